"""The corpus pipeline: documents through five stages to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet under the shared checkpoint folder and reads it back as the next
stage's ``docs``. All but the last keep the columns of ``documents``. Extra
columns pass through, whatever their names; null texts are undetermined in the
first stage and go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontamination, jaccard_join, language_id, packing, pii
from tessera.llm.common import broadcast_if_small, materialize
from tessera.llm.queries import tokenizer_path


def _plain(docs: DataFrame, *known: str) -> DataFrame:
    """``docs`` with columns named by place, but for the known ones, so that no name clashes with an operator's."""
    return docs.toDF(*[c if c in known else f"k{i}" for i, c in enumerate(docs.columns)])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is undetermined (no text or no letter); the others' null languages become the predicted ones.

    Without a labelled row nothing can be learned: documents with a letter stay as they are.
    """
    trees = language_id.train(docs.select("doc_id", "text", "lang"))
    if not trees.languages:
        return language_id.with_letters(docs)
    rows = _plain(docs, "text", "lang")
    found = language_id.identify(rows, trees, rows.columns).where(F.col("lang_pred") != language_id.UNDETERMINED)
    filled = F.coalesce("lang", F.col("lang_pred").cast(docs.schema["lang"].dataType)).alias("lang")
    return found.select(*[filled if c == "lang" else c for c in rows.columns]).toDF(*docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near duplicates: the smallest id's (null after all others), of these the smallest text hash's."""
    texts = docs.select("doc_id", "text")
    found = materialize(jaccard_join.near_duplicates(texts, rows=True).where("n_shingles > 0"), "classes")
    row, is_first = ["doc_id", "t1", "t2"], F.col("doc_id").eqNullSafe(F.col("component_id"))
    gone = found.where(~is_first).select(row).distinct()
    # groups in which several rows have the smallest id, or none has one
    first = found.where(is_first)
    several = materialize(first.groupBy("root").count().where("count > 1").select("root"), "several")
    again = None
    if several.limit(1).count():
        tied = materialize(first.join(broadcast_if_small(several, 64), "root").groupBy("root", *row).agg(F.count("*").alias("k")), "tied")
        least = materialize(tied.groupBy("root").agg(F.min(F.struct("t1", "t2")).alias("least")), "least")
        tied = tied.join(broadcast_if_small(least, 96), "root")
        gone = gone.union(tied.where("struct(t1, t2) <> least").select(row))
        again = materialize(tied.where("struct(t1, t2) = least and k > 1").select(row), "repeated_rows")
    rows = _plain(docs, "doc_id", "text")

    def among(left: DataFrame, some: DataFrame, how: str) -> DataFrame:
        some = broadcast_if_small(some.select(*[F.col(c).alias(f"_{c}") for c in row]), 96)
        same = F.col("doc_id").cast("long").eqNullSafe(F.col("_doc_id")) & (F.xxhash64("text") == F.col("_t1"))
        return left.join(some, same & (F.xxhash64(F.lit(1), "text") == F.col("_t2")), how).select(*rows.columns)

    kept = among(rows, materialize(gone, "gone"), "left_anti")
    if again is not None and again.limit(1).count():
        # rows that repeat an id and a text: one of them stays
        kept = among(kept, again, "left_anti").union(among(kept, again, "left_semi").dropDuplicates(["doc_id", "text"]))
    return kept.toDF(*docs.columns)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a ten-word window of a benchmark item."""
    return decontamination.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind and recount the characters."""
    masked = pii.mask(_plain(docs, "text", "n_chars"))
    if "n_chars" in masked.columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn("n_chars", F.coalesce(F.char_length("text"), F.col("n_chars")).cast(kind))
    return masked.toDF(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenise, cut and pack what is left into sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", remove_near_duplicates),
    ("decontamination", remove_contaminated),
    ("personal_data", mask_personal_data),
    ("packing", pack),
]

#: Training, similarity joins and tokenisation have no SQL form; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
