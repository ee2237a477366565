"""The word hash on words made to collide, and the pipeline on columns whose names clash."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm import DOCS, docs

from tessera.llm import decontamination, jaccard_join, language_id
from tessera.llm.common import WordScanner, byte_class


def exchanged(n, a="a", b="b"):
    """Two words of 2^n letters, built by doubling with exchanged letters; they collide under powers of any base modulo 2^64."""
    for _ in range(n):
        a, b = a + b, b + a
    return a, b


@pytest.mark.parametrize("n", [9, 10, 11, 13])
def test_exchanged_words_have_different_hashes(n):
    one, other = exchanged(n)
    data = np.frombuffer(f"{one} {other} {one.upper()} {one[:-1]}".encode(), np.uint8)
    *_, hashes, _ = WordScanner(byte_class((0x20, 0x20), invert=True)).scan(np.array([0, len(data)]), data)
    assert hashes[0] == hashes[2] and len(set(hashes.tolist())) == 3


def test_hashes_do_not_depend_on_the_slice():
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("abc"), rng.integers(1, 90))) for _ in range(3000)]
    text = " ".join(words).encode()
    scanner = WordScanner(byte_class((0x20, 0x20), invert=True))
    whole = scanner.scan(np.array([0, len(text)]), np.frombuffer(text, np.uint8))[2]
    alone = [scanner.scan(np.array([0, len(w)]), np.frombuffer(w.encode(), np.uint8))[2][0] for w in words]
    assert whole.tolist() == alone
    assert len(set(alone)) == len(set(words))


def test_exchanged_words_do_not_link_documents(spark):
    one, other = exchanged(10)
    common = [f"w{k}" for k in range(20)]
    left, right = list(common), list(common)
    left[8], right[8] = one, other  # five of sixteen shingles differ
    rows = [(1, " ".join(left), "en"), (2, " ".join(right), "en")]
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.near_duplicates(docs(spark, rows)).collect()}
    assert got == {1: 1, 2: 2}


def test_near_copies_that_do_not_link_are_not_paired(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base, texts = [f"b{k}" for k in range(100)], {}
    for d in range(120):  # two words of each exchanged, far from each other: mostly 40 shingles apart, 27 are allowed
        words = list(base)
        words[rng.integers(5, 45)], words[rng.integers(55, 95)] = f"x{d}", f"y{d}"
        texts[d] = words
    sets = {d: {tuple(w[k:k + 5]) for k in range(96)} for d, w in texts.items()}
    root = {d: d for d in texts}
    links = [(a, b) for a in texts for b in range(a + 1, 120) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    for _ in texts:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    made, write = {}, jaccard_join.materialize

    def counted(df, name):
        out = write(df, name)
        made[name] = out.count()
        return out
    monkeypatch.setattr(jaccard_join, "materialize", counted)
    got = jaccard_join.near_duplicates(docs(spark, [(d, " ".join(w), "en") for d, w in texts.items()])).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == root and 0 < len(links) < 2000
    assert 0 < made["rest"] < 2 * len(links) + 200  # all pairs that postings allow: some 7000


def test_parities_differ_at_most_as_much_as_sets():
    rng = np.random.default_rng(4)
    sets = [rng.integers(0, 2000, rng.integers(0, 900)).astype(np.uint64) for _ in range(60)]
    sets = [np.unique(s) for s in sets]
    bits = np.unpackbits(jaccard_join._parities(sets).view(np.uint8).reshape(60, -1), axis=1)
    apart = [(int((bits[a] != bits[b]).sum()), len(np.setxor1d(sets[a], sets[b]))) for a in range(60) for b in range(60)]
    assert all(x <= d and (d - x) % 2 == 0 for x, d in apart) and any(x > 100 for x, _ in apart)
    assert jaccard_join._parities([]).shape == (0, jaccard_join.PARITY)


def test_exchanged_words_are_no_benchmark_hit(spark):
    one, other = exchanged(10)
    words = [f"w{k}" for k in range(10)]
    item, text = list(words), list(words)
    item[4], text[4] = one, other
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    rows = [(1, " ".join(text), "en"), (2, " ".join(item), "en")]
    got = {r["doc_id"]: r["n_hit"] for r in decontamination.benchmark_hits(docs(spark, rows), benchmark).collect()}
    assert got == {1: 0, 2: 10}


CLASHING = ["score", "lang_pred", "_t1", "_t2", "_doc_id", "t1", "root", "component_id", "n_hit", "items", "base", "added", "k0", "_0"]


def test_stages_pass_columns_of_any_name_through(spark):
    import corpus_pipeline as pipeline
    words = "the of and to in is that it for on".split()
    rows = [(k, " ".join(words[(k * j) % 10] for j in range(3, 40)) + f" own{k}", ["en", "fr"][k % 2]) for k in range(12)]
    rows += [(20, rows[0][1], "en"), (20, rows[0][1], "en"), (21, rows[1][1] + " mail me@here.org", None), (22, "!!", "en")]
    plain = docs(spark, rows)
    clashing = plain
    for c in CLASHING:
        clashing = clashing.withColumn(c, F.concat(F.lit(c), F.col("doc_id")))
    sf = "/root/testdata/sf0.001"
    for name, stage in pipeline.STAGES[:-1]:
        plain, clashing = stage(spark, plain, sf), stage(spark, clashing, sf)
        assert plain.columns == [c.split()[0] for c in DOCS.split(", ")] and clashing.columns == plain.columns + CLASHING, name
        found = clashing.collect()
        assert sorted(map(str, plain.collect())) == sorted(map(str, clashing.select(plain.columns).collect())), name
        assert all(r[c] == f"{c}{r['doc_id']}" for r in found for c in CLASHING), name
    assert clashing.count() >= 10
    packed = pipeline.STAGES[-1][1](spark, clashing, sf)
    assert packed.select("doc_id").distinct().count() == clashing.count()


def test_the_language_stage_uses_its_prediction(spark, monkeypatch):
    import corpus_pipeline as pipeline
    german, english = "der die das und nicht ein ist von zu mit " * 4, "the of and to not one is from at with " * 4
    rows = [(k, (german if k % 2 else english) + f"x{k}", "de" if k % 2 else "en") for k in range(40)]
    rows += [(100, german, None), (101, english, None), (102, "12 34", None), (103, None, "de"), (104, english, "de")]
    stage = lambda: {r["doc_id"]: r["lang"] for r in pipeline.identify_language(spark, docs(spark, rows), "").collect()}
    got = stage()
    assert got[100] == "de" and got[101] == "en" and got[104] == "de" and 102 not in got and 103 not in got and len(got) == 43
    # another model, another result
    train = language_id.train
    swapped = {"de": "en", "en": "de"}
    monkeypatch.setattr(language_id, "train", lambda d: train(d.withColumn("lang", F.col("lang")).replace(swapped, subset="lang")))
    got = stage()
    assert got[100] == "en" and got[101] == "de" and got[104] == "de"


def test_a_filter_skips_shards_by_their_minima_and_maxima(spark, tmp_dir):
    """Shards written along the curve, read back through the statistics that a reader prunes by."""
    import glob

    import pyarrow.parquet as pq

    from tessera.llm import sharding
    rng = np.random.default_rng(7)
    langs, sources = ["de", "en", "es", "fr", "it", "pl"], [f"site{k:02d}.org" for k in range(40)]
    rows = [(k, "x" * int(2 ** rng.uniform(1, 12)), str(rng.choice(langs)), str(rng.choice(sources))) for k in range(6000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    sharding.write_shards(table, sharding.shard(table), f"{tmp_dir}/shards")
    ranges = []
    for shard in range(sharding.SHARDS):
        groups = [pq.ParquetFile(f).metadata.row_group(g) for f in glob.glob(f"{tmp_dir}/shards/shard={shard}/*.parquet")
                  for g in range(pq.ParquetFile(f).metadata.num_row_groups)]
        stats = {c: [col.statistics for g in groups for col in (g.column(k) for k in range(g.num_columns)) if col.path_in_schema == c] for c in ("lang", "source")}
        ranges.append({c: (min(s.min for s in own), max(s.max for s in own)) for c, own in stats.items()})

    def kept(column, value):
        return sum(r[column][0] <= value <= r[column][1] for r in ranges)
    assert np.mean([kept("lang", v) for v in langs]) < 0.6 * sharding.SHARDS
    assert np.mean([kept("source", v) for v in sources]) < 0.6 * sharding.SHARDS
    for column, value in (("lang", "es"), ("source", "site07.org")):
        found = spark.read.parquet(f"{tmp_dir}/shards").where(F.col(column) == value)
        assert found.count() == sum(value in r for r in rows)
        assert found.select("shard").distinct().count() <= kept(column, value)
