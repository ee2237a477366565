"""The operators' registered queries and their SQL; each query takes ``(spark, sf_dir)``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.llm import (attention_lm, collocations, decontamination, hard_negatives, jaccard_join, language_id, lsh_forest, packing, pii, secret_scan,
                         sharding, token_counts, warc)


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the installed public tokenizer files lie."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_secret_scan(spark, sf_dir):
    """Secrets in all documents: assignments, access keys and hex strings."""
    found = secret_scan.digest(secret_scan.scan(_table(spark, sf_dir, "documents")))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op2_token_counts(spark, sf_dir):
    """Greedy longest-match word-piece counts of all documents."""
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), tokenizer_path())


def op3_best_fit_packing(spark, sf_dir):
    """All documents, tokenised and cut, packed into sequences of at most 2048 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())


def op4_ngram_jaccard_join(spark, sf_dir):
    """Near duplicates of all documents at a Jaccard similarity of 0.75 on five-word shingles."""
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_warc(spark, sf_dir):
    """All pages written to WARC archives, and what reading the archives gives."""
    archives = warc.write_archives(_table(spark, sf_dir, "pages"))
    found = warc.read_archives(spark, archives, payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_language_id(spark, sf_dir):
    """The language of all documents; learned from those that are not held out."""
    documents = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text", "lang")
    found = language_id.identify(documents, language_id.train(documents), ["doc_id"])
    held_out = F.coalesce(language_id.held_out_remainder() == 1, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_pii(spark, sf_dir):
    """Personal data in all documents: the base patterns' spans and those of the random field."""
    documents = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    return pii.digest(pii.find(documents, ["doc_id"]))


def op8_sharding(spark, sf_dir):
    """All documents in 24 shards along a Hilbert curve, row counts at most one apart."""
    placed = sharding.shard(_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "curve")


def op9_benchmark_decontamination(spark, sf_dir):
    """Words of all documents inside any occurrence of a ten-word window of a benchmark item."""
    hits = decontamination.benchmark_hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return decontamination.hits_digest(hits)


def op10_lsh_forest(spark, sf_dir):
    """The ten nearest neighbours found of every vector whose id is divisible by 100."""
    return lsh_forest.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_phrase_collocations(spark, sf_dir):
    """The first 2000 phrases of two or three words of each language by the lowest score of their cuts."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark, sf_dir):
    """The first five rows of other labels in the score window of each of the first five rows of an anchor's label."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op13_lm_scores(spark, sf_dir):
    """The log10 probability of all documents by a unigram base and by a self-attention model on subword ids."""
    return attention_lm.score_texts(_table(spark, sf_dir, "documents"), tokenizer_path())


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_token_counts, op3_best_fit_packing, op4_ngram_jaccard_join, op5_warc, op6_language_id,
    op7_pii, op8_sharding, op9_benchmark_decontamination, op10_lsh_forest,
    op11_phrase_collocations, op12_hard_negatives, op13_lm_scores)}

#: DuckDB SQL for the queries that SQL can express.
SQL = {
    "op1_secret_scan": r"""
with docs as (select doc_id, coalesce(text, '') as text from documents),
rules(rule, kind, pattern, val_group, least) as (values
  (0, 'assign', '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
  (1, 'access', '(AKIA[A-Z0-9]+)', 1, 20),
  (2, 'hex', '([0-9a-f]+)', 1, 24)),
parts as (
  select doc_id, text, 0 as rule, string_split_regex(text, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+') as gaps,
         regexp_extract_all(text, '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0) as found,
         regexp_extract_all(text, '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2) as vals from docs
  union all
  select doc_id, text, 1, string_split_regex(text, 'AKIA[A-Z0-9]+'), regexp_extract_all(text, 'AKIA[A-Z0-9]+'), regexp_extract_all(text, 'AKIA[A-Z0-9]+') from docs
  union all
  select doc_id, text, 2, string_split_regex(text, '[0-9a-f]+'), regexp_extract_all(text, '[0-9a-f]+'), regexp_extract_all(text, '[0-9a-f]+') from docs),
each as (select doc_id, rule, unnest(range(1, len(found) + 1)) as i, gaps, found, vals from parts),
lens as (
  select doc_id, rule, i, length(vals[i]) as n, length(found[i]) as m,
         cast(sum(length(gaps[i])) over w as bigint) as gap, cast(sum(length(found[i])) over w as bigint) as upto
  from each window w as (partition by doc_id, rule order by i)),
spans as (
  select l.doc_id, l.rule, r.kind, gap + upto - m as s, gap + upto as e
  from lens l join rules r using (rule) where n >= least),
texts as (
  select doc_id, count(*) filter (rule = 0) as n_assign, count(*) filter (rule = 1) as n_access, count(*) filter (rule = 2) as n_hex,
         string_agg(kind || ':' || s || ':' || e, ',' order by s, rule) as spans
  from spans group by doc_id)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans
from docs d left join texts using (doc_id)""",
    "op11_phrase_collocations": r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
phrases as (
  select lang, 1 as k, unnest(w) as p from words
  union all
  select lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from words where len(w) > 1
  union all
  select lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) from words where len(w) > 2),
f as materialized (select lang, k, p, count(*) as f from phrases group by all having count(*) >= 10),
fs as materialized (select struct_pack(lang := lang, p := p) as s, f from f),
n as (select lang, count(*) as n from phrases where k = 1 group by lang),
cand as materialized (select lang, k, p, f, string_split(p, ' ') as w from f where k > 1),
parts as (
  select lang, p, k, f as a, 1 as cut, w[1] as lp, array_to_string(w[2:], ' ') as rp from cand
  union all
  select lang, p, k, f, 2, w[1] || ' ' || w[2], w[3] from cand where k = 3),
cuts as (
  select c.lang, c.p, c.a, c.cut, l.f as l, r.f as r,
         cast((1000000::hugeint * c.a * c.a) // (l.f::hugeint * r.f) as bigint) as score
  from parts c join fs l on l.s = struct_pack(lang := c.lang, p := c.lp) join fs r on r.s = struct_pack(lang := c.lang, p := c.rp)),
best as (select * from cuts qualify row_number() over (partition by lang, p order by score, cut) = 1),
inside as (
  select lang, w[1] || ' ' || w[2] as p, f from cand where k = 3
  union all
  select lang, w[2] || ' ' || w[3], f from cand where k = 3),
gone as (select distinct s.lang, s.p from cand s join inside g on g.lang = s.lang and g.p = s.p and s.k = 2 and 100 * g.f >= 50 * s.f),
kept as (select *, p as phrase from best where (lang, p) not in (select (lang, p) from gone))
select lang, rank, phrase, a, l, r, n, score from (
  select lang, cast(row_number() over (partition by lang order by score desc, a desc, phrase) as int) as rank, phrase, a, l, r, n, score
  from kept join n using (lang)) where rank <= 2000""",
    "op12_hard_negatives": """
with e as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as anchor_id, a.label as anchor_label, r.vec_id, r.label, cast(list_dot_product(a.q, r.q) as bigint) as score
  from e a join e r on a.vec_id % 100 = 0 and r.vec_id <> a.vec_id and len(a.q) = len(r.q)),
p as (
  select anchor_id, vec_id as positive_id, score as positive_score from s where label = anchor_label
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, positive_id, cast(row_number() over w as int) as rank, s.vec_id as negative_id, positive_score, s.score as negative_score
from p join s on s.anchor_id = p.anchor_id and s.label <> s.anchor_label
 and 80 * positive_score <= 100 * s.score and 100 * s.score <= 100 * positive_score
window w as (partition by p.anchor_id, positive_id order by s.score desc, s.vec_id)
qualify row_number() over w <= 5""",
    "op4_ngram_jaccard_join": r"""
with w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
s as materialized (
  select distinct doc_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                      when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as sh from w),
n as materialized (select doc_id, count(*) as n from s group by doc_id),
shared as materialized (
  select a.doc_id as x, b.doc_id as y, count(*) as k from s a join s b on a.sh = b.sh and a.doc_id < b.doc_id group by all),
links as materialized (
  select x, y from shared join n p on p.doc_id = x join n q on q.doc_id = y where 100 * k >= 75 * (p.n + q.n - k)),
edges as materialized (select x, y from links union all select y, x from links),
reach as (
  with recursive r(x, y) as (select doc_id, doc_id from n union select r.x, e.y from r join edges e on e.x = r.y)
  select x, min(y) as least from r group by x)
select d.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(least, d.doc_id) as component_id
from documents d left join n on n.doc_id = d.doc_id left join reach on reach.x = d.doc_id""",
    "op9_benchmark_decontamination": r"""
with dw as materialized (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
iw as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
items as materialized (
  select distinct item_id, least(10, len(w)) as n, unnest(list_transform(range(1, greatest(1, len(w) - 9) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) as win
  from iw where len(w) > 0),
wins as materialized (select distinct n, win from items),
places as (
  select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as win
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from dw, (select distinct n from items) where len(w) >= n)),
found as materialized (select doc_id, p.n, i, p.win from places p join wins on wins.win = p.win and wins.n = p.n),
hit as (select doc_id, count(distinct place) as n_hit from (select doc_id, unnest(range(i, i + n)) as place from found) group by doc_id),
held as (
  select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct doc_id, cast(item_id as varchar) as id from found join items on items.win = found.win and items.n = found.n) group by doc_id)
select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from dw d left join hit using (doc_id) left join held using (doc_id)""",
    "op5_warc": """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, strlen(html) as payload_bytes, sha256(html) as payload_digest from p),
f as (select payload_digest, min(page_id) as first_page from d where payload_bytes >= 100 group by payload_digest)
select page_id, payload_bytes, payload_digest,
       case when first_page < page_id then 'revisit' else 'response' end as record_type,
       case when first_page < page_id then first_page end as refers_to
from d left join f using (payload_digest)""",
}
