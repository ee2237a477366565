"""Phrase collocations, hard negatives and language-model scores against brute force, and on awkward rows."""

import random
import re
import zlib
from collections import Counter, defaultdict
from functools import partial

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_llm import DOCS, FOLD, awkward, docs

from tessera.llm import attention_lm, collocations, hard_negatives, words
from tessera.llm.queries import tokenizer_path


class Shared:
    """What a broadcast looks like to a task."""

    def __init__(self, value):
        self.value = value


# --------------------------------------------------------------------------
# phrase collocations
# --------------------------------------------------------------------------

def brute_collocations(rows, least, longest=3, top=2000):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, count in f.items():
        candidates = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        gone = {q for p, a in candidates.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
                for q in [p[i:i + k]] if 100 * a >= 50 * count[q]}
        scored = []
        for p, a in candidates.items():
            if p not in gone:
                score, _, left, right = min((1_000_000 * a * a // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(3)
    vocabulary = ["the", "OF", "a", "né", "b\x01c", "\x02", "x-y", "(z)", "the\x01", "naïve", "and"]
    rows = []
    for k in range(400):
        text = " ".join(rng.choices(vocabulary, [9, 7, 5, 3, 2, 1, 2, 1, 2, 1, 6], k=rng.choice((1, 2, 3, 12, 60))))
        text = re.sub(" ", lambda m: rng.choice([" "] * 14 + ["\t", "  ", ". ", ",", "\n", "\r\n", " ! "]), text)
        rows.append((k, text, rng.choice(["en", "en", "fr", None, "und", "a\tb"])))
    rows += [(1000 + k, "new york city. new york", "en") for k in range(12)]
    return rows + awkward()


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("least,longest,top", [(10, 3, 2000), (2, 4, 25), (1, 2, 7)])
def test_collocations_against_brute_force(spark, prose, least, longest, top):
    got = found(collocations.collocations(docs(spark, prose).repartition(5), least, longest, top))
    assert got == brute_collocations(prose, least, longest, top) and got


def test_collocations_do_not_depend_on_runs_or_ranges(spark, prose, monkeypatch):
    want = found(collocations.collocations(docs(spark, prose), 3))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        with_more = spark.createDataFrame(docs(spark, prose).collect(), DOCS).repartition(17)
        assert found(collocations.collocations(with_more, 3)) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_runs_and_slices_cut_no_phrase(monkeypatch, prose):
    """A task that flushes its run after every slice of a few bytes counts what one whole run counts."""
    text = " ".join(t or "" for _, t, _ in prose[:300]) + "."
    batch = pa.record_batch([pa.array([text, None, text[:500]]), pa.array(["en", "en", "fr"])], ["text", "lang"])

    def counted():
        out = Counter()
        for b in collocations._count_task([0, 1, 2, 3], None)([batch]):
            for key, count in zip(b.column("key").to_pylist(), b.column("count").to_pylist()):
                out[key] += count
        return out
    want = counted()
    monkeypatch.setattr(collocations, "slices", partial(words.slices, size=40))
    monkeypatch.setattr(collocations, "RUN_WORDS", 30)
    assert counted() == want and want["en\t"] > 1000


def test_the_bit_table_holds_every_pair():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 1 << 63, 20_000).astype(np.uint64)
    table = np.zeros((collocations.CHUNKS, collocations.CHUNK_BITS // 8), np.uint8)
    for chunk in range(collocations.CHUNKS):
        own = h[h % np.uint64(collocations.CHUNKS) == chunk]
        part = pa.record_batch([pa.array(np.full(len(own), chunk, np.int32)), pa.array(own.view(np.int64))], ["chunk", "h"])
        (got,) = collocations._fill_chunk((pa.scalar(chunk),), iter([part]))
        table[chunk] = np.frombuffer(got.column("bits")[0].as_py(), np.uint8)
    assert collocations._held(table.ravel(), h).all()
    assert collocations._held(table.ravel(), rng.integers(0, 1 << 63, 20_000).astype(np.uint64)).mean() < 0.01


def test_counts_past_64_bits_are_exact(spark, monkeypatch):
    """The scores of a stream of given counts whose products do not fit 64 bits."""
    a, left, right = 3_000_000_019, 3_000_000_020, 9_000_000_001
    rows = [("x", [], 20_000_000_000), ("x", ["p"], left), ("x", ["q"], right), ("x", ["p", "q"], a)]
    streams = [spark.createDataFrame(rows, "lang string, words array<string>, count long"),
               spark.createDataFrame([], "lang string, words array<string>, count long")]
    monkeypatch.setattr(collocations, "_counts", lambda *_: streams.pop(0))
    got = collocations.collocations(docs(spark, [(1, "p q", "x")])).collect()
    assert [(r["phrase"], r["a"], r["l"], r["r"], r["score"]) for r in got] == [("p q", a, left, right, 1_000_000 * a * a // (left * right))]


def test_collocations_of_nothing(spark):
    assert found(collocations.collocations(docs(spark, []))) == []
    assert found(collocations.collocations(docs(spark, [(1, None, None), (2, "", "en"), (3, ".,;", "en")]))) == []


# --------------------------------------------------------------------------
# hard negatives
# --------------------------------------------------------------------------

def brute_negatives(rows, is_anchor, label_of):
    good = []
    for i, v, label in rows:
        label = label_of(i, label)
        if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            good.append((i, [int(np.floor(256 * float(x))) for x in v], label))
    out = []
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    for k, (i, v, label) in enumerate(good):
        if not is_anchor(i):
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, m) for n, (j, w, m) in enumerate(good) if n != k and len(w) == len(v)]
        for p, j, _ in sorted([s for s in scored if s[2] == label], key=order)[:5]:
            fit = sorted([s for s in scored if s[2] != label and 80 * p <= 100 * s[0] <= 100 * p], key=order)
            out += [(i, j, rank, n, p, q) for rank, (q, n, _) in enumerate(fit[:5], 1)]
    return sorted(out, key=str)


def mined(spark, rows, **how):
    df = spark.createDataFrame([(i, v, label, 1.0, "x") for i, v, label in rows], "vec_id long, embedding array<float>, label int, score double, rank string")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.hard_negatives(df.repartition(3), F.col("vec_id") % 10 == 0, label, **how)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert got.columns == names
    return sorted((tuple(r) for r in got.collect()), key=str)


def _moved(i, label):
    return label if label is None or i is None or i % 7 else (label + 1) % 10


def _anchor(i):
    return i is not None and i % 10 == 0


def test_negatives_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", 7)  # several sets of anchors
    rng = np.random.default_rng(4)
    rows = [(k, np.float32(rng.normal(size=12)).tolist(), int(rng.integers(0, 3))) for k in range(200)]
    rows += [(200 + k, [round(float(x) * 4) / 4 for x in rng.normal(size=12)], k % 3) for k in range(60)]       # few values: ties
    rows += [(300 + k, rows[k % 5][1], k % 3) for k in range(40)]                                              # copies
    rows += [(400 + k, np.float32(rng.normal(size=5)).tolist(), k % 2) for k in range(30)]                     # another length
    rows += [(500, None, 1), (510, [None] * 12, 1), (520, [float("nan")] * 12, 2), (530, [float("inf")] + [0.0] * 11, 2),
             (540, [0.0] * 12, 1), (550, [], 1), (551, [], 1), (552, [], 2), (560, rows[0][1], None), (None, rows[3][1], 1), (None, rows[3][1], 2)]
    want = brute_negatives(rows, _anchor, _moved)
    assert mined(spark, rows) == want and len(want) > 300


def test_negatives_of_large_components_are_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(k, (rng.normal(size=4) * 2.0 ** 18).astype(np.float32).tolist(), k % 2) for k in range(80)]  # scores over 2^53
    want = brute_negatives(rows, _anchor, _moved)
    assert mined(spark, rows) == want and max(abs(r[4]) for r in want) > 1 << 53
    with pytest.raises(Exception, match="does not fit 64 bits"):
        mined(spark, [(k, [1e12, 1e12], k % 2) for k in range(40)])


def test_negatives_of_nothing(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(10, [1.0], None), (20, None, 1)]) == []
    assert mined(spark, [(10, [1.0], 1), (11, [1.0], 2)]) == []  # no positive


def test_the_bitmap_shrinks(monkeypatch):
    """Rows whose bounds decide against them are not read to the end."""
    rng = np.random.default_rng(6)
    near, far = rng.normal(size=(20, 64)) * 0.05 + 1, rng.normal(size=(2000, 64)) * 0.05 - 1
    values = np.floor(256 * np.concatenate([near, far])).astype(np.int64)
    n = len(values)
    block = hard_negatives.Block(64, n, np.arange(n).tobytes(), np.arange(n).tobytes(), np.ones(n, np.int64).tobytes(),
                                 np.ascontiguousarray(values.T.astype(np.int16)).tobytes())
    left = []
    best = hard_negatives.Best(5)
    scan = hard_negatives.Block.scan

    def watched(self, anchor, alive, keep):
        def seen(low, high, some):
            out = keep(low, high, some)
            left.append(int(out.sum()))
            return out
        return scan(self, anchor, alive, seen)
    monkeypatch.setattr(hard_negatives.Block, "scan", watched)
    hard_negatives._same_label(block, values[0], 1, 0, best)
    exact = values @ values[0]
    assert [(-s, i) for s, i, _ in best.items] == sorted(((int(exact[i]), i) for i in range(1, n)), key=lambda x: (-x[0], x[1]))[:5]
    assert left[len(left) // 2 + 1] < 40 and left[-1] >= 5


# --------------------------------------------------------------------------
# language-model scores
# --------------------------------------------------------------------------

def lm_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))


@pytest.fixture(scope="module")
def lm_rows():
    rng = random.Random(9)
    words_ = ["the", "of", "Running", "né", "tokenize", "x" * 90, "<|endoftext|>", "a b", "it's", "§§§"]
    rows = [(k, " ".join(rng.choices(words_, k=rng.choice((0, 1, 5, 40, 90)))), "en") for k in range(120)]
    return rows + [(500 + k, f"own{k} word the of", "en") for k in range(30)] + awkward()


def scored(spark, rows, **how):
    got = attention_lm.score_texts(docs(spark, rows).repartition(3), tokenizer_path(), **how)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("table", [400_000, 3])
def test_base_scores_against_direct_counts(spark, lm_rows, monkeypatch, table):
    monkeypatch.setattr(attention_lm, "TABLE_WORDS", table)  # with a table of 3 nearly all words are joined
    got = scored(spark, lm_rows, steps=5)
    rest = lambda i: None if i is None else zlib.crc32(str(i).encode()) % 10
    count = Counter()
    for i, text, _ in lm_rows:
        if rest(i) not in (None, 0):
            count.update(lm_words(text) + [None])
    n, v = sum(count.values()), len(count)
    want = []
    for i, text, _ in lm_rows:
        w = lm_words(text) + [None]
        base = sum(np.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        want.append((i, rest(i) == 0, len(w), sum(count[x] > 0 for x in w), n, base))
    want = sorted(want, key=str)
    key = lambda r: str(r[:5])
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9) and np.isfinite(a[6]) and a[6] < 0


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(2)
    counts = np.zeros(400)
    counts[:300] = np.round(3000 / np.arange(1, 301))
    m = attention_lm.Model(counts, 50, classes=12, inner=60)
    texts = [rng.choice(300, size=rng.integers(0, 90), p=counts[:300] / counts.sum()) for _ in range(40)]
    m.train([w for t in texts for w in m.some_windows(t)], steps=60)
    return m, texts


def test_probabilities_of_all_ids_sum_to_one(model):
    m, texts = model
    ids = texts[0][:10]
    prefix = m.score(ids, np.array([0, len(ids)]))[0]
    states = m.network.hidden(np.concatenate([[0], m.unit_of[ids]])[None, :])[0, -1:]
    every = np.arange(400)
    at = np.repeat(states, 401, 0)
    logs = m.network.log_probabilities(at, np.append(m.class_of[every], 0).astype(np.int32), np.append(m.place[every], -1).astype(np.int32))
    logs = logs / np.log(10) + np.append(m.share[every], 0)
    assert (10 ** logs).sum() == pytest.approx(1, abs=1e-4)
    grown = [m.score(np.append(ids, x), np.array([0, len(ids) + 1]))[0] for x in (0, 5, 399)]
    assert all(np.isfinite(g) for g in grown) and np.isfinite(prefix)


def test_each_id_is_scored_once_in_overlapping_windows(model):
    """One window at a time, one position at a time, gives the batched score."""
    m, texts = model
    texts = texts + [np.zeros(0, int), np.tile(texts[0], 6)]
    got = m.score(np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    for text, score in zip(texts, got):
        x = np.concatenate([[0], m.unit_of[text]])
        y, place = np.concatenate([m.class_of[text], [0]]), np.concatenate([m.place[text], [-1]])
        total, done, begin = m.share[text].sum(), 0, 0
        while done < len(x):
            end = min(begin + attention_lm.WIDTH, len(x))
            states = m.network.hidden(x[None, begin:end])[0]
            for k in range(done, end):
                total += m.network.log_probabilities(states[k - begin:k - begin + 1], y[k:k + 1], place[k:k + 1])[0] / np.log(10)
            done, begin = end, begin + attention_lm.STRIDE
        assert score == pytest.approx(total, rel=1e-4)


def test_attention_sees_only_the_past(model):
    m, texts = model
    x = np.concatenate([[0], m.unit_of[np.tile(texts[0], 3)]])[None, :20]
    other = x.copy()
    other[0, 12:] = 1
    assert np.allclose(m.network.hidden(x)[0, :12], m.network.hidden(other)[0, :12])
    assert np.allclose(m.network.hidden(x), m.network.states(x), atol=1e-4)


def test_gradients_against_differences():
    rng = np.random.default_rng(1)
    m = attention_lm.Model(np.array([9.0, 5, 4, 3, 3, 2, 2, 1, 1, 1, 1, 1]), 3, classes=4, inner=5, size=6)
    net = m.network
    net.p = {k: (v + 0.1 * rng.standard_normal(v.shape)).astype(np.float64) for k, v in net.p.items()}
    x, y, place, real = np.stack([w for t in ([1, 4, 2, 9, 0], [3, 3, 7]) for w in m.some_windows(np.array(t))]).transpose(1, 0, 2)
    real = real.astype(np.float64)
    _, g = net.gradients(x, y, place, real)
    for name, value in net.p.items():
        flat = value.reshape(-1)
        for at in rng.choice(len(flat), min(4, len(flat)), replace=False):
            old = flat[at]
            ends = []
            for step in (1e-5, -1e-5):
                flat[at] = old + step
                ends.append(net.gradients(x, y, place, real)[0])
            flat[at] = old
            assert g[name].reshape(-1)[at] == pytest.approx((ends[0] - ends[1]) / 2e-5, rel=2e-2, abs=1e-4), name


def test_a_text_cut_into_slices_scores_as_a_whole(model, monkeypatch):
    """Slices of a few bytes, so that texts run over many of them."""
    with open(tokenizer_path(), encoding="utf-8") as f:
        json = f.read()
    ids = max(attention_lm.encoder(json).tokenizer.get_vocab().values()) + 1
    m = attention_lm.Model(np.ones(ids), 5)
    table = attention_lm.Table(pa.array([b"the", b"of"], pa.large_binary()), np.array([7, 0]), json)
    text = ["", None, "the of other words " * 30, "  ", "one", "the", "x " * 200, "", None]
    n = len(text)
    batch = pa.record_batch([pa.array(range(n), pa.int64()), pa.array(text), pa.array([False] * n)], ["doc_id", "text", "held_out"])

    def run():
        task = attention_lm._score_task(Shared(m), Shared(table), Shared(json), 100.0, 5)
        out = defaultdict(lambda: [0, 0, 0.0, 0.0, Counter()])
        for b in task([batch]):
            for r in b.to_pylist():
                o = out[r["row"], r["doc_id"]]
                for k, c in enumerate(("n_tokens", "n_known", "base", "score")):
                    o[k] += r[c]
                o[4].update(dict(zip(r["rare"], r["times"])))
        return dict(out)
    whole = run()
    assert len(whole) == n and whole[2, 2][4] == {b"other": 30, b"words": 30} and whole[2, 2][0] == 121
    monkeypatch.setattr(attention_lm, "SCORE_BYTES", 50)
    cut = run()
    assert cut.keys() == whole.keys()
    for k in whole:
        assert cut[k][:2] == whole[k][:2] and cut[k][2:4] == pytest.approx(whole[k][2:4], rel=1e-5)


def test_held_out_texts_score_above_the_base_in_a_corpus_of_few_patterns(spark):
    """What the network learns shows: words in a fixed order are likelier than their counts say."""
    rng = random.Random(4)
    line = "red green blue yellow black white".split()
    rows = []
    for k in range(300):
        at = rng.randrange(6)
        rows.append((k, " ".join(line[(at + j) % 6] for j in range(60)), "en"))
    got = scored(spark, rows, steps=400)
    held = [r for r in got if r[1]]
    assert len(held) > 10 and sum(r[6] for r in held) > 0.5 * sum(r[5] for r in held)


def test_scores_of_nothing_and_without_training_texts(spark):
    assert scored(spark, []) == []
    only = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 10 == 0)
    (row,) = scored(spark, [(only, "some words", "en")], steps=2)
    assert row[:5] == (only, True, 3, 0, 0) and row[5] == pytest.approx(0.0) and row[6] < 0


def test_the_windows_of_the_pass_hold_every_place_once(model):
    m, texts = model
    texts = texts + [np.zeros(0, int), np.tile(texts[0], 40)]
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = Counter()
    for x, y, place, real in m.all_windows(np.concatenate(texts), starts):
        got.update(zip(*(a[real > 0].tolist() for a in (x, y, place))))
    want = Counter()
    for t in texts:
        want.update(zip([0, *m.unit_of[t].tolist()], [*m.class_of[t].tolist(), 0], [*m.place[t].tolist(), -1]))
    assert got == want


def test_a_task_of_the_pass_learns_from_all_its_texts():
    rng = np.random.default_rng(7)
    m = attention_lm.Model(np.full(12, 50.0), 5, classes=4, inner=12)
    texts = [(np.arange(300) + rng.integers(12)) % 12 for _ in range(200)]
    batch = pa.record_batch([pa.array([t.astype("<u2").tobytes() for t in texts] + [None, b""], pa.binary())], ["ids"])
    task = attention_lm._pass_task(Shared(m), "<u2", 1e-2)
    before = {k: v.copy() for k, v in m.network.p.items()}
    (out,) = task([batch] * 20)
    assert out.column("seen").to_pylist() == [20 * (200 * 301 + 1)]
    assert all((m.network.p[k] == before[k]).all() for k in before)  # the next task starts from the same weights
    ids, starts = texts[0], np.array([0, 300])
    first = m.score(ids, starts)[0]
    seen, m.network.p = attention_lm.average([(2, out.column("parameters")[0].as_py())] * 2)
    m.network.ready = {}
    assert seen == 4 and m.score(ids, starts)[0] > 0.5 * first


def test_weights_come_from_all_training_texts(spark, monkeypatch):
    """Without any text to start from, the rounds over all texts alone fit the network."""
    monkeypatch.setattr(attention_lm, "TRAIN_TEXTS", 0)
    line = "red green blue yellow black white".split()
    rows = [(k, " ".join(line[(k * 5 + j) % 6] for j in range(60)), "en") for k in range(300)]
    held = {}
    for rounds in (0, 12):
        monkeypatch.setattr(attention_lm, "ROUNDS", rounds)
        held[rounds] = sum(r[6] for r in scored(spark, rows) if r[1])
    assert held[12] > held[0]


def test_tasks_leave_no_words_in_the_workers(spark):
    """Workers live on through training and scoring: the words that reading has learned would stay beside them."""
    rows = [(k, f"zebrafinch{'abcdefghij'[k % 10]} the of", "en") for k in range(60)]
    assert len(scored(spark, rows, steps=2)) == 60

    def held(batches):
        from tessera.llm import packing
        for _ in batches:
            words_ = [w for e in packing._ENCODERS.values() for w in (*e.cache, *e.older) if "zebrafinch" in w]
            yield pa.RecordBatch.from_arrays([pa.array([len(words_)], pa.int64())], ["n"])
    assert [r["n"] for r in spark.range(0, 8, 1, 8).mapInArrow(held, "n long").collect()] == [0] * 8


def test_ids_are_remembered_for_a_bounded_number_of_words(monkeypatch):
    with open(tokenizer_path(), encoding="utf-8") as f:
        json = f.read()
    monkeypatch.setattr(attention_lm, "CACHE_WORDS", 20)
    e = attention_lm.encoder(json)
    e.forget()
    some = ["".join(random.Random(k).choices("abcdefgh", k=9)) for k in range(400)]
    found = [attention_lm.subword_ids(some[k:k + 10], json)[0] for k in range(0, 400, 10)]
    assert 0 < len(e.cache) + len(e.older) <= 2 * (20 + 10)
    e.forget()
    assert not e.cache and not e.older
    assert np.concatenate(found).tolist() == attention_lm.subword_ids(some, json)[0].tolist()
    e.forget()


def test_a_look_up_returns_the_ids_of_its_words_alone():
    with open(tokenizer_path(), encoding="utf-8") as f:
        json = f.read()
    known = [f"word{k}ing" for k in range(500)]
    table = attention_lm.Table(pa.array([w.encode() for w in known], pa.large_binary()), np.arange(500), json)
    asked = ["word7ing", "neither", "word499ing", "nor", "word0ing"]
    counts, ids, begin, end = table.look_up(pa.array([w.encode() for w in asked], pa.large_binary()), json)
    want = [attention_lm.subword_ids([w], json)[0].tolist() for w in asked]
    assert counts.tolist() == [7, -1, 499, -1, 0] and [ids[a:b].tolist() for a, b in zip(begin, end)] == want
    assert len(ids) == sum(map(len, want))
    assert [len(x) for x in table.look_up(pa.array([], pa.large_binary()), json)] == [0] * 4


def test_counting_holds_the_distinct_words_of_a_slice(monkeypatch):
    monkeypatch.setattr(attention_lm, "RUN_WORDS", 50)
    batch = pa.record_batch([pa.array(["the of the The " * 40, "one", None]), pa.array([True, False, True])], ["text", "learn"])
    out = list(attention_lm._count_words([batch] * 5))  # 15 words held, 805 read: one run
    assert len(out) == 1
    assert dict(zip(out[0].column("word").to_pylist(), out[0].column("count").to_pylist())) == {b"the": 600, b"of": 200, b"one": 0}
    monkeypatch.setattr(attention_lm, "RUN_WORDS", 6)
    got = Counter()
    for b in attention_lm._count_words([batch] * 5):
        got.update(dict(zip(b.column("word").to_pylist(), b.column("count").to_pylist())))
    assert got == {b"the": 600, b"of": 200, b"one": 0}


def test_classes_share_their_passes(model, monkeypatch):
    """Exponentials are taken of all classes' logits at once, not class by class, in training and in scoring."""
    m, texts = model
    ids, starts = np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    batch = next(m.all_windows(ids, starts))
    states = m.network.hidden(batch[0]).reshape(-1, m.network.size)
    assert m.network.several.sum() > 4
    calls, exp = [], np.exp
    monkeypatch.setattr(np, "exp", lambda *a, **k: calls.append(1) or exp(*a, **k))
    m.network.gradients(*batch)
    assert len(calls) <= 4
    calls.clear()
    m.network.log_probabilities(states, batch[1].ravel(), batch[2].ravel())
    assert len(calls) <= 2


def test_states_are_made_for_the_scored_places_alone(model, monkeypatch):
    m, texts = model
    ids = np.tile(texts[0], 40)[:attention_lm.WIDTH - 1 + 9 * attention_lm.STRIDE]  # full windows only
    x = m._places(ids, np.array([0, len(ids)]))[0][:3 * attention_lm.WIDTH].reshape(3, -1)
    assert np.allclose(m.network.states(x, 4), m.network.hidden(x)[:, 4:], atol=1e-4)
    made, states = [], attention_lm.Network.states
    monkeypatch.setattr(attention_lm.Network, "states", lambda *a: made.append((got := states(*a)).shape) or got)
    m.score(ids, np.array([0, len(ids)]))
    assert sum(a * b for a, b, _ in made) == 10 * attention_lm.WIDTH  # the text's first window is in the batch, and cut from its start
    monkeypatch.setattr(attention_lm, "SCORE_WINDOWS", 1)
    made.clear()
    m.score(ids, np.array([0, len(ids)]))
    assert sum(a * b for a, b, _ in made) == len(ids) + 1


@pytest.mark.parametrize("large", [1, 40])
def test_gradients_in_single_precision_with_logits_too_large_for_it(large):
    """Logits of classes and of numbers in them whose exponentials don't fit: as in double precision."""
    rng = np.random.default_rng(3)
    m = attention_lm.Model(np.array([9.0, 5, 4, 3, 3, 2, 2, 1, 1, 1, 1, 1]), 3, classes=4, inner=12, size=6)
    net = m.network
    for name in ("id", "out", "mix"):
        net.p[name] = rng.standard_normal(net.p[name].shape).astype(np.float32)
    net.p["id"] *= large
    net.p["out"] *= large
    batch = next(m.all_windows(rng.integers(0, 12, 300), np.array([0, 40, 40, 300])))
    y, place = batch[1].ravel(), batch[2].ravel()
    loss, g = net.gradients(*batch)
    logs = net.log_probabilities(net.hidden(batch[0]).reshape(-1, 6), y, place)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    want_loss, want = net.gradients(*batch)
    states = net.hidden(batch[0]).reshape(-1, 6)
    assert (abs(states @ net.p["out"]).max() > 100) == (large > 1)
    assert np.allclose(logs, net.log_probabilities(states, y, place), rtol=1e-3, atol=1e-3)
    for k in g:
        assert g[k].dtype == np.float32 and np.isfinite(g[k]).all()
        if large == 1:
            assert np.allclose(g[k], want[k], atol=1e-4 * max(1, abs(want[k]).max())), k
    assert np.isfinite(loss) and (large > 1 or loss == pytest.approx(want_loss, rel=1e-4))


def test_attention_logits_count_no_more_than_the_most(model):
    m, texts = model
    net = attention_lm.Network(9, np.array([0, 2, 8]), 8, size=6)
    net.p["embed"] *= 12
    x = np.random.default_rng(4).integers(0, 9, (3, 20))
    h = net.p["embed"][x]
    q, k, v = np.split(h @ net.p["qkv"], 3, axis=-1)
    a = q @ k.transpose(0, 2, 1) / np.sqrt(6) + net._near(20)
    assert a.max() > attention_lm.MOST_LOGIT
    a = np.exp(np.minimum(a, attention_lm.MOST_LOGIT))
    h1 = h + (a / a.sum(-1, keepdims=True)) @ v @ net.p["mix"]
    want = h1 + np.maximum(h1 @ net.p["up"] + net.p["up0"], 0) @ net.p["down"]
    assert np.allclose(net.hidden(x), want, rtol=1e-3, atol=1e-3)


def test_words_are_found_by_hash_and_compared_by_their_bytes(monkeypatch):
    with open(tokenizer_path(), encoding="utf-8") as f:
        json = f.read()
    rng = random.Random(5)
    some = [bytes(rng.choices(b"abcd\xc3\xa9", k=rng.choice((1, 2, 3, 31, 32, 33, 70)))) for _ in range(3000)]
    known = list(dict.fromkeys(some[:2000]))
    column = pa.array([b"before", *known], pa.large_binary()).slice(1)
    asked = list(dict.fromkeys([b"", *some]))
    place = {w: k for k, w in enumerate(known)}
    monkeypatch.setattr(attention_lm.pc, "index_in", None)  # it hashes the whole table again for every slice of a text
    table = attention_lm.Table(column, np.arange(len(known)), json)
    assert table.place(pa.array(asked, pa.large_binary())).tolist() == [place.get(w, -1) for w in asked]
    # words of one hash: none is taken for another, and one that isn't found is looked up as a rare one
    monkeypatch.setattr(attention_lm._SCANNER, "hashes", lambda offsets, data: np.diff(offsets).astype(np.uint64) // np.uint64(40))
    table = attention_lm.Table(column, np.arange(len(known)), json)
    got = table.place(pa.array(asked, pa.large_binary())).tolist()
    assert all(p in (-1, place.get(w, -1)) for w, p in zip(asked, got)) and max(got) >= 0
    counts, ids, begin, end = table.look_up(pa.array(asked[:200], pa.large_binary()), json)
    want = [attention_lm.subword_ids(attention_lm._strings(pa.array([w], pa.large_binary())), json)[0].tolist() for w in asked[:200]]
    assert [ids[a:b].tolist() for a, b in zip(begin, end)] == want
    empty = attention_lm.Table(pa.array([], pa.large_binary()), np.zeros(0, np.int64), json)
    assert empty.place(pa.array([b"x"], pa.large_binary())).tolist() == [-1]
