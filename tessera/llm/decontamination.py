"""Benchmark decontamination: an FM-index per shard of the training texts.

Test items become windows of ten consecutive words (an item of fewer words is
one window). Each task cuts its documents into shards of about ``SHARD_WORDS``
words and builds over each an FM-index: suffix array (prefix doubling),
Burrows-Wheeler transform, wavelet-matrix ranks and sampled suffix positions.
All windows are searched backwards at once; occurrences are located by walking
to the next sample, and their word ranges merged into removal spans.

A word that no test item holds cannot be part of an occurrence, so the index
holds the runs of words between such words, each with an end mark of its own.
Words are matched by 64-bit hashes.

Items are read in blocks of about ``BLOCK_BYTES`` (hashed over the blocks), the
only data that is broadcast; with several blocks the documents are passed once
for each and the spans united. Nothing is shuffled with one block.

Null and empty texts have no words; null or repeated item ids are allowed (a
null id is shown as an empty string, an id counts once); extra columns are
ignored; a text of any length is searched whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WordScanner, arrow_rows, byte_class, materialize, text_buffer

WINDOW = 10
SHARD_WORDS = 500_000
BLOCK_BYTES = 8 << 20
SAMPLE = 8
WORD_BYTES = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


class FMIndex:
    """Over runs of symbols 1..n_symbols, separated by 0; every 0 differs from the others and sorts first."""

    def __init__(self, text: np.ndarray, n_symbols: int):
        n = len(text)
        ends = np.flatnonzero(text == 0)
        counts = np.bincount(text, minlength=n_symbols + 1)
        self.first = np.cumsum(counts) - counts  # of the rows that begin with a symbol
        rank = self.first[text]
        rank[ends] = np.arange(len(ends))
        active = np.flatnonzero((counts[text] > 1) & (text > 0))
        ahead = 1
        while len(active):
            key = rank[active] << 32 | rank[active + ahead]
            order = np.argsort(key)
            active, key = active[order], key[order]
            old = key >> 32
            at = np.arange(len(key))
            new_old = np.concatenate(([True], old[1:] != old[:-1]))
            new = np.concatenate(([True], key[1:] != key[:-1]))
            group = np.flatnonzero(new)
            number = np.cumsum(new) - 1
            rank[active] = old + group[number] - np.maximum.accumulate(np.where(new_old, at, 0))
            active = active[np.diff(np.append(group, len(key)))[number] > 1]
            ahead *= 2
        suffix = np.empty(n, np.int64)
        suffix[rank] = np.arange(n)
        self.bwt = text[suffix - 1]
        marked = (suffix % SAMPLE == 0) | (self.bwt == 0)  # a run's start has no symbol to walk to
        self.sample_number = np.cumsum(marked) - marked
        self.marked, self.samples, self.size = marked, suffix[marked], n
        self.levels, row = [], self.bwt
        for level in reversed(range(max(1, int(n_symbols).bit_length()))):
            bit = (row >> level) & 1
            ones = np.zeros(n + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.levels.append((level, ones, n - int(ones[-1])))
            bit = bit.astype(bool)
            row = np.concatenate((row[~bit], row[bit]))
        self.origin = self._descend(np.arange(n_symbols + 1), np.zeros(n_symbols + 1, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, ones, zeros in self.levels:
            one = ones[at]
            at = np.where((symbol >> level) & 1, zeros + one, at - one)
        return at

    def step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The row reached by putting ``symbol`` before the suffixes up to row ``at``."""
        return self.first[symbol] + self._descend(symbol, at) - self.origin[symbol]

    def search(self, patterns: np.ndarray):
        """Row intervals of equally long patterns: numbers of those that occur, low, high."""
        which = np.arange(len(patterns))
        low, high = np.zeros(len(which), np.int64), np.full(len(which), self.size, np.int64)
        for j in reversed(range(patterns.shape[1])):
            symbol = patterns[which, j]
            low, high = self.step(symbol, low), self.step(symbol, high)
            there = low < high
            which, low, high = which[there], low[there], high[there]
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows."""
        out, walked, todo = np.empty(len(rows), np.int64), 0, np.arange(len(rows))
        rows = rows.copy()
        while len(todo):
            done = self.marked[rows]
            out[todo[done]] = self.samples[self.sample_number[rows[done]]] + walked
            todo, rows = todo[~done], rows[~done]
            rows = self.step(self.bwt[rows], rows)
            walked += 1
        return out


class TestWindows:
    """The windows of a block of items as symbol patterns, by length, with their items."""

    def __init__(self, items: list[tuple[str, str | None]]):
        scanner = WordScanner(WORD_BYTES)
        names = sorted({i for i, _ in items})
        number = {x: k for k, x in enumerate(names)}
        column = pa.array([t for _, t in items], pa.string())
        _, _, words, first = scanner.scan(*text_buffer(column))
        self.items = names
        self.words, symbols = np.unique(words, return_inverse=True)
        symbols = symbols + 1
        owners: dict[bytes, set[int]] = {}
        for k, (name, _) in enumerate(items):
            own = symbols[first[k]:first[k + 1]].astype(np.int32)
            for j in range(max(1, len(own) - WINDOW + 1) if len(own) else 0):
                owners.setdefault(own[j:j + WINDOW].tobytes(), set()).add(number[name])
        self.by_length = []
        for m in sorted({len(k) // 4 for k in owners}):
            keys = sorted(k for k in owners if len(k) == 4 * m)
            patterns = np.frombuffer(b"".join(keys), np.int32).reshape(-1, m)
            self.by_length.append((m, patterns, [np.array(sorted(owners[k])) for k in keys]))
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.words >> np.uint64(48)).astype(np.int64)] = True

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), np.int32)
        if len(self.words):
            at = np.flatnonzero(self.maybe[(hashes >> np.uint64(48)).astype(np.int64)])
            place = np.minimum(np.searchsorted(self.words, hashes[at]), len(self.words) - 1)
            known = self.words[place] == hashes[at]
            out[at[known]] = place[known] + 1
        return out


def occurrences(windows: TestWindows, symbols: np.ndarray, first: np.ndarray):
    """Of one shard: start and end word of each occurrence, its window length group and number in it."""
    kept = np.flatnonzero(symbols)
    none = np.zeros(0, np.int64)
    if not len(kept):
        return none, none, []
    begins = np.zeros(len(symbols) + 1, bool)
    begins[first] = True
    run = np.cumsum(np.concatenate(([False], (kept[1:] != kept[:-1] + 1) | begins[kept[1:]])))
    place = np.arange(len(kept)) + run
    text = np.zeros(len(kept) + run[-1] + 1, np.int32)
    text[place] = symbols[kept]
    word = np.zeros(len(text), np.int64)
    word[place] = kept
    index = FMIndex(text, len(windows.words))
    starts, ends, which = [none], [none], []
    for g, (m, patterns, _) in enumerate(windows.by_length):
        number, low, high = index.search(patterns)
        size = high - low
        rows = np.repeat(high - np.cumsum(size), size) + np.arange(size.sum())
        at = word[index.locate(rows)]
        starts.append(at), ends.append(at + m)
        which.append((g, np.repeat(number, size), at))
    return np.concatenate(starts), np.concatenate(ends), which


HITS = ("n_words long, n_hit long, items array<string>, "
        "spans array<struct<first_word:long,end_word:long,start:long,end:long>>")
FOUND = f"rid long, doc_id long, {HITS}"


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching ranges united."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], starts[1:] > reach[:-1]))
    return starts[new], reach[np.concatenate((new[1:], [True]))]


def _search_task(shared, keep: list[str]):
    def run(batches):
        windows, scanner = shared.value, WordScanner(WORD_BYTES)
        kept, symbols, firsts, bounds, total = [], [], [], [], 0

        def flush():
            first = np.concatenate([*firsts, [total]])
            sym = np.concatenate(symbols)
            starts, ends, which = occurrences(windows, sym, first)
            n_words = np.diff(first)
            cover = np.cumsum(np.bincount(starts, minlength=total + 1) - np.bincount(ends, minlength=total + 1)) > 0
            n_hit = np.diff(np.concatenate(([0], np.cumsum(cover)))[first])
            items: dict[int, set[int]] = {}
            for g, number, at in which:
                doc = np.searchsorted(first, at, "right") - 1
                pairs = np.unique(doc * len(windows.by_length[g][2]) + number)
                for d, k in zip((pairs // len(windows.by_length[g][2])).tolist(), (pairs % len(windows.by_length[g][2])).tolist()):
                    items.setdefault(d, set()).update(windows.by_length[g][2][k].tolist())
            spans = [[] for _ in n_words]
            if len(starts):
                byte_at, byte_end = np.concatenate([b[0] for b in bounds]), np.concatenate([b[1] for b in bounds])
                doc = np.searchsorted(first, starts, "right") - 1
                order = np.argsort(doc, kind="stable")
                cut = np.searchsorted(doc[order], np.arange(len(n_words) + 1))
                for d in np.flatnonzero(np.diff(cut)).tolist():
                    own = order[cut[d]:cut[d + 1]]
                    a, b = merged(starts[own], ends[own])
                    spans[d] = _spans(a, b, first[d], byte_at, byte_end)
            return pa.RecordBatch.from_arrays(
                [*[pa.concat_arrays([b.column(c) for b in kept]) for c in keep], pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array([sorted(windows.items[k] for k in items.get(d, ())) for d in range(len(n_words))], pa.list_(pa.string())),
                 pa.array(spans, pa.list_(pa.struct([(k, pa.int64()) for k in ("first_word", "end_word", "start", "end")])))],
                names=[*keep, "n_words", "n_hit", "items", "spans"])

        for batch in batches:
            offsets, data = text_buffer(batch.column("text"))
            begin, end, hashes, first = scanner.scan(offsets, data)
            origin = np.repeat(offsets[:-1], np.diff(first))
            kept.append(batch)
            symbols.append(windows.symbols(hashes)), firsts.append(first[:-1] + total)
            bounds.append(((begin - origin), (end - origin)))
            total += len(hashes)
            if total >= SHARD_WORDS:
                yield flush()
                kept, symbols, firsts, bounds, total = [], [], [], [], 0
        if kept:
            yield flush()
    return run


def _spans(a: np.ndarray, b: np.ndarray, first: int, byte_at: np.ndarray, byte_end: np.ndarray) -> list[dict]:
    return [{"first_word": x - first, "end_word": y - first, "start": s, "end": e}
            for x, y, s, e in zip(a.tolist(), b.tolist(), byte_at[a].tolist(), byte_end[b - 1].tolist())]


def _unite_task(batches):
    """Rows of several blocks, gathered per document: spans and items united."""
    for batch in batches:
        spans, hits, items = [], [], []
        for row, names in zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist()):
            own, end = [], -1
            for s in sorted(row, key=lambda s: (s["first_word"], s["end_word"])):
                if own and s["first_word"] <= end:
                    if s["end_word"] > end:
                        own[-1]["end_word"], own[-1]["end"] = s["end_word"], s["end"]
                else:
                    own.append(s)
                end = own[-1]["end_word"]
            spans.append(own), hits.append(sum(s["end_word"] - s["first_word"] for s in own)), items.append(sorted(set(names)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("rid"), batch.column("doc_id"), batch.column("n_words"), pa.array(hits, pa.int64()),
             pa.array(items, pa.list_(pa.string())), pa.array(spans, batch.schema.field("spans").type)], names=["rid", "doc_id", "n_words", "n_hit", "items", "spans"])


def _windows(benchmark: DataFrame, block_bytes: int):
    """The blocks of a benchmark's windows, each as a broadcast."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    blocks = max(1, -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes))
    for k in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        yield benchmark.sparkSession.sparkContext.broadcast(TestWindows(sorted({(r["item"], r["text"]) for r in own.collect()}, key=str)))


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``documents`` without a window of any item; one pass for each block, no shuffle."""
    arrow_rows(documents.sparkSession)
    names = documents.columns
    plain = [f"_{k}" for k in range(len(names))]  # extra columns may have any name
    at = names.index("text")
    rows = documents.toDF(*plain).withColumnRenamed(plain[at], "text")
    plain[at] = "text"
    typed = ", ".join(f"`{c}` {f.dataType.simpleString()}" for c, f in zip(plain, documents.schema))
    for windows in _windows(benchmark, block_bytes):
        rows = rows.mapInArrow(_search_task(windows, plain), f"{typed}, {HITS}").where("n_hit = 0").select(*plain)
    return rows.toDF(*names)


def benchmark_hits(documents: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (ids as strings) and merged spans (words and UTF-8 bytes)."""
    arrow_rows(documents.sparkSession)
    blocks = list(_windows(benchmark, block_bytes))
    docs = documents.select(F.col("doc_id").cast("long"), "text")
    if len(blocks) == 1:
        return docs.mapInArrow(_search_task(blocks[0], ["doc_id"]), f"doc_id long, {HITS}")
    rows = docs.withColumn("rid", F.xxhash64("doc_id", "text"))
    found = [rows.mapInArrow(_search_task(windows, ["rid", "doc_id"]), FOUND) for windows in blocks]
    hits = found[0]
    for f in found[1:]:
        hits = hits.union(f)
    # equal rows share a rid; each is counted once per block and multiplied back
    parts = hits.groupBy("rid", "doc_id", "n_words").agg(
        F.flatten(F.collect_set("items")).alias("items"), F.flatten(F.collect_set("spans")).alias("spans"), (F.count("*") / len(blocks)).cast("int").alias("copies"))
    parts = materialize(parts, "block_hits")
    united = parts.select("rid", "doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), "items", "spans").mapInArrow(_unite_task, FOUND)
    copies = parts.where("copies > 1").select(F.col("rid").alias("r"), F.explode(F.sequence(F.lit(2), "copies")).alias("i"))
    extra = united.join(copies, F.col("rid") == F.col("r")).drop("r", "i")
    return united.union(extra).drop("rid")


def hits_digest(hits: DataFrame) -> DataFrame:
    """The item list as count and SHA-256."""
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
