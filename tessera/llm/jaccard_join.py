"""Near duplicates: a grouped prefix join on distinct five-word shingles.

Two documents link when ``100 * |A & B| >= 75 * |A | B|``. The join is exact:

1. A fixed-size sketch (2^20 counters, summed over all tasks) gives every
   shingle a frequency class. A shingle's id is its class followed by 56 bits
   of its hash, so sorting a set by id puts rare shingles first and the first
   quarter of it is its *prefix*: linked sets share a shingle there. The
   sketch only decides the order, never the result.
2. Documents with equal sets collapse into one set; sets with equal prefix
   and size collapse into one *group*, and only one prefix per group is
   posted. Postings travel as binary blobs by hash range.
3. Each range emits pairs of groups that share a posting. With r shingles
   from the posting on to the end of a set, a link needs ``min(r) >= 3/7`` of
   both sizes' sum, which also bounds the sizes; and a pair is left to an
   earlier posting if the one before is shared, too. A list of over
   ``LIST_PAIRS`` groups emits stars around ``HUBS`` of them (the same ones in
   lists of the same groups) instead of all pairs, and itself.
4. Group pairs expand to members. A count of each set's shingles in small bins
   bounds what two sets can share and removes most candidates that don't link;
   the others are verified on the whole sets. Then the links' connected
   components are computed.
5. What the stars left out (long lists, groups of several members) is
   compared next, but only between sets that are not connected yet. There a
   *parity* of each set decides first: whether the number of its shingles in
   each of 1024 bins is odd. Two sets' parities differ in at most as many bins
   as the sets differ in shingles, and links differ in at most a seventh of
   both sizes' sum; near copies that don't link are mostly told apart inside
   the join. So copies in thousands cost a star, and no link is lost.

Empty and null texts have no set and link with nothing. Repeated rows and
equal texts share a set. A null ``doc_id`` never is a component's id. Extra
columns are ignored. A word of any length and a text of any length are hashed whole.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ARROW_ROWS, WordScanner, arrow_rows, broadcast_if_small, byte_class, materialize, mix, text_buffer

SHINGLE = 5
SKETCH_BITS = 20
SKETCH_PARTS = 64
LIST_PAIRS = 32
HUBS = 16
#: Words of 64 bits of a set's parity.
PARITY = 16
RANGE_ENTRIES = 1_000_000
FLUSH_ENTRIES = 1_000_000
#: Words are runs of anything but the ASCII white space.
WORD_BYTES = byte_class((0x20, 0x20), (0x09, 0x0D), invert=True)
_FACTORS = mix(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)


def _shingles(scanner: WordScanner, column: pa.Array):
    """Hashes of a batch's shingles (repeats kept) and each document's first one (n + 1)."""
    offsets, data = text_buffer(column)
    _, _, words, first = scanner.scan(offsets, data)
    counts = np.diff(first)
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(first), np.int64)
    total = np.zeros(n, np.uint64)
    for j in range(SHINGLE):
        total[:n - j] += words[j:] * _FACTORS[j]
    # a document keeps the starts with five words ahead; a shorter one its first, summed over its own words
    tail = np.zeros(n + 1, np.int32)
    full = counts >= SHINGLE
    np.add.at(tail, first[1:][full] - (SHINGLE - 1), 1)
    np.add.at(tail, first[1:][full], -1)
    keep = np.cumsum(tail[:n]) == 0
    for d in np.flatnonzero((counts > 0) & ~full):
        a, b = first[d], first[d + 1]
        keep[a + 1:b] = False
        total[a] = (words[a:b] * _FACTORS[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
    size = np.where(full, counts - (SHINGLE - 1), np.minimum(counts, 1))
    return mix(total[keep]), np.concatenate(([0], np.cumsum(size)))


def _batches(batch: pa.RecordBatch, limit: int = 4 << 20):
    """Row slices of a batch with at most ``limit`` text bytes, one row at least."""
    offsets, _ = text_buffer(batch.column("text"))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def _sketch_task(batches):
    scanner = WordScanner(WORD_BYTES)
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    for batch in batches:
        for part in _batches(batch):
            hashes, _ = _shingles(scanner, part.column("text"))
            counts += np.bincount((hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts))
    if counts.any():
        parts = counts.reshape(SKETCH_PARTS, -1)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(range(SKETCH_PARTS), pa.int32()),
            "counts": pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary())})


def _sketch_sum(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(zlib.decompress(x.as_py()), np.int64) for x in table.column("counts"))
    return pa.table({"part": table.column("part")[:1], "counts": pa.array([total.tobytes()], pa.binary())})


def frequency_classes(texts: DataFrame) -> np.ndarray:
    """One byte for each of the 2^20 counters: eight classes to a doubling of the count."""
    schema = "part int, counts binary"
    rows = texts.mapInArrow(_sketch_task, schema).groupBy("part").applyInArrow(_sketch_sum, schema).collect()
    counts = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.int64)
    for r in rows:
        counts[r["part"]] = np.frombuffer(r["counts"], np.int64)
    return np.minimum(np.rint(8 * np.log2(1 + counts.ravel())), 255).astype(np.uint8)


def _sets(scanner: WordScanner, classes: np.ndarray, column: pa.Array):
    """The sorted array of distinct shingle ids of each document of a batch."""
    hashes, first = _shingles(scanner, column)
    ids = classes[(hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(56)
    ids |= (hashes << np.uint64(8)) >> np.uint64(8)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        s = np.sort(ids[a:b])
        yield s[np.concatenate(([True], s[1:] != s[:-1]))] if len(s) > 1 else s


def _digest(data: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(data, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


PARITIES = [f"s{k}" for k in range(PARITY)]
DOCS = "rid long, doc_id long, t1 long, t2 long, n int, d1 long, d2 long, p1 long, p2 long, prefix binary, " + ", ".join(f"{c} long" for c in PARITIES)


def _parities(sets: list[np.ndarray]) -> np.ndarray:
    """Bits (set x word) that tell in which bins each set has an odd number of ids."""
    bins = 64 * PARITY
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    place = (mix(np.concatenate([np.zeros(0, np.uint64), *sets])) % np.uint64(bins)).astype(np.int64)
    odd = np.bincount(owner * bins + place, minlength=len(sets) * bins) & 1
    return np.packbits(odd.reshape(len(sets), bins).astype(np.uint8), axis=1).view(np.int64)


def _prefix_task(shared):
    def run(batches):
        scanner, classes = WordScanner(WORD_BYTES), np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for part in _batches(batch):
                n, d1, d2, p1, p2, prefix = [], [], [], [], [], []
                sets = list(_sets(scanner, classes, part.column("text")))
                for s in sets:
                    head = s[:len(s) - (3 * len(s) + 3) // 4 + 1].tobytes() if len(s) else b""
                    a, b = _digest(s.tobytes())
                    c, d = _digest(head)
                    n.append(len(s)), d1.append(a), d2.append(b), p1.append(c), p2.append(d), prefix.append(head)
                longs = [pa.array(x, pa.int64()) for x in (d1, d2, p1, p2)]
                keep = [part.column(x) for x in ("rid", "doc_id", "t1", "t2")]
                yield pa.RecordBatch.from_arrays([*keep, pa.array(n, pa.int32()), *longs, pa.array(prefix, pa.binary()), *map(pa.array, np.ascontiguousarray(_parities(sets).T))],
                                                 names=["rid", "doc_id", "t1", "t2", "n", "d1", "d2", "p1", "p2", "prefix", *PARITIES])
    return run


BLOBS = "part int, ids binary, sizes binary, hashes binary, refs binary, places binary, before binary"


def _post_task(bits: int):
    """Rows (rid, n, prefix) to posting blobs by hash range: for each posting its document, place and predecessor."""
    def flush(rids, sizes, prefixes):
        lengths = np.array([len(p) // 8 for p in prefixes])
        size = np.array(sizes, np.int32)
        rid = np.array(rids, np.int64)
        ids = mix(np.frombuffer(b"".join(prefixes), np.uint64))
        doc = np.repeat(np.arange(len(rid), dtype=np.uint32), lengths)
        place = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        low = ids.astype(np.uint32)
        before = np.concatenate((np.zeros(1, np.uint32), low[:-1]))
        place = np.minimum(place, 0xFFFF).astype(np.uint16)  # a smaller place only weakens the filter
        part = (ids >> np.uint64(64 - bits)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange((1 << bits) + 1))
        out = {k.split()[0]: [] for k in BLOBS.split(", ")}
        for k in np.flatnonzero(np.diff(cuts)):
            pick = order[cuts[k]:cuts[k + 1]]
            used, ref = np.unique(doc[pick], return_inverse=True)
            out["part"].append(int(k))
            for name, x in (("ids", rid[used]), ("sizes", size[used]), ("hashes", low[pick]), ("refs", ref.astype(np.uint32)),
                            ("places", place[pick]), ("before", before[pick])):
                out[name].append(x.tobytes())
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int32() if k == "part" else pa.binary()) for k, x in out.items()], names=list(out))

    def run(batches):
        rids, sizes, prefixes, total = [], [], [], 0
        for batch in batches:
            for r, n, p in zip(batch.column("rid").to_pylist(), batch.column("n").to_pylist(), batch.column("prefix").to_pylist()):
                rids.append(r), sizes.append(n), prefixes.append(p)
                total += len(p) // 8
                if total >= FLUSH_ENTRIES:
                    yield flush(rids, sizes, prefixes)
                    rids, sizes, prefixes, total = [], [], [], 0
        if prefixes:
            yield flush(rids, sizes, prefixes)
    return run


#: Kind 0: a candidate pair of groups (a, b); kind 1: group b of the long list a, with its size, r and predecessor.
PAIRS = "kind int, a long, b long, n int, r int, before long"


def _list_pairs(table: pa.Table) -> pa.Table:
    """All posting lists of a hash range: candidate pairs, and the entries of long lists."""
    rid, columns, base = [], {k: [] for k in ("sizes", "hashes", "refs", "places", "before")}, 0
    kinds = {"sizes": np.int32, "hashes": np.uint32, "refs": np.uint32, "places": np.uint16, "before": np.uint32}
    for i in range(table.num_rows):
        ids = np.frombuffer(table.column("ids")[i].as_buffer(), np.int64)
        for k, kind in kinds.items():
            x = np.frombuffer(table.column(k)[i].as_buffer(), kind)
            columns[k].append(x + np.int64(base) if k == "refs" else x)
        rid.append(ids)
        base += len(ids)
    part = table.column("part")[0].as_py()
    rid = np.concatenate(rid)
    size, hashes, refs, places, before = (np.concatenate(columns[k]) for k in kinds)
    order = np.argsort(hashes, kind="stable")
    hashes, refs, before = hashes[order], refs[order], before[order]
    n = size[refs]
    rest = n - places[order]
    first = places[order] == 0
    edge = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1], [True])))
    start, length = edge[:-1], np.diff(edge)
    left, right, hot = [], [], []

    def emit(x, y):
        ok = 7 * np.minimum(rest[x], rest[y]).astype(np.int64) >= 3 * (n[x].astype(np.int64) + n[y])
        ok &= (before[x] != before[y]) | first[x] | first[y]
        r, s = rid[refs[x[ok]]], rid[refs[y[ok]]]
        left.append(np.minimum(r, s)), right.append(np.maximum(r, s))

    for m in np.unique(length[(length > 1) & (length <= LIST_PAIRS)]):
        rows = start[length == m]
        i, j = np.triu_indices(m, 1)
        step = max(1, (1 << 21) // len(i))
        for k in range(0, len(rows), step):
            block = rows[k:k + step][:, None]
            emit((block + i).ravel(), (block + j).ravel())
    for a, m in zip(start[length > LIST_PAIRS], length[length > LIST_PAIRS]):
        at = np.arange(a, a + m)
        hubs = at[np.argsort(mix(rid[refs[at]].astype(np.uint64)), kind="stable")[:HUBS]]
        for hub in hubs:
            emit(np.full(m, hub), at)
        hot.append(at)
    cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    left, right, hot = cat(left), cat(right), cat(hot)
    if len(left):
        order = np.lexsort((right, left))
        left, right = left[order], right[order]
        new = np.concatenate(([True], (left[1:] != left[:-1]) | (right[1:] != right[:-1]))) & (left != right)
        left, right = left[new], right[new]
    none = np.zeros(len(left), np.int64)
    no_before = np.where(first[hot], -1 - refs[hot], before[hot].astype(np.int64))  # a first posting equals no other's
    return pa.table({
        "kind": np.repeat(np.array([0, 1], np.int32), [len(left), len(hot)]),
        "a": np.concatenate((left, np.int64(part) << np.int64(32) | hashes[hot].astype(np.int64))),
        "b": np.concatenate((right, rid[refs[hot]])), "n": np.concatenate((none, n[hot])).astype(np.int32),
        "r": np.concatenate((none, rest[hot])).astype(np.int32), "before": np.concatenate((none, no_before))})


def _outline(ids: np.ndarray) -> bytes:
    """How many ids of a set fall into each of about half as many bins; empty if a count needs over a byte."""
    bits = max(5, (len(ids) - 1).bit_length() - 1)
    counts = np.bincount((mix(ids) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else b""


def _set_task(shared):
    def run(batches):
        scanner, classes = WordScanner(WORD_BYTES), np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for part in _batches(batch):
                sets = list(_sets(scanner, classes, part.column("text")))
                columns = [pa.array(x, pa.binary()) for x in ([s.tobytes() for s in sets], [_outline(s) for s in sets])]
                yield pa.RecordBatch.from_arrays([part.column("sid"), *columns], names=["sid", "ids", "outline"])
    return run


def _possible(x: bytes, y: bytes) -> bool:
    """Whether sets with these outlines can link: they share at most the sum of the smaller counts."""
    if not x or not y:
        return True
    u, v = np.frombuffer(x, np.uint8).astype(np.int64), np.frombuffer(y, np.uint8).astype(np.int64)
    n = min(len(u), len(v))
    u, v = u.reshape(n, -1).sum(1), v.reshape(n, -1).sum(1)
    return 7 * np.minimum(u, v).sum() >= 3 * (u.sum() + v.sum())


def _linked(x: bytes, y: bytes) -> bool:
    both = np.concatenate((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)))
    both.sort(kind="stable")
    return 7 * int((both[1:] == both[:-1]).sum()) >= 3 * len(both)


def _keep_task(test):
    """Pairs (a, b) whose x and y pass ``test``."""
    def run(batches):
        for batch in batches:
            keep = [test(x, y) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of undirected ``edges`` (a, b); root is the smallest node reachable.

    In a round every node joins its smallest neighbour if that is smaller,
    chains are shortened, and the edges between what is left go to the next
    round; each round at least halves the nodes of a component of any width.
    """
    def between(rows: DataFrame, u, v) -> DataFrame:
        return rows.select(F.least(u, v).alias("u"), F.greatest(u, v).alias("v")).where("u < v").distinct()
    left = materialize(between(edges, "a", "b"), "edges")
    label = None
    while True:
        both = left.union(left.select("v", "u"))
        step = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("near")).select("node", F.least("node", "near").alias("root"))
        for _ in range(2):
            step = materialize(step, "steps")
            jump = step.select(F.col("node").alias("root"), F.col("root").alias("top"))
            step = step.join(jump, "root").select("node", F.col("top").alias("root"))
        step = materialize(step, "steps")
        if label is None:
            label = step
        else:
            top = step.select(F.col("node").alias("root"), F.col("root").alias("top"))
            label = materialize(label.join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "labels")
        x, y = (step.select(F.col("node").alias(i), F.col("root").alias(j)) for i, j in (("u", "x"), ("v", "y")))
        left = materialize(between(left.join(x, "u").join(y, "v"), "x", "y"), "edges")
        if not left.limit(1).count():
            return label


def near_duplicates(documents: DataFrame, rows: bool = False) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): doc_id, n_shingles, component_id.

    With ``rows`` also t1 and t2 (two hashes of the text) and root, which only the rows of one component share.
    """
    spark = documents.sparkSession
    arrow_rows(spark)
    texts = documents.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("t1"),
                             F.xxhash64(F.lit(1), "text").alias("t2"))
    classes = spark.sparkContext.broadcast(frequency_classes(documents.select("text")).tobytes())
    docs = texts.withColumn("rid", F.monotonically_increasing_id()).mapInArrow(_prefix_task(classes), DOCS)
    docs = materialize(docs, "prefixes")
    real = docs.where("n > 0")
    sets = real.groupBy("d1", "d2").agg(F.min("rid").alias("sid"), *[F.min(c).alias(c) for c in ("n", "p1", "p2")])
    sets = materialize(sets, "sets")
    groups = sets.groupBy("p1", "p2", "n").agg(F.min("sid").alias("gid"), F.count("*").alias("members"))
    groups = materialize(groups, "groups")
    many = groups.where("members > 1")
    member = materialize(sets.join(many, ["p1", "p2", "n"]).select("gid", "sid"), "members")

    entries = groups.agg(F.sum(F.col("n") * 0.25 + 1)).first()[0] or 0
    bits = max(6, int(np.ceil(np.log2(max(1, entries / RANGE_ENTRIES)))))
    # a set's and a group's first row is posted; the others' ids are few unless most rows are copies
    copies = materialize(real.select("rid").join(groups.select(F.col("gid").alias("rid")), "rid", "left_anti"), "copies")
    posted = real.select("rid", "n", "prefix").join(broadcast_if_small(copies, 64), "rid", "left_anti")
    found = posted.mapInArrow(_post_task(bits), BLOBS).groupBy("part").applyInArrow(_list_pairs, PAIRS)
    found = materialize(found, "candidates")
    group_pairs = found.where("kind = 0").select("a", "b").distinct()
    first = group_pairs.union(member.where("gid < sid").select("gid", "sid"))

    sid_text = sets.select(F.col("sid").alias("rid")).join(real.select("rid", "doc_id", "t1", "t2"), "rid")

    def verified(pairs: DataFrame, name: str, outline: bool = True) -> DataFrame:
        pairs = materialize(pairs, name)
        need = pairs.select(F.explode(F.array("a", "b")).alias("rid")).distinct().join(sid_text, "rid")
        need = materialize(need.select(F.col("rid").alias("sid"), F.col("doc_id").alias("d"), F.col("t1").alias("u1"), F.col("t2").alias("u2")), name + "_need")
        same = F.expr("t1 = u1 and t2 = u2 and doc_id <=> d")
        text = texts.join(broadcast_if_small(need, 200), same).select("sid", "text").dropDuplicates(["sid"])
        known = materialize(text.mapInArrow(_set_task(classes), "sid long, ids binary, outline binary"), name + "_sets")
        rows = arrow_rows(spark, 200)  # two whole sets a row
        for column, test in (("outline", _possible), ("ids", _linked))[not outline:]:
            x, y = (known.select(F.col("sid").alias(i), F.col(column).alias(j)) for i, j in (("a", "x"), ("b", "y")))
            both = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")
            pairs = materialize(both.mapInArrow(_keep_task(test), "a long, b long"), f"{name}_{column}")
        spark.conf.set(ARROW_ROWS, rows)
        return pairs

    links = verified(first, "first")
    root, merged = connected_components(links), None

    # what the stars left open, between sets that are not connected yet
    entry = found.where("kind = 1").select(F.col("a").cast("string").alias("block"), F.col("b").alias("gid"), "r", "before")
    big = member.select("gid").distinct()
    wide = group_pairs.join(big.select(F.col("gid").alias("a")), "a", "left_semi").union(
        group_pairs.join(big.select(F.col("gid").alias("b")), "b", "left_semi").select("a", "b")).distinct()
    wide = wide.select(F.concat_ws("-", F.lit("p"), "a", "b").alias("block"), F.explode(F.array("a", "b")).alias("gid"))
    own = big.select(F.concat(F.lit("g"), "gid").alias("block"), "gid")
    none = [F.lit(None).cast("int").alias("r"), F.lit(None).cast("long").alias("before")]
    entry = entry.union(wide.union(own).select("block", "gid", *none)).join(member, "gid", "left")
    entry = entry.select("block", F.coalesce("sid", "gid").alias("sid"), "r", "before")
    entry = entry.join(root.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    entry = entry.join(sets.select("sid", "n"), "sid").select(
        "block", "sid", "root", "n", F.coalesce("r", "n").alias("r"), F.coalesce("before", -1 - F.col("sid")).alias("before"))
    entry = materialize(entry, "open")
    open_ = entry.groupBy("block").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    open_ = materialize(open_.select("block"), "open_blocks")
    if open_.limit(1).count():
        entry = materialize(entry.join(open_, "block"), "open_entries")
        parity = docs.select(F.col("rid").alias("sid"), *PARITIES).join(broadcast_if_small(materialize(entry.select("sid").distinct(), "open_sets"), 64), "sid")
        # a root's sets in a block; the smaller side of two roots finds the larger side's members
        size = entry.groupBy("block", "root").agg(F.count("*").alias("k"))
        most = size.groupBy("block").agg(F.max(F.struct("k", "root")).alias("most"))
        entry = materialize(entry.join(parity, "sid").join(size, ["block", "root"]).join(most, "block"), "open_parities")
        x, y = (entry.select("block", *[F.col(c).alias(c + i) for c in ("root", "k", "sid", "n", "r", "before", *PARITIES)], *more)
                for i, more in (("1", ["most"]), ("2", [])))
        apart = " + ".join(f"bit_count({c}1 ^ {c}2)" for c in PARITIES)
        rest = x.where("struct(k1, root1) <> most").drop("most").join(broadcast_if_small(y, 400), "block").where(
            "(k1 < k2 or k1 = k2 and root1 < root2) and 7 * least(r1, r2) >= 3 * (n1 + n2) and before1 <> before2"
            f" and 7 * ({apart}) <= n1 + n2").select(F.col("sid1").alias("x"), F.col("sid2").alias("y"))
        rest = rest.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        # mostly within groups of near copies, where outlines tell nothing
        more = verified(rest.join(first, ["a", "b"], "left_anti"), "rest", outline=False)
        u, v = (root.select(F.col("node").alias(i), F.col("root").alias(j)) for i, j in (("a", "u"), ("b", "v")))
        more = more.join(u, "a", "left").join(v, "b", "left").select(F.coalesce("u", "a").alias("a"), F.coalesce("v", "b").alias("b"))
        more = materialize(more.where("a <> b"), "more")
        if more.limit(1).count():
            merged = connected_components(more).select(F.col("node").alias("root"), F.col("root").alias("top"))

    sets = sets.join(root.withColumnRenamed("node", "sid"), "sid", "left").select("d1", "d2", F.coalesce("root", "sid").alias("root"))
    if merged is not None:
        sets = sets.join(merged, "root", "left").select("d1", "d2", F.coalesce("top", "root").alias("root"))
    of_set = real.groupBy("d1", "d2").agg(F.min("doc_id").alias("low")).join(sets, ["d1", "d2"])
    of_set = materialize(of_set, "set_roots")
    least = of_set.groupBy("root").agg(F.min("low").alias("component_id"))
    of_set = materialize(of_set.join(least, "root").select("d1", "d2", "component_id", "root"), "set_components")
    more = ["t1", "t2", "root"] if rows else []
    out = docs.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "d1", "d2", *more[:2])
    out = out.join(of_set, ["d1", "d2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    return out.select("doc_id", "n_shingles", component, *more)
