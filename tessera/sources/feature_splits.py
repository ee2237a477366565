"""Large GeoJSON files cut into features by many tasks.

The text reader splits a file at any byte and hands out records that end at a
``}``, so a task sees a run of bytes of which it does not know whether it
starts inside a string, nor how deep. Two scans find out:

1. Every split is summed up for both cases: how many quotes it holds (odd or
   even), how far it rises and how far it falls in the nesting. The sums, one
   row a split, put together give each split's true start.
2. With that, a split cuts out the objects of the ``features`` array that
   begin and end in it, and the piece of a feature that it shares with its
   neighbours. Pieces of one feature meet by the split in which it begins.

The features are written one a line to the shared checkpoint folder, where
Spark's own JSON reader takes them, again in splits. A task holds one batch of
records and the feature that is open.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

_STEP = np.zeros(256, np.int8)
_STEP[[ord("{"), ord("[")]] = 1
_STEP[[ord("}"), ord("]")]] = -1
_FEATURES = re.compile(rb'"features"\s*:\s*$')
#: Bytes before an opening bracket that are looked at for its key.
KEY_BYTES = 256
RISE = "file string, start long, size long, bytes long, quotes int, up0 long, up1 long, low0 long, low1 long"
CUT = "file string, start long, kind string, owner long, inside boolean, text binary"


def _records(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("lineSep", "}").text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                       F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("value"))


def _by_split(batches):
    """(file, start, size, bytes) of runs of records of one split; a task reads its splits one after another."""
    for batch in batches:
        files, starts = batch.column("file").dictionary_encode(), batch.column("start").to_numpy()
        codes = files.indices.to_numpy()
        cuts = np.flatnonzero((np.diff(codes) != 0) | (np.diff(starts) != 0)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
            if hi > lo:
                part = batch.slice(lo, hi - lo)
                data = b"}".join(part.column("value").to_pylist()) + b"}"
                yield part.column("file")[0].as_py(), int(starts[lo]), part.column("size")[0].as_py(), data


def _quotes_and_steps(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Quotes up to each byte that are not escaped, and the rise of each byte outside strings or not."""
    a = np.frombuffer(data, np.uint8)
    quote = a == ord('"')
    slash = a == ord("\\")
    if slash.any():
        place = np.arange(len(a))
        other = np.maximum.accumulate(np.where(slash, -1, place))  # the last byte that is no backslash
        run = np.zeros(len(a), np.int64)
        run[1:] = (place - other)[:-1]
        quote &= run % 2 == 0
    return np.cumsum(quote), _STEP[a]


def _sum_up(batches):
    now, held = None, []

    def row():
        return pa.RecordBatch.from_pylist([dict(zip(("file", "start", "size", "bytes", "quotes", "up0", "up1", "low0", "low1"), held))],
                                          schema=pa.schema([("file", pa.string()), ("start", pa.int64()), ("size", pa.int64()), ("bytes", pa.int64()),
                                                            ("quotes", pa.int32()), *[(c, pa.int64()) for c in ("up0", "up1", "low0", "low1")]]))
    for file, start, size, data in _by_split(batches):
        if (file, start) != now:
            if now:
                yield row()
            now, held = (file, start), [file, start, size, 0, 0, 0, 0, 0, 0]
        quotes, step = _quotes_and_steps(data)
        odd = (quotes + held[4]) % 2
        for case in (0, 1):
            depth = np.cumsum(np.where(odd == case, step, 0))
            held[7 + case] = min(held[7 + case], held[5 + case] + int(depth.min()))
            held[5 + case] += int(depth[-1])
        held[3] += len(data)
        held[4] = (held[4] + int(quotes[-1])) % 2
    if now:
        yield row()


def _starts(rows: list) -> dict:
    """(in a string, depth, split in which the open feature began) of every split's first byte; raises for broken files."""
    out, state = {}, {}
    last: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r["file"], r["start"])):
        odd, depth, owner = state.get(r["file"], (0, 0, -1))
        out[r["file"], r["start"]] = (odd, depth, owner)
        if depth + r[f"low{odd}"] < 3:
            owner = r["start"]  # what is open at its end began here
        state[r["file"]] = ((odd + r["quotes"]) % 2, depth + r[f"up{odd}"], owner)
        last.setdefault(r["file"], [r["size"], 0])[1] += r["bytes"]
    for file, (odd, depth, _) in state.items():
        size, held = last[file]
        missing = held in (size + 1, size - 2)  # no } at the end; a byte order mark is not handed out
        if odd or depth + missing:
            raise ValueError(f"{file}: not a whole JSON object")
    return out


def _cut_out(starts):
    known = starts.value

    def run(batches):
        now = None
        rows: list[tuple] = []

        def flush():
            columns = list(zip(*rows))
            rows.clear()
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], ["file", "start", "kind", "owner", "inside", "text"])

        def close():
            if piece:  # goes on in the next split
                rows.append((*now, "piece", owner, inside, b"".join(piece)))
        for file, start, _, data in _by_split(batches):
            if (file, start) != now:
                if now:
                    close()
                now = (file, start)
                odd, depth, owner = known[now]
                inside, before = None, b""  # whether the open array is that of the features: not known yet
                piece = [b""] if depth > 2 else []
            quotes, step = _quotes_and_steps(data)
            at = np.flatnonzero(np.where((quotes + odd) % 2 == 0, step, 0))
            after = depth + np.cumsum(step[at])
            up = step[at] > 0
            turns = np.flatnonzero((up & (after <= 3)) | (~up & (after <= 2)))
            begin = 0 if piece else None
            for k in turns.tolist():
                p, level = int(at[k]), int(after[k])
                if up[k] and level == 2:
                    key = (before + data[max(0, p - KEY_BYTES):p])[-KEY_BYTES:]
                    inside = data[p:p + 1] == b"[" and bool(_FEATURES.search(key))
                    rows.append((*now, "array", start, inside, None))
                elif up[k] and level == 3:
                    begin, piece, owner = p, [], start
                elif level == 2 and begin is not None:
                    text = b"".join([*piece, data[begin:p + 1]])
                    rows.append((*now, "piece" if owner != start else "whole", owner, inside, text))
                    begin, piece, owner = None, [], start
            if begin is not None:
                piece = [*piece, data[begin:]]
            depth = int(after[-1]) if len(after) else depth
            odd = (odd + int(quotes[-1])) % 2
            before = (before + data[-KEY_BYTES:])[-KEY_BYTES:]
            if rows:
                yield flush()
        if now:
            close()
        if rows:
            yield flush()
    return run


def feature_lines(spark: SparkSession, path: str) -> str:
    """Where the features of the collections under ``path`` lie, one JSON object a line.

    A file that is no whole JSON object or has no ``features`` array raises a
    ValueError that names it; an empty array gives no lines.
    """
    records = _records(spark, path)
    starts = _starts(records.mapInArrow(_sum_up, RISE).collect())  # one row a split
    found = records.mapInArrow(_cut_out(spark.sparkContext.broadcast(starts)), CUT)
    cut = scratch_path(spark, "feature_pieces")
    found.write.parquet(cut)
    found = spark.read.schema(found.schema).parquet(cut)
    # the depth-two containers of a file are a handful: which one is open where a split starts
    arrays: dict[str, list] = {}
    for r in found.where("kind = 'array'").select("file", "start", "inside").collect():
        arrays.setdefault(r["file"], []).append((r["start"], r["inside"]))
    for file in {f for f, _ in starts}:
        if not any(inside for _, inside in arrays.get(file, ())):
            raise ValueError(f"{file}: not a feature collection")
    opened, now = [], {}
    for file, start in sorted(starts):
        opened.append((file, start, now.get(file, False)))
        own = [inside for s, inside in arrays.get(file, ()) if s == start]
        if own:
            now[file] = own[-1]
    opened = spark.createDataFrame(opened, "file string, start long, before boolean")
    found = found.where("kind <> 'array'").join(opened, ["file", "start"]).where(F.coalesce("inside", "before"))
    whole = found.where("kind = 'whole'").select("text")
    pieces = found.where("kind = 'piece'").groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("start", "text"))).alias("p"))
    pieces = pieces.select(F.array_join(F.transform("p", lambda p: p["text"].cast("string")), "").cast("binary").alias("text"))
    lines = whole.unionByName(pieces).select(F.translate(F.col("text").cast("string"), "\n\r", "  ").alias("value"))
    out = scratch_path(spark, "features")
    lines.write.text(out)
    return out
