"""Operator 9: sharding by histogram sort.

Documents are ordered by (hash of the text, id, row). Splitters are found without
moving rows: each round counts, across all partitions, the exact bytes and rows
between candidate keys, and puts new candidates only between the smallest and largest
key of the interval that holds a splitter, until every splitter is within tolerance.
Then each row is sent to its place once. Candidates fall between texts first, so
equal texts share a shard unless they alone outweigh the tolerance.
"""

from __future__ import annotations

import math
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripcast.llm import rounds as R

PROBES = 16
PART_ROWS = 1 << 16
_BITS = 64
_TOP = 1 << 3 * _BITS


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    """24 bytes per row whose byte order is the order by (h unsigned, id signed, row)."""
    out = np.zeros((batch.num_rows, 3), ">u8")
    out[:, 0] = batch.column("h").to_numpy().view(np.uint64)
    out[:, 1] = batch.column("k").to_numpy().view(np.uint64) ^ np.uint64(1 << 63)
    out[:, 2] = batch.column("row").to_numpy().view(np.uint64)
    return np.ascontiguousarray(out).view("S24").ravel()


def _number(key: bytes) -> int:
    return int.from_bytes(key, "big")


def _sorted_keys(keys: list[int]) -> np.ndarray:
    return np.frombuffer(b"".join(k.to_bytes(24, "big") for k in keys), "S24")


def _counted(rows: DataFrame, probes: list[int], open_: list[bool]) -> list:
    """Exact bytes and rows, smallest and largest key between each two probes, for the open intervals."""
    keys, wanted = _sorted_keys(probes), np.array(open_)

    def one(batches):
        for batch in batches:
            key = _keys(batch)
            bin_ = np.searchsorted(keys, key, side="right")  # keys[bin - 1] <= key < keys[bin]
            use = np.flatnonzero(wanted[bin_])
            if not len(use):
                continue
            order = use[np.lexsort((key[use], bin_[use]))]
            at = np.flatnonzero(np.concatenate(([True], np.diff(bin_[order]) > 0)))
            last = np.append(at[1:], len(order)) - 1
            blob = key[order].view(np.uint8).reshape(-1, 24)
            yield pa.record_batch({"bin": pa.array(bin_[order[at]].astype(np.int32)),
                                   "bytes": pa.array(np.add.reduceat(batch.column("size").to_numpy()[order], at)),
                                   "rows": pa.array(np.diff(np.append(at, len(order)))),
                                   "low": pa.array([blob[i].tobytes() for i in at], pa.binary()),
                                   "high": pa.array([blob[i].tobytes() for i in last], pa.binary())})

    return (rows.mapInArrow(one, "bin int, bytes long, rows long, low binary, high binary").groupBy("bin")
            .agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high")).collect())


def _between(low: int, high: int, count: int) -> list[int]:
    """Candidate keys in (low, high], on the first of the three parts in which low and high differ."""
    for part in (2, 1, 0):
        unit = 1 << part * _BITS
        a, b = low // unit, high // unit
        if a != b:
            steps = min(count, b - a)
            return sorted({(a + (b - a) * (i + 1) // steps) * unit for i in range(steps)})
    return []


def splitters(rows: DataFrame, targets: list[int], slack: list[float], total_bytes: int, total_rows: int) -> list[tuple[int, int, int]]:
    """For each target (bytes below it) a key with the exact bytes and rows below it, within its slack or as near as whole rows allow."""
    known = {0: (0, 0), _TOP - 1: (total_bytes, total_rows)}  # key: bytes and rows below
    ends = {0: (0, _TOP - 1)}  # interval by its lower key: smallest and largest key seen, if known
    while True:
        keys = sorted(known)
        below = [known[k][0] for k in keys]
        probe, where = set(), set()
        for target, most in zip(targets, slack, strict=True):
            i = bisect_left(below, target)
            if i and min(below[i] - target, target - below[i - 1]) > most:
                low, high = ends.get(keys[i - 1], (keys[i - 1], keys[i]))
                if low != high and keys[i - 1] not in where:
                    where.add(keys[i - 1])
                    probe |= {k for k in _between(low, high, PROBES) if k not in known}
        if not probe:
            break
        marks = sorted(set(keys) | probe)
        # interval j: marks[j - 1] <= key < marks[j]; open if inside one that is refined
        inside = [False] * (len(marks) + 1)
        for j in range(1, len(marks)):
            inside[j] = keys[bisect_left(keys, marks[j - 1] + 1) - 1] in where
        found = {r.bin: r for r in _counted(rows, marks, inside)}
        for j in range(1, len(marks)):
            if inside[j]:
                r = found.get(j)
                start = known[marks[j - 1]]
                if marks[j] not in known:
                    known[marks[j]] = (start[0] + (r.bytes if r else 0), start[1] + (r.rows if r else 0))
                ends[marks[j - 1]] = (_number(r.low), _number(r.high)) if r else (0, 0)
    out = []
    for target in targets:
        i = bisect_left(below, target)
        i = i - 1 if i and target - below[i - 1] <= below[i] - target else i
        out.append((keys[i], *known[keys[i]]))
    return out


def shard(docs: DataFrame, shards: int = 24, tolerance: float = 0.002, carry: tuple[str, ...] = (),
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's shard and slot; shards hold nearly equal bytes.

    Size is the text's UTF-8 bytes plus 8 (a null text: 8). Returns the id (under its
    name), ``size``, ``text_crc32`` (unsigned; of no byte for null), ``law`` ("bytes"),
    ``shard``, ``slot`` (gapless from 0 in each shard), ``grown_shard`` (null: the law
    promises nothing for another number of shards) and the columns named in carry.
    A shard differs from its even part by at most 2 * tolerance of it or one row. Rows
    that share an id, or have none, are placed each by itself; an empty table gives no row.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = R.written(docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("k"),
        (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("row"), *[F.col(c).alias(f"x{i}") for i, c in enumerate(carry)]), "shard")
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    # every shard is sorted in several parts of bounded size
    inner = max(4, math.ceil(count / (shards * PART_ROWS)))
    parts = shards * inner
    targets = [total * i // parts for i in range(1, parts)]
    slack = [tolerance * total / shards if i % inner == 0 else total / parts / 8 for i in range(1, parts)]
    found = splitters(rows.select("h", "k", "row", "size"), targets, slack, total, count) if count else []
    found = sorted(found)
    keys = _sorted_keys([f[0] for f in found])
    first_row = [0, *(f[2] for f in found)]

    def place(batches):
        for batch in batches:
            part = np.searchsorted(keys, _keys(batch), side="right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part.astype(np.int32))], [*batch.schema.names, "part"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    placed = rows.mapInArrow(place, ddl + ", part int")
    # rows of a shard before each of its parts; as many entries as parts
    before = [first_row[i] - first_row[i - i % inner] for i in range(parts)] if count else [0]
    order = Window.partitionBy("part").orderBy(F.col("h").bitwiseXOR(F.lit(-(1 << 63))), "k", "row")
    starts = spark.createDataFrame([(i, b) for i, b in enumerate(before)], "part int, before long")
    out = placed.withColumn("at", F.row_number().over(order)).join(starts, "part")
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"),
                      F.floor(F.col("part") / inner).cast("int").alias("shard"), (F.col("before") + F.col("at") - 1).alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"), *[F.col(f"x{i}").alias(c) for i, c in enumerate(carry)])
