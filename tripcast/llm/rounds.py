"""Distributed rounds on names: which document has a name first, and who shares it.

Documents are dealt once, by doc_id, into groups of bounded text. A round takes
names (64-bit content hashes) of every group, each name once per group with its
smallest document, meets them by name, and tells each group, for those of its
names that two or more documents have, the smallest document of all. A name that
a third of all documents hold thus travels once per group, not once per document.
Names travel as packed columns: a row holds one group's names of one bucket.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcast.llm.text import U

GROUP_BYTES = 4 << 20
LEAST_GROUPS = 48
NAMES = "bucket int, grp int, names binary, checks binary, docs binary, many binary"
FIRSTS = "grp int, names binary, firsts binary"


def shared_path(df_or_spark, name: str) -> str:
    """A new path below the folder in spark.checkpoint.dir, which driver and executors share."""
    spark = df_or_spark.sparkSession if isinstance(df_or_spark, DataFrame) else df_or_spark
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{root.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage and survives lost executors."""
    path = shared_path(df, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark, *tables: DataFrame) -> None:
    """Delete tables made by written()."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for table in tables:
        for file in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(file)
            path.getFileSystem(conf).delete(path, True)


def group_of(column: str, n: int) -> F.Column:
    return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")


def group_count(docs: DataFrame, text: str) -> int:
    """Groups for a table: about GROUP_BYTES of text and row overhead each."""
    total, = docs.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 64)).first()
    return max(LEAST_GROUPS, math.ceil((total or 0) / GROUP_BYTES))


def pack(values: np.ndarray) -> bytes:
    """Integers by byte planes, compressed: small numbers and equal high bytes cost little."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def name_rows(grp: int, buckets: int, names: np.ndarray, checks: np.ndarray | None, docs: np.ndarray) -> pa.Table:
    """Rows of NAMES for one group: each (name, check) once with its smallest document, by bucket.

    checks: 32 more bits per name for names whose equality decides the result.
    """
    checks = np.zeros(len(names), np.uint32) if checks is None else checks
    order = np.lexsort((docs, checks, names))
    names, checks, docs = names[order], checks[order], docs[order]
    rows: dict[str, list] = {k: [] for k in ("bucket", "grp", "names", "checks", "docs", "many")}
    if len(names):
        new = np.concatenate(([True], (names[1:] != names[:-1]) | (checks[1:] != checks[:-1])))
        at = np.flatnonzero(new)
        last = docs[np.concatenate((at[1:], [len(names)])) - 1]
        names, checks, docs = names[at], checks[at], docs[at]
        many = (last != docs).astype(np.uint8)
        place = (names >> U(20)) % U(buckets)
        order = np.argsort(place, kind="stable")
        cuts = np.searchsorted(place[order], np.arange(buckets + 1, dtype=U))
        for b in np.flatnonzero(np.diff(cuts)):
            i = order[cuts[b]: cuts[b + 1]]
            for k, v in zip(rows, (int(b), grp, names[i].tobytes(), pack(checks[i]), pack(docs[i]), pack(many[i])), strict=True):
                rows[k].append(v)
    return pa.table([pa.array(rows["bucket"], pa.int32()), pa.array(rows["grp"], pa.int32()),
                     *(pa.array(rows[k], pa.binary()) for k in ("names", "checks", "docs", "many"))], names=list(rows))


def _meet(table: pa.Table) -> pa.Table:
    grps = table["grp"].to_numpy()
    parts = [[np.frombuffer(n, U), unpack(c, np.uint32), unpack(d, np.int64), unpack(m, np.uint8)] for n, c, d, m in
             zip(*(table[k].to_pylist() for k in ("names", "checks", "docs", "many")), strict=True)]
    sizes = np.array([len(p[0]) for p in parts])
    names, checks, docs, many = (np.concatenate(x) for x in zip(*parts, strict=True))
    of = np.repeat(np.arange(len(parts)), sizes)
    order = np.lexsort((checks, names))
    n, c = names[order], checks[order]
    new = np.concatenate(([True], (n[1:] != n[:-1]) | (c[1:] != c[:-1])))
    at, run = np.flatnonzero(new), np.cumsum(new) - 1
    low, high = np.minimum.reduceat(docs[order], at), np.maximum.reduceat(docs[order], at)
    shared = (low != high) | (np.maximum.reduceat(many[order], at) > 0)
    keep = order[shared[run]]
    first = np.empty(len(names), np.int64)
    first[order] = low[run]
    keep = np.sort(keep)  # back to rows, one after the other
    cuts = np.searchsorted(of[keep], np.arange(len(parts) + 1))
    full = np.flatnonzero(np.diff(cuts))
    return pa.table([pa.array(grps[full], pa.int32()),
                     pa.array([names[keep[cuts[i]:cuts[i + 1]]].tobytes() for i in full], pa.binary()),
                     pa.array([pack(first[keep[cuts[i]:cuts[i + 1]]]) for i in full], pa.binary())], names=["grp", "names", "firsts"])


def round_of_names(rows: DataFrame) -> DataFrame:
    """One round: rows of NAMES to rows of FIRSTS (names that two or more documents have)."""
    return rows.groupBy("bucket").applyInArrow(_meet, FIRSTS)


def known(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sorted names and their first documents from a group's rows of FIRSTS."""
    if not table.num_rows:
        return np.zeros(0, U), np.zeros(0, np.int64)
    names = np.concatenate([np.frombuffer(b, U) for b in table["names"].to_pylist()])
    firsts = np.concatenate([unpack(b, np.int64) for b in table["firsts"].to_pylist()])
    order = np.lexsort((firsts, names))
    return names[order], firsts[order]


def look_up(names: np.ndarray, values: np.ndarray, wanted: np.ndarray, absent: int) -> np.ndarray:
    """For each wanted name its value, or absent."""
    if not len(names):
        return np.full(len(wanted), absent, np.int64)
    at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
    return np.where(names[at] == wanted, values[at], absent)
