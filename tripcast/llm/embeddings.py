"""Operator 7: embedding near-dedup with randomised-rotation binary codes.

Unit vectors are turned by fixed random rotations; the signs after a rotation are a
vector's binary code. For the code x and the turned vector o, <x, q> / <x, o> is an
unbiased estimate of <o, q>; the stored factor <x, o> also gives its confidence bound.
Bits of further rotations form the keys of tables whose number and width follow from
the threshold, the share of pairs that may be missed (``miss``) and the number of
vectors. Inside a bucket the estimate and its bound decide which pairs are recomputed
exactly, in double precision; a pair is counted in the first table that holds it.

Equal vectors are one class with a weight. A bucket over BLOCK classes is cut into
blocks, and each pair of blocks is work of its own.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcast.llm import rounds as R
from tripcast.llm.components import components

BLOCK = 512
GROUP_ROWS = 8192
SURE = 3.0  # deviations of the estimate that its bound allows for
BUCKET = 16  # classes per bucket that the key's width aims at


def plan(threshold: float, classes: int, miss: float) -> tuple[int, int]:
    """Bits per key and number of tables such that a pair at the threshold misses all with a chance below miss."""
    bits = max(4, math.ceil(math.log2(max(2, classes / BUCKET))))
    meet = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log(1 - meet)))


def rotations(dim: int, count: int, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return np.stack([np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(count)])


def units(blobs: list[bytes]) -> np.ndarray:
    v = np.stack([np.frombuffer(b, np.float64) for b in blobs])
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def table_keys(v: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Key of each table, vectors x tables; the first rotation is kept for the codes."""
    dim = v.shape[1]
    turned = rotations(dim, 1 + math.ceil(bits * tables / dim))[1:]
    signs = np.concatenate([(v @ r > 0) for r in turned], axis=1)[:, : bits * tables].reshape(len(v), tables, bits)
    return (signs * (np.int64(1) << np.arange(bits, dtype=np.int64))).sum(axis=2)


def candidates(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i of a, j of b) of unit vectors whose estimates' upper bounds reach the threshold."""
    dim = a.shape[1]
    turn = rotations(dim, 1)[0]
    a, b = a @ turn, b @ turn
    maybe = np.zeros((len(a), len(b)), bool)
    for x, y, flip in ((a, b, False), (b, a, True)):  # x as queries, y by its code
        code = np.where(y > 0, 1.0, -1.0) / math.sqrt(dim)
        factor = (code * y).sum(axis=1)
        bound = SURE * np.sqrt(np.maximum(0, 1 - factor ** 2)) / factor / math.sqrt(max(1, dim - 1))
        upper = x @ code.T / factor + bound >= threshold - 1e-9
        maybe |= upper.T if flip else upper
    return np.nonzero(maybe)


def _forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same vectors as the given ones, at most one per vector."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(left.tolist(), right.tolist(), strict=True):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    nodes = [x for x in parent if root(x) != x]
    return np.array(nodes, np.int64), np.array([root(x) for x in nodes], np.int64)


def near_vectors(vectors: DataFrame, threshold: float = 0.95, miss: float = 1e-3, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per row: the id, ``n_links`` (other rows with cosine >= threshold), ``component_id`` and ``kept``.

    Links are exact, and all that the tables find. Null, empty or zero vectors, and those
    with null or non-finite components, link with nothing; so do vectors of other lengths.
    Rows without id link with nothing, have no component and are kept. Rows that share an
    id are vectors of their own; their component is the smallest id reachable from the row.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.col("id").isNotNull() & F.col("v").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("cls", F.when(good, F.xxhash64("v")))
    classes = R.written(rows.where("cls is not null").groupBy("cls").agg(
        F.first("v").alias("v"), F.count("*").alias("weight"), F.min("id").alias("low")), "classes")
    total = classes.count()
    bits, tables = plan(threshold, total, miss)

    def keys(batches):
        for batch in batches:
            sizes = np.diff(np.asarray(batch.column("v").offsets))
            cls = batch.column("cls").to_numpy()
            for dim in np.unique(sizes):
                mine = np.flatnonzero(sizes == dim)
                blobs = [np.array(batch.column("v")[int(i)].as_py()).tobytes() for i in mine]
                found = table_keys(units(blobs), bits, tables)
                yield pa.record_batch({"dim": pa.array(np.full(found.size, dim, np.int32)), "tbl": pa.array(np.tile(np.arange(tables, dtype=np.int32), len(mine))),
                                       "bucket": pa.array(found.ravel()), "cls": pa.array(np.repeat(cls[mine], tables))})

    bucket = ["dim", "tbl", "bucket"]
    keyed = R.written(classes.select("cls", "v").mapInArrow(keys, "dim int, tbl int, bucket long, cls long"), "keys")
    sizes = keyed.groupBy(*bucket).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.count("*").alias("n")).where("n > 1").drop("n")
    placed = keyed.join(sizes, bucket).withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    work = [*bucket, F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two")]
    placed = placed.select(*work, "own", "cls").withColumn("grp", F.pmod(F.xxhash64(*bucket, "one", "two"), F.lit(max(1, math.ceil(total * tables / GROUP_ROWS)))))
    joined = placed.join(classes.select("cls", "v", "weight"), "cls")

    def compare(table: pa.Table) -> pa.Table:
        cls, weight, own = (table[c].to_numpy() for c in ("cls", "weight", "own"))
        # one work item after the other
        place = np.stack([table[c].to_numpy().astype(np.int64) for c in (*bucket, "one", "two")], axis=1)
        order = np.lexsort(place.T[::-1])
        place = place[order]
        cuts = np.concatenate(([0], np.flatnonzero((place[1:] != place[:-1]).any(axis=1)) + 1, [len(place)]))
        flat = table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        lists = table["v"].combine_chunks()
        starts = np.asarray(lists.offsets) - np.asarray(lists.offsets)[0]
        node, links, a, b = [], [], [], []
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            dim, tbl, _, one, two = (int(x) for x in place[lo])
            mine = order[lo:hi]
            left = mine[own[mine] == one]
            right = mine[own[mine] == two]
            if not len(left) or not len(right) or hi - lo < 2:
                continue
            v = {}
            for name, some in (("l", left), ("r", right)):
                raw = flat[starts[some][:, None] + np.arange(dim)]
                raw = raw / np.abs(raw).max(axis=1, keepdims=True)
                v[name] = raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True))
            i, j = candidates(v["l"], v["r"], threshold)
            once = cls[left[i]] < cls[right[j]] if one == two else np.ones(len(i), bool)
            i, j = i[once], j[once]
            near = np.einsum("ij,ij->i", v["l"][i], v["r"][j]) >= threshold
            i, j = i[near], j[near]
            if not len(i):
                continue
            x, y = cls[left[i]], cls[right[j]]
            tree = _forest(x, y)
            a.append(tree[0])
            b.append(tree[1])
            # counted by the first table that holds the pair
            kl, kr = table_keys(v["l"], bits, tables), table_keys(v["r"], bits, tables)
            first = ~(kl[i, :tbl] == kr[j, :tbl]).any(axis=1)
            for mine_, their in ((left[i], right[j]), (right[j], left[i])):
                who, at = np.unique(cls[mine_[first]], return_inverse=True)
                node.append(who)
                links.append(np.bincount(at, weights=weight[their[first]], minlength=len(who)).astype(np.int64))
        full = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
        node, links, a, b = full(node), full(links), full(a), full(b)
        return pa.table({"a": pa.array(np.concatenate((a, node))), "b": pa.array(np.concatenate((b, np.zeros(len(node), np.int64))), mask=np.arange(len(a) + len(node)) >= len(a)),
                         "n": pa.array(np.concatenate((np.zeros(len(a), np.int64), links)))})

    found = R.written(joined.groupBy("grp").applyInArrow(compare, "a long, b long, n long"), "links")
    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("far")).withColumnRenamed("a", "cls")
    members = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "cls")
    members = classes.select("cls", "low", "weight").join(members, "cls", "left").withColumn("component_id", F.coalesce("component_id", "cls"))
    lows = members.groupBy("component_id").agg(F.min("low").alias("least"))
    about = members.join(lows, "component_id").join(counts, "cls", "left").select("cls", "least", (F.coalesce("far", F.lit(0)) + F.col("weight") - 1).alias("n"))
    out = rows.drop("v").join(about, "cls", "left")
    component = F.coalesce("least", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
