"""Operator 4: MinHash near-dedup by tensored banding.

Two collections of ``m`` small keys are made per document, each key from ``k``
minhashes; table (i, j) has the pair of key i of the first and key j of the second
collection as its key. So m * m tables cost 2 * m * k minhashes where separate
tables would cost m * m * 2k. m follows from the similarity and the share of links
that the keys may miss (``miss``).

Documents that meet under a key become candidates: in each table with the smallest
document (by id, and in every other table by a scrambled id, so that centres
differ), and in small groups also with their neighbours in order. Every task first
keeps one document per key and compares its others locally, so a key that a third
of all documents hold costs a row per slice of text. Candidates are confirmed on
full shingle sets; sets travel once per pair of document and group of documents.
Equal sets share one more key, so that they always end in one component.

The centres leave out pairs, and that matters only where documents under one key are
still in different components. Then some candidate pair joins two components, since
the candidates of a key connect all its documents. So the documents of components
that candidate pairs connect meet once more, one per set and component, in pairs of
blocks; there those from different components that share a key and whose sizes allow
a link are confirmed, and only links that join components leave the task. So every
pair that a table puts together is linked, or in one component, or known to be unlike.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcast.llm import rounds as R
from tripcast.llm.components import components
from tripcast.llm.text import U, Words, mix, ngrams, slices, split

SHINGLE = 5
PERCENT = 80
SMALL = 8  # members of a key's group that are also compared with their neighbours
HELD = 1 << 20  # keys that a task gathers before it passes them on
FEW = 1 << 21  # rows of two numbers that a join may broadcast; a table is counted first, and shuffled beyond
BLOCK = 256  # documents that are compared with those of another block in one place
PACKED = R.NAMES + ", ids binary, sizes binary, lefts binary, rights binary, owners binary, keys binary"


def table_sides(percent: int, k: int, miss: float) -> int:
    """m such that a pair at the threshold misses every table with a chance below miss."""
    return max(2, math.ceil(math.log(miss / 2) / math.log(1 - (percent / 100) ** k)))


def shingle_sets(words: Words, n: int) -> list[np.ndarray]:
    """Sorted distinct names of each document's n-word shingles; a shorter document is one shingle."""
    first = words.first().tolist()
    grams = ngrams(words.hash, n) if len(words.hash) >= n else np.zeros(0, U)
    none = np.zeros(0, U)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a: b - n + 1]))
        elif b > a:
            name = U(b - a)
            for x in words.hash[a:b]:
                name = mix(np.array([name]), x)[0]
            out.append(np.array([name], U))
        else:
            out.append(none)
    return out


def tensor_keys(sets: list[np.ndarray], m: int, k: int) -> np.ndarray:
    """Key of each table for each (not empty) set, and last the name of the whole set: sets x (m*m + 1)."""
    flat = np.concatenate(sets)
    at = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    seeds = mix(np.arange(1, 4 * m * k + 1, dtype=U), U(0x2545F4914F6CDD1D))
    half = np.zeros((2 * m, len(sets)), U)
    with np.errstate(over="ignore"):
        for f in range(2 * m * k):
            low = np.minimum.reduceat((flat ^ seeds[2 * f]) * (seeds[2 * f + 1] | U(1)), at)
            half[f // k] = mix(half[f // k] + U(f), low)
    same = mix(np.add.reduceat(mix(flat, flat), at), np.array([len(s) for s in sets], U))
    return np.stack([*(mix(half[i], half[m + j] ^ U(i * m + j)) for i in range(m) for j in range(m)), same], axis=1)


_SCRAMBLE = 0x9E3779B97F4A7C15


def _scrambled(ids: np.ndarray, factor: int = _SCRAMBLE) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (ids.astype(np.int64).view(U) * U(factor)).view(np.int64)


def _plain(ids: np.ndarray) -> np.ndarray:
    return _scrambled(ids, pow(_SCRAMBLE, -1, 1 << 64))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = min(len(a), len(b)), max(len(a), len(b))
    if not small or 100 * small < percent * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _pairs_within(names: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star to the first document of each name, and neighbours in order where few share the name."""
    order = np.lexsort((docs, names))
    n, d = names[order], docs[order]
    new = np.concatenate(([True], n[1:] != n[:-1])) if len(n) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    size = np.diff(np.append(at, len(n)))
    few = ~new & (size[run] <= SMALL)
    left = np.concatenate((d[at][run][~new], np.roll(d, 1)[few]))
    right = np.concatenate((d[~new], d[few]))
    differ = left != right
    return left[differ], right[differ]


def _distinct(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.unique(np.stack((np.minimum(left, right), np.maximum(left, right)), axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def _star_pairs(names: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct candidate pairs; names with an odd last bit hold scrambled ids."""
    found = []
    for odd in (0, 1):
        mine = (names & U(1)) == U(odd)
        pair = _pairs_within(names[mine], docs[mine])
        found.append([_plain(x) if odd else x for x in pair])
    return _distinct(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))


def signatures(df: DataFrame, key: str, text: str, n: int, shingle: int, m: int, k: int) -> DataFrame:
    """For each task's texts: packed key rows and candidate pairs, and for each slice ids with set sizes, and keys."""

    def packed(columns: dict) -> pa.RecordBatch:
        many = len(next(iter(columns.values())))
        return pa.record_batch({c: (pa.array(columns[c], pa.binary()) if isinstance(columns[c], list) else columns[c].combine_chunks())
                                if c in columns else pa.nulls(many, t) for c, t in _PACKED_TYPES})

    def met(held: list):
        """What many slices know together: a name and bucket costs a row per task, not per slice."""
        names, docs = (np.concatenate(x) for x in zip(*held, strict=True))
        left, right = _star_pairs(names, docs)
        rows = R.name_rows(0, n, names, None, docs)
        yield packed({c: rows[c] for c in rows.column_names})
        yield packed({"lefts": [left.tobytes()], "rights": [right.tobytes()]})

    def one(batches):
        held, many = [], 0
        odd = np.arange(m * m + 1, dtype=U) & U(1)
        for batch in batches:
            for part, texts in slices(pa.Table.from_batches([batch]), text):
                ids = part[key]
                valid, own = ids.is_valid().to_numpy(), ids.fill_null(0).to_numpy().astype(np.int64)
                sets = shingle_sets(split(texts, lower=True), shingle)
                sizes = np.array([len(s) for s in sets], np.int64)
                use = np.flatnonzero(valid & (sizes > 0))
                keys = tensor_keys([sets[i] for i in use], m, k) if len(use) else np.zeros(0, U)
                if len(use):
                    docs = np.stack([_scrambled(own[use]) if o else own[use] for o in odd], axis=1).ravel()
                    held.append((((keys & ~U(1)) | odd).ravel(), docs))
                    many += len(docs)
                yield packed({"ids": [own.tobytes()], "sizes": [np.where(valid, sizes, -1 - sizes).tobytes()],
                              "owners": [own[use].tobytes()], "keys": [keys.tobytes()]})
                if many >= HELD:
                    yield from met(held)
                    held, many = [], 0
        if held:
            yield from met(held)

    return df.select(key, text).mapInArrow(one, PACKED)


_PACKED_TYPES = [(c, pa.int32() if t == "int" else pa.binary()) for c, t in (x.split() for x in PACKED.split(", "))]


def _meet_pairs(table: pa.Table) -> pa.Table:
    names = np.concatenate([np.frombuffer(b, U) for b in table["names"].to_pylist()])
    docs = np.concatenate([R.unpack(b, np.int64) for b in table["docs"].to_pylist()])
    left, right = _star_pairs(names, docs)
    return pa.table({"a": left, "b": right})


def _unpacked(packed: DataFrame, one: str, two: str, schema: str) -> DataFrame:
    def flat(batches):
        names = [f.split()[0] for f in schema.split(", ")]
        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield pa.record_batch({names[0]: np.frombuffer(x, np.int64), names[1]: np.frombuffer(y, np.int64)})

    return packed.where(f"{one} is not null").select(one, two).mapInArrow(flat, schema)


def confirmed(df: DataFrame, key: str, text: str, pairs: DataFrame, n: int, shingle: int, percent: int) -> DataFrame:
    """The candidate pairs (a, b) whose full sets are similar enough."""

    def sets_of(table: pa.Table, wanted: np.ndarray) -> dict[int, list[np.ndarray]]:
        mask = pa.array(np.isin(table[key].to_numpy(), wanted))
        out: dict[int, list[np.ndarray]] = {}
        for part, texts in slices(table.filter(mask), text):
            for i, s in zip(part[key].to_pylist(), shingle_sets(split(texts, lower=True), shingle), strict=True):
                out.setdefault(i, []).append(s)
        return out

    def answer(table: pa.Table, asked: pa.Table) -> pa.Table:
        to, who = asked["asks"].to_numpy(), asked["a"].to_numpy()
        sets = sets_of(table, who) if len(who) else {}
        rows = [(int(g), int(a), s.tobytes()) for g, a in zip(to, who, strict=True) for s in sets.get(int(a), ())]
        return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.binary()))],
                        names=["to", "a", "found"])

    def confirm(table: pa.Table, told: pa.Table) -> pa.Table:
        a, b = told["a"].to_numpy(), told["b"].to_numpy(zero_copy_only=False)
        is_pair = told["b"].is_valid().to_numpy()
        far: dict[int, list[np.ndarray]] = {}
        for i in np.flatnonzero(~is_pair):
            far.setdefault(int(a[i]), []).append(np.frombuffer(told["found"][int(i)].as_py(), U))
        left, right = a[is_pair].astype(np.int64), b[is_pair].astype(np.int64)
        near = sets_of(table, np.concatenate((left, right))) if len(left) else {}
        ok = np.array([any(similar(x, y, percent) for x in near.get(p) or far.get(p, ()) for y in near.get(q, ()))
                       for p, q in zip(left.tolist(), right.tolist(), strict=True)], bool)
        return pa.table({"a": left[ok], "b": right[ok]})

    placed = pairs.select("a", "b", R.group_of("a", n).alias("asked"), R.group_of("b", n).alias("asks"))
    mine = df.where(F.col(key).isNotNull()).select(key, text, R.group_of(key, n).alias("grp"))
    ask = placed.where("asked <> asks").select("asked", "asks", "a").distinct()
    answers = mine.groupBy("grp").cogroup(ask.groupBy("asked")).applyInArrow(answer, "to int, a long, found binary")
    told = placed.select(F.col("asks").alias("to"), "a", "b", F.lit(None).cast("binary").alias("found")).unionByName(
        answers.withColumn("b", F.lit(None).cast("long")).select("to", "a", "b", "found"))
    return mine.groupBy("grp").cogroup(told.groupBy("to")).applyInArrow(confirm, "a long, b long")


def _keys_of(packed: DataFrame, tables: int) -> DataFrame:
    """node, same (name of its set) and keys of each document with a set."""

    def flat(batches):
        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                keys = np.frombuffer(y, np.int64).reshape(-1, tables + 1)
                yield pa.record_batch({"node": np.frombuffer(x, np.int64), "same": np.ascontiguousarray(keys[:, -1]),
                                       "keys": pa.array([k.tobytes() for k in np.ascontiguousarray(keys[:, :tables])], pa.binary())})

    return packed.where("owners is not null").select("owners", "keys").mapInArrow(flat, "node long, same long, keys binary")


def _few(table: DataFrame) -> DataFrame:
    """A written table of numbers for the small side of a join."""
    return F.broadcast(table) if table.count() <= FEW else table


def late_links(df: DataFrame, packed: DataFrame, pairs: DataFrame, members: DataFrame, tables: int, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) between component ids whose documents share a key, as many as join what such links join.

    df holds the texts (c1) by id (c0). Work is dealt by what the candidate pairs connect, in pairs of blocks.
    """
    comp = _few(members.select("node", F.col("component_id").alias("comp")))
    sides = [_few(members).select(F.col("node").alias(x), F.col("component_id").alias(f"c{x}")) for x in "ab"]
    met = pairs.join(sides[0], "a", "left").join(sides[1], "b", "left").select(
        F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where("a <> b")
    whole = R.written(components(met).toDF("comp", "whole"), "open")
    keyed = _keys_of(packed, tables).join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    classes = R.written(keyed.join(_few(whole), "comp").groupBy("whole", "same", "comp").agg(
        F.min("node").alias("node"), F.any_value("keys").alias("keys")), "classes")
    blocks = classes.groupBy("whole").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = classes.join(blocks, "whole").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select("whole", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "own", "node", "comp", "keys")

    def sets_of(batches):
        for batch in batches:
            for part, texts in slices(pa.Table.from_batches([batch]), "c1"):
                found = [s.tobytes() for s in shingle_sets(split(texts, lower=True), shingle)]
                yield pa.record_batch({"node": part["c0"].combine_chunks(), "found": pa.array(found, pa.binary())})

    mine = df.join(_few(classes.select(F.col("node").alias("c0"))), "c0", "left_semi").select("c0", "c1")
    work = placed.join(mine.mapInArrow(sets_of, "node long, found binary"), "node")

    def settle(table: pa.Table) -> pa.Table:
        one, two = table["one"][0].as_py(), table["two"][0].as_py()
        comp, own = table["comp"].to_numpy(), table["own"].to_numpy()
        keys = np.frombuffer(b"".join(table["keys"].to_pylist()), np.int64).reshape(-1, tables)
        sets = [np.frombuffer(b, U) for b in table["found"].to_pylist()]
        sizes = np.array([len(s) for s in sets])
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        right = np.flatnonzero(own == two)
        a, b = [], []
        for i in np.flatnonzero(own == one).tolist():
            js = right[right > i] if one == two else right
            fits = 100 * np.minimum(sizes[js], sizes[i]) >= percent * np.maximum(sizes[js], sizes[i])
            js = js[(comp[js] != comp[i]) & fits]
            for j in js[(keys[js] == keys[i]).any(axis=1)].tolist():
                x, y = root(int(comp[i])), root(int(comp[j]))
                if x != y and similar(sets[i], sets[j], percent):
                    parent[max(x, y)] = min(x, y)
                    a.append(comp[i])
                    b.append(comp[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return work.groupBy("whole", "one", "two").applyInArrow(settle, "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, k: int = 3, miss: float = 1e-3,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of documents linked by Jaccard similarity >= percent / 100 of their word shingles.

    Words are lower-cased (A-Z). Returns one row per input row: the id (under its
    name), ``n_shingles``, ``component_id`` (smallest id reachable) and ``kept``
    (the id is its component's). Null, empty and wordless texts have an empty set and
    link with nothing; rows without id link with nothing, have no component and are
    kept. Rows sharing an id are one document that is linked if any of its texts is.
    """
    m = table_sides(percent, k, miss)
    n = R.group_count(docs, text_col)
    df = docs.select(F.col(id_col).cast("long").alias("c0"), F.col(text_col).alias("c1"))
    packed = R.written(signatures(df, "c0", "c1", n, shingle, m, k), "minhash")
    pairs = packed.where("names is not null").select("bucket", "names", "docs").groupBy("bucket").applyInArrow(_meet_pairs, "a long, b long")
    pairs = R.written(pairs.unionByName(_unpacked(packed, "lefts", "rights", "a long, b long")).distinct(), "pairs")
    members = R.written(components(confirmed(df, "c0", "c1", pairs, n, shingle, percent)), "members")
    joined = components(late_links(df, packed, pairs, members, m * m, shingle, percent)).toDF("comp", "whole")
    # a size below 0 marks a row without id
    rows = _unpacked(packed, "ids", "sizes", "node long, size long")
    rows = rows.select(F.when(F.col("size") >= 0, F.col("node")).alias("node"),
                       F.when(F.col("size") >= 0, F.col("size")).otherwise(-1 - F.col("size")).alias("n_shingles"))
    rows = rows.join(members, "node", "left").withColumn("comp", F.coalesce("component_id", "node"))
    out = rows.join(joined, "comp", "left").select(
        F.col("node").alias(id_col), "n_shingles", F.coalesce("whole", "comp").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
