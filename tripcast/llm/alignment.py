"""Operator 11: cross-tokenizer alignment by white-space-token anchors.

Both tokenizers encode whole texts. A byte position where tokens of both end, and
where both next tokens start with a space, is an anchor; anchors split a document
into windows, each a tuple of A ids and a tuple of B ids. Equal windows align alike, so
each distinct window of a slice of texts is aligned once: the ends that both sides
share cut it into groups, and each stretch between neighbouring ends of either side
is one link of an A and a B token. Windows are met by 64-bit names and then compared id
by id; a window that differs from its namesake is aligned on its own.

How many documents hold a pair of ids linked is summed by Spark from each slice's
distinct pairs; the sums go back to the slices by a join on the pair, and each slice
adds them up for its documents. A pair that all documents hold costs a row per slice.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcast.llm import rounds as R
from tripcast.llm.packing import Encoder
from tripcast.llm.text import U, mix, raw, slices

MARK = "▁"
SLICE = 4 << 20
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


@dataclass
class Vocabulary:
    """Bytes of each id's token, one after the other."""

    flat: np.ndarray
    start: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> Vocabulary:
        size = np.array([len(t) for t in tokens], np.int64)
        return cls(np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(size) - size, size)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[_runs(self.start[ids], self.size[ids])]


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each run, one run after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


class SpacedBytes:
    """Byte-level BPE ids of a space and the text."""

    def __init__(self, path: str):
        self.encoder = Encoder(path)
        self.vocabulary = Vocabulary.of([self.encoder.bpe.decode_single_token_bytes(i) if n else b"" for i, n in enumerate(self.encoder.sizes.tolist())])

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        # a full stop is a pre-token of its own before a space, so that texts are cut at spaces from the first one on
        ids, at = self.encoder.ordinary(pc.binary_join_element_wise(pa.scalar(".", pa.large_string()), texts, pa.scalar(" ", pa.large_string())))
        keep = np.ones(len(ids), bool)
        keep[at[:-1]] = False
        return ids[keep], at - np.arange(len(at))


def charsmap(model: bytes) -> bytes:
    """The character rules of a SentencePiece model (field 2 of field 3 of the message); empty if it changes no character."""

    def number(data: bytes, at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            at, shift = at + 1, shift + 7
            if data[at - 1] < 128:
                return value, at

    def field(data: bytes, wanted: int) -> bytes:
        at, found = 0, b""
        while at < len(data):
            key, at = number(data, at)
            if key & 7 == 2:
                n, at = number(data, at)
                if key >> 3 == wanted:
                    found = data[at: at + n]
                at += n
            elif key & 7 == 0:
                _, at = number(data, at)
            else:
                at += 8 if key & 7 == 1 else 4
        return found

    return field(field(model, 3), 2)


class Pieces:
    """SentencePiece ids of texts (the model puts a space before them).

    If no piece holds a space after another character and no character is changed, the
    ids of a text are those of its parts from space to space, and each distinct part
    of a batch is encoded once. Texts with spaces side by side or at an end are encoded whole.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        tokens = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.vocabulary = Vocabulary.of(tokens)
        self.cuts = not any(MARK in p.lstrip(MARK) for p in pieces) and not charsmap(self.model.serialized_model_proto())

    def whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = self.model.encode(texts, num_threads=1) if texts else []
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), np.uint32, int(size.sum())), size

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lists = pc.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        parts, code = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        bounds = np.asarray(lists.offsets).astype(np.int64)
        bounds -= bounds[0]
        count = np.diff(bounds)
        odd = np.full(len(texts), not self.cuts)
        if "" in parts:
            odd[np.repeat(np.arange(len(texts)), count)[code == parts.index("")]] = True
        used = np.unique(code[np.repeat(~odd, count)])
        ids, size = self.whole([parts[i] for i in used])
        more, whole = self.whole(texts.filter(pa.array(odd)).to_pylist())
        # runs of ids in order: a text's parts, or the text
        of = np.zeros(len(parts), np.int64)
        of[used] = np.arange(len(used))
        size = np.concatenate((size, whole))
        run = np.where(np.repeat(odd, count), len(used) + np.repeat(np.cumsum(odd) - 1, count), of[code])
        first = np.zeros(len(code), bool)
        first[bounds[:-1]] = True
        run = run[first | np.repeat(~odd, count)]
        ids = np.concatenate((ids, more))
        ends = np.concatenate(([0], np.cumsum(size[run])))
        runs = np.concatenate(([0], np.cumsum(np.where(odd, 1, count))))
        return ids[_runs((np.cumsum(size) - size)[run], size[run])], ends[runs]


@dataclass
class Side:
    """One tokenizer's tokens of a slice: ids, and the position in the bytes of all texts where each ends."""

    ids: np.ndarray
    ends: np.ndarray

    def between(self, at: np.ndarray) -> np.ndarray:
        """Index of the first token that ends after each position."""
        return np.searchsorted(self.ends, at, side="right")


def _verified(data: np.ndarray, offsets: np.ndarray, coded: list[tuple[np.ndarray, np.ndarray]], vocabularies: list[Vocabulary]) -> np.ndarray:
    """Texts whose bytes are those of their tokens on both sides."""
    good = np.ones(len(offsets) - 1, bool)
    for (ids, at), v in zip(coded, vocabularies, strict=True):
        sums = np.concatenate(([0], np.cumsum(v.size[ids])))[at]
        good &= np.diff(sums) == np.diff(offsets)
    for (ids, at), v in zip(coded, vocabularies, strict=True):
        joined = v.joined(ids[np.repeat(good, np.diff(at))])
        at = np.flatnonzero(good)
        size = np.diff(offsets)[at]
        differs = joined != (data if good.all() else data[_runs(offsets[at], size)])
        if differs.any():
            good[at[np.unique(np.searchsorted(np.cumsum(size), np.flatnonzero(differs), side="right"))]] = False
    return good


def _class_of(a: Side, b: Side, at: np.ndarray) -> np.ndarray:
    """For each window (from at[i] to at[i + 1]) the first window with the same ids on both sides."""
    n = len(at) - 1
    name, cuts = np.zeros(n, U), []
    for side in (a, b):
        cut = side.between(at)
        size = np.diff(cut)
        place = np.arange(len(side.ids)) - np.repeat(cut[:-1], size)
        name = mix(name + size.astype(U), np.add.reduceat(mix(side.ids.astype(U), place.astype(U)), cut[:-1]))
        cuts.append((cut[:-1], size))
    _, least, which = np.unique(name, return_index=True, return_inverse=True)
    first, same = least[which], np.ones(n, bool)
    for _, size in cuts:
        same &= size == size[first]
    for (cut, size), side in zip(cuts, (a, b), strict=True):
        met = np.where(same, first, np.arange(n))
        other = _runs(cut[met], size)
        same &= ~np.logical_or.reduceat(side.ids != side.ids[other], cut)
    return np.where(same, first, np.arange(n))


_DIGITS = [f"{i},".encode() for i in range(1 << 16)]
_DECIMAL = Vocabulary.of(_DIGITS)


def _group_texts(a: Side, b: Side, shared: np.ndarray, last: np.ndarray) -> list[str]:
    """Each window's groups as a1,a2|b1;a3|b2: shared has the groups' ends, last marks those that end a window."""
    ga, gb = np.searchsorted(shared, a.ends), np.searchsorted(shared, b.ends)
    at_a = np.arange(len(ga)) + np.searchsorted(gb, ga, side="left")
    at_b = np.arange(len(gb)) + np.searchsorted(ga, gb, side="right")
    ids, mark = np.zeros(len(ga) + len(gb), np.int64), np.full(len(ga) + len(gb), ord(","), np.uint8)
    ids[at_a], ids[at_b] = a.ids, b.ids
    mark[at_a[np.append(ga[1:] != ga[:-1], True)]] = ord("|")
    mark[at_b[np.append(gb[1:] != gb[:-1], True)]] = np.where(last, ord("\n"), ord(";"))
    out = _DECIMAL.joined(ids)
    out[np.cumsum(_DECIMAL.size[ids]) - 1] = mark
    return out.tobytes().decode().split("\n")[:-1]


def _aligned(a: Side, b: Side, data: np.ndarray, offsets: np.ndarray) -> dict:
    """Alignment of a slice's texts: counts and digest of each, its windows' classes, and the links of each class as pairs."""
    ends = [np.zeros(len(data) + 1, bool) for _ in "ab"]
    ends[0][a.ends], ends[1][b.ends] = True, True
    both, either = ends[0] & ends[1], ends[0] | ends[1]
    anchor = both.copy()
    anchor[:-1] &= data == 0x20
    anchor[offsets] = True  # and where a document starts
    at = np.flatnonzero(anchor)
    doc = np.searchsorted(offsets, at[:-1], side="right") - 1
    first = _class_of(a, b, at)
    reps = np.unique(first)
    cls = np.searchsorted(reps, first)
    # the distinct windows, laid one after the other
    size = np.diff(at)[reps]
    close = np.cumsum(size)
    sides = []
    for side in (a, b):
        cut = side.between(at)
        n = np.diff(cut)[reps]
        tokens = _runs(cut[reps], n)
        sides.append(Side(side.ids[tokens], side.ends[tokens] + np.repeat(close - size - at[reps], n)))
    shared = np.intersect1d(sides[0].ends, sides[1].ends, assume_unique=True)
    texts = _group_texts(*sides, shared, np.isin(shared, close))
    union = np.union1d(sides[0].ends, sides[1].ends)
    pair = (sides[0].ids[np.searchsorted(sides[0].ends, union)].astype(np.int64) << 32) | sides[1].ids[np.searchsorted(sides[1].ends, union)]
    pairs, link = np.unique(pair, return_inverse=True)
    links = np.diff(np.concatenate(([0], np.searchsorted(union, close, side="right"))))
    # each document's classes, and in how many documents each pair is
    n = len(reps)
    held, times = np.unique(doc * n + cls, return_counts=True)
    d, c = held // n, held % n
    per = np.unique(np.repeat(d, links[c]) * len(pairs) + link[_runs((np.cumsum(links) - links)[c], links[c])])
    docs = np.bincount(per % len(pairs), minlength=len(pairs))
    sums = [np.concatenate(([0], np.cumsum(x)))[offsets + 1] for x in (*ends, both, either)]
    bounds, order = np.searchsorted(doc, np.arange(len(offsets))), cls.tolist()
    digests = [hashlib.sha256(";".join([texts[i] for i in order[lo:hi]]).encode()).hexdigest() for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    return {"counts": np.stack([np.diff(x) for x in sums], axis=1), "digests": digests, "pairs": pairs, "docs": docs, "links": links,
            "link": link, "d": d, "c": c, "times": times}


def align_slice(texts: pa.Array, a: SpacedBytes, b: Pieces) -> tuple[np.ndarray, dict | None]:
    """Rows (of texts, large strings, none null or empty) that both sides encode faithfully, and their alignment."""
    data, offsets = raw(pc.binary_join_element_wise(pa.scalar(b"", pa.large_binary()), texts.cast(pa.large_binary()), pa.scalar(b" ", pa.large_binary())))
    coded = [a.batch(texts), b.batch(texts)]
    good = _verified(data, offsets, coded, [a.vocabulary, b.vocabulary])
    if not good.all():
        data = data[np.repeat(good, np.diff(offsets))]
        coded = [(ids[np.repeat(good, np.diff(at))], None) for ids, at in coded]
        offsets = np.concatenate(([0], np.cumsum(np.diff(offsets)[good])))
    if not good.any():
        return good, None
    sides = [Side(ids, np.cumsum(v.vocabulary.size[ids])) for (ids, _), v in zip(coded, (a, b), strict=True)]
    return good, _aligned(*sides, data, offsets)


def _sliced(df: DataFrame, kind: str, bytes_file: str, pieces_file: str) -> DataFrame:
    """One row per document with its counts and digest, and one per slice (without a place) with its windows and pairs."""
    schema = (f"slice long, place int, c0 {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "windows array<binary>, pairs binary, docs binary")

    def one(batches):
        coders, number = None, TaskContext.get().partitionId() << 32
        for batch in batches:
            for part, texts in slices(pa.Table.from_batches([batch]), "c1", SLICE):
                coders = coders or (SpacedBytes(bytes_file), Pieces(pieces_file))
                use = np.flatnonzero(np.diff(raw(texts)[1]) > 0)
                good, found = align_slice(texts.take(pa.array(use)).cast(pa.large_string()), *coders) if len(use) else (use, None)
                n, use = len(part), use[good] if len(use) else use
                counts, digests = np.zeros((n, len(COUNTS)), np.int64), np.full(n, "", object)
                more = {}
                if found:
                    counts[use], digests[use] = found["counts"], found["digests"]
                    windows = [R.pack(x.astype(np.uint32)) for x in (use[found["d"]], found["c"], found["times"], found["links"], found["link"])]
                    more = {"slice": pa.array([number], pa.int64()), "windows": pa.array([windows], pa.list_(pa.binary())),
                            "pairs": pa.array([R.pack(found["pairs"])], pa.binary()), "docs": pa.array([R.pack(found["docs"].astype(np.int64))], pa.binary())}
                rows = {"slice": pa.array(np.full(n, number)), "place": pa.array(np.arange(n, dtype=np.int32)), "c0": part["c0"].combine_chunks(),
                        **{c: pa.array(counts[:, i]) for i, c in enumerate(COUNTS)}, "groups_sha256": pa.array(digests, pa.string())}
                types = {"slice": pa.int64(), "place": pa.int32(), "c0": part["c0"].type, **dict.fromkeys(COUNTS, pa.int64()), "groups_sha256": pa.string(),
                         "windows": pa.list_(pa.binary()), "pairs": pa.binary(), "docs": pa.binary()}
                for own in (rows, more):
                    if own:
                        yield pa.record_batch({c: own[c] if c in own else pa.nulls(len(own["slice"]), t) for c, t in types.items()})
                number += 1

    return df.mapInArrow(one, schema)


def _unpacked(found: DataFrame) -> DataFrame:
    """Each slice's distinct pairs: (slice, at, a, b, docs)."""

    def flat(batches):
        for batch in batches:
            for number, pairs, docs in zip(*(batch[c].to_pylist() for c in ("slice", "pairs", "docs")), strict=True):
                pairs, docs = R.unpack(pairs, np.int64), R.unpack(docs, np.int64)
                yield pa.record_batch({"slice": np.full(len(pairs), number), "at": np.arange(len(pairs), dtype=np.int32),
                                       "a": (pairs >> 32).astype(np.int32), "b": (pairs & 0xFFFFFFFF).astype(np.int32), "docs": docs})

    return found.where("pairs is not null").select("slice", "pairs", "docs").mapInArrow(flat, "slice long, at int, a int, b int, docs long")


def align(docs: DataFrame, bytes_file: str, pieces_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token links of two tokenizers over whole texts.

    bytes_file: a byte-level BPE file (A, encodes a space and the text); pieces_file: a
    SentencePiece model (B, puts a space first); every executor can read both. Returns
    per input row the id (under its name), ``n_a``, ``n_b`` (tokens), ``n_groups``,
    ``n_links``, ``n_best`` (links whose pair is in as many documents as any pair of its A
    id), ``count_sum`` (over links, the documents that hold the pair linked) and
    ``groups_sha256``. Null and empty texts, and those that a tokenizer doesn't keep byte
    by byte, have no tokens: zeros and an empty string. Every row is a document of its
    own, also if it shares its id or has none. Other columns are left out.
    """
    df = docs.select(F.col(id_col).alias("c0"), F.col(text_col).alias("c1"))
    kind = df.schema["c0"].dataType.simpleString()
    found = R.written(_sliced(df, kind, bytes_file, pieces_file), "aligned")
    held = _unpacked(found)
    totals = held.groupBy("a", "b").agg(F.sum("docs").alias("total"))
    most = totals.groupBy("a").agg(F.max("total").alias("most"))
    totals = totals.join(most, "a").select("a", "b", "total", (F.col("total") == F.col("most")).alias("best"))
    replies = held.select("slice", "at", "a", "b").join(totals, ["a", "b"]).select("slice", "at", "total", "best")
    columns = ["c0", *COUNTS, "groups_sha256"]

    def finish(rows: pa.Table, told: pa.Table) -> pa.Table:
        blobs = rows.filter(pc.is_valid(rows["windows"]))["windows"].to_pylist()
        rows = rows.filter(pc.is_valid(rows["place"]))
        place = rows["place"].to_numpy()
        best, total = np.zeros(int(place.max()) + 1, np.int64), np.zeros(int(place.max()) + 1, np.int64)
        for blob in blobs:  # one at most
            d, c, times, links, link = (R.unpack(x, np.uint32).astype(np.int64) for x in blob)
            at = told["at"].to_numpy()
            of = np.zeros((2, len(at)), np.int64)
            of[0, at], of[1, at] = told["best"].to_numpy(zero_copy_only=False), told["total"].to_numpy()
            for out, values in zip((best, total), of, strict=True):
                per = np.add.reduceat(values[link], np.cumsum(links) - links)
                np.add.at(out, d, per[c] * times)
        out = rows.select(columns)
        return out.append_column("n_best", pa.array(best[place])).append_column("count_sum", pa.array(total[place]))

    out = found.groupBy("slice").cogroup(replies.groupBy("slice")).applyInArrow(
        finish, f"c0 {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")
    return out.select(F.col("c0").alias(id_col), *COUNTS, "n_best", "count_sum", "groups_sha256")
