"""Operator 13: byte-level BPE encoding and decoding.

Texts are cut into pre-tokens (words) inside tasks, and each slice of texts keeps its
words as numbers in its own list of distinct words. Slices send these lists by bucket;
a bucket has one row per distinct word, and there Spark's higher-order functions
fold the merges: a word is a string with a character per token, at first one per byte;
every pair of neighbours is looked up in a literal rank map, and each step puts the
token of the leftmost pair of the lowest rank in its place. The ids go back to the slices, which put them in the order of
their texts. A word that all documents hold is merged once and costs a row per slice.

Decoding joins the bytes of the ids, one character per byte, by the same functions.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripcast.llm import rounds as R
from tripcast.llm.alignment import _runs
from tripcast.llm.text import raw, release, slices

SLICE = 6 << 20
CUT_BYTES = 1 << 20  # of texts that are cut into words at once
AT_ONCE = 1 << 18  # runs of numbers that are put together at once
LONG = 48  # bytes of a word beyond which its merges are kept in a heap, as a fold looks all pairs up in each step
ENTRIES = 1 << 18  # word places that a task holds before it sends them back
MAP_BUCKETS = 1 << 16  # of the literal rank map; a lookup reads one of them
FIRST_CHAR = 0x100  # stands for rank 0


def taken(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs of values from start on, one after the other, with memory for the result and a part of the places."""
    ends = np.concatenate(([0], np.cumsum(size)))
    out = np.empty(int(ends[-1]), values.dtype)
    for lo in range(0, len(size), AT_ONCE):
        hi = min(len(size), lo + AT_ONCE)
        out[ends[lo]:ends[hi]] = values[_runs(start[lo:hi], size[lo:hi])]
    return out


def load_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a tiktoken file."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def token_char(rank: int) -> str:
    """The character that stands for a token while its word is merged; characters sort as ranks do."""
    code = FIRST_CHAR + rank
    return chr(code if code < 0xD800 else code + 0x800)  # no surrogates


def char_ranks(chars: str) -> np.ndarray:
    codes = np.frombuffer(chars.encode("utf-32-le"), np.uint32).astype(np.int64)
    return codes - FIRST_CHAR - np.where(codes < 0xD800, 0, 0x800)


def rank_map(ranks: dict[bytes, int]) -> Column:
    """The ranks as a literal: an array of small maps, by the CRC of a pair of token characters, from the pair to the character of both together."""
    buckets: list[dict | None] = [None] * MAP_BUCKETS
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pair = token_char(left) + token_char(right)
                at = zlib.crc32(pair.encode()) % MAP_BUCKETS
                buckets[at] = (buckets[at] or {}) | {pair: token_char(rank)}
    return F.from_json(F.lit(json.dumps(buckets, ensure_ascii=False)), "array<map<string,string>>")


def merged(word: Column, table: Column) -> Column:
    """A word (a string with a token character per byte) by folding ranked merges: a token character per token."""

    def step(state: Column, _: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(1), F.char_length(state) - 1), lambda i: F.substring(state, i, F.lit(2)))
        both = F.transform(pairs, lambda p: F.get(table, (F.crc32(p) % MAP_BUCKETS).cast("int"))[p])

        def join(s: Column, found: Column) -> Column:
            least = F.array_min(found)
            return F.when(least.isNull(), s).otherwise(F.overlay(s, least, F.array_position(found, least).cast("int"), F.lit(2)))

        # an aggregate over one array evaluates it once
        return F.when(F.char_length(state) < 2, state).otherwise(F.aggregate(F.array(both), state, join))

    return F.when(F.char_length(word) < 2, word).otherwise(F.aggregate(F.sequence(F.lit(2), F.char_length(word)), word, step))


def merged_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """As merged, for long words: a heap of pairs by rank and place, and a linked list of pieces."""
    n = len(word)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n))

    def pair(i: int):
        j = after[i]
        rank = ranks.get(word[i:end[j]]) if j < n else None
        return None if rank is None else (rank, i, end[j])

    heap = [p for p in map(pair, range(n)) if p]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= n or end[j] != stop:
            continue
        end[i], after[i], alive[j] = stop, after[j], False
        before[after[j]] = i
        for k in (before[i], i):
            if k >= 0 and (p := pair(k)):
                heapq.heappush(heap, p)
    return [ranks[word[i:end[i]]] for i in range(n) if alive[i]]


OTHER, LETTER, NUMBER, WHITE = range(4)


def _classes() -> np.ndarray:
    """Class of each code point, as the pattern has them."""
    import regex

    points = np.arange(0x110000, dtype=np.uint32)
    every = points[(points < 0xD800) | (points >= 0xE000)].tobytes().decode("utf-32-le")  # no list of characters
    out = np.full(0x110000, OTHER, np.uint8)
    # \s of the library that the pattern is from is the property, without the separators U+001C to U+001F
    for kind, name in ((LETTER, "L"), (NUMBER, "N"), (WHITE, "White_Space")):
        found = regex.findall(rf"\p{{{name}}}+", every)  # runs of code points
        out[np.frombuffer("".join(found).encode("utf-32-le"), np.uint32)] = kind
    return out


class Cutter:
    """Words of texts, the pre-tokens of ``packing.PATTERN``, found for a whole slice at once.

    A word starts where the class of characters changes, and a space goes with what follows.
    Of more white space the last character stands alone (or goes with what follows). An
    apostrophe that starts a word takes the ends of contractions with it.
    """

    def __init__(self):
        self.classes = _classes()

    def starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Byte positions of all words in the texts of these bytes."""
        first = np.flatnonzero((data & 0xC0) != 0x80)  # byte position of each character
        chars = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        n = len(chars)
        kind = np.empty(n + 3, np.uint8)
        kind[:n], kind[n:] = self.classes[chars], OTHER
        opens = np.zeros(n + 3, bool)  # a text, or the end
        opens[np.searchsorted(first, offsets)] = True
        opens[n:] = True
        change = opens.copy()
        change[1:] |= kind[1:] != kind[:-1]
        space = np.zeros(n + 3, bool)
        space[:n] = chars == 0x20
        out = change.copy()
        out[1:] &= opens[1:] | ~space[:-1] | (kind[1:] == WHITE)  # a space goes with what follows
        # the last of several white spaces, unless the text ends with it
        last = np.zeros(n + 3, bool)
        last[:-1] = (kind[:-1] == WHITE) & ~change[:-1] & change[1:] & ~opens[1:]
        out |= last
        at = np.flatnonzero((chars == 0x27) & out[:n])
        if len(at):
            ahead = [np.append(chars, [0, 0, 0])[at + k] for k in (1, 2)]
            one = ~opens[at + 1] & np.isin(ahead[0], [ord(c) for c in "stmd"])
            two = ~opens[at + 1] & ~opens[at + 2] & np.logical_or.reduce([(ahead[0] == ord(x)) & (ahead[1] == ord(y)) for x, y in ("re", "ve", "ll")])
            out[at[one | two] + 1] = False
            out[at[one] + 2] = True
            out[at[two] + 3] = True
        return first[out[:n]]

    def batch(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Distinct words (binary) of LargeBinary texts, all their words as numbers in order, and how many each text has."""
        data, offsets = raw(texts)
        found, lo, n = [np.zeros(0, np.int64)], 0, len(texts)
        while lo < n:  # a few texts at a time, as characters take several times their bytes
            hi = min(n, max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + CUT_BYTES, side="right")) - 1))
            if offsets[hi] > offsets[lo]:
                found.append(self.starts(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]) + offsets[lo])
            lo = hi
        at = np.append(np.concatenate(found), len(data))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)])
        coded = words.dictionary_encode()
        return coded.dictionary, coded.indices.to_numpy(), np.diff(np.searchsorted(at, offsets))


def _squeezed(data: bytes | np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data if isinstance(data, bytes) else data.tobytes())


def _sliced(give):
    """Column-wise rows that give(slice number, ids, words, codes, counts) makes of each slice of texts."""

    def one(batches):
        cutter, number = None, 0
        for batch in batches:
            for part, texts in slices(pa.Table.from_batches([batch]), "c1", SLICE):
                cutter = cutter or Cutter()
                words, codes, counts = cutter.batch(texts)
                data, offsets = raw(words)
                about = f"{TaskContext.get().partitionId()} {number} ".encode() + offsets.tobytes() + data.tobytes()
                # by content too: a slice whose words meet other texts than those they came from finds no answer
                name = int.from_bytes(hashlib.blake2b(about, digest_size=8).digest(), "big", signed=True)
                yield from give(name, part["c0"], words, codes, counts)
                number += 1

    return one


def _listed(buckets: int):
    """A slice's distinct words, by bucket."""

    def give(name, ids, words, codes, counts):
        place = np.array([zlib.crc32(w) % buckets for w in words.to_pylist()], np.int64)
        order = np.argsort(place, kind="stable")
        data, offsets = raw(words.take(pa.array(order)))
        cuts = np.searchsorted(place[order], np.arange(buckets + 1))
        full = np.flatnonzero(np.diff(cuts)).tolist()
        runs = [(cuts[b], cuts[b + 1]) for b in full]
        columns = [[R.pack(order[x:y].astype(np.uint32)) for x, y in runs], [R.pack(np.diff(offsets[x:y + 1]).astype(np.uint32)) for x, y in runs],
                   [_squeezed(data[offsets[x]:offsets[y]]) for x, y in runs]]
        yield pa.record_batch([pa.array(full, pa.int32()), pa.array([name] * len(full), pa.int64()), *(pa.array(c, pa.binary()) for c in columns)],
                              names=["bucket", "slice", "places", "sizes", "words"])

    return give


def _numbered(kind):
    """A slice's texts as numbers of words."""

    def give(name, ids, words, codes, counts):
        ids = ids.combine_chunks()
        keys = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        yield pa.record_batch([pa.array([name], pa.int64()), keys, pa.array([len(words)], pa.int64()),
                               pa.array([R.pack(counts.astype(np.uint32))], pa.binary()), pa.array([R.pack(codes.astype(np.uint32))], pa.binary())],
                              names=["slice", "ids", "n_words", "counts", "codes"])

    return give


def _distinct(ranks_file: str):
    """A bucket's distinct words, as token characters, and the slices and places that hold each; long ones are merged here."""

    def met(table: pa.Table) -> pa.Table:
        sizes = [R.unpack(b, np.uint32).astype(np.int64) for b in table["sizes"].to_pylist()]
        data = b"".join(zstandard.ZstdDecompressor().decompress(b) for b in table["words"].to_pylist())
        offsets = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])
        coded = words.dictionary_encode()
        code = coded.indices.to_numpy()
        order = np.argsort(code, kind="stable")
        cuts = np.searchsorted(code[order], np.arange(len(coded.dictionary) + 1))
        at = np.repeat(table["slice"].to_numpy(), [len(s) for s in sizes])[order]
        places = np.concatenate([R.unpack(b, np.uint32) for b in table["places"].to_pylist()])[order]
        own = [pa.BinaryArray.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * x.itemsize).astype(np.int32)), pa.py_buffer(x.tobytes())])
               for x in (at, places.astype(np.int32))]
        ranks = load_ranks(ranks_file)
        single = {b: token_char(ranks[bytes([b])]) for b in range(256)}
        word, done = [], []
        for w in coded.dictionary.to_pylist():
            done.append("".join(map(token_char, merged_long(w, ranks))) if len(w) > LONG else None)
            word.append(None if len(w) > LONG else w.decode("latin-1").translate(single))
        return pa.table([pa.array(word, pa.string()), pa.array(done, pa.string()), *own], names=["word", "done", "slices", "places"])

    def one(table: pa.Table) -> pa.Table:
        out = met(table)
        release()
        return out

    return one


def _returned(batches):
    """Rows (tokens, slices, places) of words to rows of slices: packed places, numbers of ids, and ids."""
    held, n = [], 0

    def flush():
        counts = np.concatenate([h[0] for h in held])
        ids, at, places = (np.concatenate([h[i] for h in held]) for i in (1, 2, 3))
        of = np.concatenate([h[4] + base for h, base in zip(held, np.cumsum([0] + [len(h[0]) for h in held[:-1]]), strict=True)])
        order = np.argsort(at, kind="stable")
        names, cuts = np.unique(at[order], return_index=True)
        start = np.cumsum(counts) - counts
        columns: list[list[bytes]] = [[], [], []]
        for mine in np.split(order, cuts[1:]):
            word = of[mine]
            for c, x in zip(columns, (places[mine], counts[word], ids[_runs(start[word], counts[word])]), strict=True):
                c.append(R.pack(x.astype(np.uint32)))
        return pa.record_batch([pa.array(names, pa.int64()), *(pa.array(c, pa.binary()) for c in columns)], names=["slice", "places", "sizes", "ids"])

    for batch in batches:
        if not len(batch):
            continue
        at, places = (np.frombuffer(raw(batch[c].cast(pa.large_binary()))[0].tobytes(), t) for c, t in (("slices", np.int64), ("places", np.int32)))
        counts = pc.utf8_length(batch["tokens"]).to_numpy().astype(np.int64)
        ids = char_ranks(raw(batch["tokens"].cast(pa.large_binary()))[0].tobytes().decode())
        uses = pc.binary_length(batch["slices"]).to_numpy().astype(np.int64) // 8
        held.append((counts, ids, at, places, np.repeat(np.arange(len(batch)), uses)))
        n += len(at)
        if n >= ENTRIES:
            yield flush()
            held, n = [], 0
            release()
    if held:
        yield flush()
    held.clear()
    release()


def encode(docs: DataFrame, ranks_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of whole texts: the id column (under its name) and ``ids`` (array of int).

    ranks_file: a tiktoken file that every executor can read, with the pre-tokens of
    ``packing.PATTERN``. Special tokens have no meaning in a text. A null or empty text has no ids. Rows that
    share an id, and rows without one, are encoded each on its own; other columns are
    left out. Raises if texts come in another order when they are read a second time.
    """
    ranks = load_ranks(ranks_file)
    if lost := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"no token for bytes {lost}")
    df = docs.select(F.col(id_col).alias("c0"), F.col(text_col).alias("c1"))
    kind = df.schema["c0"].dataType.simpleString()
    buckets = max(16, R.group_count(df, "c1") // 2)
    listed = df.mapInArrow(_sliced(_listed(buckets)), "bucket int, slice long, places binary, sizes binary, words binary")
    words = listed.groupBy("bucket").applyInArrow(_distinct(ranks_file), "word string, done string, slices binary, places binary")
    tokens = F.get(F.transform(F.array(rank_map(ranks)), lambda table: F.coalesce("done", merged(F.col("word"), table))), F.lit(0))
    told = words.select(tokens.alias("tokens"), "slices", "places").mapInArrow(_returned, "slice long, places binary, sizes binary, ids binary")
    texts = df.mapInArrow(_sliced(_numbered(kind)), f"slice long, ids array<{kind}>, n_words long, counts binary, codes binary")

    def ordered(rows: pa.Table, told: pa.Table) -> pa.Table:
        if not len(rows):
            raise RuntimeError("texts were cut otherwise when they were read again: give them a fixed order, e.g. by writing them first")
        n = rows["n_words"][0].as_py()
        places, sizes, ids = (np.concatenate([np.zeros(0, np.int64), *(R.unpack(b, np.uint32).astype(np.int64) for b in told[c].to_pylist())])
                              for c in ("places", "sizes", "ids"))
        if len(places) != n or len(rows) != 1:
            raise RuntimeError("texts were cut otherwise when they were read again: give them a fixed order, e.g. by writing them first")
        start, size = np.zeros(n, np.int64), np.zeros(n, np.int64)
        start[places], size[places] = np.cumsum(sizes) - sizes, sizes
        codes, counts = (R.unpack(rows[c][0].as_py(), np.uint32).astype(np.int64) for c in ("codes", "counts"))
        flat = taken(ids.astype(np.int32), start[codes], size[codes])
        ends = np.concatenate(([0], np.cumsum(size[codes])))[np.concatenate(([0], np.cumsum(counts)))]
        return pa.table({"c0": rows["ids"].combine_chunks().flatten(), "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))})

    def finish(rows: pa.Table, told: pa.Table) -> pa.Table:
        out = ordered(rows, told)
        release()
        return out

    out = texts.groupBy("slice").cogroup(told.groupBy("slice")).applyInArrow(finish, f"c0 {kind}, ids array<int>")
    return out.withColumnRenamed("c0", id_col)


def decode(coded: DataFrame, ranks_file: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """coded with the bytes of its ids in out_col (binary; a column of this name is replaced).

    Null ids have null bytes. An id that the file lacks, or a null among ids, raises.
    """
    ranks = load_ranks(ranks_file)
    pieces: list[str | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token.decode("latin-1")  # a character per byte
    lacking = F.raise_error(F.lit("an id that the vocabulary lacks")).cast("string")
    table = F.from_json(F.lit(json.dumps(pieces, ensure_ascii=False)), "array<string>")
    joined = F.transform(F.array(table), lambda t: F.array_join(F.transform(F.col(ids_col), lambda i: F.coalesce(F.get(t, i), lacking)), ""))
    return coded.withColumn(out_col, F.encode(F.get(joined, F.lit(0)), "ISO-8859-1"))
