"""Operator 2: packing by power-of-two decomposition.

A document's tokens (with the closing id) are cut into as many whole sequences as
fit and then into the binary parts of the rest, largest first. Every piece has a
power-of-two length and is a sequence of its own: no sequence crosses documents, and
none needs padding. Training draws batches from one bucket (length) at a time, e.g.
from a table written with ``partitionBy("length")``.

Tokenising dominates. A space between two characters that are no white space always
starts a new pre-token, so texts are cut there and each distinct part is merged once
per slice of text. The merges run on the ranks of the given tokenizer file; texts
with other white space are encoded whole. Added tokens of the file (``added``) are
found first; what lies between them is encoded as texts of their own.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcast.llm.text import raw, slices

LENGTH = 1024
SLICE = 2 << 20  # of text encoded at once; its words and ids take many times as much
# Fixed values of byte-level BPE files: the pattern of pre-tokens and the bytes that stand for themselves.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLAIN_BYTES = (*range(33, 127), *range(161, 173), *range(174, 256))


class Encoder:
    """Ids of a byte-level BPE file of the tokenizers library (no special tokens added).

    added: a text's added tokens get their ids, as the file is loaded; else they are ordinary text.
    """

    def __init__(self, path: str, added: bool = False):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = {t["content"] for t in spec.get("added_tokens", ())}
        rest = [b for b in range(256) if b not in PLAIN_BYTES]
        byte_of = {chr(b): b for b in PLAIN_BYTES} | {chr(256 + i): b for i, b in enumerate(rest)}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.bpe = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        self.sizes[list(ranks.values())] = [len(token) for token in ranks]
        known = [t for t in spec.get("added_tokens", ()) if added and t["content"]]
        if odd := [t["content"] for t in known if t.get("single_word") or t.get("lstrip") or t.get("rstrip")]:
            raise ValueError(f"added tokens that depend on their surroundings: {odd}")
        self.added = {t["content"]: t["id"] for t in known}
        # the library looks for tokens that aren't normalized first, and takes the longest at a place
        groups = [sorted((t["content"] for t in known if bool(t.get("normalized")) is n), key=len, reverse=True) for n in (False, True)]
        self.patterns = [re.compile("(" + "|".join(map(re.escape, g)) + ")") for g in groups if g]

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.bpe.encode_ordinary(text), np.uint32)

    def cut(self, text: str) -> list[str | int]:
        """Ids of added tokens and the stretches around them (some empty), in order."""
        parts = [text]
        for pattern in self.patterns:
            parts = [self.added[x] if k % 2 else x for p in parts for k, x in enumerate(pattern.split(p) if isinstance(p, str) else [p])]
        return parts

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and each text's offset in them (one more than texts)."""
        held = np.zeros(len(texts), bool)
        for token in self.added:
            held |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        if not held.any():
            return self.ordinary(texts)
        cuts = [self.cut(t.as_py()) for t in texts.filter(pa.array(held))]
        flat = [x for c in cuts for x in c]
        token = np.array([isinstance(x, int) for x in flat], bool)
        stretches = pa.array([x for x in flat if isinstance(x, str)], texts.type)
        ids, at = self.ordinary(pa.concat_arrays([texts.filter(pa.array(~held)), stretches]))
        # in order: texts as they are, and the stretches and tokens of the others
        pieces = np.ones(len(texts), np.int64)
        pieces[held] = [len(c) for c in cuts]
        mixed, n = np.repeat(held, pieces), int((~held).sum())
        place, size = np.zeros(len(mixed), np.int64), np.ones(len(mixed), np.int64)
        place[~mixed], size[~mixed] = at[:n], np.diff(at)[:n]
        inner, tokens = np.flatnonzero(mixed)[~token], np.flatnonzero(mixed)[token]
        place[inner], size[inner] = at[n:-1], np.diff(at)[n:]
        place[tokens] = len(ids) + np.arange(len(tokens))
        ids = np.concatenate((ids, np.array([x for x in flat if isinstance(x, int)], np.uint32)))
        return _gathered(ids, place, size, np.cumsum(pieces) - pieces)

    def ordinary(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """As batch, for texts without added tokens."""
        n = len(texts)
        lists = pc.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        parts, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        first = np.asarray(lists.offsets)[:-1] - np.asarray(lists.offsets)[0]
        doc = np.repeat(np.arange(n), np.diff(np.asarray(lists.offsets)))
        opens = np.array([p != "" and not p[0].isspace() for p in parts], bool)
        closes = np.array([p != "" and not p[-1].isspace() for p in parts], bool)
        inner = np.ones(len(code), bool)
        inner[first] = False
        cut = inner.copy()
        cut[1:] &= opens[code[1:]] & closes[code[:-1]]
        whole = np.zeros(n, bool)  # texts with a space that isn't a sure cut
        whole[doc[inner & ~cut]] = True
        use = inner & ~whole[doc]
        used = np.unique(code[use])
        # each distinct part with its space, merged in one call; bytes tell where a part ends
        ids = self.whole("".join(" " + parts[i] for i in used)) if len(used) else np.zeros(0, np.uint32)
        ends = np.cumsum(self.sizes[ids])
        _, bounds = raw(coded.dictionary.take(pa.array(used, pa.int64())).cast(pa.large_binary()))
        cuts = np.concatenate(([0], np.searchsorted(ends, bounds[1:] + np.arange(1, len(bounds)), side="left") + 1))
        at, count = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        at[used], count[used] = cuts[:-1], np.diff(cuts)
        heads = [self.whole(t.as_py() if w else parts[code[f]]) for t, w, f in zip(texts, whole, first, strict=True)]
        head_at = len(ids) + np.concatenate(([0], np.cumsum([len(h) for h in heads])))
        ids = np.concatenate([ids, *heads])
        # in order: each text's head, then its parts
        place, size = at[code], np.where(use, count[code], 0)
        place[first], size[first] = head_at[:-1], np.diff(head_at)
        return _gathered(ids, place, size, first)


def _gathered(ids: np.ndarray, place: np.ndarray, size: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ids one after the other, and the offset of each text's first run."""
    total = np.concatenate(([0], np.cumsum(size)))
    take = np.repeat(place - total[:-1], size) + np.arange(total[-1])
    return ids[take], np.concatenate((total[first], total[-1:]))


def lengths(tokens: int, length: int) -> list[int]:
    """The pieces of a document of so many tokens: whole sequences, then the binary parts of the rest."""
    rest = tokens % length
    return [length] * (tokens // length) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, close: int = 0, id_col: str = "doc_id", text_col: str = "text",
         added: bool = False) -> DataFrame:
    """Sequences of power-of-two length, one row each.

    tokenizer: path of a byte-level BPE file that every executor can read. length must
    be a power of two. Returns the id (under its name), ``start`` (ids of the document
    before the piece), ``length`` (also its bucket), ``ids`` (binary, little-endian
    unsigned 32-bit), ``doc_tokens``, ``sequence_id`` (unique) and ``offset`` (0). A null
    or empty text is the closing id alone. Rows that share an id, and rows without one,
    are packed each on its own. Other columns are left out. With added, the added tokens
    of the file have their ids where a text holds them, as the tokenizer is loaded;
    else a text's bytes are ordinary text throughout (``encode_special_tokens``).
    """
    if length < 1 or length & (length - 1):
        raise ValueError("length must be a power of two")

    def one(batches):
        encoder = None
        for batch in batches:
            for part, texts in slices(pa.Table.from_batches([batch]), "c1", SLICE):
                encoder = encoder or Encoder(tokenizer, added)
                ids, at = encoder.batch(texts.cast(pa.large_string()))
                counts = np.diff(at) + 1
                cut = [lengths(int(c), length) for c in counts]
                pieces = np.array([len(c) for c in cut])
                size = np.concatenate([np.array(c, np.int64) for c in cut])
                row = np.repeat(np.arange(len(cut)), pieces)
                ends = np.cumsum(size)
                stream = np.insert(ids, at[1:], np.uint32(close)).astype("<u4")
                start = ends - size - np.concatenate(([0], np.cumsum(counts)[:-1]))[row]
                blobs = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(np.concatenate(([0], ends * 4)).astype(np.int32)), pa.py_buffer(stream.tobytes())])
                yield pa.record_batch([part["c0"].combine_chunks().take(pa.array(row)), pa.array(start), pa.array(size), blobs, pa.array(counts[row])],
                                      names=["c0", "start", "length", "ids", "doc_tokens"])

    df = docs.select(F.col(id_col).alias("c0"), F.col(text_col).alias("c1"))
    kind = df.schema["c0"].dataType.simpleString()
    out = df.mapInArrow(one, f"c0 {kind}, start long, length long, ids binary, doc_tokens long")
    return (out.withColumnRenamed("c0", id_col).withColumn("sequence_id", F.monotonically_increasing_id())
            .withColumn("offset", F.lit(0).cast("long")))
