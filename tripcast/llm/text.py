"""Words, hashes and shingles of whole texts, computed on Arrow buffers with numpy.

A word is a maximal run of characters other than ASCII white space
(``[^\\x20\\x09-\\x0D]+``). UTF-8 keeps ASCII bytes out of longer characters, so
the words can be found byte by byte without decoding. A null text has no word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SLICE_BYTES = 2 << 20  # of text worked on at once; one longer document is one slice

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def _byte_codes() -> np.ndarray:
    """A fixed odd 64-bit code for each byte; white space has 0, so that it adds nothing to a sum."""
    x = (np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95)) ^ U(0xA0761D6478BD642F)
    x = mix(x, x)
    x = x | U(1)
    x[_SPACE] = U(0)
    return x


def mix(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """The name of the ordered pair (a, b): equal pairs have equal names everywhere."""
    with np.errstate(over="ignore"):
        x = a * U(0xFF51AFD7ED558CCD) + b
        x ^= x >> U(32)
        x *= U(0x9E3779B97F4A7C15)
        x ^= x >> U(29)
        x *= U(0xC4CEB9FE1A85EC53)
        x ^= x >> U(32)
    return x


_CODES = _byte_codes()


def _powers(n: int, base: int) -> np.ndarray:
    """The first n powers of the base modulo 2**64; made anew for each slice, as workers stay while other stages run."""
    run = np.full(n, U(base & _MASK), U)
    run[:1] = U(1)
    return np.multiply.accumulate(run)


def release() -> None:
    """Give memory that isn't in use back to the system, as idle workers of earlier stages count beside those at work."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc only
        trim(0)


@dataclass
class Words:
    """Words of a slice of texts: byte range, document (row of the slice) and 64-bit hash of each."""

    data: np.ndarray  # bytes of all texts
    offsets: np.ndarray  # of each text in data, one more than texts
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    hash: np.ndarray

    @property
    def n_docs(self) -> int:
        return len(self.offsets) - 1

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n_docs).astype(np.int64)

    def first(self) -> np.ndarray:
        """Index of each document's first word, one more than documents."""
        return np.concatenate(([0], np.cumsum(self.counts())))

    def kept_text(self, kept: np.ndarray) -> pa.Array:
        """Each document's kept words joined by one space."""
        n, lens = self.n_docs, self.ends - self.starts
        keep = np.zeros(len(self.data) + 1, bool)
        inside = ~_SPACE[self.data]
        keep[:-1][inside] = np.repeat(kept, lens)
        which = np.flatnonzero(kept)
        last = np.ones(len(which), bool)
        if len(which):
            last[:-1] = self.doc[which[1:]] != self.doc[which[:-1]]
        gaps = self.ends[which[~last]]  # white space follows each of these words
        keep[gaps] = True
        data = np.append(self.data, np.uint8(0))
        data[gaps] = 0x20
        sums = np.concatenate(([0], np.cumsum(keep)))
        return pa.LargeStringArray.from_buffers(n, pa.py_buffer(sums[self.offsets].astype(np.int64)),
                                                pa.py_buffer(data[keep].tobytes()))

    def cut_text(self, lost: np.ndarray) -> pa.Array:
        """Each document's bytes without its runs of lost words (and the white space inside a run)."""
        opens, closes = lost.copy(), lost.copy()
        if len(lost):
            follows = lost[1:] & lost[:-1] & (self.doc[1:] == self.doc[:-1])
            opens[1:] &= ~follows
            closes[:-1] &= ~follows
        edge = np.zeros(len(self.data) + 1, np.int8)
        edge[self.starts[opens]] += 1
        edge[self.ends[closes]] -= 1
        keep = np.cumsum(edge, dtype=np.int8)[:-1] == 0
        sums = np.concatenate(([0], np.cumsum(keep)))
        return pa.LargeStringArray.from_buffers(self.n_docs, pa.py_buffer(sums[self.offsets].astype(np.int64)),
                                                pa.py_buffer(self.data[keep].tobytes()))


def as_large(texts: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One LargeBinary array without nulls (a null text is empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], texts.type)
    if pa.types.is_null(texts.type):
        texts = texts.cast(pa.string())
    texts = texts.cast(pa.large_binary())
    return texts.fill_null(b"") if texts.null_count else texts


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a LargeBinary array."""
    _, off, data = texts.buffers()
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64)[texts.offset: texts.offset + n + 1]
    lo, hi = int(offsets[0]), int(offsets[-1])
    found = np.frombuffer(data, np.uint8)[lo:hi] if data is not None and hi > lo else np.zeros(0, np.uint8)
    return found, offsets - lo


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z become a-z; other bytes stay."""
    return data + (((data >= 65) & (data <= 90)).astype(np.uint8) << 5)


def split(texts: pa.Array, lower: bool = False) -> Words:
    data, offsets = raw(texts)
    if lower:
        data = lower_ascii(data)
    inside = ~_SPACE[data]
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True  # a document's end ends its last word
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:-1]
    closes[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    doc = np.searchsorted(offsets, starts, side="right") - 1
    if not len(starts):
        return Words(data, offsets, starts, ends, doc, np.zeros(0, U))
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(_CODES[data] * _powers(n, _BASE), starts) * _powers(n, pow(_BASE, -1, 1 << 64))[starts]
    return Words(data, offsets, starts, ends, doc, mix(sums, (ends - starts).astype(U)))


def slices(table: pa.Table, column: str, size: int = SLICE_BYTES) -> Iterator[tuple[pa.Table, pa.Array]]:
    """Consecutive rows of about size bytes of text with the texts as LargeBinary."""
    texts = table[column]
    if pa.types.is_null(texts.type):
        texts = texts.cast(pa.string())
    # texts become binary slice by slice: of a column with nulls that is a copy
    sizes = pc.binary_length(texts).fill_null(0).to_numpy().astype(np.int64)
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    lo, n = 0, len(texts)
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1))
        yield table.slice(lo, hi - lo), as_large(texts.slice(lo, hi - lo))
        lo = hi
    release()


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Name of the n symbols from each position on (n >= 2), by doubling."""
    out, have = h, 1
    while have < n:
        step = min(have, n - have)
        if len(out) <= step:
            return np.zeros(0, U)
        out = mix(out[:-step], out[step:])
        have += step
    return out
