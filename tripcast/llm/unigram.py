"""Operator 5: SentencePiece encoding and decoding with the unigram rule.

A text gets a leading space, spaces become the marker U+2581, and the segmentation
with the highest sum of piece scores is found by Viterbi over a double-array trie of
the pieces. A character that no piece covers costs the lowest score less a penalty and
becomes byte pieces. No piece holds a marker after another character, so the best
segmentation of a text is that of its parts from marker to marker; each distinct part
of a slice of texts is solved once, all parts of like length together.
"""

from __future__ import annotations

import pickle
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcast.llm.text import slices

MARK = "▁"
PENALTY = 10.0  # of an uncovered character, below the lowest score (fixed value of the format)
SLICE = 2 << 20


def load_pieces(path: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Pieces of a SentencePiece model file, their log scores, and the ids of byte pieces <0x00>..<0xFF>.

    A BPE file holds merge ranks instead of log scores (0, -1, -2, ...); Zipf's law turns
    rank r into the log probability -ln(r + 1). Pieces that are control symbols, unknown or
    bytes have no score (NaN) and are never matched in a text.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(n)]
    plain = np.array([not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)) for i in range(n)])
    scores = np.array([model.get_score(i) for i in range(n)], np.float64)
    ranks = -scores[plain]
    if len(ranks) and (ranks == np.floor(ranks)).all() and ranks.max() > 1000:  # merge ranks
        scores = -np.log(np.maximum(np.minimum(-scores, n), 0) + 1)
    scores[~plain] = np.nan
    place = {p: i for i, p in enumerate(pieces)}
    return pieces, scores, np.array([place[f"<0x{b:02X}>"] for b in range(256)], np.int64)


@dataclass
class Trie:
    """Double array over dense character codes: child c of s is base[s] + c if check of that is s; value: piece id or -1."""

    chars: np.ndarray  # sorted code points; code = index + 1
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray
    depth: int

    def codes(self, points: np.ndarray) -> np.ndarray:
        """Dense codes of code points; a character that no piece holds has 0."""
        at = np.minimum(np.searchsorted(self.chars, points), len(self.chars) - 1)
        return np.where(self.chars[at] == points, at + 1, 0).astype(np.int32)


def build_trie(pieces: list[str], use: np.ndarray) -> Trie:
    chars = np.array(sorted({ord(c) for p, u in zip(pieces, use, strict=True) if u for c in p}), np.uint32)
    code = {chr(c): i + 1 for i, c in enumerate(chars.tolist())}
    children: list[dict[int, int]] = [{}]
    value = [-1]
    for i, p in enumerate(pieces):
        if use[i] and p:
            node = 0
            for c in p:
                nxt = children[node].get(code[c])
                if nxt is None:
                    nxt = children[node][code[c]] = len(children)
                    children.append({})
                    value.append(-1)
                node = nxt
            value[node] = i
    kids = [np.array(sorted(c), np.int64) for c in children]
    size = 2 * (len(children) + len(chars)) + 2
    used = np.zeros(size, bool)
    used[0] = True
    place, low = {}, 1
    # wide nodes first: they need a free stretch; nodes with one child fill the gaps in the end
    for node in sorted((k for k in range(len(kids)) if len(kids[k]) > 1), key=lambda k: -len(kids[k])):
        own, start = kids[node], low
        while node not in place:
            reach = 64 + (1 << 12) // len(own)
            if start + reach + own[-1] >= len(used):
                used = np.concatenate((used, np.zeros(start + reach + int(own[-1]) + size, bool)))
            free = np.flatnonzero(~used[start: start + reach]) + start - own[0]
            fits = free[~used[free[:, None] + own].any(axis=1)] if len(free) else free
            if len(fits):
                place[node] = int(fits[0])
                used[place[node] + own] = True
            start += reach
        while used[low]:
            low += 1
    single = [k for k in range(len(kids)) if len(kids[k]) == 1]
    used = np.concatenate((used, np.zeros(len(single), bool)))
    for node, cell in zip(single, np.flatnonzero(~used)[: len(single)].tolist(), strict=True):
        place[node] = cell - int(kids[node][0])
        used[cell] = True
    size = int(np.flatnonzero(used)[-1]) + 1
    base, check, out = np.zeros(size, np.int64), np.full(size, -1, np.int64), np.full(size, -1, np.int64)
    # cells are known now: walk from the root and fill base, check and value
    stack = [(0, 0)]
    while stack:
        node, cell = stack.pop()
        out[cell] = value[node]
        if children[node]:
            base[cell] = place[node]
            for c, child in children[node].items():
                check[place[node] + c] = cell
                stack.append((child, place[node] + c))
    return Trie(chars, base, check, out, max((len(p) for p, u in zip(pieces, use, strict=True) if u), default=0))


class Unigram:
    def __init__(self, path: str):
        self.pieces, self.scores, self.bytes = load_pieces(path)
        use = ~np.isnan(self.scores)
        self.trie = build_trie(self.pieces, use)
        self.unknown = float(np.nanmin(self.scores)) - PENALTY
        if any(MARK in p.lstrip(MARK) for p, u in zip(self.pieces, use, strict=True) if u):
            raise ValueError("a piece holds the space marker after another character")
        plain = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else (p.replace(MARK, " ").encode() if u else b"")
                 for p, u in zip(self.pieces, use, strict=True)]
        self.width = np.array([len(p) for p in plain], np.int64)
        self.at = np.concatenate(([0], np.cumsum(self.width)))
        self.plain = np.frombuffer(b"".join(plain), np.uint8)

    def solve(self, parts: list[str]) -> list[np.ndarray]:
        """Ids of the best segmentation of each part; of equal ones the one whose last pieces are longer."""
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(parts)
        sizes = np.array([len(p) for p in parts], np.int64)
        for low, high in ((0, 8), (8, 16), (16, 32), (32, 128), (128, np.inf)):
            mine = np.flatnonzero((sizes > low) & (sizes <= high))
            step = 1 << 15 if high <= 128 else 1
            for k in range(0, len(mine), step):
                some = mine[k: k + step]
                for i, ids in zip(some, self._batch([parts[i] for i in some]), strict=True):
                    out[i] = ids
        return out

    def _batch(self, parts: list[str]) -> list[np.ndarray]:
        t = self.trie
        n, sizes = len(parts), np.array([len(p) for p in parts])
        width = int(sizes.max())
        points = np.array([ord(c) for p in parts for c in p.ljust(width, "\0")] if width > 4096 else parts,
                          None if width > 4096 else f"U{width}")
        points = points.astype(np.uint32).reshape(n, width) if width > 4096 else points.view(np.uint32).reshape(n, width)
        codes = t.codes(points)
        best = np.full((n, width + 1), -np.inf)
        best[:, 0] = 0
        step = np.zeros((n, width + 1), np.int32)  # length of the last piece; 0: unknown character
        piece = np.full((n, width + 1), -1, np.int64)
        for i in range(width):
            rows = np.flatnonzero(sizes > i)
            start = best[rows, i]
            single = np.zeros(len(rows), bool)
            live, node, d = np.arange(len(rows)), np.zeros(len(rows), np.int64), 0
            while len(live) and d < t.depth and i + d < width:
                c = codes[rows[live], i + d]
                to = t.base[node] + c
                ok = (c > 0) & (to >= 0) & (to < len(t.check))
                ok[ok] = t.check[to[ok]] == node[ok]
                live, node = live[ok], to[ok]
                d += 1
                value = t.value[node]
                hit = value >= 0
                if d == 1:
                    single[live[hit]] = True
                r, v = rows[live[hit]], value[hit]
                total = start[live[hit]] + self.scores[v]
                better = total > best[r, i + d]
                r, v = r[better], v[better]
                best[r, i + d], step[r, i + d], piece[r, i + d] = total[better], d, v
            r = rows[~single]
            total = start[~single] + self.unknown
            better = total > best[r, i + 1]
            best[r[better], i + 1], step[r[better], i + 1], piece[r[better], i + 1] = total[better], 1, -1
        ids = np.full((n, width), -2, np.int64)
        at = sizes.copy()
        while (live := np.flatnonzero(at > 0)).size:
            ids[live, at[live] - 1] = piece[live, at[live]]
            at[live] -= step[live, at[live]]
        out = []
        known = (ids != -1).all(axis=1)
        for k in range(n):
            row = ids[k]
            if known[k]:
                out.append(row[row >= 0])
            else:
                out.append(np.concatenate([self.bytes[list(parts[k][j].encode())] if x == -1 else [x] for j, x in enumerate(row) if x != -2]).astype(np.int64))
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and each text's offset (one more than texts)."""
        lists = pc.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        offsets = np.asarray(lists.offsets) - np.asarray(lists.offsets)[0]
        words, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        empty = np.array([w == "" for w in words], bool)
        # parts start at markers; empty words and markers inside words need the text itself
        odd_word = empty | np.array([MARK in w for w in words], bool)
        odd = np.add.reduceat(np.append(odd_word[code], False).astype(np.int64), offsets[:-1]) > 0 if len(texts) else np.zeros(0, bool)
        extra: dict[str, int] = {}
        plan: list[list[int]] = []
        for i in np.flatnonzero(odd):
            text = texts[int(i)].as_py()
            parts = re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", MARK + text.replace(" ", MARK)) if text else []
            plan.append([extra.setdefault(p, len(extra)) for p in parts])
        need = np.zeros(len(words), bool)
        need[code[~np.repeat(odd, np.diff(offsets))]] = True
        used = np.flatnonzero(need)
        solved = self.solve([MARK + words[i] for i in used] + list(extra))
        flat = np.concatenate(solved) if solved else np.zeros(0, np.int64)
        ends = np.concatenate(([0], np.cumsum([len(s) for s in solved]))).astype(np.int64)
        of = np.zeros(len(words), np.int64)
        of[used] = np.arange(len(used))
        chain, counts, odd_at = [], np.zeros(len(texts), np.int64), dict(zip(np.flatnonzero(odd).tolist(), plan, strict=True))
        if odd_at:
            for i in range(len(texts)):
                part = np.array(odd_at[i], np.int64) + len(used) if i in odd_at else of[code[offsets[i]:offsets[i + 1]]]
                chain.append(part)
                counts[i] = len(part)
            order = np.concatenate(chain) if chain else np.zeros(0, np.int64)
        else:
            order, counts = of[code], np.diff(offsets)
        size = ends[order + 1] - ends[order] if len(order) else np.zeros(0, np.int64)
        total = np.concatenate(([0], np.cumsum(size)))
        take = np.repeat(ends[order] - total[:-1], size) + np.arange(total[-1]) if len(order) else np.zeros(0, np.int64)
        return flat[take], total[np.concatenate(([0], np.cumsum(counts)))]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of the ids: markers become spaces, bytes characters (U+FFFD where they are none); the leading space goes."""
        width = self.width[ids]
        ends = np.concatenate(([0], np.cumsum(width)))
        data = self.plain[np.repeat(self.at[ids] - ends[:-1], width) + np.arange(ends[-1])].tobytes() if len(ids) else b""
        out = []
        for a, b in zip(ends[offsets[:-1]].tolist(), ends[offsets[1:]].tolist(), strict=True):
            text = data[a:b].decode("utf-8", "replace")
            out.append(text[1:] if text.startswith(" ") else text)
        return out


def _mapped(df: DataFrame, model: str, column: str, kind: str, result: str, work) -> DataFrame:
    """df with one more column made by work(unigram, slice of the column).

    The trie is built once, on the driver, and broadcast: its size is that of the vocabulary file.
    """
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    source = f"c{names.index(column)}"
    # pickled here with its class: workers need no copy of this package
    shared = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(Unigram(model)))

    def one(batches):
        unigram = pickle.loads(shared.value)
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for part, values in slices(table, source, SLICE):
                yield from part.append_column("made", work(unigram, part, values)).combine_chunks().to_batches()

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    out = plain.mapInArrow(one, f"{ddl}, made {kind}")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names) if c != result], F.col("made").alias(result))


def encode(docs: DataFrame, model: str, text_col: str = "text", ids_col: str = "piece_ids") -> DataFrame:
    """docs with the ids of each text as a binary of little-endian unsigned 32-bit numbers (an input column of that name is replaced).

    model: path of a SentencePiece file with byte pieces that every executor can read. A
    null or empty text has no id. Rows are encoded each on its own, repeated or not.
    """
    def work(unigram, part, texts):
        ids, at = unigram.encode(texts.cast(pa.large_string()))
        return pa.array([ids[a:b].astype("<u4").tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())

    return _mapped(docs, model, text_col, "binary", ids_col, work)


def decode(docs: DataFrame, model: str, ids_col: str = "piece_ids", text_col: str = "decoded") -> DataFrame:
    """docs with the text of each row of ids (see encode). Ids that are no piece, or control pieces, add nothing; null ids are an empty text.

    Encoding and decoding gives the text back, but for U+2581, which comes back as a space.
    """
    def work(unigram, part, values):
        blobs = [np.frombuffer(v.as_py(), "<u4").astype(np.int64) for v in values]
        blobs = [b[b < len(unigram.pieces)] for b in blobs]
        at = np.concatenate(([0], np.cumsum([len(b) for b in blobs]))).astype(np.int64)
        return pa.array(unigram.decode(np.concatenate(blobs) if blobs else np.zeros(0, np.int64), at), pa.string())

    return _mapped(docs, model, ids_col, "string", text_col, work)
