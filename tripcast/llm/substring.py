"""Operator 1: substring dedup by recompression.

Every document is a sequence of word symbols. Two restricted recompression rounds
name runs of exactly two equal symbols and then pairs (left coin, right coin) of
neighbouring symbols. A name depends on nothing but its content, so all tasks give
one substring the same interior symbols; a phrase spans at most four words, and
whether two phrases meet at a word depends on the three words at either side only.
Hence each window of ``window`` words contains such a meeting point with its whole
six-word context; the smallest context name is the window's anchor. Then Spark
rounds on names (rounds.py) go from high symbols to low ones:

1. the symbol of a whole document (its root) and the anchors: documents whose
   root a smaller document has are copies; anchors that one document alone has
   rule out their windows;
2. windows whose anchor is shared, in documents that are no copies, by their full
   96-bit names: a window is removed if a smaller document has it.

Windows that lie in copies need no row of their own: the first occurrence of a
window is never in a copy.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcast.llm import rounds as R
from tripcast.llm.text import U, Words, mix, ngrams, slices, split

WINDOW = 13
SIDE = 3  # words of context at either side of a meeting point
SPAN = 4  # longest phrase after the two rounds
NONE = U(0xFFFFFFFFFFFFFFFF)
LAST = np.iinfo(np.int64).max


def phrase_starts(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """True where a phrase of the second recompression round starts (per word)."""
    n = len(h)
    start = np.ones(n, bool)
    if n < 2:
        return start
    equal = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    # round 1, runs: a maximal run of exactly two becomes one symbol
    two = equal.copy()
    two[1:] &= ~equal[:-1]
    two[:-1] &= ~equal[1:]
    start[1:] = ~two
    at = np.flatnonzero(start)
    size = np.diff(np.append(at, n))
    symbol = np.where(size == 2, mix(h[at], U(2)), h[at])
    # round 2, pairs: a left symbol joins the right symbol after it
    right = (mix(symbol, U(0x51ED270B)) >> U(63)).astype(bool)
    join = ~right[:-1] & right[1:] & (doc[at[1:]] == doc[at[:-1]])
    start[at[1:][join]] = False
    return start


def window_anchors(h: np.ndarray, doc: np.ndarray, window: int) -> np.ndarray:
    """For each word the anchor of the window that starts there; only for whole windows."""
    count = len(h) - window + 1
    if count <= 0:
        return np.zeros(0, U)
    context = np.full(len(h), NONE, U)
    context[SIDE: len(h) - SIDE + 1] = ngrams(h, 2 * SIDE)
    context[~phrase_starts(h, doc)] = NONE
    width = window - 2 * SIDE + 1
    low, have = context, 1
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    return low[SIDE: SIDE + count]


def _windows(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of whole windows, their documents and their anchors."""
    anchors = window_anchors(words.hash, words.doc, window)
    if not len(anchors):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), anchors
    at = np.flatnonzero(words.doc[: len(anchors)] == words.doc[window - 1:])
    return at, words.doc[at], anchors[at]


def _roots(words: Words) -> np.ndarray:
    first = words.first()
    return np.array([xxhash.xxh3_64_intdigest(words.hash[a:b].tobytes(), seed=b - a)
                     for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)], U)


def _ids(part: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    """Document ids and which rows have one."""
    ids = part[column]
    return ids.fill_null(0).to_numpy().astype(np.int64), ids.is_valid().to_numpy()


def _join(parts: list[np.ndarray], dtype) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def _dealt(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, list[str], int]:
    """docs with columns c0, c1, ... (free of clashes) and the group of each row."""
    names = docs.columns
    n = R.group_count(docs, text_col)
    df = docs.toDF(*[f"c{i}" for i in range(len(names))])
    key, text = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    df = df.withColumn(key, F.col(key).cast("long"))
    return df.withColumn("grp", F.pmod(F.xxhash64(F.coalesce(key, F.xxhash64(text))), F.lit(n)).cast("int")), names, n


def substring_dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                    joined: bool = True) -> DataFrame:
    """Remove each word covered by a window of ``window`` words that also starts in a document with a smaller id.

    Returns docs with the text replaced by the kept words joined by one space, and
    ``n_words`` and ``n_removed`` (long; an input column of such a name is replaced).
    Windows are judged on the input. Null, empty and short texts have no window and
    lose nothing but their white space (null becomes empty). Rows without id are
    neither compared nor changed otherwise. Rows that share an id are judged each on
    its own text and never against each other.

    Without joined only runs of removed words are cut, with the white space inside a
    run: all other bytes stay, and texts that lose no word (null too) stay as they are.
    """
    if window < 2 * SIDE + SPAN:
        raise ValueError(f"window must have at least {2 * SIDE + SPAN} words")
    df, names, n = _dealt(docs, id_col, text_col)
    key, text = f"c{names.index(id_col)}", f"c{names.index(text_col)}"

    def anchors(table: pa.Table) -> pa.Table:
        found, ids = [], []
        for part, texts in slices(table, text):
            words, (own, valid) = split(texts), _ids(part, key)
            at, doc, anchor = _windows(words, window)
            new = np.ones(len(at), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
            new &= valid[doc]
            long = (words.counts() >= window) & valid
            found += [anchor[new], _roots(words)[long]]
            ids += [own[doc[new]], own[long]]
        return R.name_rows(table["grp"][0].as_py(), n, _join(found, U), None, _join(ids, np.int64))

    def candidates(table: pa.Table, told: pa.Table) -> pa.Table:
        shared, firsts = R.known(told)
        found, checks, ids = [], [], []
        for part, texts in slices(table, text) if table.num_rows and len(shared) else ():
            words, (own, valid) = split(texts), _ids(part, key)
            copy = R.look_up(shared, firsts, _roots(words), LAST) < own
            at, doc, anchor = _windows(words, window)
            open_ = valid[doc] & ~copy[doc]
            open_[open_] = R.look_up(shared, firsts, anchor[open_], LAST) != LAST
            at = at[open_]
            name = ngrams(words.hash, window)[at]
            check = mix(ngrams(words.hash ^ U(0x5BD1E995A5A5A5A5), window)[at], U(7)) >> U(32)
            found.append(name)
            checks.append(check.astype(np.uint32))
            ids.append(own[doc[open_]])
        grp = table["grp"][0].as_py() if table.num_rows else 0
        return R.name_rows(grp, n, _join(found, U), _join(checks, np.uint32), _join(ids, np.int64))

    def clean(table: pa.Table, told: pa.Table) -> pa.Table:
        shared, firsts = R.known(told)
        texts_out, total, removed = [], [], []
        for part, texts in slices(table, text):
            words, (own, valid) = split(texts), _ids(part, key)
            cover = np.zeros(len(words.hash) + 1, np.int64)
            if len(shared):
                copy = valid & (words.counts() >= window) & (R.look_up(shared, firsts, _roots(words), LAST) < own)
                at, doc, _ = _windows(words, window)
                gone = copy[doc]
                rest = ~gone & valid[doc]
                at_rest = at[rest]
                gone[rest] = R.look_up(shared, firsts, ngrams(words.hash, window)[at_rest], LAST) < own[doc[rest]]
                np.add.at(cover, at[gone], 1)
                np.add.at(cover, at[gone] + window, -1)
            lost = np.cumsum(cover[:-1]) > 0
            if joined:
                texts_out.append(words.kept_text(~lost))
            else:
                texts_out.append(pc.if_else(part[text].combine_chunks().is_null(), pa.scalar(None, pa.large_string()), words.cut_text(lost)))
            total.append(words.counts())
            removed.append(np.bincount(words.doc[lost], minlength=words.n_docs))
        out = table.drop_columns(["grp"])
        if table.num_rows:
            at = out.schema.get_field_index(text)
            out = out.set_column(at, text, pa.chunked_array(texts_out).cast(out.schema.field(at).type))
        return (out.append_column("words", pa.array(_join(total, np.int64)))
                .append_column("removed", pa.array(_join(removed, np.int64).astype(np.int64))))

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != "grp")

    first = R.round_of_names(df.groupBy("grp").applyInArrow(anchors, R.NAMES))
    second = R.round_of_names(df.groupBy("grp").cogroup(first.groupBy("grp")).applyInArrow(candidates, R.NAMES))
    told = first.unionByName(second)
    out = df.groupBy("grp").cogroup(told.groupBy("grp")).applyInArrow(clean, ddl + ", words long, removed long")
    keep = [c for c in names if c not in ("n_words", "n_removed")]
    return out.select(*[F.col(f"c{names.index(c)}").alias(c) for c in keep],
                      F.col("words").alias("n_words"), F.col("removed").alias("n_removed"))
