"""Operator 3: line-first quality rules.

Each line is judged by itself, by punctuation, navigation and boilerplate rules;
failing lines are removed, and a document that loses too large a part of its words
with them is rejected. A document that fails the base checks (few words, or many
words in repeated five-word windows) is rejected first. One pass, no shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcast.llm.text import mix, ngrams, slices, split

SYMBOLS = b"#*$%&|<>"
TERMINAL = b".!?\"')]:;" + bytes(range(0x80, 0xC0))  # last byte of a line; also of a closing mark beyond ASCII
MARKS = b"!?#*$%&|<>=_~^@{}[]\\/+"
# Fixed phrases of site boilerplate, matched anywhere in a line whatever the case.
BOILERPLATE = ("cookie policy", "privacy policy", "terms of use", "terms of service", "all rights reserved", "javascript",
               "lorem ipsum", "sign up for", "subscribe to our", "click here", "log in to", "powered by", "follow us on")
WINDOW, MIN_WORDS, REPEAT_PERCENT = 5, 10, 20
MARK_PERCENT = 30  # of a line's words: so many marks at least fail the punctuation rule
BAR_PERCENT = 20  # of a line's words that are bare separators fail the navigation rule
OPEN_WORDS = 10  # a line of fewer words may end without a terminal mark
LOSS_PERCENT = 30  # of a document's words lost with failing lines reject it


def _table(marks: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(marks)] = True
    return out


def _features(texts: pa.Array) -> dict[str, np.ndarray]:
    words = split(texts)
    n, data, first = words.n_docs, words.data, words.offsets
    doc, count = words.doc, words.counts()
    per_doc = lambda x, w=None: np.bincount(x, weights=w, minlength=n).astype(np.int64)
    sums = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    chars = sums[words.ends] - sums[words.starts]
    symbol = np.concatenate(([0], np.cumsum(_table(SYMBOLS)[data])))
    # lines: every text has one more line than line feeds
    lists = pc.split_pattern(texts.cast(pa.string()), "\n")
    flat = lists.flatten()
    line_doc = np.repeat(np.arange(n), np.diff(np.asarray(lists.offsets)))
    feeds = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate((first[:-1], feeds + 1)), kind="stable")
    line = np.searchsorted(starts, words.starts, side="right") - 1
    lines = len(starts)
    line_words = np.bincount(line, minlength=lines)
    code = flat.dictionary_encode().indices.to_numpy().astype(np.uint64)
    has = line_words > 0
    _, seen = np.unique(mix(code[has], line_doc[has].astype(np.uint64)), return_index=True)
    dup = np.ones(int(has.sum()), bool)
    dup[seen] = False
    # five-word windows found twice or more in a text
    repeat = np.zeros(len(doc) + 1, np.int64)
    if len(doc) >= WINDOW:
        at = np.flatnonzero(doc[: len(doc) - WINDOW + 1] == doc[WINDOW - 1:])
        name = mix(ngrams(words.hash, WINDOW)[at], doc[at].astype(np.uint64))
        order = np.argsort(name)
        same = name[order][1:] == name[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        np.add.at(repeat, at[twice], 1)
        np.add.at(repeat, at[twice] + WINDOW, -1)
    repeated = np.cumsum(repeat[:-1]) > 0
    # line rules
    marks = np.concatenate(([0], np.cumsum(_table(MARKS)[data])))
    line_marks = np.bincount(line, weights=marks[words.ends] - marks[words.starts], minlength=lines)
    bare = (words.ends - words.starts == 1) & _table(b"|>-*/")[data[words.starts]]
    line_bare = np.bincount(line, weights=bare, minlength=lines)
    final = np.zeros(lines, bool)
    if len(line):
        last = np.flatnonzero(np.append(line[1:] != line[:-1], True))
        final[line[last]] = _table(TERMINAL)[data[words.ends[last] - 1]]
    bad_mark = (100 * line_marks >= MARK_PERCENT * line_words) | (~final & (line_words >= OPEN_WORDS))
    navigation = 100 * line_bare >= BAR_PERCENT * line_words
    boiler = pc.match_substring_regex(flat, "(?i)" + "|".join(BOILERPLATE)).to_numpy(zero_copy_only=False).astype(bool)
    failed = has & (bad_mark | navigation | boiler)
    lost = failed[line]
    kept_line = ~failed
    cleaned = pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], np.cumsum(per_doc(line_doc[kept_line])))), pa.int32()), flat.filter(pa.array(kept_line)))
    out = {"n_words": count, "word_chars": per_doc(doc, chars), "n_symbols": symbol[first[1:]] - symbol[first[:-1]],
           "n_dup_lines": per_doc(line_doc[has][dup]), "n_repeat_words": per_doc(doc[repeated]), "n_lost_words": per_doc(doc[lost])}
    out["base_failed"] = (count < MIN_WORDS) | (100 * out["n_repeat_words"] > REPEAT_PERCENT * count)
    out["kept"] = ~out["base_failed"] & (100 * out["n_lost_words"] <= LOSS_PERCENT * count)
    out["clean_text"] = pc.binary_join(cleaned, "\n")
    return out


def quality(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with the line-first verdict and its measures.

    Adds ``clean_text`` (the lines that passed; lines without a word stay), ``n_words``,
    ``word_chars`` (code points in words), ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``n_lost_words`` (in failing lines), ``base_failed`` and ``kept``;
    input columns of these names are replaced. Null, empty and wordless texts fail the
    base checks. Repeated rows and ids are judged each by itself.
    """
    kinds = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
             "n_lost_words": "long", "base_failed": "boolean", "kept": "boolean", "clean_text": "string"}
    names = docs.columns
    df = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text = f"c{names.index(text_col)}"

    def one(batches):
        for batch in batches:
            for part, texts in slices(pa.Table.from_batches([batch]), text):
                found = _features(texts)
                found["clean_text"] = found["clean_text"].cast(pa.string())
                yield from pa.table([*part.columns, *(pa.array(found[k]) if k != "clean_text" else found[k] for k in kinds)],
                                    names=[*part.column_names, *kinds]).combine_chunks().to_batches()

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    out = df.mapInArrow(one, ddl + ", " + ", ".join(f"{k} {v}" for k, v in kinds.items()))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names) if c not in kinds], *kinds)
