"""The pipeline's substring stage cuts passages out of texts and leaves every other byte."""

import re

import corpus_pipeline
from plain import substrings
from shared import docs, rows  # noqa: F401

PASSAGE = "the cat sat\ton the mat  and the dog\nlay by the door"
TEXTS = [(1, f"{PASSAGE} one"), (2, f"  head\n\n{PASSAGE}\n\ttail  é\n"), (3, f"{PASSAGE}"), (4, f"{PASSAGE}{PASSAGE[3:]}\r\n x"), (5, "a\n\n  b \t c\n"), (6, None), (7, ""),
         (8, " \n"), (9, f"x {PASSAGE} {PASSAGE} y"), (None, f"{PASSAGE}\n z")]


def cut(text, kept):
    """text without the words that aren't kept, and without the white space inside their runs."""
    out, end, gone = "", 0, False
    for m, keep in zip(re.finditer(r"[^\x20\x09-\x0D]+", text), kept, strict=True):
        out += "" if gone and not keep else text[end:m.start()]
        out += m.group() if keep else ""
        end, gone = m.end(), not keep
    return out + text[end:]


def expected(rows, n=13):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - n + 1 if i is not None else 0):
            first[tuple(w[k:k + n])] = min(i, first.get(tuple(w[k:k + n]), i))
    out = {}
    for (i, t), (_, w) in zip(rows, words, strict=True):
        kept = [True] * len(w)
        for k in range(len(w) - n + 1 if i is not None else 0):
            if first[tuple(w[k:k + n])] < i:
                kept[k:k + n] = [False] * n
        out[i] = t if t is None else cut(t, kept)
    return out


def test_stage_cuts_passages_only(spark):
    table = spark.createDataFrame(TEXTS, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.text for r in corpus_pipeline.substring_stage(spark, table, "").collect()}
    want = expected(TEXTS)
    assert got == want
    assert got[2] == "  head\n\n\n\ttail  é\n" and got[3] == "" and got[5] == TEXTS[4][1] and got[6] is None and got[None] == TEXTS[9][1]


def test_stage_over_the_table(spark, docs, rows):
    got = {r.doc_id: r.text for r in corpus_pipeline.substring_stage(spark, docs, "").collect()}
    plain = [(i, t) for i, t, _ in rows]
    assert got == expected(plain)
    lost = {i: n for i, (_, n, _) in substrings(plain).items()}
    assert all(got[i] == t for i, t in plain if not lost[i]) and any(lost.values())
