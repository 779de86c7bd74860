"""Filter interaction audit against plain replay of every order."""

import re
from itertools import permutations

import numpy as np
from plain import words
from shared import docs, rows  # noqa: F401

from tripcast.llm import survival

LABELS = "doc_id long, quality int, toxic int"


def failing(text, first, i):
    w, text = words(text), text or ""
    return {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": re.search(r"[#$%&*|]", text) is not None, "E": i is not None and first < i}


def replay(rows, labels):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    good, toxic = ({i for i, *x in labels if x[k] == 1 and i is not None} for k in (0, 1))
    out = {}
    for part in {p or "" for _, _, p in rows}:
        mine = [(i, failing(t, first.get(t or ""), i)) for i, t, p in rows if (p or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [i for i, x in left if x[f]]
                left = [(i, x) for i, x in left if not x[f]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), sum(x[f] for _, x in mine) - len(gone),
                                                   sum(x[f] and sum(x.values()) == 1 for _, x in mine), sum(i in good for i in gone), sum(i in toxic for i in gone)]
        for (p, o, s), v in out.items():
            if p == part:
                v.append(shapley[o[s - 1]])
    return out


def found(df):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in df.collect()}


def test_audit_is_the_replay_of_every_order(spark, docs, rows):
    labels = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    labels += [(-5, 1, 1), (-5, 0, 0), (100002, None, 1), (None, 1, 1), (10 ** 9, 1, 1)]
    got = found(survival.audit(docs, spark.createDataFrame(labels, LABELS)))
    assert got == replay(rows, labels) and len(got) == 600 * len({p or "" for _, _, p in rows})


def test_repeated_rows_missing_ids_and_other_columns(spark):
    shout = "A # " + " ".join(f"w{i}" for i in range(200))
    rows = [(1, shout, "en"), (1, shout, "en"), (2, shout, None), (None, shout, "en"), (None, shout, ""), (3, None, "fr"), (4, "", "fr"), (5, "X" * 50000, "en"), (6, "a " * 90000, "en")]
    df = spark.createDataFrame([(*r, 1, "x", 7) for r in rows], "doc_id long, text string, lang string, n int, part string, fails int")
    labels = [(2, 1, 0), (2, 0, 1)]
    assert found(survival.audit(df, spark.createDataFrame(labels, LABELS))) == replay(rows, labels)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert survival.audit(empty, spark.createDataFrame([], LABELS)).collect() == []
    assert len(survival.audit(spark.createDataFrame([(1, "a", None)], empty.schema), spark.createDataFrame([], LABELS)).collect()) == 600


def test_positional_popcount():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 4, 100, 4097):
        w = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        assert survival.positional_popcount(w).tolist() == [int((w >> np.uint32(b) & np.uint32(1)).sum()) for b in range(32)]
