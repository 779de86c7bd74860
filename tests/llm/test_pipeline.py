"""The whole pipeline against a plain version of each stage, and on an empty table."""

import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from plain import lines, near
from pyspark.sql import functions as F
from test_passages_cut import expected

from tripcast.llm.queries import vocabulary

SF = "/root/testdata/sf0.001"
TOP = 300


def grams(text):
    """N-grams of one to four bytes inside words, a space at each end; capitals of ASCII and Latin-1 letters folded."""
    data = bytearray((text or "").encode())
    for k, b in enumerate(data):
        if 65 <= b <= 90 or (k and data[k - 1] == 0xC3 and 0x80 <= b <= 0x9E and b != 0x97):
            data[k] = b + 32
    count = Counter()
    for word in bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in data).split():
        b = b" " + word + b" "
        for n in range(1, 5):
            for k in range(len(b) - n + 1):
                g = b[k:k + n]
                if g[0] != 32 or g[-1] != 32:
                    count[int.from_bytes(g, "big")] += 1
    return count


def ranked(count):
    return sorted(count, key=lambda g: (-count[g], g))[:TOP]


def languages(rows):
    """(language, score) of each document, learned from those whose crc32 of the id isn't divisible by 5."""
    sums = defaultdict(Counter)
    for i, text, lang in rows:
        if lang is not None and text is not None and zlib.crc32(str(i).encode()) % 5:
            sums[lang].update(grams(text))
    ranks = {x: {g: r for r, g in enumerate(ranked(c))} for x, c in sums.items()}
    out = {}
    for i, text, _ in rows:
        own = ranked(grams(text))
        if not own or not any(c.isalpha() for c in text):
            out[i] = ("und", 0.0)
            continue
        far = {x: sum(abs(r - of[g]) if g in of else TOP for r, g in enumerate(own)) for x, of in ranks.items()}
        best = min(sorted(far), key=far.get)
        out[i] = (best, 1 - far[best] / (TOP * len(own)))
    return out


@pytest.fixture(scope="module")
def table(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]


def test_language_id_is_the_plain_out_of_place_distance(spark, table):
    from tripcast.llm import langid

    odd = [(-1, None, "en"), (-2, "", "en"), (-3, "12 !", "fr"), (-4, "ÉTÉ été À LA plage", None), (-5, "日本", "en"), (-6, "x" * 100000, "en")]
    rows = table + odd
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    profiles = langid.learn(docs.where(~langid.held_out()))
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, profiles).collect()}
    want = languages(rows)
    assert {i: x for i, (x, _) in got.items()} == {i: x for i, (x, _) in want.items()}
    assert all(abs(got[i][1] - want[i][1]) < 1e-12 for i in want)


def test_run_is_the_plain_stages_in_a_row(spark, table):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    found = languages(table)
    rows = [(i, t) for i, t, _ in table if found[i][0] != "und" and found[i][1] >= corpus_pipeline.MIN_SCORE]
    kept = lines(rows)
    rows = [(i, kept[i][2]) for i, _ in rows]
    _, group = near(rows, 80)
    rows = [(i, t) for i, t in rows if group[i] == i]
    cut = expected(rows)
    want = {i: tokenizer.encode(cut[i], add_special_tokens=False).ids + [0] for i, _ in rows}
    got = defaultdict(list)
    for r in corpus_pipeline.run(spark, SF).collect():
        assert r.length & (r.length - 1) == 0 and r.length <= 1024
        got[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    assert {i: [x for _, p in sorted(pieces) for x in p] for i, pieces in got.items()} == want
    assert 100 < len(want) < len(table)


def test_stages_of_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_keep_columns_and_rows_without_ids(spark, table):
    """Nulls in every column, repeated rows and columns that are named like the operators' own."""
    extra = {"score": F.lit(1), "n_lines": F.lit("x"), "lang_pred": F.lit(2), "kept": F.lit(True), "n_words": F.lit(3), "component_id": F.lit(4)}
    rows = table[:60] + table[:3] + [(None, "the cat sat on the mat and the dog lay by the door all day long", "en"), (None, None, None), (7 ** 9, None, None), (7 ** 9, "", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns(extra)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", *extra], name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert all(r.n_lines == "x" and r.kept is True for r in docs.collect())
    assert corpus_pipeline.packing_stage(spark, docs, SF).count() > 0
