"""Substring dedup, near-dedup, line dedup and quality rules against plain Python."""

import random

import pytest
from plain import components, line_key, lines, near, quality_base, sha, substrings, words
from shared import docs, rows  # noqa: F401
from pyspark.sql import functions as F

from tripcast.llm import components as C
from tripcast.llm import langid, lines as L, minhash, quality, substring


def test_substring_dedup(docs, rows):
    got = {r.doc_id: (r.n_words, r.n_removed, r.text) for r in substring.substring_dedup(docs).collect()}
    assert got == substrings([r[:2] for r in rows])


def test_substring_dedup_keeps_other_columns_and_rows_without_id(spark):
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(1, text, 7, "a"), (2, "x " + text, 8, "b"), (2, "y  " + text, 9, "c"), (None, text, 1, "d"), (3, None, 2, None)]
    out = substring.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string, n_words int, grp string"))
    assert sorted((r.doc_id or 0, r.text, r.n_words, r.n_removed, r.grp or "") for r in out.collect()) == [
        (0, text, 20, 0, "d"), (1, text, 20, 0, "a"), (2, "x", 21, 20, "b"), (2, "y", 21, 20, "c"), (3, "", 0, 0, "")]


def test_substring_dedup_runs_and_overlaps(spark):
    """Runs of one word and of pairs, cut at every offset: anchors must meet whatever surrounds them."""
    base = ["a"] * 9 + ["b", "b"] + ["c"] * 3 + ["a", "b"] * 10 + ["d"] * 20 + ["e", "e", "f", "f"] * 6
    rows = [(i, " ".join(base[i % 17: i % 17 + 13 + i % 29])) for i in range(60)]
    out = substring.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: (r.n_words, r.n_removed, r.text) for r in out.collect()} == substrings(rows)


@pytest.mark.parametrize("percent", [85, 80])
def test_near_duplicates(docs, rows, percent):
    sizes, group = near([r[:2] for r in rows], percent)
    got = minhash.near_duplicates(docs, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (sizes[i], group[i], group[i] == i) for i in sizes}


def test_near_duplicates_of_one_hot_group(spark):
    """Variants of one text whose neighbours are similar and whose ends are not."""
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(base[i // 3:] + [f"z{j}" for j in range(i // 3)])) for i in range(90)]
    sizes, group = near(rows, 80)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == group


def test_near_duplicates_of_edited_copies(spark):
    """Copies with a few words changed share keys, but many are like few others and unlike every centre."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(240):
        text = list(base if i % 40 == 0 else rows[rng.randrange(len(rows))][1].split())
        for _ in range(rng.randrange(3)):
            text[rng.randrange(len(text))] = f"e{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(text)))
    ids = list(range(240))
    rng.shuffle(ids)
    rows = [(i, text) for i, (_, text) in zip(ids, rows, strict=True)]
    sizes, group = near(rows, 85)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), percent=85).collect()
    assert {r.doc_id: r.component_id for r in got} == group


def test_near_duplicates_without_ids_or_rows(spark):
    rows = [(None, "a b c d e f"), (1, "a b c d e f"), (4, "a b c d e f"), (4, "q r s t u v"), (5, "q r s t u v")]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got) == [(0, 0, True), (1, 1, True), (4, 1, False), (4, 1, False), (5, 1, False)]
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(7, 3), (3, 3), (9, 7), (140, 99), (50, 60), (60, 50)]
    got = {r.node: r.component_id for r in C.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == components({x for p in links for x in p}, links)


def test_line_dedup(docs, rows):
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in L.line_dedup(docs, min_docs=3).collect()}
    assert got == lines([r[:2] for r in rows], 3)


def test_line_dedup_folds_ascii_only_and_counts_documents(spark):
    rows = [(i, f" SAME line\nÉTÉ\nown {i}\nown {i}\nown {i}") for i in range(4)] + [(9, "same LINE\nété\n\n"), (9, "own 0"), (None, "same line")]
    out = L.line_dedup(spark.createDataFrame(rows, "doc_id int, text string").withColumn("n_lines", F.lit("x")), min_docs=4)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_lines, r.n_dropped, r.text) for r in out.collect())
    assert got == sorted([(-1, 1, 1, "")] + [(i, 5, 2, f"own {i}\nown {i}\nown {i}") for i in range(4)] + [(9, 4, 1, "été\n\n"), (9, 1, 0, "own 0")])


def test_line_dedup_of_a_document_of_200000_lines(spark):
    text = "\n".join(f"own {i}" if i % 3 else f"shared {i % 7} " for i in range(200000))
    rows = [(0, text), *((i, "\n".join(f"Shared {k}" for k in range(7))) for i in range(1, 4)), (9, ""), (10, None)]
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in L.line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), min_docs=4).collect()}
    assert got == lines(rows, 4)


def test_line_dedup_of_rows_without_string_ids(spark):
    rows = [(None, f"same\nown {i}") for i in range(12)] + [("x", "same")]
    got = L.line_dedup(spark.createDataFrame(rows, "doc_id string, text string"), min_docs=13).collect()
    assert sorted(r.text for r in got) == sorted(["", *(f"own {i}" for i in range(12))])
    assert L.line_dedup(spark.createDataFrame([], "doc_id string, text string")).collect() == []


def test_fold_is_exact(spark):
    texts = ["Aé", "aé", "AÉ", "aÉ", "Ａ", "ａ", "Σ", "σ", "ς", "İ", "i̇", "Đ", "đ", "𐐀", "𐐨", "Þ", "þ", "ã©", "é"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", L.fold(F.col("t")).alias("f")).collect()
    for a in got:
        for b in got:
            assert (a.f == b.f) == (line_key(a.t) == line_key(b.t)), (a.t, b.t)


def test_quality_base_measures(docs, rows):
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.quality(docs).collect()}
    assert got == {i: quality_base(t) for i, t, _ in rows}


def test_quality_line_rules(spark):
    good = "\n".join(" ".join(f"word{i}x{j}" for j in range(12)) + "." for i in range(9))
    texts = {"clean": good, "menu": "\n".join(f"home{i} | news{i} | about{i} | help{i}" for i in range(9)),
             "marks": " ".join(f"word{i}###" for i in range(40)) + ".", "shout": " ".join(f"WORD{i}!!" for i in range(40)),
             "cookies": "\n".join(f"{i} a{i} b{i} c{i} read our Cookie Policy before you go on." for i in range(9)),
             "mixed": good + "\nhome | news | about | help", "empty": None}
    got = {r.doc_id: r for r in quality.quality(spark.createDataFrame(list(texts.items()), "doc_id string, text string").withColumn("kept", F.lit(1))).collect()}
    assert {k: r.kept for k, r in got.items()} == {"clean": True, "menu": False, "marks": False, "shout": False, "cookies": False, "mixed": True, "empty": False}
    assert got["mixed"].clean_text == good and got["mixed"].text == texts["mixed"]


def test_language_id(docs, rows):
    profiles = langid.learn(docs.where(~langid.held_out()))
    got = {r.doc_id: r for r in langid.identify(docs.withColumn("score", F.lit("x")), profiles).withColumn("held", langid.held_out()).collect()}
    lang = {i: x for i, _, x in rows if 0 <= i < 100000}
    own = [i for i in lang if got[i].held]
    assert own and sum(got[i].lang_pred == lang[i] for i in own) >= 0.95 * len(own)
    for i in (-5, -4, -3, 100004):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_profiles_are_those_of_plain_counting(spark):
    from collections import Counter
    rows = [("en", "The cat, the Cat."), ("en", "a dog"), ("fr", "ÉTÉ été l'eau"), (None, "zzz"), ("fr", None)]
    p = langid.learn(spark.createDataFrame(rows, "lang string, text string"), top=12)
    for lang, texts in (("en", "the cat the cat a dog"), ("fr", "été été l eau")):
        count = Counter()
        for w in texts.split():
            b = b" " + w.encode() + b" "
            for n in range(1, 5):
                count.update(int.from_bytes(b[k:k + n], "big") for k in range(len(b) - n + 1) if b[k:k + n] != b" ")
        best = sorted(count, key=lambda g: (-count[g], g))[:12]
        column = p.ranks[:, p.langs.index(lang)]
        ranked = sorted((r, g) for g, r in zip(p.grams.tolist(), column.tolist()) if r < 12)
        assert [g for _, g in ranked] == best


def test_language_id_without_training(spark):
    p = langid.learn(spark.createDataFrame([(None, "a b")], "lang string, text string"))
    assert langid.identify(spark.createDataFrame([("abc",)], "text string"), p).first().lang_pred == "und"
