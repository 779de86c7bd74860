"""Byte-level BPE against the tiktoken library."""

import hashlib
import random

import pytest
from shared import docs, rows  # noqa: F401
from pyspark.sql import functions as F

from tripcast.llm import bytebpe
from tripcast.llm.queries import op13_byte_bpe, vocabulary

RANKS = vocabulary("byte_bpe_50k.tiktoken")
TRICKY = ["a  b", " lead", "trail ", "  ", " ", "a\n b", "a \nb", "it's we'll I'D 's", "x y  z", "\x1c a \x1fb", "<|endoftext|> a", "日本語 テキスト", "é è  \n\n ",
          "a\r\nb 12345 1 2", "\x00 a", "x\u0085y  z​w　 v", "ﬁ Ⅷ ½ ²³", "🙂 🙂🙂 👩‍👩‍👧", "a" * 300, " " * 500 + "x", "ab" * 2000, "\n" * 700, "!?" * 400, "é" * 300]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bytebpe.load_ranks(RANKS), special_tokens={})


def coded(df, **names):
    return bytebpe.decode(bytebpe.encode(df, RANKS, **names), RANKS)


def test_encode_is_the_library_and_decodes(spark, docs, rows, library):
    more = [(200000 + i, t, None) for i, t in enumerate(TRICKY)]
    got = {r.doc_id: r for r in coded(docs.union(spark.createDataFrame(more, docs.schema))).collect()}
    assert len(got) == len(rows) + len(more)
    for i, t, _ in rows + more:
        assert got[i].ids == library.encode_ordinary(t or ""), i
        assert bytes(got[i].decoded) == (t or "").encode()


def test_fold_of_random_words(spark, library):
    rng = random.Random(4)
    pools = ["etaoin", "abcdefghijklmnopqrstuvwxyz", "aab", "éü漢🙂x", "01"]
    words = sorted({"".join(rng.choice(pool) for _ in range(rng.randrange(1, 40))) for pool in pools for _ in range(300)})
    ranks = bytebpe.load_ranks(RANKS)
    table = bytebpe.rank_map(ranks)
    single = {b: bytebpe.token_char(ranks[bytes([b])]) for b in range(256)}
    given = [(w, w.encode().decode("latin-1").translate(single)) for w in words]
    out = spark.createDataFrame(given, "w string, c string").select("w", F.transform(F.array(table), lambda t: bytebpe.merged(F.col("c"), t))[0].alias("tokens"))
    for r in out.collect():
        want = library._encode_single_piece(r.w.encode())
        assert bytebpe.char_ranks(r.tokens).tolist() == want == bytebpe.merged_long(r.w.encode(), ranks), r.w


def test_token_characters_sort_as_ranks_and_skip_surrogates():
    ranks = [0, 255, 0xD6FF, 0xD700, 0xD701, 60000, 200000]
    chars = "".join(map(bytebpe.token_char, ranks))
    assert sorted(chars) == list(chars) and bytebpe.char_ranks(chars).tolist() == ranks


def test_words_of_many_slices(spark, rows, library, monkeypatch):
    monkeypatch.setattr(bytebpe, "SLICE", 20000)
    monkeypatch.setattr(bytebpe, "ENTRIES", 1000)
    few = [(str(i), t, 1) for i, t, _ in rows[:120]]
    got = {r.key: r.ids for r in coded(spark.createDataFrame(few, "key string, body string, ids int").repartition(3), id_col="key", text_col="body").collect()}
    assert got == {i: library.encode_ordinary(t or "") for i, t, _ in few}


def test_repeated_rows_empty_tables_and_odd_ids(spark, library):
    rows = [(1, "the cat", 1), (1, "the cat", 1), (None, "the dog", 1), (2, None, 1), (3, "", 1)]
    got = coded(spark.createDataFrame(rows, "doc_id long, text string, slice int")).collect()
    assert sorted((r.doc_id or 0, r.ids, bytes(r.decoded)) for r in got) == sorted((i or 0, library.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in rows)
    assert coded(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    df = spark.createDataFrame([(None, 1), ([], 2), ([262], 3)], "ids array<int>, decoded int")
    assert [r.decoded and bytes(r.decoded) for r in bytebpe.decode(df, RANKS).collect()] == [None, b"", b" the"]
    with pytest.raises(Exception, match="vocabulary lacks"):
        bytebpe.decode(spark.createDataFrame([([10 ** 6],)], "ids array<int>"), RANKS).collect()


def test_a_very_long_text(spark, library):
    text = "the cat sat on the mat, " * 40000 + "é" * 3000 + " x" * 100000 + "q" * 200000
    assert coded(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().ids == library.encode_ordinary(text)


def test_query(spark, library):
    got = {r.doc_id: tuple(r)[1:] for r in op13_byte_bpe(spark, "/root/testdata/sf0.001").collect()}
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert got == {i: (len(x), sha(" ".join(map(str, x)).encode()), sha((t or "").encode())) for i, t, x in ((i, t, library.encode_ordinary(t or "")) for i, t in table)}
