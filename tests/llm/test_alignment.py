"""Cross-tokenizer alignment against plain loops over the libraries' tokens."""

import hashlib
import json
from collections import Counter, defaultdict

import pytest
from shared import docs, rows  # noqa: F401

from tripcast.llm import alignment
from tripcast.llm.packing import PLAIN_BYTES
from tripcast.llm.queries import vocabulary

BPE, PIECES = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
TRICKY = ["a  b", " lead", "trail ", "  ", " ", "a\n b", "a \nb", "it's we'll I'D", "x y  z", "\x1c a \x1fb", "<|endoftext|> a", "</s> <s> <unk>", "日本語 テキスト", "é è  \n\n ",
          "a\r\nb 12345 1 2", "kept▁mark", "▁", "\x00 a", "<0x41> A", "é ́x", "ﬁ   　a", "🙂 🙂🙂"]


@pytest.fixture(scope="module")
def tokens():
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(BPE)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rest = [b for b in range(256) if b not in PLAIN_BYTES]
    byte = {chr(b): b for b in PLAIN_BYTES} | {chr(256 + i): b for i, b in enumerate(rest)}
    names = {i: bytes(byte.get(c, 0) for c in t) for t, i in json.load(open(BPE, encoding="utf-8"))["model"]["vocab"].items()}

    def both(text):
        if not text:
            return [], []
        a = first.encode(" " + text, add_special_tokens=False).ids
        b = second.encode(text)
        pieces = [second.id_to_piece(i) for i in b]
        b_bytes = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces, strict=True)]
        whole = (" " + text).encode()
        if b"".join(names[i] for i in a) != whole or b"".join(b_bytes) != whole:
            return [], []
        return [(i, len(names[i])) for i in a], [(i, len(x)) for i, x in zip(b, b_bytes, strict=True)]

    return both


def spans(tokens):
    at, out = 0, []
    for i, n in tokens:
        out.append((i, at, at + n))
        at += n
    return out


def plain(rows, tokens):
    linked, about = {}, {}
    for key, text in rows:
        a, b = (spans(x) for x in tokens(text))
        links, j = [], 0
        for i, lo, hi in a:
            while j < len(b) and b[j][2] <= lo:
                j += 1
            k = j
            while k < len(b) and b[k][1] < hi:
                links.append((i, b[k][0]))
                k += 1
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, lo = [], 0
        for e in ends:
            groups.append("|".join(",".join(str(i) for i, s, t in side if lo <= s and t <= e) for side in (a, b)) if len(a) < 400 else None)
            lo = e
        if a and groups[0] is None:  # long texts: by group number
            of = {s: n for n, s in enumerate([0, *ends[:-1]])}
            parts, n = [[[], []] for _ in ends], 0
            for which, side in enumerate((a, b)):
                n = 0
                for i, s, _ in side:
                    n = of.get(s, n)
                    parts[n][which].append(str(i))
            groups = ["|".join(",".join(x) for x in p) for p in parts]
        linked[key] = links
        about[key] = (len(a), len(b), len(ends), len(links), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "")
    count = Counter(p for links in linked.values() for p in set(links))
    most = defaultdict(int)
    for (i, _), n in count.items():
        most[i] = max(most[i], n)
    return {k: (*about[k][:4], sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), about[k][4]) for k, links in linked.items()}


def found(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_alignment(spark, docs, rows, tokens):
    more = [(200000 + i, t, None) for i, t in enumerate(TRICKY)]
    got = found(alignment.align(docs.union(spark.createDataFrame(more, docs.schema)), BPE, PIECES))
    want = plain([(i, t) for i, t, _ in rows + more], tokens)
    assert got == want
    assert want[200015] == (0, 0, 0, 0, 0, 0, "") and want[200000][0] > 0


def test_slices_share_counts(spark, rows, tokens, monkeypatch):
    """Many small slices: a pair's documents are summed over all of them."""
    monkeypatch.setattr(alignment, "SLICE", 20000)
    few = [(str(i), t, 1, 2) for i, t, _ in rows[:120]]
    df = spark.createDataFrame(few, "key string, body string, n_a int, slice int").repartition(3)
    got = found(alignment.align(df, BPE, PIECES, id_col="key", text_col="body"))
    assert got == plain([r[:2] for r in few], tokens)


def test_windows_with_one_name_are_told_apart(spark, rows, tokens, monkeypatch):
    monkeypatch.setattr(alignment, "mix", lambda a, b: a & alignment.U(3))
    few = [(i, t) for i, t, _ in rows[:20] if t]
    a, b = alignment.SpacedBytes(BPE), alignment.Pieces(PIECES)
    import pyarrow as pa
    good, out = alignment.align_slice(pa.array([t for _, t in few], pa.large_string()), a, b)
    want = plain(few, tokens)
    assert good.all() and out["digests"] == [want[i][6] for i, _ in few]


def test_repeated_rows_and_empty_tables(spark, tokens):
    rows = [(1, "the cat", 1), (1, "the cat", 1), (None, "the cat", 1), (2, None, 1), (3, "", 1)]
    got = alignment.align(spark.createDataFrame(rows, "doc_id long, text string, place int"), BPE, PIECES).collect()
    want = plain(list(enumerate(t for _, t, _ in rows)), tokens)
    assert sorted(tuple(r)[1:] for r in got) == sorted(want.values()) and sorted((r.doc_id is None, r.doc_id or 0) for r in got) == [(False, 1), (False, 1), (False, 2), (False, 3), (True, 0)]
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string"), BPE, PIECES).collect() == []


def test_a_very_long_text(spark, tokens):
    rows = [(1, "the cat sat on the mat, " * 40000 + "é" * 3000 + " x" * 100000)]
    got = found(alignment.align(spark.createDataFrame(rows, "doc_id long, text string"), BPE, PIECES))
    assert got == plain(rows, tokens)
