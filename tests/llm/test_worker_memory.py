"""Memory of a worker: what a batch of texts, the character classes and a slice take beside the input."""

import tracemalloc

import numpy as np
import pyarrow as pa

from tripcast.llm import bytebpe, packing, text


def test_slices_of_a_column_with_nulls_copy_one_slice_at_a_time():
    rows = [None] + [f"{i:05d} " + "x" * 9994 for i in range(2000)]
    table = pa.table({"c0": range(len(rows)), "c1": rows})
    before, most, back = pa.total_allocated_bytes(), 0, []
    for part, texts in text.slices(table, "c1", 1 << 20):
        most = max(most, pa.total_allocated_bytes() - before)
        assert len(part) == len(texts)
        back += texts.to_pylist()
    assert back == [(r or "").encode() for r in rows]
    assert most < 4 << 20  # 20 MB when the whole column was filled at once


def test_slices_cut_where_they_did():
    rows = ["a" * n for n in (3, 0, 9, 2, 2, 30, 1)]
    for column in (pa.array(rows), pa.array(rows, pa.large_string()), pa.chunked_array([rows[:2], rows[2:]])):
        got = [(part["i"].to_pylist(), texts.to_pylist()) for part, texts in text.slices(pa.table({"i": range(7), "c1": column}), "c1", 10)]
        assert [i for i, _ in got] == [[0, 1], [2], [3, 4], [5], [6]]
        assert [t for _, ts in got for t in ts] == [r.encode() for r in rows]
    assert list(text.slices(pa.table({"c1": pa.array([], pa.string())}), "c1", 10)) == []
    assert [t.to_pylist() for _, t in text.slices(pa.table({"c1": pa.nulls(2)}), "c1", 10)] == [[b"", b""]]


def test_character_classes_are_found_without_a_list_of_all_characters():
    tracemalloc.start()
    classes = bytebpe._classes()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20  # about 100 MB with a string object per character
    for char, kind in (("a", bytebpe.LETTER), ("ß", bytebpe.LETTER), ("𝒜", bytebpe.LETTER), ("7", bytebpe.NUMBER), ("½", bytebpe.NUMBER),
                       (" ", bytebpe.WHITE), (" ", bytebpe.WHITE), ("\x1c", bytebpe.OTHER), ("!", bytebpe.OTHER)):
        assert classes[ord(char)] == kind, char


def test_no_table_stays_in_a_worker_after_a_slice():
    tracemalloc.start()
    words = text.split(text.as_large(pa.array(["some words of a text"] * 3)))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert len(words.hash) == 15 and len(np.unique(words.hash)) == 5
    assert held < 1 << 20  # 32 MB of powers stayed before


def test_a_slice_of_packing_takes_little_memory():
    words = " ".join(f"w{i * 7919 % 100003:x}" for i in range(1000))
    table = pa.table({"c1": [f"{words} {i}" for i in range(2500)]})  # 15 MB
    most = max(texts.nbytes for _, texts in text.slices(table, "c1", packing.SLICE))
    assert most < 3 << 20  # 6 MB before; words and ids take many times as much
