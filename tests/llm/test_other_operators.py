"""Packing, encoding, sharding, embeddings and chat against plain Python."""

import json
import math
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from plain import components
from shared import docs, rows  # noqa: F401
from pyspark.sql import functions as F

from tripcast.llm import chat, embeddings, packing, sharding, unigram
from tripcast.llm.queries import TOOLS, tool_messages, vocabulary

BPE, PIECES = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
TRICKY = ["a  b", " lead", "trail ", "a\n b", "a \nb", "it's we'll I'D", "x y  z", "\x1c a \x1fb", "<|endoftext|> a", "日本語 テキスト", "é è  \n\n ", "a\r\nb 12345 1 2"]


def test_packing_ids_are_those_of_the_tokenizer_and_cover_each_document(spark, docs, rows):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(BPE)
    t.encode_special_tokens = True
    more = [(200000 + i, x, "en") for i, x in enumerate(TRICKY)]
    every = docs.union(spark.createDataFrame(more, docs.schema))
    got = defaultdict(list)
    found = packing.pack(every, BPE).collect()
    for r in found:
        got[r.doc_id].append(r)
    assert len({r.sequence_id for r in found}) == len(found) and {r.offset for r in found} == {0}
    for i, text, _ in rows + more:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        pieces = sorted(got[i], key=lambda r: r.start)
        assert [x for r in pieces for x in np.frombuffer(r.ids, "<u4").tolist()] == ids
        assert [r.start for r in pieces] == [0, *np.cumsum([r.length for r in pieces])[:-1].tolist()]
        assert all(r.doc_tokens == len(ids) and r.length <= 1024 and r.length & (r.length - 1) == 0 for r in pieces)


def test_lengths():
    assert packing.lengths(2 * 1024 + 5, 1024) == [1024, 1024, 4, 1] and packing.lengths(1, 1024) == [1]


def viterbi(text, scores, unknown):
    best = [(0.0, None)] + [(-math.inf, None)] * len(text)
    for i in range(len(text)):
        if text[i] not in scores:
            best[i + 1] = max(best[i + 1], (best[i][0] + unknown, i), key=lambda x: x[0])
        for j in range(i + 1, min(len(text), i + 16) + 1):
            if text[i:j] in scores and best[i][0] + scores[text[i:j]] > best[j][0]:
                best[j] = (best[i][0] + scores[text[i:j]], i)
    out, j = [], len(text)
    while j:
        out.append(text[best[j][1]:j])
        j = best[j][1]
    return out[::-1]


def test_unigram_is_viterbi_and_round_trips(spark, docs, rows):
    pieces, scores, _ = unigram.load_pieces(PIECES)
    table = {p: s for p, s in zip(pieces, scores.tolist()) if s == s}
    place_of_bytes = {i for i, p in enumerate(pieces) if re.fullmatch("<0x[0-9A-F]{2}>", p)}
    unknown = min(table.values()) - unigram.PENALTY
    more = [(200000 + i, x, "en") for i, x in enumerate(TRICKY)]
    every = docs.union(spark.createDataFrame(more, docs.schema)).withColumn("decoded", F.lit(1))
    out = unigram.decode(unigram.encode(every, PIECES), PIECES)
    for r in out.collect():
        text = r.text or ""
        assert r.decoded == text, r.doc_id
        if len(text) < 3000:
            # sums over a whole text and over its parts differ in the last bits, so compare the sums
            parts = viterbi("▁" + text.replace(" ", "▁"), table, unknown) if text else []
            ids = np.frombuffer(r.piece_ids, "<u4").tolist()
            covered = [c for c in text if c not in table and c != " "]
            assert sum(i in place_of_bytes for i in ids) == sum(len(c.encode()) for c in covered), r.doc_id
            mine = sum(scores[i] for i in ids if i not in place_of_bytes) + unknown * len(covered)
            assert abs(mine - sum(table.get(p, unknown) for p in parts)) < 1e-6, r.doc_id


def test_trie_holds_all_pieces_and_no_other():
    words = ["a", "ab", "abc", "b", "ba", "cab", "▁a", "▁"]
    t = unigram.build_trie(words, np.ones(len(words), bool))
    def walk(w):
        node = 0
        for c in t.codes(np.array([ord(x) for x in w], np.uint32)).tolist():
            to = int(t.base[node]) + c
            if not c or not 0 <= to < len(t.check) or t.check[to] != node:
                return -1
            node = to
        return int(t.value[node])
    assert [walk(w) for w in words] == list(range(len(words)))
    assert walk("ac") == walk("abca") == walk("z") == walk("c") == -1


@pytest.mark.parametrize("tolerance", [0.002, 0.05])
def test_sharding(docs, rows, tolerance):
    copies = docs.union(docs.where("doc_id = 3").withColumn("doc_id", F.explode(F.sequence(F.lit(300000), F.lit(300199)))))
    got = sharding.shard(copies, shards=6, tolerance=tolerance, carry=("text",)).collect()
    assert len(got) == len(rows) + 200 and len({r.doc_id for r in got}) == len(got)
    by = defaultdict(list)
    for r in got:
        text = (r.text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text) + 8, zlib.crc32(text), "bytes", None)
        by[r.shard].append(r)
    assert set(by) == set(range(6))
    total = sum(r.size for r in got)
    for rs in by.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
        assert abs(sum(r.size for r in rs) - total / 6) <= 2 * max(tolerance * total / 6, max(r.size for r in got))


def test_sharding_of_nothing_and_of_rows_alike(spark):
    assert sharding.shard(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    got = sharding.shard(spark.createDataFrame([(None, None)] * 30 + [(1, "a")] * 30, "doc_id long, text string"), shards=4).collect()
    assert len(got) == 60 and max(sum(r.size for r in got if r.shard == s) for s in range(4)) <= 60 * 9 / 4 + 18


def near_plain(rows, threshold):
    unit, order = {}, []
    for k, (i, v) in enumerate(rows):
        order.append(k)
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            a = np.array(v, float)
            unit[k] = a / np.linalg.norm(a)
    links = [(a, b) for x, a in enumerate(order) for b in order[x + 1:]
             if a in unit and b in unit and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold]
    return links


def test_near_vectors(spark):
    rng = np.random.default_rng(1)
    table = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    base = rng.standard_normal(64)
    table += [(1000 + i, (base + 0.15 * rng.standard_normal(64)).tolist()) for i in range(700)] + [(3000 + i, base.tolist()) for i in range(20)]
    odd = [(5000, None), (5001, []), (5002, [0.0] * 64), (5003, [float("nan")] * 64), (5004, [1.0, 2.0]), (5005, [2.0, 4.0]), (5006, [None, 1.0]), (5007, [float("inf")] * 64)]
    rows = table + odd
    got = {r.vec_id: r for r in embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    links = near_plain(rows, 0.95)
    degree = defaultdict(int)
    for a, b in links:
        degree[rows[a][0]] += 1
        degree[rows[b][0]] += 1
    group = components([i for i, _ in rows], [(rows[a][0], rows[b][0]) for a, b in links])
    found = sum(r.n_links for r in got.values()) / 2
    assert 0.995 * len(links) <= found <= len(links)
    assert all(got[i].n_links <= degree[i] for i in got)
    assert {i: r.component_id for i, r in got.items()} == group
    assert all(r.kept == (r.component_id == r.vec_id) for r in got.values())
    assert embeddings.near_vectors(spark.createDataFrame([(None, [1.0]), (None, [1.0])], "vec_id long, embedding array<double>")).collect()[0].kept


def message(conv, turn, role, text, calls=None, of=None):
    return (conv, turn, role, text, calls, of)


MESSAGES = "conv_id long, turn long, role string, text string, tool_calls array<struct<id:string,name:string,arguments:string>>, tool_call_id string"


def test_chat_order_status_and_canonical_json(spark):
    ok = '{"limit": 1, "query": "ä\\n\\"q\\""}'
    ref = lambda i: '{"query":"x","limit":2,"context":{"$ref":"%s"}}' % i
    rows = [message(1, 0, "system", 'say "hi"\n'), message(1, 1, "assistant", None, [("c", "search", ref("b")), ("a", "search", ok), ("b", "search", ref("a"))]),
            message(1, 2, "tool", "first", of="a"), message(1, 5, "tool", "late", of="b"), message(1, 3, "tool", "lost", of="zz"),
            message(1, 4, "assistant", "more", [("a", "search", ok), ("d", "fax", "{}"), ("e", "search", "{"), ("f", "search", '{"query":"", "limit":1}'),
                                                ("x", "search", ref("y")), ("y", "search", ref("x")), ("s", "search", ref("s")), (None, "search", ok)]),
            message(None, 1, "assistant", "none", [("a", "search", ok)]), message(1, 6, "tool", None, of=None)]
    out = chat.link_tool_calls(spark.createDataFrame(rows, MESSAGES), TOOLS).collect()
    for r in out:
        value = json.loads(r.json)
        assert json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r.json
    mine = sorted((r for r in out if r.conv_id == 1), key=lambda r: (r["at"], r.level, r.kind, r.turn, r.pos))
    order = [(r.kind, r.call_id) for r in mine if r.call_id in ("a", "b", "c") and r.status != "duplicate"]
    assert order == [(1, "a"), (2, "a"), (1, "b"), (2, "b"), (1, "c")]
    status = {(r.call_id, r.turn): r.status for r in mine if r.kind == 1}
    assert status == {("c", 1): "unanswered", ("a", 1): "ok", ("b", 1): "ok", ("a", 4): "duplicate", ("d", 4): "unknown_tool", ("e", 4): "unreadable",
                      ("f", 4): "invalid", ("x", 4): "cycle", ("y", 4): "cycle", ("s", 4): "cycle", (None, 4): "duplicate"}
    assert {r.call_id: r.status for r in mine if r.kind == 2} == {"a": "ok", "b": "ok", "zz": "orphan", None: "orphan"}
    assert len(out) == 4 + 12 + 4  # messages, calls, results


def test_chat_over_the_table(spark):
    plain = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    messages = tool_messages(plain).collect()
    got = chat.link_tool_calls(tool_messages(plain), TOOLS).collect()
    calls = [(m.conv_id, c) for m in messages for c in m.tool_calls or ()]
    assert len(got) == sum(m.role != "tool" for m in messages) + len(calls) + sum(m.role == "tool" for m in messages)
    ids = {(c, x.id) for c, x in calls}
    for r in got:
        if r.kind == 2:
            assert (r.status == "ok") == ((r.conv_id, r.call_id) in ids)
    by = {(r.conv_id, r.call_id): r for r in got if r.kind == 1}
    for (conv, call), r in by.items():
        args = json.loads(r.json)["arguments"]
        need = args["context"]["$ref"] if isinstance(args, dict) and "context" in args else None
        if (conv, need) in by:
            p = by[conv, need]
            assert (p["at"], p.level) < (r["at"], r.level) or p["at"] < r["at"]


def test_chat_of_nothing(spark):
    assert chat.link_tool_calls(spark.createDataFrame([], MESSAGES), TOOLS).collect() == []
