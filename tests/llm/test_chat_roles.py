"""Calls on messages of every role, and references to calls that aren't there."""

from test_other_operators import MESSAGES, message

from tripcast.llm import chat
from tripcast.llm.queries import TOOLS

OK = '{"limit": 1, "query": "q"}'


def ref(*ids):
    return '{"query":"x","limit":2,"context":{"$ref":"%s"}}' % ids


def linked(spark, rows):
    return chat.link_tool_calls(spark.createDataFrame(rows, MESSAGES), TOOLS).collect()


def test_calls_of_tool_messages_have_rows_and_results(spark):
    rows = [message(1, 0, "assistant", "go", [("a", "search", OK)]),
            message(1, 1, "tool", "found", [("b", "search", OK), ("c", "search", ref("b"))], of="a"),
            message(1, 2, "tool", "more", of="b"), message(1, 3, "tool", "last", of="c"),
            message(1, 4, "tool", "lost", [("d", "search", OK)], of="zz"), message(1, 5, "user", "me", [("e", "search", OK)]),
            message(1, 6, None, "none", [("f", "search", OK)]), message(1, 7, "tool", "own", [("g", "search", OK)], of="g")]
    out = linked(spark, rows)
    assert len(out) == 3 + 7 + 5  # messages, calls, results
    status = {r.call_id: r.status for r in out if r.kind == 1}
    assert status == {"a": "ok", "b": "ok", "c": "ok", "d": "unanswered", "e": "unanswered", "f": "unanswered", "g": "cycle"}
    assert {r.call_id: r.status for r in out if r.kind == 2} == {"a": "ok", "b": "ok", "c": "ok", "zz": "orphan", "g": "ok"}
    order = [(r.kind, r.call_id) for r in sorted(out, key=lambda r: (r["at"], r.level, r.kind, r.turn, r.pos)) if r.call_id in ("a", "b", "c")]
    assert order == [(1, "a"), (2, "a"), (1, "b"), (2, "b"), (1, "c"), (2, "c")]


def test_references_to_absent_calls_are_unresolved(spark):
    rows = [message(1, 0, "assistant", "go", [("a", "search", ref("none")), ("b", "search", ref("a")), ("c", "search", ref("other")), ("d", "fax", ref("none")),
                                              ("e", "search", '{"query":"", "limit":1, "context":{"$ref":"none"}}'), ("f", "search", ref("none"))]),
            message(2, 0, "assistant", "go", [("other", "search", OK)])]
    rows += [message(1, 1 + i, "tool", "done", of=c) for i, c in enumerate("abcde")] + [message(2, 1, "tool", "done", of="other")]
    status = {(r.conv_id, r.call_id): r.status for r in linked(spark, rows) if r.kind == 1}
    assert status == {(1, "a"): "unresolved", (1, "b"): "ok", (1, "c"): "unresolved", (1, "d"): "unknown_tool", (1, "e"): "invalid", (1, "f"): "unresolved",
                      (2, "other"): "ok"}
