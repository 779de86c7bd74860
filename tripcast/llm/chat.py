"""Operator 10: chat formatting with tool-call linking.

Calls and results meet by a hash join on (conversation, identifier). A call whose
arguments hold ``{"$ref": identifier}`` waits for that call and its results; rounds of
joins peel off calls with nothing left to wait for, so calls get the earliest time and
level at which all they need is there, however long a conversation is. Arguments are
parsed, checked against the tool's schema and written as canonical JSON (sorted keys,
no white space, UTF-8). Each message is a row with its order key: a conversation is
never gathered in one task.
"""

from __future__ import annotations

import json
import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcast.llm import rounds as R

KINDS = {"message": 0, "call": 1, "result": 2}
_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def fault(value, schema: dict, path: str = "$") -> str | None:
    """The first breach of a schema (type, enum, minimum, maximum, minLength, required, properties, additionalProperties, items)."""
    kind = schema.get("type")
    if kind in ("integer", "number"):
        if isinstance(value, bool) or not isinstance(value, int if kind == "integer" else (int, float)):
            return f"{path}: not of type {kind}"
    elif kind and not isinstance(value, _TYPES[kind]):
        return f"{path}: not of type {kind}"
    if "enum" in schema and value not in schema["enum"]:
        return f"{path}: not in enum"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", -math.inf) or value > schema.get("maximum", math.inf):
            return f"{path}: out of range"
    if isinstance(value, str) and len(value) < schema.get("minLength", 0):
        return f"{path}: too short"
    if isinstance(value, dict):
        known = schema.get("properties", {})
        for name in schema.get("required", ()):
            if name not in value:
                return f"{path}: {name} is missing"
        for name in sorted(value):
            found = fault(value[name], known[name], f"{path}.{name}") if name in known else (
                f"{path}: {name} is unknown" if schema.get("additionalProperties", True) is False else None)
            if found:
                return found
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            if found := fault(item, schema["items"], f"{path}[{i}]"):
                return found
    return None


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def references(value) -> list[str]:
    """Identifiers under "$ref" anywhere in a value, in order."""
    if isinstance(value, dict):
        own = [value["$ref"]] if isinstance(value.get("$ref"), str) else []
        return own + [r for k, v in value.items() if k != "$ref" for r in references(v)]
    return [r for v in value for r in references(v)] if isinstance(value, list) else []


def _refuse(text: str):
    raise ValueError(text)


def read_arguments(text: str | None, schema: dict | None) -> tuple[str | None, str | None, list[str]]:
    """Canonical JSON (null if unreadable), what is wrong (null if nothing), and references."""
    try:
        value = json.loads(text or "", parse_constant=_refuse)
        done = canonical(value)
        done.encode()
    except (ValueError, RecursionError):
        return None, "unreadable arguments", []
    refs = list(dict.fromkeys(references(value)))
    return done, "unknown tool" if schema is None else fault(value, schema), refs


def _checked(calls: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    def one(batches):
        for batch in batches:
            found = [read_arguments(a, schemas.get(n)) for n, a in zip(batch.column("name").to_pylist(), batch.column("arguments").to_pylist(), strict=True)]
            columns = [batch.column(i) for i in range(batch.num_columns)]
            columns += [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.string(), pa.string(), pa.list_(pa.string())))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "args", "wrong", "refs"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in calls.schema.fields)
    return calls.mapInArrow(one, ddl + ", args string, wrong string, refs array<string>")


def _times(calls: DataFrame, answered: DataFrame) -> DataFrame:
    """(conv, id, at, level, cycle) of each call that waits for others, by peeling.

    calls: conv, id, turn, refs; answered: conv, id, last turn of the call's results.
    Waiting edges of a finished call are dropped each round; what never finishes is a cycle.
    """
    spark = calls.sparkSession
    edges = calls.select("conv", "id", F.explode("refs").alias("need")).join(
        calls.select("conv", F.col("id").alias("need")), ["conv", "need"], "left_semi")
    open_ = R.written(edges.distinct(), "edges")
    ready = calls.join(open_.select("conv", "id").distinct(), ["conv", "id"], "left_anti").select("conv", "id", F.col("turn").alias("at"))
    met, parts, level, old = None, [], 0, []
    left = open_.count()
    while left:
        level += 1
        done = ready.join(answered, ["conv", "id"], "left").select(
            "conv", F.col("id").alias("need"), F.greatest("at", F.coalesce("last", "at")).alias("done"))
        hit = R.written(open_.join(done, ["conv", "need"]).select("conv", "id", "need", "done"), "met")
        rest = R.written(open_.join(hit.select("conv", "id", "need"), ["conv", "id", "need"], "left_anti"), "edges")
        met = hit.drop("need") if met is None else met.unionByName(hit.drop("need"))
        free = hit.select("conv", "id").distinct().join(rest.select("conv", "id").distinct(), ["conv", "id"], "left_anti")
        times = met.join(free, ["conv", "id"], "left_semi").groupBy("conv", "id").agg(F.max("done").alias("done"))
        ready = R.written(times.join(calls.select("conv", "id", "turn"), ["conv", "id"]).select(
            "conv", "id", F.greatest("turn", "done").alias("at")), "ready")
        parts.append(ready.withColumns({"level": F.lit(level), "cycle": F.lit(False)}))
        old += [open_, hit]
        open_, now = rest, rest.count()
        if now == left:
            break
        left = now
    empty = spark.createDataFrame([], "conv long, id string, at long, level int, cycle boolean")
    out = empty
    for part in parts:
        out = out.unionByName(part.select(*empty.columns))
    stuck = open_.select("conv", "id").distinct().join(calls.select("conv", "id", "turn"), ["conv", "id"])
    return out.unionByName(stuck.select("conv", "id", F.col("turn").alias("at"), F.lit(0).alias("level"), F.lit(True).alias("cycle")))


def link_tool_calls(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per message, call and result with its order key, status and canonical JSON.

    messages: ``conv_id``, ``turn`` (long), ``role``, ``text``, ``tool_calls``
    (array<struct<id, name, arguments: string>>, null for none; of any role) and ``tool_call_id``
    (of a message of role tool); other columns are left out. A message of role tool is a result,
    and its own calls wait for the call that it answers. Order a conversation by (at,
    level, kind, turn, pos): calls precede their results and all that refers to them.
    Status: ``ok``; calls: ``duplicate`` (a later call of the same identifier, or one without an identifier),
    ``cycle``, ``unreadable``, ``unknown_tool``, ``invalid``, ``unresolved`` (a reference to an identifier
    that no call of the conversation has) or ``unanswered`` (the first that holds);
    results: ``orphan``. Null texts are JSON null; rows without conversation link with
    nothing; repeated messages are messages of their own; an empty table gives no row.
    """
    rows = messages.select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), "role", "text", "tool_calls", "tool_call_id")
    said = rows.where("role is null or role <> 'tool'")
    plain = said.select("conv", F.col("turn").alias("at"), F.lit(0).alias("level"), F.lit(0).alias("kind"), "turn", F.lit(-1).alias("pos"),
                        F.lit(None).cast("string").alias("call_id"), F.lit("ok").alias("status"),
                        F.to_json(F.struct(F.col("text").alias("content"), "role"), {"ignoreNullFields": "false"}).alias("json"))
    answers_to = F.when(F.col("role") == "tool", F.col("tool_call_id")).alias("of")
    every = rows.select("conv", "turn", answers_to, F.posexplode("tool_calls").alias("pos", "c")).select(
        "conv", "turn", "of", "pos", "c.id", "c.name", "c.arguments", F.xxhash64("c").alias("same"), F.monotonically_increasing_id().alias("row"))
    every = R.written(_checked(every, schemas), "calls")
    # the first call of an identifier has it
    first = every.where("conv is not null and id is not null").groupBy("conv", "id").agg(
        F.min(F.struct("turn", "pos", "row", "refs", "of")).alias("f")).select("conv", "id", "f.turn", "f.row", "f.refs", "f.of")
    lost = first.select("conv", "id", F.explode("refs").alias("need")).join(
        first.select("conv", F.col("id").alias("need")), ["conv", "need"], "left_anti").select("conv", "id", F.lit(True).alias("lost")).distinct()
    waits = F.when(F.col("of").isNull(), F.col("refs")).otherwise(F.array_union("refs", F.array("of")))
    results = rows.where("role = 'tool'").select("conv", "turn", F.col("tool_call_id").alias("id"), "text")
    answered = results.where("conv is not null and id is not null").groupBy("conv", "id").agg(F.max("turn").alias("last"))
    times = _times(first.select("conv", "id", "turn", waits.alias("refs")), answered)
    owners = first.join(times, ["conv", "id"], "left").select(
        "conv", "id", F.col("row").alias("owner"), F.coalesce("at", "turn").alias("at"), F.coalesce("level", F.lit(0)).alias("level"),
        F.coalesce("cycle", F.lit(False)).alias("cycle"))
    owners = owners.join(answered.select("conv", "id", F.lit(True).alias("has")), ["conv", "id"], "left").join(lost, ["conv", "id"], "left")
    owned = every.join(owners, ["conv", "id"], "left")
    status = (F.when(F.col("owner").isNull() | (F.col("owner") != F.col("row")), "duplicate").when(F.col("cycle"), "cycle")
              .when(F.col("args").isNull(), "unreadable").when(F.col("wrong") == "unknown tool", "unknown_tool").when(F.col("wrong").isNotNull(), "invalid")
              .when(F.col("lost"), "unresolved").when(F.col("has").isNull(), "unanswered").otherwise("ok"))
    is_owner = F.coalesce(F.col("owner") == F.col("row"), F.lit(False))
    text = lambda c: F.when(F.col(c).isNull(), F.lit("null")).otherwise(F.expr(f"substring(to_json(named_struct('x', {c})), 6, length(to_json(named_struct('x', {c}))) - 6)"))
    calls = owned.select("conv", F.when(is_owner, F.col("at")).otherwise(F.col("turn")).alias("at"), F.when(is_owner, F.col("level")).otherwise(0).alias("level"),
                         F.lit(1).alias("kind"), "turn", "pos", F.col("id").alias("call_id"), status.alias("status"),
                         F.concat(F.lit('{"arguments":'), F.coalesce("args", text("arguments")), F.lit(',"error":'), text("wrong"), F.lit(',"id":'), text("id"),
                                  F.lit(',"name":'), text("name"), F.lit('}')).alias("json"))
    names = every.select(F.col("row").alias("owner"), "name")
    linked = results.join(owners.join(names, "owner"), ["conv", "id"], "left")
    answers = linked.select("conv", F.greatest("turn", F.coalesce("at", "turn")).alias("at"), F.coalesce("level", F.lit(0)).alias("level"), F.lit(2).alias("kind"),
                            "turn", F.lit(-1).alias("pos"), F.col("id").alias("call_id"), F.when(F.col("owner").isNull(), "orphan").otherwise("ok").alias("status"),
                            F.concat(F.lit('{"call_id":'), text("id"), F.lit(',"content":'), text("text"), F.lit(',"name":'), text("name"), F.lit('}')).alias("json"))
    return plain.unionByName(calls).unionByName(answers).withColumnRenamed("conv", "conv_id")
