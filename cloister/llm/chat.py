"""Chat formatting with linked tool calls.

Calls and their results are joined by conversation and identifier, put in an order that respects what calls depend on,
held against the schemas of their tools, and written as canonical JSON: keys sorted by code point, no white space, only
the escapes that JSON demands.

Messages are dealt by call, never by conversation, so a conversation of any length is no task's alone; only where a call
needs one that doesn't stand earlier, the identifiers, positions and needs of that conversation (no bodies) meet in a task. Numbers within a
conversation come from counts by stretches of turns and then within stretches.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, staged

#: Turns of a conversation that are numbered together.
STRETCH = 64


def canonical(value: Any) -> str:
    """Canonical JSON; raises ValueError for numbers that JSON lacks."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _is_type(value: Any, kind: str) -> bool:
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    return {
        "object": isinstance(value, dict),
        "array": isinstance(value, list),
        "string": isinstance(value, str),
        "number": number,
        "integer": number and (isinstance(value, int) or (math.isfinite(value) and value == int(value))),
        "boolean": isinstance(value, bool),
        "null": value is None,
    }.get(kind, False)


def violations(value: Any, schema: dict, at: str = "$") -> list[str]:
    """What in a value breaks a JSON schema (type, enum, const, bounds, lengths, properties, required, items)."""
    out = []
    kinds = schema.get("type")
    if kinds is not None:
        kinds = kinds if isinstance(kinds, list) else [kinds]
        if not any(_is_type(value, k) for k in kinds):
            return [f"{at}: not {' or '.join(kinds)}"]
    if "enum" in schema and not any(type(v) is type(value) and v == value for v in schema["enum"]):
        out.append(f"{at}: not in enum")
    if "const" in schema and not (type(schema["const"]) is type(value) and schema["const"] == value):
        out.append(f"{at}: not the constant")
    if _is_type(value, "number"):
        if value < schema.get("minimum", value):
            out.append(f"{at}: under minimum")
        if value > schema.get("maximum", value):
            out.append(f"{at}: over maximum")
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
        out.append(f"{at}: length")
    if isinstance(value, list):
        if not schema.get("minItems", 0) <= len(value) <= schema.get("maxItems", len(value)):
            out.append(f"{at}: items")
        if isinstance(schema.get("items"), dict):
            for i, v in enumerate(value):
                out += violations(v, schema["items"], f"{at}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                out += violations(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}.{k}: unknown")
    return out


def numbered(rows: DataFrame, group: str, position: str, ties: list[Column]) -> DataFrame:
    """``rows`` with ``seq``: the place of each in its group, from 0, by position (null first), then ties."""
    rows = rows.withColumn("__stretch", F.floor(F.coalesce(F.col(position), F.lit(-1)) / STRETCH))
    counts = rows.groupBy(group, "__stretch").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(group).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col(group).alias("__group"), F.col("__stretch").alias("__at"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    inner = Window.partitionBy(group, "__stretch").orderBy(F.col(position).asc_nulls_first(), *ties)
    rows = rows.withColumn("__k", F.row_number().over(inner))
    joined = rows.join(counts, F.col(group).eqNullSafe(F.col("__group")) & (F.col("__stretch") == F.col("__at")))
    return joined.withColumn("seq", (F.col("__base") + F.col("__k") - 1).cast("long")).drop("__stretch", "__group", "__at", "__base", "__k")


_ORDER = "call_id string, position long, ready long, hops int, cycle boolean"


def _peeled():
    """For the rows (conv_id, call_id, position, needs) of a conversation: its calls (needs null) and what they need."""

    def peeled(rows: pa.Table) -> pa.Table:
        ids, positions, needs = (rows.column(k).to_pylist() for k in ("call_id", "position", "needs"))
        calls = {c: p for c, p, n in zip(ids, positions, needs) if n is None}
        least = -(2**63)  # of null positions, which come first
        key = {c: (least if p is None else p, 0) for c, p in calls.items()}
        needed_by: dict[str, list[str]] = {}
        open_needs = dict.fromkeys(calls, 0)
        for c, n in zip(ids, needs):
            if n is not None and c in calls and n in calls:
                needed_by.setdefault(n, []).append(c)
                open_needs[c] += 1
        free = [c for c, n in open_needs.items() if not n]
        for n in free:  # grows while calls become free
            ready, hops = key[n]
            for c in needed_by.get(n, ()):
                key[c] = max(key[c], (ready, hops + 1))
                open_needs[c] -= 1
                if not open_needs[c]:
                    free.append(c)
        cycle = [open_needs[c] > 0 for c in calls]
        ready = [p if on or key[c][0] == least else key[c][0] for (c, p), on in zip(calls.items(), cycle)]
        hops = [0 if on else key[c][1] for c, on in zip(calls, cycle)]
        conv_id = pa.array([rows.column("conv_id")[0].as_py()] * len(calls), rows.schema.field("conv_id").type)
        columns = [conv_id, pa.array(list(calls), pa.string()), pa.array(list(calls.values()), pa.int64()), pa.array(ready, pa.int64()), pa.array(hops, pa.int32()), pa.array(cycle, pa.bool_())]
        return pa.Table.from_arrays(columns, names=["conv_id", *[x.split()[0] for x in _ORDER.split(", ")]])

    return peeled


def ordered(calls: DataFrame, depends: DataFrame) -> DataFrame:
    """When each call can run: (conv_id, call_id, ready, hops, cycle), to be sorted by (ready, hops, position).

    calls: conv_id, call_id, position; depends: conv_id, call_id, needs. A call is ready at its own position or, if later,
    at that of what it needs, some hops after it. Conversations whose calls need only earlier ones are in order. In each of
    the others, calls whose needs are all placed are placed one after the other, however long the chains; what is never
    placed is on a cycle or needs what is: it keeps its position and is marked.
    """
    state = staged(calls.groupBy("conv_id", "call_id").agg(F.min("position").cast("long").alias("position")), "calls")
    edges = depends.filter("call_id is not null and needs is not null").select("conv_id", "call_id", "needs").distinct()
    own = state.toDF("c", "i", "mine")
    theirs = state.toDF("d", "n", "other")
    met = edges.join(own, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("call_id") == F.col("i"))).join(theirs, F.col("conv_id").eqNullSafe(F.col("d")) & (F.col("needs") == F.col("n")))
    # Null positions come first.
    late = met.filter(F.col("mine").isNull() | (F.col("other") >= F.col("mine"))).select(F.col("conv_id").alias("late")).distinct()
    late = staged(late, "late")
    in_order = state.select("conv_id", "call_id", F.col("position").alias("ready"), F.lit(0).alias("hops"), F.lit(False).alias("cycle"))
    if late.isEmpty():
        return in_order
    is_late = F.col("conv_id").eqNullSafe(F.col("late"))
    rows = state.withColumn("needs", F.lit(None).cast("string")).unionByName(edges.withColumn("position", F.lit(None).cast("long"))).join(late, is_late, "left_semi")
    kind = dict(state.dtypes)["conv_id"]
    placed = rows.groupBy("conv_id").applyInArrow(_peeled(), f"conv_id {kind}, {_ORDER}")
    return in_order.join(late, is_late, "left_anti").unionByName(placed.select("conv_id", "call_id", "ready", "hops", "cycle"))


def _checker(schemas: dict[str, dict]):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, errors = [], []
            for kind, call_id, name, body in zip(*(batch.column(k).to_pylist() for k in ("kind", "call_id", "name", "body"))):
                wrong: list[str] = []
                if kind == "call":
                    try:
                        arguments = json.loads(body) if body is not None else {}
                        canonical(arguments)
                    except (ValueError, RecursionError):
                        arguments, wrong = body, ["$: not JSON"]
                    if not wrong:
                        wrong = violations(arguments, schemas[name]) if name in schemas else ["unknown tool"]
                    value: dict = {"arguments": arguments, "id": call_id, "name": name, "type": "tool_call"}
                elif kind == "result":
                    value = {"content": body, "tool_call_id": call_id, "type": "tool_result"}
                else:
                    value = {"content": body, "role": name, "type": "message"}
                texts.append(canonical(value))
                errors.append("; ".join(wrong) if kind == "call" else None)
            keep = [c for c in batch.schema.names if c not in ("name", "body")]
            columns = [*[batch.column(c) for c in keep], pa.array(texts, pa.string()), pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "json", "errors"])

    return check


def link_calls(events: DataFrame, schemas: dict[str, dict], depends: DataFrame | None = None) -> DataFrame:
    """Link, order, validate and serialise the events of conversations.

    events: conv_id, position (long), kind ('call', 'result' or 'message'), call_id, name (tool, or role of a message),
    body (arguments as JSON, or content). depends: conv_id, call_id, needs. schemas: a JSON schema for each tool.

    One row per event: conv_id, position, kind, call_id, status, n_calls and n_results of its identifier, first_result
    (position, of a call), seq (place in the conversation), errors (of a call: empty if its arguments are valid), cycle,
    json. Status: 'linked', 'duplicate' (more than one call or result of that identifier), 'unanswered' (a call without
    result), 'orphan' (a result without call), 'message'. A null identifier links with nothing. Null bodies are JSON null,
    null arguments an empty object. Repeated rows are events of their own. An empty table gives no rows.
    """
    small_batches(events.sparkSession)
    named = events.select("conv_id", F.col("position").cast("long").alias("position"), "kind", "call_id", "name", "body")
    rows = staged(named, "events")
    linkable = rows.filter("kind in ('call', 'result') and call_id is not null")
    by_id = linkable.groupBy("conv_id", "call_id").agg(
        F.count(F.when(F.col("kind") == "call", 1)).alias("n_calls"),
        F.count(F.when(F.col("kind") == "result", 1)).alias("n_results"),
        F.min(F.when(F.col("kind") == "result", F.col("position"))).alias("first_result"),
    )
    by_id = staged(by_id.toDF("c", "i", "n_calls", "n_results", "first_result"), "identifiers")
    joined = rows.join(by_id, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("call_id") == F.col("i")) & (F.col("kind") != "message"), "left").drop("c", "i")
    calls, results = F.coalesce("n_calls", F.lit(0)), F.coalesce("n_results", F.lit(0))
    status = (
        F.when(F.col("kind") == "message", "message")
        .when((calls > 1) | (results > 1), "duplicate")
        .when((F.col("kind") == "call") & (results == 0), "unanswered")
        .when((F.col("kind") == "result") & (calls == 0), "orphan")
        .otherwise("linked")
    )
    joined = joined.select("conv_id", "position", "kind", "call_id", "name", "body", status.alias("status"), calls.alias("n_calls"), results.alias("n_results"), F.when(F.col("kind") == "call", F.col("first_result")).alias("first_result"))
    if depends is not None:
        keys = ordered(linkable.filter("kind = 'call'").select("conv_id", "call_id", "position"), depends).toDF("c", "i", "ready", "hops", "cycle")
        joined = joined.join(keys, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("call_id") == F.col("i")) & (F.col("kind") == "call"), "left").drop("c", "i")
        joined = joined.withColumn("at", F.coalesce("ready", "position")).withColumn("hops", F.coalesce("hops", F.lit(0))).withColumn("cycle", F.coalesce("cycle", F.lit(False))).drop("ready")
    else:
        joined = joined.withColumn("at", F.col("position")).withColumn("hops", F.lit(0)).withColumn("cycle", F.lit(False))
    placed = numbered(joined, "conv_id", "at", [F.col("hops"), F.col("position"), F.col("kind"), F.col("call_id"), F.xxhash64("name", "body")])
    kind_of = dict(events.dtypes)["conv_id"]
    out = placed.select("conv_id", "position", "kind", "call_id", "status", "n_calls", "n_results", "first_result", "seq", "cycle", "name", "body")
    return out.mapInArrow(_checker(schemas), f"conv_id {kind_of}, position long, kind string, call_id string, status string, n_calls long, n_results long, first_result long, seq long, cycle boolean, json string, errors string")


#: The tool that a user's turn calls in `turn_events`.
REPLY_SCHEMA = {"type": "object", "properties": {"prompt": {"type": "string", "minLength": 1}}, "required": ["prompt"], "additionalProperties": False}


def turn_events(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, turn, role, text) as events, and what calls need: a user's turn calls the tool ``reply`` with the
    text as prompt, the assistant's turn after it is the result; a call needs the user's turn two before it. Other roles
    are messages."""
    role, turn = F.col("role"), F.col("turn").cast("long")
    identity = lambda t: F.concat(F.lit("call-"), t.cast("string"))
    kind = F.when(role == "user", "call").when(role == "assistant", "result").otherwise("message")
    call_id = F.when(role == "user", identity(turn)).when(role == "assistant", identity(turn - 1))
    body = F.when(role == "user", F.to_json(F.struct(F.col("text").alias("prompt")))).otherwise(F.col("text"))
    name = F.when(role == "user", "reply").when(role == "assistant", F.lit(None)).otherwise(role)
    events = conversations.select("conv_id", turn.alias("position"), kind.alias("kind"), call_id.alias("call_id"), name.alias("name"), body.alias("body"))
    users = conversations.filter(role == "user").select("conv_id", turn.alias("turn")).filter("turn >= 2")
    depends = users.select("conv_id", identity(F.col("turn")).alias("call_id"), identity(F.col("turn") - 2).alias("needs"))
    return events, depends


def format_conversations(conversations: DataFrame) -> DataFrame:
    """The turns of conversations (conv_id, turn, role, text) as linked, ordered, validated events: see `link_calls`."""
    events, depends = turn_events(conversations.select("conv_id", "turn", "role", "text"))
    return link_calls(events, {"reply": REPLY_SCHEMA}, depends)
