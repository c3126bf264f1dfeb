"""Chat formatting: linking tool calls to results, ordering, validation, canonical JSON.

A message's text is plain, or a JSON object. An object with ``tool_calls`` (a list
of {id, name, arguments[, depends_on]}, or {id, function: {name, arguments}}) makes
calls; one with ``tool_call_id`` is the result of a call. Each message and each
call becomes an item of its own row.

Calls and results are hash-joined by conversation and identifier. The first call of
an identifier counts, by turn and place, and so does its first result; further ones
are marked. A call names calls whose results it needs in ``depends_on``; its level
is one more than the highest of theirs; chains are settled by pointer jumping. The
order within a conversation is (order_turn, level, order_index, stage): a result
follows its call, a call follows the results it needs. Calls on a cycle, or behind
one, have no level and an error.

No task holds a conversation: one of a third of all rows is dealt like others, since
all joins are on (conversation, identifier) and aggregates are partial first.

Defined results: a null conversation is a conversation of its own; null text is
null content; text that is not such JSON, is nested more than 100 deep or has an
integer of over 4,300 digits is plain; half surrogates become U+FFFD; repeated rows
are repeated items; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.llm.common import cut, slices
from sluice.operators.scratch import Scratch

#: Levels of nesting beyond which a text is not taken as JSON.
DEPTH = 100
_HALF = re.compile("[\ud800-\udfff]")


def canonical(value: Any) -> str:
    """JSON with sorted keys and no blanks; whole floats as integers; not-a-number and infinities as null."""

    def plain(x: Any) -> Any:
        if isinstance(x, float):
            return None if not math.isfinite(x) else int(x) if x.is_integer() and abs(x) < 1e15 else x
        if isinstance(x, dict):
            return {k: plain(v) for k, v in x.items()}
        return [plain(v) for v in x] if isinstance(x, list) else x

    return whole(json.dumps(plain(value), ensure_ascii=False, sort_keys=True, separators=(",", ":")))


def whole(text: str) -> str:
    """text with U+FFFD for half surrogates, which UTF-8 can't hold."""
    return _HALF.sub("\ufffd", text)


def parsed(text: str) -> Any:
    """The JSON value of text; ValueError where it is none or is nested more than ``DEPTH`` deep."""
    try:
        value = json.loads(text)
    except RecursionError:
        raise ValueError("nested too deep") from None
    level = [value]
    for _ in range(DEPTH):
        level = [y for x in level if isinstance(x, (dict, list)) for y in (x.values() if isinstance(x, dict) else x)]
        if not level:
            return value
    raise ValueError("nested too deep")


_KINDS = {
    "object": lambda x: isinstance(x, dict), "array": lambda x: isinstance(x, list), "string": lambda x: isinstance(x, str),
    "boolean": lambda x: isinstance(x, bool), "null": lambda x: x is None,
    "integer": lambda x: (isinstance(x, int) and not isinstance(x, bool)) or (isinstance(x, float) and x.is_integer()),
    "number": lambda x: isinstance(x, (int, float)) and not isinstance(x, bool),
}


def violations(value: Any, schema: dict, at: str = "$") -> list[str]:
    """What in value breaks a JSON schema of type, enum, required, properties, additionalProperties, items, minimum, maximum, minLength, maxLength."""
    out = []
    kinds = schema.get("type")
    if kinds is not None and not any(_KINDS.get(k, lambda x: True)(value) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return [f"{at}: not {kinds}"]
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not one of the values")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                out += violations(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties", True) is False:
                out.append(f"{at}.{k}: unknown")
    if isinstance(value, list) and "items" in schema:
        out += [e for i, x in enumerate(value) for e in violations(x, schema["items"], f"{at}[{i}]")]
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0) or len(value) > schema.get("maxLength", len(value)):
            out.append(f"{at}: length")
    elif _KINDS["number"](value) and (value < schema.get("minimum", value) or value > schema.get("maximum", value)):
        out.append(f"{at}: out of range")
    return out


_ITEM = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("place", T.IntegerType()), T.StructField("call_id", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("depends", T.ArrayType(T.StringType())), T.StructField("errors", T.ArrayType(T.StringType())), T.StructField("json", T.StringType()),
])


def items_of(role: str | None, text: str | None, schemas: dict[str, dict]) -> list[dict]:
    """The items of one message: itself, and its calls."""
    value: Any = None
    if text is not None and text.lstrip()[:1] == "{":
        try:
            value = parsed(text)
        except ValueError:
            value = None
    own = {"place": 0, "call_id": None, "name": None, "depends": [], "errors": []}
    if isinstance(value, dict) and isinstance(value.get("tool_call_id"), (str, int)):
        call = whole(str(value["tool_call_id"]))
        body = {"content": value.get("content"), "role": role or "tool", "tool_call_id": call}
        return [own | {"kind": "result", "call_id": call, "json": canonical(body)}]
    if not (isinstance(value, dict) and isinstance(value.get("tool_calls"), list)):
        return [own | {"kind": "message", "json": canonical({"content": text, "role": role})}]
    out, shown = [], []
    for k, c in enumerate(value["tool_calls"]):
        c = c if isinstance(c, dict) else {}
        inner = c.get("function") if isinstance(c.get("function"), dict) else c
        name, arguments, errors = inner.get("name"), inner.get("arguments", {}), []
        if isinstance(arguments, str):
            try:
                arguments = parsed(arguments)
            except ValueError:
                errors.append("$: not JSON")
        call = None if c.get("id") is None else whole(str(c["id"]))
        name = None if name is None else whole(str(name))
        if call is None:
            errors.append("no identifier")
        if name not in schemas:
            errors += [f"no schema for {name}"] if schemas else []
        elif not errors:
            errors += violations(arguments, schemas[name])
        needs = c.get("depends_on") if isinstance(c.get("depends_on"), list) else []
        body = {"arguments": arguments, "id": call, "name": name}
        shown.append(body)
        out.append({"kind": "call", "place": k + 1, "call_id": call, "name": name, "depends": [whole(str(x)) for x in needs if x is not None], "errors": [whole(e) for e in errors], "json": canonical(body)})
    return [own | {"kind": "message", "json": canonical({"content": value.get("content"), "role": role, "tool_calls": shown})}, *out]


def format_chat(
    messages: DataFrame, schemas: dict[str, dict] | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """A row per item: conversation, turn, role, kind (message, call, result), place, call_id, name, linked, level,
    order_turn, order_index, stage, valid, errors and json, the canonical form.

    linked: a call with a result, or a result with a call; null for messages.
    schemas: the arguments' JSON schema of each tool; without any, names are free.
    """
    schemas = schemas or {}
    kind = pa.struct([("kind", pa.string()), ("place", pa.int32()), ("call_id", pa.string()), ("name", pa.string()), ("depends", pa.list_(pa.string())), ("errors", pa.list_(pa.string())), ("json", pa.string())])
    picked = messages.select(F.col(conv).alias("conv"), F.col(text).alias("text"), F.col(turn).alias("turn"), F.col(role).cast("string").alias("role"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [items_of(r, t, schemas) for t, r in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist())]
            at = pa.array([k for k, x in enumerate(found) for _ in x], pa.int64())
            items = pa.array([i for x in found for i in x], kind)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(2).take(at), batch.column(3).take(at), *items.flatten()], names=["conv", "turn", "role", *[f.name for f in _ITEM]])

    by = {f.name: f.dataType for f in picked.schema}
    schema = T.StructType([T.StructField("conv", by["conv"]), T.StructField("turn", by["turn"]), T.StructField("role", T.StringType()), *_ITEM.fields])
    items = picked.mapInArrow(parse, schema).withColumn("_key", F.coalesce(F.concat(F.lit("c"), F.col("conv").cast("string")), F.lit("n")))
    items = cut(items)
    tools = items.where("kind <> 'message' and call_id is not null")
    first = tools.groupBy("_key", "call_id", "kind").agg(F.min(F.struct("turn", "place")).alias("at"))
    calls = first.where("kind = 'call'").select("_key", "call_id", F.col("at").alias("call_at"))
    results = first.where("kind = 'result'").select("_key", "call_id", F.col("at").alias("result_at"))
    linked = calls.join(results, ["_key", "call_id"], "full")
    linked = linked.join(_levels(items, calls), ["_key", "call_id"], "left")
    # messages have no identifier: they need no join, and would meet in one task by their null keys
    joined = tools.join(linked, ["_key", "call_id"], "left").unionByName(items.where("kind = 'message' or call_id is null"), allowMissingColumns=True)
    own_at = F.struct("turn", "place")
    is_call, is_result = F.col("kind") == "call", F.col("kind") == "result"
    again = (is_call & (own_at != F.col("call_at"))) | (is_result & (own_at != F.col("result_at")))
    pair = F.col("call_at").isNotNull() & F.col("result_at").isNotNull()
    behind = is_result & F.col("call_at").isNotNull()
    errors = F.filter(F.concat(F.col("errors"), F.array(
        F.when(again, F.lit("identifier used again")), F.when(is_call & ~pair, F.lit("no result")), F.when(is_result & F.col("call_at").isNull(), F.lit("no call")),
        F.when(is_call & F.col("call_id").isNotNull() & F.col("level").isNull(), F.lit("needs a cycle")),
    )), lambda e: e.isNotNull())
    return joined.select(
        F.col("conv").alias(conv), F.col("turn").alias(turn), F.col("role").alias(role), "kind", "place", "call_id", "name",
        F.when(~is_call & ~is_result, F.lit(None)).otherwise(F.coalesce(pair & ~again, F.lit(False))).alias("linked"),
        F.when(is_call | is_result, F.col("level")).otherwise(F.lit(0)).cast("int").alias("level"),
        F.when(behind, F.col("call_at.turn")).otherwise(F.col("turn")).alias("order_turn"),
        F.when(behind, F.col("call_at.place")).otherwise(F.col("place")).alias("order_index"),
        F.when(is_result, F.lit(1)).otherwise(F.lit(0)).alias("stage"), (F.size(errors) == 0).alias("valid"), errors.alias("errors"), "json",
    )


def _levels(items: DataFrame, calls: DataFrame) -> DataFrame:
    """(_key, call_id, level) of the first call of each identifier; those on or behind a cycle are left out.

    Needs of identifiers that no call has are ignored. Calls with one need form trees:
    their way up to a call with none or several is found by pointer jumping, in
    rounds about the logarithm of its length. Calls with several needs are then
    settled round by round, as many rounds as such calls stand behind each other.
    """
    key, put = ["_key", "call_id"], Scratch(items.sparkSession).put
    needs = items.where("kind = 'call' and call_id is not null and size(depends) > 0").join(calls, key).where("struct(turn, place) = call_at")
    needs = needs.select(*key, F.explode(F.array_distinct("depends")).alias("need"))
    needs = put(needs.join(calls.select("_key", F.col("call_id").alias("need")), ["_key", "need"]).select(*key, "need"))
    if needs.isEmpty():
        return calls.select(*key, F.lit(0).cast("long").alias("level"))
    counts = needs.groupBy(*key).agg(F.count("*").alias("n"), F.min("need").alias("need"))
    single = put(counts.where("n = 1").select(*key, F.col("need").alias("up"), F.lit(1).cast("long").alias("dist")))
    way = _to_the_top(single, single.count())
    tree = way.select("_key", F.col("call_id").alias("need"), "up", "dist")
    edges = needs.join(counts.where("n > 1").select(*key), key, "left_semi").join(tree, ["_key", "need"], "left")
    edges = put(edges.select(*key, F.coalesce("up", "need").alias("up"), (F.coalesce("dist", F.lit(0)) + 1).alias("dist"), F.lit(None).cast("long").alias("level")))
    settled = put(calls.join(needs.select(*key), key, "left_anti").select(*key, F.lit(0).cast("long").alias("level")))
    fresh = settled
    while not edges.isEmpty() and not fresh.isEmpty():
        found = fresh.select("_key", F.col("call_id").alias("up"), F.col("level").alias("found"))
        edges = edges.join(found, ["_key", "up"], "left").select(*key, "up", "dist", F.coalesce("level", F.col("found") + F.col("dist")).alias("level"))
        edges = put(edges)
        fresh = put(edges.groupBy(*key).agg(F.count("*").alias("n"), F.count("level").alias("k"), F.max("level").alias("level")).where("n = k").select(*key, "level"))
        edges = put(edges.join(fresh.select(*key), key, "left_anti"))
        settled = settled.unionByName(fresh)
    above = settled.select("_key", F.col("call_id").alias("up"), F.col("level").alias("over"))
    return settled.unionByName(way.join(above, ["_key", "up"]).select(*key, (F.col("over") + F.col("dist")).alias("level")))


def _to_the_top(single: DataFrame, n: int) -> DataFrame:
    """single (_key, call_id, up, dist) with up the first call above that is not in single; rows on or behind a cycle are left out.

    A round doubles the way, so after the logarithm of n rounds what is still under
    way is on a cycle or behind one.
    """
    rows, reach, put = single, 1, Scratch(single.sparkSession).put
    while True:
        above = rows.select("_key", F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("dist").alias("more"))
        joined = put(rows.join(above, ["_key", "up"], "left"))
        open_ = joined.where("next is not null")
        if open_.isEmpty() or reach > n:
            return joined.where("next is null").select("_key", "call_id", "up", "dist")
        rows, reach = joined.select("_key", "call_id", F.coalesce("next", "up").alias("up"), (F.col("dist") + F.coalesce("more", F.lit(0))).alias("dist")), 2 * reach


def calls_of_turns(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """messages (conv, turn, role, text) of plain conversations as tool calls, by a stated rule.

    A user's turn t becomes a call of the tool ``ask`` with identifier t, which needs
    the call of turn t - 2; an assistant's turn t becomes the result of the call t - 1.
    Other turns, and those without a turn, stay as they are. The rule looks at one row
    at a time, so it moves nothing.
    """
    at, t = F.col(turn).cast("string"), F.col(text).cast("string")
    words = F.size(F.array_remove(F.split(F.coalesce(t, F.lit("")), r"\s+", -1), ""))
    call = F.struct(at.alias("id"), F.lit("ask").alias("name"), F.struct(t.alias("text"), words.alias("words")).alias("arguments"), F.array((F.col(turn) - 2).cast("string")).alias("depends_on"))
    calls = F.to_json(F.struct(F.array(call).alias("tool_calls")))
    result = F.to_json(F.struct((F.col(turn) - 1).cast("string").alias("tool_call_id"), t.alias("content")))
    made = F.when(F.col(turn).isNull(), t).when(F.col(role) == "user", calls).when(F.col(role) == "assistant", result).otherwise(t)
    return messages.select(F.col(conv).alias(conv), F.col(turn).alias(turn), F.col(role).alias(role), made.alias(text))


#: The arguments of the tool ``ask`` of calls_of_turns.
ASK = {"ask": {"type": "object", "properties": {"text": {"type": "string", "minLength": 1}, "words": {"type": "integer", "minimum": 1}}, "required": ["text", "words"], "additionalProperties": False}}
