"""Chat formatting with linked tool calls.

A turn is plain text, an assistant message with calls, or a tool's result. Calls and results are
joined by conversation and call identifier; messages are put in topological order, so that a
result follows its call and a call follows what it depends on; arguments are checked against the
tools' schemas; each message becomes one line of canonical JSON (keys sorted, no spaces). A turn
that cannot be read is plain text and a call that cannot be checked is invalid: none ends the job.

The forms read are ``{"content": ..., "tool_calls": [{"id", "name", "arguments", "depends_on"}]}``
(also with ``"function": {"name", "arguments"}``, arguments as an object or as JSON text) from an
assistant, and ``{"tool_call_id": ..., "content": ...}`` from a tool. Anything else is plain text.
"""

from __future__ import annotations

import json
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogflow.llm.blocks import map_arrow
from catalogflow.session import materialize


_SURROGATE = re.compile("[\ud800-\udfff]")


def _told(text: str) -> str:
    """Half of a surrogate pair, which no UTF-8 text can hold, is written as its JSON escape."""
    return _SURROGATE.sub(lambda half: f"\\u{ord(half.group()):04x}", text)


def canonical(value) -> str:
    """Keys sorted by code point, no spaces, every character that UTF-8 can hold as it is."""
    return _told(json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False))


def _finite(text: str) -> float:
    number = float(text)
    if not math.isfinite(number):
        raise ValueError(f"{text} is out of range")
    return number


def _refused(text: str):
    raise ValueError(f"{text} is no JSON")


def parsed(text: str):
    """The value of a JSON text; what is no JSON (NaN, a number out of range, too deep) raises."""
    try:
        return json.loads(text, parse_constant=_refused, parse_float=_finite)
    except RecursionError:
        raise ValueError("nested too deeply") from None


def _equal(a, b) -> bool:
    """Equality of JSON values: 1 and 1.0 are equal, 1 and true are not."""
    if isinstance(a, bool) or isinstance(b, bool):
        return a is b
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(_equal, a, b))
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(_equal(v, b[k]) for k, v in a.items())
    return a == b


def _is(value, kind) -> bool:
    if isinstance(value, bool) and kind in ("integer", "number"):
        return False
    if kind == "integer" and isinstance(value, float):
        return value.is_integer()
    return isinstance(value, _TYPES.get(kind, ()) if isinstance(kind, str) else ())


_TYPES = {
    "object": dict, "array": list, "string": str, "boolean": bool, "null": type(None),
    "integer": int, "number": (int, float),
}


def errors_of(value, schema: dict, at: str = "$") -> list[str]:
    """What in ``value`` breaks the schema.

    Of JSON Schema: type (1.0 is an integer; no value is of a type that JSON Schema does not know),
    enum, minimum, maximum, required, properties, additionalProperties (true or false) and items.
    """
    found = []
    kinds = schema.get("type")
    if kinds is not None:
        kinds = kinds if isinstance(kinds, list) else [kinds]
        if not any(_is(value, k) for k in kinds):
            return [f"{at}: not of type {'/'.join(map(str, kinds))}"]
    if "enum" in schema and not any(_equal(value, v) for v in schema["enum"]):
        found.append(f"{at}: not one of the values")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value) or value > schema.get("maximum", value):
            found.append(f"{at}: out of range")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                found += errors_of(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{at}.{k}: not allowed")
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            found += errors_of(item, schema["items"], f"{at}[{i}]")
    return found


def _call(raw, schemas: dict) -> dict | None:
    if not isinstance(raw, dict) or raw.get("id") is None:
        return None
    body = raw["function"] if isinstance(raw.get("function"), dict) else raw
    name, arguments = body.get("name"), body.get("arguments")
    found = []
    if isinstance(arguments, str):
        try:
            arguments = parsed(arguments)
        except ValueError:
            found.append("$: no JSON")
    if not found:
        schema = schemas.get(name) if isinstance(name, str) else None
        found = ["unknown tool"] if schema is None else errors_of(arguments, schema)
    after = raw.get("depends_on") or []
    return {
        "id": _told(str(raw["id"])),
        "name": name if name is None or isinstance(name, str) else canonical(name),
        "arguments": arguments,
        "after": [_told(str(x)) for x in (after if isinstance(after, list) else [after])],
        "errors": [_told(e) for e in found],
    }


def read_turn(role: str | None, text: str | None, schemas: dict) -> tuple[dict, list, str | None]:
    """The message of a turn, its calls, and the identifier of the call that it answers."""
    plain = {"role": role, "content": text}
    if role not in ("assistant", "tool") or not text or not text.lstrip().startswith("{"):
        return plain, [], None
    try:
        value = parsed(text)
        # What can be read but not written again, being nested too deeply, is plain text as well.
        canonical(value)
    except (ValueError, RecursionError):
        return plain, [], None
    if role == "tool" and value.get("tool_call_id") is not None:
        answered = _told(str(value["tool_call_id"]))
        return {"role": role, "tool_call_id": answered, "content": value.get("content")}, [], answered
    if role == "assistant" and isinstance(value.get("tool_calls"), list):
        calls = [c for c in (_call(x, schemas) for x in value["tool_calls"]) if c]
        shown = [{k: c[k] for k in ("id", "name", "arguments")} for c in calls]
        return {"role": role, "content": value.get("content"), "tool_calls": shown}, calls, None
    return plain, [], None


def _read(turns: DataFrame, schemas: dict, kinds: list[T.DataType]) -> DataFrame:
    names = ("conv", "turn", "role", "message", "calls", "answers")
    call_type = pa.list_(
        pa.struct(
            [
                ("id", pa.string()),
                ("after", pa.list_(pa.string())),
                ("errors", pa.list_(pa.string())),
            ]
        )
    )
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)])
    for field in T._parse_datatype_string(
        "message string, answers string, "
        "calls array<struct<id: string, after: array<string>, errors: array<string>>>"
    ):
        schema = schema.add(field)

    def run(batches):
        for batch in batches:
            read = [
                read_turn(r, t, schemas)
                for r, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            ]
            calls = [
                [{k: c[k] for k in ("id", "after", "errors")} for c in found] for _, found, _ in read
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(2),
                    pa.array([canonical(m) for m, _, _ in read], pa.string()),
                    pa.array([a for _, _, a in read], pa.string()),
                    pa.array(calls, call_type),
                ],
                names=["conv", "turn", "role", "message", "answers", "calls"],
            )

    return map_arrow(turns, run, schema)


def _order(edges: DataFrame) -> DataFrame:
    """(conv, turn, place, cyclic) of the messages that have to move.

    A place is (turn, level): a message comes after all that it follows, and otherwise keeps its
    turn. Each round moves the messages that stand before something they follow; a message whose
    level exceeds the number of its conversation's messages with edges is part of a cycle or
    follows one, and keeps its turn.
    """
    edges = materialize(edges, "edges")
    sizes = edges.groupBy("conv").agg((F.countDistinct("turn") + 1).alias("most"))
    moved = materialize(
        edges.select("conv", "turn").limit(0).select(
            "conv", "turn", F.struct("turn", F.lit(0).alias("level")).alias("place")
        ),
        "places",
    )
    while True:
        at = moved.select(F.col("conv").alias("c"), F.col("turn").alias("t"), "place")
        own = at.withColumnRenamed("place", "own")
        dep = at.withColumnRenamed("place", "dep")
        start = F.struct(F.col("turn"), F.lit(0).alias("level"))
        first = F.struct(F.col("follows").alias("turn"), F.lit(0).alias("level"))
        rows = (
            edges.join(own, F.col("conv").eqNullSafe(F.col("c")) & (F.col("turn") == F.col("t")), "left")
            .drop("c", "t")
            .join(dep, F.col("conv").eqNullSafe(F.col("c")) & (F.col("follows") == F.col("t")), "left")
            .drop("c", "t")
            .select(
                "conv",
                "turn",
                F.coalesce("own", start).alias("own"),
                F.coalesce("dep", first).alias("dep"),
            )
            .join(sizes.withColumnRenamed("conv", "s"), F.col("conv").eqNullSafe(F.col("s")))
            .where((F.col("dep") >= F.col("own")) & (F.col("own.level") <= F.col("most")))
        )
        later = F.struct(F.col("dep.turn").alias("turn"), (F.col("dep.level") + 1).alias("level"))
        raised = rows.groupBy("conv", "turn").agg(F.max(later).alias("place"))
        raised = materialize(raised, "raised")
        if raised.isEmpty():
            break
        moved = materialize(
            moved.unionByName(raised).groupBy("conv", "turn").agg(F.max("place").alias("place")), "places"
        )
    return moved.join(sizes.withColumnRenamed("conv", "s"), F.col("conv").eqNullSafe(F.col("s"))).select(
        "conv", "turn", "place", (F.col("place.level") > F.col("most")).alias("cyclic")
    )


def format_turns(
    turns: DataFrame,
    schemas: dict[str, dict] | None = None,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per turn: conversation, turn, order_turn, order_level, role, message, and counts.

    Sorting a conversation by order_turn, order_level, turn gives a topological order.
    ``n_calls``, ``n_answered`` (calls with a result) and ``n_invalid`` (calls whose arguments
    break their tool's schema, or whose tool has none) count the turn's own calls; ``status``
    is ``text``, ``calls``, ``result``, ``orphan`` (a result without a call), ``repeated`` (a
    second result for a call, or calls whose identifiers an earlier turn has used) or
    ``cyclic`` (it depends on itself by some way, and keeps its turn). A null turn number is
    never linked. Nulls elsewhere are JSON nulls. Repeated rows stay repeated.
    """
    plain = turns.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip((conv_col, turn_col, role_col, text_col), ("conv", "turn", "role", "text"))]
    )
    kinds = [plain.schema[n].dataType for n in ("conv", "turn", "role")]
    read = materialize(_read(plain, schemas or {}, kinds), "turns")
    calls = read.where("turn is not null").select("conv", "turn", F.explode("calls").alias("call"))
    calls = calls.select("conv", "turn", "call.id", "call.after")
    first = calls.groupBy("conv", "id").agg(F.min("turn").alias("call_turn"))
    answers = read.where("answers is not null and turn is not null")
    answers = answers.select("conv", F.col("answers").alias("id"), "turn")
    answer = answers.groupBy(F.col("conv").alias("b_conv"), F.col("id").alias("b_id")).agg(
        F.min("turn").alias("answer_turn")
    )
    same = F.col("conv").eqNullSafe(F.col("b_conv")) & (F.col("id") == F.col("b_id"))
    both_null = F.col("id").isNull()
    links = materialize(
        first.join(answer.hint("shuffle_hash"), same, "full").select(
            F.when(both_null, F.col("b_conv")).otherwise(F.col("conv")).alias("l_conv"),
            F.coalesce("id", "b_id").alias("l_id"),
            "call_turn",
            "answer_turn",
        ),
        "calls",
    )
    on_link = F.col("conv").eqNullSafe(F.col("l_conv")) & (F.col("id") == F.col("l_id"))
    result_edges = links.where("call_turn <> answer_turn").select(
        F.col("l_conv").alias("conv"), F.col("answer_turn").alias("turn"), F.col("call_turn").alias("follows")
    )
    needs = calls.select("conv", "turn", F.explode("after").alias("id"))
    call_edges = needs.join(links, on_link).select(
        "conv", "turn", F.coalesce("answer_turn", "call_turn").alias("follows")
    )
    edges = result_edges.unionByName(call_edges).where("turn <> follows").distinct()
    places = _order(edges)

    counted = (
        calls.join(links, on_link, "left")
        .groupBy(F.col("conv").alias("k_conv"), F.col("turn").alias("k_turn"))
        .agg(
            F.count_if(F.col("answer_turn").isNotNull()).alias("n_answered"),
            F.max(F.col("call_turn") < F.col("turn")).alias("again"),
        )
    )
    result = answers.join(links, on_link, "left").select(
        F.col("conv").alias("a_conv"),
        F.col("turn").alias("a_turn"),
        F.col("id").alias("a_id"),
        F.when(F.col("call_turn").isNull(), "orphan")
        .when(F.col("answer_turn") < F.col("turn"), "repeated")
        .otherwise("result")
        .alias("answer_status"),
    ).distinct()
    places = places.select(
        F.col("conv").alias("p_conv"), F.col("turn").alias("p_turn"), "place", "cyclic"
    )
    at = lambda p: F.col("conv").eqNullSafe(F.col(f"{p}_conv")) & (F.col("turn") == F.col(f"{p}_turn"))
    marked = F.size("calls") > 0
    special = read.where(marked | F.col("answers").isNotNull())
    joined = (
        special.join(counted, at("k"), "left")
        .join(result, at("a") & (F.col("answers") == F.col("a_id")), "left")
        .join(places, at("p"), "left")
    )
    kept_place = F.when(~F.coalesce("cyclic", F.lit(False)), F.col("place"))
    linked = joined.select(
        "conv",
        "turn",
        F.coalesce(kept_place["turn"], "turn").alias("order_turn"),
        F.coalesce(kept_place["level"], F.lit(0)).alias("order_level"),
        "role",
        "message",
        F.size("calls").cast("bigint").alias("n_calls"),
        F.coalesce("n_answered", F.lit(0)).cast("bigint").alias("n_answered"),
        F.aggregate(
            "calls", F.lit(0), lambda n, c: n + F.when(F.size(c["errors"]) > 0, 1).otherwise(0)
        )
        .cast("bigint")
        .alias("n_invalid"),
        F.when(F.col("cyclic"), "cyclic")
        .when(F.col("answers").isNotNull(), F.coalesce("answer_status", F.lit("orphan")))
        .when(F.col("again"), "repeated")
        .otherwise("calls")
        .alias("status"),
    )
    zero = F.lit(0).cast("bigint")
    text = read.where(~marked & F.col("answers").isNull()).select(
        "conv",
        "turn",
        F.col("turn").alias("order_turn"),
        F.lit(0).alias("order_level"),
        "role",
        "message",
        zero.alias("n_calls"),
        zero.alias("n_answered"),
        zero.alias("n_invalid"),
        F.lit("text").alias("status"),
    )
    return text.unionByName(linked).withColumnsRenamed({"conv": conv_col, "turn": turn_col, "role": role_col})
