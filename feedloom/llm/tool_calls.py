"""Tool calls in chats: linked to their results, put in order, validated and serialised."""

from __future__ import annotations

import json
from collections.abc import Iterator
from math import ceil, isinf, log2

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import materialise

#: What a message needs: ``calls`` on those that call, ``answers`` (a call's id) on results.
MESSAGE = ("conv_id long, turn long, role string, text string, "
           "calls array<struct<id:string,name:string,arguments:string,after:string>>, "
           "answers string")
KINDS = {"string": str, "boolean": bool, "array": list, "object": dict}


#: Lists and objects that arguments may stand in, one inside the other.
DEPTH = 64


class Rejected(ValueError):
    pass


def _pairs(pairs):
    found = dict(pairs)
    if len(found) < len(pairs):
        raise Rejected("a name stands twice in an object")
    return found


def _constant(name):
    raise Rejected(f"{name} is no JSON number")


def _number(text):
    value = float(text)
    if isinf(value):
        raise Rejected("a number is too great")
    return value


def _checked(value):
    """``value``, if it is not nested too deep and all its texts can be written."""
    layer, depth = [value], 0
    while layer:
        depth += any(isinstance(one, (list, dict)) for one in layer)
        if depth > DEPTH:
            raise Rejected("nested too deep")
        for one in layer:
            for text in [one] if isinstance(one, str) else one if isinstance(one, dict) else ():
                if not text.isascii() and any("\ud800" <= c <= "\udfff" for c in text):
                    raise Rejected("half of a surrogate pair")
        layer = [inner for one in layer if isinstance(one, (list, dict))
                 for inner in (one.values() if isinstance(one, dict) else one)]
    return value


def parsed(text: str):
    """The JSON value of a text.

    Names that repeat, numbers that are none or too great for one, halves of surrogate pairs and
    values in more than ``DEPTH`` lists and objects are rejected.
    """
    return _checked(json.loads(text, object_pairs_hook=_pairs, parse_constant=_constant,
                               parse_float=_number))


def canonical(value) -> str:
    """JSON with sorted names, no blanks, and whole numbers without a point."""
    def plain(one):
        if isinstance(one, dict):
            return {name: plain(inner) for name, inner in one.items()}
        if isinstance(one, list):
            return [plain(inner) for inner in one]
        if isinstance(one, float) and one.is_integer() and abs(one) < 1e21:
            return int(one)
        return one

    return json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def errors(value, schema: dict, at: str = "") -> list[str]:
    """What in ``value`` breaks a JSON schema (types, names, bounds, enumerations, items)."""
    kind = schema.get("type")
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    fits = {"number": number, "null": value is None,
            "integer": number and (isinstance(value, int) or value.is_integer())}.get(
                kind, isinstance(value, KINDS[kind]) if kind in KINDS else True)
    if not fits:
        return [f"{at}: not of type {kind}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not among the values")
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            out.append(f"{at}: too short")
        if len(value) > schema.get("maxLength", len(value)):
            out.append(f"{at}: too long")
    if number and (value < schema.get("minimum", value) or value > schema.get("maximum", value)):
        out.append(f"{at}: out of bounds")
    if isinstance(value, list) and "items" in schema:
        for i, inner in enumerate(value):
            out += errors(inner, schema["items"], f"{at}/{i}")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}/{name}: missing" for name in schema.get("required", []) if name not in value]
        for name, inner in value.items():
            if name in known:
                out += errors(inner, known[name], f"{at}/{name}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}/{name}: unknown")
    return out


def judged(name, arguments, tools: dict[str, dict]) -> tuple[object, list[str]]:
    """A call's arguments as a value, and what is wrong with them."""
    try:
        value = parsed(arguments if arguments is not None else "")
    except (ValueError, RecursionError) as wrong:
        return arguments, [f"no JSON: {wrong}" if isinstance(wrong, Rejected) else "no JSON"]
    if name not in tools:
        return value, ["unknown tool"]
    return value, errors(value, tools[name])


def depths(calls: DataFrame) -> DataFrame:
    """``(conv_id, call_id, depth)``: how many calls a call comes after, one after another.

    ``calls`` has one row per ``(conv_id, call_id)`` and the id ``after`` which it comes. A call
    after one that does not exist has depth 0; calls in a circle, or after one, have a null depth.
    Each round doubles the length of the steps, so a chain of n calls takes log2(n) rounds.
    """
    here = calls.select("conv_id", "call_id")
    known = here.select("conv_id", F.col("call_id").alias("up"))
    steps = materialise(
        calls.select("conv_id", "call_id", F.col("after").alias("up"))
        .join(known.withColumn("there", F.lit(1)).hint("shuffle_hash"), ["conv_id", "up"], "left")
        .select("conv_id", "call_id", F.when(F.col("there") == 1, F.col("up")).alias("up"),
                F.coalesce("there", F.lit(0)).cast("long").alias("depth")), "steps")
    rounds = ceil(log2(max(2, steps.count()))) + 1
    for _ in range(rounds):
        if steps.where("up is not null").isEmpty():
            break
        ahead = steps.select("conv_id", F.col("call_id").alias("up"),
                             F.col("up").alias("further"), F.col("depth").alias("more"))
        steps = materialise(steps.join(ahead.hint("shuffle_hash"), ["conv_id", "up"], "left").select(
            "conv_id", "call_id", F.col("further").alias("up"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "steps")
    return steps.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("depth"))
                        .alias("depth"))


def linked_calls(messages: DataFrame, tools: dict[str, dict]) -> DataFrame:
    """Calls and results of ``messages`` (columns of ``MESSAGE``), joined by conversation and id.

    Gives per call, and per result without one: ``conv_id, call_id, nth, status, depth, turn,
    name, n_errors, json``. ``nth`` tells calls apart that share an id: the first goes with the
    first result and so on, by turn, place and content. ``status`` is ``answered``, ``early`` (the
    result does not stand behind the call), ``unanswered`` or ``orphan``. In order of ``depth``,
    ``turn`` and ``nth`` each call follows those it comes after; see ``depths``, where an id that
    is used more than once stands for its first call. ``json`` is the canonical form of the call
    with its result; arguments that are no JSON, or that ``parsed`` rejects, stay a string and count as an error. Null ids are
    never linked: such a call is unanswered, such a result is no result. Null texts are null
    results. Repeated rows are further calls and results. ``tools`` has a JSON schema per name.

    A conversation is never gathered: rows are dealt by conversation and id.
    """
    call = messages.select("conv_id", "turn", F.posexplode("calls").alias("place", "call")).select(
        "conv_id", F.col("call.id").alias("call_id"), F.col("turn").alias("call_turn"), "place",
        "call.name", "call.arguments", "call.after", F.lit(1).alias("called"))
    same = Window.partitionBy("conv_id", "call_id")
    call = call.withColumn("nth", F.row_number().over(
        same.orderBy("call_turn", "place", "name", "arguments", "after")))
    call = materialise(call.drop("place"), "calls")
    result = messages.where("answers is not null").select(
        "conv_id", F.col("answers").alias("call_id"), F.col("turn").alias("result_turn"),
        F.col("text").alias("result"), F.lit(1).alias("replied"))
    result = result.withColumn("nth", F.row_number().over(same.orderBy("result_turn", "result")))
    order = depths(call.where("nth = 1 and conv_id is not null and call_id is not null"))
    # Both sides are dealt by the identifier and meet in a hash table per part.
    both = call.join(result.hint("shuffle_hash"), ["conv_id", "call_id", "nth"], "full").join(
        order.hint("shuffle_hash"), ["conv_id", "call_id"], "left")
    status = F.when(F.col("called").isNull(), "orphan").when(
        F.col("replied").isNull(), "unanswered").when(
        F.col("result_turn") > F.col("call_turn"), "answered").otherwise("early")
    rows = both.select(
        "conv_id", "call_id", "nth", status.alias("status"), "depth",
        F.coalesce("call_turn", "result_turn").alias("turn"), "name", "arguments", "result",
        F.col("called").isNotNull().alias("called"))

    def serialise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            wrong, texts = [], []
            for row in frame.itertuples(index=False):
                said = {"id": row.call_id, "result": row.result}
                found: list[str] = []
                if row.called:
                    value, found = judged(row.name, row.arguments, tools)
                    said |= {"name": row.name, "arguments": value}
                wrong.append(len(found))
                texts.append(canonical(said))
            yield frame[["conv_id", "call_id", "nth", "status", "depth", "turn", "name"]].assign(
                n_errors=wrong, json=texts)

    return rows.mapInPandas(
        serialise, "conv_id long, call_id string, nth int, status string, depth long, turn long, "
                   "name string, n_errors long, json string")


#: Tools of the chats that ``request_messages`` makes.
REQUEST_TOOLS = {
    "search": {"type": "object", "required": ["length", "query"], "additionalProperties": False,
               "properties": {"query": {"type": "string", "minLength": 20},
                              "length": {"type": "integer", "minimum": 1}}},
    "read": {"type": "object", "required": ["length", "query"], "additionalProperties": False,
             "properties": {"query": {"type": "string", "minLength": 1},
                            "length": {"type": "integer", "maximum": 1000}}},
}


def request_messages(turns: DataFrame) -> DataFrame:
    """Messages with tool calls from plain ``conversations``.

    A user's turn calls ``search`` with its text, or ``read`` beyond 200 characters, after the
    call two turns before it; an assistant's turn is the result of the turn before it.
    """
    asked = F.col("role") == "user"
    name = F.when(F.length("text") > 200, "read").otherwise("search")
    arguments = F.to_json(F.struct(F.length("text").alias("length"), F.col("text").alias("query")))
    after = F.when(F.col("turn") >= 2, F.concat(F.lit("c"), F.col("turn") - 2))
    call = F.struct(F.concat(F.lit("c"), "turn").alias("id"), name.alias("name"),
                    arguments.alias("arguments"), after.alias("after"))
    return turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text",
        F.when(asked, F.array(call)).alias("calls"),
        F.when(F.col("role") == "assistant", F.concat(F.lit("c"), F.col("turn") - 1))
        .alias("answers"))
