"""Chat formatting with linked tool calls.

A message whose text is a JSON object may carry ``tool_calls`` (a list of objects with
``id``, ``name``, ``arguments`` and optionally ``after``, ids it waits for) or, as a tool's
answer, ``tool_call_id``. A call may also be nested as ``{"id", "function": {"name",
"arguments"}}``, ids may be integers (``7`` and ``"7"`` are one id) and blanks may stand
before the object. Calls and answers of a conversation meet in a hash join on
(conversation, id). Messages are ordered topologically: a call comes after the calls named
in ``after`` and after those whose id an argument quotes as ``{"$ref": id}``, an answer
after its call; levels are found by passing the largest known level along these links until
nothing changes, where a chain takes a round for each doubling of its length. Arguments are
checked against JSON schemas by tool name. Every message becomes one row of canonical JSON:
sorted keys, no spaces, UTF-8, whole numbers as integers.

Defined results: null texts become the empty string, null roles ``unknown``; text that is
no such JSON object is an ordinary message, and so is one with numbers that are not finite
or nesting over 100; arguments like that are invalid; half characters stand as escapes; a
missing link leaves ``linked`` false; links in a circle leave ``level`` null; of repeated
ids the earliest call is the one linked; calls without schema are valid when their
arguments are an object; repeated rows stay; rows are never gathered by conversation, so a
conversation may be of any length; empty tables give no rows; extra columns are ignored.
"""

import json
import math
import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

PARSED = "json string, calls array<struct<id:string,name:string,valid:boolean,needs:array<string>>>, answers string"
KINDS = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list, "null": type(None)}


#: Arrays and objects within each other; what is nested deeper is no JSON here.
DEPTH = 100


def _plain(text: str) -> str:
    """Half characters (surrogates of a JSON escape that lacks its other half) as their escapes."""
    return re.sub("[\ud800-\udfff]", lambda m: f"\\u{ord(m[0]):04x}", text)


def canonical(value) -> str:
    return _plain(json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False))


def _number(text: str) -> int | float:
    """A JSON number with point or exponent; whole ones as integers, so that 1.0, 1e0 and 1 are one."""
    x = float(text)
    if x in (math.inf, -math.inf):
        raise ValueError("beyond a double")
    return int(x) if x.is_integer() and abs(x) < 1 << 53 else x


def _no_number(text: str):
    raise ValueError(f"{text} is no JSON")


def read(text: str):
    """The JSON value of a text; ValueError where there is none, a number is not finite or the nesting is over ``DEPTH``."""
    try:
        value = json.loads(text, parse_float=_number, parse_constant=_no_number)
    except RecursionError as e:
        raise ValueError("nested too deep") from e
    level = [value]
    for _ in range(DEPTH):
        level = [y for x in level if isinstance(x, dict | list) for y in (x.values() if isinstance(x, dict) else x)]
        if not level:
            return value
    raise ValueError("nested too deep")


def fits(value, schema: dict) -> bool:
    """Whether ``value`` meets a JSON schema (type, enum, properties, required, additionalProperties, items, bounds)."""
    kind = schema.get("type")
    if kind is not None:
        kinds = kind if isinstance(kind, list) else [kind]
        whole = isinstance(value, float) and value.is_integer() and "integer" in kinds
        if not whole and not any(isinstance(value, KINDS[k]) and (k == "boolean" or not isinstance(value, bool)) for k in kinds):
            return False
    if "enum" in schema and value not in schema["enum"]:
        return False
    if isinstance(value, dict):
        props = schema.get("properties", {})
        if any(k not in value for k in schema.get("required", [])):
            return False
        if schema.get("additionalProperties") is False and any(k not in props for k in value):
            return False
        return all(fits(v, props[k]) for k, v in value.items() if k in props)
    if isinstance(value, list) and isinstance(schema.get("items"), dict):
        return all(fits(v, schema["items"]) for v in value)
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return schema.get("minimum", value) <= value <= schema.get("maximum", value)
    return True


def _id(value) -> str | None:
    """An id as text; None for what is no string or integer."""
    if isinstance(value, int) and not isinstance(value, bool):
        return str(value)
    return _plain(value) if isinstance(value, str) else None


def _refs(value) -> set[str]:
    if isinstance(value, dict):
        own = {_id(value.get("$ref"))} - {None}
        return own.union(*map(_refs, value.values()))
    return set().union(*map(_refs, value)) if isinstance(value, list) else set()


def parse(role: str | None, text: str | None, schemas: dict) -> dict:
    """Canonical JSON of one message, its calls and the call it answers."""
    text, role = text or "", role or "unknown"
    calls, answers, message = [], None, {"role": role, "content": text}
    if text.lstrip(" \t\r\n")[:1] == "{":
        try:
            body = read(text)
        except ValueError:
            body = {}
        if isinstance(body.get("tool_calls"), list):
            for c in body["tool_calls"]:
                own = _id(c.get("id")) if isinstance(c, dict) else None
                if own is not None:
                    f = c["function"] if isinstance(c.get("function"), dict) else c
                    args = f.get("arguments")
                    if isinstance(args, str):  # arguments are often sent as encoded JSON
                        try:
                            args = read(args)
                        except ValueError:
                            args = None
                    name = _plain(str(f.get("name")))
                    after = c.get("after") if isinstance(c.get("after"), list) else []
                    needs = sorted(({_id(x) for x in after} | _refs(args)) - {own, None})
                    calls.append({"id": own, "name": name, "valid": isinstance(args, dict) and fits(args, schemas.get(name, {})), "needs": needs})
        else:
            answers = _id(body.get("tool_call_id"))
        if calls or answers is not None:
            message = body | {"role": role}
    return {"json": canonical(message), "calls": calls, "answers": answers}


def link(conversations: DataFrame, schemas: dict | None = None) -> DataFrame:
    """Per message: conv_id, turn, role, json, n_calls, n_valid, answers, linked, call_turn, level."""
    schemas = schemas or {}

    @F.pandas_udf(PARSED)
    def parsed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for roles, texts in batches:
            yield pd.DataFrame([parse(r, t, schemas) for r, t in zip(roles, texts)], columns=["json", "calls", "answers"])

    m = conversations.select("conv_id", "turn", "role", parsed("role", "text").alias("m")).select("conv_id", "turn", "role", "m.*")
    m = stored(m, "chat-messages")
    call = m.select("conv_id", "turn", F.explode("calls").alias("c")).select("conv_id", "turn", "c.id", "c.needs")
    # a repeated id: the earliest call counts
    call = call.groupBy("conv_id", "id").agg(F.min(F.struct(F.col("turn").isNull().alias("z"), "turn", "needs")).alias("c"))
    call = stored(call.select("conv_id", "id", F.col("c.turn").alias("turn"), F.col("c.needs").alias("needs")), "chat-calls")
    levels = _levels(call).select(F.col("conv_id").alias("k_conv"), F.col("id").alias("k_id"), F.col("turn").alias("call_turn"), "level")
    lost = F.col("answers").isNull()
    out = m.where(~lost).join(levels, (F.col("answers") == F.col("k_id")) & F.col("conv_id").eqNullSafe(F.col("k_conv")), "left")
    out = out.withColumn("linked", F.col("k_id").isNotNull()).withColumn("level", F.col("level") + 1)
    own = m.where(lost & (F.size("calls") > 0)).select("conv_id", "turn", "role", "json", "calls", "answers", F.posexplode(F.col("calls.id")).alias("pos", "id"), F.xxhash64("json", "turn").alias("row"))
    own = own.join(levels, (F.col("id") == F.col("k_id")) & F.col("conv_id").eqNullSafe(F.col("k_conv")), "left")
    at = own.groupBy("conv_id", "turn", "row").agg(F.max("level").alias("level"), F.max(F.col("level").isNull()).alias("open"))
    at = at.select(F.col("conv_id").alias("a_conv"), F.col("turn").alias("a_turn"), "row", F.when(~F.col("open"), F.col("level")).alias("level"))
    calls_ = m.where(lost & (F.size("calls") > 0)).withColumn("r", F.xxhash64("json", "turn"))
    calls_ = calls_.join(at, (F.col("r") == F.col("row")) & F.col("conv_id").eqNullSafe(F.col("a_conv")) & F.col("turn").eqNullSafe(F.col("a_turn")), "left")
    plain = m.where(lost & (F.size("calls") == 0))
    n = F.size("calls").cast("long")
    valid = F.size(F.filter("calls", lambda c: c["valid"])).cast("long")
    cols = lambda linked, turn, level: ["conv_id", "turn", "role", "json", n.alias("n_calls"), valid.alias("n_valid"), "answers", linked.alias("linked"), turn.cast("long").alias("call_turn"), level.cast("long").alias("level")]
    none = F.lit(None)
    return (plain.select(*cols(F.lit(False), none, F.lit(0))).unionByName(calls_.select(*cols(F.lit(False), none, F.col("level"))))
            .unionByName(out.select(*cols(F.col("linked"), F.col("call_turn"), F.col("level")))))


def _levels(call: DataFrame) -> DataFrame:
    """Each call with its level: 0 without known needs, else two above the highest (the answer lies between).

    A call with one need points at it; pointers double until they stand on a call with none
    or several, so a chain of n calls takes log2(n) rounds. Calls with several needs get
    their levels round by round, as soon as all they need have theirs; each round writes the
    new ones only. What points into a circle, or waits for it, never gets a level.
    """
    need = call.select("conv_id", "id", F.explode("needs").alias("need"))
    c = call.select(F.col("conv_id").alias("n_conv"), F.col("id").alias("n_id"))
    need = stored(need.join(c, (F.col("need") == F.col("n_id")) & F.col("conv_id").eqNullSafe(F.col("n_conv")), "left_semi"), "chat-needs")
    waits = need.groupBy(F.col("conv_id").alias("w_conv"), F.col("id").alias("w_id")).agg(F.count("*").alias("n"), F.min("need").alias("to"))
    waits = stored(waits, "chat-waits")
    own = lambda a, b: (F.col(a) == F.col(b)) & F.col("conv_id").eqNullSafe(F.col("w_conv"))
    free = call.select("conv_id", "id", "turn").join(waits, own("id", "w_id"), "left_anti").withColumn("level", F.lit(0))
    if waits.isEmpty():
        return free
    single = waits.where("n = 1").select("w_conv", "w_id", "to")
    most = single.groupBy("w_conv").count().agg(F.max("count").alias("n")).first()["n"] or 0
    # (call, call it stands on, links between them); a pointer is home where it meets no single call
    open_, home, span = single.select(F.col("w_conv").alias("conv_id"), F.col("w_id").alias("id"), "to", F.lit(1).cast("long").alias("links")), [], 1
    while True:
        far = single.select(F.col("w_conv").alias("s_conv"), F.col("w_id").alias("s_id"))
        open_ = open_.join(far, (F.col("to") == F.col("s_id")) & F.col("conv_id").eqNullSafe(F.col("s_conv")), "left")
        open_ = stored(open_.select("conv_id", "id", "to", "links", F.col("s_id").isNull().alias("home")), "chat-pointers")
        home.append(open_.where("home").drop("home"))
        if span >= most or open_.where("not home").isEmpty():
            break
        jump = home[-1] if span == 1 else reduce(DataFrame.unionByName, home)
        jump = jump.unionByName(open_.where("not home").drop("home"))
        jump = jump.select(F.col("conv_id").alias("j_conv"), F.col("id").alias("j_id"), F.col("to").alias("j_to"), F.col("links").alias("j_links"))
        open_ = open_.where("not home").join(jump, (F.col("to") == F.col("j_id")) & F.col("conv_id").eqNullSafe(F.col("j_conv")))
        open_ = open_.select("conv_id", "id", F.col("j_to").alias("to"), (F.col("links") + F.col("j_links")).alias("links"))
        span *= 2
    home = reduce(DataFrame.unionByName, home)
    # (call with several needs, the call it rests on, links between them)
    rests = need.join(waits.where("n > 1").select("w_conv", "w_id"), own("id", "w_id"), "left_semi")
    h = home.select(F.col("conv_id").alias("w_conv"), F.col("id").alias("w_id"), F.col("to").alias("h_to"), "links")
    rests = rests.join(h, own("need", "w_id"), "left").select("conv_id", "id", F.coalesce("h_to", "need").alias("on"), F.coalesce("links", F.lit(0)).alias("links"))
    rests = stored(rests, "chat-rests")
    known, new, rest = [free.select("conv_id", "id", F.col("level").cast("long").alias("level"))], None, rests
    while not rest.isEmpty():
        new = known[-1].select(F.col("conv_id").alias("w_conv"), F.col("id").alias("w_id"), "level")
        # what rests on a call that got its level in the last round keeps that level
        rest = rest.join(new, own("on", "w_id"), "left") if "best" not in rest.columns else rest.join(new, own("on", "w_id"), "left").withColumn("level", F.coalesce("level", "best"))
        rest = stored(rest.select("conv_id", "id", "on", "links", F.col("level").alias("best")), "chat-rest")
        ready = rest.groupBy("conv_id", "id").agg(F.max(F.col("best") + 2 * F.col("links") + 2).alias("level"), F.max(F.col("best").isNull()).alias("open"))
        ready = stored(ready.where("not open").select("conv_id", "id", "level"), "chat-ready")
        if ready.isEmpty():
            break
        known.append(ready)
        gone = ready.select(F.col("conv_id").alias("w_conv"), F.col("id").alias("w_id"))
        rest = rest.join(gone, own("id", "w_id"), "left_anti")
    known = stored(reduce(DataFrame.unionByName, known), "chat-levels")
    base = known.select(F.col("conv_id").alias("w_conv"), F.col("id").alias("w_id"), F.col("level").alias("base"))
    chain = home.join(base, own("to", "w_id")).select("conv_id", "id", (F.col("base") + 2 * F.col("links")).alias("level"))
    levels = known.unionByName(chain).select(F.col("conv_id").alias("w_conv"), F.col("id").alias("w_id"), "level")
    return call.select("conv_id", "id", "turn").join(levels, own("id", "w_id"), "left").select("conv_id", "id", "turn", "level")


#: Tools of the derived calls; the row's hash deals them.
TOOLS = ("search", "quote", "count")


def derived(conversations: DataFrame) -> DataFrame:
    """The conversations as tool chats, one message per given row, each from its row alone.

    An assistant's turn becomes a call with id ``c<turn>`` and its text as content, the
    user's next turn its answer; first turns and other roles stay as they are. The rest of
    xxhash64(conv_id, turn) by 16 plants what goes wrong:

    0 no call, so the answer misses its call; 1 the id of the turn two before once more;
    2 ``limit`` as text; 3 no ``query``; 4 a limit above the schema's maximum; 5 arguments
    that are no JSON; 6 waits for the call two turns later; 7 quotes the call two turns
    before; 8 integer id in the flat form, blanks in front; 9 two calls in one message, the
    second after the first; 10 the user does not answer; 11 the user answers the call of the
    turn after, before it is made; 12 as 6 and 7, a circle where a neighbour does the same;
    others: a plain call.
    """
    kind = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(16))
    t, text = F.col("turn"), F.coalesce("text", F.lit(""))
    at = lambda n: F.concat(F.lit("c"), (t + n).cast("string"))
    tool = F.element_at(F.array(*map(F.lit, TOOLS)), (F.pmod(F.crc32(text.cast("binary")), F.lit(len(TOOLS))) + 1).cast("int"))
    words = F.size(F.split(F.trim(text), r"\s+"))
    limit = F.when(kind == 2, F.to_json(F.struct(words.cast("string").alias("x")))).otherwise(F.to_json(F.struct((words + F.when(kind == 4, 1_000_000_000).otherwise(0)).alias("x"))))
    limit = F.regexp_replace(limit, r'^\{"x":|\}$', "")
    query = F.regexp_replace(F.to_json(F.struct(F.substring(text, 1, 40).alias("x"))), r'^\{"x":|\}$', "")
    quoted = F.when(kind.isin(7, 12), F.concat(F.lit(',"from":{"$ref":"'), at(-2), F.lit('"}'))).otherwise("")
    args = F.concat(F.lit("{"), F.when(kind != 3, F.concat(F.lit('"query":'), query, F.lit(","))).otherwise(""), F.lit('"limit":'), limit, quoted, F.lit("}"))
    args = F.when(kind == 5, F.lit("{limit:")).otherwise(args)
    encoded = F.regexp_replace(F.to_json(F.struct(args.alias("x"))), r'^\{"x":|\}$', "")
    body = F.regexp_replace(F.to_json(F.struct(text.alias("x"))), r'^\{"x":|\}$', "")
    after = F.when(kind.isin(6, 12), F.concat(F.lit(',"after":["'), at(2), F.lit('"]'))).otherwise("")
    nested = lambda own, more: F.concat(F.lit('{"id":"'), own, F.lit('"'), more, F.lit(',"type":"function","function":{"name":"'), tool, F.lit('","arguments":'), encoded, F.lit("}}"))
    one = nested(F.when(kind == 1, at(-2)).otherwise(at(0)), after)
    flat = F.concat(F.lit('{"id":'), t.cast("string"), F.lit(',"name":"'), tool, F.lit('","arguments":'), args, F.lit("}"))
    two = F.concat(one, F.lit(","), nested(F.concat(F.lit("d"), t.cast("string")), F.concat(F.lit(',"after":["'), at(0), F.lit('"]'))))
    made = F.concat(F.when(kind == 8, F.lit(" \n")).otherwise(""), F.lit('{"content":'), body, F.lit(',"tool_calls":['), F.when(kind == 8, flat).when(kind == 9, two).otherwise(one), F.lit("]}"))
    before = F.pmod(F.xxhash64("conv_id", t - 1), F.lit(16))
    called = F.when(kind == 11, F.concat(F.lit('"'), at(1), F.lit('"'))).when(before == 8, (t - 1).cast("string")).otherwise(F.concat(F.lit('"'), at(-1), F.lit('"')))
    answer = F.concat(F.lit('{"content":'), body, F.lit(',"tool_call_id":'), called, F.lit("}"))
    known = F.col("conv_id").isNotNull() & t.isNotNull()
    calls, answers = known & (F.col("role") == "assistant") & (kind != 0), known & (F.col("role") == "user") & (t > 0) & (kind != 10)
    return conversations.select("conv_id", "turn", F.when(answers, "tool").otherwise(F.col("role")).alias("role"), F.when(calls, made).when(answers, answer).otherwise(F.col("text")).alias("text"), tool.alias("tool"), words.alias("words"))


def schema_table(chats: DataFrame) -> dict:
    """A JSON schema per tool of derived chats; a limit is at most the tool's longest text in words."""
    most = {r["tool"]: r["n"] for r in chats.groupBy("tool").agg(F.max("words").alias("n")).collect()}
    ref = {"type": "object", "properties": {"$ref": {"type": "string"}}, "required": ["$ref"], "additionalProperties": False}
    return {k: {"type": "object", "required": ["query", "limit"], "additionalProperties": False,
                "properties": {"query": {"type": "string"}, "limit": {"type": "integer", "minimum": 1, "maximum": n}, "from": ref}} for k, n in most.items()}


def op1_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole method: calls, answers and schemas derived from the given conversations."""
    chats = derived(table(spark, sf_dir, "conversations"))
    return link(chats, schema_table(chats))


def op1_tool_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "conversations"))


#: Covers messages without tool JSON, which is every message of the given table.
ORACLE_OP1 = """
SELECT conv_id, turn, role, '{"content":' || CAST(to_json(coalesce(text, '')) AS VARCHAR) || ',"role":' || CAST(to_json(coalesce(role, 'unknown')) AS VARCHAR) || '}' AS json,
       CAST(0 AS BIGINT) AS n_calls, CAST(0 AS BIGINT) AS n_valid, CAST(NULL AS VARCHAR) AS answers, false AS linked, CAST(NULL AS BIGINT) AS call_turn, CAST(0 AS BIGINT) AS level
FROM conversations
"""
