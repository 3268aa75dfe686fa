"""Chat formatting: linking, ordering, validating and serialising tool calls.

Messages are rows (conversation, turn, role, text).  An assistant message whose text is
a JSON object with a ``tool_calls`` array issues calls ``{"id", "name", "arguments",
"after": [ids]}``; a message with role ``tool`` whose text is ``{"call_id", "content"}``
is a result.  All other messages are left alone.

* *Linking*: calls and results meet in an equi-join on (conversation, identifier).  The
  first result after the call answers it; ``n_results`` counts all that name it.
* *Order*: ``level`` is 0 for a call that waits for no other, else one more than the
  highest level of the calls it names in ``after``; calls in or behind a cycle, or behind a
  call that does not exist, get no level.  Calls that wait for exactly one other form chains,
  whose ends are found by path doubling: a chain of n calls takes log n rounds of joins.  What
  is left are calls that wait for several; rounds over them alone, with whole chains as
  weighted edges, give the levels.  Sorting by (level, turn, position) is a topological
  order; no conversation is gathered into one task for it.
* *Validation*: arguments are held against the tool's schema (required names, types,
  ranges, allowed values, types of an array's items, no other names, and the same for objects
  within objects); ``errors`` lists what is wrong in order, an object's own first.
* *Serialisation*: ``json`` is canonical: sorted keys, no spaces, nulls left in.

Only DataFrame functions; JSON is handled as VARIANT.  Schemas are a parameter and
become expressions.  A hot conversation is split by its identifiers in the joins, and
by adaptive execution within them.

Edge cases: null or malformed texts, calls without an id or name and results without an
id issue nothing; a null conversation id is a conversation of its own; a call id used
again in a conversation stays several calls (all linked to the same results, and whoever
waits for the id waits for all of them); messages without calls or an empty table give no rows;
columns beside the four are dropped; an unknown tool is an error.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.sources.scratch import materialize, release

#: JSON type of a property -> pattern of the VARIANT types that satisfy it.
_TYPES = {
    "string": "STRING", "boolean": "BOOLEAN", "integer": "BIGINT", "number": r"BIGINT|DOUBLE|DECIMAL\(.*\)",
    "array": "ARRAY.*", "object": "OBJECT.*",
}
_KEY = ["conv", "call_id"]


def parse_calls(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """``conv``, ``turn``, ``position``, ``call_id``, ``name``, ``arguments`` (VARIANT), ``after`` (ids)."""
    parsed = (messages.where(F.col(role_col) == "assistant")
              .select(F.col(conv_col).cast("string").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                      F.try_parse_json(text_col).alias("v"))
              .select("conv", "turn", F.posexplode(F.expr("try_variant_get(v, '$.tool_calls', 'array<variant>')")).alias("position", "c")))
    return parsed.select("conv", "turn", "position",
                         F.expr("try_variant_get(c, '$.id', 'string')").alias("call_id"),
                         F.expr("try_variant_get(c, '$.name', 'string')").alias("name"),
                         F.expr("try_variant_get(c, '$.arguments', 'variant')").alias("arguments"),
                         F.expr("array_distinct(filter(try_variant_get(c, '$.after', 'array<string>'), x -> x IS NOT NULL))").alias("after")
                         ).where("call_id IS NOT NULL AND name IS NOT NULL")


def parse_results(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """``conv``, ``result_turn``, ``call_id``, ``content``."""
    return (messages.where(F.col(role_col) == "tool")
            .select(F.col(conv_col).cast("string").alias("conv"), F.col(turn_col).cast("long").alias("result_turn"),
                    F.try_parse_json(text_col).alias("v"))
            .select("conv", "result_turn", F.expr("try_variant_get(v, '$.call_id', 'string')").alias("call_id"),
                    F.expr("try_variant_get(v, '$.content', 'string')").alias("content")).where("call_id IS NOT NULL"))


def _same(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on conversation and identifier; null conversations are equal."""
    other = right.withColumnsRenamed({"conv": "r_conv", "call_id": "r_id"})
    return left.join(other, left["conv"].eqNullSafe(F.col("r_conv")) & (left["call_id"] == F.col("r_id")), how).drop("r_conv", "r_id")


def link(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Add ``result_turn`` and ``content`` of the first later result (of equal turns the smallest
    content), and ``n_results``."""
    # one row per turn on either side, so that repeated messages do not multiply
    asked = calls.select("conv", "call_id", "turn").distinct()
    told = results.groupBy("conv", "call_id", "result_turn").agg(F.min("content").alias("content"), F.count(F.lit(1)).alias("n"))
    late = F.when(F.col("result_turn") > F.col("turn"), F.struct("result_turn", "content"))
    answers = (_same(asked, told, "inner").groupBy("conv", "call_id", "turn")
               .agg(F.min(late).alias("answer"), F.sum("n").alias("n_results"))
               .withColumnsRenamed({"conv": "a_conv", "call_id": "a_id", "turn": "a_turn"}))
    same = (F.col("conv").eqNullSafe(F.col("a_conv")) & (F.col("call_id") == F.col("a_id")) & F.col("turn").eqNullSafe(F.col("a_turn")))
    return (calls.join(answers, same, "left")
                 .select(*calls.columns, "answer.result_turn", "answer.content",
                         F.coalesce("n_results", F.lit(0)).alias("n_results")))


def order(calls: DataFrame) -> DataFrame:
    """``uid`` and ``level`` of every call that can be ordered."""
    waits = calls.select("uid", "conv", F.explode("after").alias("call_id"))
    known = calls.select(F.col("uid").alias("dep"), "conv", "call_id")
    edges = materialize(_same(waits, known, "left").select("uid", "dep"), "chat-edges")
    counted = edges.groupBy("uid").agg(F.count(F.lit(1)).alias("n"), F.first("dep").alias("dep"))
    single = materialize(counted.where("n = 1 AND dep IS NOT NULL").select("uid", "dep"), "chat-single")
    chained = _chain_ends(single)
    roots = calls.select("uid").join(edges.select("uid").distinct(), "uid", "left_anti").withColumn("level", F.lit(0))
    # calls that wait for several, or for a call that is not there
    end = chained.select(F.col("uid").alias("dep"), "to", "steps")
    rest = materialize(edges.join(single.select("uid"), "uid", "left_anti").join(end, "dep", "left").select(
        "uid", F.coalesce("to", "dep").alias("dep"), (F.coalesce("steps", F.lit(0)) + 1).alias("steps"),
        F.lit(None).cast("int").alias("level")), "chat-rest")
    frontier = materialize(roots, "chat-levels")
    parts = [frontier]
    while not rest.isEmpty() and not frontier.isEmpty():
        at = frontier.select(F.col("uid").alias("at"), F.col("level").alias("found"))
        marked = materialize(rest.join(at, F.col("dep") == F.col("at"), "left").select(
            "uid", "dep", "steps", F.coalesce("level", F.col("found") + F.col("steps")).alias("level")), "chat-marked")
        # a call is ready when all the calls it waits for have a level
        ready = marked.groupBy("uid").agg(F.min(F.col("level").isNotNull()).alias("ready"), F.max("level").alias("level"))
        frontier = materialize(ready.where("ready").select("uid", "level"), "chat-levels")
        parts.append(frontier)
        release(rest)
        rest = materialize(marked.join(frontier.select("uid"), "uid", "left_anti"), "chat-rest")
        release(marked)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    behind = chained.join(out.withColumnRenamed("uid", "to"), "to").select("uid", (F.col("level") + F.col("steps")).alias("level"))
    release(edges, single, rest)
    return out.unionByName(behind)


def _chain_ends(single: DataFrame) -> DataFrame:
    """Of calls ``uid`` that wait for one other, ``dep``: the first call behind them that does not
    (``to``) and how many ``steps`` it is away; calls in or behind a cycle of such calls have none."""
    inner = single.select(F.col("uid").alias("i"))
    now = materialize(single.join(inner, F.col("dep") == F.col("i"), "left").select(
        "uid", F.col("dep").alias("to"), F.lit(1).alias("steps"), F.col("i").isNull().alias("ended")), "chat-chains")
    left, before = now.where("NOT ended").count(), -1
    # a round without a new end leaves cycles only: of a chain, the next call in line always gets one
    while left and left != before:
        on = now.select(F.col("uid").alias("via"), F.col("to").alias("end"), F.col("steps").alias("more"), F.col("ended").alias("over"))
        far = now.where("NOT ended").join(on, F.col("to") == F.col("via")).select(
            "uid", F.col("end").alias("to"), (F.col("steps") + F.col("more")).alias("steps"), F.col("over").alias("ended"))
        following = materialize(now.where("ended").unionByName(far), "chat-chains")
        release(now)
        now, before = following, left
        left = now.where("NOT ended").count()
    return now.where("ended").select("uid", "to", "steps")


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _checks(schema: Mapping, holder: str, names: str, where: str) -> str:
    """What is wrong with the object ``holder`` (VARIANT), whose names are ``names``: an SQL array of strings."""
    own, inner = [], []
    for p, rule in sorted(schema.get("properties", {}).items()):
        if '"' in p:
            raise ValueError(f"a property's name must not have quotation marks: {p}")
        path, shown = '$["' + p + '"]', where + p
        value = f"try_variant_get({holder}, {_lit(path)}, 'variant')"
        has = f"coalesce(array_contains({names}, {_lit(p)}), false)"
        is_type = lambda v, kind: f"coalesce(schema_of_variant({v}) RLIKE {_lit('^(' + _TYPES[kind] + ')$')}, false)"
        typed = is_type(value, rule["type"])
        if p in schema.get("required", ()):
            own.append(f"CASE WHEN NOT {has} THEN {_lit(f'missing {shown}')} END")
        own.append(f"CASE WHEN {has} AND NOT {typed} THEN {_lit(f'type of {shown}')} END")
        number = f"try_variant_get({value}, '$', 'double')"
        bounds = [f"{number} {sign} {rule[key]}" for key, sign in (("minimum", "<"), ("maximum", ">")) if key in rule]
        if bounds:
            own.append(f"CASE WHEN {has} AND {typed} AND ({' OR '.join(bounds)}) THEN {_lit(f'range of {shown}')} END")
        if "enum" in rule:
            allowed = ", ".join(map(_lit, rule["enum"]))
            own.append(f"CASE WHEN {has} AND {typed} AND try_variant_get({value}, '$', 'string') NOT IN ({allowed}) THEN {_lit(f'value of {shown}')} END")
        if "items" in rule:
            each = f"exists(try_variant_get({value}, '$', 'array<variant>'), x -> NOT {is_type('x', rule['items']['type'])})"
            own.append(f"CASE WHEN {has} AND {typed} AND {each} THEN {_lit(f'items of {shown}')} END")
        if "properties" in rule:
            deeper = _checks(rule, value, f"json_object_keys(to_json({value}))", shown + ".")
            inner.append(f"CASE WHEN {has} AND {typed} THEN {deeper} ELSE CAST(array() AS array<string>) END")
    known = ", ".join(map(_lit, sorted(schema.get("properties", {})))) or "CAST(NULL AS string)"
    unknown = f"transform(array_sort(array_except({names}, array({known}))), x -> concat({_lit('unknown ' + where)}, x))"
    found = f"filter(array({', '.join(own) or 'CAST(NULL AS string)'}), x -> x IS NOT NULL)"
    return f"concat({', '.join([found, unknown, *inner])})"


def _errors(schemas: Mapping[str, Mapping]) -> Column:
    """What is wrong with ``arguments`` for the tool ``name``, as an array of strings."""
    cases = "".join(f" WHEN {_lit(tool)} THEN {_checks(schema, 'arguments', 'names', '')}" for tool, schema in sorted(schemas.items()))
    return F.expr(f"CASE WHEN names IS NULL THEN array('arguments') ELSE CASE name{cases} ELSE array('unknown tool') END END")


def format_calls(messages: DataFrame, schemas: Mapping[str, Mapping], conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A row per call: the conversation, ``turn``, ``position``, ``call_id``, ``name``, ``level``,
    ``result_turn``, ``n_results``, ``errors``, ``valid``, ``json``."""
    named = dict(conv_col=conv_col, turn_col=turn_col, role_col=role_col, text_col=text_col)
    # arguments travel as canonical JSON text
    calls = parse_calls(messages, **named).withColumn("arguments", F.to_json("arguments"))
    calls = materialize(calls.withColumn("uid", F.monotonically_increasing_id()), "chat-calls")
    levels = order(calls)
    linked = link(calls, parse_results(messages, **named))
    full = linked.join(levels.withColumnRenamed("uid", "l_uid"), F.col("uid") == F.col("l_uid"), "left")
    full = full.withColumn("names", F.json_object_keys("arguments")).withColumn("arguments", F.try_parse_json("arguments"))
    full = full.withColumn("errors", _errors(schemas)).withColumn("valid", F.size("errors") == 0)
    text = F.to_json(F.struct("arguments", "call_id", F.col("content").alias("content"), "errors", "level", "name", "valid"),
                     {"ignoreNullFields": "false"})
    kind = messages.schema[conv_col].dataType
    return full.select(F.col("conv").cast(kind).alias(conv_col), "turn", "position", "call_id", "name", "level",
                       "result_turn", "n_results", "errors", "valid", text.alias("json"))


# -- the registered query's messages -------------------------------------------------------

#: Tools of the derived traffic.
SCHEMAS = {
    "search": {"required": ["query", "limit"], "properties": {
        "query": {"type": "string"}, "limit": {"type": "integer", "minimum": 1, "maximum": 20},
        "mode": {"type": "string", "enum": ["exact", "fuzzy"]}}},
    "fetch": {"required": ["page"], "properties": {"page": {"type": "number", "minimum": 0}, "raw": {"type": "boolean"}}},
}


def traffic(conversations: DataFrame) -> DataFrame:
    """Messages with tool calls derived from plain conversations.

    Every assistant turn becomes a call whose tool, arguments (some of them wrong) and
    dependency follow from the turn's number and text; every other turn from 1 on becomes
    the result of the call one turn before it, whether there is one or not.  A call waits
    for the one two turns before it, so chains run the length of the conversation; every
    eleventh turn issues two calls, the first of which waits for the second as well.  Texts
    travel whole, as arguments and as results.
    """
    words = F.size(F.split(F.trim("text"), " +"))
    call = lambda turn: F.concat(F.lit("c"), F.coalesce(turn.cast("string"), F.lit("")))
    t = F.col("turn")
    search = F.struct((words % 25).alias("limit"), F.col("text").alias("query"),
                      F.when(t % 3 == 0, "fuzzy").when(t % 3 == 1, "loose").alias("mode"))
    fetch = F.struct(F.when(words % 2 == 0, F.to_json(F.struct(words.alias("page")))).otherwise(F.lit('{"raw":"yes"}')).alias("a"))
    arguments = F.when(words % 3 == 0, F.get_json_object(F.to_json(fetch), "$.a")).otherwise(F.to_json(search))
    name = F.when(words % 3 == 0, "fetch").when(words % 17 == 1, "browse").otherwise("search")
    ids = F.filter(F.array(F.when(t >= 2, call(t - 2)), F.when(t % 11 == 10, F.concat(call(t), F.lit("b")))), lambda c: c.isNotNull())
    after = F.to_json(ids)
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    one = F.concat(F.lit('{"id":'), quoted(call(t)), F.lit(',"name":'), quoted(name), F.lit(',"arguments":'), arguments,
                   F.lit(',"after":'), after, F.lit("}"))
    two = F.concat(F.lit(',{"id":'), quoted(F.concat(call(t), F.lit("b"))), F.lit(',"name":"fetch","arguments":{"page":0.5},"after":[]}'))
    issued = F.concat(F.lit('{"tool_calls":['), one, F.when(t % 11 == 10, two).otherwise(F.lit("")), F.lit("]}"))
    result = F.to_json(F.struct(call(t - 1).alias("call_id"), F.col("text").alias("content")))
    assistant = F.col("role") == "assistant"
    return conversations.where(assistant | (t >= 1)).select(
        "conv_id", "turn", F.when(assistant, "assistant").otherwise("tool").alias("role"),
        F.when(assistant, issued).otherwise(result).alias("text"))
