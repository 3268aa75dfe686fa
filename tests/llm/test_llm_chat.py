"""Linking, ordering, validation and canonical JSON against a plain Python version."""

import json

from encore.llm.chat import SCHEMAS, format_calls, traffic
from encore.llm.queries import QUERIES

from conftest import SMALL

SCHEMA = "conv_id long, turn long, role string, text string, level string, uid int"


def _parse(text):
    def once(pairs):
        if len({k for k, _ in pairs}) < len(pairs):
            raise ValueError("repeated name")
        return dict(pairs)
    try:
        value = json.loads(text, object_pairs_hook=once)
    except (TypeError, ValueError):
        return {}
    return value if isinstance(value, dict) else {}


def _errors(name, arguments):
    if not isinstance(arguments, dict):
        return ["arguments"]
    if name not in SCHEMAS:
        return ["unknown tool"]
    schema, out = SCHEMAS[name], []
    kinds = {"string": str, "boolean": bool, "integer": int, "number": (int, float)}
    for p, rule in sorted(schema["properties"].items()):
        if p not in arguments:
            out += [f"missing {p}"] * (p in schema["required"])
            continue
        v = arguments[p]
        if not isinstance(v, kinds[rule["type"]]) or (isinstance(v, bool) and rule["type"] != "boolean"):
            out.append(f"type of {p}")
        elif "minimum" in rule and v < rule["minimum"] or "maximum" in rule and v > rule["maximum"]:
            out.append(f"range of {p}")
        elif "enum" in rule and v not in rule["enum"]:
            out.append(f"value of {p}")
    return out + [f"unknown {k}" for k in sorted(set(arguments) - set(schema["properties"]))]


def _brute(messages):
    calls, results = [], []
    for conv, turn, role, text, *_ in messages:
        v = _parse(text)
        if role == "assistant" and isinstance(v.get("tool_calls"), list):
            for k, c in enumerate(v["tool_calls"]):
                if isinstance(c, dict) and c.get("id") is not None and c.get("name") is not None:
                    calls.append((conv, turn, k, c["id"], c["name"], c.get("arguments"), set(c.get("after") or [])))
        if role == "tool" and v.get("call_id") is not None:
            results.append((conv, turn, v["call_id"], v.get("content")))
    level, named = {}, {}
    for n, c in enumerate(calls):
        named.setdefault((c[0], c[3]), []).append(n)
    waits = [[named.get((c[0], a), []) for a in c[6]] for c in calls]
    while True:
        new = {}
        for n, deps in enumerate(waits):
            if n in level:
                continue
            if all(d and all(m in level for m in d) for d in deps):
                new[n] = max((level[m] + 1 for d in deps for m in d), default=0)
        if not new:
            break
        level |= new
    out = []
    for n, (conv, turn, k, i, name, arguments, _) in enumerate(calls):
        mine = [r for r in results if r[0] == conv and r[2] == i]
        late = min(((r[1], r[3]) for r in mine if r[1] > turn), default=(None, None))
        errors = _errors(name, arguments)
        text = json.dumps({"arguments": arguments, "call_id": i, "content": late[1], "errors": errors, "level": level.get(n),
                           "name": name, "valid": not errors}, separators=(",", ":"), sort_keys=True, ensure_ascii=False)
        out.append((conv, turn, k, i, name, level.get(n), late[0], len(mine), errors, not errors, text))
    return sorted(out, key=repr)


def _got(df):
    return sorted((tuple(r) for r in df.select("conv_id", "turn", "position", "call_id", "name", "level", "result_turn", "n_results",
                                               "errors", "valid", "json").collect()), key=repr)


def test_derived_traffic_matches_brute_force(spark):
    messages = traffic(spark.read.parquet(f"{SMALL}/conversations.parquet"))
    assert _got(format_calls(messages, SCHEMAS)) == _brute([tuple(r) for r in messages.collect()])


def test_edge_cases(spark):
    call = lambda **k: json.dumps({"tool_calls": [k]})
    rows = [
        (1, 1, "assistant", call(id="a", name="search", arguments={"query": "q", "limit": 3}, after=["b"])),
        (1, 3, "assistant", call(id="b", name="fetch", arguments={"page": 1.5, "raw": True, "z": 1, "y": None})),
        (1, 2, "tool", json.dumps({"call_id": "a", "content": "second"})), (1, 2, "tool", json.dumps({"call_id": "a", "content": "first"})),
        (1, 0, "tool", json.dumps({"call_id": "a", "content": "early"})), (1, 9, "tool", json.dumps({"call_id": "nobody"})),
        (2, 1, "assistant", call(id="a", name="search", arguments={"query": 5, "limit": 21, "mode": "loose"}, after=["a"])),
        (2, 1, "assistant", call(id="x", name="search", arguments=[1], after=["gone"])),
        (3, 1, "assistant", "not json"), (3, 1, "assistant", None), (3, 2, None, "{}"), (3, 1, "assistant", '{"tool_calls": 7}'),
        (3, 1, "assistant", call(name="search", arguments={})), (3, 1, "assistant", call(id="n")),
        (None, 1, "assistant", call(id="a", name="fetch", arguments={"page": -1})), (None, 2, "tool", json.dumps({"call_id": "a", "content": "c"})),
        (4, 1, "assistant", call(id="d", name="nope", arguments={})), (4, 1, "assistant", call(id="d", name="fetch", arguments={"page": 2})),
        (4, 2, "assistant", call(id="e", name="fetch", arguments={"page": 3}, after=["d", "d"])),
        (4, 3, "tool", json.dumps({"call_id": "d", "content": "x" * 100_000})),
        (5, 1, "assistant", call(id="f", name="fetch", arguments={"page": 1}, after=["g"])),
        (5, 1, "assistant", call(id="g", name="fetch", arguments={"page": 1}, after=["f"])),
    ]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(3)
    assert _got(format_calls(df, SCHEMAS)) == _brute(rows)
    assert format_calls(df.limit(0), SCHEMAS).count() == 0


def test_hot_conversation(spark):
    rows = [(7 if n % 3 else n, n, "assistant", json.dumps({"tool_calls": [{"id": f"c{n}", "name": "fetch", "arguments": {"page": n}}]})) for n in range(300)]
    df = spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA)
    assert _got(format_calls(df, SCHEMAS)) == _brute(rows)


def test_chains_and_joins(spark):
    """A chain of 1000 calls, chains that meet, cycles with tails, a hole in a chain."""
    def call(conv, turn, i, *after):
        return conv, turn, "assistant", json.dumps({"tool_calls": [{"id": i, "name": "fetch", "arguments": {"page": turn}, "after": list(after)}]})
    rows = [call(1, k, f"c{k}", *[f"c{k - 1}"] * (k > 0)) for k in range(1000)]
    rows += [call(2, k, f"c{k}", *(f"c{j}" for j in (k - 1, k // 2) if 0 <= j < k)) for k in range(12)]
    rows += [call(3, k, f"a{k}", f"a{(k + 1) % 7}") for k in range(7)] + [call(3, 10 + k, f"t{k}", f"t{k - 1}" if k else "a3") for k in range(5)]
    rows += [call(4, k, f"c{k}", f"c{k - 1}" if k != 5 else "hole") for k in range(1, 12)]
    rows += [call(5, 0, "r"), *(call(5, k, f"x{k}", f"x{k - 1}" if k > 1 else "r") for k in range(1, 9)),
             *(call(5, k, f"y{k}", f"y{k - 1}" if k > 1 else "r") for k in range(1, 4)), call(5, 20, "m", "x8", "y3"),
             *(call(5, 20 + k, f"z{k}", f"z{k - 1}" if k > 1 else "m") for k in range(1, 6)), call(5, 40, "n", "z5", "m", "r")]
    df = spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA).repartition(3)
    assert _got(format_calls(df, SCHEMAS)) == _brute(rows)


def test_names_with_dots(spark):
    schemas = {"t": {"required": ["a.b"], "properties": {"a.b": {"type": "integer", "maximum": 3}, "a": {"type": "string"}}}}
    rows = [(1, k, "assistant", json.dumps({"tool_calls": [{"id": f"c{k}", "name": "t", "arguments": a}]}))
            for k, a in enumerate([{"a.b": 1}, {"a.b": 9}, {"a": "x"}, {"a": "x", "a.b": "y"}])]
    out = {r.turn: r.errors for r in format_calls(spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA), schemas).collect()}
    assert out == {0: [], 1: ["range of a.b"], 2: ["missing a.b"], 3: ["type of a.b"]}


def test_nested_schemas(spark):
    schemas = {"t": {"required": ["where"], "properties": {
        "tags": {"type": "array", "items": {"type": "string"}},
        "where": {"type": "object", "required": ["city"], "properties": {
            "city": {"type": "string", "enum": ["it's", "b"]}, "at": {"type": "object", "properties": {"x": {"type": "number", "maximum": 1}}}}}}}}
    cases = [({"where": {"city": "b"}}, []), ({"where": {}}, ["missing where.city"]), ({"where": 3}, ["type of where"]), ({}, ["missing where"]),
             ({"where": {"city": "it's", "at": {"x": 2, "z": 0}, "y": 1}}, ["unknown where.y", "range of where.at.x", "unknown where.at.z"]),
             ({"where": {"city": "c", "at": 1}, "tags": ["a", 1]}, ["items of tags", "type of where.at", "value of where.city"]),
             ({"where": {"city": None}, "tags": []}, ["type of where.city"])]
    rows = [(1, k, "assistant", json.dumps({"tool_calls": [{"id": f"c{k}", "name": "t", "arguments": a}]}), "", 0) for k, (a, _) in enumerate(cases)]
    out = {r.turn: r.errors for r in format_calls(spark.createDataFrame(rows, SCHEMA), schemas).collect()}
    assert out == {k: e for k, (_, e) in enumerate(cases)}


def test_whole_texts_travel(spark):
    rows = [(1, 0, "user", "q", "", 0), (1, 1, "assistant", "word " * 4001 + "end", "", 0), (1, 2, "user", "answer " * 5000 + "end", "", 0)]
    out = format_calls(traffic(spark.createDataFrame(rows, SCHEMA)), SCHEMAS).collect()
    assert [json.loads(r.json)["content"] for r in out] == [rows[2][3]]
    assert [json.loads(r.json)["arguments"]["query"] for r in out if r.name == "search"] == [rows[1][3]] * sum(r.name == "search" for r in out)


def test_query_columns(spark):
    out = QUERIES["op2_chat_format"](spark, SMALL)
    assert {"conv_id", "turn", "call_id", "level", "errors", "valid", "json"} <= set(out.columns)
