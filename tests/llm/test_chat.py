import json

from aerostat.llm import chat

TOOLS = [("search", "query", "string", True), ("search", "limit", "integer", False), ("pay", "amount", "number", True), ("pay", "to", "object", False), ("pay", "open", "boolean", None)]
CALLS = [
    (1, "a", 1, "search", '{"query": "x\\n\\"y", "limit": 3}', None), (1, "b", 3, "pay", '{"to": {"z": 1, "a": [2, {"q": null, "b": 1}]}, "amount": 5}', "a"), (1, "c", 5, "pay", '{"amount": "5"}', "b"),
    (1, "d", 7, "search", '{"limit": 2.5, "more": 1}', "c"), (2, "a", 1, "search", None, None), (2, "b", 2, "search", "[1]", "nowhere"), (2, "c", 3, "none", "{}", "b"), (2, "d", 4, None, '{"a": 1', None),
    (3, "p", 1, "search", '{"query":"1"}', "q"), (3, "q", 2, "search", '{"query":"2"}', "p"), (3, "r", 3, "search", '{"query":"3"}', "r"), (3, "s", 4, "search", '{"query":"4"}', "p"),
    (4, "x", 2, "search", '{"query":"late"}', None), (4, "x", 1, "search", '{"query":"first"}', None), (4, "x", 1, "search", '{"query":"first"}', None),
    (None, "a", 1, "search", '{"query":"0"}', None), (5, None, 1, "search", '{"query":"0"}', None)]
RESULTS = [(1, "a", "r1"), (1, "b", None), (1, "c", "ü"), (1, "d", "r4"), (2, "a", "ok"), (2, "zz", "lost"), (3, "p", ""), (4, "x", "b"), (4, "x", "a"), (None, "a", "n"), (9, None, "m")]


def frames(spark):
    return (spark.createDataFrame([(*c, "e", 1) for c in CALLS], "conv_id long, call_id string, turn int, name string, arguments string, after string, errors string, copies int"),
            spark.createDataFrame([(*r, "e") for r in RESULTS], "conv_id long, call_id string, content string, level string"),
            spark.createDataFrame(TOOLS, "name string, parameter string, type string, required boolean"))


def test_links_order_and_errors(spark):
    rows = chat.link_calls(*frames(spark)).collect()
    got = {(r.conv_id, r.call_id): (r.level, r.errors) for r in rows if "no_id" not in r.errors and r.conv_id != 4}
    assert got == {
        (1, "a"): (0, []), (1, "b"): (1, []), (1, "c"): (2, ["type:amount"]), (1, "d"): (3, ["missing:query", "type:limit", "unexpected:more"]),
        (2, "a"): (0, ["bad_arguments"]), (2, "b"): (0, ["bad_arguments", "no_result", "unknown_after"]), (2, "c"): (1, ["no_result", "unknown_tool"]), (2, "d"): (0, ["no_result", "unknown_tool"]),
        (2, "zz"): (None, ["no_call"]), (3, "p"): (None, ["cycle"]), (3, "q"): (None, ["cycle", "no_result"]), (3, "r"): (None, ["cycle", "no_result"]), (3, "s"): (None, ["cycle", "no_result"])}
    assert len([r for r in rows if r.errors == ["no_id"]]) == 4
    assert all(r.valid == (not r.errors) for r in rows)


def test_different_calls_and_results_of_one_id_are_all_kept(spark):
    rows = [r for r in chat.link_calls(*frames(spark)).collect() if r.conv_id == 4]
    got = sorted((json.loads(r.json)["arguments"]["query"] if r.name else None, json.loads(r.json)["result"], r.level, r.errors, r.copies) for r in rows if r.name)
    assert got == [("first", "a", 0, ["duplicate_id"], 2), ("late", "a", 0, ["duplicate_id"], 1)]
    assert [(json.loads(r.json)["result"], r.errors, r.copies) for r in rows if not r.name] == [("b", ["duplicate_result"], 1)]


def test_many_calls_and_results_of_one_id_do_not_multiply(spark):
    _, _, tools = frames(spark)
    calls = spark.createDataFrame([(1, "x", i, "search", '{"query":"q"}', None) for i in range(300)], "conv_id long, call_id string, turn int, name string, arguments string, after string")
    results = spark.createDataFrame([(1, "x", f"r{i % 200:03d}") for i in range(400)], "conv_id long, call_id string, content string")
    rows = chat.link_calls(calls, results, tools).collect()
    assert len(rows) == 300 + 199 and sum(r.copies for r in rows) == 300 + 2 * 199 and {r.json.count('"r000"') for r in rows if r.name} == {1}


def test_integers_by_value(spark):
    _, results, tools = frames(spark)
    texts = ["3.0", "99999999999999999999", "1e2", "-4", "2.5", '"3"', "true", "null"]
    calls = spark.createDataFrame([(1, str(i), i, "search", f'{{"query":"q","limit":{t}}}', None) for i, t in enumerate(texts)],
                                  "conv_id long, call_id string, turn int, name string, arguments string, after string")
    rows = {r.turn: "type:limit" in r.errors for r in chat.link_calls(calls, results.limit(0), tools).collect()}
    assert [rows[i] for i in range(len(texts))] == [False] * 4 + [True] * 4


def test_sql_keeps_them_too(spark, tmp_path):
    import duckdb
    data = [(1, 0, "user", "hello"), (1, 0, "user", "other words"), (1, 0, "user", "hello"), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"),
            (1, 2, "user", "and then"), (2, 1, "assistant", "x"), (2, 1, "assistant", "y"), (2, 6, "user", "far")]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    sql = con.sql(chat.OP4_SQL)
    got = chat.op4_tool_calls(spark, str(tmp_path)).select(*sql.columns).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, sql.fetchall())) and len(got) == 7


def test_json_is_canonical(spark):
    rows = {(r.conv_id, r.call_id): r.json for r in chat.link_calls(*frames(spark)).collect()}
    for text in rows.values():
        assert text == json.dumps(json.loads(text), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    b = json.loads(rows[1, "b"])
    assert b["arguments"] == {"amount": 5, "to": {"a": [2, {"b": 1, "q": None}], "z": 1}} and b["result"] is None and b["level"] == 1
    assert json.loads(rows[1, "a"])["arguments"]["query"] == 'x\n"y'


def test_long_chain_takes_few_rounds(spark):
    calls = spark.createDataFrame([(1, f"c{i}", i, "search", '{"query":""}', f"c{i - 1}" if i else None) for i in range(300)], "conv_id long, call_id string, turn int, name string, arguments string, after string")
    got = {r.call_id: r.level for r in chat.levels(calls.select("conv_id", "call_id", "after")).collect()}
    assert got == {f"c{i}": i for i in range(300)}


def test_empty_and_plan_without_python(spark):
    calls, results, tools = frames(spark)
    assert chat.link_calls(calls.limit(0), results.limit(0), tools).count() == 0
    plan = chat.link_calls(calls, results, tools)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
