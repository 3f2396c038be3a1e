from corpusloom.operators import flatten

SCHEMA = "record_no long, uuid string, messages array<struct<role:string,content:string,reasoning_content:string,tool_call_id:string,tool_calls:array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>>>, tools array<struct<type:string,name:string,description:string,parameters:string,function:struct<name:string,description:string,parameters:string>>>"


def call(i, name):
    return (i, "function", (name, "{}"))


def message(role, tool_call_id=None, calls=None):
    return (role, "x", None, tool_call_id, calls)


def tool(top=None, inner=None):
    return ("function", top, None, None, (inner, None, None) if inner else None)


def links(spark, rows):
    return sorted(tuple(r) for r in flatten.call_links(spark.createDataFrame(rows, SCHEMA)).collect())


def test_links(spark):
    messages = [message("user"), message("assistant", calls=[call("A1", "f"), call("a2", "none"), call(None, "g")]), message("tool", " a1\n"), message("tool", "a9"), message("tool", None), message("assistant", calls=[call("a1", "g")]), message("tool", "A1"), message("tool", "  ")]
    assert links(spark, [(1, "u", messages, [tool("f"), tool(None, "g"), tool("g"), tool("f")])]) == [
        (1, "orphan_call", 1, 1, -1), (1, "orphan_reply", 3, -1, -1), (1, "orphan_reply", 4, -1, -1), (1, "orphan_reply", 7, -1, -1), (1, "reply", 1, 0, 2), (1, "reply", 5, 0, 6),
        (1, "tool", 1, 0, 0), (1, "tool", 1, 2, 1), (1, "tool", 5, 0, 1),
    ]


def test_an_answer_before_its_call_is_an_orphan(spark):
    assert links(spark, [(1, None, [message("tool", "c"), message("assistant", calls=[call("c", "F")])], [tool("f")])]) == [(1, "orphan_call", 1, 0, -1), (1, "orphan_reply", 0, -1, -1)]


def test_nulls_and_empty(spark):
    assert links(spark, []) == []
    assert links(spark, [(1, None, None, None), (2, None, [], []), (3, None, [message(None)], None), (4, None, [message("assistant", calls=[])], [tool()])]) == []
    assert links(spark, [(5, None, [message("assistant", calls=[("x", None, None)])], None)]) == [(5, "orphan_call", 0, 0, -1)]


def test_tables_keep_links_and_clashing_names(spark):
    df = spark.createDataFrame([(1, ("a", [("b", [1, 2])]), "c"), (2, None, "d"), (3, ("e", None), None)], "k long, X struct<y:string,items:array<struct<K:string,ns:array<int>>>>, x_y string")
    tables = flatten.flat_tables(df, ["k"])
    assert set(tables) == {"records", "X_items", "X_items_ns"}
    assert tables["records"].columns == ["k", "X_y", "x_y_2"]
    assert [tuple(r) for r in tables["X_items"].collect()] == [(1, 0, "b")]
    assert tables["X_items"].columns == ["k", "X_items_pos", "K_2"]
    assert sorted(tuple(r) for r in tables["X_items_ns"].collect()) == [(1, 0, 0, 1), (1, 0, 1, 2)]


def test_json_records_get_one_merged_schema(spark):
    lines = ['{"id": 1, "a": {"b": [{"c": 1}, {"c": 2.5, "d": [1, 2]}]}, "x": "t"}', '{"id": 2, "a": {"b": []}, "x": 7, "m": null}', "no json", "[1]", None, '{"id": 3, "e": {}, "KEY": true}', '{"id": 3, "e": {}, "KEY": true}']
    df = spark.createDataFrame([(i % 5, x) for i, x in enumerate(lines)], "key int, body string")
    schema = flatten.merged_schema(df, "body")
    assert schema.simpleString().lower() == "struct<key:boolean,a:struct<b:array<struct<c:double,d:array<bigint>>>>,e:string,id:bigint,m:string,x:string>"
    records = flatten.with_row_key(flatten.records_of(df, "body", ["key"]))
    assert records.columns == ["key", "KEY_2", "a", "e", "id", "m", "x", "row_key"] and records.count() == 4
    tables = flatten.flat_tables(records, ["row_key"])
    assert set(tables) == {"records", "a_b", "a_b_d"}
    assert tables["records"].select("row_key").distinct().count() == 4  # the last two are alike but for their key
    items = tables["a_b"].join(tables["records"].select("row_key", "id", "x"), "row_key")
    assert sorted((r["id"], r["a_b_pos"], r["c"]) for r in items.collect()) == [(1, 0, 1.0), (1, 1, 2.5)]
    assert [(r["a_b_pos"], r["a_b_d_pos"], r["value"]) for r in tables["a_b_d"].orderBy("a_b_d_pos").collect()] == [(1, 0, 1), (1, 1, 2)]
    nothing = df.where("false")
    assert flatten.merged_schema(nothing, "body").fields == [] and flatten.records_of(nothing, "body", ["key"]).columns == ["key"]


def test_maps_are_tables(spark):
    df = spark.createDataFrame([(1, {"a": [1, 2], "b": None}, [{"x": 1}]), (2, None, [])], "k int, m map<string,array<int>>, l array<map<string,int>>")
    tables = flatten.flat_tables(df, ["k"])
    assert sorted((r["k"], r["m_pos"], r["key"]) for r in tables["m"].collect()) == [(1, 0, "a"), (1, 1, "b")]
    assert sorted((r["k"], r["m_pos"], r["m_value_pos"], r["value"]) for r in tables["m_value"].collect()) == [(1, 0, 0, 1), (1, 0, 1, 2)]
    assert [(r["key"], r["value"]) for r in tables["l_entries"].collect()] == [("x", 1)]
