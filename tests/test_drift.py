import json

from corpusloom.operators import drift


def lines(spark, rows):
    return spark.createDataFrame(
        [(i, t, f, p, d, n, "2024-01-01", b, "extra") for i, (t, f, p, d, n, b) in enumerate(rows)],
        "record_no long, table_name string, feed string, file_path string, batch_day string, line_no int, arrived_at string, body string, field_path string",
    )


def record(uuid="a8098c1a-f86e-11da-bd1a-00112444be1e", **more):
    return {"uuid": uuid, "turns": 3, "messages": [{"role": "user", "content": "What do I need to know about the crop?"}], "tools": [{"name": "water_level", "description": "Tells how high the water is today."}], **more}


def changes(spark, *files):
    rows = [("t", "f", f"f/{k}.jsonl", f"2024-01-{k + 1:02d}", n, b if isinstance(b, (str, type(None))) else json.dumps(b)) for k, bodies in enumerate(files) for n, b in enumerate(bodies)]
    return sorted((r["file_path"], r["field_path"], r["change"], r["old_path"]) for r in drift.schema_changes(lines(spark, rows)).collect())


def test_renamed_added_removed_and_types(spark):
    first, second = record(license="odc-by"), record(license="odc-by", lang="de")
    second["record_id"] = second.pop("uuid").replace("1a", "2b")
    third = dict(second, turns="3")
    del third["license"]
    assert changes(spark, [first, first], [second], [third]) == [
        ("f/1.jsonl", "lang", "added", None), ("f/1.jsonl", "record_id", "renamed", "uuid"),
        ("f/2.jsonl", "license", "removed", None), ("f/2.jsonl", "turns", "type_changed", None),
    ]


def test_moves_into_function(spark):
    wrapped = record()
    wrapped["tools"] = [{"type": "function", "function": wrapped["tools"][0]}]
    assert changes(spark, [record()], [wrapped]) == [
        ("f/1.jsonl", "tools.function.description", "renamed", "tools.description"), ("f/1.jsonl", "tools.function.name", "renamed", "tools.name"), ("f/1.jsonl", "tools.type", "added", None),
    ]


def test_gone_and_new_fields_with_other_content_are_no_rename(spark):
    a, b = record(created_at=1731673158), record(lang="de")
    assert changes(spark, [a], [b]) == [("f/1.jsonl", "created_at", "removed", None), ("f/1.jsonl", "lang", "added", None)]


def test_null_has_no_type_but_is_a_field(spark):
    a, b = record(lang=None), record(lang="de")
    assert changes(spark, [a], [b]) == [("f/1.jsonl", "lang", "type_changed", None)]
    assert changes(spark, [a], [record()]) == [("f/1.jsonl", "lang", "removed", None)]


def test_bad_lines_repeats_and_order(spark):
    a, b = record(), record(lang="de")
    assert changes(spark, [a, a, "# end", None, "null", "[1]", '{"uuid": '], [b, "  ", b]) == [("f/1.jsonl", "lang", "added", None)]
    assert changes(spark, [a], ["# nothing"], [a])[0] == ("f/1.jsonl", "messages.content", "removed", None)


def test_empty_table_null_feed_and_long_value(spark):
    assert drift.schema_changes(lines(spark, [])).count() == 0
    rows = [("t", None, "a", "1", 0, json.dumps(record())), ("t", None, "b", "2", 0, json.dumps(record(note="x " * 300_000)))]
    assert [(r["field_path"], r["change"]) for r in drift.schema_changes(lines(spark, rows)).collect()] == [("note", "added")]


def test_unified_records(spark):
    a, b = record(), record()
    b["record_id"] = b.pop("uuid")
    b["tools"] = [{"type": "function", "function": b["tools"][0]}]
    rows = [("t", "f", "f/0", "2024-01-01", 1, json.dumps(a)), ("t", "f", "f/0", "2024-01-01", 2, json.dumps(a)), ("t", "f", "f/0", "2024-01-01", 2, json.dumps(a)), ("t", "f", "f/1", "2024-01-02", 1, json.dumps(b)), ("t", "f", "f/1", "2024-01-02", 2, "# end")]
    got = drift.unified_records(lines(spark, rows)).collect()
    assert len(got) == 3
    for r in got:
        assert r["record"]["uuid"] == a["uuid"] and r["record"]["turns"] == 3.0
        assert r["record"]["tools"][0]["name"] == "water_level"


def test_unified_records_lose_no_content(spark):
    one = record(messages={"role": "user", "content": "What is it?"})
    one["tools"] = [{"name": "outer", "function": {"name": "inner"}}]
    rows = [("t", "f", "f/0", "2024-01-01", None, json.dumps(one)), ("t", "f", "f/0", "2024-01-01", None, json.dumps(one))]
    got = drift.unified_records(lines(spark, rows)).collect()
    assert len(got) == 2
    for r in got:
        assert [m["content"] for m in r["record"]["messages"]] == ["What is it?"]
        assert r["record"]["tools"][0].asDict() == {"name": "outer", "function.name": "inner"}


def test_flooding_prefers_the_same_content(spark):
    s = lambda *v: (1, sum((sketch(x) for x in v)))

    def sketch(value):
        import numpy as np

        out = np.zeros(drift.SKETCH, np.float32)
        for place, w in drift._kinds(value):
            out[place] += w
        return out

    before = {"spdx": s("odc-by", "mit"), "uuid": s("a8098c1a-f86e-11da-bd1a-00112444be1e")}
    after = {"licence": s("mit", "odc-by"), "id": s("b8098c1a-f86e-11da-bd1a-00112444be1f")}
    assert drift.match_fields(before, after) == [("spdx", "licence"), ("uuid", "id")]


def test_what_is_a_json_object():
    assert drift._as_object('{"a": 1}') == {"a": 1}
    for body in (None, "", "  ", "null", "[]", "1", '{"a": NaN}', '{"a": 1} x', "{'a': 1}", "﻿{}"):
        assert drift._as_object(body) is None
