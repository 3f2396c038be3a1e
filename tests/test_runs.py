"""Runs: markers, inventories, metrics, sweeps, file systems; and the command line's statuses."""

import json
import os

import pytest
from pyspark.sql import functions as F

from corpusloom import cli, config
from corpusloom.functions import text as T
from corpusloom.operators import adapters, explore, manifest, metrics, parse
from corpusloom.schema import PRETRAINING_SCHEMA, SFT_SCHEMA
from corpusloom.sources import discovery, readers, sinks


def test_inventory_of_finished_runs(tmp_path):
    for name, said in (("a", {"source": "news", "rows": 5}), ("b", {"source": "code", "rows": 3, "limit": 3}), ("c/d", {"rows": 0}), ("e", {"archive_name": "old", "rows": 1})):
        sinks.write_marker(str(tmp_path / name), said)
    assert len(config.find_finished(str(tmp_path))) == 4 and list(config.find_finished(str(tmp_path), "news")) == [str(tmp_path / "a")]
    kept, skipped = config.select_inventory(str(tmp_path))
    assert set(kept) == {str(tmp_path / "a"), str(tmp_path / "e")} and len(skipped) == 2
    assert list(config.select_inventory(str(tmp_path), ["old"])[0]) == [str(tmp_path / "e")]
    with pytest.raises(ValueError, match="code"):
        config.select_inventory(str(tmp_path), ["news", "code"])
    assert config.single_finished(str(tmp_path), "news").endswith("a")
    with pytest.raises(ValueError, match="4 finished"):
        config.single_finished(str(tmp_path))


def test_sweeps_and_jobs():
    assert config.sweep([("a", lambda: True), ("b", lambda: True)]) == ["a", "b"]
    with pytest.raises(ValueError, match="b is partial"):
        config.sweep([("a", lambda: True), ("b", lambda: False), ("c", lambda: 1 / 0)])
    results, failed = config.in_parallel({"x": lambda: 7, "y": lambda: 1 / 0})
    assert results == {"x": 7} and list(failed) == ["y"]


def test_observed_counts_add_up(spark):
    df, watch = metrics.observed(spark.range(10), "seen", rows=F.count(F.lit(1)), even=F.count_if(F.col("id") % 2 == 0))
    assert df.count() == 10 and watch.get == {"rows": 10, "even": 5}
    assert not metrics.reconcile_stages([metrics.Stage("a", 10, 8, 2, 10), metrics.Stage("b", 8, 8)])
    assert len(metrics.reconcile_stages([metrics.Stage("a", 10, 8, 1), metrics.Stage("b", 7, 7, declared=9)])) == 3


def test_files_on_a_hadoop_file_system(spark, tmp_path):
    (tmp_path / "web").mkdir()
    for name in ("web/a.jsonl", "web/b.log", "c.csv", "web/_hidden.json", "web/x.bin"):
        (tmp_path / name).write_text("{}")
    want = [(f"{tmp_path}/c.csv", tmp_path.name), (f"{tmp_path}/web/a.jsonl", "web"), (f"{tmp_path}/web/b.log", "web")]
    for root, session in ((str(tmp_path), None), (f"file://{tmp_path}", spark)):
        assert [(f["path"].removeprefix("file:").replace("///", "/"), f["source_dataset"]) for f in discovery.discover(root, session)] == want
    assert discovery.discover(f"file://{tmp_path}/c.csv", spark)[0]["source_dataset"] == "c"
    assert discovery.component("s3a://bucket/data/zone/part.parquet", [("/zone/", "z")]) == "z" and discovery.component("hdfs://x/data/cc/p.parquet") == "cc" and discovery.component("p.parquet") == "root"
    rows = spark.createDataFrame([("file:///d/one/a.parquet", 2), ("file:///d/one/b.parquet", 3), ("file:///d/two/c.parquet", 4)], "file_path string, rows long")
    assert {tuple(r) for r in discovery.rows_by_component(rows, [("d/two", "second")]).collect()} == {("one", 2, 5), ("second", 1, 4)}
    assert [f["path"] for f in discovery.in_scope([{"path": "s3a://b/data/x"}, {"path": "s3a://b/sample/x"}], "sample")] == ["s3a://b/sample/x"]


def test_lines_that_are_no_records(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_bytes(b'{"a": 1, "b": "x\\u0000"}\n{"a": \n\n{"a": null}\n{}\n\x7f{"a": 2}\n[1]\n{"a": "three"}\n')
    assert sorted((r["a"] or "") for r in readers.read_jsonl(spark, str(path), "a string").collect() if r["a"]) == ["1", "2", "three"]
    assert readers.malformed_lines(spark, str(path)) == 1 and readers.count_records(spark, str(path)) == 6
    with pytest.raises(Exception):  # noqa: B017
        readers.read_jsonl(spark, str(path), "a int", strict=True).collect()


def test_mixtures_with_bare_shares():
    tree = {"bins": {100: {"share": 0.6, "domains": {"a": 0.25, "b": {"share": 0.75, "subdomains": {"x": 0.5, "y": "0.5"}}}}, "200": 0.4}}
    got = {(t.len_bucket, t.domain, t.subdomain): (t.bin_share, t.domain_share, t.subdomain_share) for t in manifest.parse_mixture(tree)}
    assert got == {(100, "a", None): (0.6, 0.25, 1.0), (100, "b", "x"): (0.6, 0.75, 0.5), (100, "b", "y"): (0.6, 0.75, 0.5), (200, None, None): (0.4, 1.0, 1.0)}
    for bad in ({"bins": {100: 0.5}}, {"bins": {"long": 1}}, {"bins": {100: {"share": 1, "domains": {"a": "much"}}}}, {"bins": {100: True}}, {"bins": {100: {"share": 1, "domains": [1]}}}):
        with pytest.raises(ValueError):
            manifest.parse_mixture(bad)


def test_statuses_of_the_command_line(spark, tmp_path, capsys):
    capacity = str(tmp_path / "capacity")
    spark.createDataFrame([(100, "a", "x", 700), (200, "b", "y", 100)], "len_bucket long, domain string, subdomain string, n_tokens long").write.parquet(capacity)
    config_file = tmp_path / "mixture.json"
    config_file.write_text(json.dumps({"bins": {"100": {"share": 0.8, "domains": {"a": 1}}, "200": 0.2}}))
    assert cli.main(["mixture", str(config_file), capacity, "--budget", "400"]) == 0
    assert cli.main(["mixture", str(config_file), capacity]) == 3
    lines = tmp_path / "r.jsonl"
    lines.write_text("".join(json.dumps({"uuid": f"u{i}", "messages": [{"role": "user", "content": f"about the harbour {i}"}, {"role": "assistant", "content": "yes"}], "tools": []}) + "\n" for i in range(5)))
    assert cli.main(["search", str(lines), "HARBOUR 3"]) == 0
    assert "harbour 3" in capsys.readouterr().out
    assert cli.main(["parse", str(lines), "--start", "1", "--end", "3", "--format", "json", "--compact"]) == 0
    assert [m["messages"][1]["content"] for m in json.loads(capsys.readouterr().out)] == ["", ""]
    assert cli.main(["show", str(lines), "2", "--format", "markdown"]) == 0 and "### USER" in capsys.readouterr().out
    for mode in ("dry-run", "plan", "normalize", "exact", "minhash"):
        assert cli.main(["dedup", str(lines), "--text", "uuid", "--mode", mode, *([] if mode in ("dry-run", "plan") else ["-o", str(tmp_path / mode)])]) == 0
    assert spark.read.parquet(str(tmp_path / "minhash")).count() == 5


def test_small_helpers(spark):
    assert T.readable_size(512) == "512 B" and T.readable_size(1536) == "1.5 KB" and T.readable_size(3 << 30) == "3.0 GB"
    assert T.urn("loom", "page", "é", 1) == 'urn:loom:page:v1:["\\u00e9",1]'
    df = spark.createDataFrame([([("u", "hi")],)], "messages array<struct<role:string,content:string>>")
    assert adapters.with_conversations(df).columns == ["conversations"] and adapters.with_messages(adapters.with_conversations(df)).columns == ["messages"]
    assert explore.record_roles is not None and parse.parse_as(df, SFT_SCHEMA).columns == ["messages"]
    assert parse.parse_as(spark.createDataFrame([("t",)], "text string"), PRETRAINING_SCHEMA).first()["source_dataset"] == "parse"
    with pytest.raises(ValueError):
        parse.parse_as(df, df.schema)
    tools = spark.createDataFrame([("t", "L", [("n", None, ("f", "d"))])], "title string, license string, tools array<struct<name:string,description:string,function:struct<name:string,description:string>>>")
    said = tools.select(sinks.as_markdown(F.lit(None).cast("array<struct<role:string,content:string>>"), F.col("title"), {"license": F.col("license")}, F.col("tools"))).first()[0]
    assert said == "# t\n\n- **license**: L\n\n\n\n## Tools\n\n- `n`: d"


def test_stored_tables_are_removed():
    import subprocess
    import sys

    code = """
import os
from corpusloom.session import clear, session, shared_dir, stored
s = session('clear', **{'spark.master': 'local[1]'})
kept = stored(s.range(5), 'five')
folder = shared_dir(s).removeprefix('file://') + '/corpusloom/' + s.sparkContext.applicationId
assert kept.count() == 5 and len(os.listdir(folder)) == 1
clear(s)
assert not os.path.exists(folder)
"""
    assert subprocess.run([sys.executable, "-c", code], timeout=120, capture_output=True, env={**os.environ, "PYTHONPATH": os.getcwd()}).returncode == 0
