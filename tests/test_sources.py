import io
import json
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom import config
from corpusloom.operators import adapters, explore, mix, normalize
from corpusloom.schema import PRETRAINING_SCHEMA, SFT_SCHEMA, conform, conformance, validate
from corpusloom.sources import discovery, readers, sinks


def test_detect(tmp_path):
    assert readers.detect_format("A.JSONL?x=1") == "jsonl"
    (tmp_path / "a.dat").write_bytes(b"PAR1....")
    (tmp_path / "b.dat").write_text("  [1]")
    (tmp_path / "c.dat").write_text(' {"a": 1}')
    assert [readers.detect_format(str(tmp_path / n)) for n in ("a.dat", "b.dat", "c.dat")] == ["parquet", "json", "jsonl"]
    with pytest.raises(ValueError):
        readers.detect_format(str(tmp_path / "none"))


def test_jsonl(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_bytes(b'{"a": 1, "b": "x\x07"}\n\nnot json\n{"a": 2, "b": null}\n')
    assert sorted(tuple(r) for r in readers.load(spark, str(p)).collect()) == [(1, "x"), (2, None)]
    assert readers.malformed_lines(spark, str(p)) == 1
    assert readers.read_variant(spark, str(p)).count() == 2
    with pytest.raises(Exception):
        readers.read_jsonl(spark, str(p), "a long, b string", strict=True).collect()


def test_csv_text_json_and_ordinals(spark, tmp_path):
    (tmp_path / "a.csv").write_text('prompt,completion\n"a ""q""\nline",b\n\n' + '"' + "x" * 200_000 + '",c\n')
    got = readers.load(spark, str(tmp_path / "a.csv")).collect()
    assert got[0]["prompt"] == 'a "q"\nline' and len(got[1]["prompt"]) == 200_000
    (tmp_path / "a.txt").write_text("one\ntwo\n")
    assert [tuple(r) for r in readers.load(spark, str(tmp_path / "a.txt")).collect()] == [(1, "one"), (2, "two")]
    (tmp_path / "a.json").write_text('[{"a": 1}, {"a": 2}]')
    df = readers.with_ordinal(readers.load(spark, str(tmp_path / "a.json")))
    assert readers.record_at(df, 1).first()["a"] == 2
    assert readers.records_range(df, 1, 5).count() == 1
    with pytest.raises(IndexError):
        readers.record_at(df, 2)


def test_discovery_and_mix(spark, tmp_path):
    (tmp_path / "qa").mkdir()
    (tmp_path / "qa" / "a.csv").write_text("prompt,completion\nhi,ho\n")
    (tmp_path / "chat").mkdir()
    (tmp_path / "chat" / "b.jsonl").write_text(json.dumps({"messages": [{"role": "user", "content": "x"}], "metadata": {"model": "org/m", "run_id": "r"}}) + "\n")
    (tmp_path / "chat" / "interactive_agent.jsonl").write_text("{}\n")
    files = discovery.discover(str(tmp_path))
    assert [f["source_dataset"] for f in files] == ["chat", "qa"]
    assert len(discovery.choose(files, include=["qa"])) == 1 and discovery.choose(files, exclude=["a.csv", "chat"]) == []
    df = mix.mix(spark, str(tmp_path))
    assert conformance(df, SFT_SCHEMA).ok and df.count() == 2
    chat = df.where("source_dataset = 'chat'").first()
    assert (chat["model_provider"], chat["run_id"], chat["conversations"][0]["content"]) == ("org", "r", "x")
    assert {tuple(r) for r in mix.dry_run(df).collect()} == {("source", "qa", 1), ("source", "chat", 1), ("total", None, 2)}


def test_adapters_by_shape(spark):
    trajectory = spark.createDataFrame([("i", "t", '[{"role": "user", "content": "x"}]', 1.0, "", 3), ("j", "t", "", 1.0, "", 3)], "instance_id string, trial_id string, messages string, reward double, model_patch string, turns int")
    assert adapters.choose_adapter(trajectory, "parquet", "s") is adapters.trajectories
    got = sorted(adapters.trajectories(trajectory, "s").collect(), key=lambda r: r["task"])
    assert (got[0]["episode"], len(got[0]["conversations"]), got[1]["conversations"]) == ("3", 1, [])
    code = spark.createDataFrame([((("p", "m/x", "d")), ("t",), "py", "1")], "provenance struct<prompt:string,model:string,generated_at:string>, content struct<text:string>, language string, sample_id string")
    assert adapters.choose_adapter(code, "jsonl", "s") is adapters.code_answers
    assert [t["content"] for t in adapters.code_answers(code, "s").first()["conversations"]] == ["p", "t"]
    with pytest.raises(ValueError):
        adapters.choose_adapter(code.select("language"), "jsonl", "s")


def test_schema(spark):
    df = spark.createDataFrame([("x", "1")], "TEXT string, token_count string")
    assert conform(df, PRETRAINING_SCHEMA).first()["token_count"] == 1
    assert not conformance(df, PRETRAINING_SCHEMA).ok
    with pytest.raises(ValueError):
        validate(df, PRETRAINING_SCHEMA)


def test_normalise_falls_back_to_the_record(spark):
    df = spark.createDataFrame([("a  b", "d1", "math", "7"), (None, "", None, "x")], "body string, doc_id string, domain string, token_count string")
    got = normalize.to_pretraining(df, normalize.Source("s")).collect()
    assert (got[0]["text"], got[0]["id"], got[0]["domain"], got[0]["token_count"]) == ("a b", "d1", "math", 7)
    assert (got[1]["text"], got[1]["id"], got[1]["token_count"]) == (None, None, None)
    assert normalize.inspect(df.drop("body"), normalize.Source("s"))["status"] == "needs_mapping"


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("u1", [1, 2], "8192", "{}"), ("u2", [3], None, "{}"), ("u3", None, "8192", "{}")], "uuid string, input_ids array<int>, len_bin string, sidecar string").coalesce(1)
    made = sinks.write_tar_shards(rows, str(tmp_path), "src").collect()
    assert {(r["len_bin"], r["samples"], r["tokens"]) for r in made} == {("8192", 1, 2), ("unbinned", 1, 1)}
    with tarfile.open(next(r["path"] for r in made if r["len_bin"] == "8192")) as t:
        assert np.load(io.BytesIO(t.extractfile("u1.npy").read())).tolist() == [1, 2]
    sinks.write_partitioned(spark.createDataFrame([(1, "a"), (2, None)], "n int, domain string"), str(tmp_path / "p"), "domain")
    back = spark.read.parquet(str(tmp_path / "p"))
    assert {tuple(r) for r in back.collect()} == {(1, "a"), (2, "unknown")}
    sinks.write_marker(str(tmp_path / "p"), {"rows": 2, "limit": None, "identity": config.identity({"a": 1})})
    assert config.finished(str(tmp_path / "p"), {"a": 1}, 2)["rows"] == 2
    with pytest.raises(ValueError):
        config.finished(str(tmp_path / "p"), rows=3)


def test_config(tmp_path):
    p = tmp_path / "c.yaml"
    p.write_text("corpus:\n  defaults: {license: mit}\n  sources:\n    hub:\n      - {name: alpha, domain: math}\n      - {name: beta, mode: sft}\n")
    known = config.sources(config.read_config(str(p)), "pretraining")
    assert [(s.name, s.license) for s in known] == [("alpha", "mit")]
    assert config.in_domain(config.sources(config.read_config(str(p))), "unknown")[0].name == "beta"
    with pytest.raises(KeyError, match="alpha"):
        config.by_name(known, ["alpa"])
    config.refuse_drift(str(tmp_path), {"bins": [1], "seed": 1})
    config.refuse_drift(str(tmp_path), {"bins": [1], "seed": 2})
    with pytest.raises(ValueError, match="bins"):
        config.refuse_drift(str(tmp_path), {"bins": [2], "seed": 2})
    assert config.check_pipeline({})["clusters"] == 128
    with pytest.raises(ValueError):
        config.check_pipeline({"contexts": {1: 1.0}})


def test_explore(spark):
    df = spark.createDataFrame([("t1", [("user", "hello", "why"), ("assistant", "", None)])], "trial_name string, conversations array<struct<role:string,content:string,reasoning_content:string>>")
    full = explore.with_defaults(df)
    assert full.first()["uuid"] == "t1"
    assert explore.detect_fields(full)["messages"] == "messages"
    assert explore.list_records(full, reasoning=True).count() == 1
    assert explore.search(full.select("uuid"), "T1", ["uuid"]).first()["around"] == "t1"
    md = full.select(sinks.as_markdown(F.col("messages"), F.col("uuid"))).first()[0]
    assert "### USER" in md and "(empty)" in md


def test_preflight_and_cli(spark, tmp_path, capsys):
    from corpusloom import cli
    from corpusloom.session import preflight

    assert preflight(spark, 4).where("ok").count() == 4
    p = tmp_path / "r.jsonl"
    p.write_text("".join(json.dumps({"uuid": f"u{i}", "messages": [{"role": "user", "content": f"hello {i}"}], "tools": []}) + "\n" for i in range(5)))
    assert cli.main(["stats", str(p)]) == 0
    assert cli.main(["show", str(p), "1"]) == 0
    assert "u1" in capsys.readouterr().out
    assert cli.main(["split", str(p), "-n", "2", "-o", str(tmp_path / "parts")]) == 0
    assert spark.read.parquet(str(tmp_path / "parts")).groupBy("part").count().count() == 2
    assert cli.main(["show", str(tmp_path / "nothing"), "1"]) == 1
