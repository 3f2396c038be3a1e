import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.running import ordinal_by_key, rank_in_group, running_sum
from corpusloom.functions.text import normal_text
from corpusloom.operators import dedup, diff, filters, manifest, pack, parse, sampling


def test_running_sum_with_a_hot_group(spark):
    rows = [(i, None if i % 7 == 0 else "hot" if i % 3 else f"g{i % 5}", None if i % 11 == 0 else i % 4) for i in range(3000)]
    got = running_sum(spark.createDataFrame(rows, "id long, g string, v long"), ["g"], "id", F.col("v"), "before").collect()
    for g, own in itertools.groupby(sorted(got, key=lambda r: (r["g"] or "", r["before"])), key=lambda r: r["g"]):
        own = list(own)
        total = sum(r["v"] or 0 for r in own)
        assert own[0]["before"] == 0 and all(0 <= r["before"] <= total for r in own)
        assert sorted(r["before"] + (r["v"] or 0) for r in own)[-1] == total
    ranks = rank_in_group(spark.createDataFrame(rows, "id long, g string, v long"), ["g"], "id", "r").collect()
    for g, n in Counter(r["g"] for r in ranks).items():
        assert sorted(r["r"] for r in ranks if r["g"] == g) == list(range(n))


def test_ordinals(spark):
    keys = [5, 1, 70_000, 12, -4, 10_000]
    got = ordinal_by_key(spark.createDataFrame([(k,) for k in keys], "k long"), "k").collect()
    assert [r["k"] for r in sorted(got, key=lambda r: r["ordinal"])] == sorted(keys)


@pytest.mark.parametrize("total,parts", list(itertools.product((100, 101, 19_028), (2, 3, 7, 10))))
def test_split_bounds(total, parts):
    bounds = sampling.split_bounds(total, parts)
    assert bounds[0][0] == 0 and bounds[-1][1] == total and all(a[1] == b[0] for a, b in zip(bounds, bounds[1:], strict=False))
    assert max(b - a for a, b in bounds) - min(b - a for a, b in bounds) <= 1


def test_parts_are_the_bounds(spark):
    df = spark.range(101).withColumnRenamed("id", "at")
    got = sampling.with_part(df, 7, "at").collect()
    for i, (a, b) in enumerate(sampling.split_bounds(101, 7)):
        assert sorted(r["at"] for r in got if r["part"] == i + 1) == list(range(a, b))
    assert sampling.verify_split(df, sampling.with_part(df, 7, "at"), "at").count() == 0
    assert sampling.with_part(spark.range(2).withColumnRenamed("id", "at"), 5, "at").count() == 2
    assert sorted(r["n"] for r in sampling.shuffled_parts(df, "at", 7, 3).groupBy("part").agg(F.count("*").alias("n")).collect()) == [14, 14, 14, 14, 15, 15, 15]


def test_exact_share(spark):
    rows = [(i, "hot" if i % 3 else None) for i in range(900)]
    got = sampling.exact_share(spark.createDataFrame(rows, "id long, g string"), "g", "id", 0.21).collect()
    assert Counter(r["g"] for r in got) == {"hot": 126, None: 63}


def jaccard(a, b):
    def runs(t):
        w = " ".join(t.split()).lower().split(" ")
        return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))}

    x, y = runs(a), runs(b)
    return len(x & y) / len(x | y)


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(30):
        base = [rng.choice(words) for _ in range(120)]
        for _ in range(rng.choice((1, 2, 3))):
            copy = list(base)
            for _ in range(rng.choice((0, 0, 1))):
                copy[rng.randrange(120)] = "changed"
            texts.append(" ".join(copy))
    texts += ["", None, "short one", "short one", "short  one"]
    rows = list(enumerate(texts))
    got = {r["id"]: r["class_id"] for r in dedup.near_duplicates(spark.createDataFrame(rows, "id long, text string"), "id", "text").collect()}
    assert set(got) == {i for i, _ in rows}
    same = {(i, j) for (i, a), (j, b) in itertools.combinations(rows, 2) if jaccard(a or "", b or "") >= 0.8}
    found = {(i, j) for i, j in itertools.combinations(sorted(got), 2) if got[i] == got[j]}
    assert len(same & found) >= 0.9 * len(same)
    assert all(jaccard(texts[i] or "", texts[j] or "") > 0.6 for i, j in found)
    assert dedup.near_duplicates(spark.createDataFrame([], "id long, text string"), "id", "text").count() == 0


@pytest.mark.parametrize("listed, block", [(32, 3000), (2, 5)])
def test_near_duplicates_lose_no_link(spark, monkeypatch, listed, block):
    monkeypatch.setattr(dedup, "LISTED", listed)
    monkeypatch.setattr(dedup, "BLOCK_ROWS", block)
    rng = random.Random(4)
    texts = []
    for g in range(12):  # rows that share most of a page, at similarities on both sides of 0.8
        base = [f"g{g}w{rng.randrange(500)}" for _ in range(100)]
        for _ in range(10):
            copy = list(base)
            for _ in range(rng.choice((1, 2, 2, 3))):
                copy[rng.randrange(100)] = f"c{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    got = {r["id"]: r["class_id"] for r in dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), "id", "text").collect()}
    lead = list(range(len(texts)))
    for _ in texts:
        for i, j in itertools.combinations(range(len(texts)), 2):
            if i // 10 == j // 10 and lead[i] != lead[j] and jaccard(texts[i], texts[j]) >= 0.8:
                lead[i] = lead[j] = min(lead[i], lead[j])
    assert got == dict(enumerate(lead)) and len(set(lead)) > 12


def test_near_duplicates_compare_few_sets_and_leave_no_shuffles(spark, monkeypatch):
    import os

    rng = random.Random(5)
    phrases = [" ".join(f"p{i}w{j}" for j in range(8)) for i in range(40)]
    texts = [" ".join(x for k in range(30) for x in (f"t{t}k{k}", *rng.choice(phrases).split(), f"t{t}x{k}")) for t in range(200)]
    texts += [t + " changed" for t in texts[:5]]
    kept, read = dedup.stored, {}
    monkeypatch.setattr(dedup, "stored", lambda df, name: read.setdefault(name, kept(df, name)))
    monkeypatch.setattr(dedup, "drop", lambda df: None)
    monkeypatch.setattr(dedup, "components", lambda links: links.selectExpr("a as node", "least(a, b) as component"))
    dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), "id", "text")
    assert read["shingles"].count() <= 20 and read["links"].count() == 5
    files = lambda: {f for d, _, fs in os.walk(spark.conf.get("spark.local.dir", "/tmp")) if "blockmgr" in d for f in fs if f.startswith("shuffle_")}
    before = files()
    kept(spark.range(1000).groupBy(F.col("id") % 7).count(), "counts")
    assert not files() - before


def test_rows_whose_key_another_has_too():
    import pyarrow as pa

    keys = [1, 1, 2, 3, 3, 3, 4, 5, 5, 6]
    whole = pa.RecordBatch.from_arrays([pa.array(range(10)), pa.array(keys)], ["row", "key"])
    for n in (1, 2, 3, 10):
        got = [r for b in dedup._several(iter([whole.slice(i, n) for i in range(0, 10, n)])) for r in b.column("row").to_pylist()]
        assert got == [0, 1, 3, 4, 5, 7, 8]


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(100, 140)]
    hub = [(1, i) for i in range(2, 40)]
    got = {r["node"]: r["component"] for r in dedup.components(spark.createDataFrame(chain + hub + [(7, 7)], "a long, b long")).collect()}
    assert {got[i] for i in range(100, 141)} == {100} and {got[i] for i in range(1, 40)} == {1}


def test_exact_report_counts_null_texts_as_one(spark):
    df = spark.createDataFrame([("a",), ("a ",), (None,), ("",)], "text string")
    assert tuple(dedup.exact_report(df, normal_text(F.col("text"))).first()) == (4, 2, 2, 1)


def test_manifest_and_mixture(spark):
    rows = [("poems", "attic", "odes", 7), ("poems", "attic", "odes", 8193), ("poems", "attic", None, 300_001), ("letters", "post", None, 8192), (None, None, None, None)]
    df = spark.createDataFrame(rows, "domain string, source_dataset string, subdomain string, token_count long")
    cells = manifest.cells(df)
    assert cells.count() == 5 and manifest.from_json(spark, manifest.to_json(cells)).exceptAll(cells).count() == 0
    tree = {"64": {"share": 1.0, "domains": {"poems": {"share": 0.35}, "letters": 0.65}}}
    capacity = spark.createDataFrame([(64, "poems", "odes", 520), (64, "letters", "notes", 230)], "len_bucket long, domain string, subdomain string, n_tokens long")
    checked = {r["domain"]: r for r in manifest.check_mixture(capacity, manifest.parse_mixture(tree), 600).collect()}
    assert (checked["poems"]["shortfall"], checked["letters"]["shortfall"], checked["poems"]["bin_ok"]) == (0, 160, False)  # 0.65 x 600 - 230
    assert manifest.check_mixture(capacity, manifest.parse_mixture(tree), 0).where("need > 0").count() == 0
    assert not manifest.satisfiable(manifest.check_mixture(capacity, manifest.parse_mixture(tree)))
    with pytest.raises(ValueError):
        manifest.parse_mixture({"64": {"share": 0.5}})


def test_reasons(spark):
    df = spark.createDataFrame([(1.0, 5, "m"), (0.0, 5, "m"), (1.0, 1, "m"), (1.0, None, "m"), (1.0, 9, "n"), (None, 5, "m")], "reward double, num_turns int, model string")
    got = {r["reason"]: r["n"] for r in filters.reason_counts(df, filters.trajectory_reason(df, min_turns=2, model="m")).collect()}
    assert got == {"passed": 1, "failed": 2, "excluded_by_min_turns": 2, "excluded_by_model": 1}
    keyed = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    assert filters.without(keyed, keyed.where("k = 1"), "k").count() == 2


def test_diff():
    a, b = {"x": 1, "y": [1, {"z": 2}], "gone": {"k": 1}}, {"x": 1, "y": [1, {"z": 3}, 4], "new": None}
    assert dict(diff.compare(a, b)) == {"x": "unchanged", "y[0]": "unchanged", "y[1].z": "changed", "y[2]": "added", "gone": "removed", "gone.k": "removed", "new": "added"}
    assert dict(diff.compare(1, True)) == {"": "changed"}


def test_diff_of_columns(spark):
    df = spark.createDataFrame([(1, '{"a": 1}', '{"a": 2}'), (2, None, "{"), (3, None, None)], "k long, l string, r string")
    assert sorted(tuple(r) for r in diff.record_diff(df, "k", "l", "r").collect()) == [(1, "a", "changed"), (2, "", "changed"), (3, "", "unchanged")]
    assert diff.side_by_side(df.where("k < 3"), df.where("k > 1"), "k").count() == 3


def test_blanking_keeps_everything_else(spark):
    df = spark.createDataFrame([("u", [("assistant", "a", "why", "id"), ("user", "q", "r", None), ("assistant", None, None, None)])], "uuid string, messages array<struct<role:string,content:string,reasoning_content:string,extra:string>>")
    got = [tuple(m) for m in parse.prompts(df).first()["messages"]]
    assert got == [("assistant", "", "", None), ("user", "q", "r", None), ("assistant", "", None, None)]


def groups(sizes, host=None):
    return (pack.Group.of([(str(i), 0, host, 0, n)]) for i, n in enumerate(sizes))


def test_best_fit():
    full, left = pack.best_fit(groups([5, 3, 2, 3]), 10)
    assert [[p[0] for p in g.parts] for g in full] == [["0", "1"]] and sum(len(g.parts) for g in left) == 2
    assert len(pack.best_fit(groups([1, 1], "h"), 10, max_same_host=1)[1]) == 2
    assert len(pack.best_fit(groups([1] * 5), 100, max_documents=2)[1]) == 3
    assert len(pack.best_fit(groups([6, 6, 6]), 10, max_open=1)[1]) == 3
    with pytest.raises(ValueError):
        pack.best_fit(groups([10]), 10)


def test_packing_loses_nothing(spark):
    rng = random.Random(1)
    rows = [(str(i), f"h{i % 9}" if i % 4 else None, i % 3, 16 if i % 2 else 8, i % 5, list(range(i, i + rng.choice((0, 3, 6, 20, 40))))) for i in range(120)]
    parts = pack.segments(spark.createDataFrame(rows, "doc_id string, host string, cluster int, context int, partition long, input_ids array<int>"), (8, 16)).cache()
    samples = pack.pack_all(parts, buckets=4)
    assert samples.where("size(segments) > 32").count() == 0
    assert pack.accounts(samples, parts).first()["complete"]
    made = pack.materialise(samples, parts, eos=-1, pad=-2).collect()
    for r in made:
        assert len(r["input_ids"]) == len(r["labels"]) == len(r["attention_mask"]) == r["context"]
        assert r["input_ids"].count(-1) == r["n_segments"] and sum(r["attention_mask"]) == r["n_source"] + r["n_segments"]
    placed = Counter(x for r in made for x in r["input_ids"] if x >= 0)
    assert placed == Counter(x for row in rows for x in row[5])


def test_materialised_sample(spark):
    parts = spark.createDataFrame([("a", None, 1, 8, 0, 0, [10, 11, 12]), ("b", None, 1, 8, 0, 0, [13])], "doc_id string, host string, cluster int, context int, partition long, chunk int, ids array<int>")
    r = pack.materialise(pack.pack_all(parts, 1), parts, 7, 0).first()
    assert sorted(r["input_ids"][:6]) == [7, 7, 10, 11, 12, 13] and r["input_ids"][6:] == [0, 0]
    assert r["labels"][6:] == [-100, -100] and r["attention_mask"] == [1] * 6 + [0] * 2 and r["cluster_id"] == 1


def test_stream(spark, tmp_path):
    from corpusloom.streaming import ingest

    folder = tmp_path / "in"
    spark.createDataFrame([("a",), ("a",), ("b",)], "text string").coalesce(1).write.parquet(str(folder))
    rows = ingest.first_of_each_text(ingest.arriving(spark, str(folder), spark.read.parquet(str(folder)).schema))
    for _ in range(2):
        ingest.ingest(rows, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(120)
    assert sorted(r["text"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]


def test_topic_clusters(spark):
    from corpusloom.operators import topics

    words = {0: "court verdict witness appeal", 1: "penalty goalkeeper league podium", 2: "garlic onion skillet broth"}
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(words[i % 3].split()) for _ in range(12))) for i in range(60)] + [(100, ""), (101, None)]
    docs = topics.prepared(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id")
    vectors = topics.features(docs, word_dims=512, piece_dims=256).select("doc_id", "bytes", "features").cache()
    model = topics.fit(vectors, "doc_id", k=3, seed=2)
    got = topics.assign(vectors, model)
    rows = {r["doc_id"]: r for r in got.collect()}
    assert set(rows) == set(range(60))
    assert {r["doc_id"]: r["prediction"] for r in model.setPredictionCol("prediction").transform(vectors).collect()} == {i: r["cluster"] for i, r in rows.items()}
    for r in vectors.collect():
        centre = model.clusterCenters()[rows[r["doc_id"]]["cluster"]]
        assert abs(rows[r["doc_id"]]["distance"] - float(((r["features"].toArray() - centre) ** 2).sum() ** 0.5)) < 1e-3
    report = {r["cluster"]: r for r in topics.quality(got, "doc_id", 3).collect()}
    assert report[None]["n_docs"] == 60 and report[None]["ok"] == (len(report) == 4)
    plan = topics.partition_plan(got.groupBy("cluster").agg(F.count("*").alias("n_docs"), F.sum("bytes").alias("bytes")), 8)
    assert plan.agg(F.sum("share")).first()[0] == 8
    placed = topics.physical_partition(got, plan, "doc_id")
    assert placed.count() == 60 and placed.agg(F.max("physical_partition")).first()[0] < 8
    with pytest.raises(ValueError):
        topics.fit(vectors, "doc_id", k=100)


def test_the_driver_never_has_all_centres(spark, monkeypatch):
    from corpusloom.operators import topics

    monkeypatch.setattr(topics, "AT_ONCE", 2)
    seen, some = [], topics.Centres._some
    monkeypatch.setattr(topics.Centres, "_some", lambda self, first: seen.append(some(self, first)) or seen[-1])
    rows = [(i, " ".join(f"t{i % 5}w{(i * j) % 11}" for j in range(1, 15))) for i in range(80)]
    vectors = topics.features(topics.prepared(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id")).select("doc_id", "features").cache()
    model = topics.fit(vectors, "doc_id", k=5)
    assert seen and max(map(len, seen)) <= 2
    got = {r["doc_id"]: r["cluster"] for r in topics.assign(vectors, model).collect()}
    assert len(set(got.values())) == 5
    for c in set(got.values()):  # a centre is the mean of its rows
        mine = [r["features"].toArray() for r in vectors.collect() if got[r["doc_id"]] == c]
        assert abs(model.clusterCenters()[c] - sum(mine) / len(mine)).max() < 1e-4
