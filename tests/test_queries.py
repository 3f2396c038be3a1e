"""Every query of the core against its SQL on the smallest tables; the others run and have a stable schema."""

import pytest

from corpusloom.plans import catalog

from . import oracle

SLOW = {"topic_clusters"}  # topic_quality runs the same and more


@pytest.fixture(scope="module")
def con(data):
    return oracle.connection(data)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_sql(name, spark, data, con):
    oracle.check(catalog.QUERIES[name], catalog.ORACLES[name], spark, data, con)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES) - SLOW))
def test_runs(name, spark, data):
    df = catalog.QUERIES[name](spark, data)
    assert df.columns and df.count() >= 0


def test_entry(spark, data):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_topics_run_with_the_settings_of_the_operator(spark, data, monkeypatch):
    from corpusloom.operators import topics

    seen = {}
    features, fit = topics.features, topics.fit
    monkeypatch.setattr(topics, "features", lambda df, *a, **k: seen.update(features=(a, k)) or features(df, word_dims=512, piece_dims=256))
    monkeypatch.setattr(topics, "fit", lambda df, row, **k: seen.update(k=k["k"]) or fit(df, row, **k))
    monkeypatch.setattr(topics, "CLUSTERS", 20)
    assert catalog.QUERIES["topic_clusters"](spark, data).count() > 0
    assert seen == {"features": ((), {}), "k": 20}


def test_nothing_of_the_core_imports_llm():
    import os
    import re

    root = os.path.dirname(catalog.__file__).rsplit(os.sep, 1)[0]
    for folder, _, names in os.walk(root):
        if f"{os.sep}llm" in folder:
            continue
        for n in names:
            if n.endswith(".py"):
                with open(os.path.join(folder, n)) as f:
                    assert not re.search(r"^\s*(?:from|import)\s.*\bllm\b", f.read(), re.M), n
