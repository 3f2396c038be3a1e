import pytest

from corpusloom.llm import catalog


@pytest.mark.parametrize("name", sorted(n for n in catalog.QUERIES if n.endswith("_found")))
def test_found(name, spark, data):
    columns = {
        "p3_found": [("table_name", "string"), ("record_no", "bigint"), ("msg_pos", "int"), ("defect", "string")], "p4_found": [("id", "string")], "p5_found": [("id_a", "string"), ("id_b", "string")],
        "p6_found": [("doc_id", "bigint")], "p7_found": [("source", "string")], "p8_found": [("doc_id", "bigint"), ("subject", "string")],
    }
    df = catalog.QUERIES[name](spark, data)
    assert df.dtypes == columns[name]
    assert df.count() == df.distinct().count()


@pytest.mark.parametrize("name", sorted(n for n in catalog.QUERIES if not n.endswith("_found")))
def test_runs(name, spark, data):
    assert catalog.QUERIES[name](spark, data).count() > 0
