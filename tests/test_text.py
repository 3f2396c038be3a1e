import unicodedata
import uuid

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import text as T


def value(spark, text, *columns):
    return tuple(spark.createDataFrame([(text,)], "t string").select(*columns).first())


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=30), min_size=1, max_size=20))
def test_normal_text_is_python_s(spark, texts):
    texts = [t.replace("\x00", "") for t in texts if not any("\ud800" <= c <= "\udfff" for c in t)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(T.normal_text(F.col("t"))).collect()]
    assert got == [" ".join(unicodedata.normalize("NFC", t).split()) for t in texts]


def test_uuid5(spark):
    assert value(spark, "urn:x:1", T.uuid5(F.col("t")))[0] == str(uuid.uuid5(uuid.NAMESPACE_URL, "urn:x:1"))


def test_hosts(spark):
    for url, host in (("https://User@WWW.Ex.example:80/a?b", "www.ex.example"), ("nonsense", ""), (None, ""), ("http://a b/", "")):
        assert value(spark, url, T.url_host(F.col("t")))[0] == host


def test_bins(spark):
    df = spark.createDataFrame([(x,) for x in (1, 8191, 8192, 8193, 65536, 65537, 10_000_000, None)], "n long")
    assert [r[0] for r in df.select(T.length_bin(F.col("n"), (8192, 65536, 262144))).collect()] == [8192, 8192, 8192, 65536, 65536, 262144, 262144, None]


def test_casts_and_lines(spark):
    assert value(spark, " 12 ", T.int_or_null(F.col("t"))) == (12,)
    assert value(spark, "3.7", T.int_or_null(F.col("t"))) == (None,)
    assert value(spark, "a\x00\x00b\x07\tc ", T.scrub_line(F.col("t"))) == ("a b\tc",)
    assert value(spark, "abcdefgh", T.truncated(F.col("t"), 5)) == ("ab...",)
    assert value(spark, "org/model", T.model_provider(F.col("t"))) == ("org",)
    assert value(spark, "model", T.model_provider(F.col("t"))) == (None,)
