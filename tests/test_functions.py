import datetime as dt

from pyspark.sql import functions as F

from tierwell.functions import keys as K
from tierwell.functions.names import account_fullname, normalize_header
from tierwell.functions.text import strip_citations


def _one(spark, value, expr, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("o")).first()["o"]


def test_account_fullname_edge_table(spark):
    cases = {"john.smith": "John Smith", "admin": "Admin", "a.b.c": "A B.c",
             "mark.": "Mark ", "rob.mcDonald": "Rob McDonald", ".smith": "Smith"}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r["v"]: r["o"] for r in df.select("v", account_fullname("v").alias("o")).collect()}
    assert got == cases


def test_strip_citations_is_greedy(spark):
    assert _one(spark, "a[1] b [2]c", strip_citations("v")) == "ac"
    assert _one(spark, "plain", strip_citations("v")) == "plain"


def test_day_of_timestamp_is_first_ten_chars(spark):
    d = _one(spark, dt.datetime(2001, 7, 1, 23, 59, 59), K.day_of("v"), "v timestamp_ntz")
    assert d == dt.date(2001, 7, 1)


def test_case_key_without_dot_is_empty(spark):
    assert _one(spark, "BLB0000123", K.case_key_of_request("v")) == ""
    assert _one(spark, "BLB0000123.4", K.case_key_of_request("v")) == "BLB0000123"


def test_ilike_prefix_is_case_insensitive(spark):
    df = spark.createDataFrame([("O X",), ("o x",), ("OX",)], "v string")
    kept = [r["v"] for r in df.filter(~K.ilike_prefix("v", "o %")).collect()]
    assert kept == ["OX"]


def test_city_split(spark):
    df = spark.createDataFrame([("RUS-Moscow",), ("OTHER",), ("USA-OTHER",)], "v string")
    got = sorted((r["c"], r["n"]) for r in df.select(K.city_country("v").alias("c"),
                                                     K.city_name("v").alias("n")).collect())
    assert got == [("OTH", "OTHER"), ("RUS", "Moscow"), ("USA", "OTHER")]


def test_backslash_literal_kept(spark):
    df = spark.sql("select 'N' || chr(92) || 'A' as v")
    assert df.first()["v"] == "N\\A" and len(df.first()["v"]) == 3


def test_normalize_header():
    assert normalize_header("Nation/Name") == "nation_name"
    assert normalize_header("Nation Key") == "nation_key"


def test_request_number_and_case_parts(spark):
    df = spark.createDataFrame([("GLBCIP0000042.3",)], "v string")
    r = df.select(K.request_number("v").alias("rn")).first()["rn"]
    assert r == "CIP0000042.3"
    out = spark.createDataFrame([("GLBCIP0000042",)], "v string").select(
        K.client_of_case("v").alias("c"), K.case_number("v").alias("n"),
        K.case_key("v").alias("k")).first()
    assert (out["c"], out["n"], out["k"]) == ("CIP", "0000042", "CIP0000042")
    assert F is not None
