"""P-series column helpers and the pandas/Spark semantic rules."""

import datetime

from pyspark.sql import functions as F

from flowlens.functions import columns as C


def one(spark, expr, schema="x double", value=None):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(expr.alias("y")).first().y


def test_safe_division(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0), (None, 1.0)], "a double, b double")
    got = [r.y for r in df.select(C.safe_div("a", "b").alias("y")).collect()]
    assert got == [None, 0.25, None]
    got0 = [r.y for r in df.select(C.safe_div0("a", "b").alias("y")).collect()]
    assert got0 == [0.0, 0.25, 0.0]


def test_canonicalise(spark):
    df = spark.createDataFrame([("Can't afford", "Can't afford"), ("x", None)], "a string, b string")
    one_col = C.canonicalise(df, {"Can't afford": "Cannot afford"}, ["a"]).collect()
    assert one_col[0].a == "Cannot afford" and one_col[0].b == "Can't afford"
    every = C.canonicalise_all(df, {"Can't afford": "Cannot afford"}).collect()
    assert every[0].b == "Cannot afford"


def test_name_cleanup_and_tokens(spark):
    df = spark.createDataFrame([("reasons_for_not_interested_in_demo", "Awareness (Demo Video)", "TITOS HANDMADE VODKA 1L")],
                               "c string, s string, i string")
    r = df.select(
        C.clean_category_name("c", ["reasons_for_not_interested_in_", "reasons_for_not_interested_to_"]).alias("cat"),
        C.first_token_lower("s").alias("tok"),
        C.prefix_ellipsis("i", 15).alias("lab"),
    ).first()
    assert (r.cat, r.tok, r.lab) == ("Demo", "awareness", "TITOS HANDMADE ...")


def test_labels(spark):
    df = spark.createDataFrame([(4608450130.4, 0.0523, None)], "v double, g double, n double")
    r = df.select(C.usd_label("v").alias("usd"), C.millions_label("v").alias("m"), C.pct_label("g").alias("p"),
                  C.signed_growth_label("g").alias("sg"), C.signed_growth_label("n").alias("na")).first()
    assert r.usd == "$4,608,450,130"
    assert r.m == "$4608.5M"
    assert r.p == "5.2%"
    assert r.sg == "+5.2% MoM"
    assert r.na == "N/A"


def test_clip_and_width(spark):
    df = spark.createDataFrame([(0.6, 5.0, 10.0), (-0.1, 10.0, 10.0), (0.1, 0.0, 0.0)], "m double, v double, mx double")
    got = df.select(C.clip01("m").alias("c"), C.relative_width("v", "mx", 1.0, 1.5).alias("w")).collect()
    assert [r.c for r in got] == [1.0, 0.0, 0.2]
    assert [r.w for r in got] == [1.75, 2.5, None]


def test_dates(spark):
    df = spark.createDataFrame([("1/10/2022",), ("not a date",)], "d string")
    got = [r.y for r in df.select(C.lenient_date("d", "M/d/yyyy").alias("y")).collect()]
    assert got == [datetime.date(2022, 1, 10), None]
    assert df.filter(F.col("d") == "1/10/2022").select(C.strict_date("d").alias("y")).first().y == datetime.date(2022, 1, 10)


def test_labels_of_null(spark):
    from flowlens.functions import columns as C

    df = spark.createDataFrame([(None,), (1234567.0,)], "x double")
    kinds = [C.usd_label, C.millions_label, C.thousands_label, C.pct_label]
    got = df.orderBy(F.col("x").asc_nulls_first()).select(*[f("x") for f in kinds]).collect()
    assert tuple(got[0]) == ("N/A",) * 4
    assert tuple(got[1]) == ("$1,234,567", "$1.2M", "$1234.6K", "123456700.0%")
