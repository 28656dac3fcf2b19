"""Explicit schemas for the domain files (no schema inference on large inputs)."""

from pyspark.sql import types as T

LEADS = T.StructType([
    T.StructField("lead_id", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("current_city", T.StringType()),
    T.StructField("current_education", T.StringType()),
    T.StructField("parent_occupation", T.StringType()),
    T.StructField("lead_gen_source", T.StringType()),
])

DEMO_WATCHED = T.StructType([
    T.StructField("lead_id", T.StringType()),
    T.StructField("demo_watched_date", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("watched_percentage", T.IntegerType()),
])

NO_INTEREST = T.StructType([
    T.StructField("lead_id", T.StringType()),
    T.StructField("reasons_for_not_interested_in_demo", T.StringType()),
    T.StructField("reasons_for_not_interested_to_consider", T.StringType()),
    T.StructField("reasons_for_not_interested_to_convert", T.StringType()),
])

MANAGERS = T.StructType([
    T.StructField("snr_sm_id", T.StringType()),
    T.StructField("jnr_sm_id", T.StringType()),
    T.StructField("assigned_date", T.StringType()),
    T.StructField("cycle", T.IntegerType()),
    T.StructField("lead_id", T.StringType()),
])

INTERACTIONS = T.StructType([
    T.StructField("lead_id", T.StringType()),
    T.StructField("lead_stage", T.StringType()),
    T.StructField("call_status", T.StringType()),
    T.StructField("call_reason", T.StringType()),
    T.StructField("call_done_date", T.StringType()),
])

IRIS = T.StructType([
    T.StructField("sepal_length", T.DoubleType()),
    T.StructField("sepal_width", T.DoubleType()),
    T.StructField("petal_length", T.DoubleType()),
    T.StructField("petal_width", T.DoubleType()),
    T.StructField("species", T.StringType()),
])

EDGES = T.StructType([
    T.StructField("node1", T.LongType()),
    T.StructField("node2", T.LongType()),
])

# card-transaction table: Time, V1..V28, Amount, Class
TXN_FEATURES = ["Time"] + [f"V{i}" for i in range(1, 29)] + ["Amount"]


# Date format of the lead CSVs (fixed value of the input files)
LEAD_DATE_FORMAT = "M/d/yyyy"
