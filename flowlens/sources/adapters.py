"""Driver tables → the domain views the analyses are written against.

Each view is a lazy DataFrame. Dimension attributes are *left*-joined onto the fact rows, so
the row set of a view never depends on which attributes a query asks for; a query that does
not need an attribute does not pay for its join. Fixed-size dimensions (nation: 25 rows,
region: 5 rows) are broadcast explicitly; everything else is left to the planner's size
estimate (``autoBroadcastJoinThreshold``) and AQE.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions.columns import money
from flowlens.sources.readers import read_table

# ---------------------------------------------------------------------------------------------
# Lead stages in funnel order, event type that stands for each stage, and the
# texts of the no-interest reasons of the lead data set.
STAGES = ["lead", "awareness", "consideration", "conversion"]
STAGE_OF_EVENT = {"view": "lead", "click": "awareness", "signup": "consideration", "purchase": "conversion"}
# call reason per stage: (value < 100, value >= 100)
CALL_REASONS = {
    "lead": ("lead_introduction", "demo_scheduled"),
    "awareness": ("after_demo_followup", "demo_reminder"),
    "consideration": ("consideration_followup", "pricing_query"),
    "conversion": ("successful_conversion", "payment_followup"),
}
REASON_TEXTS = [
    "Wants offline classes",
    "Can't afford",
    "Student not interested in domain",
    "No time for student",
    "Will join in final year",
    "Cannot afford",
]
REASON_COLUMNS = [
    "reasons_for_not_interested_in_demo",
    "reasons_for_not_interested_to_consider",
    "reasons_for_not_interested_to_convert",
]
SUCCESS_VALUE = 25.0  # event value at or above which a call counts as successful
# ---------------------------------------------------------------------------------------------

SALES_COLUMNS = [
    "invoice_and_item_number", "date", "store_number", "store_name", "county", "item_description",
    "sale_dollars", "bottles_sold", "volume_sold_liters", "state_bottle_retail", "state_bottle_cost",
]


def sales_view(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Retail sales lines: one row per lineitem.

    invoice = order-line, date = ship date, county = customer nation, store = supplier,
    item = part name, dollars = extended price, bottles = quantity, litres = quantity × size,
    retail = part retail price, cost = retail × (1 - discount).
    """
    cols = list(columns) if columns else list(SALES_COLUMNS)
    need = set(cols)
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_discount", "l_shipdate",
    )
    df = li
    if "county" in need:
        orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
        customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
        nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
        cust_nation = customer.join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey, "left")
        order_county = orders.join(cust_nation, orders.o_custkey == cust_nation.c_custkey, "left").select(
            "o_orderkey", F.col("n_name").alias("county")
        )
        df = df.join(order_county, df.l_orderkey == order_county.o_orderkey, "left")
    if "store_name" in need:
        supplier = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name"])
        df = df.join(supplier, df.l_suppkey == supplier.s_suppkey, "left")
    if need & {"item_description", "volume_sold_liters", "state_bottle_retail", "state_bottle_cost"}:
        part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_size", "p_retailprice"])
        df = df.join(part, df.l_partkey == part.p_partkey, "left")

    exprs: dict[str, Column] = {
        "invoice_and_item_number": F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")),
        "date": F.to_date("l_shipdate"),
        "invoice_number": F.shiftleft(F.col("l_orderkey").cast("bigint"), 8).bitwiseOR(F.col("l_linenumber").cast("bigint")),
        "store_number": F.col("l_suppkey"),
        "store_name": F.col("s_name"),
        "county": F.col("county"),
        "item_description": F.col("p_name"),
        "sale_dollars": F.col("l_extendedprice"),
        "bottles_sold": F.col("l_quantity").cast("bigint"),
        "volume_sold_liters": F.col("l_quantity") * F.col("p_size"),
        "state_bottle_retail": F.col("p_retailprice"),
        "state_bottle_cost": F.col("p_retailprice") * (F.lit(1.0) - F.col("l_discount")),
    }
    return df.select(*[exprs[c].alias(c) for c in cols])


def sales_totals(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """(key, total): sales of ``sales_view`` added up by county or item, before a dimension is joined.

    Lines are added up by the fact's own key, so a join takes one row a key: an order, then a customer, or a part. Totals are
    exact decimals.
    """
    part, dims = {
        "county": ("l_orderkey", [("orders", "o_orderkey", "o_custkey"), ("customer", "c_custkey", "c_nationkey"), ("nation", "n_nationkey", "n_name")]),
        "item_description": ("l_partkey", [("part", "p_partkey", "p_name")]),
    }[key]
    df = read_table(spark, sf_dir, "lineitem", [part, "l_extendedprice"]).groupBy(part).agg(F.sum(money("l_extendedprice")).alias("total"))
    for name, own, further in dims:
        dim = read_table(spark, sf_dir, name, [own, further])
        dim = F.broadcast(dim) if name == "nation" else dim
        df = df.join(dim, F.col(part) == F.col(own), "left").groupBy(further).agg(F.sum("total").cast("decimal(38,2)").alias("total"))
        part = further
    return df.withColumnRenamed(part, key)


def record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as text records (quantity, "price", discount, label), some of them broken by their line number.

    Line 4 of an order has a word for its quantity, line 5 lacks label and discount, line 6 is blank, line 7 has one field.
    """
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag"])
    n = F.col("l_linenumber")
    quantity = F.when(n == 4, "many").otherwise(F.col("l_quantity").cast("decimal(12,2)").cast("string"))
    price = F.format_string('"%s"', F.col("l_extendedprice").cast("decimal(12,2)").cast("string"))
    rest = F.when(n != 5, F.concat(F.lit(", "), F.col("l_discount").cast("decimal(12,2)").cast("string"), F.lit(","), F.when(F.col("l_returnflag") == "R", "1").otherwise("0")))
    whole = F.concat(quantity, F.lit(","), price, F.coalesce(rest, F.lit("")))
    line = F.when(n == 6, "  ").when(n == 7, quantity).otherwise(whole)
    return li.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line_id"), line.alias("line"))


def interactions_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lead interactions (calls): one row per event; an event of no stage (error) has a NULL stage and reason."""
    ev = read_table(spark, sf_dir, "events", ["user_id", "event_type", "value", "ts"])
    stage = F.when(F.col("event_type") == "view", "lead")
    for et, st in list(STAGE_OF_EVENT.items())[1:]:
        stage = stage.when(F.col("event_type") == et, st)
    reason = None
    for et, st in STAGE_OF_EVENT.items():
        low, high = CALL_REASONS[st]
        branch = F.when(F.col("value") < 100, low).otherwise(high)
        reason = F.when(F.col("event_type") == et, branch) if reason is None else reason.when(F.col("event_type") == et, branch)
    return ev.select(
        F.col("user_id").alias("lead_id"),
        stage.alias("lead_stage"),
        F.when(F.col("value") >= SUCCESS_VALUE, "successful").otherwise("failed").alias("call_status"),
        reason.alias("call_reason"),
        F.to_date("ts").alias("call_done_date"),
    )


def leads_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leads: one per customer; the market segment stands for the lead source."""
    return read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment", "c_nationkey"]).select(
        F.col("c_custkey").alias("lead_id"),
        F.col("c_mktsegment").alias("lead_gen_source"),
        F.col("c_nationkey").alias("current_city"),
    )


def demo_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demo views: one per document; language = lang, watched % = n_chars / 50 (may exceed 100)."""
    return read_table(spark, sf_dir, "documents", ["doc_id", "lang", "n_chars"]).select(
        F.col("doc_id").alias("lead_id"),
        F.col("lang").alias("language"),
        F.floor(F.col("n_chars") / F.lit(50.0)).cast("int").alias("watched_percentage"),
    )


def _reason_text(source: Column) -> Column:
    idx = F.substring(source, 4, 8).cast("int") % len(REASON_TEXTS)
    out = F.when(idx == 0, REASON_TEXTS[0])
    for i, text in enumerate(REASON_TEXTS[1:], start=1):
        out = out.when(idx == i, text)
    return out


def no_interest_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No-interest reasons: one row per document, exactly one non-NULL reason column.

    Unlabelled documents drop at the demo, quality 0 at consideration, quality 1 at conversion.
    """
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "source"])
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "quality"]).withColumnRenamed("doc_id", "lb_doc_id")
    j = docs.join(labels, docs.doc_id == labels.lb_doc_id, "left")
    reason = _reason_text(F.col("source"))
    return j.select(
        F.col("doc_id").alias("lead_id"),
        F.when(F.col("lb_doc_id").isNull(), reason).alias(REASON_COLUMNS[0]),
        F.when(F.col("quality") == 0, reason).alias(REASON_COLUMNS[1]),
        F.when(F.col("quality") == 1, reason).alias(REASON_COLUMNS[2]),
    )


def managers_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales managers: senior = region, junior = nation, lead = customer; cycle 1-4 by key."""
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    nr = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey, "left")
    j = customer.join(F.broadcast(nr), customer.c_nationkey == nr.n_nationkey, "left")
    return j.select(
        F.col("r_name").alias("snr_sm_id"),
        F.col("n_name").alias("jnr_sm_id"),
        ((F.col("c_custkey") % 4) + 1).cast("int").alias("cycle"),
        F.col("c_custkey").alias("lead_id"),
    )


def edges_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer–supplier edge list: one row per distinct (customer, supplier) pair that traded."""
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_suppkey"])
    return (
        li.join(orders, li.l_orderkey == orders.o_orderkey, "inner")
        .select(F.col("o_custkey").alias("node1"), F.col("l_suppkey").alias("node2"))
        .distinct()
    )


FRAUD_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def labelled_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary labelled rows: four lineitem measures, label = returned ('R'); unique string key."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", *FRAUD_FEATURES])
    return li.select(
        F.concat_ws("|", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("row_id"),
        *FRAUD_FEATURES,
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
    )


def embedding_view(spark: SparkSession, sf_dir: str, binary: bool = True) -> DataFrame:
    """Dense vectors: 64 floats; binary label = (class 0), about 10 % positive."""
    emb = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    label = (F.col("label") == 0).cast("int") if binary else F.col("label")
    return emb.select(F.col("vec_id"), F.col("embedding").cast("array<double>").alias("features"), label.alias("label"))
