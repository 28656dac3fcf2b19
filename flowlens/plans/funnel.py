"""Lead-funnel analyses.

Inputs are the domain views: interactions(lead_id, lead_stage, call_status, call_reason,
call_done_date), leads(lead_id, lead_gen_source), demo(lead_id, language, watched_percentage),
no_interest(lead_id, three reason columns), managers(snr_sm_id, jnr_sm_id, cycle, lead_id).

Stage-level results are always produced from the four-row stage dimension, left-joined to the
aggregates, so a stage without rows reads 0 (the reference's ``.get(stage, 0)``). Aggregates are
grouped by stage first; the per-stage windows then run over four rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowlens.functions.columns import canonicalise, clean_category_name, first_token_lower, r6, safe_div
from flowlens.operators.aggregates import conditional_rate, frequency, mean_gap_days, mean_of_group_distinct, ordered_text
from flowlens.operators.reshape import melt, pivot_count
from flowlens.operators.topk import top_k_per_group
from flowlens.sources.adapters import CALL_REASONS, REASON_COLUMNS, STAGES

REASON_PREFIXES = ["reasons_for_not_interested_in_", "reasons_for_not_interested_to_"]
# Alias → canonical reason (the dynamic flow chart replaces it in the demo column)
CANONICAL_REASONS = {"Can't afford": "Cannot afford"}
# drop stage that each reason column explains (drop into awareness, consideration, conversion)
DROP_STAGE_OF_COLUMN = dict(zip(REASON_COLUMNS, STAGES[1:]))


def stage_dim(spark: SparkSession) -> DataFrame:
    """The four funnel stages with their order (fixed, four rows)."""
    return spark.createDataFrame([(s, i + 1) for i, s in enumerate(STAGES)], "stage string, stage_order int")


def _stage_window() -> Window:
    # four rows: the stage dimension is a fixed-size table
    return Window.orderBy("stage_order")


def leads_per_stage(interactions: DataFrame) -> DataFrame:
    """A3: distinct leads per stage."""
    return interactions.groupBy(F.col("lead_stage").alias("stage")).agg(F.count_distinct("lead_id").alias("leads"))


def distinct_funnel(spark: SparkSession, interactions: DataFrame) -> DataFrame:
    """distinct leads per stage and the drop from the previous stage."""
    per = F.broadcast(leads_per_stage(interactions).filter(F.col("stage").isNotNull()))
    f = stage_dim(spark).join(per, "stage", "left").withColumn("leads", F.coalesce("leads", F.lit(0).cast("bigint")))
    return f.withColumn("dropped", F.lag("leads", 1).over(_stage_window()) - F.col("leads"))


def call_success(spark: SparkSession, interactions: DataFrame) -> DataFrame:
    """Percent of calls with status 'successful' per stage (rows as base), 0 if none."""
    rate = conditional_rate(interactions.withColumnRenamed("lead_stage", "stage"), ["stage"],
                            F.col("call_status") == "successful", "success_rate")
    return stage_dim(spark).join(F.broadcast(rate), "stage", "left").select(
        "stage", "stage_order", F.coalesce(r6("success_rate"), F.lit(0.0)).alias("success_rate")
    )


def stage_conversion(spark: SparkSession, interactions: DataFrame) -> DataFrame:
    """next / prev × 100 when both stages have leads, else 0; one row per stage that has a next."""
    f = distinct_funnel(spark, interactions)
    nxt = F.lead("leads", 1).over(_stage_window())
    f = f.withColumn("next_stage", F.lead("stage", 1).over(_stage_window())).withColumn("next_leads", nxt)
    conv = F.when((F.col("leads") > 0) & (F.col("next_leads") > 0), F.col("next_leads") / F.col("leads") * 100).otherwise(F.lit(0.0))
    return f.filter(F.col("next_stage").isNotNull()).select("stage", "next_stage", r6(conv).alias("conversion_pct"))


def overall_dropoff(interactions: DataFrame) -> DataFrame:
    """distinct leads overall, converted leads, and the difference."""
    return interactions.agg(
        F.count_distinct("lead_id").alias("total_leads"),
        F.count_distinct(F.when(F.col("lead_stage") == "conversion", F.col("lead_id"))).alias("converted_leads"),
    ).withColumn("drop_offs", F.col("total_leads") - F.col("converted_leads"))


def demo_insight(demo: DataFrame, interactions: DataFrame) -> DataFrame:
    """Distinct watchers, attendance % of awareness leads, mean watch %, top language."""
    aware = interactions.agg(
        F.count_distinct(F.when(F.col("lead_stage") == "awareness", F.col("lead_id"))).alias("awareness_leads")
    )
    d = demo.agg(
        F.count_distinct("lead_id").alias("demo_watched_count"),
        r6(F.avg("watched_percentage")).alias("avg_watch_percentage"),
        F.mode("language", True).alias("top_demo_language"),
    )
    out = d.join(aware, how="cross")  # two one-row aggregates
    rate = F.when(F.col("awareness_leads") > 0, F.col("demo_watched_count") / F.col("awareness_leads") * 100).otherwise(F.lit(0.0))
    return out.select("demo_watched_count", r6(rate).alias("demo_attendance_rate"), "avg_watch_percentage", "top_demo_language")


def demo_influence(demo: DataFrame, interactions: DataFrame) -> DataFrame:
    """distinct consideration leads / distinct demo watchers × 100."""
    watched = demo.agg(F.count_distinct("lead_id").alias("demo_watched_counts"))
    cons = interactions.agg(F.count_distinct(F.when(F.col("lead_stage") == "consideration", F.col("lead_id"))).alias("_c"))
    rate = F.when(F.col("demo_watched_counts") > 0, F.col("_c") / F.col("demo_watched_counts") * 100).otherwise(F.lit(0.0))
    return watched.join(cons, how="cross").select("demo_watched_counts", r6(rate).alias("demo_conversion_rate"))


def source_breakdown(leads: DataFrame) -> DataFrame:
    """Leads per source, the top source flagged (count desc, source asc)."""
    f = frequency(leads, "lead_gen_source")
    top = f.orderBy(F.desc("count"), F.asc("lead_gen_source")).limit(1).select(F.col("lead_gen_source").alias("_top"))
    # top-1 is a single row
    return f.join(F.broadcast(top), how="cross").select(
        "lead_gen_source", "count", (F.col("lead_gen_source") == F.col("_top")).alias("is_top")
    )


def reasons_by_category(no_interest: DataFrame) -> DataFrame:
    """per reason column, value counts; the demo column canonicalised first."""
    ni = canonicalise(no_interest, CANONICAL_REASONS, [REASON_COLUMNS[0]])
    long = melt(ni, ["lead_id"], REASON_COLUMNS, "reason_type", "reason")
    return long.groupBy("reason_type", "reason").agg(F.count(F.lit(1)).alias("count")).withColumn(
        "category", clean_category_name("reason_type", REASON_PREFIXES)
    )


def stage_drops(spark: SparkSession, interactions: DataFrame) -> DataFrame:
    """Drop count into each stage with the reason column that explains it (three rows)."""
    f = distinct_funnel(spark, interactions).filter(F.col("dropped").isNotNull())
    cols = spark.createDataFrame(list(DROP_STAGE_OF_COLUMN.items()), "reason_type string, stage string")
    return cols.join(f.select("stage", "dropped"), "stage")


def reasons_pct_of_drop(spark: SparkSession, no_interest: DataFrame, interactions: DataFrame, limit: int | None = 3) -> DataFrame:
    """Reasons per column with % of that stage's drop-off, first ``limit`` by count."""
    long = melt(no_interest, ["lead_id"], REASON_COLUMNS, "reason_type", "reason")
    counts = long.groupBy("reason_type", "reason").agg(F.count(F.lit(1)).alias("count"))
    drops = F.broadcast(stage_drops(spark, interactions))  # three rows
    j = counts.join(drops, "reason_type", "left")
    pct = F.when(F.col("dropped") > 0, F.col("count") / F.col("dropped") * 100).otherwise(F.lit(0.0))
    j = j.withColumn("pct", r6(pct))
    order = [F.desc("count"), F.asc("reason")]
    if limit is None:
        ranked = j.withColumn("rank", F.row_number().over(Window.partitionBy("reason_type").orderBy(*order)))
    else:
        ranked = top_k_per_group(j, ["reason_type"], order, limit)
    return ranked.select("reason_type", "stage", "reason", "count", "pct", "rank")


def reasons_all_stages(no_interest: DataFrame, canonical: bool = False) -> DataFrame:
    """F11 (and P5 when ``canonical``): reasons over all columns, melted and counted."""
    ni = canonicalise(no_interest, CANONICAL_REASONS, REASON_COLUMNS) if canonical else no_interest
    return frequency(melt(ni, ["lead_id"], REASON_COLUMNS, "reason_type", "reason"), "reason")


def top_reason(spark: SparkSession, no_interest: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Top reason per requested column; a missing or all-NULL column gives 'N/A'."""
    columns = columns or REASON_COLUMNS
    present = [c for c in columns if c in no_interest.columns]
    req = spark.createDataFrame([(c,) for c in columns], "reason_type string")
    if not present:
        return req.withColumn("top_reason", F.lit("N/A"))
    long = melt(no_interest, ["lead_id"], present, "reason_type", "reason")
    counts = long.groupBy("reason_type", "reason").agg(F.count(F.lit(1)).alias("count"))
    top = top_k_per_group(counts, ["reason_type"], [F.desc("count"), F.asc("reason")], 1).select("reason_type", "reason")
    return req.join(F.broadcast(top), "reason_type", "left").select("reason_type", F.coalesce("reason", F.lit("N/A")).alias("top_reason"))


def stage_reason_crosstab(interactions: DataFrame) -> DataFrame:
    """(stage × call reason) call counts as a wide table, 0 for missing cells."""
    reasons = sorted({r for pair in CALL_REASONS.values() for r in pair})
    staged = interactions.filter(F.col("lead_stage").isNotNull()).withColumnRenamed("lead_stage", "stage")
    return pivot_count(staged, "stage", "call_reason", reasons)


# F13 lookups: (output name, stage, reason) — fixed values of the flow chart
CALL_LOOKUPS = [
    ("intro_calls", "lead", "lead_introduction"),
    ("demo_scheduled_calls", "lead", "demo_scheduled"),
    ("followup_calls", "awareness", "after_demo_followup"),
    ("converted_calls", "conversion", "successful_conversion"),
]


def call_patterns(interactions: DataFrame) -> DataFrame:
    """Four (stage, reason) call counts, 0 when the pair never occurs. One pass."""
    return interactions.agg(*[
        F.count_if((F.col("lead_stage") == s) & (F.col("call_reason") == r)).alias(n) for n, s, r in CALL_LOOKUPS
    ])


def stage_summary(spark: SparkSession, interactions: DataFrame) -> DataFrame:
    """Leads, conversion to next stage, call success and mean days between calls per stage.

    One aggregate over the interactions serves all four measures."""
    per = interactions.filter(F.col("lead_stage").isNotNull()).groupBy(F.col("lead_stage").alias("stage")).agg(
        F.count_distinct("lead_id").alias("leads"),
        (F.avg(F.when(F.col("call_status") == "successful", 1.0).otherwise(0.0)) * 100.0).alias("success_rate"),
        mean_gap_days(F.col("call_done_date")).alias("avg_days"),
    )
    f = stage_dim(spark).join(F.broadcast(per), "stage", "left").na.fill(0, ["leads", "success_rate", "avg_days"])
    f = f.withColumn("next_leads", F.lead("leads", 1).over(_stage_window()))
    conv = F.when((F.col("leads") > 0) & (F.col("next_leads") > 0), F.col("next_leads") / F.col("leads") * 100).otherwise(F.lit(0.0))
    return f.select("stage", "stage_order", "leads", r6(conv).alias("conversion_pct"), r6("success_rate").alias("success_rate"), "avg_days")


def manager_workload(managers: DataFrame) -> DataFrame:
    """Mean number of distinct cycles per junior manager."""
    return mean_of_group_distinct(managers, "jnr_sm_id", "cycle", "avg_cycles").select(r6("avg_cycles").alias("avg_cycles"))


def success_failure_leads(interactions: DataFrame) -> DataFrame:
    """Distinct leads per (stage, call status)."""
    staged = interactions.filter(F.col("lead_stage").isNotNull())
    return staged.groupBy(F.col("lead_stage").alias("stage"), "call_status").agg(F.count_distinct("lead_id").alias("leads"))


def language_distribution(demo: DataFrame) -> DataFrame:
    """F18."""
    return frequency(demo, "language")


def reason_text(spark: SparkSession, no_interest: DataFrame, interactions: DataFrame, limit: int = 3) -> DataFrame:
    """A24/F10 text: '- reason (n leads, p%)' lines per column, count desc, first ``limit`` lines."""
    r = reasons_pct_of_drop(spark, no_interest, interactions, limit)
    line = F.format_string("- %s (%d leads, %.1f%%)", F.col("reason"), F.col("count"), F.round("pct", 1))
    # ≤ limit lines per reason column
    return ordered_text(r, ["reason_type"], line, [F.col("rank")], "\n", "text")


def reason_names(no_interest: DataFrame, limit: int = 3) -> DataFrame:
    """first ``limit`` reason names per column, then '- ...' when more exist."""
    long = melt(no_interest, ["lead_id"], REASON_COLUMNS, "reason_type", "reason")
    counts = long.groupBy("reason_type", "reason").agg(F.count(F.lit(1)).alias("count"))
    ranked = top_k_per_group(counts, ["reason_type"], [F.desc("count"), F.asc("reason")], limit + 1)
    g = ranked.groupBy("reason_type").agg(
        F.sort_array(F.collect_list(F.when(F.col("rank") <= limit, F.struct("rank", F.concat(F.lit("- "), F.col("reason")).alias("line"))))).alias("lines"),
        F.max("rank").alias("n"),
    )
    text = F.array_join(F.transform("lines", lambda s: s["line"]), "\n")
    return g.select("reason_type", F.when(F.col("n") > limit, F.concat(text, F.lit("\n- ..."))).otherwise(text).alias("text"))


# F16 fixed values: stage node, label of its yes edge, text of its drop node, label of its no edge
DECISION_NODES = [
    ("Lead", "Yes: Interested in Demo", "Drop (No Interest / No Response)", "No"),
    ("Awareness (Demo Video)", "Yes: Post-Demo Follow-up", "Drop (Did Not Attend / No Follow-up Interest)", "No"),
    ("Consideration", "Yes: Interested in Buying", "Drop (Budget / Product Fit)", "No"),
    ("Conversion", None, "Drop (Payment Failed / Last-Minute Change)", "Failed Payment"),
]


def _decision_nodes(spark: SparkSession) -> DataFrame:
    """The four stage nodes; their key is the first word, lower case (P10)."""
    rows = [(*n, i + 1) for i, n in enumerate(DECISION_NODES)]
    named = spark.createDataFrame(rows, "node string, yes string, drop_text string, no string, stage_order int")
    return named.withColumn("stage", first_token_lower("node"))


def decision_funnel_edges(spark: SparkSession, interactions: DataFrame, no_interest: DataFrame, demo: DataFrame) -> DataFrame:
    """F16/P10: the yes/no decision funnel as an edge table (src, dst, kind, label, leads).

    Every drop-off reason hangs on the first drop, as in the reference; the demo's influence hangs on awareness.
    """
    stage_nodes = _decision_nodes(spark).join(distinct_funnel(spark, interactions).select("stage", "leads"), "stage", "left")
    w = Window.orderBy("stage_order")  # four rows
    yes = stage_nodes.withColumn("dst", F.lead("node").over(w)).filter(F.col("dst").isNotNull()).select(
        F.col("node").alias("src"), "dst", F.lit("yes").alias("kind"), F.col("yes").alias("label"), F.col("leads")
    )
    no = stage_nodes.select(
        F.col("node").alias("src"), F.concat(F.lit("Drop "), F.col("stage_order").cast("string")).alias("dst"),
        F.when(F.col("no") == "No", "no").otherwise("failed").alias("kind"), F.col("no").alias("label"),
        F.lit(None).cast("bigint").alias("leads"),
    )
    reasons = reasons_all_stages(no_interest).select(
        F.lit("Drop 1").alias("src"), F.concat(F.lit("Drop-off: "), F.col("reason")).alias("dst"),
        F.lit("reason").alias("kind"), F.lit("").alias("label"), F.col("count").alias("leads"),
    )
    influence = demo_influence(demo, interactions).select(
        F.lit(DECISION_NODES[1][0]).alias("src"), F.lit("Demo Influence").alias("dst"), F.lit("demo").alias("kind"),
        F.lit("").alias("label"), F.col("demo_watched_counts").alias("leads"),
    )
    return yes.unionByName(no).unionByName(reasons).unionByName(influence)


def _one_digit(c) -> Column:
    return F.format_string("%.1f%%", F.round(c, 1))


def decision_funnel_nodes(spark: SparkSession, interactions: DataFrame, no_interest: DataFrame, demo: DataFrame) -> DataFrame:
    """F16: the nodes of the decision funnel (node, kind, label); stage labels carry leads, conversion and call success."""
    f = stage_summary(spark, interactions).select("stage", "leads", "conversion_pct", "success_rate")
    named = _decision_nodes(spark)
    stages = named.join(f, "stage", "left").select("node", F.lit("stage").alias("kind"), F.concat(
        F.col("node"), F.format_string("\n(%d leads)\nConv. Rate: ", "leads"), _one_digit(F.col("conversion_pct")),
        F.lit("\nCall Success: "), _one_digit(F.col("success_rate"))).alias("label"))
    drops = named.select(F.concat(F.lit("Drop "), F.col("stage_order").cast("string")).alias("node"),
                         F.lit("drop").alias("kind"), F.col("drop_text").alias("label"))
    reasons = reasons_all_stages(no_interest).select(
        F.concat(F.lit("Drop-off: "), F.col("reason")).alias("node"), F.lit("reason").alias("kind"),
        F.format_string("%s\n(%d leads)", "reason", "count").alias("label"))
    influence = demo_influence(demo, interactions).select(
        F.lit("Demo Influence").alias("node"), F.lit("demo").alias("kind"),
        F.concat(F.format_string("Demo Watched: %d leads\nConversion Rate: ", "demo_watched_counts"),
                 _one_digit(F.col("demo_conversion_rate"))).alias("label"))
    return stages.unionByName(drops).unionByName(reasons).unionByName(influence)


def reason_edges(spark: SparkSession, no_interest: DataFrame, interactions: DataFrame) -> DataFrame:
    """Interest decision → reason node, labelled with its leads and their share of that stage's drop-off."""
    r = reasons_pct_of_drop(spark, no_interest, interactions, None)
    order = F.array_position(F.array(*[F.lit(c) for c in REASON_COLUMNS]), F.col("reason_type")).cast("string")
    return r.select(
        F.concat(F.lit("Interest"), order).alias("src"),
        F.concat_ws("_", "stage", F.lit("reason"), F.col("rank").cast("string")).alias("dst"),
        F.concat(F.format_string("%d leads (", "count"), _one_digit(F.col("pct")), F.lit(")")).alias("label"),
    )


def row_funnel(leads: DataFrame, demo: DataFrame, interactions: DataFrame, extra: dict | None = None) -> DataFrame:
    """row-count funnel of the dynamic flow chart (may exceed 100 % or go negative, D11).

    ``extra`` (name → aggregate over the interactions) rides along in the same pass."""
    extra = extra or {}
    i = interactions.agg(*[F.count_if(F.col("lead_stage") == s).alias(f"n_{s}") for s in STAGES[1:]],
                         *[e.alias(n) for n, e in extra.items()])
    ld = leads.agg(F.count(F.lit(1)).alias("total_leads"), F.count_distinct("lead_gen_source").alias("n_sources"))
    dm = demo.agg(F.count(F.lit(1)).alias("demo_watched"))
    x = ld.join(dm, how="cross").join(i, how="cross")  # three one-row aggregates
    a, c, v, t = F.col("n_awareness"), F.col("n_consideration"), F.col("n_conversion"), F.col("total_leads")
    return x.select(
        "total_leads", "n_sources", "demo_watched",
        a.alias("lead_to_awareness"), c.alias("awareness_to_consideration"), v.alias("consideration_to_conversion"),
        (t - a).alias("dropout_after_lead"), (a - c).alias("dropout_after_awareness"), (c - v).alias("dropout_after_consideration"),
        r6(safe_div(a, t)).alias("rate_awareness"), r6(safe_div(c, a)).alias("rate_consideration"),
        r6(safe_div(v, c)).alias("rate_conversion"), r6(safe_div(v, t)).alias("overall_rate"),
        *[F.col(n) for n in extra],
    )


def _call_counts() -> dict[str, Column]:
    return {n: F.count_if((F.col("lead_stage") == st) & (F.col("call_reason") == r)) for n, st, r in CALL_LOOKUPS}


# H9 fixed values: clusters of the flow chart and their titles
FLOW_CLUSTERS = [
    ("main_stages", "Customer Acquisition Key Stages (with actual counts)"),
    ("reasons", "Detailed Reasons for No Interest"),
    ("call_flow", "Common Call Interaction Patterns"),
]


def flow_graph_nodes(spark: SparkSession, leads: DataFrame, demo: DataFrame, interactions: DataFrame, no_interest: DataFrame) -> DataFrame:
    """H9: the nodes of the dynamic flow chart (id, cluster, shape, label); dropouts stand outside the clusters.

    A share of nothing reads N/A.
    """
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("count")).alias("o"), "language", "count")))  # one entry a language
    languages = language_distribution(demo).agg(ordered.alias("all")).select(
        F.array_join(F.transform("all", lambda x: F.format_string("'%s': %d", x["language"], x["count"])), ", ").alias("languages"))
    rf = row_funnel(leads, demo, interactions, _call_counts()).join(languages, how="cross")  # two one-row tables

    def share(a, b):
        return F.when(F.col(b) != 0, _one_digit(F.col(a) / F.col(b) * 100)).otherwise(F.lit("N/A"))

    def node(name, cluster, shape, *label):
        return F.struct(F.lit(name).alias("id"), F.lit(cluster).cast("string").alias("cluster"), F.lit(shape).alias("shape"),
                        F.concat(*label).alias("label"))

    def text(pattern, *names):
        return F.format_string(pattern, *names)

    def dropout(i, n, base):
        return node(f"Dropout{i}", None, "diamond", text("Dropout\n%d leads\n(", n), share(n, base), F.lit(")"))

    fixed = rf.select(F.explode(F.array(
        node("Lead", "main_stages", "box", text("Lead\nTotal: %d\nSources: %d", "total_leads", "n_sources")),
        node("Awareness", "main_stages", "box", text("Awareness\nDemo Watched: %d\n({%s})", "demo_watched", "languages")),
        node("Consideration", "main_stages", "box", text("Consideration\nFollow-ups: %d", "awareness_to_consideration")),
        node("Conversion", "main_stages", "box", text("Conversion\nSuccessful: %d\nRate: ", "consideration_to_conversion"),
             share("consideration_to_conversion", "total_leads")),
        dropout(1, "dropout_after_lead", "total_leads"),
        dropout(2, "dropout_after_awareness", "lead_to_awareness"),
        dropout(3, "dropout_after_consideration", "awareness_to_consideration"),
        node("Start", "call_flow", "box", F.lit("Start Call")),
        node("Intro", "call_flow", "box", text("Introduction\n%d calls", "intro_calls")),
        node("Demo", "call_flow", "box", text("Demo Scheduled\n%d calls", "demo_scheduled_calls")),
        node("Followup", "call_flow", "box", text("Follow-up\n%d calls", "followup_calls")),
        node("ConversionCall", "call_flow", "box", text("Conversion Call\n%d calls", "converted_calls")),
    )).alias("n")).select("n.*")
    rc = reasons_by_category(no_interest)
    heads = rc.select(F.concat(F.col("category"), F.lit("_header")).alias("id"), F.lit("reasons").alias("cluster"),
                      F.lit("plaintext").alias("shape"), F.col("category").alias("label")).distinct()
    reasons = rc.select(F.concat_ws("_", "category", "reason").alias("id"), F.lit("reasons").alias("cluster"), F.lit("box").alias("shape"),
                        text("%s: %d leads", "reason", "count").alias("label"))
    return fixed.unionByName(heads).unionByName(reasons)


def flow_graph_edges(spark: SparkSession, leads: DataFrame, demo: DataFrame, interactions: DataFrame, no_interest: DataFrame) -> DataFrame:
    """H9: the dynamic flow chart as edges (src, dst, cluster, value, pct) — main stages, dropouts,
    reasons per category and the call-pattern chain. Layout/rendering is left to the DOT sink."""
    # the call-pattern counts come out of the same aggregate over the interactions
    rf = row_funnel(leads, demo, interactions, _call_counts())

    def edge(src, dst, cluster, value, pct):
        return F.struct(F.lit(src).alias("src"), F.lit(dst).alias("dst"), F.lit(cluster).alias("cluster"),
                        value.cast("bigint").alias("value"), pct.cast("double").alias("pct"))

    def ratio(a, b):
        return r6(safe_div(F.col(a), F.col(b)))

    main = rf.select(F.explode(F.array(
        edge("Lead", "Awareness", "main", F.col("lead_to_awareness"), F.col("rate_awareness")),
        edge("Awareness", "Consideration", "main", F.col("awareness_to_consideration"), F.col("rate_consideration")),
        edge("Consideration", "Conversion", "main", F.col("consideration_to_conversion"), F.col("rate_conversion")),
        edge("Lead", "Dropout1", "dropout", F.col("dropout_after_lead"), ratio("dropout_after_lead", "total_leads")),
        edge("Awareness", "Dropout2", "dropout", F.col("dropout_after_awareness"), ratio("dropout_after_awareness", "lead_to_awareness")),
        edge("Consideration", "Dropout3", "dropout", F.col("dropout_after_consideration"), ratio("dropout_after_consideration", "awareness_to_consideration")),
    )).alias("e")).select("e.*")
    rc = reasons_by_category(no_interest).select(
        F.concat(F.col("category"), F.lit("_header")).alias("src"),
        F.concat_ws("_", F.col("category"), F.col("reason")).alias("dst"),
        F.lit("reasons").alias("cluster"), F.col("count").alias("value"), F.lit(None).cast("double").alias("pct"),
    )
    none = F.lit(None)
    calls = rf.select(F.explode(F.array(
        edge("Start", "Intro", "calls", F.col("intro_calls"), none),
        edge("Intro", "Demo", "calls", F.col("demo_scheduled_calls"), none),
        edge("Demo", "Followup", "calls", F.col("followup_calls"), none),
        edge("Followup", "ConversionCall", "calls", F.col("converted_calls"), none),
    )).alias("e")).select("e.*")
    links = spark.createDataFrame(
        [("Lead", "Start", "link", None, None), ("ConversionCall", "Conversion", "link", None, None)],
        "src string, dst string, cluster string, value bigint, pct double",
    )
    return main.unionByName(rc).unionByName(calls).unionByName(links)
