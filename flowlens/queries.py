"""Registered queries: name → callable(spark, sf_dir) → DataFrame.

Every query reads the driver tables (through ``sources.adapters``) over their whole extent.
Names are the SURVEY §2 id plus a slug; ``flowlens.oracle`` holds the SQL twin of each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions.columns import r6
from flowlens.plans import sales as S
from flowlens.sources import adapters as A

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return deco


# ------------------------------------------------------------------ sales
@query("sl4_kpi_row")
def sl4_kpi_row(spark, d):
    cols = ["invoice_number", "store_number", "sale_dollars", "bottles_sold", "volume_sold_liters",
            "state_bottle_retail", "state_bottle_cost"]
    return S.kpi_row(A.sales_view(spark, d, cols))


@query("sl1_sales_summary")
def sl1_sales_summary(spark, d):
    return S.performance_summary(A.sales_totals(spark, d, "county"), A.sales_totals(spark, d, "item_description"))


@query("sl2_monthly_totals")
def sl2_monthly_totals(spark, d):
    return S.monthly_totals(A.sales_view(spark, d, ["date", "sale_dollars"]))


@query("sl3_detail_with_monthly_total")
def sl3_detail_with_monthly_total(spark, d):
    sales = A.sales_view(spark, d, ["invoice_and_item_number", "date", "sale_dollars"])
    return S.with_monthly_total(sales).select(
        "month", "invoice_and_item_number", F.col("date").cast("string").alias("date"), "sale_dollars", "monthly_total_sales"
    )


@query("a7_max_monthly_total")
def a7_max_monthly_total(spark, d):
    return S.max_monthly_total(S.with_monthly_total(A.sales_view(spark, d, ["date", "sale_dollars"])))


@query("sl5_year_month_series")
def sl5_year_month_series(spark, d):
    return S.year_month_series(A.sales_view(spark, d, ["date", "sale_dollars"]))


# Nullable integer outputs (no next period, first stage, edges without a count) are emitted as
# DOUBLE on both sides of the oracle: pandas renders a nullable INT as float in one engine and as
# integer in the other.
def _nullable_as_double(df, *cols):
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


@query("h5_timeline_chain")
def h5_timeline_chain(spark, d):
    return _nullable_as_double(S.timeline_chain(A.sales_view(spark, d, ["date", "sale_dollars"])), "next_year", "next_month")


@query("sl6_top_counties")
def sl6_top_counties(spark, d):
    return S.top_totals(A.sales_totals(spark, d, "county"), "county", 10)


@query("sl6_top_products")
def sl6_top_products(spark, d):
    return S.top_totals(A.sales_totals(spark, d, "item_description"), "item_description", 10)


_GROWTH_COLS = ["invoice_and_item_number", "date", "county", "store_number", "store_name", "item_description",
                "sale_dollars", "state_bottle_retail", "state_bottle_cost"]


@query("sl7_margin_growth")
def sl7_margin_growth(spark, d):
    g = S.with_margin_and_growth(A.sales_view(spark, d, _GROWTH_COLS))
    return g.select("invoice_and_item_number", "sale_dollars", "prev_month_sales",
                    r6("profit_margin").alias("profit_margin"), r6("sales_growth").alias("sales_growth"))


@query("sl8_enhanced_county_view")
def sl8_enhanced_county_view(spark, d):
    return S.enhanced_county_view(A.sales_view(spark, d, _GROWTH_COLS))


@query("w4_monthly_growth")
def w4_monthly_growth(spark, d):
    g = S.monthly_growth(A.sales_view(spark, d, ["county", "date", "sale_dollars"]))
    return g.select("county", "year", "month", "sales", F.col("prev_sales"), r6("growth").alias("growth"))


@query("a19_first_store_name")
def a19_first_store_name(spark, d):
    return S.first_store_name(A.sales_view(spark, d, ["store_number", "store_name", "date", "invoice_and_item_number"]))


@query("a20_date_range")
def a20_date_range(spark, d):
    r = S.date_range(A.sales_view(spark, d, ["date"]))
    return r.select(F.col("min_date").cast("string").alias("min_date"), F.col("max_date").cast("string").alias("max_date"))


@query("h3_geo_hierarchy")
def h3_geo_hierarchy(spark, d):
    sales = A.sales_view(spark, d, ["county", "store_number", "store_name", "item_description",
                                    "sale_dollars", "date", "invoice_and_item_number"])
    return S.geo_hierarchy(sales, by_county=A.sales_totals(spark, d, "county"))


# ------------------------------------------------------------------ funnel
from flowlens.plans import funnel as FN  # noqa: E402
from flowlens.plans import hierarchy as HR  # noqa: E402


@query("f1_distinct_funnel")
def f1_distinct_funnel(spark, d):
    return _nullable_as_double(FN.distinct_funnel(spark, A.interactions_view(spark, d)), "dropped")


@query("f2_row_funnel")
def f2_row_funnel(spark, d):
    return FN.row_funnel(A.leads_view(spark, d), A.demo_view(spark, d), A.interactions_view(spark, d))


@query("f3_call_success")
def f3_call_success(spark, d):
    return FN.call_success(spark, A.interactions_view(spark, d))


@query("f4_stage_conversion")
def f4_stage_conversion(spark, d):
    return FN.stage_conversion(spark, A.interactions_view(spark, d))


@query("f5_overall_dropoff")
def f5_overall_dropoff(spark, d):
    return FN.overall_dropoff(A.interactions_view(spark, d))


@query("f6_demo_insight")
def f6_demo_insight(spark, d):
    return FN.demo_insight(A.demo_view(spark, d), A.interactions_view(spark, d))


@query("f7_demo_influence")
def f7_demo_influence(spark, d):
    return FN.demo_influence(A.demo_view(spark, d), A.interactions_view(spark, d))


@query("f8_source_breakdown")
def f8_source_breakdown(spark, d):
    return FN.source_breakdown(A.leads_view(spark, d))


@query("f9_reasons_by_category")
def f9_reasons_by_category(spark, d):
    return FN.reasons_by_category(A.no_interest_view(spark, d))


@query("f10_reasons_pct_of_drop")
def f10_reasons_pct_of_drop(spark, d):
    return FN.reasons_pct_of_drop(spark, A.no_interest_view(spark, d), A.interactions_view(spark, d), 3)


@query("h10_reason_nodes")
def h10_reason_nodes(spark, d):
    r = FN.reasons_pct_of_drop(spark, A.no_interest_view(spark, d), A.interactions_view(spark, d), None)
    return r.select(F.concat_ws("_", "stage", F.lit("reason"), F.col("rank").cast("string")).alias("node_id"),
                    "reason_type", "reason", "count", "pct")


@query("f11_reasons_all_stages")
def f11_reasons_all_stages(spark, d):
    return FN.reasons_all_stages(A.no_interest_view(spark, d))


@query("p5_reasons_canonical")
def p5_reasons_canonical(spark, d):
    return FN.reasons_all_stages(A.no_interest_view(spark, d), canonical=True)


@query("f12_top_reason")
def f12_top_reason(spark, d):
    return FN.top_reason(spark, A.no_interest_view(spark, d))


@query("r2_stage_reason_crosstab")
def r2_stage_reason_crosstab(spark, d):
    return FN.stage_reason_crosstab(A.interactions_view(spark, d))


@query("f13_call_patterns")
def f13_call_patterns(spark, d):
    return FN.call_patterns(A.interactions_view(spark, d))


@query("f14_stage_summary")
def f14_stage_summary(spark, d):
    return FN.stage_summary(spark, A.interactions_view(spark, d))


@query("f15_manager_workload")
def f15_manager_workload(spark, d):
    return FN.manager_workload(A.managers_view(spark, d))


@query("f16_decision_funnel_edges")
def f16_decision_funnel_edges(spark, d):
    return _nullable_as_double(FN.decision_funnel_edges(spark, A.interactions_view(spark, d), A.no_interest_view(spark, d),
                                                        A.demo_view(spark, d)), "leads")


@query("f16_decision_funnel_nodes")
def f16_decision_funnel_nodes(spark, d):
    return FN.decision_funnel_nodes(spark, A.interactions_view(spark, d), A.no_interest_view(spark, d), A.demo_view(spark, d))


@query("h10_reason_edges")
def h10_reason_edges(spark, d):
    return FN.reason_edges(spark, A.no_interest_view(spark, d), A.interactions_view(spark, d))


@query("f17_success_failure_leads")
def f17_success_failure_leads(spark, d):
    return FN.success_failure_leads(A.interactions_view(spark, d))


@query("f18_language_distribution")
def f18_language_distribution(spark, d):
    return FN.language_distribution(A.demo_view(spark, d))


@query("a24_reason_text")
def a24_reason_text(spark, d):
    return FN.reason_text(spark, A.no_interest_view(spark, d), A.interactions_view(spark, d), 3)


@query("f19_reason_names")
def f19_reason_names(spark, d):
    return FN.reason_names(A.no_interest_view(spark, d), 3)


@query("h9_flow_graph_edges")
def h9_flow_graph_edges(spark, d):
    return _nullable_as_double(FN.flow_graph_edges(spark, A.leads_view(spark, d), A.demo_view(spark, d),
                                                   A.interactions_view(spark, d), A.no_interest_view(spark, d)), "value")


@query("h9_flow_graph_nodes")
def h9_flow_graph_nodes(spark, d):
    return FN.flow_graph_nodes(spark, A.leads_view(spark, d), A.demo_view(spark, d), A.interactions_view(spark, d), A.no_interest_view(spark, d))


@query("h1_hierarchy_edges")
def h1_hierarchy_edges(spark, d):
    return HR.hierarchy_edges(A.managers_view(spark, d))


@query("h2_hierarchy_nodes")
def h2_hierarchy_nodes(spark, d):
    return HR.hierarchy_nodes(A.managers_view(spark, d))


@query("h6_edge_stats")
def h6_edge_stats(spark, d):
    return HR.edge_stats(A.edges_view(spark, d))


@query("h8_interaction_network")
def h8_interaction_network(spark, d):
    return HR.interaction_network(A.managers_view(spark, d), A.interactions_view(spark, d))


@query("a1_row_counts")
def a1_row_counts(spark, d):
    parts = [A.interactions_view(spark, d).agg(F.count(F.lit(1)).alias("interaction_rows")),
             A.leads_view(spark, d).agg(F.count(F.lit(1)).alias("lead_rows")),
             A.demo_view(spark, d).agg(F.count(F.lit(1)).alias("demo_rows")),
             A.managers_view(spark, d).agg(F.count(F.lit(1)).alias("manager_rows"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, how="cross")  # one-row aggregates
    return out


@query("a2_distinct_counts")
def a2_distinct_counts(spark, d):
    i = A.interactions_view(spark, d).agg(F.count_distinct("lead_id").alias("distinct_leads"))
    s = A.leads_view(spark, d).agg(F.count_distinct("lead_gen_source").alias("distinct_sources"))
    m = A.demo_view(spark, d).agg(F.count_distinct("language").alias("distinct_languages"))
    return i.join(s, how="cross").join(m, how="cross")  # one-row aggregates


# ------------------------------------------------------------------ sampling, scaling, models, evaluation
from flowlens.operators import evaluate as EV  # noqa: E402
from flowlens.operators import linear as LN  # noqa: E402
from flowlens.operators import sampling as SM  # noqa: E402
from flowlens.operators.aggregates import moments  # noqa: E402
from flowlens.operators.scaling import standardize, with_intercept  # noqa: E402
from flowlens.plans import fraud as FR  # noqa: E402

_FEAT = A.FRAUD_FEATURES


def _r6_all(df, cols):
    return df.select(*[r6(c).alias(c) if c in cols else F.col(c) for c in df.columns])


@query("m1_random_split")
def m1_random_split(spark, d):
    return SM.random_split(A.labelled_view(spark, d).select("row_id", "label"), "row_id", 0.8, FR.SEED)


@query("m2_stratified_split")
def m2_stratified_split(spark, d):
    return SM.stratified_split(A.labelled_view(spark, d).select("row_id", "label"), "row_id", "label", FR.TEST_SIZE, FR.SEED)


@query("m4_sample_n_per_class")
def m4_sample_n_per_class(spark, d):
    return SM.sample_n(A.labelled_view(spark, d).select("row_id", "label"), "row_id", 100, FR.SEED, ["label"])


@query("h7_edge_sample")
def h7_edge_sample(spark, d):
    return SM.sample_n(A.edges_view(spark, d), ["node1", "node2"], 30, FR.SEED)


@query("m5_fraction_sample")
def m5_fraction_sample(spark, d):
    return SM.sample_fraction(A.labelled_view(spark, d).select("row_id", "label"), "row_id", 0.1, FR.SEED)


@query("m6_undersample_to_minority")
def m6_undersample_to_minority(spark, d):
    return SM.undersample_to_minority(A.embedding_view(spark, d).select("vec_id", "label"), "vec_id", "label", FR.SEED)


@query("m7_undersample_ratio")
def m7_undersample_ratio(spark, d):
    return SM.undersample_ratio(A.embedding_view(spark, d).select("vec_id", "label"), "vec_id", "label", 0.5, FR.SEED)


@query("m8_undersample_one_to_one")
def m8_undersample_one_to_one(spark, d):
    return SM.undersample_ratio(A.embedding_view(spark, d).select("vec_id", "label"), "vec_id", "label", 1.0, FR.SEED)


@query("m15_balanced_weights")
def m15_balanced_weights(spark, d):
    w = SM.balanced_weights(A.labelled_view(spark, d).select("row_id", "label"), "label")
    return w.groupBy("label", r6("weight").alias("weight")).agg(F.count(F.lit(1)).alias("count"))


@query("m16_class_counts")
def m16_class_counts(spark, d):
    return SM.class_counts(A.embedding_view(spark, d), "label")


@query("m17_curated_subset")
def m17_curated_subset(spark, d):
    lv = A.labelled_view(spark, d).select("row_id", "label")
    return SM.curated_subset(lv, "row_id", "label", {0: 49, 1: 1}, {0: 490, 1: 10}, FR.SEED)


@query("a21_moments")
def a21_moments(spark, d):
    m = moments(A.labelled_view(spark, d), _FEAT, zero_std_to_one=False)
    return _r6_all(m, m.columns)


@query("m10_standardize_one")
def m10_standardize_one(spark, d):
    lv = A.labelled_view(spark, d).select("row_id", "l_extendedprice")
    return _r6_all(standardize(lv, ["l_extendedprice"]), ["l_extendedprice"])


@query("m12_standardize_all")
def m12_standardize_all(spark, d):
    lv = A.labelled_view(spark, d).select("row_id", *_FEAT)
    return _r6_all(standardize(lv, _FEAT), _FEAT)


@query("m11_scale_test_with_train")
def m11_scale_test_with_train(spark, d):
    s = FR.split_and_scale(A.labelled_view(spark, d)).filter(~F.col("is_train")).select("row_id", *_FEAT)
    return _r6_all(s, _FEAT)


@query("m13_amount_then_intercept")
def m13_amount_then_intercept(spark, d):
    lv = A.labelled_view(spark, d).select("row_id", "l_extendedprice", "label")
    return _r6_all(with_intercept(standardize(lv, ["l_extendedprice"])), ["l_extendedprice"])


@query("t1_scores")
def t1_scores(spark, d):
    s = FR.scored_test(spark, A.labelled_view(spark, d))
    return s.select("row_id", "label", r6("probability").alias("probability"), "prediction")


@query("t8_log_loss")
def t8_log_loss(spark, d):
    return LN.log_loss(FR.scored_test(spark, A.labelled_view(spark, d))).select(r6("log_loss").alias("log_loss"))


@query("e1_confusion")
def e1_confusion(spark, d):
    return EV.confusion(FR.scored_test(spark, A.labelled_view(spark, d)))


@query("e3_threshold_metrics")
def e3_threshold_metrics(spark, d):
    return EV.threshold_metrics(FR.scored_test(spark, A.labelled_view(spark, d)), [0.3, 0.5, 0.7])


GRID = [0.1 + i * 0.01 for i in range(40)]  # np.arange(0.1, 0.5, 0.01)


@query("e7_grid_threshold")
def e7_grid_threshold(spark, d):
    return EV.grid_best_threshold(FR.scored_test(spark, A.labelled_view(spark, d)), GRID)


@query("e4_roc_auc")
def e4_roc_auc(spark, d):
    return EV.roc_auc(FR.exact_scored_test(A.labelled_view(spark, d)))


@query("e5_pr_curve")
def e5_pr_curve(spark, d):
    return EV.pr_curve(FR.exact_scored_test(A.labelled_view(spark, d)))


@query("e6_best_f1_threshold")
def e6_best_f1_threshold(spark, d):
    return EV.best_f1_threshold(EV.pr_curve(FR.exact_scored_test(A.labelled_view(spark, d))))


@query("e8_classification_report")
def e8_classification_report(spark, d):
    return EV.classification_report(FR.scored_test(spark, A.labelled_view(spark, d)))


def _weights_df(spark, weights):
    names = ["w_bias"] + [f"w_{c}" for c in _FEAT]
    # + 0.0 turns a -0.0 from rounding into +0.0
    return spark.createDataFrame([tuple(round(float(w), 6) + 0.0 for w in weights)], ", ".join(f"{n} double" for n in names))


GD_VARIANTS = {
    "t2_gd_mean": LN.GDConfig(learning_rate=0.01, n_iterations=100),
    "t3_gd_l2_all": LN.GDConfig(learning_rate=0.01, n_iterations=100, l2=0.1, l2_bias=True),
    "t4_gd_l2_bias_free": LN.GDConfig(learning_rate=0.1, n_iterations=50, l2=0.01, clip_z=20.0, patience=5),
    "t5_gd_summed": LN.GDConfig(learning_rate=1e-5, n_iterations=100, mean_gradient=False),  # a step is lr times the number of rows
}
WEIGHTED = LN.GDConfig(learning_rate=0.01, n_iterations=100, weight_col="sw")
HISTORY = LN.GDConfig(learning_rate=0.01, n_iterations=100, l2=0.01, clip_z=20.0, patience=5)
ESTIMATOR = {"learning_rate": 0.1, "n_iterations": 100}
STOPPED = LN.GDConfig(learning_rate=250.0, n_iterations=50, l2=0.01, clip_z=20.0, patience=5)  # overshoots, so patience ends it


def _gd_query(name, cfg):
    def fn(spark, d):
        return _weights_df(spark, FR.train_gd(A.labelled_view(spark, d), cfg).weights)
    QUERIES[name] = fn


for _n, _c in GD_VARIANTS.items():
    _gd_query(_n, _c)


@query("t6_gd_weighted")
def t6_gd_weighted(spark, d):
    train = FR.split_and_scale(A.labelled_view(spark, d), columns=[*_FEAT, "label"]).filter("is_train")
    w = SM.balanced_weights(train, "label", "sw")
    res = LN.fit_logistic_gd(w, _FEAT, "label", WEIGHTED)
    return _weights_df(spark, res.weights)


@query("t13_coefficients")
def t13_coefficients(spark, d):
    res = FR.train_gd(A.labelled_view(spark, d), GD_VARIANTS["t2_gd_mean"])
    t = LN.coefficient_table(spark, [round(w, 6) for w in res.weights], _FEAT)
    return t


@query("t7_estimator")
def t7_estimator(spark, d):
    """The estimator with balanced class weights: confusion of its predictions on the test split at two thresholds."""
    data = FR.split_and_scale(A.labelled_view(spark, d), columns=[*_FEAT, "label"])
    model = LN.LogisticRegressionGD(class_weight="balanced", **ESTIMATOR).fit(data.filter("is_train"), _FEAT)
    test = model.predict_proba(data.filter("NOT is_train"))
    return EV.threshold_metrics(test, [0.45, 0.5])


@query("e10_cost_history")
def e10_cost_history(spark, d):
    h = FR.train_gd(A.labelled_view(spark, d), HISTORY).history_df(spark)
    return h.select("iteration", F.round("loss", 6).alias("loss"), F.round("accuracy", 6).alias("accuracy"))


@query("t4_early_stop")
def t4_early_stop(spark, d):
    """Passes run before patience ended the fit, and the weights kept, those of the best pass."""
    res = FR.train_gd(A.labelled_view(spark, d), STOPPED)
    return _weights_df(spark, res.weights).withColumn("passes", F.lit(res.iterations).cast("int"))


@query("e9_rebalancing_comparison")
def e9_rebalancing_comparison(spark, d):
    return FR.rebalancing_comparison(spark, A.labelled_view(spark, d), n_iterations=100)


# ------------------------------------------------------------------ kNN and SMOTE (embeddings, minority = class 0)
from flowlens.operators import knn as KN  # noqa: E402
from flowlens.operators import knn_lsh as KL  # noqa: E402


@query("j7_knn_minority")
def j7_knn_minority(spark, d):
    e = A.embedding_view(spark, d).filter(F.col("label") == 1)
    nn = KN.knn_self_join(e, "vec_id", "features", k=5, n_pivots=4)
    return nn.select("vec_id", "neighbor_id", "rank", r6("distance").alias("distance"))


@query("j7_knn_lsh")
def j7_knn_lsh(spark, d):
    e = A.embedding_view(spark, d)
    nn = KL.knn_lsh_join(e, "vec_id", "features", k=5, query=F.col("vec_id") % 20 == 0)
    return nn.select("vec_id", "neighbor_id", "rank", r6("distance").alias("distance"))


@query("m9_smote")
def m9_smote(spark, d):
    s = KN.smote(A.embedding_view(spark, d), "vec_id", "features", "label", k=5, ratio=1.0, seed=FR.SEED)
    norm = F.sqrt(F.aggregate(F.transform("features", lambda x: x * x), F.lit(0.0), lambda a, b: a + b))
    return s.select("syn_id", "base_id", "neighbor_id", r6("gap").alias("gap"), r6(norm).alias("norm"), "label")


# ------------------------------------------------------------------ ML-library operators (rows-only checks)
from flowlens.operators import mlmodels as ML  # noqa: E402
from flowlens.session import ensure_checkpoint_dir  # noqa: E402


def _emb_split(spark, d, binary):
    e = A.embedding_view(spark, d, binary=binary)
    return SM.stratified_split(e, "vec_id", "label", 0.2, FR.SEED)


@query("t9_mllib_logistic")
def t9_mllib_logistic(spark, d):
    data = FR.split_and_scale(A.labelled_view(spark, d), columns=[*_FEAT, "label"])
    m = ML.mllib_logistic(data.filter("is_train"), _FEAT, max_iter=100)
    return ML.accuracy(m, data.filter(~F.col("is_train")), _FEAT).withColumn("model", F.lit("mllib_logistic"))


@query("t10_ovr_linear_svc")
def t10_ovr_linear_svc(spark, d):
    data = _emb_split(spark, d, binary=False)
    m = ML.ovr_linear_svc(data.filter("is_train"), "features", parallelism=5)
    return ML.accuracy(m, data.filter(~F.col("is_train")), "features").withColumn("model", F.lit("ovr_linear_svc"))


@query("t11_decision_tree")
def t11_decision_tree(spark, d):
    data = _emb_split(spark, d, binary=False)
    m = ML.decision_tree(data.filter("is_train"), "features")
    return ML.accuracy(m, data.filter(~F.col("is_train")), "features").withColumn("model", F.lit("decision_tree"))


@query("t12_tree_nodes")
def t12_tree_nodes(spark, d):
    data = _emb_split(spark, d, binary=False)
    m = ML.decision_tree(data.filter("is_train"), "features")  # the tree of T11
    base = ensure_checkpoint_dir(spark).rstrip("/")
    import uuid

    return ML.tree_nodes(m, f"{base}/tree-{uuid.uuid4().hex}")


# ------------------------------------------------------------------ sources, sinks, reshaping, labels
from flowlens.functions.columns import (  # noqa: E402
    lenient_date, millions_label, pct_label, prefix_ellipsis, signed_growth_label, thousands_label, usd_label,
)
from flowlens.sources.readers import read_warehouse, sql_source  # noqa: E402
from flowlens.sources.records import parse_records  # noqa: E402
from flowlens.sources.sinks import dot_lines  # noqa: E402

SENIOR = "ASIA"


@query("s5_format_scan")
def s5_format_scan(spark, d):
    li = read_warehouse(spark, "parquet", path=f"{d}/lineitem.parquet")
    return li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("rows"))


@query("s6_sql_source")
def s6_sql_source(spark, d):
    sales = A.sales_view(spark, d, ["invoice_and_item_number", "sale_dollars"])
    return sql_source(spark, "SELECT COUNT(*) AS n_rows, CAST(SUM(CAST(sale_dollars AS DECIMAL(18,2))) AS DOUBLE) AS total "
                             "FROM flowlens_sales", {"flowlens_sales": sales})


@query("s10_dot_hierarchy")
def s10_dot_hierarchy(spark, d):
    m = A.managers_view(spark, d)
    nodes = HR.hierarchy_nodes(m).select(F.col("node").alias("id"), F.concat_ws(": ", "kind", "node").alias("label"))
    return dot_lines("SalesHierarchy", nodes, HR.hierarchy_edges(m).select("src", "dst"))


@query("s10_dot_flow_chart")
def s10_dot_flow_chart(spark, d):
    views = A.leads_view(spark, d), A.demo_view(spark, d), A.interactions_view(spark, d), A.no_interest_view(spark, d)
    clusters = spark.createDataFrame(FN.FLOW_CLUSTERS, "cluster string, label string")
    return dot_lines("Customer_Acquisition_Flow", FN.flow_graph_nodes(spark, *views), FN.flow_graph_edges(spark, *views).select("src", "dst"),
                     clusters=clusters)


@query("r3_reason_stage_crosstab")
def r3_reason_stage_crosstab(spark, d):
    from flowlens.operators.reshape import melt, pivot_count

    long = melt(A.no_interest_view(spark, d), ["lead_id"], A.REASON_COLUMNS, "reason_type", "reason")
    return pivot_count(long, "reason", "reason_type", A.REASON_COLUMNS)


@query("s4_record_parse")
def s4_record_parse(spark, d):
    """Records as text lines, some of them broken: rows, repaired fields and exact feature totals by label."""
    good, _ = parse_records(A.record_lines(spark, d), "line_id", "line", n_features=3)
    cents = [F.sum(F.round(F.col("features")[i] * 100).cast("bigint")).alias(f"cents_{i}") for i in range(3)]
    return good.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n_repaired").alias("n_repaired"), *cents)


@query("s4_record_rejects")
def s4_record_rejects(spark, d):
    """Every record that was not taken, with the reason."""
    _, rejects = parse_records(A.record_lines(spark, d), "line_id", "line", n_features=3)
    return rejects


@query("p3_senior_hierarchy")
def p3_senior_hierarchy(spark, d):
    return HR.hierarchy_edges(A.managers_view(spark, d), senior=SENIOR)


@query("p6_lenient_dates")
def p6_lenient_dates(spark, d):
    """Orders by the year of a date given as text, some of which is no date."""
    o = A.read_table(spark, d, "orders", ["o_orderkey", "o_orderdate"])
    text = F.when(F.col("o_orderkey") % 7 == 0, F.lit("n/a")).when(F.col("o_orderkey") % 11 == 0, F.lit("1996-02-30"))
    text = text.otherwise(F.to_date("o_orderdate").cast("string"))
    return o.groupBy(F.year(lenient_date(text)).cast("double").alias("year")).agg(F.count(F.lit(1)).alias("n_orders"))


@query("p12_number_labels")
def p12_number_labels(spark, d):
    """Every kind of number label over the counties' months: whole dollars, millions, thousands, percent, signed growth."""
    m = S.monthly_growth(A.sales_view(spark, d, ["county", "date", "sale_dollars"]))
    return m.select(
        "county", "year", "month", usd_label("sales").alias("dollars"), millions_label("sales").alias("millions"),
        thousands_label("sales").alias("thousands"), pct_label("growth").alias("percent"), signed_growth_label("growth").alias("growth_label"),
    )


@query("p16_missing_column")
def p16_missing_column(spark, d):
    return FN.top_reason(spark, A.no_interest_view(spark, d), [*A.REASON_COLUMNS, "reason_not_recorded"])


@query("p12_drilldown_labels")
def p12_drilldown_labels(spark, d):
    t = S.enhanced_county_view(A.sales_view(spark, d, _GROWTH_COLS))
    return t.select("county", "store_number", "item_description",
                    prefix_ellipsis("item_description", 15).alias("product_label"),
                    usd_label("product_sales").alias("sales_label"))
