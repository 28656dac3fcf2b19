"""SQL twins of the registered queries, for the DuckDB correctness oracle.

Each view of ``sources.adapters`` has a CTE here written from the same fixed values, so the
Spark plan and the oracle read the same rows. Money sums go through DECIMAL(18,2) (exact in
both engines); ratios are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

from flowlens.sources.adapters import CALL_REASONS, REASON_COLUMNS, REASON_TEXTS, STAGE_OF_EVENT, SUCCESS_VALUE


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


MONEY = "CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)"


def money(c: str) -> str:
    return MONEY.format(c=c)


SALES = """sales AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS invoice_and_item_number,
         CAST(l.l_shipdate AS DATE) AS date,
         s.s_suppkey AS store_number, s.s_name AS store_name,
         n.n_name AS county, p.p_name AS item_description,
         l.l_extendedprice AS sale_dollars,
         CAST(l.l_quantity AS BIGINT) AS bottles_sold,
         l.l_quantity * p.p_size AS volume_sold_liters,
         p.p_retailprice AS state_bottle_retail,
         p.p_retailprice * (1.0 - l.l_discount) AS state_bottle_cost
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey)"""


def _stage_case() -> str:
    return "CASE event_type " + " ".join(f"WHEN {q(e)} THEN {q(s)}" for e, s in STAGE_OF_EVENT.items()) + " END"


def _reason_case() -> str:
    parts = []
    for e, s in STAGE_OF_EVENT.items():
        low, high = CALL_REASONS[s]
        parts.append(f"WHEN {q(e)} THEN CASE WHEN value < 100 THEN {q(low)} ELSE {q(high)} END")
    return "CASE event_type " + " ".join(parts) + " END"


INTERACTIONS = f"""interactions AS (
  SELECT user_id AS lead_id, {_stage_case()} AS lead_stage,
         CASE WHEN value >= {SUCCESS_VALUE} THEN 'successful' ELSE 'failed' END AS call_status,
         {_reason_case()} AS call_reason,
         CAST(ts AS DATE) AS call_done_date
  FROM events)"""

LEADS = """leads AS (
  SELECT c_custkey AS lead_id, c_mktsegment AS lead_gen_source, c_nationkey AS current_city FROM customer)"""

DEMO = """demo AS (
  SELECT doc_id AS lead_id, lang AS language, CAST(floor(n_chars / 50.0) AS INTEGER) AS watched_percentage FROM documents)"""


def _reason_text() -> str:
    idx = f"(CAST(substr(d.source, 4, 8) AS INTEGER) % {len(REASON_TEXTS)})"
    return "CASE " + " ".join(f"WHEN {idx} = {i} THEN {q(t)}" for i, t in enumerate(REASON_TEXTS)) + " END"


NO_INTEREST = f"""no_interest AS (
  SELECT d.doc_id AS lead_id,
         CASE WHEN lb.doc_id IS NULL THEN {_reason_text()} END AS {REASON_COLUMNS[0]},
         CASE WHEN lb.quality = 0 THEN {_reason_text()} END AS {REASON_COLUMNS[1]},
         CASE WHEN lb.quality = 1 THEN {_reason_text()} END AS {REASON_COLUMNS[2]}
  FROM documents d LEFT JOIN labels lb ON d.doc_id = lb.doc_id)"""

MANAGERS = """managers AS (
  SELECT r.r_name AS snr_sm_id, n.n_name AS jnr_sm_id, CAST(c.c_custkey % 4 + 1 AS INTEGER) AS cycle, c.c_custkey AS lead_id
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""

EDGES = """edges AS (
  SELECT DISTINCT o.o_custkey AS node1, l.l_suppkey AS node2
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

LABELLED = """labelled AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) || '|' || CAST(l_partkey AS VARCHAR) || '|' || CAST(l_suppkey AS VARCHAR) AS row_id,
         l_quantity, l_extendedprice, l_discount, l_tax, CAST(l_returnflag = 'R' AS INTEGER) AS label
  FROM lineitem)"""

EMBEDDED = """embedded AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS features, CAST(label = 0 AS INTEGER) AS label FROM embeddings)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLE: dict[str, str] = {}


def _positive_zero_rounds(sql: str) -> str:
    """Wrap every ``ROUND(...)`` as ``(ROUND(...) + 0.0::DOUBLE)``.

    DuckDB's ROUND keeps the sign of a value that rounds to zero (-0.0) while Spark's returns
    +0.0; adding +0.0 turns -0.0 into +0.0 and changes nothing else.
    """
    out, i = [], 0
    while True:
        j = sql.find("ROUND(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len("ROUND")
        while True:
            ch = sql[k]
            depth += ch == "("
            depth -= ch == ")"
            k += 1
            if depth == 0:
                break
        inner = _positive_zero_rounds(sql[j + len("ROUND("):k - 1])
        out.append(sql[i:j] + "(ROUND(" + inner + ") + 0.0::DOUBLE)")
        i = k


def register(name: str, sql: str) -> None:
    ORACLE[name] = _positive_zero_rounds(sql)


# ------------------------------------------------------------------ sales (SL*, H3-H5, W*, A*)
register("sl4_kpi_row", with_(SALES) + f"""
SELECT {money('sale_dollars')} AS total_sales,
       CAST(SUM(bottles_sold) AS BIGINT) AS total_bottles,
       ROUND(SUM(volume_sold_liters), 6) AS total_liters,
       ROUND(AVG(state_bottle_retail - state_bottle_cost), 6) AS profit_per_bottle,
       ROUND({money('sale_dollars')} / COUNT(DISTINCT invoice_and_item_number), 6) AS aov,
       ROUND(COUNT(DISTINCT invoice_and_item_number) / COUNT(DISTINCT store_number), 6) AS aof
FROM sales""")

register("sl1_sales_summary", with_(SALES) + f"""
SELECT (SELECT {money('sale_dollars')} FROM sales) AS total_sales,
       (SELECT item_description FROM sales GROUP BY item_description
         ORDER BY SUM(CAST(sale_dollars AS DECIMAL(18,2))) DESC, item_description ASC LIMIT 1) AS top_product,
       (SELECT county FROM sales GROUP BY county
         ORDER BY SUM(CAST(sale_dollars AS DECIMAL(18,2))) DESC, county ASC NULLS LAST LIMIT 1) AS top_county""")

register("sl2_monthly_totals", with_(SALES) + f"""
SELECT CAST(month(date) AS INTEGER) AS month, {money('sale_dollars')} AS monthly_total_sales
FROM sales GROUP BY 1""")

register("sl3_detail_with_monthly_total", with_(SALES) + f"""
, d AS (SELECT invoice_and_item_number, date, sale_dollars, CAST(month(date) AS INTEGER) AS month FROM sales)
, m AS (SELECT month, {money('sale_dollars')} AS monthly_total_sales FROM d GROUP BY month)
SELECT d.month, d.invoice_and_item_number, CAST(d.date AS VARCHAR) AS date, d.sale_dollars, m.monthly_total_sales
FROM d LEFT JOIN m ON d.month = m.month""")

register("a7_max_monthly_total", with_(SALES) + f"""
, d AS (SELECT sale_dollars, CAST(month(date) AS INTEGER) AS month FROM sales)
, m AS (SELECT month, {money('sale_dollars')} AS monthly_total_sales FROM d GROUP BY month)
SELECT d.month, MAX(m.monthly_total_sales) AS max_monthly_total FROM d LEFT JOIN m ON d.month = m.month GROUP BY d.month""")

register("sl5_year_month_series", with_(SALES) + f"""
SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, {money('sale_dollars')} AS sales
FROM sales GROUP BY 1, 2""")

register("h5_timeline_chain", with_(SALES) + f"""
, ym AS (SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, {money('sale_dollars')} AS sales
         FROM sales GROUP BY 1, 2)
SELECT year, month, sales,
       CAST(LEAD(year) OVER (ORDER BY year, month) AS DOUBLE) AS next_year,
       CAST(LEAD(month) OVER (ORDER BY year, month) AS DOUBLE) AS next_month
FROM ym""")

register("sl6_top_counties", with_(SALES) + f"""
SELECT county, {money('sale_dollars')} AS sales FROM sales GROUP BY county
ORDER BY sales DESC, county ASC NULLS LAST LIMIT 10""")

register("sl6_top_products", with_(SALES) + f"""
SELECT item_description, {money('sale_dollars')} AS sales FROM sales GROUP BY item_description
ORDER BY sales DESC, item_description ASC NULLS LAST LIMIT 10""")

_GROWTH = """
, base AS (
  SELECT *, CASE WHEN state_bottle_retail = 0 THEN NULL
                 ELSE (state_bottle_retail - state_bottle_cost) / state_bottle_retail END AS profit_margin,
         LAG(sale_dollars) OVER (PARTITION BY county, store_number, item_description
                                 ORDER BY date, invoice_and_item_number) AS prev_month_sales
  FROM sales)
, b2 AS (SELECT *, CASE WHEN prev_month_sales = 0 THEN NULL
                        ELSE (sale_dollars - prev_month_sales) / prev_month_sales END AS sales_growth FROM base)"""

register("sl7_margin_growth", with_(SALES) + _GROWTH + """
SELECT invoice_and_item_number, sale_dollars, prev_month_sales,
       ROUND(profit_margin, 6) AS profit_margin, ROUND(sales_growth, 6) AS sales_growth
FROM b2""")

register("sl8_enhanced_county_view", with_(SALES) + _GROWTH + f"""
, counties AS (
  SELECT county, {money('sale_dollars')} AS county_sales, AVG(sales_growth) AS county_growth
  FROM b2 GROUP BY county ORDER BY county_sales DESC, county ASC NULLS LAST LIMIT 10)
, c2 AS (SELECT *, MAX(county_sales) OVER () AS max_county_sales FROM counties)
, stores AS (
  SELECT county, store_number, store_name, {money('sale_dollars')} AS store_sales, AVG(sales_growth) AS store_growth
  FROM b2 WHERE county IN (SELECT county FROM counties) GROUP BY 1, 2, 3)
, s2 AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY county ORDER BY store_sales DESC, store_number, store_name) AS INTEGER) AS store_rank FROM stores)
, s3 AS (SELECT *, MAX(store_sales) OVER (PARTITION BY county) AS max_store_sales FROM s2 WHERE store_rank <= 3)
, products AS (
  SELECT b.county, b.store_number, b.store_name, b.item_description,
         {money('b.sale_dollars')} AS product_sales, AVG(b.profit_margin) AS avg_margin
  FROM b2 b JOIN s3 ON b.county = s3.county AND b.store_number = s3.store_number AND b.store_name = s3.store_name
  GROUP BY 1, 2, 3, 4)
, p2 AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY county, store_number, store_name
                                      ORDER BY product_sales DESC, item_description) AS INTEGER) AS product_rank FROM products)
, p3 AS (SELECT *, MAX(product_sales) OVER (PARTITION BY county, store_number, store_name) AS max_product_sales
         FROM p2 WHERE product_rank <= 2)
SELECT p3.county, p3.store_number, p3.store_name, s3.store_rank, p3.item_description, p3.product_rank,
       c2.county_sales, ROUND(c2.county_growth, 6) AS county_growth,
       ROUND(1.0 + c2.county_sales / c2.max_county_sales * 1.5, 6) AS county_width,
       s3.store_sales, ROUND(s3.store_growth, 6) AS store_growth,
       ROUND(0.5 + s3.store_sales / s3.max_store_sales * 1.0, 6) AS store_width,
       p3.product_sales, ROUND(p3.avg_margin, 6) AS avg_margin,
       ROUND(0.3 + p3.product_sales / p3.max_product_sales * 0.7, 6) AS product_width,
       ROUND(LEAST(GREATEST(p3.avg_margin / 0.5, 0.0), 1.0), 6) AS margin_norm,
       CASE WHEN p3.avg_margin > 0.2 THEN 'black' ELSE 'white' END AS font_color
FROM p3 JOIN s3 ON p3.county = s3.county AND p3.store_number = s3.store_number AND p3.store_name = s3.store_name
JOIN c2 ON p3.county = c2.county""")

register("w4_monthly_growth", with_(SALES) + f"""
, m AS (SELECT county, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
               {money('sale_dollars')} AS sales FROM sales GROUP BY 1, 2, 3)
, l AS (SELECT *, LAG(sales) OVER (PARTITION BY county ORDER BY year, month) AS prev_sales FROM m)
SELECT county, year, month, sales, prev_sales,
       ROUND(CASE WHEN prev_sales = 0 THEN NULL ELSE (sales - prev_sales) / prev_sales END, 6) AS growth
FROM l""")

register("a19_first_store_name", with_(SALES) + """
, r AS (SELECT store_number, store_name,
               ROW_NUMBER() OVER (PARTITION BY store_number ORDER BY date, invoice_and_item_number) AS rn FROM sales)
SELECT store_number, store_name FROM r WHERE rn = 1""")

register("a20_date_range", with_(SALES) + """
SELECT CAST(MIN(date) AS VARCHAR) AS min_date, CAST(MAX(date) AS VARCHAR) AS max_date FROM sales""")

register("h3_geo_hierarchy", with_(SALES) + f"""
, counties AS (SELECT county, {money('sale_dollars')} AS county_sales FROM sales GROUP BY county
               ORDER BY county_sales DESC, county ASC NULLS LAST LIMIT 5)
, cs AS (SELECT DISTINCT county, store_number FROM sales WHERE county IN (SELECT county FROM counties))
, cs2 AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY county ORDER BY store_number) AS INTEGER) AS store_rank FROM cs)
, stores AS (SELECT * FROM cs2 WHERE store_rank <= 3)
, names AS (SELECT store_number, store_name FROM (
      SELECT store_number, store_name,
             ROW_NUMBER() OVER (PARTITION BY store_number ORDER BY date, invoice_and_item_number) AS rn
      FROM sales WHERE store_number IN (SELECT store_number FROM stores)) WHERE rn = 1)
, prod AS (SELECT store_number, item_description, {money('sale_dollars')} AS product_sales
           FROM sales WHERE store_number IN (SELECT store_number FROM stores) GROUP BY 1, 2)
, top AS (SELECT store_number, item_description, product_sales FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY store_number ORDER BY product_sales DESC, item_description) AS rn
      FROM prod) WHERE rn = 1)
SELECT s.county, c.county_sales, s.store_rank, s.store_number, n.store_name,
       t.item_description AS top_product, t.product_sales
FROM stores s JOIN counties c ON s.county = c.county
LEFT JOIN names n ON s.store_number = n.store_number
LEFT JOIN top t ON s.store_number = t.store_number""")


# ------------------------------------------------------------------ funnel (F*, H1-H10, R2, A*)
from flowlens.plans.funnel import CALL_LOOKUPS, CANONICAL_REASONS, DECISION_NODES, DROP_STAGE_OF_COLUMN, FLOW_CLUSTERS, REASON_PREFIXES  # noqa: E402
from flowlens.sources.adapters import STAGES  # noqa: E402

STAGE_DIM = "stages AS (SELECT * FROM (VALUES " + ", ".join(f"({q(s)}, {i + 1})" for i, s in enumerate(STAGES)) + ") t(stage, stage_order))"
F1 = """per AS (SELECT lead_stage AS stage, COUNT(DISTINCT lead_id) AS leads FROM interactions
            WHERE lead_stage IS NOT NULL GROUP BY 1),
f1 AS (SELECT s.stage, s.stage_order, COALESCE(p.leads, 0) AS leads,
              LAG(COALESCE(p.leads, 0)) OVER (ORDER BY s.stage_order) - COALESCE(p.leads, 0) AS dropped
       FROM stages s LEFT JOIN per p ON s.stage = p.stage)"""


def _canon(col: str) -> str:
    out = col
    for a, b in CANONICAL_REASONS.items():
        out = f"CASE WHEN {out} = {q(a)} THEN {q(b)} ELSE {out} END"
    return out


def _melted(src: str, canon_cols: tuple[str, ...] = ()) -> str:
    parts = []
    for c in REASON_COLUMNS:
        v = _canon(c) if c in canon_cols else c
        parts.append(f"SELECT lead_id, {q(c)} AS reason_type, {v} AS reason FROM {src} WHERE {c} IS NOT NULL")
    return "melted AS (" + " UNION ALL ".join(parts) + ")"


def _category(col: str) -> str:
    out = col
    for p in REASON_PREFIXES:
        out = f"replace({out}, {q(p)}, '')"
    out = f"replace({out}, '_', ' ')"
    return f"upper(substr({out}, 1, 1)) || lower(substr({out}, 2))"


COL_STAGE = "colstage AS (SELECT * FROM (VALUES " + ", ".join(f"({q(c)}, {q(s)})" for c, s in DROP_STAGE_OF_COLUMN.items()) + ") t(reason_type, stage))"
F10 = f"""counts AS (SELECT reason_type, reason, COUNT(*) AS count FROM melted GROUP BY 1, 2),
drops AS (SELECT c.reason_type, c.stage, f1.dropped FROM colstage c JOIN f1 ON c.stage = f1.stage WHERE f1.dropped IS NOT NULL),
pcts AS (SELECT k.reason_type, d.stage, k.reason, k.count,
                ROUND(CASE WHEN d.dropped > 0 THEN k.count / d.dropped * 100 ELSE 0.0 END, 6) AS pct,
                CAST(ROW_NUMBER() OVER (PARTITION BY k.reason_type ORDER BY k.count DESC, k.reason) AS INTEGER) AS rank
         FROM counts k LEFT JOIN drops d ON k.reason_type = d.reason_type)"""

register("f1_distinct_funnel", with_(INTERACTIONS, STAGE_DIM, F1) + "SELECT stage, stage_order, leads, CAST(dropped AS DOUBLE) AS dropped FROM f1")

register("f2_row_funnel", with_(INTERACTIONS, LEADS, DEMO) + """
, x AS (SELECT (SELECT COUNT(*) FROM leads) AS total_leads,
               (SELECT COUNT(DISTINCT lead_gen_source) FROM leads) AS n_sources,
               (SELECT COUNT(*) FROM demo) AS demo_watched,
               (SELECT COUNT(*) FROM interactions WHERE lead_stage = 'awareness') AS a,
               (SELECT COUNT(*) FROM interactions WHERE lead_stage = 'consideration') AS c,
               (SELECT COUNT(*) FROM interactions WHERE lead_stage = 'conversion') AS v)
SELECT total_leads, n_sources, demo_watched, a AS lead_to_awareness, c AS awareness_to_consideration,
       v AS consideration_to_conversion, total_leads - a AS dropout_after_lead, a - c AS dropout_after_awareness,
       c - v AS dropout_after_consideration,
       ROUND(a / NULLIF(total_leads, 0), 6) AS rate_awareness, ROUND(c / NULLIF(a, 0), 6) AS rate_consideration,
       ROUND(v / NULLIF(c, 0), 6) AS rate_conversion, ROUND(v / NULLIF(total_leads, 0), 6) AS overall_rate
FROM x""")

register("f3_call_success", with_(INTERACTIONS, STAGE_DIM) + """
, rate AS (SELECT lead_stage AS stage,
                  AVG(CASE WHEN call_status = 'successful' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100 AS success_rate
           FROM interactions GROUP BY 1)
SELECT s.stage, s.stage_order, COALESCE(ROUND(r.success_rate, 6), 0.0::DOUBLE) AS success_rate
FROM stages s LEFT JOIN rate r ON s.stage = r.stage""")

F4 = """f4 AS (SELECT stage, next_stage,
              ROUND(CASE WHEN leads > 0 AND next_leads > 0 THEN next_leads / leads * 100 ELSE 0.0::DOUBLE END, 6) AS conversion_pct
       FROM (SELECT stage, leads, LEAD(stage) OVER (ORDER BY stage_order) AS next_stage,
                    LEAD(leads) OVER (ORDER BY stage_order) AS next_leads FROM f1) WHERE next_stage IS NOT NULL)"""
register("f4_stage_conversion", with_(INTERACTIONS, STAGE_DIM, F1, F4) + "SELECT * FROM f4")

register("f5_overall_dropoff", with_(INTERACTIONS) + """
SELECT COUNT(DISTINCT lead_id) AS total_leads,
       COUNT(DISTINCT CASE WHEN lead_stage = 'conversion' THEN lead_id END) AS converted_leads,
       COUNT(DISTINCT lead_id) - COUNT(DISTINCT CASE WHEN lead_stage = 'conversion' THEN lead_id END) AS drop_offs
FROM interactions""")

register("f6_demo_insight", with_(INTERACTIONS, DEMO) + """
, d AS (SELECT COUNT(DISTINCT lead_id) AS demo_watched_count, ROUND(AVG(watched_percentage), 6) AS avg_watch_percentage,
               (SELECT language FROM demo WHERE language IS NOT NULL GROUP BY language
                ORDER BY COUNT(*) DESC, language LIMIT 1) AS top_demo_language FROM demo)
, a AS (SELECT COUNT(DISTINCT CASE WHEN lead_stage = 'awareness' THEN lead_id END) AS awareness_leads FROM interactions)
SELECT d.demo_watched_count,
       ROUND(CASE WHEN a.awareness_leads > 0 THEN d.demo_watched_count / a.awareness_leads * 100 ELSE 0.0::DOUBLE END, 6) AS demo_attendance_rate,
       d.avg_watch_percentage, d.top_demo_language
FROM d, a""")

register("f7_demo_influence", with_(INTERACTIONS, DEMO) + """
, w AS (SELECT COUNT(DISTINCT lead_id) AS demo_watched_counts FROM demo)
, c AS (SELECT COUNT(DISTINCT CASE WHEN lead_stage = 'consideration' THEN lead_id END) AS n FROM interactions)
SELECT w.demo_watched_counts,
       ROUND(CASE WHEN w.demo_watched_counts > 0 THEN c.n / w.demo_watched_counts * 100 ELSE 0.0::DOUBLE END, 6) AS demo_conversion_rate
FROM w, c""")

register("f8_source_breakdown", with_(LEADS) + """
SELECT lead_gen_source, COUNT(*) AS count,
       ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, lead_gen_source) = 1 AS is_top
FROM leads WHERE lead_gen_source IS NOT NULL GROUP BY 1""")

register("f9_reasons_by_category", with_(NO_INTEREST, _melted("no_interest", (REASON_COLUMNS[0],))) + f"""
SELECT reason_type, reason, COUNT(*) AS count, {_category('reason_type')} AS category
FROM melted GROUP BY 1, 2""")

register("f10_reasons_pct_of_drop", with_(INTERACTIONS, NO_INTEREST, STAGE_DIM, F1, COL_STAGE, _melted("no_interest"), F10) + """
SELECT reason_type, stage, reason, count, pct, rank FROM pcts WHERE rank <= 3""")

register("h10_reason_nodes", with_(INTERACTIONS, NO_INTEREST, STAGE_DIM, F1, COL_STAGE, _melted("no_interest"), F10) + """
SELECT concat_ws('_', stage, 'reason', CAST(rank AS VARCHAR)) AS node_id, reason_type, reason, count, pct FROM pcts""")

register("f11_reasons_all_stages", with_(NO_INTEREST, _melted("no_interest")) + """
SELECT reason, COUNT(*) AS count FROM melted GROUP BY 1""")

register("p5_reasons_canonical", with_(NO_INTEREST, _melted("no_interest", tuple(REASON_COLUMNS))) + """
SELECT reason, COUNT(*) AS count FROM melted GROUP BY 1""")

register("f12_top_reason", with_(NO_INTEREST, _melted("no_interest")) + f"""
, req AS (SELECT * FROM (VALUES {", ".join(f"({q(c)})" for c in REASON_COLUMNS)}) t(reason_type))
, counts AS (SELECT reason_type, reason, COUNT(*) AS count FROM melted GROUP BY 1, 2)
, top AS (SELECT reason_type, reason FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY reason_type ORDER BY count DESC, reason) AS rn
                                           FROM counts) WHERE rn = 1)
SELECT r.reason_type, COALESCE(t.reason, 'N/A') AS top_reason FROM req r LEFT JOIN top t ON r.reason_type = t.reason_type""")

_ALL_CALL_REASONS = sorted({r for pair in CALL_REASONS.values() for r in pair})
register("r2_stage_reason_crosstab", with_(INTERACTIONS) + "SELECT lead_stage AS stage, " + ", ".join(
    f"COUNT(*) FILTER (WHERE call_reason = {q(r)}) AS {r}" for r in _ALL_CALL_REASONS) + " FROM interactions WHERE lead_stage IS NOT NULL GROUP BY 1")

register("f13_call_patterns", with_(INTERACTIONS) + "SELECT " + ", ".join(
    f"COUNT(*) FILTER (WHERE lead_stage = {q(s)} AND call_reason = {q(r)}) AS {n}" for n, s, r in CALL_LOOKUPS) + " FROM interactions")

register("f14_stage_summary", with_(INTERACTIONS, STAGE_DIM, F1, F4) + """
, succ AS (SELECT lead_stage AS stage,
                  ROUND(AVG(CASE WHEN call_status = 'successful' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100, 6) AS success_rate
           FROM interactions GROUP BY 1)
, gap AS (SELECT lead_stage AS stage,
                 CAST(CASE WHEN COUNT(call_done_date) >= 2
                           THEN floor(datediff('day', MIN(call_done_date), MAX(call_done_date)) / (COUNT(call_done_date) - 1))
                           ELSE 0 END AS BIGINT) AS avg_days
          FROM interactions GROUP BY 1)
SELECT f1.stage, f1.stage_order, f1.leads, COALESCE(f4.conversion_pct, 0.0::DOUBLE) AS conversion_pct,
       COALESCE(s.success_rate, 0.0::DOUBLE) AS success_rate, COALESCE(g.avg_days, 0) AS avg_days
FROM f1 LEFT JOIN f4 ON f1.stage = f4.stage LEFT JOIN succ s ON f1.stage = s.stage LEFT JOIN gap g ON f1.stage = g.stage""")

register("f15_manager_workload", with_(MANAGERS) + """
SELECT ROUND(AVG(n), 6) AS avg_cycles FROM (SELECT jnr_sm_id, COUNT(DISTINCT cycle) AS n FROM managers
                                            WHERE jnr_sm_id IS NOT NULL GROUP BY 1)""")

_F16_VALUES = ", ".join("(" + ", ".join("NULL" if v is None else q(v) for v in n) + f", {i + 1})" for i, n in enumerate(DECISION_NODES))
F16 = f"""nodes AS (SELECT *, lower(split_part(trim(node), ' ', 1)) AS stage FROM (VALUES {_F16_VALUES}) t(node, yes, drop_text, no_text, stage_order)),
watched AS (SELECT COUNT(DISTINCT lead_id) AS n FROM demo)"""
register("f16_decision_funnel_edges", with_(INTERACTIONS, NO_INTEREST, DEMO, STAGE_DIM, F1, _melted("no_interest"), F16) + f"""
, sn AS (SELECT n.*, f1.leads FROM nodes n LEFT JOIN f1 ON n.stage = f1.stage)
SELECT src, dst, kind, label, CAST(leads AS DOUBLE) AS leads FROM (
SELECT * FROM (SELECT node AS src, LEAD(node) OVER (ORDER BY stage_order) AS dst, 'yes' AS kind, yes AS label, leads FROM sn) WHERE dst IS NOT NULL
UNION ALL SELECT node, 'Drop ' || CAST(stage_order AS VARCHAR), CASE no_text WHEN 'No' THEN 'no' ELSE 'failed' END, no_text, CAST(NULL AS BIGINT) FROM sn
UNION ALL SELECT 'Drop 1', 'Drop-off: ' || reason, 'reason', '', COUNT(*) FROM melted GROUP BY reason
UNION ALL SELECT {q(DECISION_NODES[1][0])}, 'Demo Influence', 'demo', '', n FROM watched)""")

register("f16_decision_funnel_nodes", with_(INTERACTIONS, NO_INTEREST, DEMO, STAGE_DIM, F1, F4, _melted("no_interest"), F16) + """
, succ AS (SELECT lead_stage AS stage,
                  ROUND(AVG(CASE WHEN call_status = 'successful' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100, 6) AS success_rate
           FROM interactions GROUP BY 1)
, infl AS (SELECT n, ROUND(CASE WHEN n > 0 THEN (SELECT COUNT(DISTINCT lead_id) FROM interactions WHERE lead_stage = 'consideration') / n * 100
                           ELSE 0.0::DOUBLE END, 6) AS rate FROM watched)
SELECT n.node, 'stage' AS kind, n.node || chr(10) || printf('(%d leads)', f1.leads) || chr(10)
       || printf('Conv. Rate: %.1f%%', ROUND(COALESCE(f4.conversion_pct, 0.0::DOUBLE), 1)) || chr(10)
       || printf('Call Success: %.1f%%', ROUND(COALESCE(s.success_rate, 0.0::DOUBLE), 1)) AS label
FROM nodes n LEFT JOIN f1 ON n.stage = f1.stage LEFT JOIN f4 ON n.stage = f4.stage LEFT JOIN succ s ON n.stage = s.stage
UNION ALL SELECT 'Drop ' || CAST(stage_order AS VARCHAR), 'drop', drop_text FROM nodes
UNION ALL SELECT 'Drop-off: ' || reason, 'reason', reason || chr(10) || printf('(%d leads)', COUNT(*)) FROM melted GROUP BY reason
UNION ALL SELECT 'Demo Influence', 'demo', printf('Demo Watched: %d leads', n) || chr(10) || printf('Conversion Rate: %.1f%%', ROUND(rate, 1)) FROM infl""")

register("h10_reason_edges", with_(INTERACTIONS, NO_INTEREST, STAGE_DIM, F1, COL_STAGE, _melted("no_interest"), F10) + f"""
SELECT 'Interest' || CASE reason_type {" ".join(f"WHEN {q(c)} THEN '{i + 1}'" for i, c in enumerate(REASON_COLUMNS))} END AS src,
       concat_ws('_', stage, 'reason', CAST(rank AS VARCHAR)) AS dst, printf('%d leads (%.1f%%)', count, ROUND(pct, 1)) AS label FROM pcts""")

register("f17_success_failure_leads", with_(INTERACTIONS) + """
SELECT lead_stage AS stage, call_status, COUNT(DISTINCT lead_id) AS leads FROM interactions WHERE lead_stage IS NOT NULL GROUP BY 1, 2""")

register("f18_language_distribution", with_(DEMO) + """
SELECT language, COUNT(*) AS count FROM demo WHERE language IS NOT NULL GROUP BY 1""")

register("a24_reason_text", with_(INTERACTIONS, NO_INTEREST, STAGE_DIM, F1, COL_STAGE, _melted("no_interest"), F10) + """
SELECT reason_type, string_agg(printf('- %s (%d leads, %.1f%%)', reason, count, ROUND(pct, 1)), chr(10) ORDER BY rank) AS text
FROM pcts WHERE rank <= 3 GROUP BY reason_type""")

register("f19_reason_names", with_(NO_INTEREST, _melted("no_interest")) + """
, counts AS (SELECT reason_type, reason, COUNT(*) AS count FROM melted GROUP BY 1, 2)
, r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY reason_type ORDER BY count DESC, reason) AS rank FROM counts)
SELECT reason_type,
       string_agg(CASE WHEN rank <= 3 THEN '- ' || reason END, chr(10) ORDER BY rank)
         || CASE WHEN MAX(rank) > 3 THEN chr(10) || '- ...' ELSE '' END AS text
FROM r GROUP BY reason_type""")

H9 = f"""x AS (SELECT (SELECT COUNT(*) FROM leads) AS t,
               (SELECT COUNT(DISTINCT lead_gen_source) FROM leads) AS n_sources, (SELECT COUNT(*) FROM demo) AS watched,
               (SELECT COUNT(*) FROM interactions WHERE lead_stage = 'awareness') AS a,
               (SELECT COUNT(*) FROM interactions WHERE lead_stage = 'consideration') AS c,
               (SELECT COUNT(*) FROM interactions WHERE lead_stage = 'conversion') AS v)
, cp AS (SELECT {", ".join(f"COUNT(*) FILTER (WHERE lead_stage = {q(s)} AND call_reason = {q(r)}) AS {n}" for n, s, r in CALL_LOOKUPS)} FROM interactions)"""
_H9_BASE = (INTERACTIONS, LEADS, DEMO, NO_INTEREST, _melted("no_interest", (REASON_COLUMNS[0],)), H9)
H9_EDGES = f"""SELECT src, dst, cluster, CAST(value AS DOUBLE) AS value, pct FROM (
SELECT 'Lead' AS src, 'Awareness' AS dst, 'main' AS cluster, a AS value, ROUND(a / NULLIF(t, 0), 6) AS pct FROM x
UNION ALL SELECT 'Awareness', 'Consideration', 'main', c, ROUND(c / NULLIF(a, 0), 6) FROM x
UNION ALL SELECT 'Consideration', 'Conversion', 'main', v, ROUND(v / NULLIF(c, 0), 6) FROM x
UNION ALL SELECT 'Lead', 'Dropout1', 'dropout', t - a, ROUND((t - a) / NULLIF(t, 0), 6) FROM x
UNION ALL SELECT 'Awareness', 'Dropout2', 'dropout', a - c, ROUND((a - c) / NULLIF(a, 0), 6) FROM x
UNION ALL SELECT 'Consideration', 'Dropout3', 'dropout', c - v, ROUND((c - v) / NULLIF(c, 0), 6) FROM x
UNION ALL SELECT {_category('reason_type')} || '_header', concat_ws('_', {_category('reason_type')}, reason), 'reasons', COUNT(*), CAST(NULL AS DOUBLE)
          FROM melted GROUP BY reason_type, reason
UNION ALL SELECT 'Start', 'Intro', 'calls', intro_calls, CAST(NULL AS DOUBLE) FROM cp
UNION ALL SELECT 'Intro', 'Demo', 'calls', demo_scheduled_calls, CAST(NULL AS DOUBLE) FROM cp
UNION ALL SELECT 'Demo', 'Followup', 'calls', followup_calls, CAST(NULL AS DOUBLE) FROM cp
UNION ALL SELECT 'Followup', 'ConversionCall', 'calls', converted_calls, CAST(NULL AS DOUBLE) FROM cp
UNION ALL SELECT 'Lead', 'Start', 'link', CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE)
UNION ALL SELECT 'ConversionCall', 'Conversion', 'link', CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE))"""
register("h9_flow_graph_edges", with_(*_H9_BASE) + H9_EDGES)


def _share(a: str, b: str) -> str:
    return f"CASE WHEN {b} <> 0 THEN printf('%.1f%%', ROUND(({a}) / {b} * 100, 1)) ELSE 'N/A' END"


def _dropout(i: int, n: str, base: str) -> str:
    return f"UNION ALL SELECT 'Dropout{i}', NULL, 'diamond', 'Dropout' || chr(10) || printf('%d leads', {n}) || chr(10) || '(' || {_share(n, base)} || ')' FROM x"


H9_NODES = f"""
SELECT 'Lead' AS id, 'main_stages' AS cluster, 'box' AS shape, 'Lead' || chr(10) || printf('Total: %d', t) || chr(10) || printf('Sources: %d', n_sources) AS label FROM x
UNION ALL SELECT 'Awareness', 'main_stages', 'box', 'Awareness' || chr(10) || printf('Demo Watched: %d', watched) || chr(10) || '({{'
  || (SELECT COALESCE(string_agg('''' || language || ''': ' || CAST(n AS VARCHAR), ', ' ORDER BY n DESC, language), '')
      FROM (SELECT language, COUNT(*) AS n FROM demo WHERE language IS NOT NULL GROUP BY 1)) || '}})' FROM x
UNION ALL SELECT 'Consideration', 'main_stages', 'box', 'Consideration' || chr(10) || printf('Follow-ups: %d', c) FROM x
UNION ALL SELECT 'Conversion', 'main_stages', 'box', 'Conversion' || chr(10) || printf('Successful: %d', v) || chr(10) || 'Rate: ' || {_share('v', 't')} FROM x
{_dropout(1, 't - a', 't')}
{_dropout(2, 'a - c', 'a')}
{_dropout(3, 'c - v', 'c')}
UNION ALL SELECT 'Start', 'call_flow', 'box', 'Start Call' FROM x
UNION ALL SELECT 'Intro', 'call_flow', 'box', 'Introduction' || chr(10) || printf('%d calls', intro_calls) FROM cp
UNION ALL SELECT 'Demo', 'call_flow', 'box', 'Demo Scheduled' || chr(10) || printf('%d calls', demo_scheduled_calls) FROM cp
UNION ALL SELECT 'Followup', 'call_flow', 'box', 'Follow-up' || chr(10) || printf('%d calls', followup_calls) FROM cp
UNION ALL SELECT 'ConversionCall', 'call_flow', 'box', 'Conversion Call' || chr(10) || printf('%d calls', converted_calls) FROM cp
UNION ALL SELECT DISTINCT {_category('reason_type')} || '_header', 'reasons', 'plaintext', {_category('reason_type')} FROM melted
UNION ALL SELECT concat_ws('_', {_category('reason_type')}, reason), 'reasons', 'box', reason || printf(': %d leads', COUNT(*)) FROM melted GROUP BY reason_type, reason"""
register("h9_flow_graph_nodes", with_(*_H9_BASE) + H9_NODES)

register("h1_hierarchy_edges", with_(MANAGERS) + """
SELECT DISTINCT snr_sm_id AS src, jnr_sm_id AS dst, 1 AS level FROM managers
UNION ALL SELECT jnr_sm_id, CAST(lead_id AS VARCHAR), 2 FROM managers""")

register("h2_hierarchy_nodes", with_(MANAGERS) + """
SELECT DISTINCT node, kind FROM (
  SELECT snr_sm_id AS node, 'senior' AS kind FROM managers
  UNION ALL SELECT jnr_sm_id, 'junior' FROM managers
  UNION ALL SELECT CAST(lead_id AS VARCHAR), 'lead' FROM managers)""")

register("h6_edge_stats", with_(EDGES) + """
SELECT (SELECT COUNT(*) FROM edges) AS n_edges,
       (SELECT COUNT(*) FROM (SELECT node1 AS node FROM edges UNION SELECT node2 FROM edges)) AS n_nodes""")

register("h8_interaction_network", with_(MANAGERS, INTERACTIONS) + """
SELECT m.jnr_sm_id, m.lead_id, COUNT(*) AS n_interactions
FROM managers m JOIN interactions i ON m.lead_id = i.lead_id GROUP BY 1, 2""")

register("a1_row_counts", with_(INTERACTIONS, LEADS, DEMO, MANAGERS) + """
SELECT (SELECT COUNT(*) FROM interactions) AS interaction_rows, (SELECT COUNT(*) FROM leads) AS lead_rows,
       (SELECT COUNT(*) FROM demo) AS demo_rows, (SELECT COUNT(*) FROM managers) AS manager_rows""")

register("a2_distinct_counts", with_(INTERACTIONS, LEADS, DEMO) + """
SELECT (SELECT COUNT(DISTINCT lead_id) FROM interactions) AS distinct_leads,
       (SELECT COUNT(DISTINCT lead_gen_source) FROM leads) AS distinct_sources,
       (SELECT COUNT(DISTINCT language) FROM demo) AS distinct_languages""")


# ------------------------------------------------------------------ sampling, scaling, models, evaluation
from flowlens.linear_sql import HISTORY_SQL, gd_recursive_sql, weights_sql  # noqa: E402
from flowlens.operators.linear import GDConfig  # noqa: E402
from flowlens.queries import ESTIMATOR, GD_VARIANTS, HISTORY, SENIOR, STOPPED, WEIGHTED  # noqa: E402
from flowlens.plans.fraud import EXACT_WEIGHTS, FIXED_WEIGHTS, SEED, TEST_SIZE  # noqa: E402
from flowlens.sources.adapters import FRAUD_FEATURES  # noqa: E402

FEAT = FRAUD_FEATURES
UNIT = "(('0x' || substr({h}, 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"


def hkey(seed, *cols: str) -> str:
    return "md5(concat_ws('|', " + ", ".join([q(str(seed))] + [f"CAST({c} AS VARCHAR)" for c in cols]) + "))"


TRAIN_FRACTION = f"CAST({1.0 - TEST_SIZE!r} AS DOUBLE)"
SPLIT = f"""flagged AS (
  SELECT * EXCLUDE (rn, nc, h), rn <= floor(nc * {TRAIN_FRACTION}) AS is_train FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY label ORDER BY h) AS rn, COUNT(*) OVER (PARTITION BY label) AS nc
    FROM (SELECT *, {hkey(SEED, 'row_id')} AS h FROM labelled)))"""
STATS = "stats AS (SELECT " + ", ".join(
    f"AVG({c}) AS mean_{c}, CASE WHEN STDDEV_POP({c}) = 0 THEN 1.0::DOUBLE ELSE STDDEV_POP({c}) END AS std_{c}" for c in FEAT
) + " FROM flagged WHERE is_train)"
SCALED = "scaled AS (SELECT row_id, label, is_train, " + ", ".join(
    f"(f.{c} - s.mean_{c}) / s.std_{c} AS {c}" for c in FEAT) + " FROM flagged f, stats s)"


def _logit(w, alias="t") -> str:
    z = f"{float(w[0])!r}::DOUBLE"
    for wi, c in zip(w[1:], FEAT):
        z = f"({z} + {float(wi)!r}::DOUBLE * {alias}.{c})"
    return z


PROB = f"1.0::DOUBLE / (1.0::DOUBLE + exp(-({_logit(FIXED_WEIGHTS)})))"
SCORED = f"""scored AS (SELECT t.row_id, t.label, {PROB} AS probability FROM scaled t WHERE NOT t.is_train),
scored2 AS (SELECT *, CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END AS prediction FROM scored)"""
FRAUD_BASE = (LABELLED, SPLIT, STATS, SCALED, SCORED)


def _metrics(tp="tp", fp="fp", tn="tn", fn="fn") -> str:
    prec = f"CASE WHEN {tp} + {fp} > 0 THEN {tp} / ({tp} + {fp}) ELSE 0.0::DOUBLE END"
    rec = f"CASE WHEN {tp} + {fn} > 0 THEN {tp} / ({tp} + {fn}) ELSE 0.0::DOUBLE END"
    f1 = f"CASE WHEN ({prec}) + ({rec}) > 0 THEN 2.0::DOUBLE * ({prec}) * ({rec}) / (({prec}) + ({rec})) ELSE 0.0::DOUBLE END"
    acc = f"CASE WHEN {tp} + {fp} + {tn} + {fn} > 0 THEN ({tp} + {tn}) / ({tp} + {fp} + {tn} + {fn}) ELSE 0.0::DOUBLE END"
    return f"ROUND({acc}, 6) AS accuracy, ROUND({prec}, 6) AS precision, ROUND({rec}, 6) AS recall, ROUND({f1}, 6) AS f1"


register("m1_random_split", with_(LABELLED) + f"""
SELECT row_id, label, rn <= floor(n * CAST(0.8 AS DOUBLE)) AS is_train FROM (
  SELECT row_id, label, ROW_NUMBER() OVER (ORDER BY h) AS rn, COUNT(*) OVER () AS n
  FROM (SELECT row_id, label, {hkey(SEED, 'row_id')} AS h FROM labelled))""")

register("m2_stratified_split", with_(LABELLED, SPLIT) + "SELECT row_id, label, is_train FROM flagged")

register("m4_sample_n_per_class", with_(LABELLED) + f"""
SELECT row_id, label FROM (
  SELECT row_id, label, ROW_NUMBER() OVER (PARTITION BY label ORDER BY {hkey(SEED, 'row_id')}) AS rn FROM labelled)
WHERE rn <= 100""")

register("h7_edge_sample", with_(EDGES) + f"""
SELECT node1, node2 FROM (SELECT node1, node2, ROW_NUMBER() OVER (ORDER BY {hkey(SEED, 'node1', 'node2')}) AS rn FROM edges)
WHERE rn <= 30""")

register("m5_fraction_sample", with_(LABELLED) + f"""
SELECT row_id, label FROM labelled WHERE {UNIT.format(h=hkey(SEED, 'row_id'))} < 0.1::DOUBLE""")

register("m6_undersample_to_minority", with_(EMBEDDED) + f"""
, c AS (SELECT label, COUNT(*) AS n FROM embedded GROUP BY label)
, mm AS (SELECT MIN(n) AS mn, MAX(n) AS mx, (SELECT label FROM c ORDER BY n, label LIMIT 1) AS minority FROM c)
SELECT e.vec_id, e.label FROM embedded e, mm
WHERE e.label = mm.minority OR {UNIT.format(h=hkey(SEED, 'e.vec_id'))} < mm.mn / mm.mx""")


def _under(ratio: float) -> str:
    return with_(EMBEDDED) + f"""
, nmin AS (SELECT floor(COUNT(*) / CAST({ratio!r} AS DOUBLE)) AS n FROM embedded WHERE label = 1)
, maj AS (SELECT vec_id, label, ROW_NUMBER() OVER (ORDER BY {hkey(SEED, 'vec_id')}) AS rn FROM embedded WHERE label = 0)
SELECT vec_id, label FROM embedded WHERE label = 1
UNION ALL SELECT vec_id, label FROM maj, nmin WHERE rn <= nmin.n"""


register("m7_undersample_ratio", _under(0.5))
register("m8_undersample_one_to_one", _under(1.0))

register("m15_balanced_weights", with_(LABELLED) + """
, c AS (SELECT label, COUNT(*) AS nc FROM labelled GROUP BY label)
, t AS (SELECT SUM(nc) AS n FROM c)
SELECT c.label, ROUND(t.n / (2.0::DOUBLE * c.nc), 6) AS weight, c.nc AS count FROM c, t""")

register("m16_class_counts", with_(EMBEDDED) + """
SELECT label, COUNT(*) AS count, ROUND(COUNT(*) / SUM(COUNT(*)) OVER (), 6) AS share FROM embedded GROUP BY label""")

register("m17_curated_subset", with_(LABELLED) + f"""
, head AS (SELECT row_id, label FROM (
    SELECT row_id, label, ROW_NUMBER() OVER (PARTITION BY label ORDER BY {hkey('head', 'row_id')}) AS rn FROM labelled)
  WHERE rn <= (SELECT COUNT(*) FROM labelled) * CASE label WHEN 0 THEN 49 ELSE 1 END // 100)
SELECT row_id, label FROM (
  SELECT row_id, label, ROW_NUMBER() OVER (PARTITION BY label ORDER BY {hkey(SEED, 'row_id')}) AS rn FROM head)
WHERE (label = 0 AND rn <= 490) OR (label = 1 AND rn <= 10)""")

register("a21_moments", with_(LABELLED) + "SELECT " + ", ".join(
    f"ROUND(AVG({c}), 6) AS mean_{c}, ROUND(STDDEV_POP({c}), 6) AS std_{c}" for c in FEAT) + " FROM labelled")


def _std_all(cols, extra="") -> str:
    st = "st AS (SELECT " + ", ".join(
        f"AVG({c}) AS mean_{c}, CASE WHEN STDDEV_POP({c}) = 0 THEN 1.0::DOUBLE ELSE STDDEV_POP({c}) END AS std_{c}" for c in cols
    ) + " FROM labelled)"
    return with_(LABELLED, st) + "SELECT row_id" + extra + ", " + ", ".join(
        f"ROUND((l.{c} - st.mean_{c}) / st.std_{c}, 6) AS {c}" for c in cols) + " FROM labelled l, st"


register("m10_standardize_one", _std_all(["l_extendedprice"]))
register("m12_standardize_all", _std_all(FEAT))
register("m13_amount_then_intercept", _std_all(["l_extendedprice"], ", 1.0::DOUBLE AS intercept, label"))

register("m11_scale_test_with_train", with_(LABELLED, SPLIT, STATS, SCALED) + "SELECT row_id, " + ", ".join(
    f"ROUND({c}, 6) AS {c}" for c in FEAT) + " FROM scaled WHERE NOT is_train")

register("t1_scores", with_(*FRAUD_BASE) + "SELECT row_id, label, ROUND(probability, 6) AS probability, prediction FROM scored2")

register("t8_log_loss", with_(*FRAUD_BASE) + """
SELECT ROUND(AVG(-label * ln(LEAST(GREATEST(probability, 1e-15::DOUBLE), 1.0::DOUBLE - 1e-15::DOUBLE))
             - (1.0::DOUBLE - label) * ln(1.0::DOUBLE - LEAST(GREATEST(probability, 1e-15::DOUBLE), 1.0::DOUBLE - 1e-15::DOUBLE))), 6) AS log_loss
FROM scored""")

register("e1_confusion", with_(*FRAUD_BASE) + """
, c AS (SELECT COUNT(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, COUNT(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
               COUNT(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, COUNT(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn
        FROM scored2)
SELECT tp, fp, tn, fn, """ + _metrics() + " FROM c")


def _thr_sql(ts) -> str:
    vals = ", ".join(f"({float(t)!r}::DOUBLE)" for t in ts)
    return f"""
, th AS (SELECT * FROM (VALUES {vals}) v(threshold))
, c AS (SELECT th.threshold,
               COUNT(*) FILTER (WHERE s.label = 1 AND s.probability >= th.threshold) AS tp,
               COUNT(*) FILTER (WHERE s.label = 0 AND s.probability >= th.threshold) AS fp,
               COUNT(*) FILTER (WHERE s.label = 0 AND s.probability < th.threshold) AS tn,
               COUNT(*) FILTER (WHERE s.label = 1 AND s.probability < th.threshold) AS fn
        FROM th, scored s GROUP BY th.threshold)
, m AS (SELECT threshold, tp, fp, tn, fn, {_metrics()} FROM c)"""


register("e3_threshold_metrics", with_(*FRAUD_BASE) + _thr_sql([0.3, 0.5, 0.7]) + " SELECT * FROM m")

_GRID = [0.1 + i * 0.01 for i in range(40)]
register("e7_grid_threshold", with_(*FRAUD_BASE) + _thr_sql(_GRID) + """
, best AS (SELECT threshold, f1 FROM m WHERE tp > 0 ORDER BY 2 * tp / (2 * tp + fp + fn) DESC, threshold ASC LIMIT 1)
SELECT COALESCE((SELECT threshold FROM best), 0.5::DOUBLE) AS best_threshold,
       COALESCE((SELECT f1 FROM best), 0.0::DOUBLE) AS best_f1""")

EXACT = "exact AS (SELECT label, CAST(" + " + ".join(
    f"{w} * CAST(ROUND({c} * 100) AS BIGINT)" for w, c in zip(EXACT_WEIGHTS, FEAT)) + " AS DOUBLE) AS probability FROM flagged WHERE NOT is_train)"
EXACT_BASE = (LABELLED, SPLIT, EXACT)
SCORE_COUNTS = """sc AS (SELECT probability AS score, COUNT(*) FILTER (WHERE label = 1) AS pos,
                           COUNT(*) FILTER (WHERE label = 0) AS neg FROM exact GROUP BY 1),
cum AS (SELECT *, COALESCE(SUM(pos) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cum_pos,
                  COALESCE(SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cum_neg FROM sc)"""

register("e4_roc_auc", with_(*EXACT_BASE, SCORE_COUNTS) + """
SELECT ROUND(SUM(pos * (cum_neg + neg / 2.0::DOUBLE)) / (SUM(pos) * SUM(neg)), 6) AS auc FROM cum""")

PR = """pr AS (
  SELECT c.score AS threshold, CAST(t.P - c.cum_pos AS BIGINT) AS tp, CAST(t.N - c.cum_neg AS BIGINT) AS fp, CAST(c.cum_pos AS BIGINT) AS fn,
         ROUND(CASE WHEN (t.P - c.cum_pos) + (t.N - c.cum_neg) > 0
                    THEN (t.P - c.cum_pos) / ((t.P - c.cum_pos) + (t.N - c.cum_neg)) ELSE 0.0::DOUBLE END, 6) AS precision,
         ROUND(CASE WHEN t.P > 0 THEN (t.P - c.cum_pos) / t.P ELSE 0.0::DOUBLE END, 6) AS recall
  FROM cum c, (SELECT SUM(pos) AS P, SUM(neg) AS N FROM sc) t
  WHERE c.score >= (SELECT MIN(score) FROM sc WHERE pos > 0))"""

register("e5_pr_curve", with_(*EXACT_BASE, SCORE_COUNTS, PR) + "SELECT * FROM pr")

register("e6_best_f1_threshold", with_(*EXACT_BASE, SCORE_COUNTS, PR) + """
SELECT threshold AS best_threshold, precision, recall,
       ROUND(2 * tp / (2 * tp + fp + fn), 6) AS f1
FROM pr ORDER BY 2 * tp / (2 * tp + fp + fn) DESC, threshold ASC LIMIT 1""")


def _prf(tp, fp, fn):
    pr = f"CASE WHEN {tp} + {fp} > 0 THEN {tp} / ({tp} + {fp}) ELSE 0.0::DOUBLE END"
    rc = f"CASE WHEN {tp} + {fn} > 0 THEN {tp} / ({tp} + {fn}) ELSE 0.0::DOUBLE END"
    f = f"CASE WHEN ({pr}) + ({rc}) > 0 THEN 2 * ({pr}) * ({rc}) / (({pr}) + ({rc})) ELSE 0.0::DOUBLE END"
    return pr, rc, f


_p1, _r1, _f1 = _prf("tp", "fp", "fn")
_p0, _r0, _f0 = _prf("tn", "fn", "fp")
register("e8_classification_report", with_(*FRAUD_BASE) + f"""
, c AS (SELECT COUNT(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, COUNT(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
               COUNT(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, COUNT(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn
        FROM scored2)
, v AS (SELECT {_p0} AS p0, {_r0} AS r0, {_f0} AS f0, {_p1} AS p1, {_r1} AS r1, {_f1} AS f1,
               tn + fp AS s0, tp + fn AS s1, tp + fp + tn + fn AS n, (tp + tn) / (tp + fp + tn + fn) AS acc FROM c)
SELECT '0' AS class, ROUND(p0, 6) AS precision, ROUND(r0, 6) AS recall, ROUND(f0, 6) AS f1, CAST(s0 AS BIGINT) AS support FROM v
UNION ALL SELECT '1', ROUND(p1, 6), ROUND(r1, 6), ROUND(f1, 6), CAST(s1 AS BIGINT) FROM v
UNION ALL SELECT 'accuracy', ROUND(acc, 6), ROUND(acc, 6), ROUND(acc, 6), CAST(n AS BIGINT) FROM v
UNION ALL SELECT 'macro avg', ROUND((p0 + p1) / 2, 6), ROUND((r0 + r1) / 2, 6), ROUND((f0 + f1) / 2, 6), CAST(n AS BIGINT) FROM v
UNION ALL SELECT 'weighted avg', ROUND((p0 * s0 + p1 * s1) / n, 6), ROUND((r0 * s0 + r1 * s1) / n, 6),
                 ROUND((f0 * s0 + f1 * s1) / n, 6), CAST(n AS BIGINT) FROM v""")

TRAIN = "train AS (SELECT * FROM scaled WHERE is_train)"
GD_BASE = (LABELLED, SPLIT, STATS, SCALED, TRAIN)


def _fitted(cfg, *more: str, base: tuple = GD_BASE, train: str = "train") -> str:
    """WITH RECURSIVE ... of a fit; ``fitted`` and ``gd`` can be read after it."""
    gd = gd_recursive_sql(FEAT, cfg.learning_rate, cfg.n_iterations, cfg.l2, cfg.l2_bias, cfg.mean_gradient, cfg.clip_z, cfg.weight_col, cfg.patience, train)
    return with_(*base).replace("WITH ", "WITH RECURSIVE ", 1) + gd


for _name, _cfg in GD_VARIANTS.items():
    register(_name, _fitted(_cfg) + weights_sql(FEAT))
TRAIN_W = """trainw AS (SELECT t.*, n.n / (2.0::DOUBLE * c.nc) AS sw FROM scaled t
  JOIN (SELECT label, COUNT(*) AS nc FROM scaled WHERE is_train GROUP BY label) c ON t.label = c.label,
  (SELECT COUNT(*) AS n FROM scaled WHERE is_train) n WHERE t.is_train)"""
register("t6_gd_weighted", _fitted(WEIGHTED, base=(LABELLED, SPLIT, STATS, SCALED, TRAIN_W), train="trainw") + weights_sql(FEAT))
register("t13_coefficients", _fitted(GD_VARIANTS["t2_gd_mean"]) + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, ROUND(w{i + 1}, 6) AS coefficient, ABS(ROUND(w{i + 1}, 6)) AS abs_value FROM fitted" for i, c in enumerate(FEAT)))
register("t4_early_stop", _fitted(STOPPED) + weights_sql(FEAT).replace(" FROM fitted", ", (SELECT MAX(k) FROM gd)::INT AS passes FROM fitted"))
register("e10_cost_history", _fitted(HISTORY) + HISTORY_SQL)
register("t7_estimator", _fitted(GDConfig(**ESTIMATOR, weight_col="sw"), base=(LABELLED, SPLIT, STATS, SCALED, TRAIN_W), train="trainw")
         + ", scored AS (SELECT t.label, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(f.b"
         + "".join(f" + f.w{i + 1} * t.{c}" for i, c in enumerate(FEAT)) + "))) AS probability FROM scaled t, fitted f WHERE NOT t.is_train)\n"
         + _thr_sql([0.45, 0.5]) + " SELECT * FROM m")


# ------------------------------------------------------------------ kNN and SMOTE (brute force in SQL)
KNN = """mino AS (SELECT vec_id, features FROM embedded WHERE label = 1),
knn AS (SELECT * FROM (
  SELECT a.vec_id, b.vec_id AS neighbor_id, list_distance(a.features, b.features) AS distance,
         CAST(ROW_NUMBER() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.features, b.features), b.vec_id) AS INTEGER) AS rank
  FROM mino a, mino b WHERE a.vec_id <> b.vec_id) WHERE rank <= 5)"""
register("j7_knn_minority", with_(EMBEDDED, KNN) + "SELECT vec_id, neighbor_id, rank, ROUND(distance, 6) AS distance FROM knn")


def _u(kind: str) -> str:
    return UNIT.format(h=f"md5(concat_ws('|', {q(str(SEED))}, {q(kind)}, CAST(i AS VARCHAR)))")


register("m9_smote", with_(EMBEDDED, KNN) + f"""
, cnt AS (SELECT (SELECT COUNT(*) FROM embedded WHERE label = 1) AS n_min, (SELECT COUNT(*) FROM embedded WHERE label = 0) AS n_maj)
, idx AS (SELECT vec_id, features, ROW_NUMBER() OVER (ORDER BY vec_id) - 1 AS pos FROM mino)
, syn AS (SELECT i, CAST(floor({_u('base')} * n_min) AS BIGINT) AS pos,
                 CAST(floor({_u('nb')} * LEAST(5, GREATEST(n_min - 1, 1))) + 1 AS INTEGER) AS rank,
                 {_u('gap')} AS gap
          FROM cnt, range(CAST(floor(1.0::DOUBLE * n_maj - n_min) AS BIGINT)) r(i))
, synfull AS (SELECT s.i AS syn_id, b.vec_id AS base_id, k.neighbor_id, s.gap,
                  list_transform(list_zip(b.features, nb.features), lambda p: p[1] + s.gap * (p[2] - p[1])) AS v
           FROM syn s JOIN idx b ON s.pos = b.pos JOIN knn k ON k.vec_id = b.vec_id AND k.rank = s.rank
           JOIN mino nb ON nb.vec_id = k.neighbor_id)
SELECT syn_id, base_id, neighbor_id, ROUND(gap, 6) AS gap,
       ROUND(sqrt(list_sum(list_transform(v, lambda x: x * x))), 6) AS norm, 1 AS label FROM synfull""")


# ------------------------------------------------------------------ sources, sinks, reshaping, labels
register("s5_format_scan", "SELECT l_returnflag, COUNT(*) AS rows FROM lineitem GROUP BY 1")

register("s6_sql_source", with_(SALES) + f"SELECT COUNT(*) AS n_rows, {money('sale_dollars')} AS total FROM sales")


def _dq(expr: str) -> str:
    return f"'\"' || replace(CAST({expr} AS VARCHAR), '\"', '\\\\\"') || '\"'"


register("s10_dot_hierarchy", with_(MANAGERS) + f"""
, nodes AS (SELECT DISTINCT node, kind FROM (
    SELECT snr_sm_id AS node, 'senior' AS kind FROM managers
    UNION ALL SELECT jnr_sm_id, 'junior' FROM managers
    UNION ALL SELECT CAST(lead_id AS VARCHAR), 'lead' FROM managers))
, edges AS (SELECT DISTINCT snr_sm_id AS src, jnr_sm_id AS dst FROM managers
            UNION ALL SELECT jnr_sm_id, CAST(lead_id AS VARCHAR) FROM managers)
SELECT 0 AS seq, '' AS key, 'digraph "SalesHierarchy" {{' AS line
UNION ALL SELECT 1, node, '  ' || {_dq('node')} || ' [label=' || {_dq("concat_ws(': ', kind, node)")} || '];' FROM nodes
UNION ALL SELECT 2, concat_ws(chr(1), src, dst), '  ' || {_dq('src')} || ' -> ' || {_dq('dst')} || ';' FROM edges
UNION ALL SELECT 3, '', '}}'""")

_FLOW_CLUSTER_ROWS = ", ".join(f"({q(c)}, {q(t)})" for c, t in FLOW_CLUSTERS)


def _dql(expr: str) -> str:
    return f"replace({_dq(expr)}, chr(10), '\\n')"


register("s10_dot_flow_chart", with_(*_H9_BASE) + f"""
, fn AS ({H9_NODES})
, fe AS ({H9_EDGES})
, cl AS (SELECT * FROM (VALUES {_FLOW_CLUSTER_ROWS}) t(cluster, label))
SELECT 0 AS seq, '' AS key, 'digraph "Customer_Acquisition_Flow" {{' AS line
UNION ALL SELECT 1, concat_ws(chr(1), COALESCE(cluster, ''), '1', id),
                 '  ' || {_dql('id')} || ' [label=' || {_dql('label')} || ', shape=' || {_dql('shape')} || '];' FROM fn
UNION ALL SELECT 1, concat_ws(chr(1), cluster, '0'), '  subgraph ' || {_dql("'cluster_' || cluster")} || ' {{ label=' || {_dql('label')} || ';' FROM cl
UNION ALL SELECT 1, concat_ws(chr(1), cluster, '2'), '  }}' FROM cl
UNION ALL SELECT 2, concat_ws(chr(1), src, dst), '  ' || {_dql('src')} || ' -> ' || {_dql('dst')} || ';' FROM fe
UNION ALL SELECT 3, '', '}}'""")

register("r3_reason_stage_crosstab", with_(NO_INTEREST, _melted("no_interest")) + "SELECT reason, " + ", ".join(
    f"COUNT(*) FILTER (WHERE reason_type = {q(c)}) AS {c}" for c in REASON_COLUMNS) + " FROM melted GROUP BY reason")

register("p12_drilldown_labels", with_(SALES) + _GROWTH + f"""
, counties AS (
  SELECT county, {money('sale_dollars')} AS county_sales FROM b2 GROUP BY county
  ORDER BY county_sales DESC, county ASC NULLS LAST LIMIT 10)
, stores AS (
  SELECT county, store_number, store_name, {money('sale_dollars')} AS store_sales
  FROM b2 WHERE county IN (SELECT county FROM counties) GROUP BY 1, 2, 3)
, s3 AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY county ORDER BY store_sales DESC, store_number, store_name) AS r
                        FROM stores) WHERE r <= 3)
, products AS (
  SELECT b.county, b.store_number, b.store_name, b.item_description, {money('b.sale_dollars')} AS product_sales
  FROM b2 b JOIN s3 ON b.county = s3.county AND b.store_number = s3.store_number AND b.store_name = s3.store_name
  GROUP BY 1, 2, 3, 4)
, p3 AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY county, store_number, store_name
                                                     ORDER BY product_sales DESC, item_description) AS r FROM products) WHERE r <= 2)
SELECT county, store_number, item_description, left(item_description, 15) || '...' AS product_label,
       '$' || format('{{:,.0f}}', product_sales) AS sales_label FROM p3""")

_FIELDS = """f AS (SELECT l_orderkey || '-' || l_linenumber AS line_id, l_linenumber AS n, CAST(l_quantity AS DECIMAL(12,2)) AS quantity,
              CAST(l_extendedprice AS DECIMAL(12,2)) AS price, CAST(l_discount AS DECIMAL(12,2)) AS discount,
              CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS flag FROM lineitem)"""
register("s4_record_parse", with_(_FIELDS) + """
SELECT CAST(CASE WHEN n = 5 THEN 0 ELSE flag END AS INT) AS label, COUNT(*) AS n_rows,
       CAST(SUM(CASE n WHEN 4 THEN 1 WHEN 5 THEN 2 ELSE 0 END) AS BIGINT) AS n_repaired,
       CAST(SUM(CASE WHEN n = 4 THEN 0 ELSE quantity * 100 END) AS BIGINT) AS cents_0, CAST(SUM(price * 100) AS BIGINT) AS cents_1,
       CAST(SUM(CASE WHEN n = 5 THEN 0 ELSE discount * 100 END) AS BIGINT) AS cents_2
FROM f WHERE n NOT IN (6, 7) GROUP BY 1""")
register("s4_record_rejects", with_(_FIELDS) + """
SELECT line_id, CASE WHEN n = 6 THEN '  ' ELSE CAST(quantity AS VARCHAR) END AS line, CASE WHEN n = 6 THEN 'blank' ELSE 'one field' END AS reason
FROM f WHERE n IN (6, 7)""")
register("p3_senior_hierarchy", with_(MANAGERS) + f"""
SELECT DISTINCT snr_sm_id AS src, jnr_sm_id AS dst, 1 AS level FROM managers WHERE snr_sm_id = {q(SENIOR)}
UNION ALL SELECT jnr_sm_id, CAST(lead_id AS VARCHAR), 2 FROM managers WHERE snr_sm_id = {q(SENIOR)}""")
register("p6_lenient_dates", """
SELECT CAST(year(TRY_CAST(CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' WHEN o_orderkey % 11 = 0 THEN '1996-02-30'
                               ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS DATE)) AS DOUBLE) AS year, COUNT(*) AS n_orders
FROM orders GROUP BY 1""")
register("p12_number_labels", with_(SALES) + f"""
, m AS (SELECT county, CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month, {money('sale_dollars')} AS sales FROM sales GROUP BY 1, 2, 3)
, g AS (SELECT *, LAG(sales) OVER (PARTITION BY county ORDER BY year, month) AS prev FROM m)
, r AS (SELECT *, CASE WHEN prev <> 0 THEN (sales - prev) / prev END AS growth FROM g)
SELECT county, year, month, '$' || format('{{:,}}', CAST(ROUND_EVEN(sales, 0) AS BIGINT)) AS dollars,
       '$' || printf('%.1f', ROUND(sales / 1e6, 1)) || 'M' AS millions, '$' || printf('%.1f', ROUND(sales / 1e3, 1)) || 'K' AS thousands,
       COALESCE(printf('%.1f', growth * 100) || '%', 'N/A') AS percent,
       CASE WHEN growth IS NULL OR growth = 0 THEN 'N/A' WHEN growth > 0 THEN '+' || printf('%.1f', growth * 100) || '% MoM'
            ELSE printf('%.1f', growth * 100) || '% MoM' END AS growth_label
FROM r""")
register("p16_missing_column", ORACLE["f12_top_reason"].replace(f"({q(REASON_COLUMNS[-1])})", f"({q(REASON_COLUMNS[-1])}), ('reason_not_recorded')", 1))
