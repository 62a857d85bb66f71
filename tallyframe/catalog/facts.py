"""Report facts: the pipelines' own tables over the test data in their column contracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.bins import cut
from ..operators import distribution, grouping, quality
from ..operators.customers import rfm_scores
from ..plans import casefile, noshow, retail, sales, web
from ..session import written
from .aggregates import GAINS, discount_profit
from .cleaning import AUDITED, any_table
from .frames import (
    APPOINTMENTS,
    RETAIL_LINES,
    SALES_ORDERS,
    WEB_SESSIONS,
    appointments,
    retail_lines,
    rounded,
    sales_orders,
    web_sessions,
)
from .registry import query
from .scalars import RFM


def _as_sales(t):
    """Orders in the sales contract: nation stands for the product, segment for the category."""
    return sales_orders(t, region=True).withColumns({"product": F.col("nation"), "category": F.col("segment")})


@query(f"""WITH {SALES_ORDERS}, m AS (SELECT strftime(date, '%Y-%m') AS month, sum(revenue) AS r, count(*) AS c FROM sales_orders GROUP BY 1),
  g AS (SELECT *, (r - lag(r) OVER o) / lag(r) OVER o * 100 AS g, lag(month) OVER o AS before FROM m WINDOW o AS (ORDER BY month))
  SELECT arg_max(month, r) AS peak_month, round(max(r), 2) AS peak_revenue, round(max(r) / sum(r) * 100, 6) AS peak_share_pct,
         round(arg_max(g, month), 6) AS last_growth_pct, arg_max(c, month) AS last_order_count, arg_max(before, g) AS best_growth_from,
         arg_max(month, g) AS best_growth_to, round(max(g), 6) AS best_growth_pct FROM g""")
def f1_monthly_facts(t):
    out = sales.monthly_facts(sales_orders(t))
    return rounded(rounded(out, 2, "peak_revenue"), 6, "peak_share_pct", "last_growth_pct", "best_growth_pct")


def _leaders_sql(name: str, column: str) -> str:
    return f"""SELECT '{name}' AS grouping, (SELECT k FROM g{name} ORDER BY r DESC, k LIMIT 1) AS top_by_revenue, round(max(r), 2) AS top_revenue,
      round(max(r) / sum(r) * 100, 6) AS top_share_pct, (SELECT k FROM g{name} ORDER BY a DESC, k LIMIT 1) AS top_by_aov, round(max(a), 6) AS top_aov,
      (SELECT k FROM g{name} ORDER BY c DESC, k LIMIT 1) AS top_by_count, max(c) AS top_count, round(max(r) - min(r), 2) AS revenue_range FROM g{name}"""


_GROUPS = {"region": "region", "category": "segment", "product": "nation", "sales_rep": "sales_rep", "customer_name": "customer_name"}


@query(f"WITH {SALES_ORDERS}, " + ", ".join(
    f"g{n} AS (SELECT {c} AS k, sum(revenue) AS r, avg(revenue) AS a, count(order_id) AS c FROM sales_orders WHERE {c} IS NOT NULL GROUP BY 1)"
    for n, c in _GROUPS.items()) + " " + " UNION ALL ".join(_leaders_sql(n, c) for n, c in _GROUPS.items()))
def f2_leader_facts(t):
    return rounded(rounded(sales.leader_facts(_as_sales(t)), 2, "top_revenue", "revenue_range"), 6, "top_share_pct", "top_aov")


@query(f"""WITH {SALES_ORDERS}, g AS (SELECT customer_name, sum(revenue) AS r, count(*) AS c FROM sales_orders GROUP BY 1),
  k AS (SELECT *, row_number() OVER (ORDER BY r DESC, customer_name) AS i FROM g)
  SELECT round(sum(r) FILTER (WHERE i <= 1) / sum(r) * 100, 6) AS top1_pct, round(sum(r) FILTER (WHERE i <= 3) / sum(r) * 100, 6) AS top3_pct,
         count(*) FILTER (WHERE c > 1) AS repeat_customers FROM k""")
def f2_customer_facts(t):
    return rounded(sales.customer_facts(_as_sales(t)), 6, "top1_pct", "top3_pct")


@query(f"""WITH {SALES_ORDERS} SELECT count(*) FILTER (WHERE is_pending) AS pending_count, round(count(*) FILTER (WHERE is_pending) / count(*) * 100, 6) AS pending_count_pct,
  round(sum(revenue) FILTER (WHERE is_pending), 2) AS pending_revenue, round(sum(revenue) FILTER (WHERE is_pending) / sum(revenue) * 100, 6) AS pending_revenue_pct,
  (SELECT region FROM sales_orders WHERE is_pending GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top_pending_region FROM sales_orders""")
def f3_status_facts(t):
    out = sales.status_facts(_as_sales(t))
    return rounded(rounded(out, 2, "pending_revenue"), 6, "pending_count_pct", "pending_revenue_pct")


_LEAD = {b: c for b, c in zip(
    ["same-day", "1-7d", "8-30d", "31-90d", "90d+"],
    ["lead_days = 0", "lead_days BETWEEN 1 AND 7", "lead_days BETWEEN 8 AND 30", "lead_days BETWEEN 31 AND 90", "lead_days > 90"])}
_PCT = "format('{{:.2f}}', avg(noshow_flag) FILTER (WHERE {}) * 100)"
_F4 = [
    ("Total appointments (after cleaning)", "CAST(count(*) AS VARCHAR)"),
    ("Total unique patients", "CAST(count(DISTINCT patient_id) AS VARCHAR)"),
    ("Overall no-show rate (%)", "format('{:.2f}', avg(noshow_flag) * 100)"),
    *[(f"No-show rate — Gender {g} (%)", _PCT.format(f"gender = '{g}'")) for g in ("F", "M")],
    *[(f"No-show rate — Lead bucket {b} (%)", _PCT.format(c)) for b, c in _LEAD.items()],
    ("No-show rate — No SMS (%)", _PCT.format("sms_received = 0")),
    ("No-show rate — SMS received (%)", _PCT.format("sms_received = 1")),
    ("Mean lead_days", "format('{:.1f}', avg(lead_days))"),
    ("Median lead_days", "format('{:.0f}', quantile_cont(lead_days, 0.5))"),
    ("Most common neighbourhood", "(SELECT CAST(neighbourhood AS VARCHAR) FROM a GROUP BY neighbourhood ORDER BY count(*) DESC, neighbourhood LIMIT 1)"),
    *[(f"Neighbourhood with {side} no-show rate (min 50 appts)",
       f"""(SELECT neighbourhood || ' (' || format('{{:.1f}}', avg(noshow_flag) * 100) || '%)' FROM a GROUP BY neighbourhood HAVING count(*) >= 50
            ORDER BY avg(noshow_flag) {order}, neighbourhood LIMIT 1)""") for side, order in (("highest", "DESC"), ("lowest", "ASC"))],
]


@query(f"""WITH {APPOINTMENTS}, a AS (SELECT *, CASE WHEN l_linenumber > 3 THEN 'F' ELSE 'M' END AS gender FROM appointments
             WHERE NOT (age < 0 OR age > 115 OR lead_days < 0)) """ + " UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS position, '{m}' AS metric, {v} AS value FROM {'(SELECT 1)' if v.startswith('(') else 'a'}" for i, (m, v) in enumerate(_F4)))
def f4_noshow_summary(t):
    """As in the plan's run, the summary reads written rows: their join is made once."""
    df = written(appointments(t).select(
        F.col("patient_id").alias("PatientId"), F.col("age").alias("Age"), "lead_days", "noshow_flag",
        F.when(F.col("l_linenumber") > 3, "F").otherwise("M").alias("Gender"),
        F.col("sms_received").alias("SMS_received"), F.col("neighbourhood").alias("Neighbourhood")), "appointments")
    kept = noshow.clean(df).clean
    return noshow.summary(kept.withColumn("lead_bucket", cut(F.col("lead_days"), noshow.LEAD_EDGES, noshow.LEAD_LABELS)))


@query(f"""WITH {RETAIL_LINES}, {RFM}, {GAINS},
  c AS (SELECT sub_category, round_even(avg(is_loss) * 100, 2) AS pct_loss FROM retail_lines GROUP BY 1),
  m AS (SELECT bin, label, avg(gain) AS mean FROM labelled WHERE category = 'PROMO' GROUP BY 1, 2)
  SELECT (SELECT sub_category FROM c ORDER BY pct_loss DESC, sub_category LIMIT 1) AS worst_item, (SELECT max(pct_loss) FROM c) AS worst_pct_loss,
         coalesce((SELECT arg_min(label, bin) FROM m WHERE mean < 0), 'never negative') AS focus_breakeven,
         round(avg(CASE WHEN segment = 'Champions' THEN 1 ELSE 0 END) * 100, 6) AS champions_pct,
         round(avg(CASE WHEN segment = 'At Risk' THEN 1 ELSE 0 END) * 100, 6) AS at_risk_pct FROM scored""")
def f5_retail_findings(t):
    categories = grouping.profit_table(retail_lines(t), ["sub_category"], "profit", "profit_margin", "is_loss")
    breakevens = distribution.breakeven_by_group(discount_profit(t), "category", "l_discount", "gain")
    scores = rfm_scores(t.orders, "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    out = retail.findings(categories, breakevens, scores, "category", "sub_category", "PROMO")
    return rounded(out, 6, "champions_pct", "at_risk_pct")


@query(f"""WITH {RFM}, n AS (SELECT segment, count(*) AS n FROM scored GROUP BY 1) SELECT segment, n, round(n / (SELECT sum(n) FROM n) * 100, 6) AS pct FROM n""")
def f5_segment_shares(t):
    scores = rfm_scores(t.orders, "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return rounded(retail.segment_shares(scores), 6, "pct")


_FEATURES = ["page_views", "session_duration", "bounce_rate", "previous_visits"]


@query(f"""WITH {WEB_SESSIONS}, g AS (SELECT traffic_source AS k, round_even(avg(session_duration), 4) AS d, round_even(avg(bounce_rate), 4) AS b, round_even(avg(conversion_rate), 4) AS c FROM web GROUP BY 1),
  r AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS feature, corr(conversion_rate, {c}) AS r FROM web" for c in _FEATURES) + """)
  SELECT (SELECT k FROM g ORDER BY c DESC, k LIMIT 1) AS best_conversion_source, (SELECT k FROM g ORDER BY d DESC, k LIMIT 1) AS highest_engagement_source,
         (SELECT k FROM g ORDER BY b, k LIMIT 1) AS lowest_bounce_source, round(avg(conversion_rate) FILTER (WHERE previous_visits = 0), 4) AS new_conversion,
         round(avg(conversion_rate) FILTER (WHERE previous_visits > 0), 4) AS returning_conversion,
         (SELECT feature FROM r ORDER BY abs(r) DESC, feature LIMIT 1) AS top_feature, (SELECT round(arg_max(r, abs(r)), 4) FROM r) AS top_r FROM web""")
def f6_web_findings(t):
    return web.report_facts(
        web_sessions(t), "traffic_source", "session_duration", "bounce_rate", "conversion_rate", "previous_visits", _FEATURES)


@query(f"""WITH {RETAIL_LINES}, m AS (SELECT avg(profit) AS a, stddev_pop(profit) AS s FROM retail_base),
  k AS (SELECT *, coalesce(abs((profit - a) / s) > 1.8, false) AS bad FROM retail_base, m)
  SELECT count(*) FILTER (WHERE NOT bad) AS clean_rows, round(avg(CASE WHEN profit < 0 THEN 1 ELSE 0 END) FILTER (WHERE NOT bad) * 100, 6) AS loss_rate_pct,
         strftime(min(l_shipdate) FILTER (WHERE NOT bad), '%Y-%m-%d') || ' to ' || strftime(max(l_shipdate) FILTER (WHERE NOT bad), '%Y-%m-%d') AS date_range,
         count(*) FILTER (WHERE bad) AS dirty_rows FROM k""")
def f7_overview(t):
    df = retail_lines(t, parts=False)
    parts = quality.split(df, quality.first_reason([
        quality.Rule("profit_extreme_outlier", quality.beyond_population_z(df, "profit", 1.8))]))
    return rounded(retail.overview(parts.clean, parts.dirty, "l_shipdate"), 6, "loss_rate_pct")


@query(f"""WITH {AUDITED}, c AS (SELECT * FROM audited WHERE reason IS NULL), i AS (SELECT count(*) AS n FROM (SELECT unnest(string_split(reason, '; ')) FROM audited WHERE reason IS NOT NULL)),
  p AS (SELECT 's_nationkey' AS col, avg(s_nationkey) AS mean, stddev_samp(s_nationkey) AS sd, sum(s_nationkey)::DOUBLE AS s, count(*) AS n FROM c
        UNION ALL SELECT 's_acctbal', avg(s_acctbal), stddev_samp(s_acctbal), sum(s_acctbal), count(*) FROM c)
  SELECT 'suppliers' AS "case", (SELECT count(*) FROM audited) AS total_rows, (SELECT count(reason) FROM audited) AS dirty_rows,
         (SELECT round_even((1 - count(reason) / count(*)) * 100, 1) FROM audited) AS pass_rate_pct, (SELECT n FROM i) AS issues, count(*) AS columns,
         round_even(sum(s) / sum(n), 2) AS overall_mean, arg_max(col, mean) AS top_column, round_even(max(mean), 2) AS top_mean,
         round(round_even(max(mean), 2) - round_even(min(mean), 2), 2) AS spread,
         count(*) FILTER (WHERE round_even(round_even(sd, 2) / round_even(mean, 2) * 100, 1) > 40) AS alerts FROM p""")
def f8_case_file(t):
    parts = casefile.investigate(any_table(t))
    return rounded(casefile.summary(parts, ["s_nationkey", "s_acctbal"], "suppliers"), 2, "spread")


def _sales_contract(t):
    """Lines with every column of the sales contract; the places hang on the customer."""
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), "l_partkey", "l_suppkey", F.col("l_shipdate").alias("date"),
        (F.col("l_discount") * 100).alias("discount_pct"), F.col("l_extendedprice").alias("revenue"),
        F.when(F.col("l_linestatus") == "F", "Pending").otherwise("Completed").alias("status"),
    ).withColumn("is_pending", F.col("status") == "Pending")
    customers = (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", F.col("c_name").alias("customer_name"), F.col("r_name").alias("region"))
    )
    orders = t.orders.select("o_orderkey", "o_custkey").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    parts = t.part.select("p_partkey", F.col("p_brand").alias("product"), F.col("p_type").alias("category"))
    reps = t.supplier.select("s_suppkey", F.nullif("s_name", F.lit("Supplier#000000003")).alias("sales_rep"))
    return (
        lines.join(orders, F.col("order_id") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey")).join(reps, F.col("l_suppkey") == F.col("s_suppkey"))
    )


_REV = {"revenue_sum": "sum(revenue)", "aov": "avg(revenue)", "order_count": "count(order_id)"}


def _long(table: str, key: str, measures: dict[str, str], source: str = "s", where: str = "", tail: str = "", by: str | None = None) -> str:
    cols = ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in measures.items())
    names = "[" + ", ".join(f"'{n}'" for n in measures) + "]"
    values = "[" + ", ".join(measures) + "]"
    return f"""SELECT '{table}' AS "table", k || ' :: ' || m AS metric_name, v AS metric_number, NULL::VARCHAR AS text FROM (
      SELECT k, unnest({names}) AS m, unnest({values}) AS v FROM (SELECT coalesce({key}, 'nan') AS k, {cols} FROM {source} {where} GROUP BY 1 {tail}))"""


_KPI_NUM = {
    "total_revenue": "round_even(sum(revenue), 2)", "order_count": "count(*)", "avg_order_value": "round_even(avg(revenue), 2)",
    "median_order_value": "round_even(quantile_cont(revenue, 0.5), 2)", "pending_count": "count(*) FILTER (WHERE status = 'Pending')",
    "pending_revenue": "round_even(sum(revenue) FILTER (WHERE status = 'Pending'), 2)",
    "repeat_customer_count": "(SELECT count(*) FROM c WHERE k > 1)", "one_time_customer_count": "(SELECT count(*) FROM c WHERE k = 1)",
}
_KPI_TEXT = {"top_region": "region", "top_product": "product", "top_sales_rep": "sales_rep", "top_customer": "customer_name"}
_F9 = """s AS (SELECT l_orderkey AS order_id, strftime(l_shipdate, '%Y-%m') AS month, c_name AS customer_name, r_name AS region, p_brand AS product, p_type AS category,
     l_discount * 100 AS discount_pct, l_extendedprice AS revenue, nullif(s_name, 'Supplier#000000003') AS sales_rep,
     CASE l_linestatus WHEN 'F' THEN 'Pending' ELSE 'Completed' END AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
  c AS (SELECT customer_name, count(*) AS k FROM s GROUP BY 1),
  months AS (SELECT month, sum(revenue) AS r, avg(revenue) AS a, count(*) AS n FROM s GROUP BY 1),
  grown AS (SELECT *, (r - lag(r) OVER o) / lag(r) OVER o * 100 AS g FROM months WINDOW o AS (ORDER BY month)),
  big AS (SELECT customer_name, sum(revenue) AS r, row_number() OVER (ORDER BY sum(revenue) DESC, customer_name) AS i FROM s GROUP BY 1),
  conc AS (SELECT n, sum(r) AS r, sum(r) / (SELECT sum(r) FROM big) * 100 AS p FROM big, (SELECT unnest([1, 3, 5, 10]) AS n) WHERE i <= n GROUP BY n),
  grid AS (SELECT a.region, b.category, coalesce(sum(revenue), 0) AS v FROM (SELECT DISTINCT region FROM s) a CROSS JOIN (SELECT DISTINCT category FROM s) b
           LEFT JOIN s ON s.region = a.region AND s.category = b.category GROUP BY 1, 2)"""


# means get more digits than sums: a mean of few cents often ends on a half at four digits
@query(f"""WITH {_F9} SELECT "table", metric_name, CASE WHEN metric_name LIKE '%:: aov' THEN round(metric_number, 8) ELSE round(metric_number, 4) END
             AS metric_number, text FROM (""" + " UNION ALL ".join(
    [f"SELECT 'kpis' AS \"table\", '{n}' AS metric_name, CAST({e} AS DOUBLE) AS metric_number, NULL::VARCHAR AS text FROM {'(SELECT 1)' if e.startswith('(') else 's'}" for n, e in _KPI_NUM.items()]
    + [f"SELECT 'kpis', '{n}', NULL::DOUBLE, (SELECT {c} FROM s WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY sum(revenue) DESC, 1 LIMIT 1)" for n, c in _KPI_TEXT.items()]
    + ["SELECT 'monthly_revenue', month || ' :: ' || m, v, NULL FROM (SELECT month, unnest(['revenue_sum', 'aov', 'order_count', 'mom_growth_pct']) AS m, unnest([r, a, CAST(n AS DOUBLE), g]) AS v FROM grown)"]
    + [_long(f"revenue_by_{c}", c, _REV) for c in ("region", "category", "product")]
    + [_long("sales_rep_performance", "sales_rep", {**_REV, "avg_discount": "avg(discount_pct)"}),
       _long("top_customers", "customer_name", {k: _REV[k] for k in ("revenue_sum", "order_count")}, tail="ORDER BY sum(revenue) DESC, 1 LIMIT 10"),
       "SELECT 'customer_concentration', m, v, NULL FROM (SELECT unnest(['top_n', 'revenue_sum', 'pct_of_total']) AS m, unnest([CAST(n AS DOUBLE), r, p]) AS v FROM conc)",
       _long("status_breakdown", "status", {k: _REV[k] for k in ("order_count", "revenue_sum")}),
       "SELECT 'region_category_heatmap', region || ' | ' || category || ' :: revenue_sum', v, NULL FROM grid",
       _long("discount_summary", "category", {"avg_discount": "avg(discount_pct)", "max_discount": "max(discount_pct)", "min_discount": "min(discount_pct)"})]) + ")")
def f9_summary_stats(t):
    """As in the plan's run, the tables read written rows: their joins are made once."""
    used = [
        "order_id", "date", "customer_name", "region", "product", "category", "discount_pct", "revenue", "sales_rep", "status", "is_pending"]
    long = sales.summary_stats(written(_sales_contract(t).select(*used), "sales"))
    return long.select(
        "table", "metric_name", F.when(
            F.col("metric_name").endswith(":: aov"), F.round("metric_number", 8)
        ).otherwise(F.round("metric_number", 4)).alias("metric_number"),
        F.when((F.col("table") == "kpis") & F.col("metric_name").startswith("top_"), F.col("metric_value")).alias("text"))
