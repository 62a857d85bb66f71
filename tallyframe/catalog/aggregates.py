"""Grouped aggregates and distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.bins import cut
from ..operators import distribution, grouping, ordering, profile, timeline
from .frames import (
    APPOINTMENTS,
    RETAIL_LINES,
    SALES_LINES,
    SALES_ORDERS,
    WEB_SESSIONS,
    appointments,
    retail_lines,
    rounded,
    sales_lines,
    sales_orders,
    web_sessions,
)
from .registry import query


@query(f"""WITH {SALES_ORDERS} SELECT sales_rep, round(sum(revenue), 2) AS revenue_sum, round(avg(revenue), 6) AS aov,
             count(order_id) AS order_count FROM sales_orders GROUP BY 1""")
def a1_revenue_by_key(t):
    out = grouping.summarise(sales_orders(t), ["sales_rep"], grouping.revenue_measures("revenue", "order_id"))
    return rounded(rounded(out, 2, "revenue_sum"), 6, "aov").orderBy(F.desc("revenue_sum"))


@query(f"""WITH {SALES_ORDERS}, m AS (SELECT strftime(date, '%Y-%m') AS month, sum(revenue) AS r, avg(revenue) AS a, count(*) AS c
             FROM sales_orders GROUP BY 1)
           SELECT month, round(r, 2) AS revenue_sum, round(a, 6) AS aov, c AS order_count,
                  round((r - lag(r) OVER (ORDER BY month)) / lag(r) OVER (ORDER BY month) * 100, 6) AS mom_growth_pct FROM m""")
def a2_monthly_revenue(t):
    out = timeline.monthly_revenue(sales_orders(t), "date", "revenue", "order_id")
    return rounded(rounded(out, 2, "revenue_sum"), 6, "aov", "mom_growth_pct")


@query(f"""WITH {SALES_LINES} SELECT s_name AS sales_rep, round(sum(total), 2) AS revenue_sum, round(avg(total), 4) AS aov,
             count(order_id) AS order_count, round(avg(discount_pct), 6) AS avg_discount
           FROM sales_lines LEFT JOIN supplier ON l_suppkey = s_suppkey AND s_acctbal > 0 GROUP BY 1""")
def a3_rep_performance(t):
    # additive parts per supplier first, then the names: a hot supplier is one row at the join
    per = sales_lines(t).groupBy("l_suppkey").agg(
        F.sum("total").alias("s"), F.count("total").alias("k"), F.count("order_id").alias("c"),
        F.sum("discount_pct").alias("d"), F.count("discount_pct").alias("dk"))
    named = per.join(t.supplier.where("s_acctbal > 0").select("s_suppkey", F.col("s_name").alias("sales_rep")),
                     F.col("l_suppkey") == F.col("s_suppkey"), "left")
    return named.groupBy("sales_rep").agg(
        F.round(F.sum("s"), 2).alias("revenue_sum"), F.round(F.sum("s") / F.sum("k"), 4).alias("aov"),
        F.sum("c").alias("order_count"), F.round(F.sum("d") / F.sum("dk"), 6).alias("avg_discount"),
    ).orderBy(F.desc("revenue_sum"))


@query(f"""WITH {SALES_ORDERS} SELECT sales_rep, round(sum(revenue), 2) AS revenue_sum FROM sales_orders
           WHERE sales_rep IS NOT NULL GROUP BY 1""")
def a4_null_dropping_groups(t):
    measures = {"revenue_sum": F.round(F.sum("revenue"), 2)}
    return grouping.summarise(sales_orders(t), ["sales_rep"], measures, keep_null_keys=False)


@query("""SELECT p_type, round(min(l_discount), 4) AS min_discount, round(avg(l_discount), 6) AS avg_discount,
                 round(max(l_discount), 4) AS max_discount FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def a5_min_mean_max(t):
    # one row per part before the join; min, sum, count and max all add up
    per = t.lineitem.groupBy("l_partkey").agg(
        F.min("l_discount").alias("a"), F.sum("l_discount").alias("s"), F.count("l_discount").alias("k"),
        F.max("l_discount").alias("b"))
    joined = per.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy("p_type").agg(
        F.round(F.min("a"), 4).alias("min_discount"), F.round(F.sum("s") / F.sum("k"), 6).alias("avg_discount"),
        F.round(F.max("b"), 4).alias("max_discount"))


@query(f"""WITH {RETAIL_LINES} SELECT category, sub_category, count(profit) AS "count", round(avg(profit), 4) AS mean_profit,
             round(quantile_cont(profit, 0.5), 6) AS median_profit, round(avg(profit_margin), 6) AS mean_profit_margin,
             round_even(avg(is_loss) * 100, 2) AS pct_loss FROM retail_lines GROUP BY 1, 2""")
def a6_profit_table(t):
    out = grouping.profit_table(retail_lines(t), ["category", "sub_category"], "profit", "profit_margin", "is_loss")
    return rounded(rounded(out, 4, "mean_profit"), 6, "median_profit", "mean_profit_margin")


@query("""SELECT p_brand, p_type, round(sum(l_extendedprice), 2) AS revenue_sum, count(*) AS order_count
          FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def a7_two_key_sum(t):
    per = t.lineitem.groupBy("l_partkey").agg(F.sum("l_extendedprice").alias("s"), F.count("*").alias("k"))
    joined = per.join(t.part.select("p_partkey", "p_brand", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy("p_brand", "p_type").agg(
        F.round(F.sum("s"), 2).alias("revenue_sum"), F.sum("k").alias("order_count"))


@query(f"""WITH {WEB_SESSIONS} SELECT previous_visits, count(*) AS n, round(avg(is_error), 6) AS rate,
             round((SELECT avg(is_error) FROM web), 6) AS overall_rate FROM web GROUP BY 1""")
def a8_rate_against_overall(t):
    return rounded(grouping.rate_by(web_sessions(t), ["previous_visits"], F.col("is_error")), 6, "rate", "overall_rate")


_FLAGS = ["scholarship", "hypertension", "diabetes", "alcoholism", "sms_received"]


@query(f"WITH {APPOINTMENTS} " + " UNION ALL ".join(
    f"SELECT '{f}' AS flag, {f} AS value, count(*) AS n, round(avg(noshow_flag), 6) AS rate FROM appointments GROUP BY {f}"
    for f in _FLAGS))
def a9_rate_by_flags(t):
    return rounded(grouping.rate_by_flags(appointments(t), _FLAGS, "noshow_flag"), 6, "rate")


@query(f"""WITH {APPOINTMENTS}, g AS (SELECT neighbourhood, count(*) AS n, avg(noshow_flag) AS rate FROM appointments
             GROUP BY 1 HAVING count(*) >= 50)
           SELECT neighbourhood, n, round(rate, 6) AS rate, place FROM (
             (SELECT *, 'highest' AS place FROM g ORDER BY rate DESC, neighbourhood LIMIT 1)
             UNION ALL (SELECT *, 'lowest' FROM g ORDER BY rate, neighbourhood LIMIT 1))""")
def a10_best_and_worst(t):
    return rounded(grouping.best_and_worst(appointments(t), "neighbourhood", "noshow_flag", 50), 6, "rate")


@query("SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1")
def a11_distinct_count(t):
    # distinct pairs first: each pair is one row, so no group is held in one task
    return t.orders.select("o_orderpriority", "o_custkey").distinct().groupBy("o_orderpriority").agg(
        F.count("o_custkey").alias("customers"))


@query(f"""WITH {WEB_SESSIONS} SELECT traffic_source, round(avg(conversion_rate), 6) AS mean_conversion,
             round(stddev_samp(conversion_rate), 6) AS std_conversion, round(avg(session_duration), 6) AS mean_duration,
             round(stddev_samp(session_duration), 6) AS std_duration FROM web GROUP BY 1""")
def a12_mean_and_std(t):
    return web_sessions(t).groupBy("traffic_source").agg(*[
        F.round(f(c), 6).alias(f"{name}_{short}")
        for c, short in (("conversion_rate", "conversion"), ("session_duration", "duration"))
        for f, name in ((F.avg, "mean"), (F.stddev_samp, "std"))
    ])


@query("""SELECT count(*) AS n, round(quantile_cont(l_extendedprice, 0.5), 4) AS median,
                 round(quantile_cont(l_extendedprice, 0.95), 4) AS p95 FROM lineitem""")
def a13_exact_quantiles(t):
    out = ordering.exact_quantiles(t.lineitem, "l_extendedprice", {"median": 0.5, "p95": 0.95})
    return rounded(out.drop("distinct"), 4, "median", "p95")


@query(f"""WITH {SALES_ORDERS}, c AS (SELECT customer_name, count(*) AS k FROM sales_orders GROUP BY 1)
  SELECT round_even(sum(revenue), 2) AS total_revenue, count(*) AS order_count, round_even(avg(revenue), 2) AS avg_order_value,
         round_even(quantile_cont(revenue, 0.5), 2) AS median_order_value,
         (SELECT region FROM sales_orders GROUP BY 1 ORDER BY sum(revenue) DESC, 1 LIMIT 1) AS top_region,
         (SELECT segment FROM sales_orders GROUP BY 1 ORDER BY sum(revenue) DESC, 1 LIMIT 1) AS top_product,
         (SELECT sales_rep FROM sales_orders WHERE sales_rep IS NOT NULL GROUP BY 1 ORDER BY sum(revenue) DESC, 1 LIMIT 1) AS top_sales_rep,
         (SELECT customer_name FROM sales_orders GROUP BY 1 ORDER BY sum(revenue) DESC, 1 LIMIT 1) AS top_customer,
         count(*) FILTER (WHERE is_pending) AS pending_count,
         round_even(sum(revenue) FILTER (WHERE is_pending), 2) AS pending_revenue,
         (SELECT count(*) FROM c WHERE k > 1) AS repeat_customer_count,
         (SELECT count(*) FROM c WHERE k = 1) AS one_time_customer_count FROM sales_orders""")
def a14_kpis(t):
    leaders = {"top_region": "region", "top_product": "segment", "top_sales_rep": "sales_rep", "top_customer": "customer_name"}
    df = sales_orders(t, region=True)
    return grouping.kpis(df, "revenue", "order_id", "customer_name", F.col("is_pending"), leaders)


@query("""(SELECT l_suppkey, round(sum(l_extendedprice), 2) AS revenue, 'highest' AS place FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1)
          UNION ALL (SELECT l_suppkey, round(sum(l_extendedprice), 2), 'lowest' FROM lineitem GROUP BY 1 ORDER BY 2, 1 LIMIT 1)""")
def a15_leading_group(t):
    sums = t.lineitem.groupBy("l_suppkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("revenue"))
    return grouping.leader(sums, "l_suppkey", "revenue").withColumn("place", F.lit("highest")).unionByName(
        grouping.leader(sums, "l_suppkey", "revenue", lowest=True).withColumn("place", F.lit("lowest")))


@query("""SELECT rows_per_key, count(*) AS keys FROM (SELECT o_custkey, count(o_orderkey) AS rows_per_key FROM orders GROUP BY 1) GROUP BY 1""")
def a16_count_distribution(t):
    return grouping.count_distribution(t.orders, "o_custkey", "o_orderkey")


_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("""WITH m AS (SELECT round_even(avg(l_quantity), 2) AS q, round_even(avg(l_extendedprice), 2) AS e, round_even(avg(l_discount), 2) AS d,
             round_even(avg(l_tax), 2) AS x, round_even((sum(l_quantity) + sum(l_extendedprice) + sum(l_discount) + sum(l_tax)) / (4 * count(*)), 2) AS o FROM lineitem)
          SELECT CAST(4 AS BIGINT) AS columns, o AS overall_mean, 'l_extendedprice' AS top_column, e AS top_mean, round(e - least(q, d, x), 2) AS spread FROM m""")
def a17_pooled_mean(t):
    return rounded(profile.pooled_summary(t.lineitem, _NUM), 2, "spread")


@query(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(avg({c}), 4) AS mean, round(quantile_cont({c}, 0.5), 4) AS median, round(stddev_samp({c}), 4) AS std,
        CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
        coalesce(round_even(round_even(stddev_samp({c}), 2) / nullif(round_even(avg({c}), 2), 0) * 100, 1), 0) AS cv_pct,
        coalesce(round_even(round_even(stddev_samp({c}), 2) / nullif(round_even(avg({c}), 2), 0) * 100, 1), 0) > 40 AS high_variability FROM lineitem"""
    for c in _NUM))
def a18_variability(t):
    return rounded(profile.variability(t.lineitem, _NUM), 4, "mean", "median", "std")


@query(f"""WITH {SALES_ORDERS} SELECT round(max(r) - min(r), 2) AS spread FROM (SELECT region, sum(revenue) AS r FROM sales_orders GROUP BY 1)""")
def a19_spread_of_groups(t):
    sums = sales_orders(t, region=True).groupBy("region").agg(F.sum("revenue").alias("r"))
    return sums.agg(F.round(F.max("r") - F.min("r"), 2).alias("spread"))


@query(f"""WITH {SALES_ORDERS} SELECT status, round(sum(revenue), 2) AS revenue,
             round(sum(revenue) / (SELECT sum(revenue) FROM sales_orders) * 100, 6) AS share_pct FROM sales_orders GROUP BY 1""")
def a20_share_of_total(t):
    sums = sales_orders(t).groupBy("status").agg(F.sum("revenue").alias("revenue"))
    return rounded(rounded(grouping.share_of_total(sums, "revenue"), 2, "revenue"), 6, "share_pct")


def region_category_cells(t):
    """Revenue per (region, category): lines shrink to (supplier, category) before the places join."""
    parts = t.part.select("p_partkey", F.col("p_type").alias("category"))
    per_part = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.sum("l_extendedprice").alias("s"))
    per = per_part.join(parts, F.col("l_partkey") == F.col("p_partkey")).groupBy("l_suppkey", "category").agg(F.sum("s").alias("s"))
    places = (
        t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", F.col("r_name").alias("region"))
    )
    # one combination is left out on purpose, so that the grid has an empty cell
    joined = per.join(places, F.col("l_suppkey") == F.col("s_suppkey")).where(
        ~((F.col("region") == "ASIA") & (F.col("category") == "PROMO")))
    return joined.groupBy("region", "category").agg(F.sum("s").alias("revenue"))


CELLS = """cells AS (SELECT r_name AS region, p_type AS category, sum(l_extendedprice) AS revenue
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE NOT (r_name = 'ASIA' AND p_type = 'PROMO') GROUP BY 1, 2)"""
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(f"WITH {CELLS} SELECT region, " + ", ".join(
    f"round(coalesce(sum(revenue) FILTER (WHERE category = '{c}'), 0), 2) AS \"{c}\"" for c in TYPES) + " FROM cells GROUP BY 1")
def a21_pivot_zero_fill(t):
    return rounded(grouping.pivot_sum(region_category_cells(t), "region", "category", "revenue", TYPES), 2, *TYPES)


@query("SELECT user_id, " + ", ".join(
    f"round(avg(value) FILTER (WHERE event_type = '{c}'), 6) AS {c}" for c in ("click", "error", "view")) + " FROM events GROUP BY 1")
def a22_pivot_mean(t):
    kinds = ["click", "error", "view"]
    return rounded(grouping.pivot_mean(t.events, "user_id", "event_type", "value", kinds), 6, *kinds)


@query(f"""WITH {CELLS} SELECT round(max(revenue), 2) AS max_value, arg_max(category, revenue) AS max_column, arg_max(region, revenue) AS max_row,
             count(DISTINCT region) * count(DISTINCT category) - count(*) FILTER (WHERE revenue <> 0) AS zero_cells FROM cells""")
def a23_heatmap_facts(t):
    return rounded(grouping.heatmap_facts(region_category_cells(t), "region", "category", "revenue"), 2, "max_value")


@query("""SELECT c_mktsegment, count(*) FILTER (WHERE o_orderstatus = 'F') AS "F", count(*) FILTER (WHERE o_orderstatus = 'O') AS "O",
                 count(*) FILTER (WHERE o_orderstatus = 'P') AS "P" FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def a24_contingency(t):
    return grouping.contingency(_segment_status(t), "c_mktsegment", "o_orderstatus")


def _segment_status(t):
    return t.orders.select("o_custkey", "o_orderstatus").join(
        t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))


_COMPARED = ["noshow_flag", "scholarship", "hypertension", "diabetes", "sms_received"]


@query(f"WITH {APPOINTMENTS} " + " UNION ALL ".join(
    f"""SELECT '{m}' AS measure, round(avg({m}) FILTER (WHERE lead_days <= 0) * 100, 6) AS holds,
        round(avg({m}) FILTER (WHERE lead_days > 0) * 100, 6) AS rest FROM appointments""" for m in _COMPARED))
def a25_two_populations(t):
    measures = {m: F.col(m) * 100 for m in _COMPARED}
    return rounded(grouping.compare_populations(appointments(t), F.col("lead_days") <= 0, measures), 6, "holds", "rest")


LEAD_EDGES, LEAD_LABELS = [-1, 0, 7, 30, 90, 10000], ["same-day", "1-7d", "8-30d", "31-90d", "90d+"]
LEAD_CASE = """CASE WHEN lead_days <= -1 THEN NULL WHEN lead_days <= 0 THEN 'same-day' WHEN lead_days <= 7 THEN '1-7d'
  WHEN lead_days <= 30 THEN '8-30d' WHEN lead_days <= 90 THEN '31-90d' WHEN lead_days <= 10000 THEN '90d+' END"""


@query(f"""WITH {APPOINTMENTS} SELECT {LEAD_CASE} AS lead_bucket, round(avg(noshow_flag) FILTER (WHERE sms_received = 0), 6) AS no_sms,
             round(avg(noshow_flag) FILTER (WHERE sms_received = 1), 6) AS sms FROM appointments WHERE lead_days >= 0 GROUP BY 1""")
def a26_stratified_rate(t):
    df = appointments(t).where("lead_days >= 0").withColumn(
        "lead_bucket", cut(F.col("lead_days"), LEAD_EDGES, LEAD_LABELS))
    out = grouping.pivot_mean(df, "lead_bucket", "sms_received", "noshow_flag", [0, 1])
    return rounded(out.toDF("lead_bucket", "no_sms", "sms"), 6, "no_sms", "sms")


@query("""WITH g AS (SELECT o_custkey, avg(o_totalprice) AS v FROM orders GROUP BY 1),
          r AS (SELECT v, row_number() OVER (ORDER BY v) AS i FROM g)
          SELECT count(*) AS n, round((2 * sum(i * v) - (count(*) + 1) * sum(v)) / (count(*) * sum(v)), 9) AS gini FROM r""")
def a27_gini(t):
    means = t.orders.groupBy("o_custkey").agg(F.avg("o_totalprice").alias("v"))
    return rounded(grouping.gini(means, "v"), 9, "gini")


@query("""WITH s AS (SELECT min(l_extendedprice) AS a, max(l_extendedprice) AS b FROM lineitem),
          h AS (SELECT CAST(least(50, floor((l_extendedprice - a) / (b - a) * 50) + 1) AS INTEGER) AS bin, count(*) AS n FROM lineitem, s GROUP BY 1)
          SELECT bin, round(a + (b - a) / 50 * (bin - 1), 6) AS left_edge, round(a + (b - a) / 50 * bin, 6) AS right_edge, n FROM h, s""")
def a28_histogram(t):
    return rounded(distribution.histogram(t.lineitem, "l_extendedprice", 50), 6, "left_edge", "right_edge")


@query(f"""WITH {APPOINTMENTS}, g AS (SELECT age, lead_days <= 0 AS early FROM appointments),
           s AS (SELECT early, min(age) AS a, max(age) AS b, count(*) AS c FROM g GROUP BY 1),
           h AS (SELECT early, a, b, c, CAST(least(20, floor((age - a) / (b - a) * 20) + 1) AS INTEGER) AS bin, count(*) AS n
                 FROM g JOIN s USING (early) GROUP BY ALL)
           SELECT early, bin, n, round(n / (c * ((b - a) / 20)), 9) AS density FROM h""")
def a29_density_histogram(t):
    df = appointments(t).select("age", (F.col("lead_days") <= 0).alias("early"))
    return rounded(distribution.density_histogram(df, "age", "early", 20), 9, "density")


@query("""WITH s AS (SELECT min(l_discount) AS a, max(l_discount) AS b FROM lineitem)
          SELECT p_type, CAST(least(5, floor((l_discount - a) / (b - a) * 5) + 1) AS INTEGER) AS bin, count(*) AS n
          FROM s, lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def a30_histogram_by_category(t):
    df = t.lineitem.select("l_partkey", "l_discount").join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    return distribution.histogram(df, "l_discount", 5, ["p_type"]).select("p_type", "bin", "n")


@query("""SELECT greatest(1, least(21, k)) AS visits, count(*) AS keys FROM (SELECT user_id, count(*) AS k FROM events GROUP BY 1) GROUP BY 1
          UNION ALL SELECT greatest(1, least(21, k)), count(*) FROM (SELECT o_custkey, count(*) AS k FROM orders GROUP BY 1) GROUP BY 1""")
def a31_clipped_counts(t):
    return distribution.clipped_counts(t.events, "user_id", 1, 21).unionByName(
        distribution.clipped_counts(t.orders, "o_custkey", 1, 21))


@query("""WITH q AS (SELECT event_type, count(*) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1)
          SELECT event_type, any_value(n) AS n, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
                 min(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
                 max(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
                 count(*) FILTER (WHERE NOT value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
          FROM events JOIN q USING (event_type) GROUP BY 1""")
def a32_box_stats(t):
    return rounded(distribution.box_stats(t.events, "value", "event_type"), 6, "q1", "median", "q3")


@query("""WITH s AS (SELECT event_type, min(value) AS a, max(value) AS b, count(*) AS n, stddev_samp(value) * pow(count(*), -0.2) AS h FROM events GROUP BY 1),
          g AS (SELECT *, CAST(unnest(range(32)) AS INTEGER) AS point FROM s),
          x AS (SELECT *, (a - 3 * h) + (b - a + 6 * h) / 31 * point AS x FROM g)
          SELECT event_type, point, round(x, 6) AS x,
                 round(sum(exp(-0.5 * pow((x - value) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 9) AS density
          FROM events JOIN x USING (event_type) GROUP BY event_type, point, x""")
def a33_density_curve(t):
    return rounded(rounded(distribution.density_curve(t.events, "value", ["event_type"]), 6, "x"), 9, "density")


@query("""WITH g AS (SELECT o_custkey, sum(o_totalprice) AS r FROM orders GROUP BY 1),
          k AS (SELECT r, row_number() OVER (ORDER BY r DESC, o_custkey) AS i FROM g)
          SELECT CAST(n AS INTEGER) AS top_n, round(sum(r), 2) AS revenue_sum, round(sum(r) / (SELECT sum(r) FROM g) * 100, 6) AS pct_of_total
          FROM k, (SELECT unnest([1, 3, 5, 10]) AS n) WHERE i <= n GROUP BY n""")
def a34_concentration(t):
    out = grouping.concentration(t.orders, "o_custkey", "o_totalprice")
    return rounded(rounded(out, 2, "revenue_sum"), 6, "pct_of_total")


@query(f"WITH {WEB_SESSIONS} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(avg({c}), 4) AS mean, round(quantile_cont({c}, 0.5), 4) AS median, round(stddev_samp({c}), 4) AS std,
        round(min({c}), 4) AS min, round(max({c}), 4) AS max FROM web""" for c in ("session_duration", "bounce_rate", "time_on_page")))
def a35_numeric_summary(t):
    out = profile.numeric_summary(web_sessions(t), ["session_duration", "bounce_rate", "time_on_page"])
    return rounded(out, 4, "mean", "median", "std", "min", "max")


def discount_profit(t):
    """Profit that turns negative at a discount which differs by category."""
    df = retail_lines(t).select("category", "l_discount", "sales")
    allowed = F.lit(0.03) + F.length("category") / 100
    return df.withColumn("gain", F.col("sales") * (allowed - F.col("l_discount")))


GAINS = """gains AS (SELECT p_type AS category, l_discount, l_extendedprice * (0.03::DOUBLE + length(p_type) / 100 - l_discount) AS gain
             FROM lineitem JOIN part ON l_partkey = p_partkey),
  span AS (SELECT min(l_discount) AS a, max(l_discount) AS b FROM gains),
  binned AS (SELECT *, 1 + """ + " + ".join(
    f"CASE WHEN l_discount > a + (b - a) / 10 * {k} THEN 1 ELSE 0 END" for k in range(1, 10)) + """ AS bin FROM gains, span),
  bounds AS (SELECT *, CASE WHEN bin = 1 THEN a - (b - a) * 0.001 ELSE a + (b - a) / 10 * (bin - 1) END AS lo, a + (b - a) / 10 * bin AS hi FROM binned),
  labelled AS (SELECT *, '(' || CAST(round_even(lo, CAST(2 - floor(log10(abs(lo))) AS INTEGER)) AS VARCHAR)
     || ', ' || CAST(round_even(hi, CAST(2 - floor(log10(abs(hi))) AS INTEGER)) AS VARCHAR) || ']' AS label FROM bounds)"""


@query(f"""WITH {GAINS}, m AS (SELECT category, bin, label, avg(gain) AS mean FROM labelled GROUP BY 1, 2, 3),
           f AS (SELECT category, arg_min(label, bin) AS label, round(arg_min(mean, bin), 2) AS mean FROM m WHERE mean < 0 GROUP BY 1),
           c AS (SELECT DISTINCT category FROM gains)
           SELECT category, coalesce(label, 'never negative') AS breakeven_bucket, mean AS mean_at_breakeven FROM c LEFT JOIN f USING (category)""")
def a36_discount_breakeven(t):
    return distribution.breakeven_by_group(discount_profit(t), "category", "l_discount", "gain")


@query(f"""WITH {GAINS}, m AS (SELECT bin, a, b, avg(gain) AS mean FROM binned GROUP BY 1, 2, 3)
           SELECT CAST(bin AS INTEGER) AS bin, round((a + (b - a) / 10 * (bin - 1) + a + (b - a) / 10 * bin) / 2, 9) AS midpoint, round(mean, 4) AS mean
           FROM m WHERE mean < 0 ORDER BY bin LIMIT 1""")
def a36_breakeven_midpoint(t):
    out = distribution.breakeven_midpoint(discount_profit(t), "l_discount", "gain")
    return rounded(rounded(out, 9, "midpoint"), 4, "mean")


@query("""SELECT c_mktsegment, o_orderstatus, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY c_mktsegment) * 100, 6) AS row_pct
          FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""")
def a37_row_shares(t):
    return rounded(grouping.row_shares(_segment_status(t), "c_mktsegment", "o_orderstatus"), 6, "row_pct")
