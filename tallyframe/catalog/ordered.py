"""Windows, running sums, ranks and calendar series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import customers, grouping, ordering, timeline
from .frames import rounded
from .registry import query

_MONTHS = """months AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, round(sum(o_totalprice), 2) AS revenue FROM orders GROUP BY 1)"""


def _months(t):
    return t.orders.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("revenue"))


@query(f"""WITH {_MONTHS} SELECT month, revenue, round((revenue - lag(revenue) OVER (ORDER BY month)) / lag(revenue) OVER (ORDER BY month) * 100, 6)
             AS mom_growth_pct FROM months""")
def w1_growth(t):
    return rounded(timeline.growth(_months(t), "month", "revenue"), 6, "mom_growth_pct")


@query("""SELECT o_orderkey, o_orderdate, o_totalprice, round(sum(o_totalprice) OVER (ORDER BY o_orderdate, o_orderkey), 2) AS cumulative FROM orders""")
def w2_running_revenue(t):
    return rounded(timeline.running_revenue(t.orders, "o_orderdate", "o_orderkey", "o_totalprice"), 2, "cumulative")


@query("""WITH g AS (SELECT o_custkey, sum(o_totalprice) AS r FROM orders GROUP BY 1)
          SELECT o_custkey, round(r, 2) AS o_totalprice, row_number() OVER w AS position, round(sum(r) OVER w, 2) AS cumulative,
                 round(sum(r) OVER w / sum(r) OVER () * 100, 6) AS cumulative_pct FROM g WINDOW w AS (ORDER BY r DESC, o_custkey ROWS UNBOUNDED PRECEDING)""")
def w3_pareto(t):
    out = grouping.pareto(t.orders, "o_custkey", "o_totalprice")
    return rounded(rounded(out, 2, "o_totalprice", "cumulative"), 6, "cumulative_pct")


_PRIOR = """prior AS (SELECT event_id, user_id, ts, f, count(*) OVER w AS prior_count, coalesce(sum(f) OVER w, 0) AS prior_hits
  FROM (SELECT *, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS f FROM events)
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


def _visits(t):
    return t.events.select("event_id", "user_id", "ts", (F.col("event_type") == "error").cast("int").alias("failed"))


@query(f"""WITH {_PRIOR} SELECT event_id, user_id, prior_count, CAST(prior_hits AS BIGINT) AS prior_hits,
             round(prior_hits / nullif(prior_count, 0), 9) AS prior_rate FROM prior""")
def w4_prior_rate(t):
    out = timeline.prior_rate(_visits(t), "user_id", "ts", "event_id", "failed")
    return rounded(out.select("event_id", "user_id", "prior_count", "prior_hits", "prior_rate"), 9, "prior_rate")


@query(f"""WITH {_PRIOR}, r AS (SELECT f, prior_hits / prior_count AS p FROM prior WHERE prior_count > 0)
           SELECT CASE WHEN p <= 0 THEN '0%' WHEN p <= 0.25 THEN '1-25%' WHEN p <= 0.5 THEN '26-50%' WHEN p <= 0.75 THEN '51-75%' ELSE '76-100%' END
             AS prior_bucket, count(*) AS n, round(avg(f), 9) AS rate FROM r GROUP BY 1""")
def w5_rate_by_prior(t):
    return rounded(timeline.rate_by_prior(_visits(t), "user_id", "ts", "event_id", "failed"), 9, "rate")


def _frequency(t):
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("orders"))


@query("""SELECT o_custkey, count(*) AS orders, row_number() OVER (ORDER BY count(*), o_custkey) AS rank FROM orders GROUP BY 1""")
def w6_first_rank(t):
    return ordering.row_ranks(_frequency(t), ["orders", "o_custkey"])


@query("""WITH r AS (SELECT o_custkey, count(*) AS orders, row_number() OVER (ORDER BY count(*), o_custkey) AS r, count(*) OVER () AS n FROM orders GROUP BY 1)
          SELECT o_custkey, orders, CAST(1 + CASE WHEN r > 1 + (n - 1) / 4 THEN 1 ELSE 0 END + CASE WHEN r > 1 + (n - 1) * 2 / 4 THEN 1 ELSE 0 END
                 + CASE WHEN r > 1 + (n - 1) * 3 / 4 THEN 1 ELSE 0 END AS INTEGER) AS quartile FROM r""")
def w7_rank_quartile(t):
    return customers.rank_quartile(_frequency(t), "orders", "o_custkey", "quartile")


@query("""WITH g AS (SELECT s_suppkey, s_acctbal FROM supplier),
          q AS (SELECT quantile_cont(s_acctbal, [0.25, 0.5, 0.75]) AS e, quantile_cont(s_acctbal, [1/3, 2/3]) AS t FROM g)
          SELECT s_suppkey, CAST(CASE WHEN s_acctbal <= e[1] THEN 4 WHEN s_acctbal <= e[2] THEN 3 WHEN s_acctbal <= e[3] THEN 2 ELSE 1 END AS INTEGER) AS score,
                 CASE WHEN s_acctbal <= t[1] THEN 'Low Volume' WHEN s_acctbal <= t[2] THEN 'Medium Volume' ELSE 'High Volume' END AS tercile FROM g, q""")
def w8_quantile_labels(t):
    scored = ordering.quantile_labels(t.supplier.select("s_suppkey", "s_acctbal"), "s_acctbal", [4, 3, 2, 1], "score")
    terciles = ["Low Volume", "Medium Volume", "High Volume"]
    return ordering.quantile_labels(scored, "s_acctbal", terciles, "tercile").drop("s_acctbal")


@query("""WITH c AS (SELECT l_extendedprice, count(*) AS n FROM lineitem GROUP BY 1),
          r AS (SELECT *, sum(n) OVER (ORDER BY l_extendedprice) AS u FROM c)
          SELECT l_extendedprice, n, CAST(u - n + 1 AS BIGINT) AS first_rank, CAST(u AS BIGINT) AS last_rank, (u - n + 1 + u) / 2 AS avg_rank FROM r""")
def w9_average_ranks(t):
    return ordering.value_ranks(t.lineitem, "l_extendedprice").drop("group_size")


def _resample_sql(kind: str, label: str, step: str) -> str:
    return f"""SELECT '{kind}' AS grain, CAST(p AS DATE) AS period, coalesce(n, 0) AS order_count, coalesce(r, 0) AS revenue_sum, m AS revenue_mean
      FROM (SELECT unnest(generate_series(min(k), max(k), INTERVAL {step})) AS p FROM (SELECT {label} AS k FROM orders))
      LEFT JOIN (SELECT {label} AS k, count(*) AS n, round(sum(o_totalprice), 2) AS r, round(avg(o_totalprice), 8) AS m FROM orders GROUP BY 1) ON p = k"""


@query(" UNION ALL ".join([
    _resample_sql("day", "date_trunc('day', o_orderdate)", "1 DAY"),
    _resample_sql("week", "date_trunc('week', o_orderdate) + INTERVAL 6 DAY", "7 DAY"),
    _resample_sql("month", "date_trunc('month', o_orderdate)", "1 MONTH")]))
def w10_resample(t):
    measures = {"order_count": F.count("*"), "revenue_sum": F.round(F.sum("o_totalprice"), 2),
                "revenue_mean": F.round(F.avg("o_totalprice"), 8)}
    out = None
    for grain in ("day", "week", "month"):
        s = timeline.resample(t.orders, "o_orderdate", grain, measures, ["order_count", "revenue_sum"])
        s = s.select(F.lit(grain).alias("grain"), "*")
        out = s if out is None else out.unionByName(s)
    return out


@query("""WITH w AS (SELECT CAST(date_trunc('week', o_orderdate) + INTERVAL 6 DAY AS DATE) AS period, avg(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) * 100 AS rate
             FROM orders GROUP BY 1), m AS (SELECT avg(rate) + 1.5 * stddev_samp(rate) AS threshold FROM w)
          SELECT period, round(rate, 6) AS rate, round(threshold, 6) AS threshold FROM w, m WHERE rate > threshold""")
def w11_unusual_weeks(t):
    pending = F.avg((F.col("o_orderstatus") == "P").cast("int")) * 100
    weeks = timeline.resample(t.orders, "o_orderdate", "week", {"rate": pending})
    return rounded(timeline.unusual_periods(weeks, "rate"), 6, "rate", "threshold")


@query("""WITH g AS (SELECT c_nationkey, avg(c_acctbal) AS v FROM customer GROUP BY 1)
          SELECT c_nationkey, round(v, 6) AS v, round((v - min(v) OVER ()) / (max(v) OVER () - min(v) OVER ()), 9) AS scaled FROM g""")
def w12_min_max_scaling(t):
    groups = t.customer.groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("v"))
    return rounded(rounded(timeline.min_max_scaled(groups, "v"), 9, "scaled"), 6, "v")


@query(f"""WITH {_MONTHS}, g AS (SELECT *, (revenue - lag(revenue) OVER (ORDER BY month)) / lag(revenue) OVER (ORDER BY month) * 100 AS g,
             lag(month) OVER (ORDER BY month) AS before FROM months)
           SELECT min(month) AS first_label, arg_min(revenue, month) AS first_value, max(month) AS last_label, arg_max(revenue, month) AS last_value,
                  arg_max(before, g) AS best_growth_from, arg_max(month, g) AS best_growth_to, round(max(g), 6) AS best_growth_pct FROM g""")
def w13_series_ends(t):
    return rounded(timeline.series_ends(_months(t), "month", "revenue"), 6, "best_growth_pct")
