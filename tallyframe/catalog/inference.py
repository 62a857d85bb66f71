"""Statistical tests and correlations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import inference, timeline
from ..plans import retail, web
from .frames import RETAIL_LINES, WEB_SESSIONS, retail_lines, rounded, web_sessions
from .registry import query


def _erfc(z: str) -> str:
    """erfc by its power series; DuckDB has no such function."""
    terms = f"list_transform(range(0, 80), lambda n: pow(-1, n) * pow({z}, 2 * n + 1) / (gamma(n + 1.0) * (2 * n + 1)))"
    return f"(1 - 2 / sqrt(pi()) * list_sum({terms}))"


def _rank_ctes(targets: list[str], group: str, source: str) -> str:
    cells = " UNION ALL ".join(
        f"SELECT '{c}' AS target, {group} AS grp, CAST({c} AS DOUBLE) AS v FROM {source}" for c in targets)
    return f"""cells AS ({cells}),
      ties AS (SELECT target, v, count(*) AS t FROM cells GROUP BY 1, 2),
      ranks AS (SELECT target, v, t, sum(t) OVER (PARTITION BY target ORDER BY v) - (t - 1) / 2 AS rk FROM ties),
      tie_sums AS (SELECT target, sum(t) AS n, sum(pow(t, 3) - t) AS ts FROM ties GROUP BY 1)"""


_KW = ["l_quantity", "l_extendedprice", "l_discount"]


@query(f"""WITH {_rank_ctes(_KW, 'l_returnflag', 'lineitem')},
           s AS (SELECT target, grp, sum(rk) AS r, count(*) AS m FROM cells JOIN ranks USING (target, v) GROUP BY 1, 2),
           h AS (SELECT target, (12.0 / (n * (n + 1.0)) * sum(r * r / m) - 3 * (n + 1)) / (1 - ts / (pow(n, 3) - n)) AS h, count(*) - 1 AS dof
                 FROM s JOIN tie_sums USING (target) GROUP BY target, n, ts)
           SELECT target, round(h, 6) AS h_stat, dof, round(exp(-h / 2), 6) AS p_value, exp(-h / 2) < 0.05 AS significant FROM h""")
def st1_kruskal(t):
    return rounded(inference.kruskal(t.lineitem, _KW, "l_returnflag"), 6, "h_stat", "p_value")


_SIZE = "CASE WHEN l_quantity < 17 THEN 'low' WHEN l_quantity < 34 THEN 'middle' ELSE 'high' END"


@query(f"""WITH {_rank_ctes(_KW, _SIZE, 'lineitem')},
           s AS (SELECT target, grp, sum(rk) AS r, count(*) AS m FROM cells JOIN ranks USING (target, v) GROUP BY 1, 2),
           h AS (SELECT target, (12.0 / (n * (n + 1.0)) * sum(r * r / m) - 3 * (n + 1)) / (1 - ts / (pow(n, 3) - n)) AS h
                 FROM s JOIN tie_sums USING (target) GROUP BY target, n, ts)
           SELECT target FROM h WHERE exp(-h / 2) < 0.05""")
def f6_significant_targets(t):
    return web.significant_targets(
        inference.kruskal(t.lineitem.withColumn("size", F.expr(_SIZE)), _KW, "size"))


_PROFIT_GROUPS = {"Category": _SIZE, "Region": "l_returnflag", "Segment": "concat('s', l_linenumber % 3)"}


@query(f"""WITH {RETAIL_LINES}, g AS (SELECT profit AS v, unnest(['Category', 'Region', 'Segment']) AS target,
             unnest([{', '.join(_PROFIT_GROUPS.values())}]) AS grp FROM retail_base),
           ties AS (SELECT target, v, count(*) AS t FROM g GROUP BY 1, 2),
           ranks AS (SELECT target, v, sum(t) OVER (PARTITION BY target ORDER BY v) - (t - 1) / 2 AS rk FROM ties),
           tie_sums AS (SELECT target, sum(t) AS n, sum(pow(t, 3) - t) AS ts FROM ties GROUP BY 1),
           s AS (SELECT target, grp, sum(rk) AS r, count(*) AS m FROM g JOIN ranks USING (target, v) GROUP BY 1, 2),
           h AS (SELECT target, (12.0 / (n * (n + 1.0)) * sum(r * r / m) - 3 * (n + 1)) / (1 - ts / (pow(n, 3) - n)) AS h
                 FROM s JOIN tie_sums USING (target) GROUP BY target, n, ts)
           SELECT coalesce(string_agg(target, ', ' ORDER BY target) FILTER (WHERE exp(-h / 2) < 0.05), '') AS differs_by,
                  coalesce(string_agg(target, ', ' ORDER BY target) FILTER (WHERE exp(-h / 2) >= 0.05), '') AS same_by FROM h""")
def f5_profit_verdict(t):
    """Three groupings of three groups each, so that the tail of the test statistic is exp(-h / 2)."""
    lines = retail_lines(t, parts=False).withColumns({c: F.expr(e) for c, e in _PROFIT_GROUPS.items()})
    results = retail.tests(lines.withColumns({"Profit": F.col("profit"), "Ship Mode": F.col("l_linestatus")}))
    return retail.profit_verdict(results)


def _chi(source: str, a: str, b: str, yates: str, dof: str, p: str) -> str:
    return f"""WITH o AS ({source}), c AS (SELECT {a} AS a, {b} AS b, count(*) AS o FROM o GROUP BY 1, 2),
      r AS (SELECT a, sum(o) AS ro FROM c GROUP BY 1), k AS (SELECT b, sum(o) AS co FROM c GROUP BY 1), n AS (SELECT sum(o) AS n FROM c),
      g AS (SELECT coalesce(o, 0) AS o, ro * co / n AS e FROM (SELECT * FROM r, k, n) LEFT JOIN c USING (a, b)),
      x AS (SELECT sum(pow(abs(o - e) - least({yates}, abs(o - e)), 2) / e) AS x FROM g)
      SELECT round(x, 6) AS statistic, CAST({dof} AS BIGINT) AS dof, round({p}, 6) AS p_value,
             CASE WHEN {p} < 0.05 THEN 'significant' ELSE 'not significant' END AS conclusion FROM x"""


@query(_chi("SELECT c_mktsegment, o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey", "c_mktsegment", "o_orderstatus",
            "0", "8", "exp(-x / 2) * (1 + x / 2 + pow(x / 2, 2) / 2 + pow(x / 2, 3) / 6)"))
def st2_chi_square(t):
    df = t.orders.select("o_custkey", "o_orderstatus").join(
        t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    return rounded(inference.chi_square(df, "c_mktsegment", "o_orderstatus"), 6, "statistic", "p_value")


@query(_chi("SELECT l_returnflag = 'R' AS returned, l_linestatus FROM lineitem", "returned", "l_linestatus", "0.5", "1", _erfc("sqrt(x / 2)")))
def st2_chi_square_2x2(t):
    df = t.lineitem.select((F.col("l_returnflag") == "R").alias("returned"), "l_linestatus")
    return rounded(inference.chi_square(df, "returned", "l_linestatus"), 6, "statistic", "p_value")


_MW = ["session_duration", "page_views", "previous_visits"]
_MW_SQL = f"""{WEB_SESSIONS}, {_rank_ctes(_MW, 'is_error', 'web')},
  s AS (SELECT target, sum(rk) FILTER (WHERE grp = 0) AS r0, count(*) FILTER (WHERE grp = 0)::DOUBLE AS n0, count(*) FILTER (WHERE grp = 1)::DOUBLE AS n1,
               avg(v) FILTER (WHERE grp = 0) AS mean_event0, avg(v) FILTER (WHERE grp = 1) AS mean_event1 FROM cells JOIN ranks USING (target, v) GROUP BY 1),
  u AS (SELECT *, r0 - n0 * (n0 + 1) / 2 AS u, n0 + n1 AS nn FROM s JOIN tie_sums USING (target)),
  z AS (SELECT *, (greatest(u, n0 * n1 - u) - n0 * n1 / 2 - 0.5) / sqrt(n0 * n1 / 12 * ((nn + 1) - ts / (nn * (nn - 1)))) AS z FROM u),
  p AS (SELECT *, {_erfc('(z / sqrt(2))')} AS p FROM z)"""


@query(f"""WITH {_MW_SQL} SELECT target, u AS statistic, round(z, 6) AS z, round(mean_event0, 6) AS mean_event0, round(mean_event1, 6) AS mean_event1,
             round(mean_event1 - mean_event0, 6) AS mean_diff, round(p, 6) AS p_value, p < 0.05 / 3 AS bonferroni_significant FROM p""")
def st3_mann_whitney(t):
    out = inference.mann_whitney(web_sessions(t), _MW, "is_error")
    return rounded(out, 6, "z", "mean_event0", "mean_event1", "mean_diff", "p_value")


@query(f"""WITH {WEB_SESSIONS}, c AS (SELECT count(*) FILTER (WHERE is_error = 0 AND value <= 10) AS n00, count(*) FILTER (WHERE is_error = 0 AND value > 10) AS n01,
             count(*) FILTER (WHERE is_error = 1 AND value <= 10) AS n10, count(*) FILTER (WHERE is_error = 1 AND value > 10) AS n11
             FROM (SELECT is_error, session_duration AS value FROM web)),
           k AS (SELECT *, n00 + n01 AS r, n00 + n10 AS m, n00 + n01 + n10 + n11 AS n, unnest(range(greatest(0, n00 - n11), least(n00 + n01, n00 + n10) + 1)) AS k FROM c),
           l AS (SELECT *, -(lgamma(k + 1.0) + lgamma(r - k + 1.0) + lgamma(m - k + 1.0) + lgamma(n - r - m + k + 1.0)) AS lp FROM k),
           w AS (SELECT *, exp(lp - max(lp) OVER ()) AS w, max(lp) FILTER (WHERE k = n00) OVER () AS seen FROM l)
           SELECT n00, n01, n10, n11, round(n00 * n11 / (n01 * n10), 9) AS odds_ratio,
                  round(sum(w) FILTER (WHERE lp <= seen + 1e-7) / sum(w), 6) AS p_value FROM w GROUP BY n00, n01, n10, n11""")
def st4_fisher_exact(t):
    df = web_sessions(t).select("is_error", (F.col("session_duration") > 10).cast("int").alias("long_visit"))
    return rounded(rounded(inference.fisher(df, "is_error", "long_visit"), 9, "odds_ratio"), 6, "p_value")


_CORR = ["sales", "l_quantity", "l_discount", "profit", "profit_margin"]


@query(f"WITH {RETAIL_LINES} " + " UNION ALL ".join(
    f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", " + ("1.0::DOUBLE" if a == b else f"round(corr({a}, {b}), 9)") + " AS r FROM "
    + ("(SELECT 1)" if a == b else "retail_lines") for a in _CORR for b in _CORR))
def st5_correlation_matrix(t):
    return rounded(inference.correlation_matrix(_with_margin(t), _CORR), 9, "r")


def _with_margin(t):
    return retail_lines(t, parts=False)


@query(f"WITH {RETAIL_LINES}, c AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", round(corr({a}, {b}), 9) AS r FROM retail_lines"
    for a in _CORR for b in _CORR if a < b) + ") SELECT * FROM c WHERE abs(r) > 0.5")
def st6_strong_pairs(t):
    return rounded(inference.strong_pairs(_with_margin(t), _CORR), 9, "r")


_FEATURES = ["page_views", "session_duration", "bounce_rate", "time_on_page"]


def _student_p(tt: str, v: str) -> str:
    """Two-sided tail by Simpson's rule on the density from 0 to |t|."""
    f = f"pow(1 + pow(x, 2) / {v}, -({v} + 1) / 2)"
    body = f"list_sum(list_transform(list_transform(range(0, 2001), lambda i: [abs({tt}) * i / 2000, CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END]), lambda q: q[2] * {f.replace('pow(x, 2)', 'pow(q[1], 2)')}))"
    return f"(1 - 2 * exp(lgamma(({v} + 1) / 2) - lgamma({v} / 2)) / sqrt({v} * pi()) * abs({tt}) / 6000 * {body})"


@query(f"WITH {WEB_SESSIONS}, r AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, corr(is_error, {c}) AS r, count(*) AS n FROM web" for c in _FEATURES) + f""" ),
    s AS (SELECT *, r * sqrt((n - 2) / (1 - r * r)) AS t, (n - 2)::DOUBLE AS v FROM r), p AS (SELECT *, {_student_p('t', 'v')} AS p FROM s)
    SELECT feature, round(r, 9) AS r, n, round(t, 6) AS t_stat, round(p, 6) AS p_value, p < 0.05 AS significant FROM p""")
def st7_pearson_tests(t):
    out = inference.pearson_with_target(web_sessions(t), "is_error", _FEATURES)
    return rounded(rounded(out, 9, "r"), 6, "t_stat", "p_value")


@query(f"WITH {RETAIL_LINES} " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(corr(profit, {c}), 9) AS r FROM retail_lines" for c in ("sales", "l_quantity", "l_discount", "l_tax")))
def st8_feature_ranking(t):
    return rounded(inference.rank_features(_with_margin(t), "profit", ["sales", "l_quantity", "l_discount", "l_tax"]), 9, "r")


@query(f"WITH {RETAIL_LINES} SELECT round(regr_slope(profit, l_discount), 4) AS slope, round(regr_intercept(profit, l_discount), 4) AS intercept, count(*) AS n FROM retail_lines")
def st9_trend_line(t):
    return rounded(inference.trend_line(_with_margin(t), "l_discount", "profit"), 4, "slope", "intercept")


@query(f"""WITH {_MW_SQL} SELECT count(*) AS tests, 0.05 / count(*) AS alpha_corrected, count(*) FILTER (WHERE p < 0.05) AS significant_before,
             count(*) FILTER (WHERE p < 0.05 / 3) AS significant_after FROM p""")
def st10_bonferroni(t):
    return inference.bonferroni(inference.mann_whitney(web_sessions(t), _MW, "is_error"))


@query("""WITH seen AS (SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS period, round(sum(o_totalprice), 2) AS v FROM orders GROUP BY 1, 2),
  calendar AS (SELECT o_orderpriority, CAST(unnest(generate_series(min(period), max(period), INTERVAL 1 MONTH)) AS DATE) AS period FROM seen GROUP BY 1),
  m AS (SELECT o_orderpriority, period, coalesce(v, 0) AS v FROM calendar LEFT JOIN seen USING (o_orderpriority, period)),
  t AS (SELECT *, CASE WHEN count(*) OVER w = 13 THEN (sum(v) OVER w - (lag(v, 6) OVER o + lead(v, 6) OVER o) / 2) / 12 END AS trend FROM m
        WINDOW o AS (PARTITION BY o_orderpriority ORDER BY period), w AS (PARTITION BY o_orderpriority ORDER BY period ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)),
  p AS (SELECT o_orderpriority, month(period) AS mo, avg(v - trend) AS phase FROM t GROUP BY 1, 2),
  c AS (SELECT o_orderpriority, avg(phase) AS centre FROM p GROUP BY 1)
  SELECT o_orderpriority, period, v AS observed, round(trend, 6) AS trend, round(phase - centre, 6) AS seasonal, round(v - trend - (phase - centre), 6) AS residual
  FROM t JOIN c USING (o_orderpriority) JOIN p ON p.o_orderpriority = t.o_orderpriority AND mo = month(period)""")
def st11_seasonal_decomposition(t):
    months = timeline.resample(
        t.orders, "o_orderdate", "month", {"v": F.round(F.sum("o_totalprice"), 2)}, ["v"], by=["o_orderpriority"])
    out = timeline.decompose_monthly(months, "v", by=["o_orderpriority"])
    return rounded(out, 6, "trend", "seasonal", "residual")


@query()
def st11_loess_decomposition(t):
    """No SQL twin: fifteen rounds of local regression; held against plain loops in the tests."""
    months = timeline.resample(
        t.orders, "o_orderdate", "month", {"v": F.sum("o_totalprice")}, ["v"], by=["o_orderpriority", "o_orderstatus"])
    out = timeline.decompose_loess(months, "v", by=["o_orderpriority", "o_orderstatus"])
    return rounded(out, 2, "observed", "trend", "seasonal", "residual")


_CHOSEN = ", ".join(f"range(1, 26) AS {x}(i)" for x in "abcde")


@query(f"""WITH v AS (SELECT n_name, n_regionkey = 2 AS asia, sum(c_acctbal) + n_nationkey / 1000 AS v FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, n_nationkey, n_regionkey),
           r AS (SELECT *, row_number() OVER (ORDER BY v) AS rk FROM v),
           s AS (SELECT sum(rk) FILTER (WHERE NOT asia) - 210 AS u, avg(v) FILTER (WHERE NOT asia) AS m0, avg(v) FILTER (WHERE asia) AS m1 FROM r),
           x AS (SELECT *, greatest(u, 100 - u) AS far FROM s),
           picks AS (SELECT a.i + b.i + c.i + d.i + e.i - 15 AS u FROM {_CHOSEN} WHERE a.i < b.i AND b.i < c.i AND c.i < d.i AND d.i < e.i),
           p AS (SELECT least(1.0, 2 * count(*) FILTER (WHERE picks.u >= far) / count(*)) AS p FROM picks, x)
           SELECT 'v' AS target, u::DOUBLE AS statistic, round((far - 50.5) / sqrt(100 / 12 * 26), 6) AS z, round(m0, 6) AS mean_event0, round(m1, 6) AS mean_event1,
                  round(m1 - m0, 6) AS mean_diff, round(p, 9) AS p_value, p < 0.05 AS bonferroni_significant FROM x, p""")
def st3_mann_whitney_exact(t):
    """Account balances of five nations against those of the twenty others: small samples, so all arrangements are counted."""
    nations = t.nation.select("n_nationkey", (F.col("n_regionkey") == 2).cast("int").alias("asia"))
    sums = t.customer.groupBy("c_nationkey").agg(F.sum("c_acctbal").alias("balance"))
    df = sums.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("asia", (F.col("balance") + F.col("n_nationkey") / 1000).alias("v"))
    out = rounded(inference.mann_whitney(df, ["v"], "asia"), 6, "z", "mean_event0", "mean_event1", "mean_diff")
    return rounded(out, 9, "p_value")
