"""Data-quality splits and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import parse_mixed_date
from ..operators import profile, quality
from ..operators.quality import Rule
from .frames import (
    APPOINTMENTS,
    RETAIL_LINES,
    SALES_LINES,
    SALES_REASON,
    WEB_SESSIONS,
    appointments,
    retail_lines,
    rounded,
    sales_lines,
    web_sessions,
)
from .registry import query


def sales_rules(threshold: int = 45) -> list[Rule]:
    return [
        Rule("negative unit_price", F.col("unit_price") < 0),
        Rule(f"quantity exceeds threshold (>{threshold})", F.col("quantity") > threshold),
        Rule("total_mismatch", quality.total_mismatch(
            F.col("total"), F.col("quantity"), F.col("unit_price"), F.col("discount_pct"))),
    ]


@query(f"""WITH {SALES_LINES}, {SALES_REASON}
           SELECT order_id, line, quantity, unit_price, reason FROM tagged WHERE reason IS NOT NULL""")
def dq1_all_reasons_split(t):
    parts = quality.split(sales_lines(t), quality.all_reasons(sales_rules()))
    return parts.dirty.select("order_id", "line", "quantity", "unit_price", "reason")


@query(f"""WITH {APPOINTMENTS} SELECT l_orderkey, l_linenumber, age, lead_days,
             CASE WHEN age < 0 THEN 'negative age' WHEN age > 115 THEN 'age > 115'
                  WHEN lead_days < 0 THEN 'appointment before scheduled date' END AS reason
           FROM appointments WHERE age < 0 OR age > 115 OR lead_days < 0""")
def dq2_first_reason_split(t):
    rules = [
        Rule("negative age", F.col("age") < 0),
        Rule("age > 115", F.col("age") > 115),
        Rule("appointment before scheduled date", F.col("lead_days") < 0),
    ]
    dirty = quality.split(appointments(t), quality.first_reason(rules)).dirty
    return dirty.select("l_orderkey", "l_linenumber", "age", "lead_days", "reason")


@query(f"""WITH {RETAIL_LINES}, {WEB_SESSIONS}, m AS (SELECT avg(profit) AS a, stddev_pop(profit) AS s FROM retail_base)
           SELECT l_orderkey AS key, 'lineitem' AS source_file,
                  CASE WHEN sales <= 1000 THEN 'sales_zero_or_negative' ELSE 'profit_extreme_outlier' END AS reason
           FROM retail_base, m WHERE sales <= 1000 OR abs((profit - a) / s) > 1.8
           UNION ALL SELECT event_id, 'events', 'zero_page_views' FROM web WHERE page_views = 0""")
def dq3_split_with_source(t):
    lines = retail_lines(t, parts=False)
    rules = [
        Rule("sales_zero_or_negative", F.col("sales") <= 1000),
        Rule("profit_extreme_outlier", quality.beyond_population_z(lines, "profit", 1.8)),
    ]
    bad_lines = quality.split(lines, quality.first_reason(rules)).dirty
    web = quality.split(web_sessions(t), quality.first_reason([Rule("zero_page_views", F.col("page_views") == 0)]))
    pick = lambda df, key, name: df.select(F.col(key).alias("key"), F.lit(name).alias("source_file"), "reason")
    return pick(bad_lines, "l_orderkey", "lineitem").unionByName(pick(web.dirty, "event_id", "events"))


@query(f"""WITH {SALES_LINES} SELECT order_id, line, total FROM sales_lines
           WHERE abs(total - quantity * unit_price * (1 - discount_pct / 100)) > 0.01""")
def dq4_arithmetic_rule(t):
    wrong = quality.total_mismatch(F.col("total"), F.col("quantity"), F.col("unit_price"), F.col("discount_pct"))
    return sales_lines(t).where(wrong).select("order_id", "line", "total")


@query("""WITH m AS (SELECT avg(value) AS a, stddev_pop(value) AS s FROM events)
          SELECT event_id, value FROM events, m WHERE abs((value - a) / s) > 3""")
def dq5_population_z(t):
    df = t.events.select("event_id", "value")
    return df.where(quality.beyond_population_z(df, "value"))


@query("""WITH m AS (SELECT avg(value) AS va, stddev_samp(value) AS vs, avg(user_id) AS ua, stddev_samp(user_id) AS us,
                            avg(event_id) AS ea, stddev_samp(event_id) AS es FROM events)
          SELECT event_id, value,
                 CASE WHEN abs(value - va) > 3 * vs THEN 'anomalous value in ''value'' (' || CAST(value AS VARCHAR) || ')' END AS reason
          FROM events, m
          WHERE abs(value - va) > 3 * vs OR abs(user_id - ua) > 3 * us OR abs(event_id - ea) > 3 * es""")
def dq6_sigma_all_columns(t):
    df = t.events.select("event_id", "user_id", "value")
    dirty = quality.split(df, quality.all_reasons(quality.sigma_rules(df))).dirty
    return dirty.select("event_id", "value", "reason")


_COPIES = """copies AS (SELECT * FROM supplier UNION ALL SELECT * FROM supplier WHERE s_acctbal > 5000
             UNION ALL SELECT * FROM supplier WHERE s_acctbal > 8000)"""


def _copies(t):
    s = t.supplier
    return s.unionByName(s.where("s_acctbal > 5000")).unionByName(s.where("s_acctbal > 8000"))


@query(f"""WITH {_COPIES} SELECT *, row_number() OVER (PARTITION BY s_suppkey, s_name, s_nationkey, s_acctbal) > 1
           AS is_repeat FROM copies""")
def dq7_repeated_rows(t):
    return quality.flag_repeats(_copies(t))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey) > 1 AS is_repeat
          FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 1)""")
def dq8_repeated_keys(t):
    """The first line of every order stands twice, so keys and whole rows repeat."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    df = lines.unionByName(lines.where("l_linenumber = 1"))
    return quality.flag_repeats(df, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey"])


AUDITED = f"""{_COPIES}, t AS (SELECT s_suppkey, nullif(s_name, 'Supplier#000000001') AS s_name,
             nullif(s_nationkey, 3) AS s_nationkey, CASE WHEN s_suppkey = 7 THEN 1e6 ELSE s_acctbal END AS s_acctbal FROM copies),
           m AS (SELECT avg(s_suppkey) a1, stddev_samp(s_suppkey) d1, avg(s_nationkey) a2, stddev_samp(s_nationkey) d2,
                        avg(s_acctbal) a3, stddev_samp(s_acctbal) d3 FROM t),
           audited AS (SELECT s_suppkey, s_name, s_nationkey, s_acctbal, nullif(concat_ws('; ',
              CASE WHEN row_number() OVER (PARTITION BY s_suppkey, s_name, s_nationkey, s_acctbal) > 1 THEN 'duplicate row' END,
              CASE WHEN s_name IS NULL THEN 'missing value in ''s_name''' END,
              CASE WHEN s_nationkey IS NULL THEN 'missing value in ''s_nationkey''' END,
              CASE WHEN abs(s_suppkey - a1) > 3 * d1 THEN 'anomalous value in ''s_suppkey''' END,
              CASE WHEN abs(s_nationkey - a2) > 3 * d2 THEN 'anomalous value in ''s_nationkey''' END,
              CASE WHEN abs(s_acctbal - a3) > 3 * d3 THEN 'anomalous value in ''s_acctbal''' END), '') AS reason FROM t, m)"""


def any_table(t):
    return _copies(t).select(
        "s_suppkey", F.nullif("s_name", F.lit("Supplier#000000001")).alias("s_name"),
        F.nullif("s_nationkey", F.lit(3)).alias("s_nationkey"),
        F.when(F.col("s_suppkey") == 7, F.lit(1e6)).otherwise(F.col("s_acctbal")).alias("s_acctbal"),
    )


def _without_values(df):
    """The reason text without the quoted value, whose number format differs between engines."""
    return df.withColumn("reason", F.regexp_replace("reason", r" \([^)]*\)", ""))


@query(f"WITH {AUDITED} SELECT * FROM audited")
def dq9_audit_any_table(t):
    return _without_values(quality.audit_any_table(any_table(t)))


_WEEKLY = """raw AS (
  SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'week ' || o_orderkey ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date,
         CAST(floor(o_totalprice / 1000) - 5 AS INTEGER) AS units, o_totalprice AS revenue,
         CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 1.2 WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE 5000 END AS cost FROM orders)"""


@query(f"""WITH {_WEEKLY} SELECT o_orderkey, CASE WHEN units <= 0 THEN 'non_positive_units'
              WHEN revenue <= 0 THEN 'non_positive_revenue' WHEN cost <= 0 THEN 'non_positive_cost'
              WHEN cost > revenue THEN 'cost_exceeds_revenue'
              WHEN try_strptime(date, '%Y-%m-%d') IS NULL THEN 'invalid_date'
              WHEN cost IS NULL THEN 'missing_required_field' END AS reason FROM raw""")
def dq10_cross_column_rules(t):
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None)).otherwise(F.lit(5000.0))
    df = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("week "), F.col("o_orderkey").cast("string")))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"),
        (F.floor(F.col("o_totalprice") / 1000) - 5).cast("int").alias("units"),
        F.col("o_totalprice").alias("revenue"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") * 1.2).otherwise(urgent).alias("cost"),
    )
    rules = [
        Rule("non_positive_units", F.col("units") <= 0),
        Rule("non_positive_revenue", F.col("revenue") <= 0),
        Rule("non_positive_cost", F.col("cost") <= 0),
        Rule("cost_exceeds_revenue", F.col("cost") > F.col("revenue")),
        Rule("invalid_date", F.try_to_date("date", "yyyy-MM-dd").isNull()),
        Rule("missing_required_field", quality.any_null(["units", "revenue", "cost", "date"])),
    ]
    return df.select("o_orderkey", quality.first_reason(rules).alias("reason"))


@query(f"""WITH {SALES_LINES}, {SALES_REASON}
           SELECT reason, count(*) AS n FROM tagged WHERE reason IS NOT NULL GROUP BY reason""")
def dq11_reason_counts(t):
    return quality.reason_counts(quality.split(sales_lines(t), quality.all_reasons(sales_rules())).dirty)


@query(f"""WITH {AUDITED} SELECT CASE WHEN part LIKE 'missing%' THEN 'missing value' WHEN part LIKE 'anomalous%'
             THEN 'anomalous value' WHEN part LIKE 'duplicate%' THEN 'duplicate row' ELSE part END AS issue, count(*) AS n
           FROM (SELECT unnest(string_split(reason, '; ')) AS part FROM audited WHERE reason IS NOT NULL) GROUP BY 1""")
def dq12_issue_counts(t):
    return quality.issue_counts(quality.audit_any_table(any_table(t)).where("reason is not null"))


@query(f"""WITH {SALES_LINES}, {SALES_REASON} SELECT count(*) AS total_rows, count(reason) AS dirty_rows,
             round_even((1 - count(reason) / count(*)) * 100, 1) AS pass_rate_pct FROM tagged""")
def dq13_pass_rate(t):
    return quality.pass_rate(sales_lines(t).withColumn("reason", quality.all_reasons(sales_rules())))


@query(f"""WITH {SALES_LINES}, {SALES_REASON}
           SELECT 'negative unit_price' AS "check", count(*) FILTER (WHERE unit_price < 0) AS violations FROM tagged
           UNION ALL SELECT 'quantity exceeds threshold (>40)', count(*) FILTER (WHERE quantity > 40) FROM tagged WHERE reason IS NULL
           UNION ALL SELECT 'total_mismatch', CAST(0 AS BIGINT)""".replace(
    "violations FROM tagged\n", "violations FROM tagged WHERE reason IS NULL\n"))
def dq14_post_clean_checks(t):
    clean = quality.split(sales_lines(t), quality.all_reasons(sales_rules())).clean
    return quality.violation_counts(clean, sales_rules(threshold=40))


@query("""SELECT 'no rule fails' AS label, count(*) FILTER (WHERE l_quantity < 0) AS dirty,
                 count(*) FILTER (WHERE l_quantity < 0) = 0 AS warned FROM lineitem
          UNION ALL SELECT 'some rule fails', count(*) FILTER (WHERE l_quantity > 45),
                 count(*) FILTER (WHERE l_quantity > 45) = 0 FROM lineitem""")
def dq15_nothing_dirty_warning(t):
    out = []
    for label, rule in (("no rule fails", F.col("l_quantity") < 0), ("some rule fails", F.col("l_quantity") > 45)):
        dirty = quality.split(t.lineitem, quality.first_reason([Rule("quantity", rule)])).dirty
        warned = quality.warn_when_nothing_dirty(dirty, label)
        out.append(dirty.agg(F.count("*").alias("dirty")).select(
            F.lit(label).alias("label"), "dirty", F.lit(warned).alias("warned")))
    return out[0].unionByName(out[1])



def _profile_sql(columns: dict[str, str]) -> str:
    numeric = """SELECT {i} AS position, '{c}' AS "column", '{d}' AS dtype, count(*) AS total_count,
        count(*) - count({c}) AS null_count, round_even((count(*) - count({c})) / count(*) * 100, 2) AS null_pct,
        count(DISTINCT {c}) AS unique_count, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
        round_even(avg({c}), 4) AS mean, round_even(stddev_samp({c}), 4) AS std, round_even(quantile_cont({c}, 0.25), 4) AS p25,
        round_even(quantile_cont({c}, 0.5), 4) AS p50, round_even(quantile_cont({c}, 0.75), 4) AS p75 FROM src"""
    text = """SELECT {i} AS position, '{c}' AS "column", '{d}' AS dtype, count(*) AS total_count,
        count(*) - count({c}) AS null_count, round_even((count(*) - count({c})) / count(*) * 100, 2) AS null_pct,
        count(DISTINCT {c}) AS unique_count, NULL::DOUBLE AS min, NULL::DOUBLE AS max, NULL::DOUBLE AS mean,
        NULL::DOUBLE AS std, NULL::DOUBLE AS p25, NULL::DOUBLE AS p50, NULL::DOUBLE AS p75 FROM src"""
    return " UNION ALL ".join(
        (text if d == "string" else numeric).format(i=i, c=c, d=d) for i, (c, d) in enumerate(columns.items())
    )


@query(f"""WITH {SALES_LINES}, src AS (SELECT order_id, quantity, unit_price, discount_pct,
             nullif(CAST(line AS VARCHAR), '7') AS line_text FROM sales_lines) """ + _profile_sql(
    {"order_id": "bigint", "quantity": "double", "unit_price": "double", "discount_pct": "double",
     "line_text": "string"}))
def dq16_column_profile(t):
    df = sales_lines(t).select(
        "order_id", "quantity", "unit_price", "discount_pct",
        F.nullif(F.col("line").cast("string"), F.lit("7")).alias("line_text"),
    )
    return profile.profile_columns(df)


@query("""SELECT o_orderpriority, count(*) AS n, round(count(*) / (SELECT count(*) FROM orders), 6) AS proportion
          FROM orders GROUP BY 1""")
def dq17_category_profile(t):
    return rounded(profile.category_profile(t.orders, "o_orderpriority"), 6, "proportion")


@query("""SELECT 'event_id' AS "column" FROM events HAVING count(DISTINCT event_id) = count(*)
          UNION ALL SELECT 'user_id' FROM events HAVING count(DISTINCT user_id) = count(*)""")
def dq18_id_like_columns(t):
    return profile.id_like_columns(t.events)


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a' ELSE strftime(o_orderdate, '%d-%m-%Y') END AS raw
          FROM orders WHERE o_orderpriority = '5-LOW'""")
def dq19_unparsable_dates(t):
    raw = F.when(F.col("o_orderpriority") == "5-LOW", "n/a").otherwise(F.date_format("o_orderdate", "dd-MM-yyyy"))
    df = t.orders.select("o_orderkey", raw.alias("raw"))
    return df.where(parse_mixed_date(F.col("raw")).isNull())
