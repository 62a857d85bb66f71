"""Scalar functions and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bins, dates, numbers, text
from ..operators import customers, grouping, reshape
from .aggregates import LEAD_CASE, LEAD_EDGES, LEAD_LABELS, TYPES
from .frames import APPOINTMENTS, SALES_ORDERS, appointments, sales_orders
from .registry import query

_MIXED = """CASE o_orderstatus WHEN 'P' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 'F' THEN strftime(o_orderdate, '%d-%m-%Y') ELSE strftime(o_orderdate, '%m/%d/%Y') END"""


@query(f"""SELECT o_orderkey, raw, CAST(coalesce(try_strptime(raw, '%Y-%m-%d'), try_strptime(replace(raw, '/', '-'), '%m-%d-%Y'),
             try_strptime(raw, '%d-%m-%Y')) AS DATE) AS parsed FROM (SELECT o_orderkey, {_MIXED} AS raw FROM orders)""")
def s1_mixed_dates(t):
    raw = (
        F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "dd-MM-yyyy"))
        .otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
    )
    return t.orders.select("o_orderkey", raw.alias("raw")).withColumn("parsed", dates.parse_mixed_date(F.col("raw")))


@query("SELECT event_id, ts AS utc, ts - INTERVAL 2 HOUR AS shifted FROM events")
def s2_utc_parse(t):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return t.events.select(
        "event_id", dates.parse_utc(F.concat(iso, F.lit("Z"))).alias("utc"),
        dates.parse_utc(F.concat(iso, F.lit("+02:00"))).alias("shifted"),
    )


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start FROM orders")
def s3_month_key(t):
    return t.orders.select("o_orderkey", dates.month_key(F.col("o_orderdate")).alias("month"),
                           F.trunc("o_orderdate", "month").alias("month_start"))


@query(f"WITH {APPOINTMENTS} SELECT l_orderkey, l_linenumber, lead_days FROM appointments")
def s4_day_difference(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = t.orders.select("o_orderkey", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", dates.days_between(F.col("l_shipdate"), F.col("o_orderdate")).alias("lead_days"))


@query("""SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year, CAST(month(o_orderdate) AS INTEGER) AS order_month,
                 CAST(isodow(o_orderdate) - 1 AS INTEGER) AS order_dayofweek FROM orders""")
def s5_date_parts(t):
    return t.orders.select("o_orderkey", F.year("o_orderdate").alias("order_year"), F.month("o_orderdate").alias("order_month"),
                           dates.weekday_number(F.col("o_orderdate")).alias("order_dayofweek"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%a') AS weekday, strftime(o_orderdate, '%B') AS month FROM orders")
def s6_date_names(t):
    d = F.col("o_orderdate")
    return t.orders.select("o_orderkey", dates.weekday_name(d).alias("weekday"), dates.month_name(d).alias("month"))


@query("""SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS last_order, CAST((SELECT max(o_orderdate) FROM orders) + INTERVAL 1 DAY AS DATE) AS reference_date
          FROM orders GROUP BY 1""")
def s7_reference_date(t):
    reference = t.orders.select(F.date_add(F.max("o_orderdate").cast("date"), 1)).scalar()
    return t.orders.groupBy("o_custkey").agg(F.max("o_orderdate").cast("date").alias("last_order")).withColumn(
        "reference_date", reference)


@query("""SELECT o_orderstatus, strftime(min(o_orderdate), '%Y-%m-%d') || ' to ' || strftime(max(o_orderdate), '%Y-%m-%d') AS range FROM orders GROUP BY 1""")
def s8_date_range_text(t):
    return t.orders.groupBy("o_orderstatus").agg(dates.date_range_text(F.col("o_orderdate")).alias("range"))


@query("SELECT l_orderkey, l_linenumber, l_discount, l_tax, l_discount / nullif(l_tax, 0) AS ratio FROM lineitem")
def s9_safe_ratio(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_discount", "l_tax",
                             numbers.safe_ratio(F.col("l_discount"), F.col("l_tax")).alias("ratio"))


@query("""SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS is_big, o_orderstatus = 'P' AS is_pending,
                 nullif(o_orderpriority, '5-LOW') IS NULL AS missing_priority FROM orders""")
def s10_flags(t):
    return t.orders.select(
        "o_orderkey", numbers.flag(F.col("o_totalprice") > 250000).alias("is_big"), (F.col("o_orderstatus") == "P").alias("is_pending"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).isNull().alias("missing_priority"))


@query("""SELECT l_orderkey, l_linenumber, abs(l_extendedprice - 50000) AS gap, round_even(l_quantity / 2, 0) AS half,
                 round_even(l_discount * 100, 1) AS discount_pct FROM lineitem""")
def s11_rounding(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.abs(F.col("l_extendedprice") - 50000).alias("gap"),
        numbers.half_even(F.col("l_quantity") / 2).alias("half"),
        numbers.half_even(numbers.percent(F.col("l_discount")), 1).alias("discount_pct"))


@query(f"WITH {APPOINTMENTS} SELECT l_orderkey, l_linenumber, lead_days, {LEAD_CASE} AS lead_bucket FROM appointments")
def s12_labelled_cut(t):
    return appointments(t).select("l_orderkey", "l_linenumber", "lead_days",
                                  bins.cut(F.col("lead_days"), LEAD_EDGES, LEAD_LABELS).alias("lead_bucket"))


@query("""WITH s AS (SELECT min(l_discount) AS a, max(l_discount) AS b FROM lineitem),
          x AS (SELECT l_orderkey, l_linenumber, l_discount, a, b, 1 + """ + " + ".join(
    f"CASE WHEN l_discount > a + (b - a) / 10 * {k} THEN 1 ELSE 0 END" for k in range(1, 10)) + """ AS bin FROM lineitem, s)
          SELECT l_orderkey, l_linenumber, CAST(bin AS INTEGER) AS bin,
                 round((CASE WHEN bin = 1 THEN a - (b - a) * 0.001 ELSE a + (b - a) / 10 * (bin - 1) END + a + (b - a) / 10 * bin) / 2, 9) AS midpoint FROM x""")
def s13_equal_width_cut(t):
    s = t.lineitem.agg(F.struct(F.min("l_discount").alias("a"), F.max("l_discount").alias("b")).alias("s")).scalar()
    left, right = bins.equal_width_edges(F.col("bin"), s["a"], s["b"], 10)
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", bins.equal_width_bin(F.col("l_discount"), s["a"], s["b"], 10).alias("bin")
    ).withColumn("midpoint", F.round((left + right) / 2, 9))


@query("SELECT o_orderkey, '$' || format('{:,}', CAST(round_even(o_totalprice, 0) AS BIGINT)) AS label FROM orders")
def s14_currency(t):
    return t.orders.select("o_orderkey", numbers.currency(F.col("o_totalprice")).alias("label"))


@query("SELECT l_orderkey, l_linenumber, l_returnflag || l_linestatus || CAST(l_linenumber AS VARCHAR) AS code FROM lineitem")
def s15_code(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", F.concat("l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string")).alias("code"))


@query(f"""WITH {SALES_ORDERS} SELECT status, status || '<br>$' || format('{{:,}}', CAST(round_even(sum(revenue), 0) AS BIGINT)) || '<br>' || count(*) || ' orders' AS label
           FROM sales_orders GROUP BY 1""")
def s16_label_template(t):
    br = F.lit("<br>")
    return sales_orders(t).groupBy("status").agg(
        F.concat(F.col("status"), br, numbers.currency(F.sum("revenue")), br, F.count("*").cast("string"), F.lit(" orders")).alias("label"))


_JOINED = "c_mktsegment || ' :: ' || c_name || ' :: x'"


@query(f"""SELECT c_custkey, split_part(s, ' :: ', 1) AS prefix, substr(s, strpos(s, ' :: ') + 4) AS rest
           FROM (SELECT c_custkey, {_JOINED} AS s FROM customer)""")
def s17_split_once(t):
    joined = F.concat_ws(" :: ", "c_mktsegment", "c_name", F.lit("x"))
    prefix, rest = text.split_once(F.col("s"), " :: ")
    return t.customer.select("c_custkey", joined.alias("s")).select("c_custkey", prefix.alias("prefix"), rest.alias("rest"))


@query("""SELECT conv_id, turn, TRY_CAST(regexp_replace(v, '[,%]', '', 'g') AS DOUBLE) AS number FROM (
            SELECT conv_id, turn, CASE role WHEN 'user' THEN format('{:,}', 1000 * length(text)) WHEN 'system' THEN text ELSE (turn / 2) || '%' END AS v FROM conversations)
          WHERE TRY_CAST(regexp_replace(v, '[,%]', '', 'g') AS DOUBLE) IS NOT NULL""")
def s18_number_from_text(t):
    v = (
        F.when(F.col("role") == "user", F.format_number(F.length("text") * 1000, 0))
        .when(F.col("role") == "system", F.col("text"))
        .otherwise(F.concat((F.col("turn") / 2).cast("string"), F.lit("%")))
    )
    df = t.conversations.select("conv_id", "turn", v.alias("v"))
    return df.select("conv_id", "turn", numbers.number_from_text(F.col("v")).alias("number")).where("number is not null")


_STATUS = f"""{SALES_ORDERS}, g AS (SELECT region, status, count(*) AS order_count, round(sum(revenue), 2) AS revenue_sum FROM sales_orders GROUP BY 1, 2)"""


def _region_status(t):
    return sales_orders(t, region=True).groupBy("region", "status").agg(
        F.count("*").alias("order_count"), F.round(F.sum("revenue"), 2).alias("revenue_sum"))


@query(f"""WITH {_STATUS} SELECT 'region_status' AS "table", region || ' | ' || status || ' :: order_count' AS metric_name, CAST(order_count AS DOUBLE) AS metric_number FROM g
           UNION ALL SELECT 'region_status', region || ' | ' || status || ' :: revenue_sum', revenue_sum FROM g""")
def s19_wide_to_long(t):
    return reshape.to_long(_region_status(t), "region_status").drop("metric_value")


@query(f"""WITH {_STATUS} SELECT region || ' | ' || status AS prefix, CAST(order_count AS DOUBLE) AS order_count, revenue_sum FROM g""")
def s20_long_to_wide(t):
    long = reshape.to_long(_region_status(t), "region_status")
    return reshape.from_long(long, "region_status", ["order_count", "revenue_sum"])


@query("""WITH g AS (SELECT p_type, p_brand, count(*) AS n FROM part WHERE NOT (p_type = 'PROMO' AND p_brand = 'Brand#1') GROUP BY 1, 2),
          k AS (SELECT DISTINCT p_type FROM g), b AS (SELECT DISTINCT p_brand FROM g)
          SELECT p_brand, p_type AS category, coalesce(n, 0) AS parts FROM b, k LEFT JOIN g USING (p_type, p_brand)""".replace(
    "b, k LEFT JOIN g USING (p_type, p_brand)", "(SELECT * FROM b, k) LEFT JOIN g USING (p_type, p_brand)"))
def s21_melt(t):
    kept = t.part.where(~((F.col("p_type") == "PROMO") & (F.col("p_brand") == "Brand#1")))
    wide = grouping.contingency(kept, "p_brand", "p_type", TYPES)
    return grouping.melt(wide, ["p_brand"], "category", "parts")


@query("""SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'R' THEN 'Returned' WHEN 'A' THEN 'Accepted' END AS label FROM lineitem""")
def s22_recode(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", text.recode(F.col("l_returnflag"), {"R": "Returned", "A": "Accepted"}).alias("label"))


@query("""SELECT p_partkey, upper(substr(split_part(p_name, ' ', 1), 1, 1)) || substr(split_part(p_name, ' ', 1), 2) || ' ' ||
                 upper(substr(split_part(p_name, ' ', 2), 1, 1)) || substr(split_part(p_name, ' ', 2), 2) AS title,
                 starts_with(p_name, 'red') AS starts_red, contains(lower(p_name), 'bolt') AS has_bolt FROM part""")
def s23_text(t):
    slug = F.replace(F.col("p_name"), F.lit(" "), F.lit("_"))
    return t.part.select(
        "p_partkey", text.title_from_slug(slug).alias("title"), F.startswith("p_name", F.lit("red")).alias("starts_red"),
        text.contains_ci(F.col("p_name"), "BOLT").alias("has_bolt"))


@query("SELECT count(*) AS n, CAST(0 AS BIGINT) AS out_of_bounds FROM lineitem")
def s24_jitter(t):
    moved = t.lineitem.select(F.abs(numbers.jitter(F.col("l_quantity")) - F.col("l_quantity")).alias("shift"))
    return moved.agg(F.count("*").alias("n"), F.count_if(F.col("shift") > 0.1 + 1e-9).alias("out_of_bounds"))


RFM = """base AS (SELECT o_custkey, CAST(date_diff('day', CAST(max(o_orderdate) AS DATE), (SELECT CAST(max(o_orderdate) AS DATE) + 1 FROM orders)) AS INTEGER) AS recency,
     count(DISTINCT o_orderkey) AS frequency, sum(o_totalprice) AS monetary FROM orders GROUP BY 1),
  edges AS (SELECT quantile_cont(recency, [0.25, 0.5, 0.75]) AS e, count(*) AS n FROM base),
  ranked AS (SELECT *, row_number() OVER (ORDER BY frequency, o_custkey) AS fr, row_number() OVER (ORDER BY monetary, o_custkey) AS mr FROM base, edges),
  rfm AS (SELECT o_custkey, recency, frequency, round_even(monetary, 2) AS monetary,
     CAST(CASE WHEN recency <= e[1] THEN 4 WHEN recency <= e[2] THEN 3 WHEN recency <= e[3] THEN 2 ELSE 1 END AS INTEGER) AS r_score,
     CAST(1 + CASE WHEN fr > 1 + (n - 1) / 4 THEN 1 ELSE 0 END + CASE WHEN fr > 1 + (n - 1) * 2 / 4 THEN 1 ELSE 0 END + CASE WHEN fr > 1 + (n - 1) * 3 / 4 THEN 1 ELSE 0 END AS INTEGER) AS f_score,
     CAST(1 + CASE WHEN mr > 1 + (n - 1) / 4 THEN 1 ELSE 0 END + CASE WHEN mr > 1 + (n - 1) * 2 / 4 THEN 1 ELSE 0 END + CASE WHEN mr > 1 + (n - 1) * 3 / 4 THEN 1 ELSE 0 END AS INTEGER) AS m_score FROM ranked),
  scored AS (SELECT *, CAST(r_score AS VARCHAR) || f_score || m_score AS rfm_score,
     CASE WHEN r_score = 4 AND f_score = 4 AND m_score = 4 THEN 'Champions' WHEN r_score >= 3 AND f_score >= 3 AND m_score >= 4 THEN 'Loyal'
          WHEN r_score <= 2 AND f_score <= 2 AND m_score <= 2 THEN 'At Risk' ELSE 'Mid-tier' END AS segment FROM rfm)"""


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 4 AND l_quantity = 4 THEN 'Champions' WHEN l_linenumber >= 3 AND l_quantity >= 4 AND l_quantity >= 3 THEN 'Loyal'
            WHEN l_linenumber <= 2 AND l_quantity <= 2 THEN 'At Risk' ELSE 'Mid-tier' END AS segment FROM lineitem""")
def ud1_segment_rule(t):
    r, q = F.col("l_linenumber"), F.col("l_quantity")
    return t.lineitem.select("l_orderkey", "l_linenumber", customers.segment_of(r, q, q).alias("segment"))


@query("""SELECT o_custkey, date_diff('day', CAST(max(o_orderdate) AS DATE), (SELECT CAST(max(o_orderdate) AS DATE) + 1 FROM orders)) AS days_since_last
          FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1""")
def ud2_days_since_last_order(t):
    return customers.recency_frequency_spend(t.orders, "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice").select(
        "o_custkey", F.col("recency").cast("bigint").alias("days_since_last"))


@query("""SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') || ' days' AS age,
            '$' || format('{:,}', CAST(round_even(o_totalprice, 0) AS BIGINT)) AS label FROM orders""")
def ud3_element_labels(t):
    days = dates.days_between(F.lit("2002-01-01").cast("date"), F.col("o_orderdate"))
    return t.orders.select(
        "o_orderkey", F.concat(days.cast("string"), F.lit(" days")).alias("age"), numbers.currency(F.col("o_totalprice")).alias("label"))


@query(f"WITH {RFM} SELECT * FROM scored")
def ud4_rfm_scores(t):
    return customers.rfm_scores(t.orders, "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


