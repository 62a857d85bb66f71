"""Test tables seen through the column contracts of the pipelines, each with its SQL twin.

The tables hold no nulls or broken rows, so some are put in from ordinary column conditions,
the same way on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import Tables

UNIT_COST = 800.0


def sales_lines(t: Tables) -> DataFrame:
    """Order lines with some null and negative prices and some wrong totals."""
    negative = (F.col("l_tax") == 0.08) & (F.col("l_discount") == 0.1)
    missing = (F.col("l_tax") == 0.0) & (F.col("l_discount") == 0.0)
    price = F.when(missing, F.lit(None)).when(negative, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"),
        F.col("l_partkey"), F.col("l_suppkey"), F.col("l_shipdate"),
        F.col("l_quantity").alias("quantity"), price.alias("unit_price"),
        (F.col("l_discount") * 100).alias("discount_pct"), F.col("l_tax"),
    )
    wrong = F.when((F.col("line") == 7) & (F.col("l_tax") == 0.03), F.lit(1.0)).otherwise(F.lit(0.0))
    total = F.col("quantity") * F.col("unit_price") * (1 - F.col("discount_pct") / 100) + wrong
    return lines.withColumn("total", total)


SALES_LINES = """
sales_raw AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey, l_suppkey, l_shipdate,
         l_quantity AS quantity,
         CASE WHEN l_tax = 0.0 AND l_discount = 0.0 THEN NULL
              WHEN l_tax = 0.08 AND l_discount = 0.1 THEN -l_extendedprice
              ELSE l_extendedprice END AS unit_price,
         l_discount * 100 AS discount_pct, l_tax
  FROM lineitem),
sales_lines AS (
  SELECT *, quantity * unit_price * (1 - discount_pct / 100)
            + CASE WHEN line = 7 AND l_tax = 0.03 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS total
  FROM sales_raw)
"""

SALES_REASON = """
tagged AS (
  SELECT *, nullif(concat_ws('; ',
      CASE WHEN unit_price < 0 THEN 'negative unit_price' END,
      CASE WHEN quantity > 45 THEN 'quantity exceeds threshold (>45)' END,
      CASE WHEN abs(total - quantity * unit_price * (1 - discount_pct / 100)) > 0.01
           THEN 'total_mismatch' END), '') AS reason
  FROM sales_lines)
"""


def sales_orders(t: Tables, region: bool = False) -> DataFrame:
    """Orders as sales: revenue, status, a nullable sales rep; with the region when asked."""
    status = F.when(F.col("o_orderstatus") == "P", "Pending").when(
        F.col("o_orderstatus") == "F", "Completed").otherwise("Open")
    orders = t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer"),
        F.col("o_orderdate").alias("date"), F.col("o_totalprice").alias("revenue"),
        status.alias("status"),
        F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("sales_rep"),
        (F.col("o_orderstatus") == "P").alias("is_pending"),
    )
    if not region:
        return orders
    places = (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("c_custkey").alias("customer"), F.col("r_name").alias("region"),
                F.col("n_name").alias("nation"), F.col("c_mktsegment").alias("segment"),
                F.col("c_name").alias("customer_name"))
    )
    return orders.join(places, "customer")


SALES_ORDERS = """
sales_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer, o_orderdate AS date, o_totalprice AS revenue,
         CASE o_orderstatus WHEN 'P' THEN 'Pending' WHEN 'F' THEN 'Completed' ELSE 'Open' END AS status,
         nullif(o_orderpriority, '4-NOT SPECIFIED') AS sales_rep,
         o_orderstatus = 'P' AS is_pending, r_name AS region, n_name AS nation,
         c_mktsegment AS segment, c_name AS customer_name
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey)
"""


def retail_lines(t: Tables, parts: bool = True) -> DataFrame:
    """Order lines with profit, margin and loss flag; with product columns when asked."""
    profit = F.col("l_extendedprice") * (1 - F.col("l_discount")) - F.col("l_quantity") * UNIT_COST
    lines = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate",
        F.col("l_extendedprice").alias("sales"), profit.alias("profit"),
    ).withColumn("profit_margin", F.try_divide("profit", "sales")).withColumn(
        "is_loss", (F.col("profit") < 0).cast("int"))
    if not parts:
        return lines
    return lines.join(
        t.part.select("p_partkey", F.col("p_type").alias("category"), F.col("p_brand").alias("sub_category")),
        F.col("l_partkey") == F.col("p_partkey"),
    )


RETAIL_LINES = f"""
retail_base AS (
  SELECT *, l_extendedprice AS sales, l_extendedprice * (1 - l_discount) - l_quantity * {UNIT_COST} AS profit
  FROM lineitem),
retail_lines AS (
  SELECT r.*, profit / nullif(sales, 0) AS profit_margin, CASE WHEN profit < 0 THEN 1 ELSE 0 END AS is_loss,
         p_type AS category, p_brand AS sub_category
  FROM retail_base r JOIN part ON l_partkey = p_partkey)
"""


def appointments(t: Tables) -> DataFrame:
    """Lines joined to orders as visits: scheduled, appointment, age, flags, outcome."""
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").alias("neighbourhood"),
        F.col("l_shipdate").alias("appointment_dt"), (F.col("l_quantity") * 3 - 5).cast("int").alias("age"),
        (F.col("l_discount") > 0.05).cast("int").alias("scholarship"),
        (F.col("l_tax") > 0.04).cast("int").alias("hypertension"),
        (F.col("l_quantity") > 25).cast("int").alias("diabetes"),
        (F.col("l_linenumber") == 1).cast("int").alias("alcoholism"),
        (F.col("l_linenumber") - 1).alias("handcap"),
        (F.col("l_linestatus") == "F").cast("int").alias("sms_received"),
        (F.col("l_returnflag") == "R").cast("int").alias("noshow_flag"),
    )
    orders = t.orders.select("o_orderkey", F.col("o_custkey").alias("patient_id"),
                             F.col("o_orderdate").alias("scheduled_dt"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn(
        "lead_days", F.datediff("appointment_dt", "scheduled_dt"))


APPOINTMENTS = """
appointments AS (
  SELECT l_orderkey, l_linenumber, l_suppkey AS neighbourhood, l_shipdate AS appointment_dt,
         CAST(l_quantity * 3 - 5 AS INTEGER) AS age,
         CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS scholarship,
         CASE WHEN l_tax > 0.04 THEN 1 ELSE 0 END AS hypertension,
         CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS diabetes,
         CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END AS alcoholism,
         l_linenumber - 1 AS handcap,
         CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS sms_received,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS noshow_flag,
         o_custkey AS patient_id, o_orderdate AS scheduled_dt,
         CAST(date_diff('day', o_orderdate, l_shipdate) AS INTEGER) AS lead_days
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""


def web_sessions(t: Tables) -> DataFrame:
    """Events as web sessions; k of the properties feeds views, bounce rate and visits."""
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    return t.events.withColumn("k", k).select(
        "event_id", "user_id", "ts", F.col("event_type").alias("traffic_source"),
        F.col("k").alias("page_views"), F.col("value").alias("session_duration"),
        (F.col("k") / 90.0).alias("bounce_rate"), (F.col("value") / 10).alias("time_on_page"),
        F.floor(F.col("k") / 10).cast("int").alias("previous_visits"),
        F.least(F.col("value") / 100, F.lit(1.0)).alias("conversion_rate"),
        (F.col("event_type") == "error").cast("int").alias("is_error"),
    )


WEB_SESSIONS = """
web_base AS (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events),
web AS (
  SELECT event_id, user_id, ts, event_type AS traffic_source, k AS page_views,
         value AS session_duration, k / 90.0::DOUBLE AS bounce_rate, value / 10 AS time_on_page,
         CAST(floor(k / 10.0) AS INTEGER) AS previous_visits,
         least(value / 100, 1.0::DOUBLE) AS conversion_rate,
         CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_error
  FROM web_base)
"""


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})
