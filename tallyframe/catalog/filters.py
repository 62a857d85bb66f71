"""Projection, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import label_or
from ..operators import quality, topk
from .frames import SALES_LINES, SALES_ORDERS, WEB_SESSIONS, sales_lines, sales_orders, web_sessions
from .registry import query


@query("SELECT l_orderkey, l_quantity FROM lineitem")
def pf1_projection(t):
    return t.lineitem.select("l_orderkey", "l_quantity")


@query("SELECT p_partkey, p_name, p_type, p_size, p_retailprice FROM part")
def pf2_drop_columns(t):
    return t.part.drop("p_brand")


@query("SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS total FROM orders")
def pf3_rename(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice").toDF("order_id", "customer_id", "total")


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity <= 10")
def pf4_comparison(t):
    return t.lineitem.where(F.col("l_quantity") <= 10).select("l_orderkey", "l_linenumber", "l_quantity")


@query(f"""WITH {SALES_LINES} SELECT order_id, line, quantity, unit_price FROM sales_lines
           WHERE (coalesce(unit_price < 0, false) OR coalesce(quantity > 45, false))
             AND NOT coalesce(unit_price > 50000, false)""")
def pf5_boolean_masks(t):
    df = sales_lines(t)
    known = lambda c: F.coalesce(c, F.lit(False))
    mask = known(F.col("unit_price") < 0) | known(F.col("quantity") > 45)
    return df.where(mask & ~known(F.col("unit_price") > 50000)).select("order_id", "line", "quantity", "unit_price")


@query(f"WITH {WEB_SESSIONS} SELECT event_id, bounce_rate FROM web WHERE bounce_rate < 0.1 OR bounce_rate > 1")
def pf6_outside_range(t):
    return web_sessions(t).where(~F.col("bounce_rate").between(0.1, 1)).select("event_id", "bounce_rate")


@query("""SELECT o_orderkey, o_orderpriority, o_orderpriority IN ('1-URGENT', '2-HIGH') AS urgent,
                 o_orderstatus NOT IN ('P', 'F') AS other_status FROM orders""")
def pf7_membership(t):
    return t.orders.select(
        "o_orderkey", "o_orderpriority", F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("urgent"),
        (~F.col("o_orderstatus").isin("P", "F")).alias("other_status"),
    )


@query(f"""WITH {SALES_LINES} SELECT order_id, line, unit_price IS NULL AS missing_price,
               unit_price IS NULL OR total IS NULL OR quantity IS NULL AS any_missing FROM sales_lines""")
def pf8_null_tests(t):
    return sales_lines(t).select(
        "order_id", "line", F.col("unit_price").isNull().alias("missing_price"),
        quality.any_null(["unit_price", "total", "quantity"]).alias("any_missing"),
    )


@query(f"WITH {SALES_ORDERS} SELECT order_id, coalesce(sales_rep, '(unknown)') AS rep FROM sales_orders")
def pf9_null_label(t):
    return sales_orders(t).select("order_id", label_or(F.col("sales_rep"), "(unknown)").alias("rep"))


@query("""WITH h AS (SELECT count(*) FILTER (WHERE regexp_matches(p_name, '(?i)GREEN|bolt')) AS k FROM part),
          f AS (SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 10)
          SELECT p_partkey, p_name FROM part, h WHERE regexp_matches(p_name, '(?i)GREEN|bolt') AND k >= 2
          UNION ALL SELECT p_partkey, p_name FROM f, h WHERE k < 2""")
def pf10_regex_or_first(t):
    return topk.text_filter_or_first(
        t.part.select("p_partkey", "p_name"), "p_name", "GREEN|bolt", ["p_partkey"]
    )


@query("""SELECT p_partkey, p_type, 'chosen' AS mode FROM part WHERE p_type IN ('PROMO', 'SMALL')
          UNION ALL SELECT p_partkey, p_type, 'all' FROM part""")
def pf11_multi_select(t):
    df = t.part.select("p_partkey", "p_type")
    chosen = topk.multi_select(df, "p_type", ["PROMO", "SMALL"]).withColumn("mode", F.lit("chosen"))
    return chosen.unionByName(topk.multi_select(df, "p_type", []).withColumn("mode", F.lit("all")))
