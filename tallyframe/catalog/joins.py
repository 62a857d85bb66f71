"""Joins, set operations, sorting and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.bins import cut
from ..operators import grouping, reshape, topk
from ..operators.quality import all_reasons, split
from .cleaning import sales_rules
from .frames import (
    APPOINTMENTS,
    RETAIL_LINES,
    SALES_LINES,
    SALES_ORDERS,
    SALES_REASON,
    appointments,
    retail_lines,
    rounded,
    sales_lines,
    sales_orders,
)
from .registry import query


@query(f"""WITH {RETAIL_LINES}, a AS (SELECT category, sub_category, count(*) AS n FROM retail_lines GROUP BY 1, 2),
           b AS (SELECT category, sub_category, round(avg(is_loss) * 100, 6) AS pct_loss FROM retail_lines GROUP BY 1, 2)
           SELECT * FROM a JOIN b USING (category, sub_category)""")
def j1_inner_two_keys(t):
    df, keys = retail_lines(t), ["category", "sub_category"]
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    losses = df.groupBy(*keys).agg(F.round(F.avg("is_loss") * 100, 6).alias("pct_loss"))
    return counts.join(losses, keys, "inner")


_VISITS = """freq AS (SELECT patient_id, CASE WHEN count(*) <= 1 THEN '1 appt' WHEN count(*) <= 5 THEN '2-5 appts'
               WHEN count(*) <= 10 THEN '6-10 appts' ELSE '10+ appts' END AS freq_bucket FROM appointments GROUP BY 1)"""


@query(f"""WITH {APPOINTMENTS}, {_VISITS} SELECT freq_bucket, count(*) AS n, round(avg(noshow_flag), 6) AS rate
           FROM appointments LEFT JOIN freq USING (patient_id) GROUP BY 1""")
def j2_left_frequency(t):
    df = appointments(t)
    # the frequency table is one row per patient, so a patient with very many visits is only split
    # on the visit side, which adaptive skew handling may cut freely
    visits = df.groupBy("patient_id").agg(F.count("*").alias("k"))
    labels = ["1 appt", "2-5 appts", "6-10 appts", "10+ appts"]
    freq = visits.select("patient_id", cut(F.col("k"), [0, 1, 5, 10, 2**62], labels).alias("freq_bucket"))
    joined = df.select("patient_id", "noshow_flag").join(freq, "patient_id", "left")
    return rounded(joined.groupBy("freq_bucket").agg(F.count("*").alias("n"), F.avg("noshow_flag").alias("rate")), 6, "rate")


@query("""SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 1""")
def j3_lookup_drop_misses(t):
    lookup = t.nation.where("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return topk.map_groups(t.customer.select("c_custkey", "c_nationkey"), lookup, "c_nationkey").drop("c_nationkey")


@query("""WITH top AS (SELECT o_custkey FROM orders GROUP BY 1 ORDER BY count(*) DESC, o_custkey LIMIT 30)
          SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM top)""")
def j4_semi_top_keys(t):
    return topk.only_top_keys(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", 30)


@query(f"""WITH {SALES_LINES}, {SALES_REASON} SELECT o_orderkey FROM orders
           WHERE o_orderkey NOT IN (SELECT order_id FROM tagged WHERE reason IS NOT NULL)""")
def j5_anti_dirty_ids(t):
    dirty = split(sales_lines(t), all_reasons(sales_rules())).dirty.select(F.col("order_id").alias("o_orderkey"))
    return t.orders.select("o_orderkey").join(dirty.distinct(), "o_orderkey", "left_anti")


@query("""SELECT o_orderkey, round(o_totalprice / (SELECT sum(o_totalprice) FROM orders) * 100, 9) AS share_pct,
                 CAST(date_diff('day', o_orderdate, (SELECT max(o_orderdate) FROM orders)) AS INTEGER) AS age_days FROM orders""")
def j6_scalar_to_rows(t):
    total = t.orders.agg(F.sum("o_totalprice")).scalar()
    newest = t.orders.agg(F.max("o_orderdate")).scalar()
    return t.orders.select(
        "o_orderkey", F.round(F.col("o_totalprice") / total * 100, 9).alias("share_pct"),
        F.datediff(newest, "o_orderdate").alias("age_days"),
    )


@query("SELECT o_orderkey, o_totalprice, o_orderdate FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def t1_sort(t):
    return t.orders.select("o_orderkey", "o_totalprice", "o_orderdate").orderBy(F.desc("o_totalprice"), "o_orderkey")


@query("""SELECT c_name, round(sum(o_totalprice), 2) AS revenue_sum, count(*) AS order_count
          FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def t2_top_customers(t):
    # sum per key first: the join then meets one row per customer
    sums = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("r"), F.count("*").alias("k"))
    named = sums.join(t.customer.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
    groups = named.groupBy("c_name").agg(
        F.round(F.sum("r"), 2).alias("revenue_sum"), F.sum("k").alias("order_count"))
    return topk.top(groups, "revenue_sum", "c_name", 10)


@query("""WITH g AS (SELECT l_partkey, round(sum(l_extendedprice), 2) AS revenue FROM lineitem GROUP BY 1)
          SELECT * FROM (SELECT l_partkey, revenue, 'top' AS side FROM g ORDER BY revenue DESC, l_partkey LIMIT 10)
          UNION ALL SELECT * FROM (SELECT l_partkey, revenue, 'bottom' FROM g ORDER BY revenue, l_partkey LIMIT 10)""")
def t3_top_and_bottom(t):
    groups = t.lineitem.groupBy("l_partkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("revenue"))
    return topk.top_and_bottom(groups, "revenue", "l_partkey", 10)


@query("""WITH g AS (SELECT o_custkey, round(sum(o_totalprice), 2) AS revenue FROM orders GROUP BY 1),
          r AS (SELECT *, row_number() OVER (ORDER BY revenue, o_custkey) AS position, count(*) OVER () AS n FROM g)
          SELECT o_custkey, revenue, position, CASE WHEN position <= 3 THEN 'lowest' WHEN position > n - 3 THEN 'highest' END AS mark FROM r""")
def t4_ranking_with_ends(t):
    groups = t.orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("revenue"))
    return topk.ranking_with_ends(groups, "revenue", "o_custkey", 3)


@query("""WITH o(position, event_type) AS (VALUES (0, 'signup'), (1, 'view'), (2, 'refund'), (3, 'purchase')),
          g AS (SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean_value FROM events GROUP BY 1)
          SELECT CAST(position AS INTEGER) AS position, event_type, n, mean_value FROM o LEFT JOIN g USING (event_type)""")
def t5_category_order(t):
    groups = t.events.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean_value"))
    return topk.in_order(groups, "event_type", ["signup", "view", "refund", "purchase"])


@query("""SELECT l_returnflag, count(*) AS n, round(quantile_cont(l_extendedprice, 0.5), 4) AS median FROM lineitem GROUP BY 1
          ORDER BY median, l_returnflag""")
def t6_groups_by_median(t):
    return rounded(topk.by_median(t.lineitem, "l_returnflag", "l_extendedprice"), 4, "median")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def t7_preview(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(5)


@query()
def t8_hash_sample(t):
    """No SQL twin: membership follows Spark's seeded hash."""
    return topk.hash_sample(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 3000)


@query("""SELECT least(3000, count(*)) AS rows_drawn, least(3000, count(*)) AS different_members, least(3000, count(*)) AS drawn_again FROM orders""")
def t8_sample_contract(t):
    """What SQL can state of the sample: its size, that all are different rows of the table, and that a second draw is the same."""
    orders = t.orders.select("o_orderkey", "o_totalprice")
    one = topk.hash_sample(orders, ["o_orderkey"], 3000)
    again = topk.hash_sample(orders.repartition(5), ["o_orderkey"], 3000).withColumn("again", F.lit(1))
    known = orders.withColumn("member", F.lit(1))
    both = one.join(known, ["o_orderkey", "o_totalprice"], "left").join(again, ["o_orderkey", "o_totalprice"], "left")
    return both.agg(
        F.count("*").alias("rows_drawn"), F.count_distinct(F.when(F.col("member") == 1, F.col("o_orderkey"))).alias("different_members"),
        F.count("again").alias("drawn_again"))


@query("""SELECT s_suppkey AS key, s_acctbal AS balance, s_name AS supplier, NULL AS customer FROM supplier
          UNION ALL SELECT c_custkey, c_acctbal, NULL, c_name FROM customer""")
def u1_union_by_name(t):
    s = t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"), F.col("s_name").alias("supplier"))
    c = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("customer"), F.col("c_acctbal").alias("balance"))
    return reshape.stack_tables(s, c)


@query(f"""WITH {SALES_ORDERS}, s AS (SELECT status, count(*) AS order_count, round(sum(revenue), 2) AS revenue_sum FROM sales_orders GROUP BY 1),
           r AS (SELECT region, count(*) AS order_count, round(sum(revenue), 2) AS revenue_sum FROM sales_orders GROUP BY 1)
           SELECT 'status_breakdown' AS "table", status || ' :: ' || m AS metric_name, v AS metric_number
           FROM (SELECT status, unnest(['order_count', 'revenue_sum']) AS m, unnest([CAST(order_count AS DOUBLE), revenue_sum]) AS v FROM s)
           UNION ALL SELECT 'revenue_by_region', region || ' :: ' || m, v
           FROM (SELECT region, unnest(['order_count', 'revenue_sum']) AS m, unnest([CAST(order_count AS DOUBLE), revenue_sum]) AS v FROM r)""")
def u2_union_long_tables(t):
    df = sales_orders(t, region=True)
    measures = {"order_count": F.count("*"), "revenue_sum": F.round(F.sum("revenue"), 2)}
    tables = {"status_breakdown": "status", "revenue_by_region": "region"}
    out = [reshape.to_long(grouping.summarise(df, [key], measures), name) for name, key in tables.items()]
    return reshape.stack_tables(*out).drop("metric_value")


@query("SELECT DISTINCT p_brand, p_type FROM part ORDER BY 1, 2")
def u3_distinct_sorted(t):
    return topk.distinct_sorted(t.part, ["p_brand", "p_type"])
