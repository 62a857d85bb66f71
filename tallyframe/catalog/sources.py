"""Reading and writing: every query writes its table to a fresh shared folder and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans.sessions import LOG_COLUMNS, NUMBER_COLUMNS, read_logs, session_totals
from ..session import fresh_folder
from ..sources import readers, writers
from .registry import query

ORDERS_SCHEMA = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)


@query("SELECT * FROM orders")
def io1_csv_scan(t):
    path = writers.write_csv(t.orders, fresh_folder(t.spark, "io1"))
    return readers.read_csv(t.spark, path, ORDERS_SCHEMA, expected=["o_orderkey", "o_orderdate"])


@query("SELECT c_custkey, 'Ñ é ' || c_name AS label FROM customer")
def io2_csv_latin1(t):
    labelled = t.customer.select("c_custkey", F.concat(F.lit("Ñ é "), "c_name").alias("label"))
    path = writers.write_csv(labelled, fresh_folder(t.spark, "io2"), encoding="ISO-8859-1")
    return readers.read_csv(t.spark, path, "c_custkey bigint, label string", encoding="ISO-8859-1")


@query("""SELECT c_custkey, 'Ñ é ' || c_name AS label, 'fallback' AS kind FROM customer
          UNION ALL SELECT c_custkey, 'Ñ é ' || c_name, 'utf-8' FROM customer""")
def io3_encoding_fallback(t):
    labelled = t.customer.select("c_custkey", F.concat(F.lit("Ñ é "), "c_name").alias("label"))
    out = []
    for encoding, kind in (("ISO-8859-1", "fallback"), ("UTF-8", "utf-8")):
        path = writers.write_csv(labelled, fresh_folder(t.spark, "io3"), encoding=encoding)
        read = readers.read_csv_any_encoding(t.spark, path, ["c_custkey", "label"])
        out.append(read.select(F.col("c_custkey").cast("bigint"), "label", F.lit(kind).alias("kind")))
    return out[0].unionByName(out[1])


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def io4_csv_date_columns(t):
    text = t.orders.select("o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("o_orderdate"))
    path = writers.write_csv(text, fresh_folder(t.spark, "io4"))
    return readers.read_csv(t.spark, path, "o_orderkey bigint, o_orderdate date", date_format="dd/MM/yyyy")


@query("SELECT least(count(*), 5000) AS n_rows FROM lineitem")
def io5_limited_scan(t):
    return readers.preview(t.lineitem, 5000).agg(F.count("*").alias("n_rows"))


@query("SELECT p_partkey, p_brand, p_retailprice FROM part")
def io6_parquet_scan(t):
    return t.part.select("p_partkey", "p_brand", "p_retailprice")


@query("""SELECT 'present' AS source, count(*) AS n FROM supplier
          UNION ALL SELECT 'absent', CAST(0 AS BIGINT)""")
def io7_optional_source(t):
    schema = t.supplier.schema
    here = readers.read_optional(t.spark, t.path("supplier"), schema)
    gone = readers.read_optional(t.spark, t.path("no_such_table"), schema)
    count = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("source"), "n")
    return count(here, "present").unionByName(count(gone, "absent"))


@query("SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1")
def io8_column_contract(t):
    checked = readers.require_columns(t.lineitem, ["l_orderkey", "l_returnflag", "l_quantity"])
    return checked.groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def io9_csv_sink(t):
    path = writers.write_csv(
        t.orders, fresh_folder(t.spark, "io9"), columns=["o_orderkey", "o_totalprice", "o_orderpriority"]
    )
    return readers.read_csv(t.spark, path, "o_orderkey bigint, o_totalprice double, o_orderpriority string")


@query("SELECT l_returnflag, l_orderkey, l_quantity FROM lineitem")
def io10_parquet_sink(t):
    path = writers.write_parquet(
        t.lineitem.select("l_orderkey", "l_quantity", "l_returnflag"), fresh_folder(t.spark, "io10"),
        partition_by=["l_returnflag"],
    )
    return readers.read_parquet(t.spark, path, ["l_returnflag"])


@query("""SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m') AS month,
                 o_orderstatus = 'P' AS is_pending FROM orders""")
def io11_ordered_sink(t):
    derived = t.orders.withColumn("is_pending", F.col("o_orderstatus") == "P").withColumn(
        "month", F.date_format("o_orderdate", "yyyy-MM"))
    out = writers.raw_then_derived(derived, ["o_orderkey", "o_totalprice"], ["month", "is_pending"])
    path = writers.write_csv(out, fresh_folder(t.spark, "io11"))
    return readers.read_csv(
        t.spark, path, "o_orderkey bigint, o_totalprice double, month string, is_pending boolean"
    )


@query("""SELECT CAST(conv_id AS VARCHAR) AS session_id, count(*) AS events,
                 count(*) FILTER (WHERE role = 'user') AS messages,
                 CAST(sum(length(text)) AS BIGINT) AS prompt_tokens,
                 CAST(sum(turn) AS BIGINT) AS completion_tokens, max(turn) AS conversation_length
          FROM conversations GROUP BY conv_id""")
def io12_session_logs(t):
    given = {
        "event_id": F.concat_ws("-", "conv_id", "turn"), "session_id": F.col("conv_id").cast("string"),
        "event_type": F.when(F.col("role") == "user", "USER_MESSAGE").otherwise("OTHER"),
        "turn_index": F.col("turn"), "prompt_tokens": F.length("text").cast("bigint"),
        "completion_tokens": F.col("turn"), "message_text_preview": F.col("text"),
        "conversation_length": F.col("turn"),
    }
    kind = lambda c: "bigint" if c in NUMBER_COLUMNS else "string"
    logs = t.conversations.select(
        "role", *[given.get(c, F.lit(None)).cast(kind(c)).alias(c) for c in LOG_COLUMNS]
    )
    folder = fresh_folder(t.spark, "io12")
    for name, part in (("session_users.csv", F.col("role") == "user"), ("session_others.csv", F.col("role") != "user")):
        writers.write_csv(logs.where(part).drop("role"), f"{folder}/{name}")
    return session_totals(read_logs(t.spark, f"{folder}/session_*.csv"))


@query("""SELECT conv_id, min(turn) AS start, CAST(count(*) AS INTEGER) AS n_messages,
                 arg_min(text, turn) AS first_content, arg_max(text, turn) AS last_content
          FROM conversations GROUP BY conv_id""")
def io13_nested_messages(t):
    nested = writers.sessions_as_messages(t.conversations, "conv_id", "turn", "role", "text")
    path = writers.write_json(nested, fresh_folder(t.spark, "io13"))
    back = t.spark.read.schema(nested.schema).json(path)
    return back.select(
        "conv_id", "start", F.size("messages").alias("n_messages"),
        F.get("messages", F.lit(0))["content"].alias("first_content"),
        F.element_at("messages", -1)["content"].alias("last_content"),
    )


@query("""SELECT conv_id, min(turn) AS start, CAST(count(*) AS INTEGER) AS n_messages,
                 arg_min(text, turn) AS first_content, arg_max(text, turn) AS last_content
          FROM conversations GROUP BY conv_id""")
def io13_written_sessions(t):
    """The same records, written message by message and read back."""
    path = writers.write_sessions(t.conversations, "conv_id", "turn", "role", "text", fresh_folder(t.spark, "io13w"))
    back = t.spark.read.schema(
        "conv_id bigint, start bigint, messages array<struct<type: string, turn: bigint, content: string>>").json(path)
    return back.select(
        "conv_id", "start", F.size("messages").alias("n_messages"),
        F.get("messages", F.lit(0))["content"].alias("first_content"),
        F.element_at("messages", -1)["content"].alias("last_content"),
    )


@query("""SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS position
          FROM conversations""")
def io13_session_messages(t):
    return writers.session_messages(t.conversations, "conv_id", "turn", "role", "text")


@query("""SELECT l_returnflag, count(*) AS n FROM lineitem
          WHERE year(l_shipdate) = (SELECT max(year(l_shipdate)) FROM lineitem) GROUP BY 1""")
def io14_latest_run(t):
    runs = t.lineitem.select("l_returnflag", F.year("l_shipdate").alias("run_id"))
    path = writers.write_parquet(runs, fresh_folder(t.spark, "io14"), partition_by=["run_id"])
    return readers.latest_run(t.spark.read.parquet(path)).groupBy("l_returnflag").agg(F.count("*").alias("n"))
