"""Writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordering import row_ranks


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, encoding: str = "UTF-8") -> str:
    """CSV with a header, columns in the given order."""
    out = df.select(*columns) if columns else df
    (
        out.write.mode("overwrite").option("header", True).option("encoding", encoding)
        .option("escape", "\"").option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    return path


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def raw_then_derived(df: DataFrame, raw: Sequence[str], derived: Sequence[str]) -> DataFrame:
    """Original columns first, engineered ones after."""
    return df.select(*raw, *derived)


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def session_messages(turns: DataFrame, session: str, order: str, role: str, text: str) -> DataFrame:
    """One row per message with its position in the session, 1..n by ``order``, role and text.

    The form for sessions of any length: a long one is ranked over many tasks.
    """
    return row_ranks(turns.select(session, order, role, text), [order, role, text], [session], "position")


def sessions_as_messages(
    turns: DataFrame, session: str, order: str, role: str, text: str, page: int | None = None
) -> DataFrame:
    """session -> one record with its ordered messages.

    The record holds its whole session, as the format asks. Where sessions may outgrow a task's memory, write them with
    ``write_sessions``, take ``session_messages``, or set ``page``: every session then comes as records of at most ``page`` messages,
    numbered from 0 in an extra column ``page``.
    """
    slim, keys = turns.select(session, order, role, text), [session]
    if page is not None:
        numbered = session_messages(turns, session, order, role, text)
        slim = numbered.withColumn("page", F.floor((F.col("position") - 1) / page).cast("int"))
        keys = [session, "page"]
    message = F.struct(F.col(order), F.col(role).alias("type"), F.col(text).alias("content"))
    in_order = F.transform(
        F.array_sort(F.collect_list(message)),
        lambda m: F.struct(m["type"].alias("type"), m[order].alias(order), m["content"].alias("content")),
    )
    return slim.groupBy(*keys).agg(F.min(order).alias("start"), in_order.alias("messages"))


def write_sessions(
    turns: DataFrame, session: str, order: str, role: str, text: str, path: str, start: str = "start"
) -> str:
    """The records of ``sessions_as_messages`` as JSON lines, without ever holding a session in memory.

    Messages are sorted per session, which spills to disk, and written one after the other as pieces of one line:
    the first opens the record, the last closes it with a line break. Pieces are set apart by a blank, which JSON
    ignores between tokens. Messages of equal moments come by role and text, nulls first; a null session is a
    record without that field; fields that are null are left out; an empty table makes no record.
    """
    slim = turns.select(
        F.col(session).alias("_session"), F.col(order).alias("_order"), F.col(role).alias("_role"), F.col(text).alias("_text")
    )
    whole = Window.partitionBy("_session")
    placed = slim.select(
        "*", F.row_number().over(whole.orderBy("_order", "_role", "_text")).alias("_position"),
        F.count("*").over(whole).alias("_messages"), F.min("_order").over(whole).alias("_start"),
    )
    fields = F.to_json(F.struct(F.col("_session").alias(session), F.col("_start").alias(start)))
    opened = F.concat(F.expr("substring(_fields, 1, length(_fields) - 1)"), F.when(F.col("_fields") == "{}", "").otherwise(","), F.lit('"messages":['))
    message = F.to_json(F.struct(F.col("_role").alias("type"), F.col("_order").alias(order), F.col("_text").alias("content")))
    piece = F.concat(
        F.when(F.col("_position") == 1, opened).otherwise(","), message,
        F.when(F.col("_position") == F.col("_messages"), "]}\n").otherwise(""),
    )
    pieces = placed.withColumn("_fields", fields).select(piece.alias("value"))
    pieces.write.mode("overwrite").option("lineSep", " ").text(path)
    return path
