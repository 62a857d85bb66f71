"""Session logs: many CSV files in, one nested record of messages per session out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import read_csv
from ..sources.writers import sessions_as_messages, write_sessions

# fixed values: the columns of a session log, in file order
LOG_COLUMNS = [
    "event_id", "session_id", "timestamp", "event_type", "turn_index", "llm_round", "model",
    "prompt_tokens", "completion_tokens", "stop_reason", "response_text_preview", "tool_use_count",
    "tool_name", "tool_use_id", "tool_args_summary", "result_preview", "is_error_result", "file_path",
    "bytes_written", "lines_written", "write_operation", "exec_type", "exec_success", "exec_exit_code",
    "exec_duration_ms", "exec_output_preview", "validation_errors", "code_preview", "web_query",
    "web_url", "web_result_count", "message_text_preview", "slash_command_name", "file_ref_count",
    "conversation_length", "error_message", "error_traceback",
]
# fixed values: the columns that hold numbers
NUMBER_COLUMNS = {
    "turn_index", "llm_round", "prompt_tokens", "completion_tokens", "tool_use_count", "bytes_written", "lines_written",
    "exec_exit_code", "exec_duration_ms", "web_result_count", "file_ref_count", "conversation_length",
}
LOG_SCHEMA = ", ".join(f"{c} {'bigint' if c in NUMBER_COLUMNS else 'string'}" for c in LOG_COLUMNS)


def read_logs(spark: SparkSession, pattern: str) -> DataFrame:
    """All session files of a glob; messages may hold line breaks."""
    return read_csv(spark, pattern, LOG_SCHEMA, expected=LOG_COLUMNS, multiline=True)


def user_messages(logs: DataFrame) -> DataFrame:
    return logs.where(F.col("event_type") == "USER_MESSAGE").select(
        "session_id", "timestamp", F.lit("user").alias("role"), F.col("message_text_preview").alias("text")
    )


def conversations(logs: DataFrame) -> DataFrame:
    """session_id, start_time, ordered messages of {timestamp, type, content}."""
    nested = sessions_as_messages(user_messages(logs), "session_id", "timestamp", "role", "text")
    return nested.withColumnRenamed("start", "start_time")


def write_conversations(logs: DataFrame, path: str) -> str:
    """The records of ``conversations`` as JSON lines; a session of any length is written message by message."""
    return write_sessions(user_messages(logs), "session_id", "timestamp", "role", "text", path, start="start_time")


def session_totals(logs: DataFrame) -> DataFrame:
    return logs.groupBy("session_id").agg(
        F.count("*").alias("events"), F.count_if(F.col("event_type") == "USER_MESSAGE").alias("messages"),
        F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("completion_tokens").alias("completion_tokens"),
        F.max("conversation_length").alias("conversation_length"),
    )
