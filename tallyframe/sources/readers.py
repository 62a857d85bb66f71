"""Readers: explicit schemas, column contracts, encodings and optional inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: the encoding tried first and the one that can decode anything
ENCODINGS = ["UTF-8", "ISO-8859-1"]
BYTE_ORDER_MARK = "\ufeff"


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop)
    return found is not None and len(found) > 0


def require_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Fail before any job runs when a column of the contract is missing; extra ones pass."""
    missing = [c for c in expected if c not in df.columns]
    if missing:
        raise ValueError(f"missing expected columns: {missing}")
    return df


def require_path(spark: SparkSession, path: str) -> str:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"required input not found: {path}")
    return path


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, encoding: str = "UTF-8",
    expected: Sequence[str] = (), multiline: bool = True, date_format: str | None = None,
    timestamp_format: str | None = None,
) -> DataFrame:
    """CSV with a header.

    With a schema no pass over the data is needed: only the header is read, its names get the
    schema's types in whatever order they come, and other columns pass as text. Without one the
    types are inferred.

    With ``multiline`` (the default) quoted line breaks survive, but Spark cannot split a file: one file is one task.
    For large files known to hold no quoted line break, ``multiline=False`` lets many tasks read one file.
    """
    require_path(spark, path)
    reader = (
        spark.read.option("header", True).option("encoding", encoding).option("multiLine", multiline)
        .option("escape", "\"")
    )
    if date_format:
        reader = reader.option("dateFormat", date_format)
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format)
    if schema is None:
        return require_columns(reader.option("inferSchema", True).csv(path), expected)
    header = require_columns(reader.csv(path), expected)
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kinds = {f.name: f.dataType for f in declared.fields}
    typed = T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in header.columns])
    return reader.schema(typed).option("enforceSchema", False).csv(path)


def read_csv_any_encoding(spark: SparkSession, path: str, expected: Sequence[str] = (), multiline: bool = True) -> DataFrame:
    """UTF-8, with or without a byte order mark, else Latin-1.

    The bytes of the whole file are checked, stopping at the first invalid line. Latin-1 decodes
    every byte, so no later encoding of a fallback chain would ever be reached. ``multiline`` is as in ``read_csv``.
    """
    require_path(spark, path)
    valid = spark.read.text(path).where(~F.is_valid_utf8("value")).isEmpty()
    encoding = ENCODINGS[0] if valid else ENCODINGS[1]
    reader = spark.read.option("header", True).option("encoding", encoding).option("inferSchema", True)
    df = reader.option("escape", "\"").option("multiLine", multiline).csv(path)
    return require_columns(df.toDF(*[c.replace(BYTE_ORDER_MARK, "") for c in df.columns]), expected)


def read_parquet(spark: SparkSession, path: str, expected: Sequence[str] = ()) -> DataFrame:
    require_path(spark, path)
    return require_columns(spark.read.parquet(path), expected)


def read_optional(spark: SparkSession, path: str, schema: T.StructType | str, kind: str = "parquet", multiline: bool = True) -> DataFrame:
    """An empty table of the given schema when the file is not there. ``multiline`` (CSV) is as in ``read_csv``."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    if kind == "csv":
        return reader.option("header", True).option("escape", "\"").option("multiLine", multiline).csv(path)
    return reader.parquet(path)


def preview(df: DataFrame, rows: int = 5000) -> DataFrame:
    """The first rows only; the scan stops early."""
    return df.limit(rows)


def latest_run(df: DataFrame, run: str = "run_id") -> DataFrame:
    """Rows of the newest run of a table partitioned by run: only that partition is read."""
    return df.where(F.col(run) == df.agg(F.max(run)).scalar())


