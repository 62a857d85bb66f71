"""Shared-folder handling: where lineage is cut and where scratch output goes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A local session without the setting gets a folder of its own; a cluster session
    without it is refused, because a machine-local folder would be lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="tallyframe-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused folder name under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to reliable storage and read it from there afterwards.

    Used where two branches of one plan must see the very same rows and partition numbers,
    whichever executors are lost in between.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: for joined rows that many tables are made from."""
    folder = fresh_folder(df.sparkSession, label)
    df.write.parquet(folder)
    # the schema is given: an empty table has no file to take it from
    return df.sparkSession.read.schema(df.schema).parquet(folder)
