"""What several operators share: names that cannot clash, row identity, inputs in bounded blocks."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word contracts: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted column names, lengthened until ``df`` has none of them (case does not count)."""
    taken = {c.lower() for c in df.columns}
    names = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names.append(name)
    return names


def column(df: DataFrame, name: str) -> Column:
    """The column of that very name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_set_dir(spark: SparkSession) -> None:
    """Point ``checkpoint()`` at the shared folder the session names in ``spark.checkpoint.dir``.

    Only a local session without the setting (a test) gets a folder of its own.
    """
    from tallyframe.session import shared_folder

    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there: lineage ends, lost executors cost no rerun."""
    as_set_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: compressed, for rows in number."""
    from tallyframe.session import fresh_folder

    folder = fresh_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def blocks(df: DataFrame, size: Column, limit: int) -> Iterator[list]:
    """The rows of ``df`` in pieces whose summed ``size`` is measured first and stays near ``limit``.

    Every row is in exactly one piece, whatever the total; only the number of pieces grows with it.
    A piece is larger than the limit only where one row is. Equal rows arrive once.
    """
    sized = df.distinct().select("*", F.coalesce(size, F.lit(0)).cast("bigint").alias("_block_size"))
    total = sized.agg(F.sum("_block_size")).first()[0] or 0
    pieces = max(1, -(-2 * total // limit)) if total > limit else 1
    for k in range(pieces):
        part = F.pmod(F.xxhash64(*[column(df, c) for c in df.columns]), F.lit(pieces)) == k
        rows = (sized.where(part) if pieces > 1 else sized).drop("_block_size").collect()
        if rows or pieces == 1:
            yield rows
