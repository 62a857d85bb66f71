"""Sharding by jump consistent hashing (Lamping and Veach, 2014), in column expressions only.

A key's shard depends on the key and the shard count alone: no ring, no table, nothing to broadcast.
One more shard takes its share of the keys and moves no other key. The published algorithm walks a
64-bit linear congruential generator; its wrapping product is done in 32-bit halves, because ANSI
arithmetic refuses to wrap.

Slots number the rows of a shard from 0 without gaps. No shard is gathered in one task: rows equal in
key, size and checksum are counted first, the counts are dealt to ``pieces`` buckets per shard by their
hash, numbered inside each, and moved up by the rows of the buckets before. Only that table of totals
(shards x pieces rows at most, whatever the data) is broadcast. Slots are decided by content, so a
rerun after a lost executor gives the same ones.

Edge cases: a null key is a key of its own; a null text has size 1 and checksum 0; equal keys share
a shard and get slots of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column

SHARDS = 16
PIECES = 256
#: Rows of one group of equal rows that a single task writes out.
RUN = 4096

#: Fixed value: the multiplier of the published generator.
MULTIPLIER = 2862933555777941757
_LOW = (1 << 32) - 1


def _halves(key: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(key, 32), key.bitwiseAND(F.lit(_LOW))


def _next(high: Column, low: Column) -> tuple[Column, Column]:
    """(high, low) of key * MULTIPLIER + 1 modulo 2^64, with every step below 2^63."""
    a_high, a_low = MULTIPLIER >> 32, MULTIPLIER & _LOW

    def low_half(x: Column, a: int) -> Column:  # of x * a, for x and a below 2^32
        top = (x * (a >> 16)).bitwiseAND(F.lit(0xFFFF))
        return (x * (a & 0xFFFF) + F.shiftleft(top, 16)).bitwiseAND(F.lit(_LOW))

    upper = low * (a_low >> 16)
    lower = low * (a_low & 0xFFFF) + F.shiftleft(upper.bitwiseAND(F.lit(0xFFFF)), 16) + 1
    carry = F.shiftright(upper, 16) + F.shiftright(lower, 32)
    new_high = (carry + low_half(high, a_low) + low_half(low, a_high)).bitwiseAND(F.lit(_LOW))
    return new_high, lower.bitwiseAND(F.lit(_LOW))


def jump(key: Column, shards: int) -> Column:
    """The shard (0 to shards - 1) of a 64-bit key. A key jumps at most ``shards`` times."""
    if shards < 1:
        raise ValueError("there must be at least one shard")
    high, low = _halves(key)
    start = F.struct(
        F.lit(-1).cast("bigint").alias("b"), F.lit(0).cast("bigint").alias("j"), high.alias("h"), low.alias("l")
    )

    def step(s: Column, _: Column) -> Column:
        h, low = _next(s["h"], s["l"])
        # (b + 1) * 2^31 / ((key >> 33) + 1), as in the paper
        j = F.floor((s["j"] + 1) * (F.lit(float(1 << 31)) / (F.shiftright(h, 1) + 1)))
        moved = F.struct(s["j"].alias("b"), j.cast("bigint").alias("j"), h.alias("h"), low.alias("l"))
        return F.when(s["j"] < shards, moved).otherwise(s)

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step)
    return walked["b"].cast("int")


def key_of(*columns: Column) -> Column:
    """A 64-bit key of any columns, nulls included."""
    return F.xxhash64(*columns)


def assign(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text", pieces: int = PIECES) -> DataFrame:
    """One row per row of ``docs``: the key, size, text_crc32, law, shard, slot, grown_shard."""
    slim = docs.select(
        column(docs, key).alias("key"),
        (F.coalesce(F.octet_length(column(docs, text)), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(column(docs, text), F.lit(""))).alias("text_crc32"),
    )
    equal = slim.groupBy("key", "size", "text_crc32").agg(F.count("*").alias("copies"))
    order = [F.col(c) for c in ("key", "size", "text_crc32")]
    placed = equal.select(
        "*", jump(key_of(F.col("key")), shards).alias("shard"), jump(key_of(F.col("key")), shards + 1).alias("grown_shard"),
        F.pmod(F.xxhash64(*order, F.lit("slot")), F.lit(pieces)).alias("piece"),
    )
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("shard", "piece").agg(F.sum("copies").alias("n")).select(
        "shard", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before")
    )
    within = Window.partitionBy("shard", "piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    numbered = placed.withColumn("first", F.coalesce(F.sum("copies").over(within), F.lit(0)))
    # at most shards x pieces rows, whatever the data
    firsts = numbered.join(F.broadcast(totals), ["shard", "piece"]).withColumn("first", F.col("first") + F.col("rows_before"))
    return _each_copy(firsts).select(
        F.col("key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def _each_copy(firsts: DataFrame) -> DataFrame:
    """Counted rows as rows again: groups are cut into runs, and the runs dealt to tasks before they are written out."""
    runs = firsts.withColumn("run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / RUN))))
    dealt = runs.repartition("shard", "piece", "first", "run")
    nth = F.sequence(F.col("run") * RUN, F.least((F.col("run") + 1) * RUN, F.col("copies")) - 1)
    return dealt.withColumn("nth", F.explode(nth)).withColumn("slot", F.col("first") + F.col("nth"))


def with_shard(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", name: str = "shard") -> DataFrame:
    """``docs`` with its shard as one more column, without a shuffle; a column of that name is replaced."""
    return docs.withColumn(name, jump(key_of(column(docs, key)), shards))


def write(docs: DataFrame, path: str, shards: int = SHARDS, key: str = "doc_id", files: int = 8, name: str = "shard") -> None:
    """Parquet folders by shard. Each shard is dealt to ``files`` tasks by its rows' hash, so none writes a shard alone."""
    rows = with_shard(docs, shards, key, name)
    salt = F.pmod(F.xxhash64(*[column(docs, c) for c in docs.columns]), F.lit(files))
    rows.repartition(shards * files, F.col(name), salt).write.mode("overwrite").partitionBy(name).parquet(path)
