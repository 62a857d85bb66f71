"""Clean/dirty splits. Dirty rows are removed, never fixed, and keep the reason."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordering import join_null_safe

SEPARATOR = "; "


@dataclass(frozen=True)
class Rule:
    """A reason (text or text expression) and the condition under which a row fails."""

    reason: str | Column
    fails: Column

    def label(self) -> Column:
        return F.lit(self.reason) if isinstance(self.reason, str) else self.reason

    def hit(self) -> Column:
        """An unknown comparison is not a failure."""
        return F.coalesce(self.fails, F.lit(False))


class Split(NamedTuple):
    clean: DataFrame
    dirty: DataFrame


def all_reasons(rules: Sequence[Rule]) -> Column:
    """Every failed rule in order, joined by '; '; null for a clean row."""
    hits = F.array_compact(F.array(*[F.when(r.hit(), r.label()) for r in rules]))
    return F.when(F.size(hits) > 0, F.array_join(hits, SEPARATOR))


def first_reason(rules: Sequence[Rule]) -> Column:
    """The first failed rule only; null for a clean row."""
    return F.coalesce(*[F.when(r.hit(), r.label()) for r in rules])


def split(df: DataFrame, reason: Column) -> Split:
    """Two filters over one tagged plan; nothing is joined back."""
    tagged = df.withColumn("reason", reason)
    return Split(
        tagged.where(F.col("reason").isNull()).drop("reason"), tagged.where(F.col("reason").isNotNull())
    )


@dataclass(frozen=True)
class Tally:
    """What was counted on a tagged table as it was written."""

    rows: int
    dirty: int
    #: rows that fail each rule, in the order of the rules; a row may fail several
    by_rule: list[int]

    @property
    def pass_rate_pct(self) -> float:
        return round((1 - self.dirty / self.rows) * 100, 1) if self.rows else 100.0


def unparsed(raw: str, parsed: str, key: str, shown: str | None = None) -> tuple[str, Column]:
    """For ``write_split``: a text ``raw`` that has no value in ``parsed``, named by its row's key."""
    return shown or raw, F.when(F.col(parsed).isNull(), F.struct(F.col(key).cast("string"), F.col(raw).cast("string")))


def write_split(
    df: DataFrame, rules: Sequence[Rule], reason: Column, folder: str, checks: Sequence[Rule] = (),
    refuse: Sequence[tuple[str, Column]] = (), drop: Sequence[str] = (), label: str = "table",
) -> tuple[Split, Tally]:
    """Tag, check and write ``df`` in one scan; split and counts are read back from ``folder``, which must be new.

    What each rule says is written beside the rows as flags, so the counts read a few bits a row of the written
    files, and a lost task cannot count twice. (Observed metrics would save that too, but a session that has used
    them cannot serialise Spark ML models any more.) ``refuse`` names texts that cannot be parsed (``unparsed``): the
    least of them raises a ValueError. ``checks`` are what no clean row may break: an AssertionError tells how many
    do. Both come after the write, whose folder is then left behind. A warning is given when nothing is dirty.
    ``drop`` columns are not written. Rules that need figures of the whole table (a z-score) read it once more.
    """
    hits = {f"_hit{i}": r.hit() for i, r in enumerate(rules)}
    broken = {f"_broken{i}": r.hit() for i, r in enumerate(checks)}
    wrong = {f"_wrong{i}": c for i, (_, c) in enumerate(refuse)}
    tagged = df.withColumn("reason", reason).withColumns({"_dirty": F.col("reason").isNotNull(), **hits, **broken, **wrong})
    clean = ~F.col("_dirty")
    written = tagged.drop(*drop)
    written.write.partitionBy("_dirty").parquet(folder)
    # the schema is given: an empty table has no file to take it from
    back = df.sparkSession.read.schema(written.schema).parquet(folder)
    got = back.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.count_if("_dirty"), F.lit(0)).alias("dirty"),
        *[F.count_if(h).alias(h) for h in hits], *[F.count_if(F.col(b) & clean).alias(b) for b in broken],
        *[F.min(w).alias(w) for w in wrong],
    ).first()
    for i, (raw, _) in enumerate(refuse):
        if got[f"_wrong{i}"] is not None:
            raise ValueError(f"cannot parse {raw} in row {got[f'_wrong{i}'][0]}: {got[f'_wrong{i}'][1]!r}")
    failed = [f"{got[f'_broken{i}']} row(s): {r.reason}" for i, r in enumerate(checks) if got[f"_broken{i}"]]
    if failed:
        raise AssertionError("; ".join(failed))
    if not got["dirty"]:
        warnings.warn(f"{label}: no dirty row found, check the rules", stacklevel=2)
    helpers = ["_dirty", *hits, *broken, *wrong]
    parts = Split(back.where(clean).drop("reason", *helpers), back.where("_dirty").drop(*helpers))
    return parts, Tally(got["rows"], got["dirty"], [got[h] for h in hits])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def total_mismatch(total: Column, quantity: Column, price: Column, discount_pct: Column) -> Column:
    return F.abs(total - quantity * price * (1 - discount_pct / 100)) > 0.01


def beyond_population_z(df: DataFrame, column: str, limit: float = 3.0) -> Column:
    """abs(z) > limit over the raw column, population deviation; moments come as one scalar."""
    moments = df.agg(
        F.struct(F.avg(column).alias("mean"), F.stddev_pop(column).alias("deviation")).alias("m")
    ).scalar()
    return F.abs(F.try_divide(F.col(column) - moments["mean"], moments["deviation"])) > limit


def sigma_rules(df: DataFrame, columns: Sequence[str] | None = None, sigmas: float = 3.0) -> list[Rule]:
    """abs(value - mean) > sigmas * sample deviation, for each numeric column, from one aggregate."""
    columns = list(columns or numeric_columns(df))
    parts = []
    for i, c in enumerate(columns):
        parts += [F.avg(c).alias(f"mean{i}"), F.stddev_samp(c).alias(f"dev{i}")]
    moments = df.agg(F.struct(*parts).alias("m")).scalar()
    rules = []
    for i, c in enumerate(columns):
        mean, dev = moments[f"mean{i}"], moments[f"dev{i}"]
        reason = F.concat(F.lit(f"anomalous value in '{c}' ("), F.col(c).cast("string"), F.lit(")"))
        rules.append(Rule(reason, (dev > 0) & (F.abs(F.col(c) - mean) > sigmas * dev)))
    return rules


def flag_repeats(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    order_by: Sequence[str] = (),
    name: str = "is_repeat",
) -> DataFrame:
    """True on every row but the first per key (null keys meet); whole rows by default.

    Exact copies are counted before the shuffle and written out again at the end. The first row of a key is
    the least by ``order_by``, then by the other columns: a minimum, combined before the shuffle, so a hot
    key fills no task; the join back to it is split by adaptive execution.
    """
    counts = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    if keys is None or set(keys) == set(df.columns):
        return expand_copies(counts.withColumn("_later", F.lit(False)), df.columns, name)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    place = F.struct(*[F.col(c) for c in [*order_by, *rest]])
    firsts = counts.groupBy(*keys).agg(F.min(place).alias("_first"))
    marked = join_null_safe(counts, firsts, keys).withColumn("_later", ~place.eqNullSafe(F.col("_first")))
    return expand_copies(marked, df.columns, name)


def expand_copies(marked: DataFrame, columns: Sequence[str], name: str, chunk: int = 100_000) -> DataFrame:
    """Rows with a ``_copies`` count as that many rows again, all but the first flagged.

    Every row is cut into pieces of at most ``chunk`` copies; the pieces are dealt over tasks and written out there.
    """
    last = F.floor((F.col("_copies") - 1) / chunk)
    pieces = marked.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    low = F.col("_piece") * chunk + 1
    nth = F.explode(F.sequence(low, F.least(low + (chunk - 1), F.col("_copies"))))
    rows = pieces.repartition("_piece", *columns).withColumn("_nth", nth)
    return rows.select(*columns, (F.col("_later") | (F.col("_nth") > 1)).alias(name))


def nan_as_missing(df: DataFrame) -> DataFrame:
    """NaN in a floating column is a missing value, as it is in the tables' files."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def audit_any_table(df: DataFrame) -> DataFrame:
    """Rules made from the schema: repeated row, missing values (NaN is one), 3-sigma values. Adds ``reason``."""
    df = nan_as_missing(df)
    flagged = flag_repeats(df, df.columns, name="_repeat")
    rules = [Rule("duplicate row", F.col("_repeat"))]
    rules += [Rule(f"missing value in '{c}'", F.col(c).isNull()) for c in df.columns]
    rules += sigma_rules(df)
    return flagged.withColumn("reason", all_reasons(rules)).drop("_repeat")


def reason_counts(dirty: DataFrame, reason: str = "reason") -> DataFrame:
    return (
        dirty.where(F.col(reason).isNotNull()).groupBy(reason).agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), reason)
    )


def issue_counts(dirty: DataFrame, reason: str = "reason") -> DataFrame:
    """Split joined reasons and count them by kind."""
    part = F.col("part")
    kind = part
    for prefix, label in (
        ("duplicate", "duplicate row"), ("anomalous", "anomalous value"), ("missing", "missing value")
    ):
        kind = F.when(F.startswith(part, F.lit(prefix)), F.lit(label)).otherwise(kind)
    return (
        dirty.select(F.explode(F.split(F.col(reason), SEPARATOR)).alias("part"))
        .groupBy(kind.alias("issue")).agg(F.count("*").alias("n"))
    )


def pass_rate(tagged: DataFrame, reason: str = "reason") -> DataFrame:
    """Rows, dirty rows and the share of clean rows in percent (one decimal, half to even)."""
    dirty = F.count_if(F.col(reason).isNotNull())
    return tagged.agg(
        F.count("*").alias("total_rows"),
        dirty.alias("dirty_rows"),
        F.coalesce(
            F.bround((1 - F.try_divide(dirty, F.count("*"))) * 100, 1), F.lit(100.0)
        ).alias("pass_rate_pct"),
    )


def violation_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with the number of rows that break it, from one aggregate."""
    counts = df.agg(*[F.count_if(r.hit()).alias(f"v{i}") for i, r in enumerate(rules)])
    pairs = F.array(*[
        F.struct(r.label().alias("check"), F.col(f"v{i}").alias("violations"))
        for i, r in enumerate(rules)
    ])
    return counts.select(F.inline(pairs))


def ensure_clean(df: DataFrame, rules: Sequence[Rule]) -> None:
    """Raise when any post-clean check is broken."""
    broken = violation_counts(df, rules).where("violations > 0").collect()
    if broken:
        raise AssertionError("; ".join(f"{r['violations']} row(s): {r['check']}" for r in broken))


def warn_when_nothing_dirty(dirty: DataFrame, label: str) -> bool:
    """Zero dirty rows usually means the rules did not run as meant."""
    empty = dirty.isEmpty()
    if empty:
        warnings.warn(f"{label}: no dirty row found, check the rules", stacklevel=2)
    return empty


def require_parsed(df: DataFrame, raw: str, parsed: str, key: str) -> None:
    """Raise, naming one row, when a non-parsable text is left."""
    bad = df.where(F.col(parsed).isNull()).select(key, raw).orderBy(key).first()
    if bad is not None:
        raise ValueError(f"cannot parse {raw} in row {bad[0]}: {bad[1]!r}")
