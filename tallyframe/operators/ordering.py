"""Running sums, ranks and exact quantiles over a total order, without a single-task window.

The order is cut into slices at splitters that are drawn once and then stand in the plan as data. Which slice a row
is in follows from the row's own values, so every branch of a plan, and every task that is run again, agrees on it
by itself: nothing has to be written down first. Each slice is summed on its own, and the few slice totals are
added back.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bins import bin_from_edges
from ..session import materialise

#: Rows drawn for each slice when the splitters are chosen.
DRAWN = 32
#: Copies of one row that a task writes out at once.
COPIES = 4096


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join where null keys meet; the right copy of the keys is dropped."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    condition = [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def known(df: DataFrame, *keys: str) -> DataFrame:
    """Rows where every key is known: most groupings leave out a group for missing keys."""
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df


def _sides(df: DataFrame, order_by: Sequence[str | Column]) -> list[tuple[Column, bool]]:
    """Each sort key as a plain column and whether it descends (then nulls are last, else first)."""
    sides = []
    for item in order_by:
        said = None if isinstance(item, str) else re.fullmatch(r"Column<'(.*) (ASC|DESC) NULLS (FIRST|LAST)'>", str(item))
        if said is None:
            sides.append((F.col(item) if isinstance(item, str) else item, False))
        elif said[1] in df.columns and (said[2] == "DESC") == (said[3] == "LAST"):
            sides.append((F.col(f"`{said[1]}`"), said[2] == "DESC"))
        else:
            raise ValueError(f"order by a name, a column or F.desc(name), not {item}")
    return sides


def _before(points: Sequence[Column], keys: Sequence[tuple[Column, bool]]) -> Column:
    """Whether a splitter, given key by key, comes strictly before the row."""
    verdict = F.lit(False)
    for point, (key, down) in reversed(list(zip(points, keys, strict=True))):
        first = F.coalesce(point > key, key.isNull()) if down else F.coalesce(point < key, point.isNull())
        verdict = F.when(point.eqNullSafe(key), verdict).otherwise(first)
    return verdict


class Slices:
    """Splitters of a total order: about as many slices as the session has shuffle partitions.

    ``number`` is the slice of a row, a plain expression of its values. Where one key tuple alone fills a slice,
    a hash of the whole row is taken in as the last key. What then still fills a slice are copies of one row;
    ``is_copy`` tells them (None where there are none).
    """

    def __init__(self, df: DataFrame, keys: Sequence[tuple[Column, bool]]) -> None:
        slices = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        self.keys = list(keys)
        points, hot = self._draw(df, slices)
        if hot:
            self.keys.append((F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), False))
            points, hot = self._draw(df, slices)
        self.number = self._search(df, points)
        self.is_copy = self._among(df, hot) if hot else None

    def _draw(self, df: DataFrame, slices: int) -> tuple[list, list]:
        """The splitters in order, and those that came up twice: they fill a slice alone."""
        names = [f"k{i}" for i in range(len(self.keys))]
        drawn = df.select(*[c.alias(n) for n, (c, _) in zip(names, self.keys, strict=True)])
        drawn = drawn.orderBy(F.rand(42)).limit(DRAWN * slices)
        sides = [F.desc(n) if down else F.asc(n) for n, (_, down) in zip(names, self.keys, strict=True)]
        rows = [tuple(r) for r in drawn.orderBy(*sides).collect()]
        step = max(1, len(rows) // slices)
        points = rows[step - 1 :: step]
        hot = [a for a, b in zip(points, points[1:], strict=False) if a == b] if step > 1 else []
        return list(dict.fromkeys(points)), list(dict.fromkeys(hot))

    def _literal(self, df: DataFrame, points: list) -> Column:
        """The splitters as one constant array of records."""
        types = df.select(*[c.alias(f"k{i}") for i, (c, _) in enumerate(self.keys)]).schema.fields
        if all(t.dataType.simpleString() in ("int", "bigint", "double", "string", "boolean") for t in types):
            kind = ",".join(f"{t.name}:{t.dataType.simpleString()}" for t in types)
            rows = json.dumps([{t.name: v for t, v in zip(types, p, strict=True)} for p in points])
            return F.from_json(F.lit(rows), f"array<struct<{kind}>>")
        return F.array(*[
            F.struct(*[F.lit(v).cast(t.dataType).alias(t.name) for v, t in zip(p, types, strict=True)]) for p in points
        ])

    def _search(self, df: DataFrame, points: list) -> Column:
        """Number of splitters before the row: a binary search, one step a bit."""
        if not points:
            return F.lit(0)
        table, steps = self._literal(df, points), []
        while 1 << len(steps) <= len(points):
            steps.append(1 << len(steps))

        def step(at: Column, size: Column) -> Column:
            there = F.get(table, at + size - 1)
            fits = (at + size <= len(points)) & _before([there[f"k{i}"] for i in range(len(self.keys))], self.keys)
            return F.when(fits, at + size).otherwise(at)

        return F.aggregate(F.array(*[F.lit(s) for s in reversed(steps)]), F.lit(0), step)

    def _among(self, df: DataFrame, hot: list) -> Column:
        def same(p: Column) -> Column:
            out = F.lit(True)
            for i, (key, _) in enumerate(self.keys):
                out = out & p[f"k{i}"].eqNullSafe(key)
            return out

        return F.exists(self._literal(df, hot), same)


def running_totals(
    df: DataFrame,
    order_by: Sequence[str | Column],
    measures: Mapping[str, Column],
    by: Sequence[str] = (),
    totals: bool = False,
) -> DataFrame:
    """Add inclusive running sums, per ``by`` group or over the whole table.

    With ``totals`` each row also gets the sum of its whole group as ``<name>_total``. ``order_by`` takes names,
    columns and ``F.desc(name)``. A hot group or a hot value is spread over slices by a hash of the row; copies of
    one row that would fill a slice are counted, carried as one row, and written out again in pieces.
    ``df`` is read three times (splitters, rows, slice totals) and must give the same rows each time.
    """
    by = list(by)
    names = list(measures)
    staged = df.select("*", *[measures[n].alias(f"_in_{n}") for n in names])
    keys = [(F.col(f"`{c}`"), False) for c in by] + _sides(df, order_by)
    slices = Slices(staged, keys)
    order = [F.desc_nulls_last(c) if down else F.asc_nulls_first(c) for c, down in slices.keys[len(by):]]
    weighed = staged.withColumn("_copies", F.lit(1).cast("bigint"))
    if slices.is_copy is not None:
        counted = staged.where(slices.is_copy).groupBy(*[F.col(f"`{c}`") for c in staged.columns])
        weighed = weighed.where(~slices.is_copy).unionByName(counted.agg(F.count("*").alias("_copies")))
    sliced = weighed.withColumn("_slice", slices.number)
    group = Window.partitionBy("_slice", *by)
    inside = group.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = {n: F.col(f"_in_{n}") * F.col("_copies") if slices.is_copy is not None else F.col(f"_in_{n}") for n in names}
    ran = sliced.select("*", *[F.sum(each[n]).over(inside).alias(f"_run_{n}") for n in names])
    if totals and by:
        ran = ran.select("*", *[F.sum(each[n]).over(group).alias(f"_all_{n}") for n in names])

    per_slice = sliced.groupBy("_slice", *by).agg(*[F.sum(each[n]).alias(f"_sum_{n}") for n in names])
    whole = Window.partitionBy(*by)
    if by:
        # a slice boundary cuts at most one group, so at most two rows per slice are left here
        per_slice = per_slice.withColumn("_spans", F.count("*").over(whole)).where("_spans > 1")
    before = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    parts = [F.sum(f"_sum_{n}").over(before).alias(f"_off_{n}") for n in names]
    if totals:
        parts += [F.sum(f"_sum_{n}").over(whole).alias(f"_whole_{n}") for n in names]
    joined = join_null_safe(ran, F.broadcast(per_slice.select("_slice", *by, *parts)), ["_slice", *by], "left")
    after = {n: F.lit(0) for n in names}
    if slices.is_copy is not None:
        pieces = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_copies") - 1) / COPIES))
        # pieces of hot rows move to other tasks before they are written out
        joined = joined.withColumn("_piece", F.explode(pieces)).repartition("_slice", "_piece")
        first = F.col("_piece") * COPIES + 1
        joined = joined.withColumn("_nth", F.explode(F.sequence(first, F.least(first + COPIES - 1, F.col("_copies")))))
        after = {n: F.col(f"_in_{n}") * (F.col("_copies") - F.col("_nth")) for n in names}
    out = [(F.col(f"_run_{n}") + F.coalesce(F.col(f"_off_{n}"), F.lit(0)) - after[n]).alias(n) for n in names]
    if totals:
        out += [
            (F.coalesce(f"_whole_{n}", f"_all_{n}") if by else F.col(f"_whole_{n}")).alias(f"{n}_total")
            for n in names
        ]
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *out)


def row_ranks(
    df: DataFrame, order_by: Sequence[str | Column], by: Sequence[str] = (), name: str = "rank",
    totals: bool = False,
) -> DataFrame:
    """Row number 1..n in the given order; with ``totals`` also n as ``<name>_total``."""
    return running_totals(df, order_by, {name: F.lit(1).cast("bigint")}, by, totals)


def ranked_counts(counts: DataFrame, value: str, count: str, by: Sequence[str] = ()) -> DataFrame:
    """First, last and average rank of each value, and the group size, from values with their counts."""
    by = list(by)
    ran = running_totals(counts, [value], {"last_rank": F.col(count)}, by, totals=True)
    first = F.col("last_rank") - F.col(count) + 1
    return ran.select(
        *by, value, F.col(count).alias("n"), first.alias("first_rank"), "last_rank",
        ((first + F.col("last_rank")) / 2).alias("avg_rank"), F.col("last_rank_total").alias("group_size"),
    )


def value_ranks(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct value: how often it occurs and its first, last and average rank.

    Values are counted first, so a value that fills a third of the table is one row.
    """
    kept = df.where(F.col(value).isNotNull())
    return ranked_counts(kept.groupBy(*by, value).agg(F.count("*").alias("n")), value, "n", by)


#: Size of the quantile sketches, and the share of a column's ranks taken as margin on each side: four times the rank
#: error that the sketch's authors give at 99 %, which a sub-Gaussian error passes once in 10^32 runs. The second
#: sketch is read at CELLS even ranks.
SKETCH, MARGIN, CELLS = 4096, 0.0028, 512
#: So many groups' brackets at most are sent to every task, which then meets them without moving a row.
SENT = 10_000


def _meet(rows: DataFrame, groups: DataFrame, by: Sequence[str]) -> DataFrame:
    """``rows`` with the written row of their group. Spark does not know how few groups were written, so they are counted."""
    few = groups.limit(SENT + 1).count() <= SENT
    return join_null_safe(rows, F.broadcast(groups) if few else groups, by)


def column_quantiles(
    df: DataFrame, columns: Sequence[str], quantiles: Mapping[str, float], by: Sequence[str] = (), label: str = "column"
) -> DataFrame:
    """Exact, linearly interpolated quantiles of several columns at once: ``by..., <label>, n, <one column per name>``.

    Selection by bracketing, in three scans that need neither a sort of the values nor a row per cell. The first
    takes a mergeable sketch, which gives two values between which the wanted rank lies. The second counts what is
    below and at those two, and sketches what lies between, which narrows the bracket again. The third counts, value
    by value, only what is then left: about n / 25,000 cells of a large group, so that ordering them is cheap. A hot
    value is one counted cell. Nulls and NaN do not count; a column without values has n = 0 and null quantiles.
    The rows meet their brackets where they are read, up to ``SENT`` groups; beyond that they are dealt by group.
    A rank outside its bracket would raise an error, never give a wrong figure.
    """
    if not by:  # one group of all rows: its brackets are one row, met on a constant key
        one = column_quantiles(df.withColumn("_all", F.lit(0)), columns, quantiles, ["_all"], label).drop("_all")
        every = df.sparkSession.createDataFrame([(c,) for c in columns], f"`{label}` string")
        return every.join(one, label, "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
    points = [float(p) for p in quantiles.values()]
    names = range(len(columns))
    cells = [(f"{j}_{i}", f"_v{j}", f"_n{j}", p) for j in names for i, p in enumerate(points)]
    keys = [F.col(f"`{c}`") for c in by]

    def exprs(*texts: str) -> list[Column]:
        return [F.expr(t) for t in texts]

    def read(sketch: str, some: str, ranks: Sequence[float]) -> str:
        text = ",".join(repr(min(1.0, max(0.0, r))) for r in ranks)
        return f"CASE WHEN {some} > 0 THEN kll_sketch_get_quantile_double({sketch}, CAST(split('{text}', ',') AS array<double>)) END"

    slim = df.select(*keys, *[
        F.when(~F.isnan(v), v).alias(f"_v{j}") for j, v in enumerate(F.col(f"`{c}`").cast("double") for c in columns)
    ])
    first = slim.groupBy(*keys).agg(*exprs(*[
        t for j in names for t in (f"count(_v{j}) AS _n{j}", f"kll_sketch_agg_double(_v{j}, {SKETCH}) AS _s{j}")
    ]))
    # the ends, then a margin on both sides of each quantile
    asked = [0.0, 1.0, *[p + side for p in points for side in (-MARGIN, MARGIN)]]
    wide = first.select(*keys, *exprs(*[t for j in names for t in (f"_n{j}", read(f"_s{j}", f"_n{j}", asked) + f" AS _s{j}")]))
    # few values: a margin of ranks is less than a place, so the whole range is the bracket
    # sketches differ from run to run, so the brackets, a row per group, are written down; the rows never are
    brackets = materialise(wide.select(*keys, *exprs(*[f"_n{j}" for j in names], *[
        f"get(_s{j}, CASE WHEN _n{j} * {MARGIN} < 4 THEN {end} ELSE {2 + 2 * i + end} END) AS _{edge}{j}_{i}"
        for j in names for i in range(len(points)) for end, edge in enumerate(("lo", "hi"))
    ])))
    bracketed = _meet(slim, brackets, by)
    counts = bracketed.groupBy(*keys).agg(*exprs(*[
        t for c, v, _, _ in cells for t in (
            f"count_if({v} < _lo{c}) AS _below{c}", f"count_if({v} <= _lo{c}) AS _upto{c}",
            f"count_if({v} < _hi{c}) AS _to_hi{c}", f"count_if({v} <= _hi{c}) AS _past{c}",
        )
    ]))
    rows = ", ".join(
        f"named_struct('_cell', '{c}', 'n', {n}, '_spot', ({n} - 1) * {p}D, '_lo', _lo{c}, '_hi', _hi{c}, "
        f"'_below', _below{c}, '_upto', _upto{c}, '_in', greatest(0, _to_hi{c} - _upto{c}), '_top', _past{c} - _to_hi{c})"
        for c, _, n, p in cells
    )
    facts = join_null_safe(brackets, counts, by).select(*keys, F.expr(f"inline(array({rows}))"))

    def strictly_inside(cut: str, value: str) -> DataFrame:
        """The few cells between the edges that pass ``cut``, one row each."""
        near = {c: cut.format(v=v, c=c) for c, v, _, _ in cells}
        some = " OR ".join(f"({t})" for t in near.values())
        boxes = ", ".join(f"named_struct('_cell', '{c}', '_value', {value.format(v=v, c=c)}, '_near', {near[c]})" for c, v, _, _ in cells)
        return bracketed.where(some).select(*keys, F.expr(f"inline(filter(array({boxes}), x -> x._near))"))

    inner = "{v} > _lo{c} AND {v} < _hi{c}"
    sketched = strictly_inside(inner, "{v}").groupBy(*keys, "_cell").agg(F.expr(f"kll_sketch_agg_double(_value, {SKETCH})").alias("_s"))
    # where the places stand among the values strictly inside, and what the second sketch has around there
    placed = join_null_safe(facts, sketched, [*by, "_cell"], "left").select("*", *exprs(
        read("_s", "_in", [k / CELLS for k in range(CELLS + 1)]) + " AS _g",
        f"int(floor((try_divide(floor(_spot) - _upto - 1, _in) - {MARGIN}) * {CELLS})) AS _start",
        f"int(ceil((try_divide(ceil(_spot) - _upto + 3, _in) + {MARGIN}) * {CELLS})) AS _stop",
    )).drop("_s")
    third = placed.select(*keys, "_cell", *exprs(
        "CASE WHEN _start < 1 THEN _lo ELSE get(_g, _start) END AS _from",
        f"CASE WHEN _stop >= {CELLS} THEN _hi WHEN _stop >= 0 THEN get(_g, _stop) END AS _to",
    ))
    narrow = materialise(third.groupBy(*keys).agg(*exprs(*[
        f"max(CASE WHEN _cell = '{c}' THEN {e} END) AS {e}{c}" for c, *_ in cells for e in ("_from", "_to")
    ])))
    # up to the narrow bracket a cell is counted without its value
    bracketed = _meet(bracketed, narrow, by)
    left = strictly_inside(inner + " AND {v} <= _to{c}", "CASE WHEN {v} >= _from{c} THEN {v} END")
    left = left.groupBy(*keys, "_cell", "_value").agg(F.count("*").alias("_c"))
    upto = Window.partitionBy(*keys, "_cell").orderBy(F.asc_nulls_first("_value")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = join_null_safe(facts, left, [*by, "_cell"], "left").withColumn("_end", F.col("_upto") + F.sum("_c").over(upto))

    def at(near: str) -> str:
        """The value at the place: one of the edges, or one of those counted by value."""
        place = f"{near}(first(_spot))"
        return (
            f"CASE WHEN {place} >= first(_below) AND {place} < first(_upto) THEN first(_lo) "
            f"WHEN {place} >= first(_upto) + first(_in) AND {place} < first(_upto) + first(_in) + first(_top) THEN first(_hi) "
            f"ELSE max(CASE WHEN _end - _c <= {near}(_spot) AND _end > {near}(_spot) THEN _value END) END"
        )

    found = ranked.groupBy(*keys, "_cell").agg(*exprs(
        "first(n) AS n", "first(_spot) AS _spot", at("floor") + " AS _low", at("ceil") + " AS _high"
    ))
    quantile = """CASE WHEN n > 0 AND (_low IS NULL OR _high IS NULL) THEN CAST(raise_error('a rank lies outside its bracket') AS DOUBLE)
        ELSE _low + (_spot - floor(_spot)) * (_high - _low) END AS _q"""
    picked = found.select(*keys, "n", "_cell", F.expr(quantile))
    column = F.get(F.array(*[F.lit(c) for c in columns]), F.split_part("_cell", F.lit("_"), F.lit(1)).cast("int"))
    return picked.groupBy(*keys, column.alias(label)).agg(F.max("n").alias("n"), *[
        F.max(F.when(F.col("_cell").endswith(f"_{i}"), F.col("_q"))).alias(name) for i, name in enumerate(quantiles)
    ])


def exact_quantiles(
    df: DataFrame, value: str, quantiles: Mapping[str, float], by: Sequence[str] = (), distinct: bool = True
) -> DataFrame:
    """Exact, linearly interpolated quantiles per group: ``by..., n, distinct, <one column per name>``.

    No group is held in memory and no value is sorted but the few around each quantile, see ``column_quantiles``.
    NaN is a missing value.
    ``distinct`` needs a shuffle of all different values: leave it out where it is not asked for. Groups that have
    no values are left out; without groups there is one row, with n = 0 and nulls if there is nothing.
    """
    by = list(by)
    some = F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))
    kept = df.where(some) if by else df
    out = column_quantiles(kept, [value], quantiles, by, "_label").drop("_label")
    if not distinct:
        return out
    different = kept.where(some).groupBy(*by, value).agg(F.lit(1)).groupBy(*by).agg(F.count(value).alias("distinct"))
    if by:
        return join_null_safe(out, different, by).select(*by, "n", "distinct", *quantiles)
    return out.withColumn("distinct", different.scalar()).select("n", "distinct", *quantiles)


def quantile_labels(df: DataFrame, value: str, labels: list, name: str) -> DataFrame:
    """Label each row by its value quantile (``len(labels)`` equal shares, right-closed)."""
    q = len(labels)
    points = {f"e{k}": k / q for k in range(1, q)}
    edges = exact_quantiles(df, value, points, distinct=False).select(F.struct(*points).alias("edges")).scalar()
    return df.withColumn(name, bin_from_edges(F.col(value), [edges[e] for e in points], labels))
