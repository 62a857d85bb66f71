import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.functions import bins, dates, numbers, tails, text
from tallyframe.operators import distribution


def test_cut_is_right_closed(spark):
    edges, labels = [-1, 0, 7, 30, 90, 10000], ["same-day", "1-7d", "8-30d", "31-90d", "90d+"]
    values = [-5, -1, 0, 1, 7, 8, 30, 31, 90, 91, 10000, 10001]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = [r[0] for r in df.select(bins.cut(F.col("v"), edges, labels)).collect()]
    want = [None if isinstance(x, float) else x for x in pd.cut(values, edges, labels=labels).astype(object)]
    assert got == want


def test_equal_width_cut_follows_pandas(spark):
    values = list(np.round(np.arange(0, 0.81, 0.01), 2)) + [0.24, 0.4]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    number = bins.equal_width_bin(F.col("v"), F.lit(0.0), F.lit(0.8), 10)
    left, right = bins.equal_width_edges(number, F.lit(0.0), F.lit(0.8), 10)
    rows = df.select("v", number.alias("n"), left.alias("l"), right.alias("r"), bins.interval_label(left, right).alias("s")).collect()
    want = pd.cut(pd.Series([r["v"] for r in rows]), bins=10)
    assert [r["n"] for r in rows] == [c + 1 for c in want.cat.codes]
    assert [r["s"] for r in rows] == [str(c) for c in want]


@pytest.mark.parametrize("n", [8, 9, 10, 11, 37, 59])
def test_rank_quartile_follows_qcut(spark, n):
    df = spark.range(1, n + 1).toDF("r")
    got = [x[0] for x in df.orderBy("r").select(bins.bin_from_rank(F.col("r"), F.lit(n))).collect()]
    assert got == list(pd.qcut(np.arange(1, n + 1), 4, labels=[1, 2, 3, 4]).astype(int))


def test_histogram_bins(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 4.9, 5, 9.99, 10)], "v double")
    got = [x[0] for x in df.select(bins.histogram_bin(F.col("v"), F.lit(0.0), F.lit(10.0), 2)).collect()]
    assert got == [1, 1, 1, 2, 2, 2]


@pytest.mark.parametrize("values", [[3.0] * 5, [0.0, 1.0, 1.0, 2.5, 10.0]])
def test_histogram_follows_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r["bin"]: (r["n"], r["left_edge"]) for r in distribution.histogram(df, "v", 4).collect()}
    counts, edges = np.histogram(values, bins=4)
    assert got == {i + 1: (c, edges[i]) for i, c in enumerate(counts) if c}


@pytest.mark.parametrize("values", [[3.0] * 5, [0.0] * 4, [0.0, 1.0, 1.0, 2.5, 10.0]])
def test_mean_by_bins_follows_cut(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r["bin"]: r["n"] for r in distribution.mean_by_equal_bins(df, "v", "v").collect()}
    codes = pd.cut(pd.Series(values), bins=10).cat.codes + 1
    assert got == codes.value_counts().to_dict()


def test_mixed_dates(spark):
    raw = ["2025-03-04", "03-04-2025", "15-03-2025", "3/4/2025", "soon", None]
    df = spark.createDataFrame([(r,) for r in raw], "d string")
    got = [str(r[0]) for r in df.select(dates.parse_mixed_date(F.col("d"))).collect()]
    assert got == ["2025-03-04", "2025-03-04", "2025-03-15", "2025-03-04", "None", "None"]


def test_utc_parse_in_another_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("2016-04-29T18:38:08Z",), ("2016-04-29T18:38:08+02:00",)], "s string")
        got = [str(r[0]) for r in df.select(dates.parse_utc(F.col("s")).cast("string")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == ["2016-04-29 18:38:08", "2016-04-29 16:38:08"]


def test_week_labels_follow_pandas(spark):
    days = pd.date_range("2024-01-01", "2024-01-20")
    df = spark.createDataFrame([(d.to_pydatetime(),) for d in days], "d timestamp_ntz")
    got = [str(r[0]) for r in df.select(dates.week_ending_sunday(F.col("d"))).collect()]
    assert got == [str((d + pd.offsets.Week(weekday=6) if d.weekday() != 6 else d).date()) for d in days]


def test_small_helpers(spark):
    one = spark.range(1)
    row = one.select(
        numbers.safe_ratio(F.lit(1.0), F.lit(0.0)), numbers.half_even(F.lit(2.5)), numbers.currency(F.lit(1234.4)),
        numbers.number_from_text(F.lit("1,234.5%")), numbers.number_from_text(F.lit("n/a")),
        numbers.flag(F.lit(None).cast("boolean")), text.title_from_slug(F.lit("noshow_by_month")),
        text.recode(F.lit(1), {0: "a", 1: "b"}), *text.split_once(F.lit("a :: b :: c"), " :: "),
        text.split_once(F.lit("plain"), " :: ")[1],
    ).first()
    assert list(row) == [None, 2.0, "$1,234", 1234.5, None, 0, "Noshow By Month", "b", "a", "b :: c", None]


@pytest.mark.parametrize("x, dof, p", [
    (3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (7.814727903251179, 3, 0.05),
    (11.070497693516351, 5, 0.05), (15.507313055865453, 8, 0.05), (0.0, 4, 1.0),
])
def test_chi_square_tail(x, dof, p):
    assert tails.chi_square_tail(x, dof) == pytest.approx(p, rel=1e-9)


def test_chi_square_tail_of_a_published_figure():
    """Published to six decimals."""
    assert round(tails.chi_square_tail(28.6516, 6), 6) == 7.1e-05


@pytest.mark.parametrize("t, dof, p", [
    (12.706204736432095, 1, 0.05), (2.228138851964939, 10, 0.05), (1.9839715184496334, 100, 0.05),
    (0.0, 5, 1.0), (-2.228138851964939, 10, 0.05),
])
def test_student_tail(t, dof, p):
    assert tails.student_two_sided(t, dof) == pytest.approx(p, abs=1e-9)


def test_normal_tail():
    assert tails.normal_two_sided(1.959963984540054) == pytest.approx(0.05, abs=1e-12)


@pytest.mark.parametrize("cells, p", [((8, 2, 1, 5), 0.034965034965034975), ((3, 1, 1, 3), 0.48571428571428565),
                                      ((10, 0, 0, 10), 1.082508822446903e-05), ((0, 5, 5, 0), 0.007936507936507936)])
def test_fisher_tail(cells, p):
    assert tails.fisher_two_sided(*cells) == pytest.approx(p, rel=1e-9)


def test_fisher_tail_of_huge_counts():
    even = tails.fisher_two_sided(10**9, 10**9, 10**9, 10**9)
    assert even == pytest.approx(1.0)
    more = 10**9 + 10**5
    z = math.log(more / 10**9) / math.sqrt(1 / more + 3 / 10**9)  # log odds ratio over its error
    assert tails.fisher_two_sided(more, 10**9, 10**9, 10**9) == pytest.approx(tails.normal_two_sided(z), rel=1e-3)
