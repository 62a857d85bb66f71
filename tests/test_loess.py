"""The decomposition by local regression against plain loops over least squares."""

import datetime as dt

import numpy as np
import pytest

from tallyframe.operators import timeline
from tallyframe.plans import retail


def line_at(values, span, place, trust):
    n = len(values)
    near = sorted(range(n), key=lambda i: (abs(i - place), i))
    if n > span:  # the window is a run of neighbours, shifted inwards at the ends
        first = min(max(int(np.floor(place)) - (span - 1) // 2, 0), n - span)
        near = range(first, first + span)
    reach = max(abs(i - place) for i in near) + max(0, span - n) // 2
    weight = [trust[i] * max(0.0, 1 - (abs(i - place) / reach) ** 3) ** 3 for i in near]
    if sum(weight) == 0:
        return values[min(max(int(round(place)), 0), n - 1)]
    root = np.sqrt(weight)
    table = np.array([[1.0, i - place] for i in near]) * root[:, None]
    centre = np.average(list(near), weights=weight)
    if np.average([(i - centre) ** 2 for i in near], weights=weight) <= 1e-6 * (n - 1) ** 2:
        return float(np.average([values[i] for i in near], weights=weight))
    return float(np.linalg.lstsq(table, np.array([values[i] for i in near]) * root, rcond=None)[0][0])


def plain(values, cycle, rounds, passes, span=7):
    n, odd = len(values), lambda x: int(np.ceil(x)) + 1 - int(np.ceil(x)) % 2
    trend, season, trust = [0.0] * n, [0.0] * n, [1.0] * n
    for turn in range(rounds + 1):
        for _ in range(passes):
            wide = [0.0] * (n + 2 * cycle)
            for k in range(cycle):
                at = list(range(k, n, cycle))
                for j in range(-1, len(at) + 1):
                    wide[k + (j + 1) * cycle] = line_at([values[i] - trend[i] for i in at], span, j, [trust[i] for i in at])
            low = wide
            for width in (cycle, cycle, 3):
                low = [sum(low[i:i + width]) / width for i in range(len(low) - width + 1)]
            season = [wide[i + cycle] - line_at(low, odd(cycle + 1), i, [1.0] * n) for i in range(n)]
            trend = [line_at([values[j] - season[j] for j in range(n)], odd(1.5 * cycle / (1 - 1.5 / span)), i, trust) for i in range(n)]
        if turn < rounds:
            off = [abs(values[i] - season[i] - trend[i]) for i in range(n)]
            bound = 6 * float(np.median(off))
            trust = [max(0.0, 1 - (o / bound) ** 2) ** 2 if bound else 1.0 for o in off]
    return season, trend


def series_of(key, n, cycle, rng):
    noise = rng.normal(0, 1, n)
    noise[rng.integers(n)] += 40  # one wild value
    return [(key, dt.date(2000 + i // 12, 1 + i % 12, 1), float(0.3 * i + 5 * np.sin(2 * np.pi * i / cycle) + noise[i])) for i in range(n)]


@pytest.mark.parametrize("robust", [False, True])
def test_fifty_series_equal_plain_loops(spark, robust):
    rng = np.random.default_rng(5)
    rows = [r for k in range(50 if not robust else 6) for r in series_of(k, int(rng.integers(24, 40)), 12, rng)]
    frame = spark.createDataFrame(rows, "k int, period date, v double")
    got = timeline.decompose_loess(frame, "v", ["k"], robust=robust).orderBy("k", "period").toPandas()
    for k, own in got.groupby("k"):
        values = [r[2] for r in rows if r[0] == k]
        season, trend = plain(values, 12, *((15, 2) if robust else (0, 5)))
        np.testing.assert_allclose(own["seasonal"], season, atol=1e-7)
        np.testing.assert_allclose(own["trend"], trend, atol=1e-7)
        np.testing.assert_allclose(own["trend"] + own["seasonal"] + own["residual"], values, atol=1e-9)


def test_season_of_a_wild_series_is_found_and_edges_are_defined(spark):
    rng = np.random.default_rng(1)
    rows = [*series_of("long", 120, 12, rng), *series_of("short", 23, 12, rng), *series_of(None, 24, 12, rng)]
    rows.append(("long", dt.date(2010, 1, 1), None))
    frame = spark.createDataFrame(rows, "k string, period date, v double")
    got = timeline.decompose_loess(frame, "v", ["k"])
    assert got.count() == len(rows)
    assert got.where("k = 'short' and (trend is not null or seasonal is not null)").count() == 0
    assert got.where("k is null and trend is not null").count() == 24
    long = got.where("k = 'long'").orderBy("period").toPandas()
    assert long["observed"].iloc[-1] == 0.0
    wave = 5 * np.sin(2 * np.pi * np.arange(108) / 12)
    assert np.corrcoef(long["seasonal"][:108], wave)[0, 1] > 0.95
    assert timeline.decompose_loess(frame.limit(0), "v", ["k"]).count() == 0
    alone = timeline.decompose_loess(frame.where("k = 'long'").drop("k"), "v")
    assert alone.count() == 121
    with pytest.raises(ValueError):
        timeline.decompose_loess(frame, "v", ["k"], span=4)


def test_monthly_sales_by_region(spark):
    rows = [(r, dt.date(2000 + i // 12, 1 + i % 12, 1 + i % 27), 100.0 + i) for r in ("a", "b") for i in range(36) if (r, i) != ("a", 7)]
    sales = spark.createDataFrame(rows, "Region string, `Order Date` date, Sales double")
    got = retail.robust_seasonality(sales, ["Region"])
    assert got.count() == 72 and got.where("observed = 0").count() == 1  # the month without sales
    assert got.where("abs(observed - trend - seasonal - residual) > 1e-6").count() == 0
    assert retail.robust_seasonality(sales).count() == 36
