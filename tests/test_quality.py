import shutil

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import profile, quality
from tallyframe.operators.quality import Rule


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [(1, 5, -1.0), (2, 999, 2.0), (3, 999, -2.0), (4, 5, None), (5, None, 3.0)], "id int, q int, p double")



def rules():
    return [Rule("negative", F.col("p") < 0), Rule("big", F.col("q") > 50)]


def test_all_reasons_are_joined_and_unknowns_pass(rows):
    parts = quality.split(rows, quality.all_reasons(rules()))
    assert {r["id"]: r["reason"] for r in parts.dirty.collect()} == {1: "negative", 2: "big", 3: "negative; big"}
    assert {r["id"] for r in parts.clean.collect()} == {4, 5} and "reason" not in parts.clean.columns


def test_first_reason_wins(rows):
    parts = quality.split(rows, quality.first_reason(rules()))
    assert {r["id"]: r["reason"] for r in parts.dirty.collect()} == {1: "negative", 2: "big", 3: "negative"}


def test_repeats_keep_the_first_by_order_even_for_a_hot_key(spark):
    pdf = pd.DataFrame({"id": range(3000), "k": [None if i % 5 == 0 else ("hot" if i % 3 == 0 else i // 7) for i in range(3000)]})
    pdf["k"] = pdf.k.astype(object).where(pdf.k.notna(), None).map(lambda x: None if x is None else str(x))
    df = spark.createDataFrame(pdf, "id bigint, k string").repartition(9)
    out = quality.flag_repeats(df, ["k"], ["id"]).toPandas().sort_values("id")
    assert list(out.is_repeat) == list(pdf.duplicated("k"))


def test_whole_row_repeats_without_an_order(spark):
    df = spark.createDataFrame([(1, None)] * 500 + [(1, "a")] * 300 + [(2, "b")], "x int, y string").repartition(8)
    out = quality.flag_repeats(df)
    assert out.where("not is_repeat").count() == 3 and out.count() == 801
    ordered = quality.flag_repeats(df, ["x"], ["y"])
    assert ordered.where("not is_repeat").count() == 2


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(i, float("nan") if i < 2 else (1000.0 if i == 60 else 5.0 + i % 3)) for i in range(61)], "k int, v double")
    reasons = {r["k"]: r["reason"] for r in quality.audit_any_table(df).where("reason is not null").collect()}
    assert reasons == {0: "missing value in 'v'", 1: "missing value in 'v'", 60: "anomalous value in 'v' (1000.0)"}


@pytest.mark.parametrize("copies", [1, 7, 8, 9, 50])
def test_many_copies_are_written_out_in_pieces(spark, copies):
    counts = spark.createDataFrame([("a", copies), ("b", 1)], "x string, _copies bigint")
    out = quality.expand_copies(counts.withColumn("_later", F.lit(False)), ["x"], "repeat", chunk=8)
    got = {(r["x"], r["repeat"]): r["n"] for r in out.groupBy("x", "repeat").agg(F.count("*").alias("n")).collect()}
    want = {("a", False): 1, ("b", False): 1, ("a", True): copies - 1}
    assert got == {k: v for k, v in want.items() if v}


def test_constant_column_is_never_anomalous(spark):
    df = spark.createDataFrame([(i, 5.0, 1.0 if i else 1000.0) for i in range(50)], "id_no int, c double, v double")
    tagged = quality.audit_any_table(df)
    assert [r["reason"] for r in tagged.where("reason is not null").collect()] == ["anomalous value in 'v' (1000.0)"]


def test_population_z_at_exactly_the_limit_is_clean(spark):
    values = [0.0] * 9 + [10.0]  # z of the last value is exactly 3
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.where(quality.beyond_population_z(df, "v")).count() == 0
    assert df.where(quality.beyond_population_z(df, "v", 2.9)).count() == 1


def test_issue_counts_and_pass_rate(spark):
    df = spark.createDataFrame(
        [("duplicate row; missing value in 'a'",), ("anomalous value in 'b' (3.0)",), (None,), (None,)], "reason string")
    issues = {r["issue"]: r["n"] for r in quality.issue_counts(df.where("reason is not null")).collect()}
    assert issues == {"duplicate row": 1, "missing value": 1, "anomalous value": 1}
    assert tuple(quality.pass_rate(df).first()) == (4, 2, 50.0)


def test_failing_checks_raise(spark, rows):
    with pytest.raises(AssertionError, match="negative"):
        quality.ensure_clean(rows, rules())
    quality.ensure_clean(rows.where("id = 4"), rules())


def test_zero_dirty_rows_warn(rows):
    with pytest.warns(UserWarning, match="label"):
        assert quality.warn_when_nothing_dirty(rows.where("id < 0"), "label")


def test_first_bad_date_is_named(spark):
    df = spark.createDataFrame([("o1", "2025-01-01", 1), ("o2", "soon", None)], "order_id string, date string, parsed int")
    with pytest.raises(ValueError, match="o2.*soon"):
        quality.require_parsed(df, "date", "parsed", "order_id")


def test_profile_against_pandas(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, None, 4.0, 4.0], "b": ["x", None, "y", "y", "y"], "c": [1, 2, 3, 4, 5]})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, b string, c bigint")
    out = {r["column"]: r for r in profile.profile_columns(df).collect()}
    a = out["a"]
    assert (a["total_count"], a["null_count"], a["null_pct"], a["unique_count"]) == (5, 1, 20.0, 3)
    assert (a["mean"], a["p25"], a["p50"], a["p75"]) == (2.75, 1.75, 3.0, 4.0) and a["std"] == round(pdf.a.std(), 4)
    assert out["b"]["unique_count"] == 2 and out["b"]["mean"] is None and out["c"]["max"] == 5.0


def test_id_like_columns_are_left_out(spark):
    df = spark.createDataFrame([(i, i % 3, float(i)) for i in range(10)], "row_id bigint, width_id bigint, v double")
    assert profile.analysis_columns(df) == ["width_id", "v"]
    assert profile.analysis_columns(df.select("v")) == ["v"]


def test_pass_rate_rounds_half_to_even(spark):
    tagged = spark.range(16).selectExpr("if(id < 3, 'bad', null) AS reason")
    assert quality.pass_rate(tagged).first()["pass_rate_pct"] == 81.2


def test_write_split_counts_in_one_scan(spark, tmp_path):
    """The counts equal those of plain passes, and nothing reads the raw table after the write."""
    raw = str(tmp_path / "raw")
    frame = spark.range(1000).select("id", F.when(F.col("id") % 10 != 3, F.col("id") % 7).alias("v"), F.col("id").cast("string").alias("text"))
    frame.repartition(4).write.parquet(raw)
    rules = [Rule("small", F.col("v") < 2), Rule("odd", F.col("v") % 2 == 1)]
    df = spark.read.parquet(raw).withColumn("number", F.expr("try_cast(text AS int)"))
    parts, tally = quality.write_split(
        df, rules, quality.all_reasons(rules), str(tmp_path / "split"), [Rule("two", F.col("v") == 1)], [quality.unparsed("text", "number", "id")], ["text"])
    want = quality.split(df.drop("text"), quality.all_reasons(rules))
    dirty, clean = want.dirty.collect(), want.clean.collect()
    shutil.rmtree(raw)
    assert sorted(parts.dirty.collect()) == sorted(dirty) and sorted(map(str, parts.clean.collect())) == sorted(map(str, clean))
    assert (tally.rows, tally.dirty) == (1000, len(dirty)) and tally.pass_rate_pct == round(100 - len(dirty) / 10, 1)
    assert tally.by_rule == [sum(r["v"] < 2 for r in dirty), sum(r["v"] % 2 == 1 for r in dirty)]


def test_write_split_refuses(spark, tmp_path):
    df = spark.createDataFrame([(1, "7", 7), (3, "x", None), (2, "y", None)], "id int, text string, number int")
    none = [Rule("never", F.lit(False))]
    with pytest.raises(ValueError, match="cannot parse text in row 2: 'y'"):
        quality.write_split(df, none, quality.first_reason(none), str(tmp_path / "a"), refuse=[quality.unparsed("text", "number", "id")])
    with pytest.raises(AssertionError, match=r"2 row\(s\): no number"):
        quality.write_split(df, none, quality.first_reason(none), str(tmp_path / "b"), [Rule("no number", F.col("number").isNull())])
    with pytest.warns(UserWarning, match="visits: no dirty row"):
        parts, tally = quality.write_split(df.limit(0), none, quality.first_reason(none), str(tmp_path / "c"), label="visits")
    assert parts.clean.collect() == parts.dirty.collect() == [] and parts.clean.columns == df.columns
    assert (tally.rows, tally.by_rule, tally.pass_rate_pct) == (0, [0], 100.0)
