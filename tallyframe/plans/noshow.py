"""Medical appointments: clean, features, and the tables on missed visits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bins import cut
from ..functions.dates import days_between, parse_utc, weekday_number
from ..functions.numbers import flag
from ..operators import distribution, grouping, inference, timeline, topk
from ..operators.ordering import exact_quantiles, known, quantile_labels
from ..operators.quality import (
    Rule,
    Split,
    Tally,
    first_reason,
    require_parsed,
    split,
    unparsed,
    warn_when_nothing_dirty,
    write_split,
)
from ..session import fresh_folder
from ..sources.readers import read_csv
from ..sources.writers import raw_then_derived, write_csv, write_parquet

# fixed values: the column contract and the bins
COLUMNS = [
    "PatientId", "AppointmentID", "Gender", "ScheduledDay", "AppointmentDay", "Age", "Neighbourhood",
    "Scholarship", "Hipertension", "Diabetes", "Alcoholism", "Handcap", "SMS_received", "No-show",
]
DERIVED = [
    "scheduled_dt", "appointment_dt", "lead_days", "noshow_flag", "appointment_dow",
    "appointment_month", "handcap_binary", "age_group", "lead_bucket",
]
AGE_EDGES = [-1, 10, 20, 30, 40, 50, 60, 70, 80, 200]
AGE_LABELS = ["0-10", "11-20", "21-30", "31-40", "41-50", "51-60", "61-70", "71-80", "81+"]
LEAD_EDGES = [-1, 0, 7, 30, 90, 10000]
LEAD_LABELS = ["same-day", "1-7d", "8-30d", "31-90d", "90d+"]
CONDITIONS = ["Scholarship", "Hipertension", "Diabetes", "Alcoholism", "handcap_binary", "SMS_received"]
TEXT_COLUMNS = {"PatientId", "Gender", "ScheduledDay", "AppointmentDay", "Neighbourhood", "No-show"}
SCHEMA = ", ".join(f"`{c}` {'string' if c in TEXT_COLUMNS else 'bigint'}" for c in COLUMNS)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Patient ids stay text (they overflow a double); times stay text until parsed as UTC."""
    return read_csv(spark, path, SCHEMA, expected=COLUMNS)


TIMES = (("ScheduledDay", "scheduled_dt"), ("AppointmentDay", "appointment_dt"))


def with_times(df: DataFrame) -> DataFrame:
    """Both times in UTC and the days between them; a text that is no time becomes null."""
    parsed = df.withColumns({moment: parse_utc(F.col(raw)) for raw, moment in TIMES})
    return parsed.withColumn("lead_days", days_between(F.col("appointment_dt"), F.col("scheduled_dt")))


def parse(df: DataFrame) -> DataFrame:
    """``with_times``; raises on the first text that is no time."""
    parsed = with_times(df)
    for raw, moment in TIMES:
        require_parsed(parsed.where(F.col(raw).isNotNull()), raw, moment, "AppointmentID")
    return parsed


def rules() -> list[Rule]:
    return [
        Rule("negative age", F.col("Age") < 0),
        Rule("age > 115", F.col("Age") > 115),
        Rule("appointment before scheduled date", F.col("lead_days") < 0),
    ]


def clean(df: DataFrame) -> Split:
    parts = split(df, first_reason(rules()))
    warn_when_nothing_dirty(parts.dirty, "appointments")
    return parts


def write_clean(df: DataFrame, folder: str) -> tuple[Split, Tally]:
    """Times, rules and counts of the raw table in one scan of it; raises on a text that is no time."""
    wrong = [(raw, F.when(F.col(raw).isNotNull(), bad)) for raw, bad in (unparsed(raw, moment, "AppointmentID") for raw, moment in TIMES)]
    return write_split(with_times(df), rules(), first_reason(rules()), folder, refuse=wrong, label="appointments")


def derive(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "noshow_flag": flag(F.col("No-show") == "Yes"),
        "appointment_dow": weekday_number(F.col("appointment_dt")),
        "appointment_month": F.month("appointment_dt"),
        "handcap_binary": flag(F.col("Handcap") > 0),
        "age_group": cut(F.col("Age"), AGE_EDGES, AGE_LABELS),
        "lead_bucket": cut(F.col("lead_days"), LEAD_EDGES, LEAD_LABELS),
    })


def univariate(df: DataFrame) -> dict[str, DataFrame]:
    count = {"n": F.count("*")}
    places = grouping.summarise(df, ["Neighbourhood"], count, keep_null_keys=False)
    shares = [F.struct(F.lit(c).alias("flag"), (F.avg(c) * 100).alias("pct")).alias(c) for c in CONDITIONS]
    return {
        "age_histogram": distribution.histogram(df, "Age", 20),
        "age_density": distribution.density_curve(df, "Age"),
        "lead_histogram": distribution.histogram(df.where("lead_days <= 120"), "lead_days", 50),
        "outcome_counts": topk.in_order(
            grouping.summarise(df, ["No-show"], count), "No-show", ["No", "Yes"]),
        "condition_prevalence": df.agg(*shares).select(F.inline(F.array(*CONDITIONS))),
        "gender_counts": topk.in_order(grouping.summarise(df, ["Gender"], count), "Gender", ["F", "M"]),
        "top_neighbourhoods": topk.top(places, "n", "Neighbourhood", 20),
        "weekday_counts": grouping.summarise(df, ["appointment_dow"], count).orderBy("appointment_dow"),
        "daily_counts": timeline.resample(df, "appointment_dt", "day", {"n": F.count("AppointmentID")}, ["n"]),
    }


def rate(df: DataFrame, column: str) -> DataFrame:
    return grouping.rate_by(df, [column], F.col("noshow_flag"))


def bivariate(df: DataFrame) -> dict[str, DataFrame]:
    places = topk.only_top_keys(df, "Neighbourhood", 30)
    place_rates = grouping.summarise(places, ["Neighbourhood"], {"rate": F.avg("noshow_flag")})
    return {
        "rate_by_gender": topk.in_order(rate(df, "Gender"), "Gender", ["F", "M"]),
        "rate_by_age_group": topk.in_order(rate(df, "age_group"), "age_group", AGE_LABELS),
        "rate_by_lead_bucket": topk.in_order(rate(df, "lead_bucket"), "lead_bucket", LEAD_LABELS),
        "rate_by_sms": rate(df, "SMS_received"),
        "rate_by_condition": grouping.rate_by_flags(df, CONDITIONS, "noshow_flag"),
        "rate_by_weekday": rate(df, "appointment_dow"),
        "rate_by_neighbourhood": timeline.min_max_scaled(place_rates, "rate"),
        "rate_by_month": rate(df, "appointment_month"),
        "rate_by_prior": topk.in_order(
            timeline.rate_by_prior(df, "PatientId", "appointment_dt", "AppointmentID", "noshow_flag"),
            "prior_bucket", timeline.PRIOR_LABELS),
        "correlation": inference.correlation_matrix(df, ["Age", "lead_days", *CONDITIONS, "noshow_flag"]),
    }


def visit_buckets(df: DataFrame) -> DataFrame:
    """Each patient's bucket of visits."""
    counts = df.groupBy("PatientId").agg(F.count("*").alias("_k"))
    labels = ["1 appt", "2-5 appts", "6-10 appts", "10+ appts"]
    return counts.select("PatientId", cut(F.col("_k"), [0, 1, 5, 10, 2**62], labels).alias("freq_bucket"))


def volume_terciles(df: DataFrame) -> DataFrame:
    """Missed-visit rate by volume tercile of the neighbourhood and by scholarship."""
    volumes = known(df, "Neighbourhood").groupBy("Neighbourhood").agg(F.count("*").alias("_v"))
    labels = ["Low Volume", "Medium Volume", "High Volume"]
    lookup = quantile_labels(volumes, "_v", labels, "nb_tercile").drop("_v")
    joined = topk.map_groups(df, lookup, "Neighbourhood")
    wide = grouping.pivot_mean(joined, "nb_tercile", "Scholarship", "noshow_flag", [0, 1])
    return topk.in_order(wide.toDF("nb_tercile", "no_scholarship", "scholarship"), "nb_tercile", labels)


def multivariate(df: DataFrame) -> dict[str, DataFrame]:
    sms = grouping.pivot_mean(df, "lead_bucket", "SMS_received", "noshow_flag", [0, 1])
    ages = grouping.pivot_mean(df, "age_group", "Hipertension", "noshow_flag", [0, 1])
    places = grouping.summarise(df, ["Neighbourhood"], {"rate": F.avg("noshow_flag")}, keep_null_keys=False)
    compared = {c: F.col(c) * 100 for c in ("noshow_flag", "Scholarship", "Hipertension", "Diabetes", "SMS_received")}
    weeks = timeline.resample(df, "appointment_dt", "week", {
        "rate": F.avg("noshow_flag") * 100, "volume": F.count("AppointmentID")}, ["volume"])
    visits = df.join(visit_buckets(df), "PatientId", "left")
    return {
        "sms_by_lead": topk.in_order(sms.toDF("lead_bucket", "no_sms", "sms"), "lead_bucket", LEAD_LABELS),
        "age_by_hypertension": topk.in_order(ages.toDF("age_group", "without", "with"), "age_group", AGE_LABELS),
        "neighbourhood_ranking": topk.ranking_with_ends(places, "rate", "Neighbourhood", 3),
        "neighbourhood_gini": grouping.gini(places, "rate"),
        "same_day_profile": grouping.compare_populations(df, F.col("lead_days") == 0, compared),
        "same_day_ages": distribution.density_histogram(
            df.withColumn("same_day", F.col("lead_days") == 0), "Age", "same_day", 20),
        "scholarship_by_volume": volume_terciles(df),
        "visits_per_patient": distribution.clipped_counts(df, "PatientId", 1, 21),
        "rate_by_visits": visits.groupBy("freq_bucket").agg(F.avg("noshow_flag").alias("rate")),
        "weekly": weeks,
        "unusual_weeks": timeline.unusual_periods(weeks, "rate"),
    }


def summary(df: DataFrame, min_visits: int = 50) -> DataFrame:
    """The report's metrics as text rows, in report order."""
    missed = F.col("noshow_flag")
    pct = lambda c: F.when(c.isNotNull(), F.format_string("%.2f", c * 100))
    on = lambda column, value: F.avg(F.when(F.col(column) == value, missed))
    middle = exact_quantiles(df, "lead_days", {"m": 0.5}, distinct=False).select("m").scalar()
    patients = known(df.select("PatientId"), "PatientId").distinct().select(F.count("*")).scalar()
    place = F.col("Neighbourhood").cast("string")
    text = F.concat(place, F.lit(" ("), F.format_string("%.1f", F.col("rate") * 100), F.lit("%)"))
    enough = F.col("rated") >= min_visits
    # one row per neighbourhood; the three names come out of one aggregate over them
    places = known(df, "Neighbourhood").groupBy("Neighbourhood").agg(
        F.count("*").alias("visits"), F.count(missed).alias("rated"), F.avg(missed).alias("rate"),
    ).agg(F.struct(
        F.min_by(place, F.struct(-F.col("visits"), "Neighbourhood")).alias("commonest"),
        F.min_by(text, F.when(enough, F.struct(-F.col("rate"), F.col("Neighbourhood")))).alias("highest"),
        F.min_by(text, F.when(enough, F.struct("rate", "Neighbourhood"))).alias("lowest"),
    ).alias("p")).scalar()
    row = df.agg(
        F.count("*").cast("string").alias("n"), pct(F.avg(missed)).alias("overall"),
        *[pct(on("Gender", g)).alias(f"gender_{g}") for g in ("F", "M")],
        *[pct(on("lead_bucket", b)).alias(f"lead_{i}") for i, b in enumerate(LEAD_LABELS)],
        *[pct(on("SMS_received", s)).alias(f"sms_{s}") for s in (0, 1)],
        F.format_string("%.1f", F.avg("lead_days")).alias("mean_lead"),
    )
    metrics = [
        ("Total appointments (after cleaning)", F.col("n")),
        ("Total unique patients", patients.cast("string")),
        ("Overall no-show rate (%)", F.col("overall")),
        *[(f"No-show rate — Gender {g} (%)", F.col(f"gender_{g}")) for g in ("F", "M")],
        *[(f"No-show rate — Lead bucket {b} (%)", F.col(f"lead_{i}")) for i, b in enumerate(LEAD_LABELS)],
        ("No-show rate — No SMS (%)", F.col("sms_0")),
        ("No-show rate — SMS received (%)", F.col("sms_1")),
        ("Mean lead_days", F.col("mean_lead")),
        ("Median lead_days", F.format_string("%.0f", F.bround(middle, 0))),
        ("Most common neighbourhood", places["commonest"]),
        (f"Neighbourhood with highest no-show rate (min {min_visits} appts)", places["highest"]),
        (f"Neighbourhood with lowest no-show rate (min {min_visits} appts)", places["lowest"]),
    ]
    cells = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(m).alias("metric"), v.alias("value"))
        for i, (m, v) in enumerate(metrics)
    ])
    # a bucket without rows has no rate and no line
    return row.select(F.inline(cells)).where("value is not null")


def run(spark: SparkSession, path: str, out: str) -> dict[str, str]:
    """CSV in, scanned once; dirty rows, clean rows (also as Parquet, which the summary reads) and the summary out."""
    parts, _ = write_clean(read(spark, path), fresh_folder(spark, "appointments"))
    typed = write_parquet(raw_then_derived(derive(parts.clean), COLUMNS, DERIVED), f"{out}/clean_parquet")
    kept = spark.read.parquet(typed)
    return {
        "dirty": write_csv(parts.dirty, f"{out}/dirty", columns=[*COLUMNS, "reason"]),
        "clean": write_csv(kept, f"{out}/clean"), "typed": typed,
        "summary": write_csv(summary(kept).orderBy("position").drop("position"), f"{out}/summary_stats"),
    }
