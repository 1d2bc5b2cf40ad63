"""Profiles, distributions, rankings and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas, vocab
from ..functions import habitability
from ..sources import dims
from ..sources.wire import nan_to_null

# Rows and columns of the printed reports.
RADIATION_ROWS = 20
ORBIT_ROWS = 100
CANDIDATE_COLUMNS = [
    "name",
    "star_type",
    "distance_au",
    "avg_temp_celsius",
    "stellar_flux",
    "surface_radiation_msv_h",
    "tidally_locked",
    "in_habitable_zone",
    "planet_type",
    "label",
]
RADIATION_COLUMNS = [
    "name",
    "star_type",
    "distance_au",
    "surface_radiation_msv_h",
    "magnetic_field",
    "label",
]


def profile_counts(planets: DataFrame) -> DataFrame:
    """Planets and distinct systems in one pass."""
    return planets.agg(
        F.count("*").alias("n_planets"), F.countDistinct("system_name").alias("n_systems")
    )


def distribution(df: DataFrame, key: str) -> DataFrame:
    """Rows per value, most frequent first, ties by value."""
    return df.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key)


def cross_distribution(df: DataFrame, first: str, second: str) -> DataFrame:
    """Rows per pair of values."""
    return df.groupBy(first, second).agg(F.count("*").alias("n")).orderBy(first, second)


def system_summary(planets: DataFrame, label: str = "predicted_label") -> DataFrame:
    """Planets per system, in all and per label."""

    def having(value: str) -> Column:
        return F.count_if(F.col(label) == value)

    return (
        planets.groupBy("system_name", "star_type")
        .agg(
            F.count("*").alias("n_planets"),
            having(vocab.HABITABLE).alias("n_habitable"),
            having(vocab.UNCERTAIN).alias("n_uncertain"),
            having(vocab.NON_HABITABLE).alias("n_non_habitable"),
        )
        .orderBy("system_name", "star_type")
    )


def candidates(planets: DataFrame) -> DataFrame:
    """Planets of a type that can be habitable."""
    return planets.filter("habitable_candidate").select(*CANDIDATE_COLUMNS)


def radiation_ranking(planets: DataFrame, rows: int = RADIATION_ROWS) -> DataFrame:
    """The most irradiated planets, ties by name."""
    return (
        planets.select(*RADIATION_COLUMNS)
        .orderBy(F.desc("surface_radiation_msv_h"), "name")
        .limit(rows)
    )


def batch_result(scored: DataFrame) -> DataFrame:
    return scored.select(*schemas.BATCH_RESULT)


def batch_report(scored: DataFrame) -> DataFrame:
    return scored.select(*schemas.BATCH_REPORT)


def planets_by_orbit(scored: DataFrame, rows: int = ORBIT_ROWS) -> DataFrame:
    """The first planets by system and distance, ties by name."""
    return batch_result(scored).orderBy("system_name", "distance_au", "name").limit(rows)


def alert_counts(readings: DataFrame) -> DataFrame:
    """Readings per raised alert code; a reading without alert counts as nominal.

    All codes are counted in one pass with one row per task, instead of a row per alert.
    """
    groups = habitability.alert_groups()
    raised = nan_to_null(readings).select(*[c.alias(name) for name, (c, _) in groups.items()])
    counts = {
        code: F.count_if(F.col(name) == code)
        for name, (_, codes) in groups.items()
        for code in codes
    }
    counts[habitability.NO_ALERT] = F.count_if(F.coalesce(*groups).isNull())
    one_row = raised.agg(*[column.alias(code) for code, column in counts.items()])
    rows = F.array(
        *[F.struct(F.lit(code).alias("alert"), F.col(code).alias("n")) for code in counts]
    )
    return one_row.select(F.inline(rows)).filter("n > 0").orderBy(F.desc("n"), "alert")


def feature_moments(planets: DataFrame, features: list[str], digits: int = 6) -> DataFrame:
    """Mean and sample deviation per feature, long form, all in one pass."""
    one_row = planets.agg(
        *[F.avg(f).alias(f"mean_{f}") for f in features],
        *[F.stddev_samp(f).alias(f"std_{f}") for f in features],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(f).alias("feature"),
                F.round(F.col(f"mean_{f}"), digits).alias("mean"),
                F.round(F.col(f"std_{f}"), digits).alias("std"),
            )
            for f in features
        ]
    )
    return one_row.select(F.inline(rows))


def _sum(columns: list[Column]) -> Column:
    return sum(columns[1:], start=columns[0])


def classification_metrics(
    df: DataFrame, label: str, prediction: str, classes: list[str] | None = None
) -> DataFrame:
    """Accuracy and label-weighted precision, recall and F1 from one pass of counts.

    ``classes`` are the possible values of both columns.
    """
    classes = list(vocab.LABELS) if classes is None else classes
    actual, predicted = F.col(label), F.col(prediction)
    counts = [F.count(label).alias("n")]
    for i, value in enumerate(classes):
        counts += [
            F.count_if((actual == value) & (predicted == value)).alias(f"hit{i}"),
            F.count_if(actual == value).alias(f"actual{i}"),
            F.count_if(actual.isNotNull() & (predicted == value)).alias(f"predicted{i}"),
        ]

    def ratio(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))

    per_class = []
    for i in range(len(classes)):
        hit, n_actual, n_predicted = (F.col(f"{k}{i}") for k in ("hit", "actual", "predicted"))
        precision, recall = ratio(hit, n_predicted), ratio(hit, n_actual)
        f1 = ratio(2 * precision * recall, precision + recall)
        per_class.append([n_actual * m for m in (precision, recall, f1)])
    weighted = [ratio(_sum(list(column)), F.col("n")) for column in zip(*per_class)]
    hits = _sum([F.col(f"hit{i}") for i in range(len(classes))])
    return df.agg(*counts).select(
        F.col("n").alias("n_rows"),
        ratio(hits, F.col("n")).alias("accuracy"),
        weighted[0].alias("weighted_precision"),
        weighted[1].alias("weighted_recall"),
        weighted[2].alias("f1"),
    )


def observed_sensor_ranges(spark, readings: DataFrame) -> DataFrame:
    """Every sensor profile next to the range that the readings of its planet type show."""
    columns = list(dims.SENSORS.values())
    wide = readings.groupBy("planet_type").agg(
        *[F.min(c).alias(f"min_{c}") for c in columns],
        *[F.max(c).alias(f"max_{c}") for c in columns],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(sensor).alias("sensor"),
                F.col(f"min_{c}").alias("observed_min"),
                F.col(f"max_{c}").alias("observed_max"),
            )
            for sensor, c in dims.SENSORS.items()
        ]
    )
    observed = wide.select("planet_type", F.inline(rows))
    return dims.sensor_profiles(spark).join(observed, ["planet_type", "sensor"], "left")
