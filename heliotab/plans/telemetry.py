"""Telemetry plans: the same functions serve batch and streaming frames."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import habitability, physics
from ..functions.rounding import with_rounded
from ..operators.joins import with_defaults
from ..sources import dims
from ..sources.wire import nan_to_null
from .training import with_predicted_label

# What the console shows of a reading.
CONSOLE_COLUMNS = [
    "planet_name",
    "star_type",
    "planet_type",
    "stellar_flux",
    "surface_radiation_msv_h",
    "avg_temp_celsius",
    "temperature_c",
    "atmosphere_o2",
    "in_hz_int",
    "tidally_locked_int",
    "habitability_score",
    "habitability_class",
    "ml_prediction",
    "alerts",
]

# The fields of a reading that score, class and alerts are made of.
ASSESSED_FIELDS = [
    "temperature_c", "avg_temp_celsius", "gravity_g", "stellar_flux", "surface_radiation_msv_h", "wind_speed_kmh",
    "vegetation_index", "humidity_pct", "seismic_activity", "atmosphere_o2", "atmosphere_co2", "atmosphere_n2",
    "has_water_int", "magnetic_field_int", "in_hz_int", "tidally_locked_int", "retains_atmosphere_int",
    "habitable_candidate_int",
]
CONSOLE_FIELDS = [*ASSESSED_FIELDS, "planet_name", "star_type", "planet_type"]
MODEL_FIELDS = ["star_type", "planet_type", *schemas.NUMERIC_FEATURES]
STELLAR_FIELDS = ["star_type", "distance_au", "magnetic_field_int", "atmosphere_n2"]


def _scored(readings: DataFrame) -> DataFrame:
    known = habitability.known_measures()
    scored = readings.withColumns(known).withColumn(
        "habitability_score", habitability.habitability_score()
    )
    return scored.drop(*known).withColumn("habitability_class", habitability.habitability_class())


def _alarmed(readings: DataFrame) -> DataFrame:
    """In two projections, so that the text is joined once."""
    raised = readings.withColumn("alerts", habitability.raised_alerts())
    return raised.withColumn("alerts", habitability.or_nominal("alerts"))


def with_score(readings: DataFrame) -> DataFrame:
    """Add score and class; NaN counts as missing and becomes NULL."""
    return _scored(nan_to_null(readings))


def with_alerts(readings: DataFrame) -> DataFrame:
    """Add the alert text; NaN raises none and becomes NULL."""
    return _alarmed(nan_to_null(readings))


def assess(readings: DataFrame, decoded: bool = False) -> DataFrame:
    """Add score, class and alerts; NaN becomes NULL, as it already is in decoded messages."""
    return _alarmed(_scored(readings if decoded else nan_to_null(readings)))


def enrich(readings: DataFrame, decoded: bool = False) -> DataFrame:
    """Add score, class, alerts and the processing time.

    Spark writes the time into the generated code, so code with it is compiled anew for every
    run.  Streams with many batches therefore ``assess``, and their sinks add the time.
    """
    return assess(readings, decoded).withColumn("processed_at", F.current_timestamp())


def score_breakdown(readings: DataFrame) -> DataFrame:
    """Add the points of every term, the reason of an elimination, and the score made of them."""
    known = habitability.known_measures()
    named = {f"pts_{term}": column for term, column in habitability.score_points().items()}
    return (
        nan_to_null(readings)
        .withColumns(known)
        .withColumns(named | {"eliminated_by": habitability.elimination()})
        .drop(*known)
        .withColumn(
            "habitability_score",
            habitability.score_from(list(named), "eliminated_by IS NOT NULL"),
        )
    )


def with_model(enriched: DataFrame, model: PipelineModel | None) -> DataFrame:
    """Add ``ml_predicted_label``; without a model it is a NULL text column."""
    if model is None:
        return enriched.withColumn("ml_predicted_label", F.lit(None).cast("string"))
    return with_predicted_label(model, model.transform(enriched), "ml_predicted_label")


def project_raw(readings: DataFrame) -> DataFrame:
    """The reading as it arrived (33 columns)."""
    return readings.select(*[f.name for f in schemas.SENSOR_READING.fields])


def project_console(enriched: DataFrame) -> DataFrame:
    return enriched.withColumnRenamed("ml_predicted_label", "ml_prediction").select(
        *CONSOLE_COLUMNS
    )


def with_star_fallback(spark: SparkSession, readings: DataFrame) -> DataFrame:
    """Star properties per reading; an unlisted star type gets the properties of ``unknown``."""
    return with_defaults(readings, dims.star_types(spark), "star_type", dims.UNKNOWN_STAR)


def with_stellar_physics(spark: SparkSession, readings: DataFrame) -> DataFrame:
    """Flux, radiation and tidal lock from the star type at telemetry precision.

    The results are ``flux_now``, ``radiation_now`` and ``locked_now``; missing inputs take the
    planet defaults.
    """
    distance = "coalesce(distance_au, 1D)"
    radiation = physics.surface_radiation(
        "luminosity",
        distance,
        "xuv_factor",
        "coalesce(magnetic_field_int, 0) = 1",
        "coalesce(atmosphere_n2, 78D)",
        physics.TELEMETRY,
    )
    flux = physics.stellar_flux("luminosity", distance)
    locked = physics.tidally_locked(distance, "tidal_lock_au").cast("int")
    quantities = {
        "flux_now": (flux, physics.TELEMETRY.flux_digits),
        "radiation_now": (radiation, physics.RADIATION_DIGITS),
    }
    star = with_star_fallback(spark, readings).withColumn("locked_now", locked)
    return with_rounded(star, quantities).drop(*dims.UNKNOWN_STAR)


def with_sensor_ranges(spark: SparkSession, readings: DataFrame) -> DataFrame:
    """Flag the sensors outside the nominal range of the planet type, and count them.

    A planet type without a profile is held against the ``unknown`` profile; a missing value is
    not out of range.
    """
    profiles = dims.sensor_profiles_wide(spark)
    bounds = [c for c in profiles.columns if c != "planet_type"]
    fallback = [float(x) for pair in dims.SENSOR_RANGES["unknown"] for x in pair]
    ranged = with_defaults(readings, profiles, "planet_type", dict(zip(bounds, fallback)))
    flags = {
        f"{sensor}_out": F.expr(
            f"if({column} NOT BETWEEN {sensor}_lo AND {sensor}_hi, 1, 0)"
        )
        for sensor, column in dims.SENSORS.items()
    }
    counted = F.expr(" + ".join(flags))
    return ranged.withColumns(flags).withColumn("sensors_out", counted).drop(*bounds)


def with_temperature_residual(readings: DataFrame) -> DataFrame:
    """Expected temperature of the day cycle and how far the reading is from it."""
    expected = physics.expected_temperature("avg_temp_celsius", "tick")
    return readings.withColumn("expected_temp_c", expected).withColumn(
        "temp_residual_c", F.col("temperature_c") - F.col("expected_temp_c")
    )


def with_composition(readings: DataFrame) -> DataFrame:
    """Gas shares as sensors report them, with the oxygen alias and carbon dioxide in ppm."""
    shares = {
        name: (physics.measured_percent(name), physics.PERCENT_DIGITS)
        for name in ("atmosphere_o2", "atmosphere_co2", "atmosphere_n2")
    }
    ppm = physics.percent_to_ppm("atmosphere_co2")
    return with_rounded(readings, {"co2_ppm": (ppm, physics.PPM_DIGITS)} | shares).withColumn(
        "o2_pct", F.col("atmosphere_o2")
    )
