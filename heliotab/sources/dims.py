"""Dimension tables.  Every one has at most eight rows by definition, so joins may broadcast them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The star types.
STAR_COLUMNS = [
    "star_idx",
    "star_type",
    "luminosity",
    "temp_k",
    "mass_solar",
    "lifespan_gy",
    "color",
    "xuv_factor",
    "flare_risk",
    "tidal_lock_au",
    "min_age_gy",
]
STAR_ROWS = [
    (0, "red_dwarf", 0.01, 3200, 0.3, 100.0, "red", 10.0, 0.6, 0.3, 2.0),
    (1, "orange_dwarf", 0.3, 4500, 0.7, 30.0, "orange", 2.0, 0.2, 0.15, 1.0),
    (2, "yellow_dwarf", 1.0, 5778, 1.0, 10.0, "yellow", 1.0, 0.1, 0.05, 1.0),
    (3, "white_dwarf", 0.001, 25000, 0.6, 999.0, "white", 50.0, 0.0, 0.5, 0.0),
    (4, "blue_giant", 50000.0, 30000, 20.0, 0.01, "blue", 100000.0, 0.0, 0.0, 0.0),
    (5, "red_giant", 1000.0, 3700, 5.0, 0.1, "red", 5.0, 0.05, 0.0, 0.0),
    (6, "subgiant", 3.0, 6000, 1.5, 5.0, "yellow", 1.5, 0.08, 0.05, 1.0),
]
# What telemetry assumes for a star type it does not know.
UNKNOWN_STAR = {"luminosity": 1.0, "xuv_factor": 1.0, "tidal_lock_au": 0.05}

# The planet types.
PLANET_COLUMNS = [
    "planet_type",
    "base_albedo",
    "habitable_candidate",
]
PLANET_ROWS = [
    ("terrestrial", 0.30, True),
    ("super_earth", 0.35, True),
    ("ocean", 0.20, True),
    ("gas", 0.52, False),
    ("gas_giant", 0.52, False),
    ("ice_dwarf", 0.70, False),
    ("lava", 0.10, False),
]

# The sensors with a nominal range and the reading column that carries each.
SENSORS = {
    "wind_speed": "wind_speed_kmh",
    "pressure": "pressure_hpa",
    "vegetation": "vegetation_index",
    "humidity": "humidity_pct",
    "seismic": "seismic_activity",
    "magnetic_ut": "magnetic_field_ut",
}
# Nominal closed range of every sensor, in the order of SENSORS.
SENSOR_RANGES = {
    "terrestrial": [(20, 80), (900, 1100), (0.0, 0.6), (10, 80), (0, 4), (20, 60)],
    "ocean": [(30, 120), (1000, 1100), (0.4, 0.9), (80, 100), (0, 3), (25, 55)],
    "super_earth": [(50, 200), (1100, 2000), (0.0, 0.4), (20, 70), (1, 6), (30, 90)],
    "gas": [(500, 2000), (10000, 100000), (0.0, 0.0), (0, 5), (0, 2), (100, 1000)],
    "gas_giant": [(800, 3000), (50000, 500000), (0.0, 0.0), (0, 2), (0, 1), (500, 5000)],
    "ice_dwarf": [(0, 30), (0.1, 10), (0.0, 0.0), (0, 5), (0, 2), (1, 15)],
    "lava": [(100, 500), (50, 500), (0.0, 0.0), (0, 2), (5, 10), (5, 30)],
    "unknown": [(0, 100), (100, 1000), (0.0, 0.2), (0, 50), (0, 5), (5, 50)],
}


def _sql_literal(value) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return f"{value!r}D"
    return repr(value)


def _values(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """A literal relation: no job, no scan, and Catalyst knows its exact size."""
    body = ", ".join("(" + ", ".join(map(_sql_literal, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(columns)})")


def star_types(spark: SparkSession) -> DataFrame:
    return _values(spark, STAR_COLUMNS, STAR_ROWS)


def planet_types(spark: SparkSession) -> DataFrame:
    return _values(spark, PLANET_COLUMNS, PLANET_ROWS)


def sensor_profiles(spark: SparkSession) -> DataFrame:
    """Long form: one row per planet type and sensor."""
    rows = [
        (planet_type, sensor, float(lo), float(hi))
        for planet_type, ranges in SENSOR_RANGES.items()
        for sensor, (lo, hi) in zip(SENSORS, ranges)
    ]
    return _values(spark, ["planet_type", "sensor", "lo", "hi"], rows)


def sensor_profiles_wide(spark: SparkSession) -> DataFrame:
    """One row per planet type, two columns per sensor: the shape that readings join to."""
    columns = ["planet_type"] + [f"{s}_{end}" for s in SENSORS for end in ("lo", "hi")]
    rows = [
        (planet_type, *(float(end) for bounds in ranges for end in bounds))
        for planet_type, ranges in SENSOR_RANGES.items()
    ]
    return _values(spark, columns, rows)
