"""Planetary tables derived from the order tables: systems, planets, readings, archive extract.

Suppliers become star systems, parts become planets, order lines become sensor readings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from ..plans import catalog
from . import dims
from .wire import iso_timestamp

# The planet type of a part by p_size modulo 12.
_PLANET_TYPES_BY_SIZE = (
    "'terrestrial', 'terrestrial', 'terrestrial', 'terrestrial', 'ocean', 'ocean', "
    "'super_earth', 'super_earth', 'gas', 'gas_giant', 'ice_dwarf', 'lava'"
)


# The columns used of each table; a given schema saves a job that reads file footers.
SCHEMAS = {
    "supplier": "s_suppkey bigint, s_name string",
    "part": "p_partkey bigint, p_name string, p_size int",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def systems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """system_id, system_name, star_type, star_age_gy."""
    types = dims.star_types(spark).select("star_idx", "star_type")
    return (
        table(spark, sf_dir, "supplier")
        .selectExpr(
            "s_suppkey AS system_id",
            "s_name AS system_name",
            "CAST((s_suppkey * 37 + 11) % 130 AS DOUBLE) / 10 AS star_age_gy",
            "CAST(CASE WHEN s_suppkey % 10 < 7 THEN s_suppkey % 10 WHEN s_suppkey % 10 = 7 THEN 2"
            " WHEN s_suppkey % 10 = 8 THEN 1 ELSE 6 END AS INT) AS star_idx",
        )
        .join(F.broadcast(types), "star_idx")
        .select("system_id", "system_name", "star_type", "star_age_gy")
    )


def planets_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measured planets with their system's columns, before any physics."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    n_systems = supplier.count()
    star = dims.star_types(spark).select("star_type", "luminosity")
    hosts = systems(spark, sf_dir).join(F.broadcast(star), "star_type")
    part = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_name", "p_size", f"p_partkey % {n_systems} AS system_id"
    )
    joined = lookup_join(part, hosts, "system_id", n_systems)
    return joined.selectExpr(
        "p_partkey AS planet_id",
        "concat(p_name, ' ', CAST(p_partkey AS STRING)) AS name",
        "system_id",
        "system_name",
        "star_type",
        "star_age_gy",
        f"get(array({_PLANET_TYPES_BY_SIZE}), p_size % 12) AS planet_type",
        "round(sqrt(luminosity) * CASE WHEN p_partkey % 3 = 1"
        " THEN 0.803D + CAST((p_partkey * 17) % 16 AS DOUBLE) / 100"
        " ELSE 0.253D + CAST((p_partkey * 17) % 41 AS DOUBLE) / 20 END, 6) AS distance_au",
        "CAST(2000 + (p_partkey * 131) % 9000 AS DOUBLE) AS radius_km",
        "CAST(3 + (p_partkey * 19) % 400 AS DOUBLE) / 100 AS mass_earth",
        "CAST(2 + (p_partkey * 13) % 29 AS DOUBLE) / 10 AS gravity_g",
        "CAST((p_partkey * 7) % 33 AS DOUBLE) AS atmosphere_o2",
        "CAST((p_partkey * 11) % 13 AS DOUBLE) AS atmosphere_co2",
        "CAST(30 + (p_partkey * 29) % 70 AS DOUBLE) AS atmosphere_n2",
        "p_partkey % 3 <> 0 AS has_water",
        "(p_partkey div 2) % 5 >= 1 AS magnetic_field",
        "CAST(p_partkey % 36 AS INT) AS moons",
    )


def planets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The planet table with physics, label and the deciding rule, plus planet_id and system_id."""
    return catalog.planet_table(spark, planets_raw(spark, sf_dir))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per order line, keyed by (l_orderkey, l_linenumber), which can repeat."""
    planet = planets(spark, sf_dir).drop("source")
    n_planets = table(spark, sf_dir, "part").count()
    line = table(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "planet_id")
    joined = lookup_join(line, planet, "planet_id", n_planets, hashed=True)
    return joined.withColumn("timestamp", iso_timestamp(F.col("l_shipdate"))).selectExpr(
        "l_orderkey",
        "l_linenumber",
        "planet_id",
        "name AS planet_name",
        "system_name",
        "if(l_suppkey % 25 = 0, 'unlisted', star_type) AS star_type",
        "planet_type",
        "distance_au",
        "mass_earth",
        "radius_km",
        "round(avg_temp_celsius + (l_quantity - 25) / 5, 2) AS temperature_c",
        "avg_temp_celsius",
        "gravity_g",
        "stellar_flux",
        "surface_radiation_msv_h",
        "surface_radiation_msv_h AS radiation_msv_h",
        "l_extendedprice / 160 AS wind_speed_kmh",
        "900 + l_quantity * 4 AS pressure_hpa",
        "l_discount * 10 AS vegetation_index",
        "l_quantity * 2 AS humidity_pct",
        "CAST((l_orderkey + l_linenumber) % 37 AS DOUBLE) / 4 AS seismic_activity",
        "20 + l_tax * 500 AS magnetic_field_ut",
        "if(l_orderkey % 97 = 0, NULL, atmosphere_o2) AS atmosphere_o2",
        "atmosphere_co2",
        "atmosphere_n2",
        "if(l_orderkey % 97 = 0, NULL, atmosphere_o2) AS o2_pct",
        "atmosphere_co2 * 10000 AS co2_ppm",
        "has_water_int",
        "if(l_orderkey % 89 = 0, NULL, magnetic_field_int) AS magnetic_field_int",
        "in_hz_int",
        "tidally_locked_int",
        "retains_atmosphere_int",
        "habitable_candidate_int",
        "l_linenumber AS tick",
        "l_shipdate AS event_time",
        "timestamp",
        "if(l_returnflag = 'R', 'catalog', 'local') AS source",
        "label",
    )


def archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An exoplanet archive extract with missing measures."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    n_hosts = supplier.count()
    part = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_name", "p_size", f"p_partkey % {n_hosts} AS s_suppkey"
    )
    joined = lookup_join(part, supplier, "s_suppkey", n_hosts)
    return joined.selectExpr(
        "s_name AS hostname",
        "concat(p_name, ' ', CAST(p_partkey AS STRING)) AS pl_name",
        "concat('G', CAST(p_size % 10 AS STRING)) AS st_spectype",
        "CAST(p_size AS DOUBLE) / 25 AS st_lum",
        "CAST(p_partkey % 130 AS DOUBLE) / 10 AS st_age",
        "if(p_partkey % 11 = 0, NULL, 0.053D + CAST((p_partkey * 17) % 97 AS DOUBLE) / 40) AS pl_orbsmax",
        "if(p_partkey % 13 = 0, NULL, 0.5D + CAST((p_partkey * 7) % 90 AS DOUBLE) / 10) AS pl_rade",
        "if(p_partkey % 17 = 0, NULL, 0.3D + CAST((p_partkey * 19) % 150 AS DOUBLE) / 10) AS pl_bmasse",
        "if(p_partkey % 19 = 0, NULL, CAST(150 + (p_partkey * 23) % 900 AS DOUBLE)) AS pl_eqt",
        "if(p_partkey % 4 = 0, 0, 1) AS default_flag",
    )
