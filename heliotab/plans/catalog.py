"""Catalogue plans: nested systems, planet and star tables, planet sources."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import habitability, physics
from ..functions.rounding import with_rounded
from ..sources import csvscan, dims

# What a planet without a measure counts as on the telemetry side.
PLANET_DEFAULTS = {
    "star_type": "unknown",
    "planet_type": "unknown",
    "distance_au": 1.0,
    "mass_earth": 1.0,
    "radius_km": 6371.0,
    "gravity_g": 1.0,
    "avg_temp_celsius": 20.0,
    "atmosphere_o2": 0.0,
    "atmosphere_co2": 0.0,
    "atmosphere_n2": 78.0,
    "has_water": False,
    "magnetic_field": False,
    "in_habitable_zone": False,
    "retains_atmosphere": True,
    "habitable_candidate": False,
    "source": "local",
}
# Columns that a local catalogue file may lack, and what they are then.
LOCAL_FILE_DEFAULTS = {
    "atmosphere_o2": 0.0,
    "atmosphere_co2": 0.0,
    "atmosphere_n2": 0.0,
    "has_water": False,
    "magnetic_field": False,
    "in_habitable_zone": False,
    "retains_atmosphere": True,
    "habitable_candidate": False,
    "source": "local",
}
# What the archive does not tell about a planet.
ARCHIVE_CONSTANTS = {
    "star_type": "unknown",
    "atmosphere_o2": 0.0,
    "atmosphere_co2": 0.0,
    "atmosphere_n2": 0.0,
    "has_water": False,
    "magnetic_field": False,
    "in_habitable_zone": False,
    "retains_atmosphere": True,
    "habitable_candidate": False,
    "source": "nasa",
}
# Fixed value: how many archive planets a telemetry run shows.
ARCHIVE_LIMIT = 30


def _in_schema_order(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def with_dimension(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Add the columns of a fixed dimension; a key that it does not list is an error.

    All columns are taken out of one checked struct, so the check runs whichever of them is used.
    """
    added = [c for c in dimension.columns if c != key]
    listed = F.broadcast(dimension.select(key, F.struct(*added).alias("listed")))
    unlisted = F.raise_error(F.concat(F.lit(f"unlisted {key}: "), F.coalesce(key, F.lit("NULL"))))
    checked = F.coalesce(F.col("listed"), unlisted)
    joined = df.join(listed, key, "left").withColumn("listed", checked)
    return joined.select(*df.columns, *[F.col(f"listed.{c}").alias(c) for c in added])


def with_star_type(spark: SparkSession, df: DataFrame, zone: bool = False) -> DataFrame:
    """Add the star properties, and on request the zone bounds, which depend on them alone and
    are therefore computed for the seven types and not for every row."""
    types = dims.star_types(spark).drop("star_idx")
    return with_dimension(df, with_rounded(types, _zone()) if zone else types, "star_type")


def with_planet_type(spark: SparkSession, df: DataFrame) -> DataFrame:
    return with_dimension(df, dims.planet_types(spark), "planet_type")


def _zone() -> dict[str, tuple[Column, int]]:
    return {
        "hz_inner_au": (physics.hz_inner("luminosity"), physics.ZONE_DIGITS),
        "hz_outer_au": (physics.hz_outer("luminosity"), physics.ZONE_DIGITS),
    }


def star_system_table(spark: SparkSession, systems: DataFrame) -> DataFrame:
    """The 12-column star table from (system_name, star_type, star_age_gy)."""
    typed = with_star_type(spark, systems, zone=True)
    renamed = typed.withColumnsRenamed(
        {
            "luminosity": "star_luminosity",
            "temp_k": "star_temp_k",
            "mass_solar": "star_mass_solar",
            "lifespan_gy": "star_lifespan_gy",
            "color": "star_color",
        }
    )
    return _in_schema_order(renamed, schemas.STAR_SYSTEMS)


def with_flag_twins(df: DataFrame) -> DataFrame:
    """Add the 0/1 twin of every boolean planet column."""
    return df.withColumns({t: F.col(f).cast("int") for f, t in schemas.FLAG_TWINS.items()})


def with_physics(df: DataFrame) -> DataFrame:
    """Derived quantities of planets that carry the columns of both dimensions and the zone."""
    temperature = physics.equilibrium_temperature("luminosity", "distance_au", "base_albedo")
    radiation = physics.surface_radiation(
        "luminosity", "distance_au", "xuv_factor", "magnetic_field", "atmosphere_n2"
    )
    flux = physics.stellar_flux("luminosity", "distance_au")
    quantities = {
        "avg_temp_celsius": (temperature, physics.TEMPERATURE_DIGITS),
        "stellar_flux": (flux, physics.CATALOG.flux_digits),
        "surface_radiation_msv_h": (radiation, physics.RADIATION_DIGITS),
    }
    return with_rounded(df, quantities).withColumns(
        {
            "tidally_locked": physics.tidally_locked("distance_au", "tidal_lock_au"),
            "in_habitable_zone": physics.in_habitable_zone(
                "distance_au", "hz_inner_au", "hz_outer_au"
            ),
            "retains_atmosphere": physics.retains_atmosphere("gravity_g", "avg_temp_celsius"),
        }
    )


def with_label(df: DataFrame) -> DataFrame:
    """Label and deciding rule; the rules run once."""
    return df.withColumn("label_rule", habitability.label_reason()).withColumn(
        "label", habitability.label_of("label_rule")
    )


def planet_table(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """The 33-column planet table from measured planets that carry their system's columns.

    Further columns of ``raw`` are kept; star limits and ``label_rule`` are added for reports.
    """
    typed = with_planet_type(spark, with_star_type(spark, raw, zone=True))
    labelled = with_label(with_flag_twins(with_physics(typed))).withColumnsRenamed(
        {"luminosity": "star_luminosity", "base_albedo": "albedo"}
    )
    columns = [f.name for f in schemas.PLANETS.fields]
    extra = [c for c in raw.columns if c not in columns]
    return labelled.select(*extra, *columns, "min_age_gy", "lifespan_gy", "label_rule")


def flatten(nested: DataFrame, planets: str = "planets") -> DataFrame:
    """One row per element of the planet array, with the system's columns."""
    parents = [c for c in nested.columns if c != planets]
    return nested.select(*parents, F.inline(planets))


def nest(planets: DataFrame, parents: list[str], by: Column) -> DataFrame:
    """Planets as an array per system and ``by``.

    ``by`` must bound the group (for instance a range of a unique id), so that no array grows
    with the table.
    """
    children = [c for c in planets.columns if c not in parents]
    return (
        planets.groupBy(*parents, by.alias("_chunk"))
        .agg(F.collect_list(F.struct(*children)).alias("planets"))
        .drop("_chunk")
    )


def read_planets_csv(
    spark: SparkSession, path: str, infer: bool = False, problems: bool = False
) -> DataFrame:
    """The 33 planet columns by header name, whatever their order; a missing one is an error.

    Inference keeps the file's own columns and types; it costs a second pass and is therefore off.
    ``problems``: see ``csvscan.scan``.
    """
    if infer:
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return csvscan.scan(spark, path, schemas.PLANETS, problems=problems)


def load_local_planets(spark: SparkSession, path: str) -> DataFrame:
    """A catalogue file as source planets: typed, missing columns defaulted, no file no rows."""
    try:
        rows = csvscan.scan(spark, path, schemas.SOURCE_PLANETS, LOCAL_FILE_DEFAULTS)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.SOURCE_PLANETS)
    return rows.withColumn("source", F.lit("local"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """An archive extract as CSV with header; columns are found by name, lines of comment skipped."""
    return csvscan.scan(spark, path, schemas.ARCHIVE, comment="#")


def default_parameter_sets(archive: DataFrame) -> DataFrame:
    """Rows of the default parameter set whose four needed measures are known."""
    needed = ("pl_eqt", "pl_orbsmax", "pl_bmasse", "pl_rade")
    return archive.filter("default_flag = 1").dropna(subset=list(needed))


def archive_planets(archive: DataFrame) -> DataFrame:
    """Archive rows in the units and columns of source planets."""
    mapped = archive.selectExpr(
        "pl_name AS name",
        "hostname AS system_name",
        "coalesce(pl_orbsmax, 1D) AS distance_au",
        "coalesce(pl_rade, 1D) AS earth_radii",
        "coalesce(pl_bmasse, 1D) AS mass_earth",
        "pl_eqt",
    ).withColumns({k: F.lit(v) for k, v in ARCHIVE_CONSTANTS.items()})
    converted = with_rounded(
        mapped.withColumn("planet_type", physics.size_class("earth_radii", "mass_earth")),
        {
            "radius_km": (physics.radius_km("earth_radii"), physics.RADIUS_DIGITS),
            "gravity_g": (
                physics.surface_gravity("mass_earth", "earth_radii"),
                physics.GRAVITY_DIGITS,
            ),
            "avg_temp_celsius": (physics.celsius("pl_eqt"), physics.TEMPERATURE_DIGITS),
        },
    )
    return _in_schema_order(converted, schemas.SOURCE_PLANETS)


def normalize_archive(archive: DataFrame, limit: int | None = None) -> DataFrame:
    """All usable archive planets, or the first ``limit`` by host (then name).

    The limit follows the conversions, so that it stays next to the sort and becomes a top-k.
    """
    planets = archive_planets(default_parameter_sets(archive))
    if limit is None:
        return planets
    return planets.orderBy("system_name", "name").limit(limit)


def union_sources(local: DataFrame, archive: DataFrame, source: str = "both") -> DataFrame:
    """Planets of the chosen sources (``local``, ``nasa`` or ``both``), duplicates kept."""
    if source == "local":
        return local
    if source == "nasa":
        return archive
    if source == "both":
        return local.unionByName(archive)
    raise ValueError(f"unknown source {source}")


def fill_planet_defaults(df: DataFrame) -> DataFrame:
    """Replace missing measures by the telemetry defaults; absent columns are added."""
    present = {c: v for c, v in PLANET_DEFAULTS.items() if c in df.columns}
    absent = {c: F.lit(v) for c, v in PLANET_DEFAULTS.items() if c not in df.columns}
    return df.na.fill(present).withColumns(absent)
