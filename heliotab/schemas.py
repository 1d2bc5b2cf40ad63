"""Explicit schemas: no job infers one from data."""

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# One sensor reading as it travels over the topic (33 fields).
SENSOR_READING = StructType(
    [
        StructField("planet_name", StringType()),
        StructField("system_name", StringType()),
        StructField("star_type", StringType()),
        StructField("planet_type", StringType()),
        StructField("distance_au", DoubleType()),
        StructField("mass_earth", DoubleType()),
        StructField("radius_km", DoubleType()),
        StructField("temperature_c", DoubleType()),
        StructField("avg_temp_celsius", DoubleType()),
        StructField("gravity_g", DoubleType()),
        StructField("stellar_flux", DoubleType()),
        StructField("surface_radiation_msv_h", DoubleType()),
        StructField("radiation_msv_h", DoubleType()),
        StructField("wind_speed_kmh", DoubleType()),
        StructField("pressure_hpa", DoubleType()),
        StructField("vegetation_index", DoubleType()),
        StructField("humidity_pct", DoubleType()),
        StructField("seismic_activity", DoubleType()),
        StructField("magnetic_field_ut", DoubleType()),
        StructField("atmosphere_o2", DoubleType()),
        StructField("atmosphere_co2", DoubleType()),
        StructField("atmosphere_n2", DoubleType()),
        StructField("o2_pct", DoubleType()),
        StructField("co2_ppm", DoubleType()),
        StructField("has_water_int", IntegerType()),
        StructField("magnetic_field_int", IntegerType()),
        StructField("in_hz_int", IntegerType()),
        StructField("tidally_locked_int", IntegerType()),
        StructField("retains_atmosphere_int", IntegerType()),
        StructField("habitable_candidate_int", IntegerType()),
        StructField("tick", IntegerType()),
        StructField("timestamp", StringType()),
        StructField("source", StringType()),
    ]
)

# Topic messages: key and JSON text.
WIRE = StructType([StructField("key", StringType()), StructField("value", StringType())])

# The star table (12 columns).
STAR_SYSTEMS = StructType(
    [
        StructField("system_name", StringType()),
        StructField("star_type", StringType()),
        StructField("star_luminosity", DoubleType()),
        StructField("star_temp_k", IntegerType()),
        StructField("star_mass_solar", DoubleType()),
        StructField("star_age_gy", DoubleType()),
        StructField("star_lifespan_gy", DoubleType()),
        StructField("star_color", StringType()),
        StructField("xuv_factor", DoubleType()),
        StructField("flare_risk", DoubleType()),
        StructField("hz_inner_au", DoubleType()),
        StructField("hz_outer_au", DoubleType()),
    ]
)

# The planet table (33 columns).
PLANETS = StructType(
    [
        StructField("system_name", StringType()),
        StructField("star_type", StringType()),
        StructField("star_luminosity", DoubleType()),
        StructField("star_age_gy", DoubleType()),
        StructField("xuv_factor", DoubleType()),
        StructField("flare_risk", DoubleType()),
        StructField("name", StringType()),
        StructField("planet_type", StringType()),
        StructField("distance_au", DoubleType()),
        StructField("radius_km", DoubleType()),
        StructField("mass_earth", DoubleType()),
        StructField("gravity_g", DoubleType()),
        StructField("avg_temp_celsius", DoubleType()),
        StructField("stellar_flux", DoubleType()),
        StructField("surface_radiation_msv_h", DoubleType()),
        StructField("tidally_locked", BooleanType()),
        StructField("retains_atmosphere", BooleanType()),
        StructField("atmosphere_o2", DoubleType()),
        StructField("atmosphere_co2", DoubleType()),
        StructField("atmosphere_n2", DoubleType()),
        StructField("has_water", BooleanType()),
        StructField("magnetic_field", BooleanType()),
        StructField("moons", IntegerType()),
        StructField("in_habitable_zone", BooleanType()),
        StructField("albedo", DoubleType()),
        StructField("habitable_candidate", BooleanType()),
        StructField("has_water_int", IntegerType()),
        StructField("magnetic_field_int", IntegerType()),
        StructField("in_hz_int", IntegerType()),
        StructField("habitable_candidate_int", IntegerType()),
        StructField("tidally_locked_int", IntegerType()),
        StructField("retains_atmosphere_int", IntegerType()),
        StructField("label", StringType()),
    ]
)

# A planet as a source hands it to the telemetry side (18 columns).
SOURCE_PLANETS = StructType(
    [
        StructField("name", StringType()),
        StructField("system_name", StringType()),
        StructField("star_type", StringType()),
        StructField("planet_type", StringType()),
        StructField("distance_au", DoubleType()),
        StructField("mass_earth", DoubleType()),
        StructField("radius_km", DoubleType()),
        StructField("gravity_g", DoubleType()),
        StructField("avg_temp_celsius", DoubleType()),
        StructField("atmosphere_o2", DoubleType()),
        StructField("atmosphere_co2", DoubleType()),
        StructField("atmosphere_n2", DoubleType()),
        StructField("has_water", BooleanType()),
        StructField("magnetic_field", BooleanType()),
        StructField("in_habitable_zone", BooleanType()),
        StructField("retains_atmosphere", BooleanType()),
        StructField("habitable_candidate", BooleanType()),
        StructField("source", StringType()),
    ]
)

# An extract of the public exoplanet archive, with the flag of its default parameter set.
ARCHIVE = StructType(
    [
        StructField("hostname", StringType()),
        StructField("pl_name", StringType()),
        StructField("st_spectype", StringType()),
        StructField("st_lum", DoubleType()),
        StructField("st_age", DoubleType()),
        StructField("pl_orbsmax", DoubleType()),
        StructField("pl_rade", DoubleType()),
        StructField("pl_bmasse", DoubleType()),
        StructField("pl_eqt", DoubleType()),
        StructField("default_flag", IntegerType()),
    ]
)

# The boolean columns of the planet table and their 0/1 twins.
FLAG_TWINS = {
    "has_water": "has_water_int",
    "magnetic_field": "magnetic_field_int",
    "in_habitable_zone": "in_hz_int",
    "habitable_candidate": "habitable_candidate_int",
    "tidally_locked": "tidally_locked_int",
    "retains_atmosphere": "retains_atmosphere_int",
}

# What the classifier reads besides the two encoded type columns.
NUMERIC_FEATURES = [
    "distance_au",
    "stellar_flux",
    "radius_km",
    "mass_earth",
    "gravity_g",
    "avg_temp_celsius",
    "surface_radiation_msv_h",
    "atmosphere_o2",
    "atmosphere_co2",
    "atmosphere_n2",
    "has_water_int",
    "magnetic_field_int",
    "in_hz_int",
    "tidally_locked_int",
    "retains_atmosphere_int",
]

# The stored result of the batch job (16 columns).
BATCH_RESULT = [
    "system_name",
    "name",
    "star_type",
    "planet_type",
    "distance_au",
    "avg_temp_celsius",
    "stellar_flux",
    "surface_radiation_msv_h",
    "in_habitable_zone",
    "atmosphere_o2",
    "has_water_int",
    "gravity_g",
    "tidally_locked",
    "retains_atmosphere",
    "label",
    "predicted_label",
]

# The held-out report (9 columns).
BATCH_REPORT = [
    "name",
    "star_type",
    "planet_type",
    "stellar_flux",
    "surface_radiation_msv_h",
    "avg_temp_celsius",
    "in_habitable_zone",
    "label",
    "predicted_label",
]

# Columns that a fitted pipeline adds and document stores must not see.
MODEL_COLUMNS = [
    "star_type_idx",
    "planet_type_idx",
    "label_index",
    "star_type_vec",
    "planet_type_vec",
    "features_raw",
    "features",
    "rawPrediction",
    "probability",
    "prediction",
]
