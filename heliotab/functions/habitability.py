"""Label, score, class and alert rules, as data, and the columns compiled from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab
from .rules import Rules, any_match_sql, first_match, first_match_sql, own_method

# Label rules of the catalogue, first match wins.  A missing flag counts as "no".
LABEL_RULES = [
    ("coalesce(habitable_candidate_int, 0) = 0", "r1"),
    ("avg_temp_celsius < -80 OR avg_temp_celsius > 80", "r2"),
    ("stellar_flux > 10", "r3"),
    ("surface_radiation_msv_h > 5", "r4"),
    ("star_age_gy < min_age_gy", "r5"),
    ("lifespan_gy < 1", "r6"),
    ("coalesce(retains_atmosphere_int, 0) = 0", "r7"),
    ("tidally_locked_int = 1 AND coalesce(magnetic_field_int, 0) = 0", "r8"),
    ("coalesce(in_hz_int, 0) = 0", "r9"),
    (
        "avg_temp_celsius BETWEEN -10 AND 50 AND stellar_flux BETWEEN 0.25 AND 1.5"
        " AND atmosphere_o2 >= 15 AND atmosphere_n2 >= 50 AND has_water_int = 1"
        " AND magnetic_field_int = 1 AND surface_radiation_msv_h <= 0.5 AND star_age_gy >= 2"
        " AND gravity_g BETWEEN 0.4 AND 2.5 AND atmosphere_co2 <= 5",
        vocab.HABITABLE,
    ),
    (
        "(has_water_int = 1 OR in_hz_int = 1) AND atmosphere_o2 >= 5"
        " AND surface_radiation_msv_h <= 2 AND avg_temp_celsius BETWEEN -30 AND 70",
        vocab.UNCERTAIN,
    ),
]
LAST_LABEL_RULE = "r10"

# Readings that score zero whatever else they show.
SCORE_ELIMINATIONS = [
    ("{habitable_candidate_int} = 0", "not_candidate"),
    ("{stellar_flux} > 10", "flux"),
    ("surface_radiation_msv_h > 5", "radiation"),
    ("{avg_temp_celsius} < -80 OR {avg_temp_celsius} > 80", "temperature"),
    ("{retains_atmosphere_int} = 0", "no_atmosphere"),
    ("{tidally_locked_int} = 1 AND {magnetic_field_int} = 0", "locked_unshielded"),
]

# Points per term, first match wins.  Vegetation is the one linear term.
SCORE_TERMS = {
    "zone": [("{in_hz_int} = 1", 20.0)],
    "temperature": [
        ("{avg_temp_celsius} BETWEEN -10 AND 50", 20.0),
        ("{avg_temp_celsius} BETWEEN -30 AND 65", 10.0),
        ("{avg_temp_celsius} BETWEEN -60 AND 80", 3.0),
    ],
    "flux": [
        ("{stellar_flux} BETWEEN 0.25 AND 1.5", 15.0),
        ("{stellar_flux} BETWEEN 0.1 AND 3", 7.0),
        ("{stellar_flux} <= 8", 2.0),
    ],
    "oxygen": [
        ("{atmosphere_o2} BETWEEN 18 AND 25", 15.0),
        ("{atmosphere_o2} BETWEEN 12 AND 30", 8.0),
        ("{atmosphere_o2} >= 5", 3.0),
    ],
    "water": [("{has_water_int} = 1", 10.0)],
    "magnetic": [("{magnetic_field_int} = 1", 10.0), ("{tidally_locked_int} = 1", -10.0)],
    "radiation": [
        ("{surface_radiation_msv_h} <= 0.1", 10.0),
        ("{surface_radiation_msv_h} <= 0.5", 6.0),
        ("{surface_radiation_msv_h} <= 2", 2.0),
        ("{surface_radiation_msv_h} <= 5", -5.0),
    ],
    "nitrogen": [("{atmosphere_n2} >= 70", 5.0), ("{atmosphere_n2} >= 40", 2.0)],
    "carbon_dioxide": [
        ("{atmosphere_co2} > 10", -15.0),
        ("{atmosphere_co2} > 5", -8.0),
        ("{atmosphere_co2} > 2", -3.0),
    ],
    "gravity": [
        ("{gravity_g} BETWEEN 0.7 AND 1.5", 3.0),
        ("{gravity_g} BETWEEN 0.4 AND 2.5", 1.0),
        ("{gravity_g} < 0.4", -10.0),
    ],
    "humidity": [("{humidity_pct} BETWEEN 20 AND 80", 5.0), ("{humidity_pct} >= 10", 2.0)],
    "planet_type": [
        ("{planet_type} = 'ocean'", 5.0),
        ("{planet_type} = 'terrestrial'", 3.0),
        ("{planet_type} = 'super_earth'", 1.0),
    ],
    "seismic": [
        ("{seismic_activity} >= 8", -15.0),
        ("{seismic_activity} >= 6", -8.0),
        ("{seismic_activity} >= 4", -3.0),
    ],
    "wind": [("{wind_speed_kmh} > 500", -15.0), ("{wind_speed_kmh} > 200", -5.0)],
}
VEGETATION_POINTS = 5.0
# What stands for a missing measure in the rules above: a value that no rule on it matches.
# Radiation has none that fits both lists, so its elimination reads the column itself.
MISSING = {
    "habitable_candidate_int": -1,
    "in_hz_int": -1,
    "has_water_int": -1,
    "magnetic_field_int": -1,
    "tidally_locked_int": -1,
    "retains_atmosphere_int": -1,
    "avg_temp_celsius": -70.0,
    "stellar_flux": 9.0,
    "surface_radiation_msv_h": 99.0,
    "atmosphere_o2": 0.0,
    "atmosphere_n2": 0.0,
    "atmosphere_co2": 0.0,
    "gravity_g": 9.0,
    "humidity_pct": 0.0,
    "seismic_activity": 0.0,
    "wind_speed_kmh": 0.0,
    "planet_type": "",
}
SCORE_RANGE = (0.0, 100.0)

# Lowest score of each class.
CLASS_RULES = [
    ("habitability_score >= 60", vocab.HABITABLE),
    ("habitability_score >= 30", vocab.UNCERTAIN),
]

# Alert rules; within a group the first match wins.
ALERT_RULES = [
    [("temperature_c > 80", "TEMP_HIGH"), ("temperature_c < -80", "TEMP_LOW")],
    [("surface_radiation_msv_h > 5", "RAD_LETHAL"), ("surface_radiation_msv_h > 2", "RAD_HIGH")],
    [("seismic_activity >= 7", "QUAKE")],
    [("wind_speed_kmh > 400", "STORM")],
    [("atmosphere_o2 < 5", "O2_LOW")],
    [("stellar_flux > 10", "FLUX_FATAL")],
    [("tidally_locked_int = 1", "TIDAL_LOCK")],
]
NO_ALERT = "NOMINAL"


def label_reason() -> Column:
    """The rule that decided a planet's label: r1 to r10, or the two positive outcomes."""
    return F.expr(own_method(first_match_sql(LABEL_RULES, LAST_LABEL_RULE)))


def label_of(reason: str) -> Column:
    """The label that a rule of ``label_reason`` stands for."""
    positive = f"{reason} IN ('{vocab.HABITABLE}', '{vocab.UNCERTAIN}')"
    return F.expr(f"CASE WHEN {positive} THEN {reason} ELSE '{vocab.NON_HABITABLE}' END")


def known_measures() -> dict[str, Column]:
    """The measures of the score rules without gaps, as helper columns.

    Comparisons of columns that cannot be NULL compile to half the code, which keeps the method
    that Spark generates for a whole enrichment below the size that the JVM still compiles.
    """
    return {
        f"_known_{measure}": F.coalesce(F.col(measure), F.lit(missing))
        for measure, missing in MISSING.items()
    }


def _on_known(rules: Rules) -> Rules:
    names = {measure: f"_known_{measure}" for measure in MISSING}
    return [(predicate.format_map(names), result) for predicate, result in rules]


def elimination() -> Column:
    """Why a reading with known measures scores zero outright, else NULL."""
    return first_match(_on_known(SCORE_ELIMINATIONS))


def _points_sql() -> dict[str, str]:
    points = {t: first_match_sql(_on_known(bands), 0.0) for t, bands in SCORE_TERMS.items()}
    earned = f"coalesce(vegetation_index * {VEGETATION_POINTS}D, 0D)"
    return points | {"vegetation": f"least({VEGETATION_POINTS}D, {earned})"}


def score_points() -> dict[str, Column]:
    """Points per term, eliminations aside; a term without a match is worth nothing."""
    return {term: F.expr(sql) for term, sql in _points_sql().items()}


def _clamped(points: str) -> str:
    low, high = SCORE_RANGE
    return f"round(greatest({low}D, least({high}D, {points})), 1)"


def score_from(terms: list[str], eliminated: str) -> Column:
    """Sum of the terms, clamped, with one decimal; zero for eliminated readings."""
    return F.expr(f"CASE WHEN {eliminated} THEN 0D ELSE {_clamped(' + '.join(terms))} END")


def habitability_score() -> Column:
    """0 to 100 with one decimal, from known measures.

    A product and not a CASE: the points are computed for every reading, in a method of their own.
    """
    eliminated = any_match_sql(_on_known(SCORE_ELIMINATIONS))
    points = own_method(" + ".join(_points_sql().values()))
    return F.expr(f"if({eliminated}, 0D, 1D) * {_clamped(points)}")


def habitability_class() -> Column:
    """Class of the column ``habitability_score``; no score means not habitable."""
    return first_match(CLASS_RULES, vocab.NON_HABITABLE)


def _alert_columns_sql() -> str:
    return ", ".join(first_match_sql(group) for group in ALERT_RULES)


def alert_groups() -> dict[str, tuple[Column, list[str]]]:
    """Per alert group: the code that a reading raises in it, and the codes it can raise."""
    return {
        f"alert_group_{i}": (first_match(group), [code for _, code in group])
        for i, group in enumerate(ALERT_RULES)
    }


def alert_codes() -> Column:
    """Alert codes of a reading as an array, empty when all is nominal."""
    return F.expr(f"array_compact(array({_alert_columns_sql()}))")


def raised_alerts() -> Column:
    """Alert codes joined into one text, empty when all is nominal."""
    return F.expr(own_method(f"concat_ws('{vocab.ALERT_SEPARATOR}', {_alert_columns_sql()})"))


def or_nominal(raised: str) -> Column:
    return F.expr(f"if({raised} = '', '{NO_ALERT}', {raised})")


def decode_label(prediction: str, labels: list[str]) -> Column:
    """Class index to label; NULL and any index outside the list become ``unknown``."""
    known = ", ".join(f"'{label}'" for label in labels)
    index = f"CAST({prediction} AS INT)"
    found = f"CASE WHEN {index} >= 0 THEN get(array({known}), {index}) END"
    return F.expr(f"coalesce({found}, '{vocab.UNKNOWN}')")
