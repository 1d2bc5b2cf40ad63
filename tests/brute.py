"""Score, alerts and label of one row in plain Python: the yardstick for the compiled rules.

Each band is (test, points); the first test that holds counts, and None passes no test.
"""

from math import inf


def between(low, high):
    return lambda x: low <= x <= high


def above(limit):
    return lambda x: x > limit


BANDS = {
    "in_hz_int": [(between(1, 1), 20)],
    "avg_temp_celsius": [(between(-10, 50), 20), (between(-30, 65), 10), (between(-60, 80), 3)],
    "stellar_flux": [(between(0.25, 1.5), 15), (between(0.1, 3), 7), (between(-inf, 8), 2)],
    "atmosphere_o2": [(between(18, 25), 15), (between(12, 30), 8), (between(5, inf), 3)],
    "has_water_int": [(between(1, 1), 10)],
    "surface_radiation_msv_h": [
        (between(-inf, 0.1), 10), (between(-inf, 0.5), 6), (between(-inf, 2), 2),
        (between(-inf, 5), -5),
    ],
    "atmosphere_n2": [(between(70, inf), 5), (between(40, inf), 2)],
    "atmosphere_co2": [(above(10), -15), (above(5), -8), (above(2), -3)],
    "gravity_g": [(between(0.7, 1.5), 3), (between(0.4, 2.5), 1), (lambda x: x < 0.4, -10)],
    "humidity_pct": [(between(20, 80), 5), (between(10, inf), 2)],
    "seismic_activity": [(between(8, inf), -15), (between(6, inf), -8), (between(4, inf), -3)],
    "wind_speed_kmh": [(above(500), -15), (above(200), -5)],
}
TYPE_BONUS = {"ocean": 5, "terrestrial": 3, "super_earth": 1}


def _holds(value, test):
    return value is not None and test(value)


def score(row: dict) -> float:
    get = row.get
    eliminated = (
        get("habitable_candidate_int") == 0
        or _holds(get("stellar_flux"), above(10))
        or _holds(get("surface_radiation_msv_h"), above(5))
        or _holds(get("avg_temp_celsius"), lambda t: t < -80 or t > 80)
        or get("retains_atmosphere_int") == 0
        or (get("tidally_locked_int") == 1 and get("magnetic_field_int") == 0)
    )
    if eliminated:
        return 0.0
    total = 0.0
    for name, bands in BANDS.items():
        total += next((p for test, p in bands if _holds(get(name), test)), 0)
    if get("magnetic_field_int") == 1:
        total += 10
    elif get("tidally_locked_int") == 1:
        total -= 10
    if get("vegetation_index") is not None:
        total += min(5, get("vegetation_index") * 5)
    total += TYPE_BONUS.get(get("planet_type"), 0)
    return round(max(0.0, min(100.0, total)), 1)


def score_class(value: float) -> str:
    if value >= 60:
        return "habitable"
    return "uncertain" if value >= 30 else "non_habitable"


ALERTS = [
    ("temperature_c", [(above(80), "TEMP_HIGH"), (lambda t: t < -80, "TEMP_LOW")]),
    ("surface_radiation_msv_h", [(above(5), "RAD_LETHAL"), (above(2), "RAD_HIGH")]),
    ("seismic_activity", [(between(7, inf), "QUAKE")]),
    ("wind_speed_kmh", [(above(400), "STORM")]),
    ("atmosphere_o2", [(lambda x: x < 5, "O2_LOW")]),
    ("stellar_flux", [(above(10), "FLUX_FATAL")]),
    ("tidally_locked_int", [(between(1, 1), "TIDAL_LOCK")]),
]


def alerts(row: dict) -> str:
    raised = []
    for name, checks in ALERTS:
        raised += [code for test, code in checks if _holds(row.get(name), test)][:1]
    return " | ".join(raised) or "NOMINAL"


def label_rule(row: dict) -> str:
    temp, flux, rad = row["avg_temp_celsius"], row["stellar_flux"], row["surface_radiation_msv_h"]
    checks = [
        (not row["habitable_candidate_int"], "r1"),
        (temp < -80 or temp > 80, "r2"),
        (flux > 10, "r3"),
        (rad > 5, "r4"),
        (row["star_age_gy"] < row["min_age_gy"], "r5"),
        (row["lifespan_gy"] < 1, "r6"),
        (not row["retains_atmosphere_int"], "r7"),
        (row["tidally_locked_int"] and not row["magnetic_field_int"], "r8"),
        (not row["in_hz_int"], "r9"),
        (
            -10 <= temp <= 50 and 0.25 <= flux <= 1.5 and row["atmosphere_o2"] >= 15
            and row["atmosphere_n2"] >= 50 and row["has_water_int"] and row["magnetic_field_int"]
            and rad <= 0.5 and row["star_age_gy"] >= 2 and 0.4 <= row["gravity_g"] <= 2.5
            and row["atmosphere_co2"] <= 5,
            "habitable",
        ),
        (
            (row["has_water_int"] or row["in_hz_int"]) and row["atmosphere_o2"] >= 5
            and rad <= 2 and -30 <= temp <= 70,
            "uncertain",
        ),
        (True, "r10"),
    ]
    return next(rule for holds, rule in checks if holds)
