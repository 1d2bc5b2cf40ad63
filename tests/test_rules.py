"""Every threshold just below, at, just above, and missing, against the plain Python rules."""

import brute
import pytest
from pyspark.sql import functions as F

from heliotab import vocab
from heliotab.functions import habitability
from heliotab.plans import catalog, telemetry
from heliotab.schemas import SENSOR_READING
from heliotab.sources import terms, wire

GOOD = {
    "planet_type": "terrestrial", "temperature_c": 20.0, "avg_temp_celsius": 20.0,
    "gravity_g": 1.0, "stellar_flux": 1.0, "surface_radiation_msv_h": 0.05,
    "wind_speed_kmh": 50.0, "vegetation_index": 0.4, "humidity_pct": 50.0,
    "seismic_activity": 1.0, "atmosphere_o2": 21.0, "atmosphere_co2": 1.0, "atmosphere_n2": 78.0,
    "has_water_int": 1, "magnetic_field_int": 1, "in_hz_int": 1, "tidally_locked_int": 0,
    "retains_atmosphere_int": 1, "habitable_candidate_int": 1,
}
LIMITS = {
    "temperature_c": [-80, 80],
    "avg_temp_celsius": [-80, -60, -30, -10, 50, 65, 80],
    "stellar_flux": [0.1, 0.25, 1.5, 3, 8, 10],
    "surface_radiation_msv_h": [0.1, 0.5, 2, 5],
    "atmosphere_o2": [5, 12, 15, 18, 25, 30],
    "atmosphere_n2": [40, 50, 70],
    "atmosphere_co2": [2, 5, 10],
    "gravity_g": [0.4, 0.7, 1.5, 2.5],
    "humidity_pct": [10, 20, 80],
    "seismic_activity": [4, 6, 7, 8],
    "wind_speed_kmh": [200, 400, 500],
    "vegetation_index": [0, 0.5, 1, 1.2],
}
FLAGS = [name for name in GOOD if name.endswith("_int")]
STEP = 1e-9


def _edge_rows():
    rows = [dict(GOOD), {}]
    for name, limits in LIMITS.items():
        for limit in limits:
            rows += [GOOD | {name: float(limit) + d} for d in (-STEP, 0.0, STEP)]
        rows.append(GOOD | {name: None})
    for name in FLAGS:
        rows += [GOOD | {name: value} for value in (0, 1, None)]
    for locked in (0, 1, None):
        for magnetic in (0, 1, None):
            rows.append(GOOD | {"tidally_locked_int": locked, "magnetic_field_int": magnetic})
    rows += [GOOD | {"planet_type": kind} for kind in [*vocab.PLANET_TYPES, "unlisted", None]]
    bad = {"stellar_flux": 12.0, "seismic_activity": 9.0, "wind_speed_kmh": 900.0}
    rows.append(GOOD | bad | {"temperature_c": 99.0, "tidally_locked_int": 1, "atmosphere_o2": 1.0})
    rows.append({name: 0 if name in FLAGS else None for name in GOOD})
    # A row whose positive terms exceed the upper bound, and one far below the lower bound.
    rows.append(GOOD | {"planet_type": "ocean", "vegetation_index": 9.0})
    rows.append({"seismic_activity": 9.0, "wind_speed_kmh": 900.0, "atmosphere_co2": 50.0})
    return rows


def _frame(spark, rows):
    values = [
        (i, *[row.get(f.name) for f in SENSOR_READING.fields]) for i, row in enumerate(rows)
    ]
    schema = "id int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SENSOR_READING)
    return spark.createDataFrame(values, schema)


def test_enrichment_at_every_threshold(spark):
    rows = _edge_rows()
    enriched = telemetry.enrich(_frame(spark, rows)).orderBy("id").collect()
    for row, got in zip(rows, enriched, strict=True):
        expected = brute.score(row)
        assert got.habitability_score == expected, row
        assert got.habitability_class == brute.score_class(expected), row
        assert got.alerts == brute.alerts(row), row


def test_breakdown_adds_up(spark):
    rows = _edge_rows()
    broken = telemetry.score_breakdown(_frame(spark, rows)).collect()
    assert len(broken) == len(rows)
    for got in broken:
        points = sum(v for k, v in got.asDict().items() if k.startswith("pts_"))
        total = 0.0 if got.eliminated_by else max(0.0, min(100.0, points))
        assert got.habitability_score == pytest.approx(total, abs=0.05)
        assert got.habitability_score == brute.score(rows[got.id])


def test_no_value_stands_for_a_match(spark):
    """The stand-in of a missing measure passes no rule that reads it."""
    frame = _frame(spark, [{}])
    got = telemetry.score_breakdown(frame).first().asDict()
    assert {v for k, v in got.items() if k.startswith("pts_")} == {0.0}
    assert got["eliminated_by"] is None and got["habitability_score"] == 0.0


def test_nan_is_missing(spark):
    nan = float("nan")
    measures = [name for name in LIMITS if name != "vegetation_index"]
    rows = [GOOD | {name: nan} for name in measures]
    frame = wire.nan_to_null(_frame(spark, rows))
    for name, got in zip(measures, telemetry.enrich(frame).orderBy("id").collect(), strict=True):
        assert got.habitability_score == brute.score(GOOD | {name: None})
        assert got.alerts == brute.alerts(GOOD | {name: None})


def test_alert_codes_match_the_text(spark):
    frame = _frame(spark, _edge_rows())
    coded = frame.withColumn("codes", habitability.alert_codes())
    both = telemetry.with_alerts(coded).selectExpr("codes", "alerts AS text")
    for got in both.collect():
        assert " | ".join(got.codes) == ("" if got.text == "NOMINAL" else got.text)


LABEL_GOOD = {
    "habitable_candidate_int": 1, "avg_temp_celsius": 20.0, "stellar_flux": 1.0,
    "surface_radiation_msv_h": 0.1, "star_age_gy": 4.0, "min_age_gy": 1.0, "lifespan_gy": 10.0,
    "retains_atmosphere_int": 1, "tidally_locked_int": 0, "magnetic_field_int": 1, "in_hz_int": 1,
    "has_water_int": 1, "atmosphere_o2": 20.0, "atmosphere_n2": 78.0, "atmosphere_co2": 1.0,
    "gravity_g": 1.0,
}
LABEL_LIMITS = {
    "avg_temp_celsius": [-80, -30, -10, 50, 70, 80],
    "stellar_flux": [0.25, 1.5, 10],
    "surface_radiation_msv_h": [0.5, 2, 5],
    "star_age_gy": [1, 2],
    "lifespan_gy": [1],
    "atmosphere_o2": [5, 15],
    "atmosphere_n2": [50],
    "atmosphere_co2": [5],
    "gravity_g": [0.4, 2.5],
}


def test_labels_at_every_threshold(spark):
    rows = [dict(LABEL_GOOD)]
    for name, limits in LABEL_LIMITS.items():
        for limit in limits:
            rows += [LABEL_GOOD | {name: limit + d} for d in (-STEP, 0.0, STEP)]
    for name in [n for n in LABEL_GOOD if n.endswith("_int")]:
        rows.append(LABEL_GOOD | {name: 0})
        rows.append(LABEL_GOOD | {name: 0, "tidally_locked_int": 1})
    schema = "id int, " + ", ".join(
        f"{n} {'int' if n.endswith('_int') else 'double'}" for n in LABEL_GOOD
    )
    frame = spark.createDataFrame(
        [(i, *map(lambda n: row[n] if n.endswith("_int") else float(row[n]), LABEL_GOOD))
         for i, row in enumerate(rows)], schema,
    )
    seen = set()
    for row, got in zip(rows, catalog.with_label(frame).orderBy("id").collect(), strict=True):
        rule = brute.label_rule(row)
        seen.add(rule)
        assert got.label_rule == rule, row
        assert got.label == (rule if rule in ("habitable", "uncertain") else "non_habitable")
    assert {"r1", "r2", "r3", "r4", "r5", "r6", "r7", "r8", "r9", "habitable", "uncertain"} <= seen


def test_decode_label_bounds(spark):
    frame = spark.createDataFrame([(x,) for x in (0.0, 1.0, 2.0, 3.0, -1.0, None)], "p double")
    decoded = frame.select(habitability.decode_label("p", ["a", "b", "c"])).collect()
    assert [r[0] for r in decoded] == ["a", "b", "c", "unknown", "unknown", "unknown"]


def test_wording_round_trip(spark):
    frame = spark.createDataFrame(
        [(s, p) for s in vocab.STAR_TYPES for p in vocab.PLANET_TYPES] + [("x", None)],
        "star_type string, planet_type string",
    )
    there = terms.to_wording(frame)
    assert there.filter(F.col("star_type") == "Naine rouge").count() == len(vocab.PLANET_TYPES)
    assert sorted(map(str, terms.to_codes(there).collect())) == sorted(map(str, frame.collect()))


def test_alert_wording(spark):
    enriched = telemetry.enrich(_frame(spark, [GOOD, GOOD | {"temperature_c": 99.0, "atmosphere_o2": 1.0}]))
    texts = [r.alerts for r in terms.to_wording(enriched).orderBy("id").collect()]
    assert texts == ["✅ RAS", "🔥 TEMPERATURE CRITIQUE | 😮 O2 INSUFFISANT"]
