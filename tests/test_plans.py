"""What the physical plans must look like."""

import contextlib
import io
import re

import pytest

from heliotab.operators import joins
from heliotab.plans import catalog, reports, telemetry
from heliotab.plans.queries import QUERIES
from heliotab.session import SETTINGS
from heliotab.schemas import SENSOR_READING
from heliotab.sources import terms, testbed, wire

HOT_PATHS = [
    "enrich_readings", "score_breakdown", "alert_counts", "sensor_range_check",
    "join_star_fallback", "planet_table", "label_reasons", "system_summary",
    "classification_metrics", "temperature_residual", "composition_units",
]


def _explain(df, mode="formatted"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


@pytest.mark.parametrize("name", HOT_PATHS)
def test_rules_stay_in_the_jvm(spark, sf_dir, name):
    plan = _explain(QUERIES[name](spark, sf_dir))
    assert "Python" not in plan and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["enrich_readings", "sensor_range_check", "join_star_fallback"])
def test_row_work_needs_no_shuffle(spark, sf_dir, name):
    assert not re.search(r"(?<!Broadcast)Exchange hash", _explain(QUERIES[name](spark, sf_dir)))


def test_only_needed_columns_are_read(spark, sf_dir):
    plan = _explain(QUERIES["alerts"](spark, sf_dir))
    scan = next(line for line in plan.splitlines() if "ReadSchema" in line and "l_orderkey" in line)
    assert "l_tax" not in scan and "l_returnflag" not in scan and "l_quantity" in scan


def test_filters_reach_the_scan(spark, sf_dir):
    readings = testbed.readings(spark, sf_dir).filter("l_orderkey = 7")
    assert "EqualTo(l_orderkey,7)" in _explain(telemetry.enrich(readings))


def test_filters_reach_the_scan_beyond_the_broadcast_size(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(joins, "row_bytes", lambda table: 1 << 50)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        readings = testbed.readings(spark, sf_dir).filter("l_orderkey = 7")
        plan = _explain(telemetry.enrich(readings))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "EqualTo(l_orderkey,7)" in plan and "SortMergeJoin" in plan


def test_few_jobs_before_a_plan_is_ready(spark, sf_dir):
    context = spark.sparkContext
    context.setJobGroup("planning", "planning")
    try:
        QUERIES["system_summary"](spark, sf_dir)
        # One count of the systems, which adaptive execution runs as two jobs.
        assert len(context.statusTracker().getJobIdsForGroup("planning")) <= 2
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_top_rows_are_taken_without_a_full_sort(spark, sf_dir):
    planets = testbed.planets(spark, sf_dir)
    assert "TakeOrderedAndProject" in _explain(reports.radiation_ranking(planets))
    archive = testbed.archive(spark, sf_dir)
    assert "TakeOrderedAndProject" in _explain(catalog.normalize_archive(archive, 30))


def test_counts_are_combined_before_the_shuffle(spark, sf_dir):
    plan = _explain(QUERIES["system_summary"](spark, sf_dir), "simple")
    assert "partial_count" in plan


def _message_plans(spark, sf_dir):
    readings = telemetry.project_raw(testbed.readings(spark, sf_dir))
    messages = wire.encode(readings)
    decoded = wire.decode(messages, audit=True)
    yield telemetry.enrich(wire.decode(messages), True)
    yield telemetry.assess(decoded, True)
    yield telemetry.project_console(telemetry.with_model(telemetry.enrich(decoded), None))
    yield terms.to_wording(telemetry.assess(terms.to_codes(decoded), True))
    yield telemetry.with_stellar_physics(spark, wire.decode(messages))
    yield telemetry.with_sensor_ranges(spark, decoded)


PLANS = [
    *HOT_PATHS, "alerts", "alert_codes", "assess_nan", "atmosphere_retention", "batch_report", "enrich_readings_wording",
    "equilibrium_temperature", "feature_moments", "fill_planet_defaults", "filter_labelled", "flags_to_int", "habitability_class",
    "habitability_score", "hash_split", "hz_interval_join", "label_distribution", "label_planets", "labels_by_planet_type",
    "labels_by_star", "normalize_archive", "normalize_archive_all", "planets_by_orbit", "planets_with_system", "predict_without_model",
    "profile_counts", "project_raw_readings", "radiation_ranking", "report_candidates", "size_class", "stellar_flux",
    "stratified_folds", "surface_radiation", "tidal_lock",
]


def test_all_generated_methods_can_be_compiled(spark, sf_dir):
    """The JVM does not compile methods above 8000 bytes of bytecode; no plan has one."""
    limit = int(SETTINGS["spark.sql.codegen.hugeMethodLimit"])
    assert limit == 8000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plans = {n: QUERIES[n](spark, sf_dir) for n in PLANS}
        plans |= {f"messages {i}": df for i, df in enumerate(_message_plans(spark, sf_dir))}
        texts = {n: _explain(df, "codegen") for n, df in plans.items()}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = {n: max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", text)), default=0) for n, text in texts.items()}
    assert {n: size for n, size in sizes.items() if size >= limit} == {}
    assert sizes["enrich_readings"] > 3000 and sizes["messages 0"] > 3000


def test_long_rules_have_methods_of_their_own(spark, sf_dir):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = _explain(telemetry.assess(spark.createDataFrame([], SENSOR_READING), True), "codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(set(re.findall(r"private void (project_subExpr_\d+)", text))) >= 2
