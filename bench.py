"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local threads.  Every query runs
up to twice to warm up and BENCH_RUNS times (default 3) for the median; the time covers building the
plan, size checks and execution.  Results go to the ``noop`` sink: all columns of all rows are
computed and nothing is collected.  The given tables have one row group each, so a scan and the
row work on top of it are one task; the message and rule timings read one file per thread.
"""

from __future__ import annotations

import contextlib
import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from heliotab.plans import telemetry  # noqa: E402
from heliotab.plans.queries import QUERIES  # noqa: E402
from heliotab.session import SETTINGS  # noqa: E402
from heliotab.sources import testbed, wire  # noqa: E402
from heliotab.streaming import streams  # noqa: E402
from heliotab.workspace import work_dir  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
BATCH = [
    "planet_table", "label_planets", "label_reasons", "system_summary", "labels_by_star",
    "radiation_ranking", "planets_by_orbit", "planets_with_system", "normalize_archive_all",
    "flatten_catalog", "feature_moments", "enrich_readings", "score_breakdown",
    "alert_counts", "sensor_range_check", "join_star_fallback", "classification_metrics",
]


def session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("heliotab-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", CPUS)
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def measure(action, runs: int = RUNS) -> float:
    """Median of up to ``runs`` runs after up to two warm-up runs; slow queries run less often."""

    def timed(limit: int, budget: float) -> list[float]:
        times: list[float] = []
        while len(times) < limit and sum(times) < budget:
            started = time.perf_counter()
            action()
            times.append(time.perf_counter() - started)
        return times

    timed(min(runs, 2), 10.0)
    return round(statistics.median(timed(runs, 15.0)), 3)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def python_rules(readings):
    """The same score and alerts as row-at-a-time Python functions, for comparison."""
    readings.sparkSession.sparkContext.addPyFile(os.path.join(ROOT, "tests", "brute.py"))
    import brute

    whole = F.struct("*")
    score = F.udf(lambda row: brute.score(row.asDict()), "double")
    alerts = F.udf(lambda row: brute.alerts(row.asDict()), "string")
    return readings.select("*", score(whole).alias("score"), alerts(whole).alias("alerts"))


def main() -> None:
    spark = session()
    seconds: dict[str, float] = {}
    for name in BATCH:
        seconds[name] = measure(lambda: drain(QUERIES[name](spark, SF_DIR)))
        print(name, seconds[name], file=sys.stderr, flush=True)

    # Messages as a topic would hold them: one file per thread.
    messages = work_dir(spark, "bench-topic")
    readings = telemetry.project_raw(testbed.readings(spark, SF_DIR))
    wire.encode(readings).repartition(int(CPUS)).write.parquet(messages)
    rows = spark.read.parquet(messages).count()

    spread = work_dir(spark, "bench-raw")
    readings.repartition(int(CPUS)).write.parquet(spread)
    raw = spark.read.parquet(spread)
    seconds["encode_wire"] = measure(lambda: drain(wire.decode(wire.encode(raw))))

    def stream():
        out = work_dir(spark, "bench-stream")
        enriched = streams.enriched_stream(streams.replay(spark, messages))
        query = streams.append_parquet(enriched, f"{out}/o", f"{out}/c", interval="once")
        streams.await_all(spark, [query])

    decoded = wire.decode(spark.read.parquet(messages))
    seconds["stream_enrich"] = measure(stream)
    seconds["decode_and_enrich_batch"] = measure(lambda: drain(telemetry.enrich(decoded, True)))
    seconds["train_predict"] = measure(lambda: drain(QUERIES["train_predict"](spark, SF_DIR)), 1)

    # Rules alone, on stored readings: native columns against Python functions.
    stored = work_dir(spark, "bench-readings")
    readings.repartition(int(CPUS)).write.parquet(stored)
    plain = spark.read.parquet(stored)
    native = measure(lambda: drain(telemetry.assess(plain)))
    python = measure(lambda: drain(python_rules(plain)), 1)
    seconds["rules_native"] = native
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "stream_rows_per_sec": round(rows / seconds["stream_enrich"]),
                "rules_python_udf_sec": python,
                "rules_speedup": round(python / native, 1),
            }
        )
    )


if __name__ == "__main__":
    with contextlib.suppress(BrokenPipeError):
        main()
