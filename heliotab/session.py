"""Session settings for jobs.  The master, memory and storage come from the submitter."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

SETTINGS = {
    # The JVM does not compile methods above 8000 bytes of bytecode.  Rule sets can generate such
    # methods; Spark then uses one generated class per operator, which is compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Split hot shuffle partitions and merge small ones at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def job_session(name: str, extra: Mapping[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
