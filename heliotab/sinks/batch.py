"""Batch outputs.  Each replaces an earlier one only when it is complete (``staged``)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from .staged import replace


def write_parquet(df: DataFrame, *paths: str) -> None:
    """Replace the result of every destination by the same rows.

    The rows are computed for the first destination only; the others copy its files, so a large
    result is neither computed again nor held on the executors.
    """
    spark = df.sparkSession
    first, *others = paths
    replace(spark, first, df.write.parquet)
    for path in others:
        written = spark.read.schema(df.schema).parquet(first)
        replace(spark, path, written.write.parquet)


def write_csv(df: DataFrame, path: str) -> None:
    replace(df.sparkSession, path, df.write.option("header", True).csv)


def write_reports(reports: Mapping[str, DataFrame], path: str) -> None:
    """Every report whole, as CSV in a folder of its name."""
    for name, report in reports.items():
        write_csv(report, f"{path}/{name}")
