"""CSV files read by header name, with a report of what could not be read.

The header decides where a column is.  Values are cast one by one; a value that is no value of its
type, and a line with too few or too many fields, are kept as problems of the row instead of passing
for missing data or stopping the scan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

PROBLEMS, RECORD = "_problems", "_record"
BROKEN_LINE = "line"


class HeaderError(ValueError):
    """The header lacks a needed column, or names one twice."""


def _header(spark: SparkSession, path: str, comment: str | None) -> list[str]:
    reader = spark.read.option("header", True)
    return (reader.option("comment", comment) if comment else reader).csv(path).columns


def _resolved(header: list[str], schema: StructType, defaults: Mapping[str, object], path: str) -> dict[str, str | None]:
    """For each field the header's column, or None where a default stands for it."""
    places: dict[str, list[str]] = {}
    for name in header:
        places.setdefault(name.strip().lower(), []).append(name)
    found = {f.name: places.get(f.name.lower(), []) for f in schema.fields}
    missing = [n for n, at in found.items() if not at and n not in defaults]
    # Spark numbers repeated names: ``mass`` twice becomes ``mass0`` and ``mass3``.
    twice = [n for n in missing if sum(h[: len(n)].lower() == n.lower() and h[len(n) :].isdigit() for h in header) > 1]
    if twice or any(len(at) > 1 for at in found.values()):
        raise HeaderError(f"{path}: columns named twice: {sorted(twice or [n for n, at in found.items() if len(at) > 1])}")
    if missing:
        raise HeaderError(f"{path}: columns missing: {sorted(missing)}; the header has {header}")
    return {n: at[0] if at else None for n, at in found.items()}


def scan(
    spark: SparkSession,
    path: str,
    schema: StructType,
    defaults: Mapping[str, object] | None = None,
    problems: bool = False,
    comment: str | None = None,
) -> DataFrame:
    """The columns of ``schema``, found by name in the header of the files of ``path``.

    Columns of the file that the schema does not name are not parsed further.  A column that the header
    lacks takes its value of ``defaults``; without one the scan raises ``HeaderError``.  All files of
    a folder must have the header of the first: another order or name is an error when it is read.

    A value that is not of the column's type becomes NULL.  With ``problems`` the rows also have
    ``_problems``, the names of such columns and ``line`` for a line with a wrong number of fields, in
    the order of the schema and empty for a clean row, and ``_record``, the whole line where it is broken.
    """
    defaults = defaults or {}
    header = _header(spark, path, comment)
    at = _resolved(header, schema, defaults, path)
    text = StructType([*[StructField(name, StringType()) for name in header], StructField(RECORD, StringType())])
    reader = (
        spark.read.schema(text)
        .option("header", True)
        .option("enforceSchema", False)  # each file's header is compared with these names
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RECORD)
    )
    if problems:
        reader = reader.option("columnPruning", False)  # else a broken line goes unseen where few columns are used
    rows = (reader.option("comment", comment) if comment else reader).csv(path)

    def value(f: StructField) -> Column:
        if at[f.name] is None:
            return F.lit(defaults[f.name]).cast(f.dataType)
        given = F.col(f"`{at[f.name]}`")
        return given if isinstance(f.dataType, StringType) else given.try_cast(f.dataType)

    columns = [value(f).alias(f.name) for f in schema.fields]
    if not problems:
        return rows.select(*columns)
    lost = [
        F.when(F.col(f"`{at[f.name]}`").isNotNull() & value(f).isNull(), F.lit(f.name))
        for f in schema.fields
        if at[f.name] is not None and not isinstance(f.dataType, StringType)
    ]
    broken = F.when(F.col(RECORD).isNotNull(), F.lit(BROKEN_LINE))
    return rows.select(*columns, F.array_compact(F.array(*lost, broken)).alias(PROBLEMS), RECORD)


def clean_rows(scanned: DataFrame) -> DataFrame:
    """Rows of a scan with ``problems`` that have none."""
    return scanned.where(F.size(PROBLEMS) == 0).drop(PROBLEMS, RECORD)


def rejected_rows(scanned: DataFrame) -> DataFrame:
    """Rows that have a problem, with what the problem is."""
    return scanned.where(F.size(PROBLEMS) > 0)


def problem_counts(scanned: DataFrame) -> DataFrame:
    """``problem, n``: rows for each kind of problem, and ``none``."""
    kinds = F.when(F.size(PROBLEMS) == 0, F.array(F.lit("none"))).otherwise(F.col(PROBLEMS))
    return scanned.select(F.explode(kinds).alias("problem")).groupBy("problem").agg(F.count(F.lit(1)).alias("n"))
