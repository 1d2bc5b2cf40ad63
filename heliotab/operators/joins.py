"""Joins of a large table to a lookup table that is unique per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

BROADCAST_BYTES = 64 * 1024 * 1024
STRING_BYTES = 64  # what a name or code counts as
FIXED_BYTES = 8


def row_bytes(table: DataFrame) -> int:
    """Bytes of a row by its schema; all columns of the table count."""
    texts = sum(isinstance(f.dataType, StringType) for f in table.schema.fields)
    return STRING_BYTES * texts + FIXED_BYTES * (len(table.columns) - texts)


def lookup_join(
    big: DataFrame,
    lookup: DataFrame,
    key: str,
    rows: int,
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
    hashed: bool = False,
) -> DataFrame:
    """Join to a lookup table of ``rows`` rows: broadcast if that is small, else a shuffle.

    The caller counts the rows, in parquet tables from file footers.  Beyond the broadcast size
    this is a plain join: filters on ``big`` go through it to the scan, and adaptive execution
    splits the partitions of hot keys, and of rows without a key, by their measured size.
    ``hashed``: neither side is sorted; a partition of the lookup table has to fit into a task's memory.
    """
    if rows * row_bytes(lookup) <= max_bytes:
        lookup = F.broadcast(lookup)
    elif hashed:
        lookup = lookup.hint("shuffle_hash")
    return big.join(lookup, key, how)


def with_defaults(
    table: DataFrame, dimension: DataFrame, key: str, defaults: dict[str, object]
) -> DataFrame:
    """Left join to a fixed dimension; rows whose key it does not list get ``defaults``.

    For the literal dimensions only: they have at most eight rows by definition.
    """
    joined = table.join(F.broadcast(dimension.select(key, *defaults)), key, "left")
    return joined.na.fill(defaults)


def key_hash(key: str) -> Column:
    """A 32-bit hash of a text key that any SQL engine can recompute."""
    return F.conv(F.substring(F.md5(F.col(key)), 1, 8), 16, 10).cast("bigint")
