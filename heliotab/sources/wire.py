"""Readings as keyed JSON messages."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..schemas import SENSOR_READING


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN compares greater than any number in Spark; as NULL it triggers no rule."""
    return df.select(
        *[
            F.nanvl(F.col(f.name), F.lit(None)).alias(f.name)
            if isinstance(f.dataType, DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


# What a message can be: read whole, read but for fields of a wrong type, nothing of it readable, no
# value at all.
MESSAGE_STATES = ["intact", "mismatched", "malformed", "missing"]
STATE = "_message"
_CORRUPT = "_corrupt"


def decode(
    messages: DataFrame,
    schema: StructType = SENSOR_READING,
    audit: bool = False,
    only: Collection[str] | None = None,
) -> DataFrame:
    """Message values to flat columns.

    Every message gives one row: a malformed one is all NULL, a value of the wrong type is NULL
    in its field only.  ``only``: the fields that are read, for a consumer that uses no others; these are
    passed over in the text and NULL.  ``audit``, always of all fields, adds the column ``_message`` with the state of the message.
    """
    text = F.col("value").cast("string")
    if not audit:
        read = StructType([f for f in schema.fields if only is None or f.name in only])
        values = {f.name: F.col(f"d.`{f.name}`") if f in read.fields else F.lit(None).cast(f.dataType) for f in schema.fields}
        parsed = messages.select(F.from_json(text, read).alias("d"))
        return nan_to_null(parsed.select(*[value.alias(name) for name, value in values.items()]))
    whole = StructType([*schema.fields, StructField(_CORRUPT, StringType())])
    parsed = F.from_json(text, whole, {"columnNameOfCorruptRecord": _CORRUPT})
    rows = messages.select(text.isNull().alias("_none"), parsed.alias("d")).select("_none", "d.*")
    state = (
        F.when(F.col("_none"), "missing")
        .when(F.col(_CORRUPT).isNull(), "intact")
        .when(F.coalesce(*[F.col(f"`{f}`").isNotNull() | F.lit(None) for f in schema.names], F.lit(False)), "mismatched")
        .otherwise("malformed")
    )
    # The greatest of the value and itself: in a method of its own, see rules.own_method.
    return nan_to_null(rows.withColumn(STATE, F.greatest(state, state)).drop("_none", _CORRUPT))


def count_states(rows: DataFrame) -> list[Column]:
    """Counts of rows in all (``rows``) and in each message state; no state column counts as intact."""
    known = STATE in rows.columns
    counts = [F.count_if(F.col(STATE) == s) if known else F.count_if(F.lit(s == "intact")) for s in MESSAGE_STATES]
    return [F.count("*").alias("rows"), *[c.alias(s) for c, s in zip(counts, MESSAGE_STATES, strict=True)]]


def state_counts(rows: DataFrame) -> dict[str, int]:
    """The counts of ``count_states``, in one pass."""
    return rows.agg(*count_states(rows)).first().asDict()


def encode(readings: DataFrame, key: str = "planet_name", beside: Sequence[str] = ()) -> DataFrame:
    """Rows to messages: key plus the whole row as JSON, NULL fields included.

    Columns named ``beside`` stay as columns too, so that nobody parses a message again for them.
    """
    whole = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return readings.select(F.col(key).alias("key"), whole.alias("value"), *beside)


def iso_timestamp(wall_clock: Column) -> Column:
    """A UTC wall-clock timestamp (without zone) to ISO-8601 text."""
    text = F.replace(wall_clock.cast("string"), F.lit(" "), F.lit("T"))
    return F.concat(text, F.lit("+00:00"))


def with_event_time(readings: DataFrame) -> DataFrame:
    """Parse the ISO text of a reading; text that is no timestamp gives NULL."""
    return readings.withColumn("event_time", F.expr("try_to_timestamp(timestamp)"))
