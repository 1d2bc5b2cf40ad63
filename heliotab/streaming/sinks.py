"""Per-batch outputs.  Every one overwrites the folder of its query and batch id.

``foreachBatch`` may run a batch again after a failure; the repeated batch has the same id and
the same rows, so an overwrite leaves each row exactly once.  The query id belongs to the
checkpoint: a restart keeps it, and a new checkpoint, whose batches count from 0 again, writes
beside the output of earlier ones.  Failures stop the query instead of being swallowed: the batch
stays uncommitted and runs again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..plans import telemetry
from ..schemas import MODEL_COLUMNS
from ..sources.wire import STATE, count_states
from ..workspace import removed, work_dir
from .manifest import Manifest

BatchSink = Callable[[DataFrame, int], None]
CONSOLE_ROWS = 30
# Text outputs repeat their field names or separators in every row: compressed they are a tenth.  A
# compressed file is read by one task, so it ends after this many rows.
TEXT = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 500_000}


OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
ROW_OF_TASK = (1 << 33) - 1  # the bits of a monotonically increasing id that number the rows of a task
QUERY_ID = "sql.streaming.queryId"  # the property that a streaming query sets for its jobs
ALL_BATCHES = "run=*/batch=*"


def _run_of(batch: DataFrame) -> str:
    return batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID) or "none"


def _batch_folder(path: str, batch: DataFrame, batch_id: int, unit: str = "batch") -> str:
    return f"{path}/run={_run_of(batch)}/{unit}={batch_id}"


def _one_pass(path: str, whole: bool = False) -> Callable[[BatchSink], BatchSink]:
    """Mark a sink that reads its batch once and whole: alone it needs no stored batch.

    ``whole``: its folder is a parquet table of all columns, from which other sinks can read the batch.
    """

    def mark(sink: BatchSink) -> BatchSink:
        sink.one_pass, sink.whole = path, whole
        return sink

    return mark


def _counted(rows: DataFrame, write: Callable[[DataFrame], None]) -> dict[str, int]:
    """Write rows while they are computed, and count them and their message states in the same pass."""
    seen = Observation()
    write(rows.observe(seen, *count_states(rows)))
    return seen.get


def _write_directly(sink: BatchSink, batch: DataFrame, batch_id: int, stamped: Callable) -> dict[str, int]:
    """Compute a batch while a sink writes it; the folder of an empty batch is taken away.

    Counting comes before the processing time, which stays out of the code that computes the batch.
    """
    counts = _counted(batch, lambda rows: sink(stamped(rows), batch_id))
    if not counts["rows"]:
        removed(batch.sparkSession, _batch_folder(sink.one_pass, batch, batch_id))
    return counts


def parquet_sink(path: str) -> BatchSink:
    @_one_pass(path, whole=True)
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_batch_folder(path, batch, batch_id))

    return write


def raw_sink(path: str) -> BatchSink:
    """The reading as it arrived, without the derived columns."""
    write_parquet = parquet_sink(path)

    @_one_pass(path)
    def write(batch: DataFrame, batch_id: int) -> None:
        write_parquet(telemetry.project_raw(batch), batch_id)

    return write


def document_sink(path: str) -> BatchSink:
    """One JSON document per reading, written by the executors as compressed lines.

    Columns of a fitted pipeline are left out; insert time and batch id are added.
    """

    @_one_pass(path)
    def write(batch: DataFrame, batch_id: int) -> None:
        documents = batch.drop(*MODEL_COLUMNS).withColumns(
            {"_inserted_at": F.current_timestamp(), "_batch_id": F.lit(batch_id).cast("bigint")}
        )
        documents.write.mode("overwrite").options(**TEXT).json(_batch_folder(path, batch, batch_id))

    return write


def snapshot_sink(path: str) -> BatchSink:
    """A raw and a processed CSV per epoch, compressed; processed adds score, class and alerts.

    A processed line begins with the raw one, so a row's text is made once and one pass writes both.
    """
    derived = ["habitability_score", "habitability_class", "alerts"]
    per_file = TEXT["maxRecordsPerFile"]

    @_one_pass(path)
    def write(batch: DataFrame, epoch: int) -> None:
        names = telemetry.project_raw(batch).columns
        # The first row that a task writes to a file brings the header.
        first = F.monotonically_increasing_id().bitwiseAND(ROW_OF_TASK) % per_file == 0
        lines = batch.select(
            F.to_csv(F.struct(*names)).alias("raw"), F.to_csv(F.struct(*derived)).alias("more"), first.alias("first")
        )
        texts = {"raw": (names, F.col("raw")), "processed": ([*names, *derived], F.concat_ws(",", "raw", "more"))}
        both = F.array(*[
            F.struct(F.lit(name).alias("snapshot"), F.when(F.col("first"), F.concat(F.lit(",".join(header) + "\n"), line)).otherwise(line).alias("line"))
            for name, (header, line) in texts.items()
        ])
        folders = {name: _batch_folder(f"{path}/{name}", batch, epoch, "epoch") for name in texts}
        staging = f"{path}/_staging-{_run_of(batch)}-{epoch}"
        spark = batch.sparkSession
        usual = spark.conf.get(OPEN_FILES)
        spark.conf.set(OPEN_FILES, len(texts))  # a task keeps the files of both open: nothing is sorted
        try:
            rows = lines.select(F.explode(both).alias("_")).select("_.*")
            rows.write.mode("overwrite").partitionBy("snapshot").options(**TEXT).text(staging)
        finally:
            spark.conf.set(OPEN_FILES, usual)
        for name, folder in folders.items():
            _move_texts(spark, f"{staging}/snapshot={name}", folder, ".csv")
        removed(spark, staging)

    return write


def _move_texts(spark, source: str, folder: str, ending: str) -> None:
    """Replace ``folder`` by the text files of ``source``, with their ending; without a source nothing happens."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    start, end = path(source), path(folder)
    fs = start.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(start):
        return
    fs.delete(end, True)
    fs.mkdirs(end)
    for file in fs.listStatus(start):
        name = file.getPath().getName().replace(".txt", ending)
        if not fs.rename(file.getPath(), path(end, name)):
            raise OSError(f"cannot move {file.getPath()} to {folder}")
    fs.create(path(end, "_SUCCESS"), True).close()


def console_sink(rows: int = CONSOLE_ROWS) -> BatchSink:
    """Print the first rows of a batch; only these rows reach the driver."""

    def write(batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        telemetry.project_console(batch).show(rows, truncate=False)

    return write


def fan_out(sinks: Mapping[str, BatchSink], manifest: Manifest | None = None) -> BatchSink:
    """Feed one computation of a batch to all sinks; an empty batch writes nothing.

    All sinks see the same processing time, added after the computation if the batch has none.  The
    pass that computes the batch also counts its rows and the states of its messages.  With a
    ``manifest`` the batch is entered there when the last sink has it, empty batches too; a batch
    that is entered already is not written again.

    The batch is not held in memory.  A single sink that reads the batch once computes it while
    writing, and nothing is stored.  Of several sinks the first parquet sink does so, and the others read what
    it has written; without one the batch is stored in the shared folder until the last sink has it.
    """
    alone = next(iter(sinks.values())) if len(sinks) == 1 else None
    holder = alone if hasattr(alone, "one_pass") else next((s for s in sinks.values() if getattr(s, "whole", False)), None)

    def stamped(rows: DataFrame) -> DataFrame:
        clean = rows.drop(STATE)
        if "processed_at" in rows.columns:
            return clean
        return clean.withColumn("processed_at", F.lit(datetime.now(timezone.utc)))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, run = batch.sparkSession, _run_of(batch)
        if manifest and manifest.has(spark, run, batch_id):
            return
        table = None
        try:
            if holder:
                states = _write_directly(holder, batch, batch_id, stamped)
                kept = _batch_folder(holder.one_pass, batch, batch_id)
            else:
                kept = table = work_dir(spark, "batch")
                states = _counted(batch, lambda rows: stamped(rows).write.option("compression", "zstd").parquet(table))
            others = [sink for sink in sinks.values() if sink is not holder]
            if states["rows"] and others:
                whole = spark.read.schema(stamped(batch).schema).parquet(kept)
                for sink in others:
                    sink(whole, batch_id)
        finally:
            if table:
                removed(spark, table)
        if manifest:
            rows = states.pop("rows")
            manifest.commit(spark, run, batch_id, rows, states, list(sinks))

    return write
