"""Enrich a stream of readings and feed all sinks.

    spark-submit --packages <topic connector> -m heliotab.jobs.stream \\
        --servers broker:9092 --topic planet_sensors --checkpoint hdfs:///checkpoints/readings \\
        --raw s3a://raw/readings --processed hdfs:///out --processed s3a://results \\
        --documents hdfs:///documents --model hdfs:///models/planets --interval "20 seconds"
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from .. import storage
from ..plans import training
from ..session import job_session
from ..sources import topic
from ..streaming import manifest, progress, sinks, streams


def chosen_sinks(options) -> dict[str, sinks.BatchSink]:
    named = {}
    if options.console:
        named["console"] = sinks.console_sink()
    if options.raw:
        named["raw"] = sinks.raw_sink(options.raw)
    for i, path in enumerate(options.processed):
        named[f"processed{i}"] = sinks.parquet_sink(path)
    if options.documents:
        named["documents"] = sinks.document_sink(options.documents)
    if options.snapshots:
        named["snapshots"] = sinks.snapshot_sink(options.snapshots)
    return named


def run(spark: SparkSession, messages: DataFrame, options) -> None:
    model = training.load_model(spark, *options.model) if options.model else None
    entries = manifest.Manifest(options.manifest) if options.manifest else None
    stream = streams.enriched_stream(messages, model, options.wording, stamp=False, audit=entries is not None)
    named = chosen_sinks(options)
    with progress.recorded(spark) as log:
        if options.separate:
            queries = streams.to_separate_queries(stream, named, options.checkpoint, options.interval)
        else:
            queries = [
                streams.to_sinks(stream, named, options.checkpoint, "readings", options.interval, entries)
            ]
        try:
            streams.await_all(spark, queries)
        finally:
            log.wait([q.runId for q in queries if not q.isActive], timeout=10)
            if options.progress:
                log.table(spark).coalesce(1).write.mode("append").json(options.progress)


def parse(arguments: list[str] | None = None):
    parser = argparse.ArgumentParser()
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="brokers of the topic")
    source.add_argument("--replay", help="folder of parquet messages (key, value)")
    parser.add_argument("--topic", default="planet_sensors")
    parser.add_argument("--starting", default="latest")
    parser.add_argument("--max-offsets", type=int, default=topic.MAX_OFFSETS, help="messages of a batch")
    parser.add_argument("--max-files", type=int, default=streams.MAX_FILES, help="replay files of a batch")
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--interval", help="'20 seconds', 'once', or as fast as possible")
    parser.add_argument("--model", action="append", default=[])
    parser.add_argument("--raw")
    parser.add_argument("--processed", action="append", default=[])
    parser.add_argument("--documents")
    parser.add_argument("--snapshots")
    parser.add_argument("--manifest", help="folder of the entries of complete batches")
    parser.add_argument("--progress", help="folder for a record of batches, ends and failures")
    parser.add_argument("--console", action="store_true")
    parser.add_argument("--separate", action="store_true", help="one query per sink")
    parser.add_argument("--wording", action="store_true", help="existing wording in and out")
    options = parser.parse_args(arguments)
    if options.manifest and options.separate:
        parser.error("--manifest is about batches that one query writes to all sinks: not with --separate")
    return options


def main() -> None:
    options = parse()
    spark = job_session("heliotab-stream", storage.object_store_conf_from(os.environ))
    if options.servers:
        messages = topic.read_topic(
            spark, options.servers, options.topic, starting_offsets=options.starting,
            max_offsets_per_trigger=options.max_offsets,
        )
    else:
        messages = streams.replay(spark, options.replay, options.max_files)
    run(spark, messages, options)


if __name__ == "__main__":
    main()
