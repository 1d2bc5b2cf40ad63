"""Publish a table of readings as keyed JSON messages.

    spark-submit --packages <topic connector> -m heliotab.jobs.publish \\
        --readings /tables/readings --servers broker:9092 --topic planet_sensors
"""

from __future__ import annotations

import argparse

from ..plans import telemetry
from ..schemas import SENSOR_READING
from ..session import job_session
from ..sources import topic, wire


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--readings", required=True, help="parquet table with the 33 columns")
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--servers", help="brokers of the topic")
    target.add_argument("--replay", help="folder to append parquet messages to")
    parser.add_argument("--topic", default="planet_sensors")
    options = parser.parse_args()
    spark = job_session("heliotab-publish")
    readings = telemetry.project_raw(spark.read.schema(SENSOR_READING).parquet(options.readings))
    if options.servers:
        topic.write_topic(readings, options.servers, options.topic)
    else:
        wire.encode(readings).write.mode("append").parquet(options.replay)


if __name__ == "__main__":
    main()
