"""What the tasks of this package need: the package itself on every executor, small Arrow batches."""

from __future__ import annotations

import io
import os
import zipfile

from pyspark.sql import SparkSession

import heliotab
from heliotab.workspace import work_dir

BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 500

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Write the package as a zip to the shared folder and add it to the job, once per job.

    Arrow batches of whole texts are kept to ``BATCH_ROWS`` rows where the session has Spark's
    default of 10,000, which would be tens of megabytes at several places of each task.
    """
    if spark.conf.get(BATCH_SETTING) == "10000":
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    root = os.path.dirname(os.path.abspath(heliotab.__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.join("heliotab", os.path.relpath(path, root)))
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{work_dir(spark, 'package')}/heliotab.zip")
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    try:
        out.write(bytearray(packed.getvalue()))
    finally:
        out.close()
    context.addPyFile(target.toString())
    _sent.add(context.applicationId)
