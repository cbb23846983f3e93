"""Disk given back between the phases of a long operator."""

from __future__ import annotations

import gc

from pyspark.sql import SparkSession


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more.

    Spark does so when the driver's garbage is collected, which may otherwise come after
    the disks are full. Called between phases whose results are written. The plan that
    ran last is referred to until another one runs, so an empty one runs first.
    """
    spark.range(1).write.format("noop").mode("overwrite").save()
    gc.collect()
    spark.sparkContext._jvm.System.gc()
