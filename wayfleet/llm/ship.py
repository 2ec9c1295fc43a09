"""Get a session ready: the package on the executors, bounded batches between Spark and Python, no old shuffle files."""

from __future__ import annotations

from pyspark.sql import SparkSession

from wayfleet.session import ship_package

#: Bytes of a batch, in Spark's buffers and again in the Python worker, however long the texts are.
BATCH_BYTES = 8 << 20


def ship(spark: SparkSession) -> SparkSession:
    """Add the package as a Python file of the application and bound the batches.

    Shuffle files go when the write that needed them has ended; what goes on starts from written tables.
    """
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    ship_package(spark)
    return spark
