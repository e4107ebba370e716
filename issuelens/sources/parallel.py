"""Spread CPU-heavy text scans over the cluster when the files give too few tasks.

A parquet file is split by row groups; a table written as one row group is
scanned by one task, and every per-row regular expression after it then runs
on one core.  Inputs beyond ``MAX_BYTES`` are never reshuffled, nor those that
give enough tasks; only small under-split scans get a round-robin repartition
to the default parallelism.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

#: The most bytes (by Spark's own size estimate of the scan) that may be dealt anew.
MAX_BYTES = 256 << 20


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    if not hasattr(spark, "_jsparkSession"):    # a Spark Connect session exposes neither RDDs nor plan statistics
        return df
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    target = min_partitions or spark.sparkContext.defaultParallelism
    return df if size > MAX_BYTES or df.rdd.getNumPartitions() >= target else df.repartition(target)
