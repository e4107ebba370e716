"""Row positions and running sums inside groups that survive hot groups (used by S1, W1, W4, A14).

``row_number()`` over a window partitioned by the group puts a group that
holds a third of all rows into one task.  Here Spark's own range partitioning
on (group, order) deals the rows, so a hot group spans many partitions.  The
rows are written once with the number of their partition; what follows, and
every recomputation after a lost executor, reads the same table.  Each
(partition, group) is summed locally; the partitions' sums (at most one row
per partition and group) give each partition its offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def prefix_within(df: DataFrame, group_cols, order_cols, out: str, value: str | None = None,
                  num_chunks: int | None = None, kind: str = "bigint") -> DataFrame:
    """Per row the sum of ``value`` (rows, if None) over the rows before it in its group, as ``out`` (``kind``).

    ``order_cols`` must make the order total inside a group.  Rows whose group
    is NULL are a group like others; without ``group_cols`` the table is one
    group.  There are as many chunks as shuffle partitions unless
    ``num_chunks`` says otherwise.
    """
    return prefix_sums(df, group_cols, order_cols, {out: value}, num_chunks, kind)


def prefix_sums(df: DataFrame, group_cols, order_cols, sums: dict[str, str | None],
                num_chunks: int | None = None, kind: str = "bigint") -> DataFrame:
    """:func:`prefix_within` for several values at once: ``sums`` names the value (None: rows) of each new column."""
    group_cols, order_cols = list(group_cols), list(order_cols)
    n = num_chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunked = cut_lineage(df.repartitionByRange(n, *group_cols, *order_cols)
                          .withColumn("_chunk", F.spark_partition_id()))
    amounts = [F.lit(1) if value is None else F.coalesce(F.col(value), F.lit(0)) for value in sums.values()]
    before = Window.partitionBy("_chunk", *group_cols).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    local = chunked.select("*", *[F.coalesce(F.sum(a).over(before), F.lit(0)).alias(f"_lr{i}") for i, a in enumerate(amounts)])
    sizes = chunked.groupBy("_chunk", *group_cols).agg(*[F.sum(a).alias(f"_n{i}") for i, a in enumerate(amounts)])
    earlier = Window.partitionBy(*group_cols).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("_chunk").alias("_oc"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(group_cols)],
        *[F.coalesce(F.sum(f"_n{i}").over(earlier), F.lit(0)).alias(f"_off{i}") for i in range(len(amounts))])
    same = F.col("_chunk") == F.col("_oc")
    for i, c in enumerate(group_cols):
        same = same & F.col(c).eqNullSafe(F.col(f"_o{i}"))
    return local.join(offsets, same, "inner").select(
        *df.columns, *[(F.col(f"_lr{i}") + F.col(f"_off{i}")).cast(kind).alias(out) for i, out in enumerate(sums)])


def rank_within(df: DataFrame, group_cols, order_cols, out: str = "rank", num_chunks: int | None = None) -> DataFrame:
    """``row_number() over (partition by group_cols order by order_cols)`` as ``out`` (bigint)."""
    ranked = prefix_within(df, group_cols, order_cols, out, None, num_chunks)
    return ranked.withColumn(out, F.col(out) + F.lit(1).cast("bigint"))
