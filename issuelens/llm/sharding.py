"""Sharding (2): a hierarchical weighted hash tree of regions, racks and shards.

A row descends the tree: at each level every child draws ``-ln(u) / weight``
with ``u`` a hash of (key, child), and the smallest draw wins.  A child's
weight is the number of shards below it.  Draws of other children don't change
when one child's weight does, so a change of weight moves rows only between
that subtree and the rest.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, Window

from issuelens.llm.common import pick
from issuelens.session import cut_lineage


def topology(n_shards: int, regions: int = 4, racks: int = 3, per_rack: int = 2) -> list[list[list[int]]]:
    """Shards 0..n-1 as regions of racks of shards.

    The first ``regions * racks * per_rack`` shards fill the tree in order; a
    further shard opens a region of its own, as no rack has room for it.  So a
    shard added to a full tree takes rows only into itself.
    """
    tree, s = [], 0
    for _ in range(regions):
        region = []
        for _ in range(racks):
            rack = list(range(s, min(s + per_rack, n_shards)))
            s += len(rack)
            if rack:
                region.append(rack)
        if region:
            tree.append(region)
    return tree + [[[x]] for x in range(s, n_shards)]


def _draw(key: Column, level: str, node: Column, weight: Column) -> Column:
    """-ln(u) / weight with u in (0, 1) from 52 bits of the hash."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(level), key, node), 12).cast("double") + 0.5) / F.lit(float(1 << 52))
    return -F.log(u) / weight


def _choose(key: Column, level: str, children: Column) -> Column:
    """The child (a struct with id and weight) of the smallest draw; equal draws go to the smaller id."""
    drawn = F.transform(children, lambda c: F.struct(_draw(key, level, c["id"], c["weight"]).alias("draw"), c["id"].alias("id")))
    return F.array_min(drawn)["id"]


def _children(level: list[tuple[int, float]]) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("id"), F.lit(float(w)).alias("weight")) for i, w in level])


def shard_of(df: DataFrame, key: Column, n_shards: int, out: str, **shape: int) -> DataFrame:
    """Adds column ``out`` (int): the shard that ``key`` (a string without nulls) descends to."""
    tree = topology(n_shards, **shape)
    sizes = [[len(rack) for rack in region] for region in tree]
    df = df.withColumn(out, _choose(key, "region", _children([(i, sum(r)) for i, r in enumerate(sizes)])))
    racks = F.array(*[_children([(i * 1000 + j, w) for j, w in enumerate(r)]) for i, r in enumerate(sizes)])
    df = df.withColumn(out, _choose(key, "rack", F.get(racks, F.col(out))))
    flat = {i * 1000 + j: rack for i, region in enumerate(tree) for j, rack in enumerate(region)}
    shards = F.create_map(*[x for k, rack in flat.items() for x in (F.lit(k), _children([(s, 1) for s in rack]))])
    return df.withColumn(out, _choose(key, "shard", F.element_at(shards, F.col(out))).cast("int"))


def shard_documents(docs: DataFrame, n_shards: int = 24, **shape: int) -> DataFrame:
    """Every document's shard under the law ``key``, its place in the shard, and its shard with one more.

    The key is doc_id as text (null: the empty key), so repeated rows share a
    shard.  ``size`` is the text's UTF-8 bytes (null: none) plus 8 and
    ``text_crc32`` the unsigned crc32 of these bytes.  ``slot`` counts a
    shard's rows from 0 without gaps: rows are numbered within their input
    partition and shard, and each such run starts after the runs before it, so
    no task holds a shard.  Extra columns are ignored; an empty table gives an
    empty one.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.col("_key")
    d = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_key"),
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().alias("_row"),
    )
    d = shard_of(shard_of(d, key, n_shards, "shard", **shape), key, n_shards + 1, "grown_shard", **shape).drop("_key")
    d = cut_lineage(d)  # rows and their numbers stay as they are, whatever is run again
    runs = d.groupBy("_part", "shard").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("_part", "shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    place = F.row_number().over(Window.partitionBy("_part", "shard").orderBy("_row"))
    return (
        d.withColumn("_place", place)
        .join(runs, ["_part", "shard"])
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("_first") + F.col("_place") - 1).alias("slot"), "grown_shard")
    )
