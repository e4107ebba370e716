"""Code trees from tree objects (S4): a tree lists names of blobs and of other trees.

``tree_objects(tree_sha, name, entry_type, child_sha)`` is what a repository
stores: a tree that many commits or folders share is there once.  Its measures
are therefore taken once as well, from the leaves up, and added wherever it is
referred to, as often as it is.  A tree without entries, or one that the table
doesn't hold, is empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_suffix
from ..session import cut_lineage
from .codemetrics import HALSTEAD_FIELDS
from .ranking import rank_within


def _folders(tree_objects: DataFrame) -> DataFrame:
    """(tree_sha, child_sha, times): how often a tree refers to another that has entries."""
    links = (tree_objects.where("entry_type = 'tree'").groupBy("tree_sha", "child_sha")
             .agg(F.count(F.lit(1)).alias("times")))
    held = tree_objects.select(F.col("tree_sha").alias("child_sha")).distinct()
    return cut_lineage(links.join(held, "child_sha", "left_semi"))


def subtree_sums(tree_objects: DataFrame, blob_values: DataFrame, suffixes=None) -> DataFrame:
    """(tree_sha, columns of ``blob_values``): sums over all blobs in and below each tree, once per distinct tree.

    ``blob_values`` holds blob_sha and numbers; a blob that it lacks (not
    text) adds nothing.  ``suffixes`` keeps blob entries by their names.  A
    round adds up the trees whose folders are all known, so there are as many
    rounds as folders are nested.  Trees without such blobs get sums of NULL.
    """
    values = [c for c in blob_values.columns if c != "blob_sha"]
    blobs = tree_objects.where("entry_type = 'blob'")
    if suffixes is not None:
        blobs = blobs.where(has_suffix("name", suffixes))
    # counted before they meet the measures: a tree may hold a blob under several names
    counted = blobs.groupBy("tree_sha", F.col("child_sha").alias("blob_sha")).agg(F.count(F.lit(1)).alias("_n"))
    own = (counted.join(blob_values, "blob_sha").groupBy("tree_sha")
           .agg(*[F.sum(F.col(c) * F.col("_n")).alias(c) for c in values]))
    folders = _folders(tree_objects)
    needed = folders.groupBy("tree_sha").agg(F.count(F.lit(1)).alias("_needed"))
    trees = tree_objects.select("tree_sha").distinct()
    todo = cut_lineage(trees.join(own, "tree_sha", "left").join(needed, "tree_sha", "left")
                       .withColumn("_needed", F.coalesce("_needed", F.lit(0))))
    done = cut_lineage(todo.where("_needed = 0").drop("_needed"))
    todo = cut_lineage(todo.where("_needed > 0"))
    while todo.limit(1).count():
        below = done.select(F.col("tree_sha").alias("child_sha"), *[F.col(c).alias(f"_b_{c}") for c in values])
        below = (folders.join(todo.select("tree_sha"), "tree_sha", "left_semi").join(below, "child_sha").groupBy("tree_sha")
                 .agg(F.count(F.lit(1)).alias("_known"), *[F.sum(F.col(f"_b_{c}") * F.col("times")).alias(f"_b_{c}") for c in values]))
        met = todo.join(below, "tree_sha").where("_known = _needed")
        ready = cut_lineage(met.select("tree_sha", *[F.coalesce(F.col(c) + F.col(f"_b_{c}"), F.col(c), F.col(f"_b_{c}")).alias(c) for c in values]))
        if not ready.limit(1).count():
            raise ValueError("a tree is part of itself")
        done = done.unionByName(ready)
        todo = cut_lineage(todo.join(ready.select("tree_sha"), "tree_sha", "left_anti"))
    return done


def tree_metrics(tree_objects: DataFrame, blob_metrics: DataFrame, suffixes=None) -> DataFrame:
    """A7-A11, A17, A18 of every tree: (tree_sha, LOC, Comments, CyclomaticComplexity, HalsteadMetrics, n_files, n_chars).

    ``blob_metrics`` comes from :func:`issuelens.operators.codemetrics.blob_metrics`.
    A tree without measured files has 0 files, lines and characters, and NULL for the rest.
    """
    b = blob_metrics.select(
        "blob_sha", "loc", "comments", "chars", F.lit(1).cast("bigint").alias("files"),
        F.col("cc").alias("cc"), F.col("cc").isNotNull().cast("bigint").alias("ccn"),
        F.col("halstead").isNotNull().cast("bigint").alias("hn"),
        *[F.col(f"halstead.{f}").alias(f) for f in HALSTEAD_FIELDS])
    s = subtree_sums(tree_objects, b, suffixes)
    zero = lambda c, out: F.coalesce(c, F.lit(0)).cast("bigint").alias(out)
    return s.select(
        "tree_sha", zero("loc", "LOC"), zero("comments", "Comments"),
        F.when(F.col("ccn") > 0, F.col("cc") / F.col("ccn")).alias("CyclomaticComplexity"),
        F.when(F.col("hn") > 0, F.struct(*[F.col(f).cast("bigint").alias(f) for f in HALSTEAD_FIELDS])).alias("HalsteadMetrics"),
        zero("files", "n_files"), zero("chars", "n_chars"))


def list_trees(tree_objects: DataFrame, roots: DataFrame, suffixes=None) -> DataFrame:
    """The files of the trees ``roots`` (tree_sha): (snapshot_sha, path, seq, entry_type, blob_sha).

    The table that J4, J5 and A14 read.  ``seq`` is the place in the
    reference's traversal: folder by folder, the upper ones first, in the
    order of names that trees are stored in.  A round opens one level of folders
    for all roots; blobs are filtered by ``suffixes`` before they are listed.
    """
    entries = cut_lineage(tree_objects.select("tree_sha", "name", "entry_type", "child_sha"))
    keep = F.col("entry_type") == "blob"
    if suffixes is not None:
        keep = keep & has_suffix("name", suffixes)
    folder = F.col("entry_type") == "tree"
    entries = entries.where(keep | folder)
    at = cut_lineage(roots.select("tree_sha").distinct().select(
        F.col("tree_sha").alias("snapshot_sha"), "tree_sha", F.lit("").alias("_prefix")))
    levels, depth = [], 0
    while at.limit(1).count():
        opened = cut_lineage(at.join(entries, "tree_sha").select(
            "snapshot_sha", F.concat("_prefix", "name").alias("path"), F.lit(depth).alias("_depth"), "entry_type", "child_sha"))
        levels.append(opened.where("entry_type = 'blob'"))
        at = opened.where("entry_type = 'tree'").select(
            "snapshot_sha", F.col("child_sha").alias("tree_sha"), F.concat("path", F.lit("/")).alias("_prefix"))
        depth += 1
    if not levels:
        levels = [at.select("snapshot_sha", F.col("_prefix").alias("path"), F.lit(0).alias("_depth"), F.lit("blob").alias("entry_type"), F.lit("").alias("child_sha"))]
    files = levels[0]
    for level in levels[1:]:
        files = files.unionByName(level)
    ranked = rank_within(files, ["snapshot_sha"], ["_depth", "path"], "seq")
    return ranked.select("snapshot_sha", "path", "seq", "entry_type", F.col("child_sha").alias("blob_sha"))
