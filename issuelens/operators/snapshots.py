"""Code trees of commits and file-version lookups.

Two input shapes are supported:

* full trees, as Git stores them: ``snapshot_files(snapshot_sha, path, seq,
  entry_type, blob_sha)`` + ``blobs(blob_sha, content)``.  A commit's tree is
  ``commits.tree`` (or the commit sha itself when there is no ``tree``
  column).  J4 / J5 are equi-joins; file contents stay in ``blobs`` and are
  only touched once per distinct blob by the metric operators.
* a version log ``file_versions(path, sha, seq, committed_date, content)``.
  J6 finds, for query points, the latest version at or before a position
  with a two-level as-of join that splits hot paths into seq chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import CODE_SUFFIXES_AFTER, CODE_SUFFIXES_BEFORE, decode_utf8, has_suffix, is_text
from ..session import cut_lineage
from .joins import bounded_broadcast, within_broadcast

#: Units of :func:`file_units` that a task gets, until there are so many tasks.
UNITS_A_TASK, MOST_TASKS = 1024, 10_000


def is_code_path_before(path) -> F.Column:
    """Suffix filter for the tree before an issue's first commit."""
    return has_suffix(path, CODE_SUFFIXES_BEFORE)


def is_code_path_after(path) -> F.Column:
    """Suffix filter for the tree after an issue's last commit (no .dart / .html)."""
    return has_suffix(path, CODE_SUFFIXES_AFTER)


def is_blob(entry_type) -> F.Column:
    """Only blob entries of a tree are files."""
    return F.col(entry_type) == "blob" if isinstance(entry_type, str) else entry_type == "blob"


def commit_trees(commits: DataFrame) -> DataFrame:
    """(sha, snapshot_sha): the tree id of each commit."""
    tree = F.col("tree") if "tree" in commits.columns else F.col("sha")
    return commits.select("sha", tree.alias("snapshot_sha"))


def before_snapshot(firsts: DataFrame, commits: DataFrame, parents_col: str = "first_parents",
                    out: str = "before_snapshot") -> DataFrame:
    """Tree of the *first parent* of each row's first commit.

    A root commit (no parents) or an unknown parent gives a NULL snapshot,
    i.e. an empty codebase.
    """
    parent = F.when(F.size(parents_col) > 0, F.element_at(parents_col, 1))
    trees = commit_trees(commits).withColumnRenamed("sha", "_parent")
    return (firsts.withColumn("_parent", parent)
            .join(trees, "_parent", "left")
            .withColumnRenamed("snapshot_sha", out).drop("_parent"))


def after_snapshot(lasts: DataFrame, commits: DataFrame, commit_col: str = "last_commit",
                   out: str = "after_snapshot") -> DataFrame:
    """Tree of each row's last commit; a missing tree gives an empty codebase."""
    trees = commit_trees(commits).withColumnRenamed("sha", commit_col)
    return lasts.join(trees, commit_col, "left").withColumnRenamed("snapshot_sha", out)


def tree_entries(snapshot_files: DataFrame, suffixes) -> DataFrame:
    """Blob entries of trees whose path ends with one of ``suffixes`` (P6 + P4)."""
    return snapshot_files.where(is_blob("entry_type") & has_suffix("path", suffixes))


def _parts(rows: DataFrame, trees: DataFrame, n_col: str, part: str, items: str) -> DataFrame:
    """(snapshot_sha, part, items): the rows of each tree in as many parts as ``trees`` says, dealt by their hash."""
    cols = [c for c in rows.columns if c != "snapshot_sha"]
    number = F.pmod(F.xxhash64(*cols), F.col(n_col)).alias(part)
    return (rows.join(bounded_broadcast(trees.select("snapshot_sha", n_col)), "snapshot_sha")
            .groupBy("snapshot_sha", number).agg(F.collect_list(F.struct(*cols)).alias(items)))


def file_units(rows: DataFrame, entries: DataFrame, snapshot_col: str, id_col: str = "issue_id",
               pack: int = 256, block: int = 64) -> DataFrame:
    """(snapshot_sha, _pack, _block, _ids, _files): every pack of a tree's ids with every block of its files.

    Spark holds all that one row is multiplied to in memory (a join's matches
    and an explode's rows alike, in one generated loop).  So ids and files are
    cut up first and a unit meets one pack and one block: about ``pack`` times
    ``block`` rows come of it, however large the tree.  The units are numbers
    only; they are dealt evenly over the tasks, a block's together, before the
    broadcast packs and blocks meet them (a side beyond the bound is shuffled).
    """
    spark = rows.sparkSession
    keys = cut_lineage(rows.where(F.col(snapshot_col).isNotNull()).select(F.col(snapshot_col).alias("snapshot_sha"), id_col))
    files = cut_lineage(entries.select("snapshot_sha", "path", "blob_sha"))
    count = lambda df, n, name: df.groupBy("snapshot_sha").agg(F.ceil(F.count(F.lit(1)) / n).alias(name))
    trees = cut_lineage(count(keys, pack, "_packs").join(count(files, block, "_blocks"), "snapshot_sha"))
    packs = cut_lineage(_parts(keys, trees, "_packs", "_pack", "_ids"))
    blocks = _parts(files, trees, "_blocks", "_block", "_files")
    units = packs.select("snapshot_sha", "_pack").join(bounded_broadcast(trees), "snapshot_sha").select(
        "snapshot_sha", "_pack", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_blocks") - 1)).alias("_block"))
    n_units = trees.agg(F.sum(F.col("_packs") * F.col("_blocks"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism,
            min(n_units // UNITS_A_TASK, MOST_TASKS))
    sides = [(packs, "_pack", within_broadcast(keys)), (blocks, "_block", within_broadcast(files))]
    for side, part, small in sides:
        units = units if small else units.join(side, ["snapshot_sha", part])
    order = ["snapshot_sha", "_block", "_pack"]
    units = units.repartitionByRange(n, *order).sortWithinPartitions(*order)
    for side, part, small in sides:
        units = units.join(F.broadcast(side), ["snapshot_sha", part]) if small else units
    return units


def named_files(rows: DataFrame, entries: DataFrame, snapshot_col: str, id_col: str = "issue_id",
                pack: int = 256, block: int = 64) -> DataFrame:
    """(id, snapshot_sha, path, blob_sha): the files of each row's tree; rows without a tree give none.

    As many rows as ids times files of their trees, so the work is dealt by
    what comes out, in :func:`file_units`.  Nothing as large as the result is
    shuffled, sorted or held, and a file's ids come out one after another, so
    columnar files keep each path once per pack.
    """
    return (file_units(rows, entries, snapshot_col, id_col, pack, block)
            .select("_ids", "snapshot_sha", F.explode("_files").alias("_file"))
            .select(F.explode("_ids").alias("_id"), "snapshot_sha", "_file")
            .select(f"_id.{id_col}", "snapshot_sha", "_file.path", "_file.blob_sha"))


def text_blobs(blobs: DataFrame) -> DataFrame:
    """P5: blobs that decode as UTF-8, with their text."""
    return (blobs.where(is_text("content"))
            .select("blob_sha", decode_utf8("content").alias("text")))


def codebase_files(snapshots: DataFrame, snapshot_files: DataFrame, blobs: DataFrame, suffixes,
                   snapshot_col: str = "snapshot_sha") -> DataFrame:
    """Files (path, seq, blob_sha, text) of the trees named in ``snapshots``.

    ``snapshots`` holds at least ``snapshot_col``; other columns are kept, so
    an issue table with a tree column yields the issue's codebase.
    """
    keys = snapshots.where(F.col(snapshot_col).isNotNull())
    entries = tree_entries(snapshot_files, suffixes).withColumnRenamed("snapshot_sha", snapshot_col)
    files = keys.join(entries, snapshot_col, "inner")
    return files.join(text_blobs(blobs), "blob_sha", "inner")


# ---------------------------------------------------------------------------
# Version logs.

def _asof(versions: DataFrame, queries: DataFrame, keys, inclusive: bool, chunk: int) -> DataFrame:
    """Latest version per query at or before (inclusive) / before ``query_seq``.

    Level 1 resolves a query against versions of the same key inside its own
    seq chunk (window over (key, chunk)).  Level 2 resolves the rest against
    the last version of earlier chunks: chunk summaries come from a
    partial-aggregated ``max_by`` and that window runs over at most two rows
    per (key, chunk), so a path with a third of all versions is still spread
    over many tasks.  Query rows travel as a struct, so no synthetic id (and
    no join back) is needed and recomputation after a lost executor is exact.
    """
    keys = list(keys)
    vcols = [c for c in versions.columns if c not in keys]
    vstruct = F.struct(*[F.col(c) for c in vcols])
    qstruct = F.struct(*[F.col(c) for c in queries.columns])
    # Equal positions: an inclusive query sees the version, an exclusive one does not.
    v_tag, q_tag = (0, 1) if inclusive else (1, 0)
    v = versions.select(*keys, F.col("seq").alias("_pos"), F.floor(F.col("seq") / chunk).alias("_chunk"),
                        F.lit(v_tag).alias("_tag"), vstruct.alias("_v"))
    q = queries.select(*keys, F.col("query_seq").alias("_pos"),
                       F.floor(F.col("query_seq") / chunk).alias("_chunk"),
                       F.lit(q_tag).alias("_tag"), qstruct.alias("_q"))
    both = (v.withColumn("_q", F.lit(None).cast(q.schema["_q"].dataType))
            .unionByName(q.withColumn("_v", F.lit(None).cast(v.schema["_v"].dataType))))
    w1 = (Window.partitionBy(*keys, "_chunk").orderBy("_pos", "_tag")
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = (both.withColumn("_best", F.last("_v", ignorenulls=True).over(w1))
             .where(F.col("_q").isNotNull())
             .select(*keys, "_chunk", "_q", "_best"))
    summaries = (versions.select(*keys, F.floor(F.col("seq") / chunk).alias("_chunk"), F.col("seq"),
                                 vstruct.alias("_v"))
                 .groupBy(*keys, "_chunk").agg(F.max_by("_v", "seq").alias("_v"))
                 .withColumn("_tag", F.lit(1)))
    # A pending query must not see the summary of its own chunk: it sorts first.
    pending = (local.where(F.col("_best").isNull()).select(*keys, "_chunk").distinct()
               .withColumn("_v", F.lit(None).cast(summaries.schema["_v"].dataType))
               .withColumn("_tag", F.lit(0)))
    w2 = (Window.partitionBy(*keys).orderBy("_chunk", "_tag")
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carry = (summaries.unionByName(pending)
             .withColumn("_carry", F.last("_v", ignorenulls=True).over(w2))
             .where(F.col("_tag") == 0).select(*keys, "_chunk", "_carry"))
    resolved = (local.join(carry, keys + ["_chunk"], "left")
                .select("_q", F.coalesce("_best", "_carry").alias("_hit"))
                .where(F.col("_hit").isNotNull()))
    extra = [c for c in vcols if c not in queries.columns]
    return resolved.select(*[F.col(f"_q.{c}").alias(c) for c in queries.columns],
                           *[F.col(f"_hit.{c}").alias(c) for c in extra])


def versions_as_of(versions: DataFrame, queries: DataFrame, inclusive: bool = True,
                   keys=("path",), chunk: int = 1 << 16) -> DataFrame:
    """J6 (per-path form): for each query row (keys, query_seq, ...), the latest version.

    Queries keep all their columns; version columns are added (inner: queries
    with no version at that point produce no row, as for a file that does not
    exist yet).
    """
    return _asof(versions, queries, keys, inclusive, chunk)


def snapshot_as_of(file_versions: DataFrame, points: DataFrame, inclusive: bool = True,
                   chunk: int = 1 << 16) -> DataFrame:
    """The tree of every point: per path, the latest version before / up to it.

    ``points(point_id, query_seq, path)`` lists the (point, path) pairs to
    resolve -- the paths of a tree are an input (e.g. the paths seen in the
    log up to a point), because a version log alone cannot say which files a
    tree holds without pairing every point with every path.
    """
    return versions_as_of(file_versions, points, inclusive=inclusive, keys=("path",), chunk=chunk)


def file_history(file_versions: DataFrame, paths: DataFrame) -> DataFrame:
    """Every version of the given paths, newest first.

    The ordering is a global range-partitioned sort on (path, seq desc), so a
    path with very many versions is split across tasks.
    """
    return (file_versions.join(paths.select("path").distinct(), "path", "left_semi")
            .orderBy(F.col("path"), F.col("seq").desc()))


def file_content_at(file_versions: DataFrame, lookups: DataFrame) -> DataFrame:
    """Content of (path, sha) pairs decoded as UTF-8; absent or binary -> no row."""
    hit = lookups.join(file_versions.select("path", "sha", "content"), ["path", "sha"], "inner")
    return hit.where(is_text("content")).withColumn("content", decode_utf8("content"))
