"""The issue change tracker (the reference's third entry point), per issue and distributed.

For each issue: pick one of its commits, pick one file that commit changed,
list the commits that touched that file (its history), and pick one of those
revisions.  The reference does this for one issue with unseeded random
choices; here every issue is handled at once and each choice is reproducible:
commit and file are ``pick_one`` (smallest md5 of seed, issue and candidate).
The revisions of a picked path are numbered once, in sha order, and an issue
takes number ``md5(seed, issue, path) mod n``, so the work grows with issues
plus revisions, never with their product.  An issue without commits, or whose
picked commit changed no file, gives no row (the reference returns early).

Shuffles: linking (J1), one partial ``min_by`` per pick, the numbering (ranges
of the sort key, so a path touched by a third of all commits spans many tasks)
and two equi-joins with the picked paths.  What several steps read is written
once as a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import bounded_broadcast
from ..operators.linking import link_commits_to_issues
from ..operators.ranking import rank_within
from ..operators.sampling import pick_one
from ..session import cut_lineage


def draw_below(n, seed: str, *cols) -> F.Column:
    """A reproducible number from 0 to n - 1: the first 60 bits of md5(seed, cols) modulo n."""
    said = F.md5(F.concat_ws("\u0001", F.lit(seed), *[F.col(c).cast("string") for c in cols]))
    return F.conv(F.substring(said, 1, 15), 16, 10).cast("bigint") % n


def dealt(commits: DataFrame) -> DataFrame:
    """``commits`` in as many tasks as shuffles have.

    A commit has some ten links, and the pick sorts the links of a task: those
    of a whole split of the commit log would take gigabytes.
    """
    return commits.repartition(int(commits.sparkSession.conf.get("spark.sql.shuffle.partitions")), "sha")


def track_issue_changes(issues: DataFrame, commits: DataFrame, commit_files: DataFrame,
                        seed: str = "0") -> DataFrame:
    """(issue_id, commit_sha, file_path, revision_sha, n_history) per issue."""
    links = link_commits_to_issues(issues, dealt(commits.select("sha", "message")), keep_message=False)
    picked = cut_lineage(pick_one(links.select("issue_id", "sha"), ["issue_id"], "sha", seed))
    changed = commit_files.select("sha", "path").join(bounded_broadcast(picked), "sha", "inner")
    picked_file = cut_lineage(pick_one(changed.select("issue_id", "path", "sha"), ["issue_id"], "path", seed, carry=["sha"]))
    paths = picked_file.select("path").distinct()
    history = cut_lineage(commit_files.select("path", "sha").join(bounded_broadcast(paths), "path", "left_semi"))
    sizes = history.groupBy("path").agg(F.count(F.lit(1)).cast("bigint").alias("n_history"))
    numbered = rank_within(history, ["path"], ["sha"], "number").withColumnRenamed("sha", "revision_sha")
    drawn = (picked_file.join(sizes, "path", "inner")
             .withColumn("number", draw_below(F.col("n_history"), seed, "issue_id", "path") + 1))
    return drawn.join(numbered, ["path", "number"], "inner").select(
        "issue_id", F.col("sha").alias("commit_sha"), F.col("path").alias("file_path"), "revision_sha", "n_history")
