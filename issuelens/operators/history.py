"""The log of the commits that a head reaches (S1), from a commit table with any number of branches.

A walk along parents takes as many steps as the history is long, so the graph
is cut into *lines* first: a commit and its first parent follow each other on
a line when the parent has no other child that continues it.  A commit's place
on its line comes from pointer doubling, in a logarithmic number of rounds.

From there on, a walk passes a line in one step.  Reaching a place on a line reaches all
places below it, so what is known of a line is the highest place reached, and
a round goes from lines to lines across merges and branch points.

The order of the log is by *corrected date* (the generation number of commit
graphs): the commit's own date, or one second more than the greatest corrected date
of its parents, if that is later.  So a commit comes before its parents, whatever the
clocks said, and dates that never run backwards are their own corrected dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .ranking import prefix_within

#: Places of a line that one window row range covers; longer lines are split over tasks.
CHUNK = 1 << 16
#: A missing date: before all others.
NO_DATE = -(1 << 53)


def _numbered(commits: DataFrame) -> DataFrame:
    """(id, sha, parents, date): one row a sha, with a number that is written and so stays."""
    date = F.coalesce(F.unix_seconds(F.col("committed_date").cast("timestamp")), F.lit(NO_DATE))
    rows = commits.select("sha", "parents", date.alias("date")).dropDuplicates(["sha"])
    return cut_lineage(rows.withColumn("id", F.monotonically_increasing_id()))


def _edges(nodes: DataFrame) -> DataFrame:
    """(child, parent, nth): links to parents that the table holds, each parent once a child."""
    links = nodes.select(F.col("id").alias("child"), F.posexplode("parents").alias("nth", "_sha"))
    ids = nodes.select(F.col("id").alias("parent"), F.col("sha").alias("_sha"))
    return cut_lineage(links.join(ids, "_sha").groupBy("child", "parent").agg(F.min("nth").alias("nth")))


def _lines(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, line, pos): each commit's line, named by its top commit, and how far below the top it is.

    Pointer doubling: a pointer up the line, and how far it goes, is joined with the pointer where it ends.
    Unfinished pointers of one round all end at different commits, so no join has a hot key.
    """
    follows = edges.where("nth = 0").groupBy("parent").agg(F.min("child").alias("up"))
    state = cut_lineage(nodes.select("id").join(follows, F.col("id") == F.col("parent"), "left").select(
        "id", F.coalesce("up", "id").alias("up"), F.when(F.col("up").isNull(), 0).otherwise(1).cast("bigint").alias("dist"),
        F.col("up").isNull().alias("done")))
    rounds = nodes.count().bit_length()  # no line is longer than all commits
    while state.where("not done").limit(1).count():
        if not rounds:
            raise ValueError("a commit is its own ancestor")
        rounds -= 1
        there = state.select(F.col("id").alias("up"), F.col("up").alias("_up"), F.col("dist").alias("_dist"), F.col("done").alias("_done"))
        moved = state.where("not done").join(there, "up").select(
            "id", F.col("_up").alias("up"), (F.col("dist") + F.col("_dist")).alias("dist"), F.col("_done").alias("done"))
        state = cut_lineage(state.where("done").unionByName(moved))
    return state.select("id", F.col("up").alias("line"), F.col("dist").alias("pos"))


def _crossings(edges: DataFrame, places: DataFrame) -> DataFrame:
    """(child, line, pos, parent, to_line, to_pos): links that don't lead to the next place of a line."""
    child = places.select(F.col("id").alias("child"), "line", "pos")
    parent = places.select(F.col("id").alias("parent"), F.col("line").alias("to_line"), F.col("pos").alias("to_pos"))
    ends = edges.select("child", "parent").join(child, "child").join(parent, "parent")
    return cut_lineage(ends.where("line <> to_line or to_pos <> pos + 1"))


def _reached(crossings: DataFrame, starts: DataFrame) -> DataFrame:
    """(line, at): the highest place of each line that a walk from ``starts`` (line, at) reaches."""
    # places from ``at`` to ``below`` are news of the last round
    state = cut_lineage(starts.groupBy("line").agg(F.min("at").alias("at")).withColumn("below", F.lit(None).cast("bigint")))
    while True:
        news = state.where("below is null or at < below")
        if not news.limit(1).count():
            return state.select("line", "at")
        over = (crossings.join(news, "line").where("pos >= at and (below is null or pos < below)")
                .groupBy(F.col("to_line").alias("line")).agg(F.min("to_pos").alias("_to")))
        known = state.select("line", F.col("at").alias("below"))
        state = cut_lineage(known.join(over, "line", "full_outer").select("line", F.least("below", "_to").alias("at"), "below"))


def _along(places: DataFrame, chunk: int) -> DataFrame:
    """``places`` (id, line, pos, base) with ``cd``: the greatest base below or at a place, plus the steps to it.

    A maximum that runs up a line, first over its chunks' maxima, then inside each chunk.
    """
    p = places.withColumn("_c", F.floor(F.col("pos") / chunk)).withColumn("_v", F.col("base") + F.col("pos"))
    below = Window.partitionBy("line").orderBy(F.desc("_c")).rowsBetween(Window.unboundedPreceding, -1)
    carry = p.groupBy("line", "_c").agg(F.max("_v").alias("_m")).withColumn("_carry", F.max("_m").over(below)).drop("_m")
    inside = Window.partitionBy("line", "_c").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, 0)
    top = F.greatest(F.max("_v").over(inside), F.col("_carry"))
    return p.join(carry, ["line", "_c"]).withColumn("cd", top - F.col("pos")).select("id", "line", "pos", "base", "cd")


def _corrected(places: DataFrame, crossings: DataFrame, chunk: int) -> DataFrame:
    """(id, cd): corrected dates of ``places`` (id, line, pos, base), a set that holds its commits' ancestors.

    A round takes all lines at once; there is another only while a date across a link is out of order.
    """
    while True:
        dated = cut_lineage(_along(places, chunk))
        parent = dated.select(F.col("id").alias("parent"), (F.col("cd") + 1).alias("least"))
        late = crossings.select("child", "parent").join(parent, "parent").groupBy("child").agg(F.max("least").alias("least"))
        late = cut_lineage(dated.join(late, F.col("id") == F.col("child")).where("least > cd").select("id", "least"))
        if not late.limit(1).count():
            return dated.select("id", "cd")
        places = dated.join(late, "id", "left").select("id", "line", "pos", F.greatest("base", "least").alias("base"))


def reachable_log(commits: DataFrame, heads: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The commits that ``heads`` (sha) reach, newest first: all columns of ``commits`` and a new ``seq``.

    ``commits`` needs sha, parents and committed_date; it may hold any
    branches.  ``seq`` counts from 0 by descending corrected date, then sha.
    Rows of one sha are one commit; parents that the table doesn't hold (a
    shallow export) end a walk; unknown heads reach nothing; a commit without a
    date is older than all that have one, but for its descendants.  The number of
    rounds grows with the logarithm of the longest line and with the number of
    merges and branch points that a walk crosses, not with the history's length.
    """
    nodes = _numbered(commits)
    edges = _edges(nodes)
    places = cut_lineage(_lines(nodes, edges))
    crossings = _crossings(edges, places)
    starts = nodes.select("id", "sha").join(heads.select("sha").distinct(), "sha").join(places, "id").select("line", F.col("pos").alias("at"))
    reached = _reached(crossings, starts)
    seen = places.join(reached, "line").where("pos >= at").select("id", "line", "pos")
    seen = cut_lineage(seen.join(nodes.select("id", F.col("date").alias("base")), "id"))
    dates = _corrected(seen, crossings.join(seen.select(F.col("id").alias("child")), "child", "left_semi"), chunk)
    log = dates.join(nodes.select("id", "sha"), "id").select((-F.col("cd")).alias("_age"), "sha")
    placed = prefix_within(log, [], ["_age", "sha"], "_seq").select("sha", F.col("_seq").alias("seq"))
    kept = [c for c in commits.columns if c != "seq"]
    return commits.dropDuplicates(["sha"]).select(*kept).join(placed, "sha").select(*kept, "seq")
