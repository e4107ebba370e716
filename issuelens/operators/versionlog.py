"""Whole code trees from a version log (J6, and tree identity for J4, J5, J9).

``versions(path, seq, blob_sha, deleted)`` says what became of a path at a
position of the log; (path, seq) is unique and ``seq`` grows with time.
``points(point_id, query_seq)`` are positions; no paths are listed.

* A version is valid from its ``seq`` up to the path's next one.  Valid spans
  meet points by an equi-join: a span falls into at most two aligned pieces of each
  power of two, and a point lies in exactly one piece of each size, so the
  pair (size, piece) is a key and nothing needs to be tested afterwards.  A grid
  with the first and last point of each cell drops most spans without a point before that.
* The digest of a tree is the sum of its entries' hashes, so a point's digest is a
  prefix sum over the log of what each version adds and takes away.  Equal
  trees are found without listing any, and each is listed and measured once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .joins import bounded_broadcast
from .ranking import prefix_sums, prefix_within
from .snapshots import versions_as_of

#: Hex digits of an entry's hash in each half of a digest (60 bits).
HALF = 15
#: The grid of points has 2 to this power cells at most.
GRID = 12


def _with_neighbour(versions: DataFrame, step: int, columns: dict[str, str]) -> DataFrame:
    """Numbered versions with columns of the path's version ``step`` further.

    The join is on (path, number), so a path with a third of all versions is dealt like any other rows.
    """
    other = versions.select("path", (F.col("_n") - step).alias("_n"), *[F.col(c).alias(out) for c, out in columns.items()])
    return versions.join(other, ["path", "_n"], "left")


def _numbered(versions: DataFrame) -> DataFrame:
    v = versions.select("path", F.col("seq").cast("bigint").alias("seq"), "blob_sha", F.coalesce("deleted", F.lit(False)).alias("deleted"))
    return cut_lineage(prefix_within(v, ["path"], ["seq"], "_n"))


def valid_spans(versions: DataFrame) -> DataFrame:
    """(path, blob_sha, seq, until): from where to before where a version is its path's; deletions are left out.

    ``until`` is NULL for what is still there.
    """
    spans = _with_neighbour(_numbered(versions), 1, {"seq": "until"})
    return spans.where(~F.col("deleted")).select("path", "blob_sha", "seq", "until")


def _pieces(start: str, end: str, levels: int) -> Column:
    """The aligned pieces (level, piece) that make up [start, end), in the manner of a segment tree."""
    one = f"""filter(flatten(transform(sequence(0, {levels}), k -> transform(
        array(struct(shiftright({start} + shiftleft(1L, k) - 1, k) as l, shiftright({end}, k) as r)), x -> array(
            if(x.l < x.r and x.l % 2 = 1, struct(k as level, x.l as piece), null),
            if(x.l < x.r and x.r % 2 = 1, struct(k as level, x.r - 1 as piece), null)))[0])), p -> p is not null)"""
    return F.expr(one)


def _met(spans: DataFrame, at: DataFrame, size: int) -> DataFrame:
    """``spans`` [_s, _e) without most of those that hold none of the points ``at`` (_at), all from 0 to before ``size``.

    A cell of the grid knows its first and last point and the first one behind
    it.  A span is kept if it begins in the stretch of its cell's points and
    ends behind their first, or if it reaches the next cell's point.
    """
    bits = max(0, size.bit_length() - GRID)
    found = at.groupBy(F.shiftright("_at", bits).alias("_cell")).agg(F.min("_at").alias("_lo"), F.max("_at").alias("_hi"))
    later = Window.orderBy("_cell").rowsBetween(1, Window.unboundedFollowing)
    grid = (spans.sparkSession.range((size >> bits) + 1).withColumnRenamed("id", "_cell").join(found, "_cell", "left")
            .withColumn("_next", F.min("_lo").over(later)))
    inside = (F.col("_s") <= F.col("_hi")) & (F.col("_e") > F.col("_lo"))
    return (spans.withColumn("_cell", F.shiftright("_s", bits)).join(F.broadcast(grid), "_cell")
            .where(inside | (F.col("_e") > F.col("_next"))).drop("_cell", "_lo", "_hi", "_next"))


def trees_at(versions: DataFrame, points: DataFrame, inclusive: bool = True) -> DataFrame:
    """The whole tree at every point: (columns of ``points``, path, blob_sha, seq), one row a live path.

    ``inclusive`` trees hold the version at the point itself (the tree after a
    commit), others only earlier ones (the tree before it).  A path that is
    deleted at a point gives no row, and so do points before the first version.
    """
    spans = cut_lineage(valid_spans(versions))
    low, high = spans.agg(F.min("seq"), F.max(F.greatest("seq", "until"))).first()
    out = [*points.columns, "path", "blob_sha", "seq"]
    if low is None:
        none = {c: F.lit(None).cast(spans.schema[c].dataType) for c in out[-3:]}
        return points.where(F.lit(False)).withColumns(none).select(*out)
    levels = (high - low + 1).bit_length()
    start, end = F.col("seq") - low, F.coalesce(F.col("until"), F.lit(high + 1)) - low
    # a point beyond the log sees its end; one before it sees nothing
    at = F.least(F.col("query_seq").cast("bigint") - (0 if inclusive else 1), F.lit(high)) - low
    asked = cut_lineage(points.withColumn("_at", at).where("_at >= 0"))
    held = _met(spans.withColumns({"_s": start, "_e": end}), asked, high - low + 1)
    held = held.withColumn("_p", F.explode(_pieces("_s", "_e", levels)))
    held = held.select("path", "blob_sha", "seq", F.col("_p.level").alias("_level"), F.col("_p.piece").alias("_piece"))
    asked = asked.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
    asked = asked.withColumn("_piece", F.expr("shiftright(_at, _level)")).drop("_at")
    return held.join(bounded_broadcast(asked), ["_level", "_piece"]).select(*out)


def _halves(path: str, blob: str) -> list[Column]:
    digest = F.md5(F.concat(F.col(path), F.lit("\0"), F.col(blob)).cast("binary"))
    return [F.conv(F.substring(digest, 1 + k * HALF, HALF), 16, 10).cast("bigint") for k in (0, 1)]


def tree_digests(versions: DataFrame, points: DataFrame, inclusive: bool = True) -> DataFrame:
    """(columns of ``points``, n_files, digest): equal digests mean equal trees; no tree is listed.

    The digest is the sum of the halves of md5(path, NUL, blob id) over the
    tree's entries.  Per position the differences are summed first, so a
    commit that touches a third of all paths is one row of the prefix sum.
    """
    v = _with_neighbour(_numbered(versions), -1, {"blob_sha": "_blob", "deleted": "_gone"})
    new = F.when(~F.col("deleted"), 1).otherwise(0)
    old = F.when(F.col("_gone") == F.lit(False), 1).otherwise(0)
    nothing = F.lit(0).cast("bigint")  # a difference of two halves of 60 bits is a bigint; their sums are not
    changes = [F.when(new == 1, a).otherwise(nothing) - F.when(old == 1, b).otherwise(nothing)
               for a, b in zip(_halves("path", "blob_sha"), _halves("path", "_blob"), strict=True)]
    names = ["_files", "_h1", "_h2"]
    steps = v.select("seq", *[c.cast("decimal(38,0)").alias(n) for c, n in zip([(new - old), *changes], names, strict=True)])
    steps = cut_lineage(steps.groupBy("seq").agg(*[F.sum(n).cast("decimal(38,0)").alias(n) for n in names]))
    before = prefix_sums(steps, [], ["seq"], {f"_before{n}": n for n in names}, kind="decimal(38,0)")
    steps = before.select("seq", *[(F.col(n) + F.col(f"_before{n}")).cast("decimal(38,0)").alias(n) for n in names])
    asked = points.withColumn("query_seq", F.col("query_seq").cast("bigint"))
    sums = cut_lineage(steps)
    known = versions_as_of(sums, asked, inclusive, keys=())
    known = known.select(*points.columns, F.col("_files").cast("bigint").alias("n_files"),
                         F.concat_ws(":", F.col("_h1").cast("string"), F.col("_h2").cast("string")).alias("digest"))
    first = sums.agg(F.min("seq")).first()[0]  # points before it see an empty tree
    early = asked if first is None else asked.where(F.col("query_seq") < first + (0 if inclusive else 1))
    return known.unionByName(early.select(*points.columns, F.lit(0).cast("bigint").alias("n_files"), F.lit("0:0").alias("digest")))


def distinct_trees(versions: DataFrame, points: DataFrame, inclusive: bool = True) -> tuple[DataFrame, DataFrame]:
    """(points with their ``digest``, files of each distinct tree: digest, path, blob_sha).

    What is measured per digest is joined back to the points, so trees that many points share are listed and measured once.
    """
    known = cut_lineage(tree_digests(versions, points, inclusive))
    once = known.groupBy("digest").agg(F.min("query_seq").alias("query_seq"))
    return known, trees_at(versions, once, inclusive).select("digest", "path", "blob_sha")
