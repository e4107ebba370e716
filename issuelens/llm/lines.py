"""Line dedup (12): levelled sorted runs of line hashes.

Documents come in batches, those of the greatest ids first.  A run is a table
of line hashes, sorted, each with the greatest document that holds the line
and the number of documents that do.  A new batch is merge-anti-joined with
the runs: lines that they already know to be in enough documents are settled
and not added again; the others become the batch's own run on level 0.  When
a level has ``fanout`` runs, they are merged into one of the next level, so a
line is written again a logarithmic number of times.

The runs name the lines that go and the document that keeps each.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
import pyspark.sql.functions as F
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql.types import StructType

from issuelens.llm.common import pick, small_batches, staged

#: The white space that is stripped from a line's ends.
BLANKS = " \t\n\v\f\r"
#: Stands for a missing id: one document before all others.
FIRST = -(1 << 63)


def line_key(line: str, min_chars: int) -> bytes | None:
    """128-bit hash of the line without white space at its ends and with A-Z in lower case; None if it is too short."""
    s = line.strip(BLANKS)
    return xxhash.xxh3_128_digest(s.encode("utf-8", "surrogatepass").lower()) if len(s) >= min_chars else None


class LineRuns:
    """Levels of runs: tables (key, last, n) in the shared folder, each of sorted files.

    ``last`` is the greatest document with the line and ``n`` the number of
    documents among the run's own batches.  Batches are added from the
    greatest documents down, and all lines of a document with one batch.
    """

    def __init__(self, min_docs: int = 3, fanout: int = 4):
        self.min_docs, self.fanout = min_docs, fanout
        self.levels: list[list[DataFrame]] = []

    def runs(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    def _merge(self, runs: list[DataFrame]) -> DataFrame:
        # rows of a run are one a line, so a line that is everywhere is one row a run
        both = reduce(DataFrame.unionByName, runs)
        return both.groupBy("key").agg(F.max("last").alias("last"), F.sum("n").alias("n"))

    def add(self, pairs: DataFrame) -> None:
        """A batch of distinct (key, doc): lines that aren't settled become a run; full levels are compacted."""
        own = pairs.groupBy("key").agg(F.max("doc").alias("last"), F.count(F.lit(1)).alias("n"))
        for run in self.runs():
            settled = run.where(F.col("n") >= self.min_docs).select("key")
            own = own.join(settled.hint("merge"), "key", "left_anti")
        self._put(0, own)

    def _put(self, level: int, run: DataFrame) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(staged(run.sortWithinPartitions("key")))
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._put(level + 1, self._merge(full))

    def repeated(self) -> DataFrame:
        """(key, last) of the lines that are in enough documents."""
        return self._merge(self.runs()).where(F.col("n") >= self.min_docs).select("key", "last")


def _batch_of(doc: Column, bounds: list[int]) -> Column:
    """0 for the documents above all bounds, one more for each bound that isn't below the document."""
    return reduce(lambda n, b: n + (doc <= F.lit(b)).cast("int"), bounds, F.lit(0))


def line_pairs(docs: DataFrame, min_chars: int, bounds: list[int]) -> DataFrame:
    """Distinct (key, doc, batch) of all lines of at least ``min_chars`` code points, written by batch."""

    def run(batches):
        for b in batches:
            keys, ends = [], [0]
            for text in b.column("_text").to_pylist():
                own = {line_key(s, min_chars) for s in text.split("\n")} if text and len(text) >= min_chars else set()
                own.discard(None)
                keys.extend(own)
                ends.append(len(keys))
            held = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys, pa.binary()))
            yield pa.RecordBatch.from_arrays([held.flatten(), b.column("_doc").take(held.value_parent_indices())], names=["key", "doc"])

    pairs = docs.select("_doc", "_text").mapInArrow(run, "key binary, doc long").distinct()
    return staged(pairs.withColumn("batch", _batch_of(F.col("doc"), bounds)), "batch")


def dedup_lines(docs: DataFrame, carry: tuple[str, ...] = (), min_chars: int = 20, min_docs: int = 3, batches: int = 8, fanout: int = 4) -> DataFrame:
    """Per document: doc_id, the columns ``carry``, n_lines, n_dropped, kept_text.

    Texts are split at \\n; a line's key is the line without white space
    (``[\\x20\\x09-\\x0D]``) at its ends and with A-Z in lower case.  A key of
    at least ``min_chars`` code points that ``min_docs`` documents hold loses all its lines but those
    of the greatest doc_id.  Other lines stay as they are, joined by \\n.

    Null and empty texts are one empty line.  Rows of one doc_id count as one
    document, and so do the rows without an id, which come before all others;
    repeated rows give a row each.  Columns that aren't named are ignored; an
    empty table gives an empty one.  A line in a third of all documents is one
    row a scan task once it is counted, and its rows are joined with the one
    that it has in the runs, which Spark splits.  ``batches`` and ``fanout``
    change the work, not the result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    carry = tuple(c for c in carry if c != "doc_id")
    d = pick(docs, "doc_id", "text", *(c for c in carry if c != "text"))
    d = d.select(F.col("doc_id").cast("long").alias("doc_id"), *carry, F.col("text").alias("_text"))
    d = d.withColumn("_doc", F.coalesce("doc_id", F.lit(FIRST)))
    cuts = d.agg(F.percentile_approx("_doc", [1 - k / batches for k in range(1, batches)], 10_000)).first()[0] or []
    pairs = line_pairs(d, min_chars, sorted(set(cuts), reverse=True))
    runs = LineRuns(min_docs, fanout)
    for k in range(len(set(cuts)) + 1):
        runs.add(pairs.where(F.col("batch") == k).select("key", "doc"))
    # tables of their own and merge joins at any size, so that the joins are of plain shuffles, which Spark splits at a hot line or document
    repeated = staged(runs.repeated()).hint("merge")
    lost = pairs.join(repeated, "key").where("doc < last")
    lost = staged(lost.groupBy("doc").agg(F.collect_list("key").alias("_lost")))

    handed = ("doc_id", *carry)
    types = StructType(list(d.select(*handed).schema.fields)).add("n_lines", "long").add("n_dropped", "long").add("kept_text", "string")

    def cut(batches):
        for b in batches:
            n_lines, n_dropped, kept = [], [], []
            for text, lost in zip(b.column("_text").to_pylist(), b.column("_lost").to_pylist(), strict=True):
                lines = (text or "").split("\n")
                n_lines.append(len(lines))
                if lost:
                    gone = set(lost)
                    stay = [s for s in lines if line_key(s, min_chars) not in gone]
                    text = "\n".join(stay)
                    n_dropped.append(len(lines) - len(stay))
                else:
                    n_dropped.append(0)
                kept.append(text or "")
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in handed), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())], names=types.names)

    return d.join(lost.hint("merge"), d["_doc"] == lost["doc"], "left").select(*handed, "_text", "_lost").mapInArrow(cut, types)
