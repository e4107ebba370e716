"""Best-fit packing (3): patterns of few lengths fitted by non-negative least squares.

Only the histogram of piece lengths (at most ``room`` counts) reaches the
driver.  There, patterns of up to four length classes that fill a sequence are
fitted to the histogram, their repeats are rounded down, and the remaining
pieces are packed best-fit, longest first, into the gaps and into further
sequences.  The plan is a list of runs (length, ranks from-to, where); every
piece finds its run by its length and its rank among pieces of that length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, Window

from issuelens.llm.common import pick, small_batches
from issuelens.llm.tokens import WordEncoder, default_path, opened
from issuelens.session import cut_lineage


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 300) -> np.ndarray:
    """argmin |a x - b| over x >= 0 by the active-set method of Lawson and Hanson."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    eps = 1e-9 * max(1.0, float(np.abs(a.T @ b).max()))
    for _ in range(rounds):
        slope = np.where(active, -np.inf, a.T @ (b - a @ x))
        best = int(slope.argmax())
        if slope[best] <= eps:
            break
        active[best] = True
        while True:
            s = np.zeros_like(x)
            s[active] = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            low = active & (s <= 0)
            if not low.any():
                x = s
                break
            step = (x[low] / np.maximum(x[low] - s[low], 1e-300)).min()
            x = x + step * (s - x)
            active &= x > 1e-12
            x[~active] = 0
    return x


def patterns(classes: int, parts: int = 4) -> np.ndarray:
    """All multisets of 2 to ``parts`` length classes that add up to ``classes``, one column each."""
    out = []

    def grow(left: int, least: int, got: list[int]) -> None:
        if left == 0 and len(got) > 1:
            out.append(got)
        elif left >= least and len(got) < parts:
            for c in range(least, left + 1):
                grow(left - c, c, [*got, c])

    grow(classes, 1, [])
    a = np.zeros((classes, len(out)))
    for j, p in enumerate(out):
        for c in p:
            a[c - 1, j] += 1
    return a


@dataclass
class Group:
    """``n`` sequences filled alike: (length, copies) in order, with ``gap`` tokens free."""

    n: int
    gap: int
    parts: list[tuple[int, int]] = field(default_factory=list)


def plan_groups(counts: dict[int, int], room: int, classes: int = 64) -> list[Group]:
    """Groups of sequences that take every piece: NNLS patterns first, then best fit for what they leave."""
    left = {k: n for k, n in counts.items() if n > 0}
    groups: list[Group] = []
    if room in left:
        groups.append(Group(left.pop(room), 0, [(room, 1)]))
    width = -(-room // classes)
    members: dict[int, list[int]] = {}
    for k in sorted(left):
        members.setdefault(-(-k // width), []).append(k)  # longest last
    hist = np.zeros(classes)
    for c, ks in members.items():
        hist[c - 1] = sum(left[k] for k in ks)
    if hist.any():
        a = patterns(classes)
        x = nnls(a, hist)
        for j in np.argsort(-x, kind="stable"):
            if x[j] < 1:
                break
            need = a[:, j].astype(int)
            used = np.flatnonzero(need)
            n = int(min(x[j], *(hist[u] // need[u] for u in used)))
            hist -= n * need
            parts = [int(u) + 1 for u in used for _ in range(need[u])]
            while n:  # stretches in which every part keeps its length
                lengths, step, taken = [], n, {}
                for c in parts:
                    k = next(k for k in reversed(members[c]) if left[k] > taken.get(k, 0))
                    taken[k] = taken.get(k, 0) + 1
                    lengths.append(k)
                step = min([n, *(left[k] // t for k, t in taken.items())])
                for k, t in taken.items():
                    left[k] -= step * t
                n -= step
                groups.append(Group(step, room - sum(lengths), [(k, 1) for k in lengths]))
                for c in set(parts):
                    while members[c] and not left[members[c][-1]]:
                        members[c].pop()
    by_gap: dict[int, list[Group]] = {}
    gaps: list[int] = []

    def put(g: Group) -> None:
        if g.gap and g.gap not in by_gap:
            by_gap[g.gap] = []
            insort(gaps, g.gap)
        if g.gap:
            by_gap[g.gap].append(g)

    for g in groups:
        put(g)
    for k in sorted((k for k, n in left.items() if n), reverse=True):
        n = left[k]
        while n:
            at = bisect_left(gaps, k)
            if at == len(gaps):
                each = min(room // k, n)
                g = Group(n // each, room - each * k, [(k, each)])
                groups.append(g)
            else:
                gap = gaps[at]
                old = by_gap[gap].pop()
                if not by_gap[gap]:
                    del by_gap[gap], gaps[at]
                each = min(gap // k, n)
                take = min(old.n, n // each)
                if take < old.n:  # the rest stays as it was
                    rest = Group(old.n - take, gap, list(old.parts))
                    groups.append(rest)
                    put(rest)
                    old.n = take
                g = old
                g.gap -= each * k
                g.parts.append((k, each))
            n -= g.n * each
            put(g)
    return groups


def runs_of(groups: list[Group]) -> dict[str, np.ndarray]:
    """The plan as arrays, ordered by (length, first rank): copies a sequence, its first sequence and the offset there."""
    rows, rank, seq = [], {}, 0
    for g in groups:
        offset = 0
        for k, each in g.parts:
            first = rank.get(k, 0)
            rows.append((k, first, each, seq, offset))
            rank[k] = first + g.n * each
            offset += k * each
        seq += g.n
    names = ("length", "first", "each", "sequence", "offset")
    cols = np.array(sorted(rows), np.int64).reshape(-1, 5).T
    return dict(zip(names, cols, strict=True))


def _code(length, rank):
    """One ordered integer for (length, rank); lengths take the high bits."""
    return (length << np.int64(40)) | rank


def pieces(docs: DataFrame, path: str, room: int, end_id: int) -> DataFrame:
    """Pieces of at most ``room`` ids of each document, numbered among pieces of like length in their partition."""
    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("piece", "start", "length", "ids_crc32", "part", "local")]])

    def run(batches):
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), np.zeros(room + 1, np.int64)
        for b in batches:
            coder = opened(WordEncoder, path)
            end = np.array([end_id], coder.dtype).tobytes()
            step, rows = room * coder.dtype.itemsize, []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                ids = coder.ids(text) + end
                for i, at in enumerate(range(0, len(ids), step)):
                    wide = np.frombuffer(ids[at : at + step], coder.dtype).astype("<u4")
                    k = len(wide)
                    rows.append((doc, i, i * room, k, zlib.crc32(wide), part, int(seen[k])))
                    seen[k] += 1
            cols = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=schema)

    small_batches(docs.sparkSession)
    d = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return d.mapInArrow(run, "doc_id long, piece long, start long, length long, ids_crc32 long, part long, local long")


def pack(docs: DataFrame, path: str | None = None, room: int = 4096, end_id: int = 1) -> DataFrame:
    """Every document's pieces, each with its sequence and the offset there.

    A document is its text's ids (null: none) and ``end_id``, so an empty text
    is one id.  Only documents of more than ``room`` ids are cut.  Repeated
    rows are packed each; null ids pass through; an empty table gives an empty
    one; other columns are ignored.  The plan's size depends on ``room`` alone,
    so it is broadcast.
    """
    spark = docs.sparkSession
    p = cut_lineage(pieces(docs, path or default_path("word_bpe_49k.json"), room, end_id))
    runs = p.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = {int(r[0]): int(r[1]) for r in runs.groupBy("length").agg(F.sum("n")).collect()}  # at most `room` rows
    plan = spark.sparkContext.broadcast(runs_of(plan_groups(counts, room)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = runs.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = p.join(first, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("local")).alias("rank"))
    out = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def place(batches):
        r = plan.value
        order = _code(r["length"], r["first"])
        for b in batches:
            length, rank = (b.column(c).to_numpy() for c in ("length", "rank"))
            i = np.searchsorted(order, _code(length, rank), "right") - 1
            k, each = rank - r["first"][i], r["each"][i]
            seq, offset = r["sequence"][i] + k // each, r["offset"][i] + k % each * length
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in out[:5]), pa.array(seq, pa.int64()), pa.array(offset, pa.int64())], names=out)

    return ranked.mapInArrow(place, "doc_id long, piece long, start long, length long, ids_crc32 long, sequence_id long, offset long")
