"""Ranked lexical search (13): bit-sliced Bloom signatures.

Documents are signed in blocks.  A signature sets three bits for each term and,
by powers of two, for each number of occurrences that the term reaches; the block
is kept by bit, so a row of it says which documents set that bit.  The AND of a
term's three rows overestimates where the term is present; the sums of the
present terms' weights, one for each power of two, bound a document's score from above.
A document is scored exactly unless its bound lies below the worst of the best
documents known to the task.  The tasks' best documents are ranked at last.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window

from issuelens.llm.common import ODD, mix, pick, small_batches
from issuelens.llm.decontaminate import BLOCK_BYTES, blocks_of, plain_words

#: Documents and text bytes that are signed together.
BLOCK_DOCS, BLOCK_TEXT = 4096, 8 << 20
#: Bits of a term, bit rows for each term of the largest document of a block, and numbers of occurrences told apart (1, 2-3, 4-7, more).
BITS, ROWS, LEVELS = 3, 16, 4
#: Stands for a missing id: after all others.
LAST = (1 << 63) - 1


def _rows(hashes: np.ndarray, level: int, bit: int) -> np.ndarray:
    """The hash whose low bits are the row of a term's bit."""
    return mix(hashes + np.uint64((level * BITS + bit + 1) * ODD % (1 << 64)))


def term_hashes(terms) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64)


def scale(n: int, docs: int, total: int) -> int:
    """A document's m of the score: 25 of 100 fixed, 75 by its length against the mean."""
    return 100 - 75 + 75 * n * docs // total


def part(tf, m):
    """What tf occurrences add to the score for a weight of 1; grows with tf."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class Signatures:
    """Bit rows of a block of documents, given by their terms' counts."""

    def __init__(self, counts: list[Counter]):
        self.size = len(counts)
        sizes = np.array([len(c) for c in counts], np.int64)
        hashes = term_hashes(t for c in counts for t in c)
        tf = np.fromiter((n for c in counts for n in c.values()), np.int64, len(hashes))
        doc = np.repeat(np.arange(self.size), sizes)
        most = int(max((np.bincount(doc, np.minimum(np.log2(tf).astype(np.int64), LEVELS - 1) + 1)), default=1))
        self.mask = np.uint64((1 << max(6, (ROWS * most - 1).bit_length())) - 1)
        held = np.zeros((int(self.mask) + 1, self.size), bool)
        for level in range(LEVELS):
            on = tf >= 1 << level
            for bit in range(BITS):
                held[(_rows(hashes[on], level, bit) & self.mask).astype(np.int64), doc[on]] = True
        self.bits = np.packbits(held, axis=1)

    def present(self, rows: list[list[np.ndarray]]) -> list[np.ndarray]:
        """Per level the documents (bits of bytes) that may hold each term so often; ``rows``: by level and bit, of each term."""
        out = []
        for level in rows:
            at = [self.bits[(r & self.mask).astype(np.int64)] for r in level]
            out.append(reduce(np.bitwise_and, [*out[-1:], *at]))
        return out


class Queries:
    """A block of items as weighted terms."""

    def __init__(self, items: list[tuple[int | None, dict[bytes, int]]], docs: int, total: int):
        self.docs, self.total = docs, total
        self.items = [(item, list(weights.items())) for item, weights in items]
        terms = sorted({t for _, w in items for t in w})
        place = {t: k for k, t in enumerate(terms)}
        self.at = [np.array([place[t] for t, _ in w], np.int64) for _, w in self.items]
        self.weights = [np.array([x for _, x in w], np.float64) for _, w in self.items]
        hashes = term_hashes(terms)
        self.rows = [[_rows(hashes, level, bit) for bit in range(BITS)] for level in range(LEVELS)]

    def bounds(self, counts: list[Counter], m: np.ndarray):
        """For each item the upper bounds of the block's documents' scores."""
        signed = Signatures(counts)
        present = signed.present(self.rows)
        most = np.array([max(c.values()) for c in counts], np.int64)
        caps = [np.full(len(m), (2 << level) - 1) for level in range(LEVELS - 1)]
        caps = [np.minimum(c, most) for c in caps] + [most]
        adds = [part(c, m) for c in caps]
        adds = [adds[0], *(b - a for a, b in zip(adds, adds[1:], strict=False))]
        for at, weights in zip(self.at, self.weights, strict=True):
            bound = np.zeros(len(m), np.int64)
            for level, add in zip(present, adds, strict=True):
                rows = level[at]
                if level is not present[0] and not rows.any():
                    break
                sums = weights @ np.unpackbits(rows, axis=1, count=len(m))
                bound += sums.astype(np.int64) * add  # weights are whole numbers, exact in doubles
            yield bound

    def exact(self, item: int, count: Counter, m: int) -> int:
        """The score of a document for an item."""
        get = count.get
        return sum(w * part(tf, m) for t, w in self.items[item][1] if (tf := get(t)))


class Best:
    """The best documents of each item that a task has met."""

    def __init__(self, queries: Queries, top: int):
        self.queries, self.top = queries, top
        self.held: list[list[tuple[int, int]]] = [[] for _ in queries.items]  # heaps of (score, -doc), the worst first
        self.scored = 0

    def add(self, docs: list[int], counts: list[Counter], sizes: list[int]) -> None:
        """A block of documents that have terms."""
        q = self.queries
        m = [scale(n, q.docs, q.total) for n in sizes]
        for k, bound in enumerate(q.bounds(counts, np.array(m, np.int64))):
            heap = self.held[k]
            may = np.flatnonzero(bound >= (heap[0][0] if len(heap) == self.top else 1))
            for i in may[np.argsort(-bound[may], kind="stable")].tolist():
                if len(heap) == self.top and bound[i] < heap[0][0]:
                    break  # this one and all after it are provably worse
                self.scored += 1
                score = q.exact(k, counts[i], m[i])
                if score > 0:
                    (heapq.heappush if len(heap) < self.top else heapq.heappushpop)(heap, (score, -docs[i]))


def _blocks(batches, block_docs: int, block_text: int):
    """Blocks of (ids, term counts, numbers of terms) of documents with terms, of about the same number of different terms."""
    held: dict[int, tuple[list, list, list]] = {}
    rows = size = 0
    for b in batches:
        for doc, text in zip(b.column("_doc").to_pylist(), b.column("_text").to_pylist(), strict=True):
            words = plain_words(text)
            if words:
                count = Counter(words)
                # blocks have as many bit rows as their largest document needs, so documents of like size go together
                for column, value in zip(held.setdefault(len(count).bit_length(), ([], [], [])), (doc, count, len(words)), strict=True):
                    column.append(value)
                rows, size = rows + 1, size + len(text)
                if rows >= block_docs or size >= block_text:
                    yield from held.values()
                    held, rows, size = {}, 0, 0
    yield from held.values()


def _statistics(docs: DataFrame, terms: Broadcast) -> tuple[int, int, dict[bytes, int]]:
    """Documents with terms, all their terms, and per known term the documents that hold it."""

    def run(batches):
        known, df, n, total = set(terms.value), Counter(), 0, 0
        for b in batches:
            for text in b.column("_text").to_pylist():
                words = plain_words(text)
                n, total = n + bool(words), total + len(words)
                df.update(known.intersection(words))
        found = [(None, n), (b"", total), *df.items()]
        yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in found], pa.binary()), pa.array([c for _, c in found], pa.int64())], names=["term", "n"])

    counted = docs.select("_text").mapInArrow(run, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n"))
    df = {None if t is None else bytes(t): n for t, n in counted.collect()}  # no more rows than the items' terms and two
    return df.pop(None, 0), df.pop(b"", 0), df


def search(docs: DataFrame, items: DataFrame, top: int = 10, block_docs: int = BLOCK_DOCS, block_text: int = BLOCK_TEXT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``top`` best documents of each item: item_id, rank, doc_id, score.

    Terms are ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z in lower
    case.  With N documents that have terms, L terms in them, df documents that
    hold a term, a term weighs w = floor(1000 ln((2N + 2) / (2df + 1))); a document
    of n terms has m = 25 + 75nN div L and scores the sum of
    w (10**9 tf div (1000 tf + 8m)) over the item's terms, repeats included.

    Equal scores come by ascending doc_id, a missing id last; ranks are unique.
    Documents that score 0 aren't ranked, so items and documents without terms
    (null, empty) don't occur.  Repeated documents are ranked each; a repeated
    item once (items that share an id but not the text, each).  Only the named columns are
    read; empty tables give an empty one.  The items are a query set: they go to the
    tasks in blocks of ``block_bytes`` of text, with two passes over the documents a block.
    """
    spark = docs.sparkSession
    small_batches(spark)
    d = pick(docs, "doc_id", "text").select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("_doc"), F.col("text").alias("_text"))
    ranked = []
    for k, block in enumerate(blocks_of(items.select(F.col("item_id").cast("long").alias("item_id"), "text"), block_bytes)):
        terms = [(item, Counter(plain_words(text))) for item, text in block]
        n, total, df = _statistics(d, spark.sparkContext.broadcast({t for _, c in terms for t in c}))
        weights = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for t, x in df.items()}
        weighed = [(item, {t: c * weights[t] for t, c in count.items() if weights.get(t)}) for item, count in terms]
        sent = spark.sparkContext.broadcast(([(item, w) for item, w in weighed if w], n, total))

        def run(batches, sent=sent):
            queries = Queries(*sent.value)
            best = Best(queries, top)
            for ids, counts, sizes in _blocks(batches, block_docs, block_text) if queries.items else ():
                best.add(ids, counts, sizes)
            found = [(j, queries.items[j][0], -doc, score) for j, heap in enumerate(best.held) for score, doc in heap]
            cols = list(zip(*found, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["item", "item_id", "_doc", "score"])

        got = d.select("_doc", "_text").mapInArrow(run, "item long, item_id long, _doc long, score long")
        ranked.append(got.withColumn("_block", F.lit(k)))
    each = Window.partitionBy("_block", "item").orderBy(F.desc("score"), "_doc")
    out = reduce(DataFrame.unionByName, ranked).withColumn("rank", F.row_number().over(each)).where(F.col("rank") <= top)
    return out.select("item_id", "rank", F.when(F.col("_doc") < LAST, F.col("_doc")).alias("doc_id"), "score")
