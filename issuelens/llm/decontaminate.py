"""Benchmark decontamination (1): Wu-Manber search over words.

The items' windows of ten words are the test strings, words are the symbols
and two words are a block.  A table of shifts by block hash tells how far the
search may skip, buckets by suffix-block hash hold the windows that may end
here, a prefix-block hash narrows them, and word ids are compared at last.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from issuelens.llm.common import pick, small_batches
from issuelens.session import cut_lineage

#: Item text that one search table holds; a larger benchmark is searched in as many passes.
BLOCK_BYTES = 8 << 20
#: Lower case for A-Z, blanks for what no word holds; bytes from 0x80 are parts of words.
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32) for c in range(256))


def plain_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


class WuManber:
    """Search tables for the windows of one length, as arrays; the word ids come from the caller (0: in no window).

    The shift table has some eight places for each block of the windows, so it doesn't fill up as they grow.
    """

    LEAST_BITS, MOST_BITS = 10, 24
    TIMES, FIRST, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(3), np.uint64(0xD6E8FEB86659FD93)

    def __init__(self, windows: np.ndarray):
        n, self.m = windows.shape
        self.b = b = min(2, self.m)
        last = self.m - b
        self.bits = min(self.MOST_BITS, max(self.LEAST_BITS, (8 * n * (last + 1)).bit_length()))
        shift = np.full(1 << self.bits, last + 1, np.uint8 if last < 255 else np.int64)
        for first in range(last + 1):  # later blocks of a window shift less, so they are set last
            shift[self._codes(windows[:, first : first + b])] = last - first
        self.shift = shift
        suffix, prefix = self._codes(windows[:, last:]), self._codes(windows[:, :b])
        key = suffix << 32 | prefix
        self.number = np.argsort(key, kind="stable")  # of the windows in the order of their buckets
        self.key, self.windows = key[self.number], windows[self.number]

    def _codes(self, blocks: np.ndarray) -> np.ndarray:
        """Hash of each row of one or two ids."""
        x = blocks.astype(np.uint64) * self.TIMES
        return self._places(x[:, 0] * self.FIRST + x[:, 1] if self.b == 2 else x[:, 0])

    def _places(self, x: np.ndarray) -> np.ndarray:
        return ((x * self.SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """(start, window number) of every occurrence."""
        n, m = len(ids), self.m
        if n < m:
            return []
        x = ids.astype(np.uint64) * self.TIMES
        codes = self._places(x[:-1] * self.FIRST + x[1:] if self.b == 2 else x)
        jumps = self.shift[codes].tolist()
        last, at, maybe = m - self.b, len(jumps), []
        i = last  # block start of the window's last block
        while i < at:
            jump = jumps[i]
            if jump:
                i += jump
                continue
            maybe.append(i - last)
            i += 1
        if not maybe:
            return []
        starts = np.array(maybe)
        key = codes[starts + last] << 32 | codes[starts]
        low, high = np.searchsorted(self.key, key), np.searchsorted(self.key, key, side="right")
        out = []
        for k in np.flatnonzero(low < high).tolist():
            start = int(starts[k])
            same = np.flatnonzero((self.windows[low[k] : high[k]] == ids[start : start + m]).all(axis=1))
            out.extend((start, int(self.number[low[k] + x])) for x in same.tolist())
        return out


class Benchmark:
    """Windows of a block of items, by length, with the items that hold each; built once and sent to the tasks."""

    def __init__(self, items: list[tuple[int | None, str | None]], size: int = 10):
        self.vocab: dict[bytes, int] = {}
        self.items = [item for item, _ in items]
        rows: dict[int, list[np.ndarray]] = {}
        owners: dict[int, list[np.ndarray]] = {}
        for k, (_, text) in enumerate(items):
            ids = np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in plain_words(text)], np.int32)
            if len(ids):
                m = min(size, len(ids))
                windows = np.lib.stride_tricks.sliding_window_view(ids, m)
                rows.setdefault(m, []).append(windows)
                owners.setdefault(m, []).append(np.full(len(windows), k))
        #: (search tables, first place of each window's items, places in ``items``)
        self.searches: list[tuple[WuManber, np.ndarray, np.ndarray]] = []
        for m in sorted(rows):
            windows, owner = np.concatenate(rows[m]), np.concatenate(owners[m])
            which = np.zeros(len(windows), np.int64)  # number of the window's beginning, word by word
            for k in range(m):
                _, at, which = np.unique(which * (len(self.vocab) + 1) + windows[:, k], return_index=True, return_inverse=True)
            held = np.unique(which * len(items) + owner)
            first = np.searchsorted(held // len(items), np.arange(len(at) + 1))
            self.searches.append((WuManber(windows[at]), first, held % len(items)))

    def search(self, text: str | None) -> tuple[int, np.ndarray, set]:
        """Number of words, whether each is hit, and the items with windows found."""
        words = plain_words(text)
        hit, found = np.zeros(len(words), bool), set()
        if words and self.searches:
            ids = np.fromiter(map(self.vocab.get, words, repeat(0)), np.int32, len(words))
            if ids.any():
                for tables, first, owners in self.searches:
                    for start, w in tables.find(ids):
                        hit[start : start + tables.m] = True
                        found.update(owners[first[w] : first[w + 1]].tolist())
        return len(words), hit, {self.items[k] for k in found}


def blocks_of(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """Item blocks of about ``block_bytes`` of text, each brought to the driver by itself."""
    b = pick(benchmark, "item_id", "text").where("text is not null").distinct()  # a repeated item says nothing new
    total = b.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = -(-total // block_bytes) or 1
    if n == 1:
        yield [tuple(r) for r in b.collect()]
        return
    for k in range(n):
        yield [tuple(r) for r in b.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()]


def contamination(docs: DataFrame, benchmark: DataFrame, carry: tuple[str, ...] = (), size: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: n_words, n_hit, the items found and ``contaminated`` (any word hit).

    One row a document, also for repeated rows and null ids; a null text has
    no words.  Items without words match nothing; an item with a null id marks
    words but isn't counted.  The benchmark is a query set: its search tables
    are built on the driver and go to the tasks in blocks of ``block_bytes``, one pass over the documents
    a block, and a pass hands on which words are hit.  The columns of ``carry`` come
    along; all others are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    carry = tuple(c for c in carry if c != "doc_id")
    d = pick(docs, "doc_id", "text", *(c for c in carry if c != "text"))
    d = d.select(F.col("doc_id").cast("long").alias("doc_id"), *carry, F.col("text").alias("_text"), F.lit(None).cast("binary").alias("_hits"), F.array().cast("array<string>").alias("items"))
    handed = ("doc_id", *carry)
    types = StructType(list(d.schema.fields)).add("n_words", "long").add("n_hit", "long")

    def passing(block, last: bool):
        """One pass: a further pass gets the text and the words hit so far, the last one's output gets neither."""

        def run(batches):
            bench = block.value
            for b in batches:
                n, hits, n_hit, items = [], [], [], []
                for t, h, it in zip(b.column("_text").to_pylist(), b.column("_hits").to_pylist(), b.column("items").to_pylist(), strict=True):
                    k, hit, found = bench.search(t)
                    if h is not None:
                        hit |= np.unpackbits(np.frombuffer(h, np.uint8), count=k).astype(bool)
                    n.append(k)
                    hits.append(None if last else np.packbits(hit).tobytes())
                    n_hit.append(int(hit.sum()))
                    items.append(sorted({*it, *(str(x) for x in found if x is not None)}))
                text = pa.nulls(len(n), pa.string()) if last else b.column("_text")
                cols = [text, pa.array(hits, pa.binary()), pa.array(items, pa.list_(pa.string())), pa.array(n, pa.int64()), pa.array(n_hit, pa.int64())]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in handed), *cols], names=types.names)

        return run

    held = None
    for block in blocks_of(benchmark, block_bytes):
        if held is not None:
            d = cut_lineage(d.mapInArrow(passing(held, False), types).drop("n_words", "n_hit"))
        held = spark.sparkContext.broadcast(Benchmark(block, size))
    d = d.mapInArrow(passing(held, True), types)
    return d.select(*handed, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", (F.col("n_hit") > 0).alias("contaminated"))
