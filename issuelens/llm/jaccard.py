"""N-gram Jaccard join (10): MinHash bands find candidates, full n-gram sets decide.

1. Every text gets a MinHash signature of its five-word n-grams; equal texts
   become one node (its least row number).
2. Nodes shuffle on band hashes; each member of a band bucket is tied to the
   bucket's least node only, so a bucket of m nodes gives m - 1 rows.
3. Components of these ties are groups that hold every candidate pair.  A
   group's n-gram sets meet in units of bounded bytes: a group beyond the
   bound is cut into blocks and every pair of blocks is a unit.
4. A unit counts all its pairs' shared n-grams by matrix products over n-grams of like
   membership, and returns per node the number of links and a spanning
   forest of the links, never the pairs.
5. Components of the forests are the classes.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from issuelens.llm.common import mix, pick, rolling, rows_by_key, small_batches, staged, word_hashes, words_of
from issuelens.llm.components import components

SIZE, THRESHOLD = 5, 0.8
#: Chance that a pair exactly at the threshold shares a band.
RECALL = 0.9999
#: A unit holds two blocks of at most about so many bytes of n-gram hashes and so many nodes.
BLOCK_BYTES, BLOCK_NODES = 4 << 20, 1000


def bands_and_rows(threshold: float = THRESHOLD, recall: float = RECALL, most_hashes: int = 160) -> tuple[int, int]:
    """The most rows a band (fewest false candidates) whose number of bands for ``recall`` stays in ``most_hashes``."""
    for rows in range(16, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= most_hashes:
            return bands, rows
    raise ValueError("no banding reaches this recall")


def ngram_set(text: str | None, size: int = SIZE) -> np.ndarray:
    """Sorted distinct hashes of a text's n-grams; a text of fewer words, but not none, has its words as one n-gram."""
    words = words_of(text)
    return np.unique(rolling(word_hashes(words), min(size, len(words)))) if words else np.empty(0, np.uint64)


class MinHash:
    def __init__(self, bands: int, rows: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = rng.integers(1, 1 << 63, bands * rows, np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, bands * rows, np.uint64)[:, None]
        self.weight = mix(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
        self.band = mix(np.arange(bands, dtype=np.uint64) + np.uint64(1 << 40))

    def band_hashes(self, grams: np.ndarray) -> np.ndarray:
        low = None
        for i in range(0, len(grams), 4096):
            part = (grams[None, i : i + 4096] * self.a + self.b).min(axis=1)
            low = part if low is None else np.minimum(low, part)
        return mix((mix(low.reshape(self.bands, self.rows)) * self.weight).sum(axis=1, dtype=np.uint64) + self.band).view(np.int64)


def linked(sets: list[np.ndarray], side: np.ndarray, same: bool, threshold: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links of each member of a unit, and a spanning forest of them.

    ``side`` tells the block (0 or 1) of each member; ``same``: all pairs
    count, else only pairs across the blocks.  N-grams held by exactly the same
    members are merged into one column with their number as weight.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    who = np.repeat(np.arange(m), sizes)
    grams = np.concatenate(sets) if m else np.empty(0, np.uint64)
    order = np.argsort(grams, kind="stable")
    grams, who = grams[order], who[order]
    starts = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]]) if len(grams) else np.empty(0, np.int64)
    lengths = np.diff(np.r_[starts, len(grams)])
    marks = [mix(np.arange(m, dtype=np.uint64) + np.uint64(x)) for x in (1, 1 << 50)]
    held = [np.add.reduceat(k[who], starts) for k in marks] if len(starts) else [np.empty(0, np.uint64)] * 2
    several = lengths > 1
    starts, lengths = starts[several], lengths[several]
    kinds = np.stack([h[several] for h in held], axis=1).view([("a", np.uint64), ("b", np.uint64)]).ravel()
    _, first, weight = np.unique(kinds, return_index=True, return_counts=True)
    left = np.arange(m) if same else np.flatnonzero(side == 0)
    right = np.arange(m) if same else np.flatnonzero(side == 1)
    shared = np.zeros((len(left), len(right)), np.float32)
    step = max(64, (4 << 20) // max(1, m))
    for i in range(0, len(first), step):
        at = first[i : i + step]
        x = np.zeros((len(at), m), np.float32)
        n = lengths[at]
        rows = np.repeat(np.arange(len(at)), n)
        x[rows, who[np.repeat(starts[at] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())]] = 1
        shared += (x[:, left] * weight[i : i + step, None].astype(np.float32)).T @ x[:, right]
    t = Fraction(str(threshold))  # shared / (a + b - shared) >= t, in whole numbers
    both = shared.astype(np.int64) * (t.numerator + t.denominator)
    ok = both >= t.numerator * (sizes[left][:, None] + sizes[right][None, :])
    ok &= shared > 0
    if same:
        np.fill_diagonal(ok, False)
    links = np.zeros(m, np.int64)
    links[left] += ok.sum(axis=1)
    if not same:
        links[right] += ok.sum(axis=0)
    return links, _forest(ok, left, right, m)


def _forest(ok: np.ndarray, left: np.ndarray, right: np.ndarray, m: int) -> list[tuple[int, int]]:
    """Edges of breadth-first trees over the link matrix: each member is entered once."""
    rows, cols = {int(x): i for i, x in enumerate(left)}, {int(x): i for i, x in enumerate(right)}
    new, out = np.ones(m, bool), []
    for root in range(m):
        if not new[root]:
            continue
        new[root] = False
        todo = [root]
        while todo:
            u = todo.pop()
            near = []
            if u in rows:
                near.append(right[ok[rows[u]]])
            if u in cols:
                near.append(left[ok[:, cols[u]]])
            for v in np.unique(np.concatenate(near)).tolist():
                if new[v]:
                    new[v] = False
                    out.append((u, v))
                    todo.append(v)
    return out


def _features(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("key", pa.binary()), ("n_grams", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def run(batches):
        hasher = MinHash(bands, rows)
        for b in batches:
            n, out = [], []
            for text in b.column("text").to_pylist():
                grams = ngram_set(text, size)
                n.append(len(grams))
                out.append(hasher.band_hashes(grams) if len(grams) else [])
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), b.column("key"), pa.array(n, pa.int64()), pa.array(out, pa.list_(pa.int64()))], schema=schema)

    d = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "key", "text")
    return d.mapInArrow(run, "row long, doc_id long, key binary, n_grams long, bands array<long>")


def _verified(units: DataFrame, size: int, threshold: float) -> DataFrame:
    """(node, other, links): per node of each unit its links there, and forest edges (other not null, links 0)."""
    schema = pa.schema([("node", pa.int64()), ("other", pa.int64()), ("links", pa.int64())])

    def run(batches):
        for group in rows_by_key(batches, "unit"):
            node, side = group.column("node").to_numpy(), group.column("side").to_numpy()
            node, first = np.unique(node, return_index=True)  # rows that repeat are one node
            sets = [np.frombuffer(group.column("grams")[i].as_py(), np.uint64) for i in first.tolist()]
            links, forest = linked(sets, side[first], bool(group.column("same")[0].as_py()), threshold)
            u, v = np.array(forest, np.int64).reshape(-1, 2).T
            hit = links > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[node[hit], node[u]], pa.int64()), pa.array([None] * int(hit.sum()) + node[v].tolist(), pa.int64()), pa.array(np.r_[links[hit], np.zeros(len(u), np.int64)], pa.int64())],
                schema=schema,
            )

    return units.mapInArrow(run, "node long, other long, links long")


def _grams(members: DataFrame, size: int) -> DataFrame:
    schema = pa.schema([("node", pa.int64()), ("grp", pa.int64()), ("blocks", pa.int64()), ("grams", pa.binary())])

    def run(batches):
        for b in batches:
            grams = [ngram_set(t, size).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("grp"), b.column("blocks"), pa.array(grams, pa.binary())], schema=schema)

    return members.select("node", "grp", "blocks", "text").mapInArrow(run, "node long, grp long, blocks long, grams binary")


def jaccard_classes(docs: DataFrame, threshold: float = THRESHOLD, size: int = SIZE, recall: float = RECALL, block_bytes: int = BLOCK_BYTES, block_nodes: int = BLOCK_NODES) -> DataFrame:
    """One row a document: row, doc_id, key (md5 of the text), class_id, copy_of, n_links, first.

    Words are ``[^\\x20\\x09-\\x0D]+``; a link is a pair of different texts whose
    n-gram sets have a Jaccard similarity of ``threshold`` or more.  Equal
    texts (null counts as empty) are copies: ``copy_of`` is their least doc_id.  A class is a
    connected component of copies and links, ``class_id`` its least doc_id
    (null where no member has one), and ``n_links`` the number of different
    texts linked to the document's text.  Texts without words have no links.  ``first``
    marks one row a class, that of the least doc_id.  Repeated rows are
    copies; extra columns are ignored; an empty table gives an empty one.
    """
    small_batches(docs.sparkSession)
    bands, rows = bands_and_rows(threshold, recall)
    text = F.coalesce(F.col("text"), F.lit(""))
    d = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.md5(text.cast("binary"))).alias("key"))
    t = staged(_features(d, size, bands, rows))
    copies = staged(t.groupBy("key").agg(F.min("row").alias("node"), F.min("doc_id").alias("copy_of")))
    nodes = t.where("n_grams > 0").join(copies.select(F.col("node").alias("row")), "row").select(F.col("row").alias("node"), "doc_id", "key", "n_grams", "bands")

    banded = nodes.select("node", F.explode("bands").alias("band"))
    # tables of their own: a join with an aggregation on the same key is none that Spark splits at a hot one
    hubs = staged(banded.groupBy("band").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    ties = banded.join(hubs, "band").where("node <> hub").select(F.col("node").alias("u"), F.col("hub").alias("v")).distinct()
    groups = staged(components(ties).select("node", F.col("component").alias("grp")))

    members = nodes.drop("bands").join(groups, "node")
    need = members.groupBy("grp").agg(F.sum("n_grams").alias("grams"), F.count(F.lit(1)).alias("n"))
    need = need.select("grp", F.greatest(F.ceil(F.col("grams") * 8 / block_bytes), F.ceil(F.col("n") / block_nodes)).cast("long").alias("blocks"))
    members = members.join(need, "grp").select("node", "grp", "blocks", "key", F.col("doc_id").alias("of"))
    texts = d.join(members, (d.key == members.key) & d.doc_id.eqNullSafe(members.of)).select("node", "grp", "blocks", "text")
    held = _grams(texts.dropDuplicates(["node"]), size)  # rows that repeat have one doc_id (or none) and one text
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    units = held.withColumn("block", block).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    low, high = F.least("block", "with"), F.greatest("block", "with")
    units = units.select(F.concat_ws(":", "grp", low, high).alias("unit"), (low == high).alias("same"), (F.col("block") == high).cast("int").alias("side"), "node", "grams")
    found = staged(_verified(units.repartition("unit").sortWithinPartitions("unit"), size, threshold))

    links = found.where("other is null").groupBy("node").agg(F.sum("links").alias("n_links"))
    classes = components(found.where("other is not null").select(F.col("node").alias("u"), F.col("other").alias("v")))
    of_node = copies.join(classes, "node", "left").join(links, "node", "left")
    of_node = of_node.select("key", "copy_of", F.coalesce("component", "node").alias("class"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    every = staged(t.select("row", "doc_id", "key").join(of_node, "key"))
    # the first row of the least doc_id; rows without one come last
    firsts = every.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("f"))
    firsts = staged(firsts.select("class", F.col("f.doc_id").alias("class_id"), F.col("f.row").alias("first_row")))
    return every.join(firsts, "class").select("row", "doc_id", "key", "class_id", "copy_of", "n_links", (F.col("row") == F.col("first_row")).alias("first"))
