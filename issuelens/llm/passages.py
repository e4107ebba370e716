"""Substring dedup (9): seeds are winnowed anchors, extension finds the shared windows around them.

Every window of 13 words has one anchor, the least hash of its six-word
n-grams, so two equal windows have the same anchor.  Texts are handled in
lots of rows; a lot asks about hashes and gets answers, each hash once.

1. Seed join: each lot sends its anchors, dealt by hash; anchors of one
   document only are dropped.
2. Extension: around each shared anchor the match is extended to the left and
   right as far as windows have this anchor.  The 128-bit hashes of these
   windows are dealt by hash; for each the least doc_id comes back to lots
   that hold it under a greater one.
3. A lot puts the covered windows of each document together: their unions are the
   maximal repeats of 13 words and more, which are cut.

A passage that n documents share costs at most one row entry a lot, never pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame
from pyspark.sql.types import StructType

from issuelens.llm.common import ODD2, covered, pack_ints, pick, rolling, rows_by_key, small_batches, staged, unpack_ints, word_hashes, word_pairs, words_of

WINDOW, SEED = 13, 6
#: Rows and text bytes of a lot, and text bytes that one hash bucket answers for.
LOT_ROWS, LOT_BYTES, BUCKET_BYTES = 1024, 32 << 20, 16 << 20
#: Text bytes for each partition of a shuffle, where the session's number of partitions would make larger ones.
PART_BYTES = 256 << 20
#: A null doc_id counts as greater than all others.
LAST = np.iinfo(np.int64).max


def anchors(hashes: np.ndarray, window: int, seed: int) -> np.ndarray:
    """For each window of ``window`` words the least hash of its ``seed``-word n-grams."""
    x = rolling(hashes, seed)
    width, have = window - seed + 1, 1
    if len(x) < width:
        return np.empty(0, np.uint64)
    while have < width:  # minima of ever wider stretches
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def windows(pairs: np.ndarray, window: int) -> np.ndarray:
    """128-bit hashes of the windows, as pairs of uint64; each half from its own half of the words' hashes."""
    out = np.empty((max(0, len(pairs) - window + 1), 2), np.uint64)
    out[:, 0], out[:, 1] = rolling(pairs[:, 0], window), rolling(pairs[:, 1], window, ODD2)
    return out


def _order(keys: np.ndarray) -> np.ndarray:
    return np.argsort(keys, kind="stable") if keys.ndim == 1 else np.lexsort((keys[:, 1], keys[:, 0]))


def _changes(keys: np.ndarray) -> np.ndarray:
    """First places of runs of equal keys."""
    new = keys[1:] != keys[:-1]
    return np.flatnonzero(np.r_[True, new if keys.ndim == 1 else new.any(axis=1)]) if len(keys) else np.empty(0, np.int64)


def least(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the least document of each, and its greatest."""
    order = _order(keys)
    keys, docs = keys[order], docs[order]
    at = _changes(keys)
    if not len(at):
        return keys, docs, docs
    return keys[at], np.minimum.reduceat(docs, at), np.maximum.reduceat(docs, at)


def _id(doc: int | None) -> int:
    return LAST if doc is None else doc


ASK = "lot long, bucket long, keys binary, docs binary, several binary"
ASK_PA = pa.schema([("lot", pa.int64()), ("bucket", pa.int64()), ("keys", pa.binary()), ("docs", pa.binary()), ("several", pa.binary())])
ANSWER = "lot long, keys binary, docs binary"
ANSWER_PA = pa.schema([("lot", pa.int64()), ("keys", pa.binary()), ("docs", pa.binary())])


def _asked(lot: int, keys: np.ndarray, docs: np.ndarray, buckets: int) -> pa.RecordBatch:
    """A lot's questions by bucket: each key once, with its least document and whether the lot has several."""
    keys, low, high = least(keys, docs)
    head = keys if keys.ndim == 1 else keys[:, 0]
    bucket = (head % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ends = [*(np.flatnonzero(np.diff(bucket[order])) + 1).tolist(), len(order)] if len(order) else []
    rows = []
    for i, j in zip([0, *ends], ends, strict=False):
        at = order[i:j]
        rows.append((lot, int(bucket[at[0]]), keys[at].tobytes(), pack_ints(low[at]), np.packbits(low[at] < high[at]).tobytes()))
    cols = list(zip(*rows, strict=True)) or [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, ASK_PA, strict=True)], schema=ASK_PA)


def _answers(asked: DataFrame, wide: bool, parts: int) -> DataFrame:
    """Per lot the keys with news: shared with another document (anchors), or in a smaller one than the lot's least (windows)."""

    def run(batches):
        for group in rows_by_key(batches, "bucket"):
            lots = group.column("lot").to_pylist()
            keys = [np.frombuffer(x, np.uint64).reshape(-1, 2) if wide else np.frombuffer(x, np.uint64) for x in group.column("keys").to_pylist()]
            docs = [unpack_ints(x) for x in group.column("docs").to_pylist()]
            many = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(k)).astype(bool) for x, k in zip(group.column("several").to_pylist(), keys, strict=True)]
            size = np.array([len(k) for k in keys])
            k, d, s = np.concatenate(keys), np.concatenate(docs), np.concatenate(many)
            del keys, docs, many
            order = _order(k)
            at = _changes(k[order])
            n = np.diff(np.r_[at, len(order)])
            low = np.repeat(np.minimum.reduceat(d[order], at), n)
            if wide:
                told = low < d[order]
            else:
                told = (low < np.repeat(np.maximum.reduceat(d[order], at), n)) | np.repeat(np.logical_or.reduceat(s[order], at), n)
            got, least_ = np.zeros(len(k), bool), np.empty(len(k), np.int64)
            got[order], least_[order] = told, low
            ends = np.cumsum(size)
            rows = []
            for lot, i, j in zip(lots, (ends - size).tolist(), ends.tolist(), strict=True):
                hit = np.flatnonzero(got[i:j]) + i
                if len(hit):
                    rows.append((lot, k[hit].tobytes(), pack_ints(least_[hit]) if wide else None))
            if rows:
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, ANSWER_PA, strict=True)], schema=ANSWER_PA)

    return asked.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(run, ANSWER)


def _is_in(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each key is among the sorted ``known``."""
    if not len(known):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


def _with_answers(docs: DataFrame, answers: DataFrame, parts: int) -> DataFrame:
    """Lots of rows, each after the answers it got."""
    carried = [c for c in docs.columns if c != "lot"]
    told = answers.select("lot", *[F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in carried], "keys", "docs", F.lit(0).alias("_kind"))
    rows = docs.select("lot", *carried, F.lit(None).cast("binary").alias("keys"), F.lit(None).cast("binary").alias("docs"), F.lit(1).alias("_kind"))
    return rows.unionByName(told).repartition(parts, "lot").sortWithinPartitions("lot", "_kind")


def _opened(group: pa.Table) -> tuple[list[bytes], list[bytes], pa.Table]:
    """A lot's answers and rows."""
    kind = group.column("_kind").to_numpy()
    n = int((kind == 0).sum())
    told = group.slice(0, n)
    return told.column("keys").to_pylist(), told.column("docs").to_pylist(), group.slice(n)


def lot_of(row: Column, n_bytes: Column, lot_rows: int = LOT_ROWS, lot_bytes: int = LOT_BYTES) -> Column:
    """A row's lot: at most ``lot_rows`` rows and ``lot_bytes`` bytes, or one row.

    Texts of up to lot_bytes / lot_rows bytes share a stretch of lot_rows
    consecutive rows; those of up to twice that share one of half as many, and so on.
    """
    kinds = lot_rows.bit_length() + 1
    out = row * kinds + (kinds - 1)  # longer than all: a lot by itself
    for k in reversed(range(kinds - 1)):
        rows = lot_rows >> k
        out = F.when(n_bytes <= lot_bytes // rows, F.floor(row / rows).cast("long") * kinds + k).otherwise(out)
    return out


def dedup_passages(docs: DataFrame, carry: tuple[str, ...] = (), window: int = WINDOW, seed: int = SEED, lot_rows: int = LOT_ROWS, bucket_bytes: int = BUCKET_BYTES, lot_bytes: int = LOT_BYTES) -> DataFrame:
    """Per document: doc_id, the columns ``carry``, n_words, n_removed, kept_text.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.  A word goes if a window of
    ``window`` words over it also starts in a document with a smaller doc_id
    (judged on the input).  ``kept_text`` is the words that stay, joined by
    one space.  Texts of fewer words, null and empty ones lose nothing.  A
    null doc_id is greater than all others; rows of equal doc_id don't cut
    each other.  Repeated rows give a row each; columns that aren't named are
    ignored; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    small_batches(spark)
    whole = "text" in carry
    carry = tuple(c for c in carry if c not in ("doc_id", "text"))
    d = pick(docs, "doc_id", "text", *carry).select(F.col("doc_id").cast("long").alias("_doc"), F.col("text").alias("_text"), *carry)
    # a lot is of one stretch of consecutive rows of an input partition; written, so that it stays what it is
    d = d.withColumn("lot", F.monotonically_increasing_id())
    d = staged(d.withColumn("lot", lot_of(F.col("lot"), F.coalesce(F.octet_length("_text"), F.lit(0)), lot_rows, lot_bytes)))
    total = d.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    set_ = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets, parts = max(set_, -(-total // bucket_bytes)), max(set_, -(-total // PART_BYTES))

    def seeds(batches):
        for lot in rows_by_key(batches, "lot"):
            keys, owners = [], []
            for doc, text in zip(lot.column("_doc").to_pylist(), lot.column("_text").to_pylist(), strict=True):
                a = np.unique(anchors(word_hashes(words_of(text)), window, seed))
                keys.append(a)
                owners.append(np.full(len(a), _id(doc), np.int64))
            yield _asked(lot.column("lot")[0].as_py(), np.concatenate(keys), np.concatenate(owners), buckets)

    shared = staged(_answers(d.select("lot", "_doc", "_text").mapInArrow(seeds, ASK), False, parts))

    def extended(batches):
        for group in rows_by_key(batches, "lot"):
            told, _, lot = _opened(group)
            if not told or not lot.num_rows:
                continue
            known = np.sort(np.concatenate([np.frombuffer(x, np.uint64) for x in told]))
            keys, owners = [], []
            for doc, text in zip(lot.column("_doc").to_pylist(), lot.column("_text").to_pylist(), strict=True):
                words = words_of(text)
                near = _is_in(anchors(word_hashes(words), window, seed), known)
                if near.any():
                    keys.append(windows(word_pairs(words), window)[near])
                    owners.append(np.full(len(keys[-1]), _id(doc), np.int64))
            if keys:
                yield _asked(lot.column("lot")[0].as_py(), np.concatenate(keys), np.concatenate(owners), buckets)

    asked = _with_answers(d.select("lot", "_doc", "_text"), shared.select("lot", "keys", "docs"), parts).mapInArrow(extended, ASK)
    smaller = staged(_answers(asked, True, parts))

    types = StructType([d.schema["_doc"], *[d.schema[c] for c in carry]])
    if whole:
        types = types.add("text", "string")
    for name, kind in (("n_words", "long"), ("n_removed", "long"), ("kept_text", "string")):
        types = types.add(name, kind)

    def cut(batches):
        for group in rows_by_key(batches, "lot"):
            keys, mins, lot = _opened(group)
            texts, ids = lot.column("_text").to_pylist(), lot.column("_doc").to_pylist()
            words = [words_of(t) for t in texts]
            win = [windows(word_pairs(w), window) for w in words]
            all_win = np.concatenate([*win, *[np.frombuffer(k, np.uint64).reshape(-1, 2) for k in keys], np.empty((0, 2), np.uint64)])
            own = np.concatenate([np.repeat(np.array([_id(x) for x in ids], np.int64), [len(w) for w in win]), *[unpack_ints(m) for m in mins]])
            order = _order(all_win)
            at = _changes(all_win[order])
            first = np.empty(len(own), np.int64)  # the least document known to hold each window
            if len(at):
                first[order] = np.repeat(np.minimum.reduceat(own[order], at), np.diff(np.r_[at, len(order)]))
            gone = first < own
            n_removed, kept, i = [], [], 0
            for w, x in zip(words, win, strict=True):
                hit = covered(np.flatnonzero(gone[i : i + len(x)]), window, len(w))
                i += len(x)
                n_removed.append(int(hit.sum()))
                kept.append(b" ".join([w[k] for k in np.flatnonzero(~hit).tolist()] if n_removed[-1] else w))
            cols = [*[lot.column(c) for c in ("_doc", *carry, *(["_text"] if whole else []))], pa.array([len(w) for w in words], pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield from pa.Table.from_arrays(cols, names=types.names).combine_chunks().to_batches()

    out = _with_answers(d, smaller, parts).mapInArrow(cut, types)
    return out.withColumnRenamed("_doc", "doc_id")

