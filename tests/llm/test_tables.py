"""Operators that shuffle: sharding, packing, token store, passages, Jaccard join, components."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from issuelens.llm import components, jaccard, packing, passages, sharding, token_store
from issuelens.llm.common import pack_ints, rolling, unpack_ints, word_hashes
from issuelens.llm.tokens import default_path

from .conftest import ODD, SCHEMA, rows_of

WORDS = default_path("word_bpe_49k.json")


LIBRARY = Tokenizer.from_file(WORDS)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


# -- common

@given(st.lists(st.integers(-(1 << 63), (1 << 63) - 1), max_size=20))
def test_packed_ints_come_back(values):
    v = np.array(values, np.int64)
    assert unpack_ints(pack_ints(v)).tolist() == values


def test_rolling_hashes_depend_on_the_words_alone():
    h = word_hashes([w.encode() for w in "a b c a b c a b d".split()])
    r = rolling(h, 3)
    assert r[0] == r[3] and r[0] != r[6] and len(set(r.tolist())) == 4


# -- sharding

def check_shards(rows, n):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r.slot)
        assert r.grown_shard in (r["shard"], n) and 0 <= r["shard"] < n
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def descent(key, tree):
    """The shard of a key by the published rule, recomputed: at each level the least of -ln(u) / weight."""
    import math
    import struct

    import xxhash

    def choose(level, children):
        def draw(node, weight):
            h = xxhash.xxh64(level.encode(), seed=42).intdigest()
            h = xxhash.xxh64(key.encode(), seed=h).intdigest()
            h = xxhash.xxh64(struct.pack("<i", node), seed=h).intdigest()
            return -math.log(((h >> 12) + 0.5) / (1 << 52)) / weight

        return min(children, key=lambda c: (draw(*c), c[0]))[0]

    region = choose("region", [(i, sum(map(len, r))) for i, r in enumerate(tree)])
    rack = choose("rack", [(region * 1000 + j, len(x)) for j, x in enumerate(tree[region])])
    return choose("shard", [(s, 1) for s in tree[region][rack % 1000]])


def test_shards_are_those_of_a_recomputed_descent(spark):
    docs = spark.createDataFrame(rows_of([(i * 7 - 50, f"t{i}") for i in range(600)] + [(None, "x")]), SCHEMA)
    for n in (24, 7):
        rows = sharding.shard_documents(docs, n).collect()
        for r in rows:
            key = "" if r.doc_id is None else str(r.doc_id)
            assert (r["shard"], r.grown_shard) == (descent(key, sharding.topology(n)), descent(key, sharding.topology(n + 1)))


def test_shards_slots_and_growth(spark, odd_docs, no_docs):
    docs = spark.createDataFrame(rows_of([(i, f"t{i}") for i in range(4000)]), SCHEMA).repartition(7)
    rows = sharding.shard_documents(docs, 24).collect()
    check_shards(rows, 24)
    n = Counter(r["shard"] for r in rows)
    assert len(n) == 24 and max(n.values()) < 1.5 * 4000 / 24 and min(n.values()) > 4000 / 24 / 1.5
    assert 0.02 < sum(r.grown_shard == 24 for r in rows) / 4000 < 0.065
    again = {r.doc_id: (r["shard"], r.grown_shard) for r in sharding.shard_documents(docs.coalesce(1), 24).collect()}
    assert again == {r.doc_id: (r["shard"], r.grown_shard) for r in rows}
    odd = sharding.shard_documents(odd_docs, 24).collect()
    check_shards(odd, 24)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in odd) == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in ODD)
    assert sharding.shard_documents(no_docs, 24).count() == 0


def test_a_changed_weight_moves_rows_only_to_or_from_its_subtree(spark):
    docs = spark.range(3000).select(F.col("id").cast("string").alias("k"))
    full = sharding.shard_of(docs, F.col("k"), 24, "s")
    less = sharding.shard_of(full, F.col("k"), 23, "t")  # the last rack loses a shard
    moved = less.where("s <> t").select("s", "t").collect()
    assert moved and all(r.s in range(18, 24) for r in moved)  # only from the region whose weight fell


# -- packing

def check_packing(spark, docs, texts, room):
    rows = packing.pack(docs, room=room).collect()
    want = Counter()
    for i, t in texts:
        ids = ids_of(t)
        want.update((i, k, a, len(ids[a : a + room]), crc(ids[a : a + room])) for k, a in enumerate(range(0, len(ids), room)))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= room
    return len(by), sum(r.length for r in rows)


def test_packing_odd_and_many_rows(spark, odd_docs, no_docs):
    check_packing(spark, odd_docs, ODD, 64)
    rnd = random.Random(2)
    texts = [(i, " ".join(rnd.choice(["a", "the", "cat"]) for _ in range(min(400, int(rnd.lognormvariate(3, 1)))))) for i in range(1500)]
    n, total = check_packing(spark, spark.createDataFrame(rows_of(texts), SCHEMA).repartition(5), texts, 128)
    assert n <= 1.02 * -(-total // 128) + 1
    assert packing.pack(no_docs).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=20))
def test_plans_take_every_piece_once(counts):
    groups = packing.plan_groups(counts, 64, classes=16)
    used = Counter()
    for g in groups:
        assert g.n > 0 and sum(k * m for k, m in g.parts) + g.gap == 64 and g.gap >= 0
        for k, m in g.parts:
            used[k] += m * g.n
    assert used == Counter(counts)


def test_nnls_finds_the_nonnegative_solution():
    rng = np.random.default_rng(0)
    a, x = rng.random((12, 8)), np.array([0, 2, 0, 1.5, 0, 0, 3, 0])
    assert np.allclose(packing.nnls(a, a @ x), x, atol=1e-6)
    assert (packing.nnls(a, -np.ones(12)) == 0).all()


# -- token store

def test_store_round_trip(spark, odd_docs, no_docs):
    for block_ids in (50, 1 << 20):
        rows = token_store.read_store(token_store.write_store(odd_docs, block_ids=block_ids)).collect()
        assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == Counter((i, len(ids_of(t)), crc(ids_of(t))) for i, t in ODD)
        at = 0
        for r in sorted(rows, key=lambda r: r.start):
            assert r.start == at
            at += r.n_tokens
        order = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
        assert order == sorted(order, key=lambda x: (x is not None, x or 0))
    assert token_store.read_store(token_store.write_store(no_docs)).count() == 0


@given(st.lists(st.integers(0, 5000), max_size=300))
def test_elias_fano_select_and_all(gaps):
    values = np.cumsum(np.array(gaps, np.int64)) if gaps else np.empty(0, np.int64)
    ef, end = token_store.EliasFano.read(b"xx" + token_store.EliasFano.of(values).to_bytes(), 2)
    assert ef.all().tolist() == values.tolist() == [ef.select(i) for i in range(len(values))]
    at = np.array([i * 7 % len(values) for i in range(len(values))], np.int64)
    assert ef.select_many(at).tolist() == values[at].tolist()
    if len(values) > 100:
        assert len(ef.low) + len(ef.high) < len(values) * (4 + np.log2(values[-1] / len(values) + 1)) / 8 + 8


def test_selects_of_wide_values_and_bounds():
    for step in (1, 1 << 20, 1 << 55, (1 << 62) - 1):
        values = np.arange(2, dtype=np.int64) * step + 3
        ef = token_store.EliasFano.of(values)
        assert ef.select_many(np.array([1, 0, 1])).tolist() == values[[1, 0, 1]].tolist() == [ef.select(i) for i in (1, 0, 1)]
    for bad in (-1, 2):
        with pytest.raises(IndexError):
            ef.select_many(np.array([0, bad]))
    lo, hi = -(1 << 63), (1 << 63) - 1
    assert token_store.Block(token_store.encode_block([lo, hi], [1, 1], b"\0\0\0\0", 2)).doc_ids(range(2)) == [lo, hi]


def test_a_full_read_selects_its_offsets(spark, odd_docs, monkeypatch):
    """Offsets come from select: a store is read though nothing may decode all ends."""
    store = token_store.write_store(odd_docs, block_ids=50)
    rows = [tuple(r) for r in store.select("payload").collect()]
    monkeypatch.setattr(token_store.EliasFano, "all", None)
    monkeypatch.setattr(token_store, "SLICE", 3)
    blocks = [token_store.Block(bytes(data)) for (data,) in rows]
    for b in blocks:
        starts, ends = b.ranges(range(b.n_docs))
        assert [b.ids[i:j].tolist() for i, j in zip(starts, ends, strict=True)] == [b.document(i).tolist() for i in range(b.n_docs)]


def test_block_documents():
    data = token_store.encode_block([None, -5, 7, 7], [1, 2, 3, 1], np.arange(7, dtype="<u2").tobytes(), 2)
    block = token_store.Block(data)
    assert block.doc_ids(range(4)) == [None, -5, 7, 7] and block.doc_ids(range(1)) == [None] and block.doc_ids(range(2, 3)) == [7]
    assert [x.tolist() for x in block.ranges(range(4))] == [[0, 1, 3, 6], [1, 3, 6, 7]]
    assert [x.tolist() for x in block.ranges(range(2, 4))] == [[3, 6], [6, 7]]
    assert [block.document(i).tolist() for i in range(4)] == [[0], [1, 2], [3, 4, 5], [6]]


# -- passages

def brute_passages(rows, n=13):
    words = [(i if i is not None else 1 << 63, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - n + 1):
            g = tuple(w[k : k + n])
            first[g] = min(first.get(g, i), i)
    out = Counter()
    for (i, _), (x, w) in zip(rows, words, strict=True):
        gone = {p for k in range(len(w) - n + 1) if first[tuple(w[k : k + n])] < x for p in range(k, k + n)}
        kept = [v for p, v in enumerate(w) if p not in gone]
        out[i, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()] += 1
    return out


def run_passages(docs, **more):
    return Counter((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in passages.dedup_passages(docs, **more).collect())


def test_passages_equal_brute_force(spark, odd_docs, no_docs, lot_rows=3):
    rnd = random.Random(4)
    shared = [" ".join(rnd.choice("abcd") for _ in range(n)) for n in (12, 13, 14, 30, 60)]
    rows = list(ODD)
    for i in range(10, 90):
        parts = [" ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 30)))]
        parts += rnd.sample(shared, rnd.randint(0, 2)) + [" ".join(f"u{rnd.randrange(50)}" for _ in range(rnd.randint(0, 20)))]
        rnd.shuffle(parts)
        rows.append((i, rnd.choice([" ", "\n"]).join(parts)))
    rows += [(i, rows[20][1]) for i in (200, 201, 201)] + [(None, rows[30][1])]
    docs = spark.createDataFrame(rows_of(rows), SCHEMA).repartition(4)
    assert run_passages(docs, lot_rows=lot_rows) == brute_passages(rows)
    assert run_passages(odd_docs) == brute_passages(ODD)
    out = passages.dedup_passages(docs, carry=("text", "lang"), lot_rows=lot_rows)
    assert out.columns == ["doc_id", "lang", "text", "n_words", "n_removed", "kept_text"] and out.where("text is not null").count() == sum(t is not None for _, t in rows)
    assert passages.dedup_passages(no_docs).count() == 0


@given(st.lists(st.sampled_from("ab"), min_size=13, max_size=60))
def test_a_window_s_anchor_depends_on_its_words_alone(words):
    h = word_hashes([w.encode() for w in words])
    a = passages.anchors(h, 13, 6)
    assert all(a[i] == passages.anchors(h[i : i + 13], 13, 6)[0] for i in range(len(a)))


# -- components

def test_lots_hold_few_bytes_or_one_row(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice((5, 20, 60, 150, 900))))) for i in range(60)]
    rows += [(60 + i, rows[i][1][40:]) for i in range(30)]
    df = spark.createDataFrame(rows_of(rows), SCHEMA).coalesce(1).withColumn("b", F.octet_length("text"))
    lots = df.withColumn("lot", passages.lot_of(F.monotonically_increasing_id(), F.col("b"), 16, 4000)).groupBy("lot").agg(F.count(F.lit(1)).alias("n"), F.sum("b").alias("b")).collect()
    assert all(r.n == 1 or (r.n <= 16 and r.b <= 4000) for r in lots) and 6 < len(lots) < 90 and any(r.n > 5 for r in lots)
    assert run_passages(df.coalesce(1), lot_rows=16, lot_bytes=4000) == run_passages(df.coalesce(1))


def test_components_of_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 300)] + [(7, 7), (500, 501), (501, 500)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(300)} | {500: 500, 501: 500}
    assert got == want
    assert components.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


# -- Jaccard join

def brute_classes(rows):
    text = {}
    for i, t in rows:
        text.setdefault(t or "", []).append(i)
    sets = {t: set(jaccard.ngram_set(t).tolist()) for t in text}
    keys = list(text)
    parent = {t: t for t in keys}

    def find(t):
        while parent[t] != t:
            t = parent[t]
        return t

    links = Counter()
    for x in range(len(keys)):
        for y in range(x):
            a, b = sets[keys[x]], sets[keys[y]]
            if a and b and 9 * len(a & b) >= 4 * (len(a) + len(b)):
                links[keys[x]] += 1
                links[keys[y]] += 1
                parent[find(keys[x])] = find(keys[y])
    low = lambda ids: min((i for i in ids if i is not None), default=None)
    members = defaultdict(list)
    for t in keys:
        members[find(t)] += text[t]
    return Counter((i, low(members[find(t or "")]), low(text[t or ""]), links[t or ""]) for i, t in rows)


def test_classes_equal_brute_force(spark, odd_docs, no_docs, block_nodes=3):
    rnd = random.Random(6)
    rows = list(ODD)
    for g in range(8):
        base = [f"w{rnd.randrange(400)}" for _ in range(rnd.choice([4, 30, 80, 300]))]
        for k in range(rnd.choice([1, 3, 12])):
            words = list(base)
            for _ in range(rnd.randint(0, max(1, len(words) // 60))):
                words[rnd.randrange(len(words))] = f"z{rnd.randrange(9)}"
            rows.append((100 * g + k + 10, " ".join(words)))
    rows += [(900 + i, rows[15][1]) for i in range(4)]
    docs = spark.createDataFrame(rows_of(rows), SCHEMA).repartition(4)
    got = jaccard.jaccard_classes(docs, block_nodes=block_nodes).collect()
    assert Counter((r.doc_id, r.class_id, r.copy_of, r.n_links) for r in got) == brute_classes(rows)
    n_classes = len({(r.class_id, r.key if r.class_id is None else None) for r in got})
    assert sum(r["first"] for r in got) == n_classes and all(r.doc_id == r.class_id for r in got if r["first"])
    odd = jaccard.jaccard_classes(odd_docs).collect()
    assert Counter((r.doc_id, r.class_id, r.copy_of, r.n_links) for r in odd) == brute_classes(ODD)
    assert jaccard.jaccard_classes(no_docs).count() == 0


def test_repeated_rows_reach_a_unit_once(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(7, text)] * 20 + [(None, text + " x")] * 15 + [(8, text + " y"), (9, "something else")]
    verified, seen = jaccard._verified, []

    def watched(units, *more):
        seen.append(units.groupBy("unit", "node").count().agg(F.max("count"), F.countDistinct("node")).first())
        return verified(units, *more)

    monkeypatch.setattr(jaccard, "_verified", watched)
    got = jaccard.jaccard_classes(spark.createDataFrame(rows_of(rows), SCHEMA), block_nodes=2).collect()
    assert [tuple(r) for r in seen] == [(1, 3)]
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got) == Counter({(7, 7, 2): 20, (None, 7, 2): 15, (8, 7, 2): 1, (9, 9, 0): 1})


def test_banding_reaches_its_recall():
    bands, rows = jaccard.bands_and_rows(0.8, 0.9999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999 and bands * rows <= 160
