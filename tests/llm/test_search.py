"""Ranked lexical search against a brute-force version."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from issuelens.llm import queries, search
from issuelens.llm.decontaminate import plain_words

from .conftest import ODD, SCHEMA, rows_of


def brute_force(docs, items, top=10):
    """(item_id, rank, doc_id, score) of every item, from the contract."""
    held = [(i, Counter(plain_words(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, c in held:
            n = sum(c.values())
            m = 100 - 75 + (75 * n * n_docs) // total
            s = 0
            for t in plain_words(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    s += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if s > 0:
                scored.append((-s, search.LAST if i is None else i))
        out += [(item, r, None if i == search.LAST else i, -s) for r, (s, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def made(seed, n_docs=400, n_items=25):
    rnd = random.Random(seed)
    vocab = [f"w{int(1 / (1 - rnd.random()))}" for _ in range(3000)]
    texts = [" ".join(rnd.choice(vocab) for _ in range(rnd.choice([1, 3, 20, 20, 60, 900]))) for _ in range(n_docs // 2)]
    docs = [(i, rnd.choice(texts)) for i in range(n_docs)]  # copies, so that scores tie
    docs += [(10_000 + i, "w1 " * rnd.choice([2, 5, 40])) for i in range(20)]
    items = [(i, " ".join(rnd.choice(vocab).upper() for _ in range(rnd.choice([1, 4, 30])))) for i in range(n_items)]
    return docs, items + [items[0], (1, "w1 w1 w2 W2"), (77, None), (78, "..."), (79, "nowhere"), (None, "w1 Ünïcödé")]


@pytest.mark.parametrize("seed", [0, 1])
def test_ranks_against_brute_force(spark, seed):
    docs, items = made(seed)
    docs = docs + ODD
    d = spark.createDataFrame(rows_of(docs), SCHEMA).repartition(3)
    q = spark.createDataFrame(items, "item_id bigint, text string")
    want = brute_force(docs, items)
    for kw in ({}, {"block_docs": 7}, {"block_bytes": 300}):
        assert sorted(map(tuple, search.search(d, q, **kw).collect()), key=str) == want
    assert len(want) > 150


def test_bounds_hold_and_exclude_documents():
    docs, items = made(5, 2000, 40)
    counts = [Counter(plain_words(t)) for _, t in docs]
    sizes = [sum(c.values()) for c in counts]
    df = Counter(t for c in counts for t in c)
    weights = [(i, {t: k * math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[t] + 1))) for t, k in Counter(plain_words(t)).items()}) for i, t in items if t]
    q = search.Queries(weights, len(docs), sum(sizes))
    m = [search.scale(n, q.docs, q.total) for n in sizes]
    for k, bound in enumerate(q.bounds(counts, np.array(m, np.int64))):
        exact = [q.exact(k, c, x) for c, x in zip(counts, m, strict=True)]
        assert all(b >= e for b, e in zip(bound.tolist(), exact, strict=True))
    best = search.Best(q, 10)
    for ids, cs, ns in search._blocks([_batch(docs)], 500, 1 << 30):
        best.add(ids, cs, ns)
    assert best.scored < len(docs) * len(q.items) / 4


def _batch(docs):
    import pyarrow as pa

    return pa.RecordBatch.from_pydict({"_doc": [i for i, _ in docs], "_text": [t for _, t in docs]})


def test_every_term_is_found_in_the_signatures():
    rnd = random.Random(2)
    counts = [Counter({b"t%d" % rnd.randrange(500): rnd.choice([1, 2, 3, 4, 9]) for _ in range(rnd.randint(1, 60))}) for _ in range(100)]
    q = search.Queries([(1, {b"t%d" % k: 1 for k in range(500)})], 1, 1)
    terms = sorted({b"t%d" % k for k in range(500)})
    present = [np.unpackbits(p, axis=1, count=100) for p in search.Signatures(counts).present(q.rows)]
    extra = 0
    for k, t in enumerate(terms):
        for doc, c in enumerate(counts):
            for level in range(search.LEVELS):
                assert present[level][k, doc] or c[t] < 1 << level
            extra += present[0][k, doc] and not c[t]
    assert extra < 0.05 * 500 * 100


def test_query_reads_whole_tables(spark, tmp_path):
    docs, items = made(7)
    spark.createDataFrame(rows_of(docs), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert sorted(map(tuple, queries.op13_signature_search(spark, str(tmp_path)).collect()), key=str) == brute_force(docs, items)


def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    items = [(1, "same twice row"), (2, "word5 of3 of4")]
    q = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "'x' as doc_id", "'x' as score", "'x' as rank")
    assert sorted(map(tuple, search.search(odd_docs, q).collect()), key=str) == brute_force(ODD, items)
    assert search.search(no_docs, q).count() == 0
    assert search.search(odd_docs, q.limit(0)).count() == 0
