"""Periodic run detection against a brute-force version."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from issuelens.llm import periodic, queries

from .conftest import ODD, SCHEMA, rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w):
    """All maximal runs, every lag compared with every word; of equal stretches the smallest period."""
    ids = np.unique(np.array(w), return_inverse=True)[1]
    best = {}
    for q in range(1, len(w) // 4 + 1):
        same = np.flatnonzero(ids[q:] == ids[:-q])
        for group in np.split(same, np.flatnonzero(np.diff(same) > 1) + 1) if len(same) >= 3 * q else ():
            if len(group) and len(group) + q >= max(6, 4 * q):
                best.setdefault((int(group[0]), len(group) + q), q)
    return sorted((s, n, q) for (s, n), q in best.items())


def brute_row(doc_id, text):
    """The query's row of a document, from its contract."""
    w = WORD.findall(text or "")
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *head, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=40), st.integers(1, 7)), max_size=6))
def test_runs_of_repeated_pieces(pieces):
    w = [x for piece, n in pieces for x in piece * n]
    got = periodic.find_runs(np.array(w, np.int64), len(w))
    assert list(zip(*(c.tolist() for c in got), strict=True)) == brute_runs(w)


def test_nested_and_broken_repetitions():
    for seed in range(400):
        rnd = random.Random(seed)
        piece = [rnd.randint(0, 50) for _ in range(rnd.choice([8, 9, 15, 16, 17, 31, 32, 40]))]
        inner = piece[: len(piece) // 2] * 2 + [99] * rnd.randint(0, 9)
        w = (piece if seed % 2 else inner) * rnd.randint(3, 6)
        w[rnd.randrange(len(w))] = -1  # cuts the run
        w = w + w[: rnd.randrange(len(w))]
        got = periodic.find_runs(np.array(w, np.int64), len(w))
        assert list(zip(*(c.tolist() for c in got), strict=True)) == brute_runs(w)


@pytest.mark.parametrize("w", [np.zeros(300_000, np.int64), np.tile(np.arange(50), 6000), np.tile(np.r_[np.zeros(40, np.int64), 1], 7000)])
def test_a_long_text_of_one_passage_takes_seconds(w):
    start, length, period = periodic.find_runs(w, len(w))
    assert (0, len(w)) in zip(start.tolist(), length.tolist(), strict=True)


def test_fewer_than_three_periods_are_refused():
    with pytest.raises(ValueError, match="three periods"):
        periodic.find_runs(np.zeros(9, np.int64), 9, min_exponent=2)


def test_query_against_brute_force(spark, tmp_path):
    rnd = random.Random(3)
    vocab = [f"w{k}" for k in range(30)] + ["é", " ", "日本"]
    texts = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([0, 1, 5, 30, 200])))) for i in range(300)]
    texts += [(1000 + i, ("\t".join(vocab[: 1 + i]) + "\n") * 6) for i in range(20)] + ODD
    spark.createDataFrame(rows_of(texts), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect()]
    want = [brute_row(i, t) for i, t in texts]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(r[1] > 0 for r in want) > 20


def test_odd_rows_and_extra_columns(spark, odd_docs, no_docs):
    got = periodic.periodic_runs(odd_docs, carry=("lang",))
    assert got.columns == ["doc_id", "lang", "n_words", "runs", "best", "collapsed_text"]
    rows = {(r.doc_id, r.n_words): r for r in got.collect()}
    last = rows[8, 20]
    assert [tuple(r) for r in last.runs] == [(0, 20, 5)] and tuple(last.best) == (0, 20, 5) and last.collapsed_text == "a b c d e"
    assert rows[1, 0].runs == [] and rows[1, 0].best is None and rows[1, 0].collapsed_text == ""
    assert got.count() == len(ODD)
    assert periodic.periodic_runs(no_docs).count() == 0
