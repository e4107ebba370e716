"""Line dedup against a brute-force version."""

import hashlib
import random
import string

import pytest

from issuelens.llm import lines, queries

from .conftest import ODD, SCHEMA, rows_of

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def key_of(line):
    return line.strip(lines.BLANKS).translate(LOWER)


def brute_force(rows, min_chars=20, min_docs=3):
    """(doc_id, n_lines, n_dropped, kept text) of every row."""
    order = lambda i: -(1 << 63) if i is None else i
    held = {}
    for i, t in rows:
        for s in (t or "").split("\n"):
            if len(key_of(s)) >= min_chars:
                held.setdefault(key_of(s), set()).add(order(i))
    out = []
    for i, t in rows:
        own = (t or "").split("\n")
        stay = [s for s in own if len(held.get(key_of(s), ())) < min_docs or max(held[key_of(s)]) == order(i)]
        out.append((i, len(own), len(own) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def made(n, seed):
    """Texts of lines that few, some and nearly all documents hold, in several spellings."""
    rnd = random.Random(seed)
    pool = [f"a line that some of the documents hold, number {k}" for k in range(40)] + ["É" * 20, "é" * 20, "short line", "", "x" * 19, "İ" * 20]
    hot = "The one line that nearly every document holds somewhere"
    rows = []
    for i in range(n):
        own = [rnd.choice(pool) for _ in range(rnd.randint(0, 8))] + [f"only document {i} holds this line"]
        own += [hot] * (rnd.random() < 0.8) + [hot.upper() + " \t"] * (rnd.random() < 0.3)
        own = [s.upper() if rnd.random() < 0.2 else f" {s}\r" if rnd.random() < 0.2 else s for s in own]
        rnd.shuffle(own)
        rows.append((rnd.choice([i, i, i, i // 7, None]) if seed else i, "\n".join(own)))
    return rows + ODD


@pytest.mark.parametrize("seed", [0, 1])
def test_lines_against_brute_force(spark, seed):
    rows = made(250, seed)
    docs = spark.createDataFrame(rows_of(rows), SCHEMA).repartition(5)
    want = brute_force(rows)
    for batches, fanout in ((8, 4), (5, 2), (1, 4)):
        got = lines.dedup_lines(docs, batches=batches, fanout=fanout).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
        assert sorted(map(tuple, got), key=str) == want
    assert sum(r[2] for r in want) > 200


def test_query_gives_digests_of_the_kept_lines(spark, tmp_path):
    rows = made(60, 0)
    spark.createDataFrame(rows_of(rows), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op12_levelled_lines(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted([(*r[:3], hashlib.sha256(r[3].encode()).hexdigest()) for r in brute_force(rows)], key=str)


def test_levels_are_compacted_and_settled_lines_are_not_added_again(spark):
    runs = lines.LineRuns(min_docs=2, fanout=3)
    for k in range(7):  # documents 13, 12, then 11, 10, ...
        runs.add(spark.createDataFrame([(b"hot", 13 - 2 * k), (b"hot", 12 - 2 * k), (b"%d" % k, 13 - 2 * k), (b"two", k - 20) if k in (1, 6) else (b"x%d" % k, -k)], "key binary, doc long"))
    assert [len(level) for level in runs.levels] == [1, 2]
    hot = [r for run in runs.runs() for r in run.where("key = cast('hot' as binary)").collect()]
    assert [tuple(r)[1:] for r in hot] == [(13, 2)]
    assert sorted(map(tuple, runs.repeated().collect())) == [(b"hot", 13), (b"two", -14)]


def test_runs_are_merge_joined(spark):
    runs = lines.LineRuns()
    one = spark.createDataFrame([(b"a", 3), (b"a", 2), (b"a", 1)], "key binary, doc long")
    runs.add(one)
    own = one.groupBy("key").count().join(runs.runs()[0].where("n >= 3").select("key").hint("merge"), "key", "left_anti")
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan


def test_odd_rows_and_extra_columns(spark, odd_docs, no_docs):
    got = lines.dedup_lines(odd_docs, carry=("lang", "text"), min_docs=2, min_chars=3)
    assert got.columns == ["doc_id", "lang", "text", "n_lines", "n_dropped", "kept_text"]
    rows = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got.collect()), key=str)
    assert rows == brute_force(ODD, 3, 2)
    assert lines.dedup_lines(no_docs).count() == 0
