"""Trees of commits (J4 / J5 / P4-P6), the as-of join J6 against brute force, J7 / J8."""

import random

import pytest
from pyspark.sql import functions as F

from issuelens.functions.text import CODE_SUFFIXES_AFTER, CODE_SUFFIXES_BEFORE
from issuelens.operators.snapshots import (after_snapshot, before_snapshot, codebase_files, file_content_at,
                                           file_history, versions_as_of)


def test_before_uses_first_parent_tree_and_root_is_empty(spark):
    commits = spark.createDataFrame(
        [("r", [], "t0"), ("a", ["r"], "t1"), ("b", ["a", "x"], "t2")],
        "sha string, parents array<string>, tree string")
    firsts = spark.createDataFrame([(1, "r", [], "b"), (2, "b", ["a", "x"], "b")],
                                   "issue_id bigint, first_commit string, first_parents array<string>, last_commit string")
    rows = after_snapshot(before_snapshot(firsts, commits), commits)
    got = {r.issue_id: (r.before_snapshot, r.after_snapshot) for r in rows.collect()}
    assert got == {1: (None, "t2"), 2: ("t1", "t2")}


def test_suffix_lists_are_asymmetric(spark):
    sf = spark.createDataFrame(
        [("t", "a.py", 1, "blob", "b1"), ("t", "b.html", 2, "blob", "b2"), ("t", "c.dart", 3, "blob", "b3"),
         ("t", "d.md", 4, "blob", "b1"), ("t", "sub", 5, "tree", None)],
        "snapshot_sha string, path string, seq bigint, entry_type string, blob_sha string")
    blobs = spark.createDataFrame([("b1", b"x"), ("b2", b"y"), ("b3", bytes.fromhex("ff61"))],
                                  "blob_sha string, content binary")
    snaps = spark.createDataFrame([("t",)], "snapshot_sha string")
    before = sorted(r.path for r in codebase_files(snaps, sf, blobs, CODE_SUFFIXES_BEFORE).collect())
    after = sorted(r.path for r in codebase_files(snaps, sf, blobs, CODE_SUFFIXES_AFTER).collect())
    assert before == ["a.py", "b.html"]      # c.dart is not UTF-8, d.md not code, sub not a blob
    assert after == ["a.py"]


def test_versions_as_of_equals_brute_force(spark):
    rnd = random.Random(11)
    versions = []
    for p in range(12):
        seqs = sorted(rnd.sample(range(0, 400), rnd.randint(0, 40 if p else 200)))   # path 0 is hot
        versions += [(f"p{p}", f"p{p}@{s}", s) for s in seqs]
    queries = [(f"p{rnd.randrange(13)}", rnd.randrange(-5, 420)) for _ in range(600)]
    vdf = spark.createDataFrame(versions, "path string, sha string, seq bigint")
    qdf = spark.createDataFrame(queries, "path string, query_seq bigint")
    for inclusive in (True, False):
        got = sorted((r.path, r.query_seq, r.sha) for r in
                     versions_as_of(vdf, qdf, inclusive=inclusive, chunk=16).collect())
        want = []
        for p, q in queries:
            cands = [(s, sha) for (vp, sha, s) in versions if vp == p and (s <= q if inclusive else s < q)]
            if cands:
                want.append((p, q, max(cands)[1]))
        assert got == sorted(want)


def test_history_and_content_lookup(spark):
    v = spark.createDataFrame([("f", "s1", 1, b"one"), ("f", "s2", 2, bytes.fromhex("ff")), ("g", "s3", 1, b"g")],
                              "path string, sha string, seq bigint, content binary")
    hist = [(r.path, r.sha) for r in file_history(v, spark.createDataFrame([("f",)], "path string")).collect()]
    assert hist == [("f", "s2"), ("f", "s1")]
    look = spark.createDataFrame([("f", "s1"), ("f", "s2"), ("f", "zz")], "path string, sha string")
    assert [(r.sha, r.content) for r in file_content_at(v, look).collect()] == [("s1", "one")]


@pytest.mark.parametrize("bound", [1_000_000, 3, 0])
def test_files_of_each_rows_tree_in_packs(spark, bound):
    """All ids of one tree: its files come from many tasks, whichever side is broadcast."""
    from issuelens.operators.joins import CONF_KEY
    from issuelens.operators.snapshots import named_files

    rows = [(i if i else None, "t") for i in range(100)] + [(5, "t"), (200, "u"), (201, None), (202, "none")]
    entries = [("t", f"{i}.py", f"b{i}") for i in range(5)] + [("t", "0.py", "b0"), ("u", "x.py", None), ("v", "y.py", "b")]
    r = spark.createDataFrame(rows, "issue_id bigint, before_snapshot string")
    e = spark.createDataFrame(entries, "snapshot_sha string, path string, blob_sha string")
    spark.conf.set(CONF_KEY, str(bound))
    try:
        found = named_files(r, e, "before_snapshot", pack=8).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset(CONF_KEY)
    key = lambda x: tuple((v is not None, v) for v in x)
    want = [(i, s, p, b) for i, t in rows for s, p, b in entries if s == t]
    assert sorted(((x.issue_id, x.snapshot_sha, x.path, x.blob_sha) for x in found), key=key) == sorted(want, key=key)
    if bound > 3:
        assert len({x.task for x in found if x.snapshot_sha == "t"}) > 1


@pytest.mark.parametrize("bound", [1_000_000, 0])
def test_no_row_is_multiplied_by_a_whole_tree(spark, bound):
    """Spark holds what comes of one row: a unit has some ids and some files of its tree, however large that is."""
    from issuelens.operators.joins import CONF_KEY
    from issuelens.operators.snapshots import file_units

    r = spark.range(2000).selectExpr("if(id > 5, id, null) issue_id", "'t' before_snapshot")
    e = spark.range(3000).selectExpr("'t' snapshot_sha", "concat(id div 2, '.py') path", "'b' blob_sha")
    spark.conf.set(CONF_KEY, str(bound))
    try:
        units = file_units(r, e, "before_snapshot", pack=16, block=32).selectExpr(
            "size(_ids) i", "size(_files) f", "_pack p", "_block b").collect()
    finally:
        spark.conf.unset(CONF_KEY)
    assert sum(x.i * x.f for x in units) == 2000 * 3000
    assert max(x.i for x in units) <= 4 * 16 and max(x.f for x in units) <= 4 * 32
    assert len({(x.p, x.b) for x in units}) == len(units)
