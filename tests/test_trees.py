"""Tree objects (S4), whole trees and tree digests from a version log (J6), against listings in Python."""

import random

import pytest
from pyspark.sql import functions as F

from issuelens.operators import treeobjects as TO
from issuelens.operators import versionlog as VL
from issuelens.operators.codemetrics import all_metrics, blob_metrics
from issuelens.operators.snapshots import tree_entries

OBJECTS = "tree_sha string, name string, entry_type string, child_sha string"
ENTRIES = [
    ("r1", "a.py", "blob", "b1"), ("r1", "lib", "tree", "t1"), ("r1", "lib2", "tree", "t1"), ("r1", "sub", "commit", "x"),
    ("r2", "lib", "tree", "t1"), ("r2", "empty", "tree", "t9"), ("r2", "a.py", "blob", "b1"), ("r2", "b.py", "blob", "b1"),
    ("t1", "c.py", "blob", "b2"), ("t1", "deep", "tree", "t2"), ("t1", "d.md", "blob", "b3"), ("t1", "lost.py", "blob", "b9"),
    ("t2", "e.py", "blob", "b1"), ("t2", "f.py", "blob", "b3"), ("r3", "only.md", "blob", "b1"),
]
TEXTS = [("b1", "x = 1\n# c\n"), ("b2", "if a and b:\n    y = a + b\n"), ("b3", "z\n")]


def test_listing_in_the_order_of_the_traversal(spark):
    t = spark.createDataFrame(ENTRIES + [("r1", "lib-b", "tree", "t2")], OBJECTS)
    got = TO.list_trees(t, spark.createDataFrame([("r1",), ("r3",), ("none",)], "tree_sha string")).orderBy("snapshot_sha", "seq").collect()
    assert [(r.seq, r.path, r.blob_sha) for r in got if r.snapshot_sha == "r1"] == [
        (1, "a.py", "b1"), (2, "lib-b/e.py", "b1"), (3, "lib-b/f.py", "b3"), (4, "lib/c.py", "b2"), (5, "lib/d.md", "b3"), (6, "lib/lost.py", "b9"),
        (7, "lib2/c.py", "b2"), (8, "lib2/d.md", "b3"), (9, "lib2/lost.py", "b9"),
        (10, "lib/deep/e.py", "b1"), (11, "lib/deep/f.py", "b3"), (12, "lib2/deep/e.py", "b1"), (13, "lib2/deep/f.py", "b3")]
    assert [(r.path, r.entry_type) for r in got if r.snapshot_sha == "r3"] == [("only.md", "blob")]


def test_metrics_from_tree_objects_equal_those_of_the_listing(spark):
    t = spark.createDataFrame(ENTRIES, OBJECTS)
    roots = spark.createDataFrame([("r1",), ("r2",), ("r3",)], "tree_sha string")
    measured = blob_metrics(spark.createDataFrame(TEXTS, "blob_sha string, text string"))
    flat = TO.list_trees(t, roots)
    files = tree_entries(flat, (".py",)).join(measured, "blob_sha")
    names = ["LOC", "Comments", "CyclomaticComplexity", "HalsteadMetrics", "n_files", "n_chars"]
    want = {r.snapshot_sha: tuple(r[c] for c in names) for r in all_metrics(files, ["snapshot_sha"]).collect()}
    got = {r.tree_sha: tuple(r[c] for c in names) for r in TO.tree_metrics(t, measured, (".py",)).collect()}
    assert got["r3"] == (0, 0, None, None, 0, 0)
    for root, row in want.items():
        assert got[root][2] == pytest.approx(row[2])
        assert got[root][:2] + got[root][3:] == row[:2] + row[3:]


def test_a_shared_tree_is_measured_once(spark):
    """64 roots of 64 folders that all hold one tree: as many sums as there are distinct trees."""
    rows = [(f"r{i}", f"f{k}", "tree", f"m{k}") for i in range(64) for k in range(64)]
    rows += [(f"m{k}", "x", "tree", "t") for k in range(64)] + [("t", f"{n}.py", "blob", "b") for n in range(50)]
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    values = spark.createDataFrame([("b", 3)], "blob_sha string, v bigint")
    t = spark.createDataFrame(rows, OBJECTS)
    t = t.where("entry_type <> 'blob'").unionByName(t.where("entry_type = 'blob'").mapInArrow(counted, t.schema))
    got = {r.tree_sha: r.v for r in TO.subtree_sums(t, values).collect()}
    assert len(got) == 129 and got["t"] == 150 and got["m5"] == 150 and got["r9"] == 64 * 150
    assert seen.value < 10 * 50  # the shared tree's entries are read by table, not by reference


def test_a_tree_inside_itself_is_an_error(spark):
    t = spark.createDataFrame([("a", "x", "tree", "b"), ("b", "y", "tree", "a")], OBJECTS)
    with pytest.raises(ValueError, match="part of itself"):
        TO.subtree_sums(t, spark.createDataFrame([("b", 1)], "blob_sha string, v bigint"))


LOG = "path string, seq bigint, blob_sha string, deleted boolean"


def listed(log, q, inclusive):
    """path -> (blob, seq) of the tree at a position."""
    tree = {}
    for path, seq, blob, deleted in sorted(log, key=lambda r: r[1]):
        if seq < q or inclusive and seq == q:
            tree[path] = None if deleted else (blob, seq)
    return {p: v for p, v in tree.items() if v}


def made_log(seed, n=400):
    rnd = random.Random(seed)
    rows = {}
    for _ in range(n):
        path = "hot" if rnd.random() < 0.35 else f"p{rnd.randrange(30)}"
        rows[path, rnd.randrange(-50, 500)] = (rnd.choice(["x", "y", "z"]), rnd.choice([True, False, False, None]))
    return [(p, s, None if d and s % 2 else b, d) for (p, s), (b, d) in rows.items()]


@pytest.mark.parametrize("inclusive", [True, False])
def test_whole_trees_against_listings(spark, inclusive):
    log = made_log(1)
    points = [(f"q{i}", q) for i, q in enumerate([-60, -50, -49, 0, 1, 2, 77, 78, 250, 499, 500, 501, 10_000])] + [("twin", 77)]
    v = spark.createDataFrame(log, LOG).repartition(5)
    p = spark.createDataFrame(points, "point_id string, query_seq bigint")
    trees = VL.trees_at(v, p, inclusive)
    plan = trees._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = {}
    for r in trees.collect():
        assert got.setdefault(r.point_id, {}).setdefault(r.path, (r.blob_sha, r.seq)) == (r.blob_sha, r.seq)
    assert {k: got.get(k, {}) for k, _ in points} == {k: listed(log, q, inclusive) for k, q in points}
    digests = {r.point_id: r for r in VL.tree_digests(v, p, inclusive).collect()}
    for a, qa in points:
        tree = listed(log, qa, inclusive)
        assert digests[a].n_files == len(tree)
        for b, qb in points:
            same = {k: x[0] for k, x in tree.items()} == {k: x[0] for k, x in listed(log, qb, inclusive).items()}
            assert (digests[a].digest == digests[b].digest) == same


def test_equal_trees_are_listed_once(spark):
    log = [("a", 1, "x", False), ("b", 2, "y", False), ("b", 3, None, True), ("a", 4, "z", False), ("a", 5, "x", False)]
    points = spark.createDataFrame([(i, i) for i in range(7)], "point_id bigint, query_seq bigint")
    known, files = VL.distinct_trees(spark.createDataFrame(log, LOG), points)
    by_digest = {}
    for r in files.collect():
        by_digest.setdefault(r.digest, []).append((r.path, r.blob_sha))
    assert len(by_digest) == 3
    assert {r.point_id: sorted(by_digest.get(r.digest, [])) for r in known.collect()} == {
        0: [], 1: [("a", "x")], 2: [("a", "x"), ("b", "y")], 3: [("a", "x")], 4: [("a", "z")], 5: [("a", "x")], 6: [("a", "x")]}


def test_empty_logs_and_no_points(spark):
    none = spark.createDataFrame([], LOG)
    p = spark.createDataFrame([("q", 1)], "point_id string, query_seq bigint")
    assert VL.trees_at(none, p).count() == 0
    assert [tuple(r) for r in VL.tree_digests(none, p).select("n_files", "digest").collect()] == [(0, "0:0")]
    some = spark.createDataFrame([("a", 1, "x", False)], LOG)
    assert VL.trees_at(some, p.limit(0)).count() == 0 and VL.tree_digests(some, p.limit(0)).count() == 0


def test_spans_without_points_are_dropped_before_they_are_cut_up(spark):
    """Of 20,000 versions only those that a point sees, and few besides, go into the join."""
    spans = spark.range(20_000).select((F.col("id") * 3).alias("_s"), (F.col("id") * 3 + 2).alias("_e"))
    at = spark.createDataFrame([(0,), (30_001,), (30_002,), (59_998,)], "_at bigint")
    kept = {(r[0], r[1]) for r in VL._met(spans, at, 60_000).collect()}
    seen = {(s, s + 2) for s in range(0, 60_000, 3) if any(s <= a < s + 2 for a in (0, 30_001, 30_002, 59_998))}
    assert seen <= kept and len(kept) < 20


def test_prefix_sums_of_several_values_in_one_pass(spark):
    from issuelens.operators.ranking import prefix_sums

    df = spark.createDataFrame([(i % 3 or None, i, i * 10, None if i % 4 else 1) for i in range(50)], "g int, o int, a bigint, b bigint")
    got = {r.o: (r.pa, r.pb, r.pn) for r in prefix_sums(df, ["g"], ["o"], {"pa": "a", "pb": "b", "pn": None}, 7).collect()}
    rows = [(i % 3 or None, i, i * 10, 0 if i % 4 else 1) for i in range(50)]
    for g, o, *_ in rows:
        before = [r for r in rows if r[0] == g and r[1] < o]
        assert got[o] == (sum(r[2] for r in before), sum(r[3] for r in before), len(before))


def test_version_log_needs_no_sorted_aggregate(spark, tmp_path):
    """A part's order is deleted if the greatest of its flags is R; flags of NULL don't count."""
    from issuelens.sources import bindings as B

    rows = [(1, 1, 2.0, "A"), (1, 1, 3.0, "R"), (1, 2, 1.0, "R"), (1, 2, 1.0, "S"), (1, 3, 1.0, None), (1, 4, 1.0, None), (1, 4, 1.0, "R"), (1, 5, 1.0, "N")]
    spark.createDataFrame(rows, "l_partkey bigint, l_orderkey bigint, l_quantity double, l_returnflag string").write.parquet(str(tmp_path / "lineitem.parquet"))
    log = B.version_log(spark, str(tmp_path))
    assert "SortAggregate" not in log._jdf.queryExecution().executedPlan().toString()
    assert {r.seq: r.deleted for r in log.collect()} == {1: True, 2: False, 3: None, 4: True, 5: False}
