"""The log of reachable commits against a walk in Python."""

import random
from datetime import datetime, timedelta, timezone

import pytest

from issuelens.operators.history import reachable_log

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = "sha string, parents array<string>, committed_date timestamp, message string, seq bigint"


def walk(rows, heads):
    """sha -> position, from the definition: reachable commits by descending corrected date, then sha."""
    by = {r[0]: r for r in rows}
    seen, todo = set(), [h for h in heads if h in by]
    while todo:
        s = todo.pop()
        if s not in seen:
            seen.add(s)
            todo += [p for p in by[s][1] or () if p in by]
    cd, left = {}, set(seen)
    while left:
        for s in sorted(left):
            ps = [p for p in by[s][1] or () if p in by]
            if all(p in cd for p in ps):
                own = -(1 << 53) if by[s][2] is None else int(by[s][2].timestamp())
                cd[s] = max([own, *(cd[p] + 1 for p in ps)])
                left.discard(s)
    return {s: k for k, s in enumerate(sorted(seen, key=lambda s: (-cd[s], s)))}


def made(seed, n=120):
    """Lines, branches and merges with clocks that run backwards now and then, ties, and lost parents."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        if i == 0 or rnd.random() < 0.03:
            parents = []
        else:
            parents = [f"c{i - 1 if rnd.random() < 0.8 else rnd.randrange(i)}"]
            parents += [f"c{rnd.randrange(i)}" for _ in range(rnd.choice([0, 0, 0, 1, 2]))]
        if rnd.random() < 0.03:
            parents.append("lost")
        date = None if rnd.random() < 0.02 else T0 + timedelta(seconds=i * 2 - rnd.choice([0, 0, 0, 1, 40]))
        rows.append((f"c{i}", parents, date, f"m{i}", 7))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_log_is_the_walk_s(spark, seed):
    rows = made(seed)
    c = spark.createDataFrame(rows + rows[:3], SCHEMA)
    heads = [f"c{len(rows) - 1}"] if seed else ["c60", "c61", "c61", "nowhere"]
    got = reachable_log(c, spark.createDataFrame([(h,) for h in heads], "sha string"), chunk=4)
    assert got.columns == ["sha", "parents", "committed_date", "message", "seq"]
    assert {r.sha: r.seq for r in got.collect()} == walk(rows, heads)
    assert got.count() == len(walk(rows, heads))


def test_a_long_line_takes_few_rounds_and_a_dead_branch_is_left_out(spark):
    n = 3000
    rows = [(f"{i:05}", [f"{i - 1:05}"] if i else [], T0, "", 0) for i in range(n)]
    rows += [("dead", ["00010"], T0 + timedelta(days=1), "", 0)]
    c = spark.createDataFrame(rows, SCHEMA)
    got = reachable_log(c, spark.createDataFrame([(f"{n - 1:05}",)], "sha string"), chunk=100)
    assert [r.sha for r in got.orderBy("seq").collect()] == [f"{i:05}" for i in reversed(range(n))]


def test_no_commits_and_no_heads(spark):
    none = spark.createDataFrame([], SCHEMA)
    one = spark.createDataFrame([("a", None, None, "", 0)], SCHEMA)
    assert reachable_log(none, one.select("sha")).count() == 0
    assert reachable_log(one, none.select("sha")).count() == 0
    assert [tuple(r) for r in reachable_log(one, one.select("sha")).select("sha", "seq").collect()] == [("a", 0)]


def test_a_cycle_is_an_error(spark):
    c = spark.createDataFrame([("a", ["b"], T0, "", 0), ("b", ["a"], T0, "", 0)], SCHEMA)
    with pytest.raises(ValueError, match="own ancestor"):
        reachable_log(c, c.select("sha"))
