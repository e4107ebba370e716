"""The change tracker on a path that most commits touched."""

from issuelens.plans.tracker import track_issue_changes


def test_every_issue_gets_a_revision_of_its_path(spark):
    n = 60
    commits = spark.createDataFrame([(f"c{i}", f"fix #{i}") for i in range(100, 100 + n)], "sha string, message string")
    # c100 to c158 changed the hot path, c159 changed nothing
    files = spark.createDataFrame([(f"c{i}", "hot.py") for i in range(100, 99 + n)] + [("c7", "hot.py"), ("c8", "other.py")],
                                  "sha string, path string")
    issues = spark.createDataFrame([(i,) for i in [*range(100, 100 + n), 999]], "issue_id long")
    got = track_issue_changes(issues, commits, files).collect()
    assert sorted(r.issue_id for r in got) == list(range(100, 99 + n))    # neither 159 nor 999, which no commit names
    touched = {f"c{i}" for i in range(100, 99 + n)} | {"c7"}
    assert all(r.commit_sha == f"c{r.issue_id}" and r.file_path == "hot.py" and r.n_history == n for r in got)
    assert {r.revision_sha for r in got} <= touched and len({r.revision_sha for r in got}) > n // 3
    again = track_issue_changes(issues, commits, files).collect()
    assert sorted(got) == sorted(again)


def test_no_commits_no_rows(spark):
    commits = spark.createDataFrame([], "sha string, message string")
    files = spark.createDataFrame([], "sha string, path string")
    issues = spark.createDataFrame([(1,)], "issue_id long")
    assert track_issue_changes(issues, commits, files).count() == 0


def test_commits_are_dealt_before_their_links_are_picked(spark):
    """One split of the log had all its links sorted in one task."""
    from issuelens.plans.tracker import dealt

    commits = spark.range(1000).selectExpr("cast(id as string) sha", "'see #1' message").coalesce(1)
    sizes = [r[0] for r in dealt(commits).selectExpr("spark_partition_id() p").groupBy("p").count().select("count").collect()]
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(sizes) < 500
