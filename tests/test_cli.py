"""The command line builds the dataset from exported tables (same range rules as the reference)."""

import datetime as dt
import uuid

from issuelens.__main__ import main
from issuelens.session import ensure_checkpoint_dir


def test_cli_builds_and_appends(spark):
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/cli-{uuid.uuid4().hex}"
    d0, d1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    spark.createDataFrame([("r", 2, d0, "init #1", [], "T0"), ("a", 1, d1, "fix #1 #2", ["r"], "T1")],
                          "sha string, seq bigint, committed_date timestamp, message string, parents array<string>, "
                          "tree string").write.parquet(f"{base}/commits")
    spark.createDataFrame([("a", "x.py", 2, 1)], "sha string, path string, insertions bigint, deletions bigint") \
        .write.parquet(f"{base}/commit_files")
    spark.createDataFrame([("T0", "x.py", 1, "blob", "B0"), ("T1", "x.py", 1, "blob", "B1")],
                          "snapshot_sha string, path string, seq bigint, entry_type string, blob_sha string") \
        .write.parquet(f"{base}/trees")
    spark.createDataFrame([("B0", b"a = 1\n"), ("B1", b"a = 1\nb = 2\n")], "blob_sha string, content binary") \
        .write.parquet(f"{base}/blobs")
    spark.createDataFrame([(1, 1, 200, '{"body": "one"}'), (2, 1, 200, '{"body": "two"}')],
                          "issue_id bigint, attempt int, status int, payload string").write.parquet(f"{base}/responses")
    spark.createDataFrame([("one", [1.0]), ("two", [2.0])], "token string, vec array<float>") \
        .write.parquet(f"{base}/token_vectors")
    spark.createDataFrame([(1, "closed", d0), (2, "closed", d1), (3, "open", d1)],
                          "issue_id bigint, state string, created_at timestamp").write.parquet(f"{base}/issues")
    out = f"{base}/out"
    assert main(["--tables", base, "--output", out]) == 0            # --end 1: up to the last closed issue (2)
    rows = {r.issue_id: r for r in spark.read.json(out).collect()}
    assert set(rows) == {1, 2}
    assert (rows[1].NOC, rows[1].first_commit, rows[1].last_commit, rows[1].LOC_after) == (2, "r", "a", 2)
    assert rows[2].issue_description_embedding == [2.0]
    assert main(["--tables", base, "--output", out, "--start", "2", "--end", "2"]) == 0   # appends
    assert spark.read.json(out).count() == 3
    assert main(["--tables", base, "--output", out, "--start", "3", "--end", "2"]) == 1   # start > end
