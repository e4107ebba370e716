"""Scans of the exported repository tables.

A Git repository is exported once (commit log, per-commit file statistics,
trees, blobs, captured API responses) and read here with fixed schemas, so
nothing is inferred and column pruning / filter pushdown reach the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


def _read(spark: SparkSession, path: str, schema, fmt: str) -> DataFrame:
    reader = spark.read.schema(schema)
    if fmt == "json":
        return reader.json(path)
    return reader.format(fmt).load(path)


def scan_commits(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The commit log (sha, seq, committed_date, message, parents, tree)."""
    return _read(spark, path, schemas.COMMITS, fmt)


def scan_commit_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Per-commit file statistics, one row per (sha, path)."""
    return _read(spark, path, schemas.COMMIT_FILES, fmt)


def explode_file_stats(commits: DataFrame, files_col: str = "files") -> DataFrame:
    """S2 for a log exported with a ``files`` MAP<path, STRUCT<insertions, deletions>> column.

    A commit without an entry keeps no row here; churn left-joins, so it still
    counts with 0 files.
    """
    return commits.select("sha", F.explode(files_col).alias("path", "_s")).select(
        "sha", "path", F.col("_s.insertions").cast("bigint").alias("insertions"),
        F.col("_s.deletions").cast("bigint").alias("deletions"))


def scan_issue_responses(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """S3: captured issue API responses (issue_id, attempt, status, payload)."""
    return _read(spark, path, schemas.ISSUE_RESPONSES, fmt)


def scan_snapshot_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Tree entries (snapshot_sha, path, seq, entry_type, blob_sha)."""
    return _read(spark, path, schemas.SNAPSHOT_FILES, fmt)


def scan_blobs(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Blob contents (blob_sha, content)."""
    return _read(spark, path, schemas.BLOBS, fmt)


def scan_file_versions(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Version log (path, sha, seq, committed_date, content) for J6-J8."""
    return _read(spark, path, schemas.FILE_VERSIONS, fmt)


def scan_lint_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a linter report (``value``)."""
    return spark.read.text(path)
