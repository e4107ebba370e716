"""Command line: build the per-issue dataset from exported repository tables.

    python -m issuelens --tables DIR [--start N] [--end N] [--output PATH] [--overwrite]
                        [--duplication blocks|lint] [--lint-report PATH] [--python-mode]
                        [--master URL] [--profile local|cluster]

``DIR`` holds parquet folders ``commits``, ``commit_files``, ``trees``
(snapshot files), ``blobs``, ``responses`` (captured issue API responses),
``token_vectors`` and, for ``--end 1`` ("up to the last closed issue"),
``issues``.  The issue range follows the reference: inclusive, ``--end 1``
is the sentinel, and a start after the end is an error.  Records are appended
to ``--output`` as JSON lines (``--overwrite`` replaces them).
"""

from __future__ import annotations

import argparse
import os
import sys

from .operators.descriptions import issue_range, last_closed_issue
from .operators.embed import VectorLookup
from .operators.history import reachable_log
from .plans.dataset import build_issue_dataset
from .session import drop_cut_tables, get_spark
from .sources import tables as S
from .sources.sinks import append_run, write_dataset
from . import schemas


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="python -m issuelens", description=__doc__.split("\n\n")[0])
    p.add_argument("--tables", required=True, help="folder with the exported tables (parquet)")
    p.add_argument("--start", type=int, default=1, help="first issue number (inclusive)")
    p.add_argument("--end", type=int, default=1, help="last issue number (inclusive); 1 = last closed issue")
    p.add_argument("--output", default="data/issue_dataset", help="JSON-lines output folder")
    p.add_argument("--overwrite", action="store_true", help="replace the output instead of appending")
    p.add_argument("--run-id", help="append under this id: a run that is repeated adds nothing")
    p.add_argument("--head", help="commit whose log is read; by default all commits of the table, by their seq")
    p.add_argument("--duplication", choices=("blocks", "lint"), default="blocks")
    p.add_argument("--lint-report", help="text file of a linter report (with --duplication lint)")
    p.add_argument("--python-mode", action="store_true", help="complexity / Halstead from the Python parser")
    p.add_argument("--master", default=None, help="Spark master (default: what spark-submit says)")
    p.add_argument("--profile", choices=("local", "cluster"), default="local",
                   help="cluster: sizes for a large cluster (splits, shuffle partitions, broadcasts)")
    return p.parse_args(argv)


def main(argv=None) -> int:
    args = parse_args(argv)
    if args.start > args.end:
        print("start issue number must be less than or equal to end issue number", file=sys.stderr)
        return 1
    spark = get_spark(args.master, profile=args.profile)
    t = lambda name: os.path.join(args.tables, name)
    last = None
    if args.end == 1:
        issues = spark.read.schema(schemas.ISSUES).parquet(t("issues"))
        last = last_closed_issue(issues)
    ids = issue_range(spark, args.start, args.end, last)
    commits = S.scan_commits(spark, t("commits"))
    if args.head:
        commits = reachable_log(commits, spark.createDataFrame([(args.head,)], "sha string"))
    ds = build_issue_dataset(
        ids, commits, S.scan_commit_files(spark, t("commit_files")),
        S.scan_snapshot_files(spark, t("trees")), S.scan_blobs(spark, t("blobs")),
        S.scan_issue_responses(spark, t("responses"), fmt="parquet"),
        VectorLookup(spark.read.schema(schemas.TOKEN_VECTORS).parquet(t("token_vectors"))),
        lint_lines=S.scan_lint_lines(spark, args.lint_report) if args.lint_report else None,
        duplication=args.duplication, mode="python" if args.python_mode else "lexical")
    if args.run_id:
        append_run(ds, args.output, args.run_id)
    else:
        write_dataset(ds, args.output, mode="overwrite" if args.overwrite else "append")
    drop_cut_tables(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
