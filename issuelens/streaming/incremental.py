"""Incremental dataset build over a stream of issue ids (the appending sink, S5, as a stream).

The reference processes issue numbers one after another and appends one JSON
line per finished issue.  Here new issue ids arrive as files (e.g. one file
per polling of the tracker); every micro-batch runs the same batch plan
(:func:`issuelens.plans.dataset.build_issue_dataset`) for the ids of that
batch and writes its records.

Per-blob statistics are kept in a table next to the stream's checkpoint, so
a blob shared by the trees of many micro-batches is measured once.

Output is exactly-once: each epoch writes its own folder ``epoch=<id>`` in
overwrite mode, so a micro-batch that is retried after a failure replaces
its earlier partial output instead of duplicating it.  Reading ``out_path``
gives the appended dataset, plus an ``epoch`` column (from the folder names)
that tells which micro-batch wrote each record.  Progress (which files were consumed) lives in
the streaming checkpoint under the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..plans.dataset import build_issue_dataset
from ..session import ensure_checkpoint_dir
from ..sources.sinks import write_dataset

ISSUE_IDS = T.StructType([T.StructField("issue_id", T.LongType(), False)])


def read_issue_stream(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Streaming source of issue ids: every new file under ``path`` is a batch of ids."""
    return spark.readStream.schema(ISSUE_IDS).format(fmt).load(path)


def start_dataset_stream(issue_ids: DataFrame, tables: dict, out_path: str, name: str = "issue-dataset",
                         available_now: bool = True, **build_options) -> StreamingQuery:
    """Start the incremental build.

    ``tables`` holds the batch inputs of :func:`build_issue_dataset`
    (commits, commit_files, snapshot_files, blobs, responses, lookup and
    optionally lint_lines).  ``available_now`` processes what has arrived and
    stops (the usual scheduled-job form); otherwise the query keeps running.
    """
    spark = issue_ids.sparkSession
    ckpt = ensure_checkpoint_dir(spark).rstrip("/") + f"/streams/{name}"
    # Blobs measured by one micro-batch are not measured again by the next.
    build_options.setdefault("stats_path", f"{ckpt}/blob-stats")

    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        ids = batch.select("issue_id").distinct()
        ds = build_issue_dataset(ids, tables["commits"], tables["commit_files"], tables["snapshot_files"],
                                 tables["blobs"], tables["responses"], tables["lookup"],
                                 lint_lines=tables.get("lint_lines"), **build_options)
        write_dataset(ds, f"{out_path.rstrip('/')}/epoch={epoch_id}", mode="overwrite")

    writer = (issue_ids.writeStream.queryName(name).foreachBatch(run_batch)
              .option("checkpointLocation", ckpt))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
