"""The incremental build equals the batch build over the same issue ids; a re-run adds nothing."""

import json
import os
import uuid

from issuelens.plans.dataset import build_issue_dataset
from issuelens.session import ensure_checkpoint_dir
from issuelens.sources import bindings as B
from issuelens.streaming.incremental import read_issue_stream, start_dataset_stream

from conftest import SF_SMALL


def test_stream_equals_batch(spark):
    d = SF_SMALL
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/stream-test-{uuid.uuid4().hex}"
    inbox, out = f"{base}/inbox", f"{base}/out"
    os.makedirs(inbox)
    for k, ids in enumerate([[1, 2, 3, 4, 5], [6, 7, 8], [9, 10, 11, 12]]):
        with open(f"{inbox}/ids-{k}.json", "w") as fh:
            fh.write("\n".join(json.dumps({"issue_id": i}) for i in ids))
    tables = dict(commits=B.commits(spark, d), commit_files=B.commit_files(spark, d),
                  snapshot_files=B.snapshot_files(spark, d), blobs=B.blobs(spark, d),
                  responses=B.issue_responses(spark, d), lookup=B.token_lookup(spark, d))
    q = start_dataset_stream(read_issue_stream(spark, inbox), tables, out, name=f"t{uuid.uuid4().hex[:8]}",
                             checkpoint=False)
    q.awaitTermination(300)
    streamed = sorted((r.issue_id, r.NOC, r.LOC_before) for r in spark.read.json(out).collect())
    ids = spark.range(1, 13).withColumnRenamed("id", "issue_id")
    batch = build_issue_dataset(ids, tables["commits"], tables["commit_files"], tables["snapshot_files"],
                                tables["blobs"], tables["responses"], tables["lookup"], checkpoint=False)
    assert streamed == sorted((r.issue_id, r.NOC, r.LOC_before) for r in batch.collect())
