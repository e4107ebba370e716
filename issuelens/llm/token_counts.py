"""Token counts (4): Arrow batches balanced by bytes go in, lengths only come out."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuelens.llm.common import pick, small_batches
from issuelens.llm.tokens import ByteCounter, default_path, opened

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 1024, batch_bytes: int = 2 << 20) -> DataFrame:
    """Tokens of every whole text, without added special tokens.

    Rows map one to one, so repeated rows and null ids pass through.  A null
    text counts as empty (0 bytes, 0 tokens).  Rows are encoded in groups of
    about ``batch_bytes`` of text; a text of any length is split at safe
    boundaries (see ``tokens.UNIT``), so no call sees a long text whole.
    Other columns are ignored.
    """
    path = path or default_path("byte_bpe_50k.json")
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

    def run(batches):
        counter = opened(ByteCounter, path)
        for b in batches:
            sizes, texts = b.column("n_bytes").to_pylist(), b.column("text")
            n, i = [], 0
            while i < len(sizes):  # groups of like bytes, however long single texts are
                j, size = i, 0
                while j < len(sizes) and (j == i or size + sizes[j] <= batch_bytes):
                    size += sizes[j]
                    j += 1
                n += counter.counts(texts.slice(i, j - i).to_pylist())
                i = j
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], schema=schema)

    small_batches(docs.sparkSession)
    d = pick(docs, "doc_id", "text")
    d = d.select(d.doc_id.cast("long").alias("doc_id"), "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return d.mapInArrow(run, SCHEMA)
