"""JSON-lines sink of the per-issue dataset.

Spark drops NULL fields from JSON by default; the reference writes them, so
``ignoreNullFields`` is switched off.  Appending twice duplicates issues, as
in the reference; ``mode="overwrite"`` is the older version's behaviour.

An append with a run id can be retried: the run's records are written to a
hidden folder first, which is then renamed to the run's own.  The folders
of runs are the ledger: a run that has one is not written again, and what a
failed run left behind is replaced by its next try and never read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..schemas import DATASET_COLUMNS

#: What the folder of a committed run, and that of one still being written, begin with.
RUN, DRAFT = "run-", "_draft-"


def _fs(spark: SparkSession, path: str):
    """The file system of ``path`` and a function that makes paths for it."""
    at = spark._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def append_run(df: DataFrame, path: str, run_id: str, compression: str | None = None) -> bool:
    """S5 that can be retried: adds ``df`` once per ``run_id``; False if that run is already there.

    A folder is renamed in one step, so readers see all of a run or nothing.
    Two programs that write one run at the same time add it once: the later rename fails or finds it there.
    """
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", run_id):
        raise ValueError(f"no run id: {run_id!r}")
    fs, at = _fs(df.sparkSession, path)
    top = path.rstrip("/")
    done = at(f"{top}/{RUN}{run_id}")
    if fs.exists(done):
        return False
    draft = f"{top}/{DRAFT}{run_id}"
    write_dataset(df, draft, mode="overwrite", compression=compression)
    if fs.exists(done):  # another try was faster
        fs.delete(at(draft), True)
        return False
    if not fs.rename(at(draft), done):
        raise OSError(f"{draft} could not be renamed")
    return True


def runs(spark: SparkSession, path: str) -> list[str]:
    """The ledger: ids of the runs that ``path`` holds."""
    fs, at = _fs(spark, path)
    if not fs.exists(at(path)):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(at(path)) if f.isDirectory()]
    return sorted(n[len(RUN):] for n in names if n.startswith(RUN))


def read_dataset(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """All records below ``path``: plain appends and committed runs (drafts are hidden names)."""
    reader = spark.read.option("recursiveFileLookup", "true")
    return (reader.schema(schema) if schema is not None else reader).json(path)


def write_dataset(df: DataFrame, path: str, mode: str = "append", compression: str | None = None) -> None:
    """S5 (``append``) / S6 (``overwrite``): one JSON object per issue, nulls and [] kept."""
    if set(DATASET_COLUMNS) <= set(df.columns):
        df = df.select(*DATASET_COLUMNS)          # the record's field order
    writer = df.write.mode(mode).option("ignoreNullFields", "false")
    if compression:
        writer = writer.option("compression", compression)
    writer.json(path)


def overwrite_dataset(df: DataFrame, path: str) -> None:
    """Replace the dataset instead of appending."""
    write_dataset(df, path, mode="overwrite")
