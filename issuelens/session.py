"""Session helpers: a tuned SparkSession and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Tables written by cut_lineage and not yet dropped.
_TABLES: list[str] = []

# Settings every job of this library relies on.  AQE re-plans joins at runtime
# (broadcast only when the measured side is small, skew splitting otherwise).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


# Sizing for a large cluster reading ~100 TB (blob texts dominate):
# * text splits of 128 MB keep one task's regex pass in the tens of seconds
#   (text metrics run at roughly 5-10 MB/s per core) and give ~800k scan tasks;
# * 8000 shuffle partitions is the ceiling; AQE coalesces small shuffles
#   (advisory 256 MB) and splits skewed partitions (factor 4 over 512 MB);
# * broadcasts stay behind the measured threshold (64 MB) or the bounded
#   counts of ``operators.joins`` (``issuelens.broadcast.maxRows``).
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "issuelens.broadcast.maxRows": "2000000",
}


def session_conf(shuffle_partitions: int | None = None, extra: dict | None = None, profile: str = "local") -> dict:
    """The settings of :func:`get_spark`."""
    conf = dict(DEFAULT_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return {**conf, **(extra or {})}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, app: str = "issuelens",
              extra: dict | None = None, profile: str = "local") -> SparkSession:
    """The session for this library.

    ``profile="cluster"`` applies :data:`CLUSTER_CONF`; master and the
    checkpoint folder then come from the deployment (``master=None``: what
    spark-submit says).  ``shuffle_partitions`` sets that number, else the
    profile's or Spark's own holds.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in session_conf(shuffle_partitions, extra, profile).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster the folder is set by the deployment and is only read here (a
    missing setting is an error there).  A private temporary folder is created
    only in local mode when the setting is absent, as in tests.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="issuelens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a parquet table under the shared checkpoint folder and read it back.

    One job writes the table (a reliable ``checkpoint()`` of an uncached plan
    would compute it twice); later stages and any retry after a lost executor
    read the table instead of recomputing the plan behind it.
    """
    spark = df.sparkSession
    path = ensure_checkpoint_dir(spark).rstrip("/") + f"/tables/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    _TABLES.append(path)
    return spark.read.parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of jobs that have ended: it does so once the driver's garbage is collected,
    which may otherwise be long after."""
    spark.sparkContext._jvm.System.gc()


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete one table that :func:`cut_lineage` wrote, once nothing reads it."""
    if path in _TABLES:
        _TABLES.remove(path)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def last_table() -> str:
    """The folder of the last table that :func:`cut_lineage` wrote."""
    return _TABLES[-1]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, on whatever file system it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)


def drop_cut_tables(spark: SparkSession) -> int:
    """Delete the tables that :func:`cut_lineage` wrote in this program; for use once the results are written."""
    n = 0
    while _TABLES:
        p = spark._jvm.org.apache.hadoop.fs.Path(_TABLES.pop())
        n += bool(p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True))
    return n
