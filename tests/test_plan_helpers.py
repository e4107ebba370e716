"""Helpers that shape plans: bounded broadcasts and spreading under-split scans."""

from pyspark.sql import functions as F

from issuelens.operators.joins import bounded_broadcast
from issuelens.sources.parallel import ensure_parallelism


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bounded_broadcast_only_under_the_limit(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # no automatic broadcast in this test
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(0, 20000).withColumnRenamed("id", "k")
        small = spark.range(0, 50).withColumnRenamed("id", "k")
        assert "BroadcastHashJoin" in _plan(big.join(bounded_broadcast(small, max_rows=100), "k"))
        assert "BroadcastHashJoin" not in _plan(big.join(bounded_broadcast(small, max_rows=10), "k"))
        assert "BroadcastHashJoin" in _plan(big.join(bounded_broadcast(small, max_rows=10, upper_bound=5), "k"))
        joined = big.join(bounded_broadcast(small, max_rows=10), "k")
        assert joined.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_ensure_parallelism_spreads_only_small_partition_counts(spark):
    one = spark.range(0, 1000, numPartitions=1)
    many = spark.range(0, 1000, numPartitions=16)
    target = spark.sparkContext.defaultParallelism
    assert ensure_parallelism(one).rdd.getNumPartitions() == target
    assert ensure_parallelism(many).rdd.getNumPartitions() == 16
    assert ensure_parallelism(one).count() == 1000


def test_ranks_of_hot_and_null_groups(spark):
    from pyspark.sql import functions as F

    from issuelens.operators.ranking import prefix_within, rank_within
    rows = [(None if i % 3 == 0 else i % 2, i) for i in range(600)]
    df = spark.createDataFrame(rows, "g int, o int").repartition(5)
    want, seen = {}, {}
    for g, o in rows:
        seen[g] = seen.get(g, 0) + 1
        want[o] = seen[g]
    for n in (1, 7, 300):
        assert {r.o: r["rank"] for r in rank_within(df, ["g"], ["o"], num_chunks=n).collect()} == want
    sums = {r.o: r.s for r in prefix_within(df.withColumn("v", F.lit(2)), ["g"], ["o"], "s", "v", 300).collect()}
    assert sums == {o: 2 * (k - 1) for o, k in want.items()}


def test_ensure_parallelism_leaves_large_scans(spark, monkeypatch):
    from issuelens.sources import parallel
    monkeypatch.setattr(parallel, "MAX_BYTES", 10)
    one = spark.range(0, 1000, numPartitions=1)
    assert ensure_parallelism(one).rdd.getNumPartitions() == 1


def test_cluster_profile_reaches_the_configuration():
    from issuelens.__main__ import parse_args
    from issuelens.session import CLUSTER_CONF, session_conf
    args = parse_args(["--tables", "t", "--profile", "cluster"])
    conf = session_conf(profile=args.profile)
    assert args.master is None and all(conf[k] == v for k, v in CLUSTER_CONF.items())
    assert conf["spark.sql.shuffle.partitions"] == "8000"
    assert "spark.sql.shuffle.partitions" not in session_conf()


def test_cut_tables_are_dropped(spark):
    from issuelens.session import cut_lineage, drop_cut_tables, path_exists
    drop_cut_tables(spark)
    df = cut_lineage(spark.range(3))
    path = df.inputFiles()[0].rsplit("/", 1)[0]
    assert df.count() == 3 and path_exists(spark, path)
    assert drop_cut_tables(spark) == 1 and not path_exists(spark, path)


def test_shuffle_files_of_an_ended_job_go(spark):
    """The dataset's links leave no shuffle files behind when its texts are measured."""
    import gc
    import time

    from issuelens.session import cut_lineage, free_shuffles

    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(blocks.getAllFiles())
                     if f.getName().startswith("shuffle_")}
    old = files()
    cut_lineage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    new = files() - old
    assert new
    gc.collect()
    free_shuffles(spark)
    until = time.time() + 20
    while new & files() and time.time() < until:
        time.sleep(0.2)
    assert not new & files()
