"""Stage tables leave nothing but themselves."""

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from clinloom.operators.ids import dense_ids
from clinloom.staging import walk_files

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark) -> int:
    return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()


def test_shuffle_files_go_with_the_write(spark, store):
    before = shuffle_files(spark)
    rows = spark.range(10_000, numPartitions=8).withColumn("k", F.xxhash64("id"))
    saved = store.save(rows.repartition(8, "k"), "rows")
    until = time.time() + 5
    while shuffle_files(spark) > before and time.time() < until:
        time.sleep(0.1)
    assert shuffle_files(spark) <= before
    assert saved.count() == 10_000


def test_the_setting_of_the_session_stays(spark, store):
    rows = spark.range(1_000).withColumn("k", F.col("id") % 7).repartition(4, "k")
    with ThreadPoolExecutor(4) as pool:
        saved = list(pool.map(lambda n: store.save(rows, f"rows{n}"), range(8)))
    assert spark.conf.get(CLEANUP) == "false"
    spark.conf.set(CLEANUP, "true")
    try:
        store.save(rows, "more")
        assert spark.conf.get(CLEANUP) == "true"
    finally:
        spark.conf.unset(CLEANUP)
    again = saved[0].groupBy("k").count()
    assert again.collect() and again.collect()


def test_numbered_tables_hold_no_hash_of_the_order(spark, store):
    dense_ids(spark.range(1_000, numPartitions=4).withColumn("k", F.col("id") % 10), "n", ["k"], store)
    columns = {c for f in walk_files(spark, store.folder) if f.endswith(".parquet") for c in spark.read.parquet(f).columns}
    assert "id" in columns and "k" in columns and "_key" not in columns
