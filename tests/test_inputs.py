"""The given tables are read where they lie, and field checks read the sources once."""

from pyspark.sql import functions as F

from clinloom.staging import path_exists
from clinloom.testbed import queries
from clinloom.testbed.inputs import MOST_ROWS_OF_A_TASK, StagedTables


def test_split_tables_are_neither_copied_nor_staged(spark, store, tmp_path):
    n = F.col("id")
    keys = (n.alias("n_nationkey"), F.concat(F.lit("N"), n).alias("n_name"), (n % 5).alias("n_regionkey"))
    split = f"file://{tmp_path}/split"
    spark.range(4 * MOST_ROWS_OF_A_TASK, numPartitions=8).select(*keys).write.parquet(f"{split}/nation.parquet")
    tables = StagedTables(spark, split, store)
    assert tables["payers"].count() == 4 * MOST_ROWS_OF_A_TASK
    assert tables["organizations"].count() == 4 * MOST_ROWS_OF_A_TASK
    assert not path_exists(spark, store.folder)


def test_one_row_group_is_dealt_over_the_tasks(spark, store, tmp_path):
    whole = f"file://{tmp_path}/whole"
    rows = 4 * MOST_ROWS_OF_A_TASK
    spark.range(rows).coalesce(1).select(F.col("id").alias("n_nationkey"), F.lit("N").alias("n_name"), F.lit(0).alias("n_regionkey")).write.parquet(f"{whole}/nation.parquet")
    payers = StagedTables(spark, whole, store)["payers"]
    sizes = [r["count"] for r in payers.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == rows and max(sizes) < rows
    assert payers.select("Id").distinct().count() == rows


def test_field_checks_are_made_once(spark, monkeypatch):
    made = []
    real = queries._FieldChecks
    monkeypatch.setattr(queries, "_FieldChecks", lambda build: made.append(build) or real(build))
    for name in ("file_summary", "spec_full_outer"):
        assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
    assert len(made) == 2


def test_a_copy_is_neither_shuffled_nor_sorted(spark, store, tmp_path):
    """Each file of the copy holds rows that followed each other in the row group."""
    whole = f"file://{tmp_path}/whole"
    rows = 4 * MOST_ROWS_OF_A_TASK
    spark.range(rows).coalesce(1).select(F.col("id").alias("n_nationkey"), F.lit("N").alias("n_name"), F.lit(0).alias("n_regionkey")).write.parquet(f"{whole}/nation.parquet")
    copy = spark.read.parquet(StagedTables(spark, whole, store)._given("nation"))
    files = copy.groupBy(F.input_file_name()).agg(F.count("*").alias("n"), (F.max("n_nationkey") - F.min("n_nationkey") + 1).alias("span")).collect()
    assert len(files) >= spark.sparkContext.defaultParallelism
    assert sum(f["n"] for f in files) == rows and all(f["n"] == f["span"] for f in files)


def test_vocabulary_status_makes_the_field_checks_once(spark, monkeypatch):
    made = []
    real = queries._FieldChecks
    monkeypatch.setattr(queries, "_FieldChecks", lambda build: made.append(build) or real(build))
    assert queries.QUERIES["vocabulary_status"](spark, "/root/testdata/sf0.001").count() > 0
    assert len(made) == 1
