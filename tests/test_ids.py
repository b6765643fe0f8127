"""Dense ids: same as a global row number, also with hot keys and copies."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clinloom.operators.ids import Cells, _blocks, dense_ids
from clinloom.staging import walk_files


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, another large group of exact copies, some NULL keys."""
    return spark.range(30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 1000).cast("long").alias("k"),
        F.when(F.col("id") % 4 == 0, F.lit("copy")).otherwise(F.col("id").cast("string")).alias("v"),
    )


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_same_as_global_row_number(spark, store, skewed, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = dense_ids(skewed, "id", ["k"], store)
        expected = skewed.withColumn("id", F.row_number().over(Window.orderBy("k", "v")).cast("long")).select("id", "k", "v")
        assert found.rows == 30_000
        assert found.df.exceptAll(expected).count() == 0 and expected.exceptAll(found.df).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hot_key_and_copies_are_spread(spark, store, skewed):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        copies = skewed.select(F.lit(1).alias("k"), F.lit("same").alias("v"))
        table = dense_ids(copies, "id", ["k"], store).df
        assert table.select(F.input_file_name()).distinct().count() > 1
        assert table.agg(F.countDistinct("id"), F.max("id")).head()[0:2] == (30_000, 30_000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_ranges_are_cut_on_order_keys_and_one_hash(spark, store, skewed):
    """Rows that differ only beyond the order keys keep the order of all columns, wherever the ranges cut them."""
    wide = skewed.selectExpr("k", "IF(k IS NULL, 'n', 'x') AS n", "v", "concat(v, '-', coalesce(k, 0)) AS w")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = dense_ids(wide, "id", ["n"], store)
        expected = wide.withColumn("id", F.row_number().over(Window.orderBy("n", "k", "v", "w")).cast("long")).select("id", *wide.columns)
        assert found.rows == 30_000
        assert found.df.exceptAll(expected).count() == 0 and expected.exceptAll(found.df).count() == 0
        again = dense_ids(wide.repartition(11), "id", ["n"], store, first_id=5)
        assert again.df.withColumn("id", F.col("id") - 4).exceptAll(expected).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_first_exchange_has_no_other_columns(spark, store, skewed, monkeypatch):
    plans = []
    save = store.save
    monkeypatch.setattr(store, "save", lambda df, name: (plans.append(df._jdf.queryExecution().toString()), save(df, name))[1])
    dense_ids(skewed.withColumn("w", F.lit("wide")), "id", ["k"], store)
    exchange = next(line for line in plans[1].splitlines() if "rangepartitioning" in line)
    assert "_tie#" in exchange and " v#" not in exchange and " w#" not in exchange


def test_no_single_task_sort(store, skewed):
    plan = dense_ids(skewed, "id", ["k"], store).df._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_empty_input_and_first_id(store, skewed):
    assert dense_ids(skewed.where("false"), "id", ["k"], store).rows == 0
    assert dense_ids(skewed.limit(3), "id", ["k"], store, first_id=11).df.agg(F.min("id"), F.max("id")).head()[0:2] == (11, 13)


def test_ids_by_place_need_no_exchange(spark, store):
    from clinloom.operators.ids import placed_ids

    numbered = placed_ids(spark.range(100).repartition(5).selectExpr("id AS v"), "number", store, first_id=11)
    assert numbered.rows == 100 and sorted(r["number"] for r in numbered.df.collect()) == list(range(11, 111))
    assert sorted(r["v"] for r in numbered.df.collect()) == list(range(100))
    assert "Exchange hashpartitioning" not in numbered.df._jdf.queryExecution().toString() and "rangepartitioning" not in numbered.df._jdf.queryExecution().toString()
    assert placed_ids(spark.createDataFrame([], "v long"), "number", store).df.collect() == []


def test_large_tables_get_more_ranges_than_shuffle_partitions(spark, store, monkeypatch):
    from clinloom.operators import ids

    monkeypatch.setattr(ids, "SORTED_ROWS", 100)
    rows = spark.range(2_000, numPartitions=3).select((F.col("id") * 7 % 2_000).alias("k"), (F.col("id") % 3).alias("v"))
    numbered = dense_ids(rows, "n", ["k"], store)
    assert numbered.rows == 2_000
    assert numbered.df.where(F.col("n") != F.col("k") + 1).count() == 0
    blocks = [f for f in walk_files(spark, store.folder) if f.endswith(".parquet")]
    assert len(blocks) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert all(".zstd." in f for f in blocks)


@pytest.mark.parametrize("weight", [{}, {7: 1}, {7: 10_000}, {7: 10_000, 0: 10_000, 999: 10_000}])
def test_cells_only_balance_tasks(spark, store, skewed, monkeypatch, weight):
    """The same ids whatever the estimate, also where a cell is cut into several blocks, keys are null or beyond the cells."""
    from clinloom.operators import ids

    monkeypatch.setattr(ids, "SORTED_ROWS", 2_000)
    cells = Cells(F.col("k") * 2 - 20, [weight.get(n, 20) for n in range(1000)])
    found = dense_ids(skewed, "id", ["k"], store, first_id=3, cells=cells)
    expected = skewed.withColumn("id", (F.row_number().over(Window.orderBy("k", "v")) + 2).cast("long")).select("id", "k", "v")
    assert found.rows == 30_000
    assert found.df.exceptAll(expected).count() == 0 and expected.exceptAll(found.df).count() == 0
    assert dense_ids(skewed.where("false"), "id", ["k"], store, cells=cells).df.collect() == []


def test_rows_with_cells_are_written_once_and_not_sampled(store, skewed, monkeypatch):
    plans, save = [], store.save
    monkeypatch.setattr(store, "save", lambda df, name: (plans.append(df._jdf.queryExecution().toString()), save(df, name))[1])
    dense_ids(skewed.where("k < 1000"), "id", ["k"], store, cells=Cells(F.col("k"), [30] * 1000))
    assert len(plans) == 1 and "rangepartitioning" not in plans[0]


def test_blocks_of_cells(monkeypatch):
    from clinloom.operators import ids

    monkeypatch.setattr(ids, "SORTED_ROWS", 100)
    assert _blocks([40, 40, 40, 0, 250, 10], 1) == ([0, 0, 1, 1, 2, 5], [1, 1, 1, 1, 3, 1], 6)
    assert _blocks([0, 0], 8) == ([0, 0], [1, 1], 1)
    first, count, blocks = _blocks([10.0] * 1000, 8)
    assert blocks == 100 and first == sorted(first) and set(count) == {1}


def test_hot_cell_is_spread(spark, store, skewed):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        copies = skewed.select(F.lit(1).alias("k"), F.lit("same").alias("v"))
        table = dense_ids(copies, "id", ["k"], store, cells=Cells(F.col("k"), [0, 200_000, 0])).df
        assert table.select(F.input_file_name()).distinct().count() > 1
        assert table.agg(F.countDistinct("id"), F.max("id")).head()[0:2] == (30_000, 30_000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
