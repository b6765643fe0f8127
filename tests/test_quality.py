"""Keys and references: bitmaps and spans against the plain counts."""

import pytest
from pyspark.sql import functions as F

from clinloom.operators import quality
from clinloom.operators.quality import IdSpan, id_span


def ids(spark, values, kind="long"):
    return spark.createDataFrame([(v,) for v in values], f"id {kind}")


@pytest.mark.parametrize(
    "values, expected",
    [
        ([], IdSpan(0, 0, 0, None, None)),
        ([None, None], IdSpan(2, 2, 0, None, None)),
        ([3, 1, 2], IdSpan(3, 0, 3, 1, 3)),
        ([-2, -1, 0, 1, None], IdSpan(5, 1, 4, -2, 1)),
        ([7, 7, 9], IdSpan(3, 0, 2, 7, 9)),
        ([*range(32_760, 32_780), *range(65_530, 65_540)], IdSpan(30, 0, 30, 32_760, 65_539)),
    ],
)
def test_span_of_a_key(spark, values, expected):
    assert id_span(ids(spark, values), "id") == expected


def test_span_properties(spark):
    assert id_span(ids(spark, [5, 6, 7], "int"), "id").gapless and not id_span(ids(spark, [5, 7]), "id").gapless
    assert id_span(ids(spark, [5, None]), "id").unique and not id_span(ids(spark, [5, None, None]), "id").unique
    assert not id_span(ids(spark, []), "id").gapless and id_span(ids(spark, []), "id").unique
    assert id_span(ids(spark, ["a"], "string"), "id") is None


def plain_report(tables, keys):
    found = []
    for child, column, parent, key in keys:
        known = {r[0] for r in tables[parent].select(key).collect()}
        wrong = [r[0] for r in tables[child].select(column).collect() if r[0] is not None and r[0] not in known]
        found.append((child, column, parent, len(wrong), len(set(wrong))))
    return sorted(found)


def test_orphans_of_dense_sparse_and_text_parents(spark):
    tables = {
        "dense": spark.range(1, 1001).select("id"),
        "sparse": spark.range(1, 1001).where("id % 7 <> 0").select("id"),
        "text": spark.range(5).select(F.concat(F.lit("k"), "id").alias("id")),
        "empty": spark.range(0).select("id"),
        "child": spark.range(3000, numPartitions=5).select(
            F.when(F.col("id") % 3 == 0, F.lit(2000)).otherwise(F.col("id") % 1200).cast("int").alias("a"),  # a third of the rows on one orphan
            F.when(F.col("id") % 2 == 0, F.col("id") % 1000).alias("b"),
            F.concat(F.lit("k"), F.col("id") % 6).alias("c"),
            F.lit(None).cast("long").alias("d"),
            (-F.col("id")).alias("e"),
        ),
        "nobody": spark.range(0).select(F.col("id").alias("a")),
    }
    keys = [
        ("child", "a", "dense", "id"), ("child", "b", "sparse", "id"), ("child", "c", "text", "id"), ("child", "d", "dense", "id"),
        ("child", "e", "dense", "id"), ("child", "e", "empty", "id"), ("nobody", "a", "dense", "id"), ("dense", "id", "sparse", "id"),
    ]
    assert sorted(map(tuple, quality.orphan_report(tables, keys).collect())) == plain_report(tables, keys)


def test_dense_parents_are_not_joined(spark):
    tables = {"p": spark.range(1, 100).toDF("id"), "c": spark.range(5000).selectExpr("id AS x", "id AS y")}
    plan = quality.orphan_report(tables, [("c", "x", "p", "id"), ("c", "y", "p", "id")])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "LeftAnti" not in plan and plan.count("Range (") == 1


def test_repeated_keys(spark):
    tables = {
        "good": spark.range(10).toDF("id"),
        "bad": ids(spark, [1, 1, 1, 2, 3, 3]),
        "nulls": ids(spark, [None, None, 4]),
        "text": ids(spark, ["a", "b", "a"], "string"),
        "none": ids(spark, []),
    }
    found = {r["table_name"]: (r["duplicate_keys"], r["duplicate_rows"]) for r in quality.key_report(tables, dict.fromkeys(tables, "id")).collect()}
    assert found == {"good": (0, 0), "bad": (2, 5), "nulls": (1, 2), "text": (1, 2), "none": (0, 0)}
