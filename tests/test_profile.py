"""Type inference and profiles on small tables."""

import datetime as dt

from pyspark.sql import functions as F

from clinloom.operators import profile

UUIDS = ["8c8e1c9a-b310-43c6-33a7-ad11bad21c40", "034E9E3B-2DEF-4559-BB2A-7850888AE060"]


def table(spark, rows, columns):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns)).coalesce(1)


def test_two_row_profile(spark):
    columns = ["Id", "BIRTHDATE", "UPDATED", "COST", "NAME"]
    df = table(
        spark,
        [(UUIDS[0], "2017-08-24", "2019-02-17T05:07:38Z", "129.16", "Ann"), (UUIDS[1], "2016-08-01", "2019-03-24T05:07:38Z", "88.00", " ")],
        columns,
    )
    rows = {r["column_name"]: r for r in profile.column_profile(df, columns, "patients.csv").collect()}
    assert [rows[c]["inferred_type"] for c in columns] == ["uuid", "date", "datetime", "decimal", "text"]
    assert (rows["NAME"]["blank_count"], rows["NAME"]["completeness_pct"]) == (1, 50.0)
    assert (rows["COST"]["min_value"], rows["COST"]["max_value"]) == ("88", "129.16")
    assert rows["UPDATED"]["min_value"] == "2019-02-17 05:07:38"
    assert rows["Id"]["sample_values"] == " | ".join(UUIDS)


def test_labels(spark):
    columns = ["flag", "whole", "real", "gone", "day", "mixed"]
    rows = [("0", "-3", "1e3", None, "2020-02-29", "1"), ("y", "+7", ".5", " ", "2019-02-29", "x")]
    found = {r["column_name"]: r["inferred_type"] for r in profile.infer_full_types(table(spark, rows, columns), columns).collect()}
    # an impossible date makes the column text; it does not fail the run
    assert found == {"flag": "boolean", "whole": "integer", "real": "decimal", "gone": "empty", "day": "text", "mixed": "text"}


def test_distinct_counts_are_exact(spark):
    df = spark.range(20_000).selectExpr("cast(id as string) a", "cast(id % 90 as string) b", "cast(null as string) c")
    found = {r["column_name"]: tuple(r)[1:] for r in profile.distinct_counts(df, ["a", "b", "c"], 100).collect()}
    assert found == {"a": (20_000, True), "b": (90, False), "c": (0, False)}
    shown = profile.column_profile(df, ["a"], "f", distinct_limit=100).head()
    assert (shown["distinct_values"], shown["distinct_count"], shown["distinct_count_is_capped"]) == (20_000, "100+", True)


def test_samples_come_in_order(spark):
    # 'late' gets its third value only far down
    rows = spark.range(5_000, numPartitions=3).selectExpr(
        "id", "cast(id as string) early", "case when id < 3000 then 'a' when id < 4000 then 'b' else 'c' end late"
    )
    found = {r["column_name"]: r["sample_values"] for r in profile.sample_values(rows, ["early", "late"], 3, "id").collect()}
    assert found == {"early": ["0", "1", "2"], "late": ["a", "b", "c"]}


def test_numbers_of_any_size(spark):
    rows = [("1e30", "0.1234567890123456789012"), ("-5", "3"), ("123456789012345678901234567890", "-2")]
    found = {r["column_name"]: (r["inferred_type"], r["min_value"], r["max_value"]) for r in profile.column_statistics(table(spark, rows, ["a", "b"]), ["a", "b"]).collect()}
    assert found == {"a": ("decimal", "-5", "1e30"), "b": ("decimal", "-2", "3")}


def test_types_come_from_all_rows(spark):
    df = spark.range(300).selectExpr("case when id < 299 then '2020-01-15' else 'unknown' end a", "case when id < 299 then ' ' else '2020-01-15' end b", "'2020-02-30' c")
    kinds = {r["column_name"]: r["value_kind"] for r in profile.infer_load_types(df, ["a", "b", "c"]).collect()}
    assert kinds == {"a": "text", "b": "date", "c": "text"}


def test_loader_types_and_values(spark):
    columns = ["Id", "BIRTHDATE", "LAST_UPDATE", "FIRST"]
    df = table(spark, [(UUIDS[0], "2017-08-24", "2019-02-17T05:07:38Z", "Damon"), ("", " ", "", "")], columns)
    kinds = {r["column_name"]: r["value_kind"] for r in profile.infer_load_types(df, columns).collect()}
    assert kinds == {"Id": "uuid", "BIRTHDATE": "date", "LAST_UPDATE": "datetime", "FIRST": "text"}
    first, blank = profile.coerce(df, kinds).collect()
    assert tuple(first) == (UUIDS[0], dt.date(2017, 8, 24), dt.datetime(2019, 2, 17, 5, 7, 38), "Damon")
    assert tuple(blank) == (None,) * 4


def test_first_values_move_one_row_a_task(spark):
    """Whatever the number of distinct values: no cell is shuffled, ties go by value, columns without values have no row."""
    rows = spark.range(5000, numPartitions=7).select(F.col("id"), F.concat(F.lit("v"), F.col("id") % 2000).alias("a"), F.when(F.col("id") % 3 == 1, F.col("id") % 2).cast("string").alias("b"), F.lit(" ").alias("c"), F.lit("same").alias("d.e"))
    found = {r["column_name"]: r["sample_values"] for r in profile.sample_values(rows, ["a", "b", "c", "d.e"], 4, "id").collect()}
    assert found == {"a": ["v0", "v1", "v2", "v3"], "b": ["1", "0"], "d.e": ["same"]}
    tied = spark.createDataFrame([(1, "b"), (1, "a"), (0, None), (2, "b")], "n int, v string")
    assert profile.sample_values(tied, ["v"], 3, "n").head()["sample_values"] == ["a", "b"]
    count, smallest = profile.first_distinct(rows, {"a": F.col("a"), "c": F.lit(None).cast("string")}, 3)
    assert (count, smallest) == (5000, {"a": ["v0", "v1", "v10"], "c": []})
    assert profile.first_distinct(rows.limit(0), {"a": F.col("a")}, 3) == (0, {"a": []})


def test_long_texts_are_counted_by_hash(spark):
    """Texts that differ only at their far end, a value that looks like a hash, long numbers and long times keep their results."""
    import hashlib

    texts = [("x" * 5000) + str(i % 7) for i in range(50)]
    lookalike = "#" + hashlib.md5(texts[0].encode()).hexdigest()
    numbers = ["1" + "0" * 90, "-2", "7" * 80, "0." + "0" * 70 + "1"] * 12 + [" ", None]
    times = ["2020-01-01T00:00:00." + "0" * 60 + "Z", "2021-01-01T00:00:00Z"] * 25
    df = table(spark, [*zip([*texts[:-1], lookalike], numbers, times)], ["a", "b", "c"])
    cells = profile.distinct_cells(df, ["a"])
    assert cells.count() == 8 and cells.agg(F.max(F.octet_length("value"))).first()[0] <= profile.SHUFFLED_BYTES
    rows = {r["column_name"]: r for r in profile.column_profile(df, ["a", "b", "c"], "f").collect()}
    assert [rows[c]["inferred_type"] for c in "abc"] == ["text", "decimal", "datetime"]
    assert [rows[c]["distinct_values"] for c in "abc"] == [8, 4, 2]
    assert (rows["a"]["min_length"], rows["a"]["max_length"], rows["a"]["sample_values"].split(" | ")[0]) == (33, 5001, texts[0])
    assert (rows["b"]["min_value"], rows["b"]["max_value"]) == ("-2", numbers[0])
    assert profile.distinct_counts(df, ["a", "b"], 7).where("column_name = 'a'").first()[1:] == (8, True)
