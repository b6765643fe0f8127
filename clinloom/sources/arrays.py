"""JSON arrays over several lines, read in splits.

A JSON text has no line break inside a string, so every line begins outside of
one, and its brackets can be counted by itself. The depth at which a line
begins follows from the sums of the splits before it, one row a split. Lines
that begin and end between the elements of the array are parsed where they are
read; only elements of several lines are brought together. A line is one value
of one task, whatever its length.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = ("file", "at")


def read_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The elements of the arrays (or single objects) of all files; raises where a file's brackets do not match."""
    place = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("row"))
    bare = F.regexp_replace("value", r'"(?:[^"\\]|\\.)*+"', "")
    change = F.length(F.regexp_replace(bare, r"[^\[{]", "")) - F.length(F.regexp_replace(bare, r"[^\]}]", ""))
    lines = spark.read.text(path).select(*place, "value").withColumn("change", change)

    start = F.nullif(F.substring(F.regexp_replace("value", "^[\\s\ufeff]+", ""), 1, 1), F.lit(""))
    sums = lines.groupBy(*BLOCK).agg(F.sum("change").alias("change"), F.min_by(start, F.when(start.isNotNull(), F.col("row"))).alias("start"))
    blocks = spark.createDataFrame(_depths(sums.collect()), "file string, at long, depth long, outer long")  # one row a split
    upto = Window.partitionBy(*BLOCK).orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    ends = lines.withColumn("_inner", F.sum("change").over(upto)).join(F.broadcast(blocks), list(BLOCK))
    ends = ends.withColumn("end", F.col("depth") + F.col("_inner")).withColumn("begin", F.col("end") - F.col("change"))

    outer = F.col("outer")  # the depth between elements: 1 in an array, 0 beside a single object
    alone = (F.col("begin") <= outer) & (F.col("end") <= outer)
    split = ends.where(~alone)
    # an element's lines follow the last line that begins outside of it; that may lie in a split before
    first = F.when(F.col("begin") <= outer, F.struct("at", "row"))
    carried = _carried(ends.groupBy(*BLOCK).agg(F.max(first).alias("first")).collect())  # one row a split
    carried = spark.createDataFrame(carried, "file string, at long, _before struct<at: long, row: long>")
    known = split.withColumn("_first", F.last(first, ignorenulls=True).over(upto)).join(F.broadcast(carried), list(BLOCK))
    joined = known.withColumn("_first", F.coalesce("_first", "_before")).groupBy("file", "outer", "_first").agg(
        F.array_sort(F.collect_list(F.struct("at", "row", "value", "begin", "end"))).alias("parts")
    )
    whole = joined.select(
        "outer",
        F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value"),
        F.element_at("parts", 1)["begin"].alias("begin"), F.element_at("parts", -1)["end"].alias("end"),
    )
    texts = ends.where(alone).select("outer", "value", "begin", "end").unionByName(whole)

    opened = F.regexp_replace("value", "^[\\s\ufeff]*,?", "")
    opened = F.when(F.col("begin") < outer, F.regexp_replace(opened, r"^\s*\[", "")).otherwise(opened)
    closed = F.when(F.col("end") < outer, F.regexp_replace(opened, r"\]\s*$", "")).otherwise(F.regexp_replace(opened, r",\s*$", ""))
    elements = F.from_json(F.concat(F.lit("["), closed, F.lit("]")), T.ArrayType(schema), {"mode": "FAILFAST"})
    return texts.select(F.inline(elements))


def _depths(sums: list) -> list[tuple[str, int, int, int]]:
    """The depth at which each split begins, and that between the elements of its file."""
    files = defaultdict(list)
    for row in sums:
        files[row["file"]].append((row["at"], row["change"], row["start"]))
    found = []
    for file, blocks in files.items():
        blocks = sorted(blocks, key=lambda b: b[0])
        depth, outer = 0, int(next((start for *_, start in blocks if start), "[") == "[")
        for at, change, _ in blocks:
            found.append((file, at, depth, outer))
            depth += change
        if depth:
            raise ValueError(f"{file} has brackets that do not match.")
    return found


def _carried(firsts: list) -> list[tuple]:
    """The last line before each split that begins outside of an element."""
    found, file, before = [], None, None
    for row in sorted(firsts, key=lambda r: (r["file"], r["at"])):
        if row["file"] != file:
            file, before = row["file"], None
        found.append((file, row["at"], before))
        before = row["first"] and tuple(row["first"]) or before
    return found
