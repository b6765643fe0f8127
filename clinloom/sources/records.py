"""Delimited records with line breaks inside quotes, read in splits.

A line is inside a quoted value if an odd number of quotes stands before it in
its file. Lines are numbered inside the split they are read in, one partially
aggregated row a split gives the quotes before each split, and both together
give the line at which every record starts. Only records of several lines are
brought together; the others are parsed where they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clinloom.operators.lookups import lookup_side
from clinloom.staging import StageStore

QUOTE = '"'
BLOCK = ("file", "at")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines with their file, the start of their split and their order in it."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("row"), "value",
    )


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(QUOTE), F.lit("")))


def breaks_in_quotes(spark: SparkSession, path: str) -> bool:
    """Whether a line of the file holds an odd number of quotes, as only a record of several lines does."""
    return not spark.read.option("lineSep", "\n").text(path).filter(_quotes(F.col("value")) % 2 == 1).isEmpty()


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines, and inside their split: the quotes before, and the last line that starts a record if the split begins outside a quoted value, or inside."""
    so_far = Window.partitionBy(*BLOCK).orderBy("row")
    counted = _lines(spark, path).withColumn("odd", _quotes(F.col("value")) % 2)
    counted = counted.withColumn("before", (F.sum("odd").over(so_far) - F.col("odd")) % 2)
    starts = [F.max(F.when(F.col("before") == inside, F.col("row"))).over(so_far).alias(f"start{inside}") for inside in (0, 1)]
    return counted.select("*", *starts)


def _blocks(lines: DataFrame) -> DataFrame:
    """One row a split: whether it begins inside a quoted value, and the start of the record that is open there.

    The running sums go over the splits of one file, not over its lines.
    """
    own = lines.groupBy(*BLOCK).agg((F.sum("odd") % 2).alias("odd"), F.max("start0").alias("last0"), F.max("start1").alias("last1"))
    earlier = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    inside = own.withColumn("inside", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    last = F.when(F.col("inside") == 0, F.col("last0")).otherwise(F.col("last1"))
    opened = inside.withColumn("last", F.when(last.isNotNull(), F.struct(F.col("at"), last.alias("row"))))
    return opened.select(*BLOCK, "odd", "inside", F.last("last", ignorenulls=True).over(earlier).alias("open"))


def record_texts(spark: SparkSession, path: str, store: StageStore) -> DataFrame:
    """Every record's whole text, line breaks included, with the place (file, split, line) at which it starts.

    Quotes are doubled inside quoted values; one inside an unquoted value would
    count as an opening quote. A file whose last quoted value is never closed
    raises, before any lines are brought together.
    """
    lines = store.save(_numbered_lines(spark, path), "lines")
    blocks = store.save(_blocks(lines), "splits")
    unclosed = [r["file"] for r in blocks.groupBy("file").agg((F.sum("odd") % 2).alias("odd")).filter("odd = 1").orderBy("file").limit(1).collect()]
    if unclosed:
        raise ValueError(f"{unclosed[0].rsplit('/', 1)[-1]} ends inside a quoted value.")
    placed = lines.join(lookup_side(blocks.drop("odd"), blocks.count()), list(BLOCK))
    own = F.when(F.col("inside") == 0, F.col("start0")).otherwise(F.col("start1"))
    start = F.when(own.isNotNull(), F.struct("at", own.alias("row"))).otherwise(F.col("open"))
    placed = placed.select(
        "file", start.alias("start"), F.struct("at", "row").alias("line"), "value",
        ((F.col("before") + F.col("inside")) % 2 == 0).alias("starts"), ((F.col("before") + F.col("inside") + F.col("odd")) % 2 == 0).alias("ends"),
    )
    alone = placed.filter("starts AND ends").select("file", "start", F.col("value").alias("text"))
    parts = placed.filter("NOT (starts AND ends)").groupBy("file", "start").agg(F.sort_array(F.collect_list(F.struct("line", "value"))).alias("lines"))
    return alone.unionByName(parts.select("file", "start", F.array_join(F.transform("lines", lambda x: x["value"]), "\n").alias("text")))


def read_records(spark: SparkSession, path: str, header: Sequence[str], sep: str, bad_row: str, place: str, store: StageStore, has_header: bool = True) -> DataFrame:
    """All columns as text, rows of another width in ``bad_row``, and each record's ``place`` in its files; blank lines are skipped.

    Rows are as the whole-file reader gives them.
    """
    records = record_texts(spark, path, store).withColumn("text", F.regexp_replace("text", "\r$", ""))
    if has_header:  # the first line of each file
        first = records.groupBy("file").agg(F.min("start").alias("start"))
        records = records.join(lookup_side(first, first.count()), ["file", "start"], "left_anti")
    schema = ", ".join("`" + name.replace("`", "``") + "` string" for name in [*header, bad_row])
    options = {"sep": sep, "quote": QUOTE, "escape": QUOTE, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad_row}
    parsed = F.from_csv("text", schema, options)
    where = F.struct("file", F.col("start.at").alias("at"), F.col("start.row").alias("row"))
    rows = records.filter(F.length(F.trim("text")) > 0).select(parsed.alias("r"), where.alias(place))
    return rows.select("r.*", place)

