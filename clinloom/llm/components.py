"""Connected components by alternating large and small stars, as joins of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import distinct_rows
from clinloom.staging import StageStore


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(links: DataFrame, store: StageStore) -> DataFrame:
    """(node, component): each linked node and the smallest node it reaches. ``links`` has two columns of ids.

    Every step is a grouped minimum and a join back; a hub's many links are
    only ever joined to its one minimum, so adaptive execution can split them.
    """
    a, b = links.columns
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v")
    now = store.save(distinct_rows(pairs, ["u", "v"]), "links")
    before = _state(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        large = store.save(distinct_rows(large, ["u", "v"]), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        now = store.save(distinct_rows(small.unionByName(least.select("u", F.col("m").alias("v"))), ["u", "v"]), "small-star")
        after = _state(now)
        if after == before:
            break
        before = after
    roots = distinct_rows(now.select(F.col("v").alias("node")), ["node"]).withColumn("component", F.col("node"))
    return store.save(now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots), "components")
