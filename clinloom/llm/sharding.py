"""Sharding by a k-d tree over document metadata.

Each node is cut at the weighted median (weight: bytes) along its widest
dimension, until the leaves reach the target size. Medians are found without
sorting: a dimension's value and a hash of the document make one 63-bit key,
and histograms of its digits, read from the top, narrow the cut down to one
key. Only the histograms' few bins meet in one task, never the documents.

Dimensions are the source, the language (both hashed, null is a value) and the
logarithm of the size. Documents of equal text (null texts too) share the
smallest of their values in every dimension, and documents equal in a dimension
are cut by a hash of the text, so copies lie in one leaf. Only where the copies
of one text alone weigh more than a leaf does the hash go on with the id. Null
texts weigh one byte. Repeated rows share a key and stay together. An empty
table gives no rows. Other columns are left alone. Without ``copies_together``
every document has its own values and hash, and leaves are a little more even.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinloom.llm.common import small_side
from clinloom.staging import StageStore

KEY_BITS, DIGIT_BITS = 63, 13
DIMENSIONS = 3
ROWS_PER_SLOT_GROUP = 50_000


def _hash31(column: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(column, F.lit("\0"))), 33)


def document_rows(documents: DataFrame) -> DataFrame:
    """Size, checksum, hash of the text and the value in each dimension of every document; one pass over the texts."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    values = [_hash31(F.col("source")), _hash31(F.col("lang")), F.floor(F.log2(F.col("size")) * (1 << 24)).cast("long")]
    return documents.select(
        "doc_id", "source", "lang", size.alias("size"), F.crc32(F.col("text")).alias("text_crc32"), F.xxhash64("text").alias("text_key")
    ).select("doc_id", "size", "text_crc32", "text_key", *(v.alias(f"v{i}") for i, v in enumerate(values)))


def document_points(rows: DataFrame, store: StageStore, leaf_bytes: float, copies_together: bool) -> DataFrame:
    """One key per dimension for every document: its value, shared by copies, above 32 bits of hash."""
    values = [f"v{i}" for i in range(DIMENSIONS)]
    by_text = F.shiftrightunsigned(F.xxhash64("text_key"), 32)
    by_id = F.shiftleft(F.shiftright(by_text, 16), 16).bitwiseOR(F.xxhash64("doc_id").bitwiseAND(0xFFFF))

    def keyed(dimensions: list, tie: Column) -> list[Column]:
        return [F.shiftleft(v, 32).bitwiseOR(tie).alias(f"k{i}") for i, v in enumerate(dimensions)]

    if not copies_together:
        return rows.select("doc_id", "size", "text_crc32", *keyed(values, by_id))
    copies = store.save(
        rows.groupBy("text_key")
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("size").alias("_weight"), *(F.min(v).alias(f"_{v}") for v in values))
        .filter("_n > 1")
        .drop("_n"),
        "kd-copies",
    )
    tie = F.when(F.col("_weight") > leaf_bytes, by_id).otherwise(by_text)
    return rows.join(small_side(copies), "text_key", "left").select("doc_id", "size", "text_crc32", *keyed([F.coalesce(f"_{v}", v) for v in values], tie))


def _by_node(values: list) -> Column:
    return F.element_at(F.lit(values), F.col("node") + 1)


def _level(points: DataFrame, nodes: int, spans: list[int]) -> DataFrame:
    """Cut every node in two; node n becomes 2n and 2n + 1."""
    keys = [f"k{i}" for i in range(DIMENSIONS)]
    # one row per node
    stats = {
        row["node"]: row
        for row in points.groupBy("node")
        .agg(F.sum("size").alias("total"), *(F.min(k).alias(f"lo_{k}") for k in keys), *(F.max(k).alias(f"hi_{k}") for k in keys))
        .collect()
    }

    def widest(node: int) -> int:
        row = stats.get(node)
        return max(range(DIMENSIONS), key=lambda d: (((row[f"hi_k{d}"] >> 32) - (row[f"lo_k{d}"] >> 32)) / spans[d], -d)) if row else 0

    axis = _by_node([widest(n) for n in range(nodes)])
    key = F.when(axis == 0, F.col("k0")).when(axis == 1, F.col("k1")).otherwise(F.col("k2"))
    keyed = points.withColumn("_key", key)
    prefix, below, last = [0] * nodes, [0] * nodes, [0] * nodes
    half = [stats[n]["total"] / 2 if n in stats else 0 for n in range(nodes)]
    shift = KEY_BITS
    while shift:
        width = min(DIGIT_BITS, shift)
        shift -= width
        digit = F.shiftright("_key", shift).bitwiseAND((1 << width) - 1)
        inside = keyed.filter(F.shiftright("_key", shift + width) == _by_node(prefix)) if shift + width < KEY_BITS else keyed
        bins = inside.groupBy("node", digit.alias("digit")).agg(F.sum("size").alias("bytes"))
        upto = Window.partitionBy("node").orderBy("digit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        found = (
            bins.withColumn("upto", F.sum("bytes").over(upto) + _by_node(below))
            .filter(F.col("upto") >= _by_node(half))
            .groupBy("node")
            .agg(F.min(F.struct("digit", "upto", "bytes")).alias("bin"))
            .collect()  # one row per node
        )
        for row in found:
            n, bin_ = row["node"], row["bin"]
            prefix[n] = (prefix[n] << width) | bin_["digit"]
            below[n], last[n] = bin_["upto"] - bin_["bytes"], bin_["bytes"]
    # the median document goes to the side that leaves the halves closer
    cut = [prefix[n] if below[n] + last[n] - half[n] <= half[n] - below[n] else prefix[n] - 1 for n in range(nodes)]
    return keyed.withColumn("node", 2 * F.col("node") + (F.col("_key") > _by_node(cut)).cast("int")).drop("_key")


def kd_shards(
    documents: DataFrame, store: StageStore, shards: int | None = None, target_bytes: int | None = None, copies_together: bool = False
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless in the shard) of every row.

    ``shards`` is a power of two; without it the tree grows until leaves hold
    about ``target_bytes``. ``copies_together`` keeps documents of equal text in
    one leaf, unless they alone weigh more than a leaf.
    """
    documents = store.save(document_rows(documents), "kd-rows")
    whole = documents.agg(
        F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"), *(F.max(f"v{i}").alias(f"hi{i}") for i in range(DIMENSIONS)),
        *(F.min(f"v{i}").alias(f"lo{i}") for i in range(DIMENSIONS)),
    ).first()
    rows, total = whole["rows"], whole["bytes"] or 0
    if shards is None:
        shards = 1 << max(0, math.ceil(math.log2(max(1.0, total / target_bytes))))
    if shards & (shards - 1):
        raise ValueError("shards has to be a power of two")
    spans = [max(1, whole[f"hi{i}"] - whole[f"lo{i}"]) if rows else 1 for i in range(DIMENSIONS)]
    points = store.save(document_points(documents, store, total / shards, copies_together).withColumn("node", F.lit(0)), "kd-points")
    nodes = 1
    while nodes < shards and rows:
        points = _level(points, nodes, spans)
        nodes *= 2
        if nodes in (4, shards) or nodes % 16 == 0:
            points = store.save(points, f"kd-{nodes}")
    # slots: small groups of a shard are numbered by themselves, and start where the groups before end
    groups = max(64, math.ceil(rows / shards / ROWS_PER_SLOT_GROUP))
    dealt = points.withColumn("_group", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(groups)))
    counts = dealt.groupBy("node", "_group").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy("node").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    starts = store.save(
        counts.select("node", "_group", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start")), "kd-starts"
    )
    own = Window.partitionBy("node", "_group").orderBy("doc_id", "text_crc32", "size")
    return (
        dealt.withColumn("_place", F.row_number().over(own) - 1)
        .join(small_side(starts), ["node", "_group"])
        .select("doc_id", "size", "text_crc32", F.col("node").cast("int").alias("shard"), (F.col("_start") + F.col("_place")).cast("long").alias("slot"))
    )
