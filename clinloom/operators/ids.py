"""Dense surrogate ids over a whole table, without one task that sees it all.

``ROW_NUMBER() OVER (ORDER BY keys)`` as a window moves every row to one task.
Here the rows are range-partitioned, sorted and written once to a stage table
together with their place (block, position), and the ids follow from the block
sizes. A block's size and the hashes of its first and last order key are all
that reaches the driver; the hashes are made when they are asked for, not kept.

The ranges are cut on the order keys and one hash of the rest of a row, so the
samples that fix them stay narrow. That hash spreads rows of one order key over
several blocks, where the wanted order goes on with the other columns. Such keys
lie at the ends of blocks, so there are fewer of them than blocks; only their
rows are ranged once more, by all columns.

Where a caller knows beforehand how rows lie along the order (``Cells``), the
ranges need no sample: rows go from their plan straight into the blocks, and
are written once. Only rows of a cell too large for one block are ranged again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom.staging import StageStore

#: Rows that a task sorts at once, some hundred bytes each.
SORTED_ROWS = 500_000

#: Rows that are worth a task of their own.
TASK_ROWS = 20_000

_TIE_BITS = 16  # a key of many rows is cut into so many ranges at most; more random bits a row only travel

_BLOCK_SHIFT = 33  # monotonically_increasing_id keeps the task in the bits above


@dataclass(frozen=True)
class Numbered:
    """A written table with dense ids, and its number of rows."""

    df: DataFrame
    rows: int


@dataclass(frozen=True)
class Cells:
    """How rows lie along an order: a whole number that never falls along it, and about how many rows have each from 0 on.

    The rows only balance the tasks. Any estimate gives the same ids.
    """

    number: Column
    rows: Sequence[float]


def _block() -> Column:
    return F.shiftrightunsigned("_place", _BLOCK_SHIFT)


def _position() -> Column:
    return F.col("_place").bitwiseAND((1 << _BLOCK_SHIFT) - 1)


def _ranged(df: DataFrame, rows: int, *order: Column | str) -> DataFrame:
    """Ranges of ``order``, at least so many that a task can sort its rows without spilling."""
    asked = -(-rows // SORTED_ROWS)
    wide = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) < asked
    return df.repartitionByRange(asked, *order) if wide else df.repartitionByRange(*order)


def dense_ids(
    df: DataFrame,
    id_column: str,
    order_by: Sequence[str],
    store: StageStore,
    first_id: int = 1,
    cells: Cells | None = None,
) -> Numbered:
    """Number the rows ``first_id, first_id + 1, …`` in the order of ``order_by``.

    Columns not named follow as tie-breaks, so equal keys get the same ids on
    every run. The task a row comes from is part of the hash that cuts ranges,
    so even a large group of exact copies is spread over several.
    """
    rest = [c for c in df.columns if c not in order_by]
    if cells is not None:
        return _dealt_ids(df, id_column, order_by, rest, store, first_id, cells)
    # written first: the range sample and the sort then read the rows, and the plan behind them runs once
    rows, found = store.save_counted(df.withColumn("_origin", F.spark_partition_id()), f"{id_column}-rows")
    ranged = (
        _ranged(rows.withColumn("_tie", F.shiftrightunsigned(F.xxhash64(*rest, "_origin"), 64 - _TIE_BITS)), found, *order_by, "_tie")
        .sortWithinPartitions(*order_by, *rest)
        .withColumn("_place", F.monotonically_increasing_id())
        .drop("_tie")
    )
    table = store.save(ranged, id_column)
    store.remove(f"{id_column}-rows")

    # nulls are skipped by the hash, so it also takes where they are
    key = F.xxhash64(*order_by, *(F.col(c).isNull() for c in order_by))
    ends = [F.min_by(key, "_place").alias("first"), F.max_by(key, "_place").alias("last")]
    # one row per written block
    blocks = sorted(table.groupBy(_block().alias("block")).agg((F.max(_position()) + 1).alias("size"), *ends).collect())
    numbered = _numbered(table, id_column, [*df.columns, "_origin"], [(b["block"], b["size"]) for b in blocks], first_id)
    cut = {a["last"] for a, b in zip(blocks, blocks[1:]) if a["last"] == b["first"]}
    return _ranged_again(numbered, id_column, df.columns, [*order_by, *rest], key, cut, store, first_id)


def _dealt_ids(
    df: DataFrame, id_column: str, order_by: Sequence[str], rest: Sequence[str], store: StageStore, first_id: int, cells: Cells
) -> Numbered:
    """``dense_ids`` of rows whose blocks follow from their cells."""
    first, count, blocks = _blocks(cells.rows, store.spark.sparkContext.defaultParallelism)
    cell = F.greatest(F.least(F.coalesce(cells.number, F.lit(0)), F.lit(len(first) - 1)), F.lit(0)).cast("int")
    plan = F.broadcast(store.spark.createDataFrame(list(zip(range(len(first)), first, count)), "_cell int, _first int, _count int"))
    # a hash of the row, not its place in the task: a task that runs again deals its rows to the same blocks
    spread = F.pmod(F.xxhash64(*rest, F.spark_partition_id()), "_count").cast("int")
    dealt = (
        df.withColumn("_cell", cell)
        .join(plan, "_cell")
        .withColumn("_block", F.when(F.col("_count") > 1, F.col("_first") + spread).otherwise(F.col("_first")))
        .select(*df.columns, "_block")
        .repartitionById(blocks, "_block")
        .select(*df.columns)
        .sortWithinPartitions(*order_by, *rest)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    table = store.save(dealt, id_column).withColumn("_origin", _block())
    # one row per written block
    sizes = sorted((row["block"], row["size"]) for row in table.groupBy(_block().alias("block")).agg((F.max(_position()) + 1).alias("size")).collect())
    numbered = _numbered(table, id_column, [*df.columns, "_origin"], sizes, first_id)
    parted = {n for n, blocks_of in enumerate(count) if blocks_of > 1}
    return _ranged_again(numbered, id_column, df.columns, [*order_by, *rest], cell.cast("long"), parted, store, first_id)


def _blocks(rows: Sequence[float], tasks: int) -> tuple[list[int], list[int], int]:
    """The first block and the number of blocks of every cell, and the number of all blocks.

    Neighbouring cells share a block; one with more rows than a block has several of its own.
    """
    total = sum(rows)
    wanted = max(1, -(-int(total) // SORTED_ROWS), min(2 * tasks, int(total) // TASK_ROWS))
    most = max(1.0, total / wanted)
    first, count, block, held = [], [], 0, 0.0
    for n in rows:
        if held and held + n > most:
            block, held = block + 1, 0.0
        own = max(1, round(n / most))
        first.append(block)
        count.append(own)
        if own > 1:
            block, held = block + own, 0.0
        else:
            held += n
    return first, count, block + 1


def _ranged_again(
    numbered: Numbered, id_column: str, columns: Sequence[str], order: Sequence[str], key: Column, cut: set[int], store: StageStore, first_id: int
) -> Numbered:
    """Rows of the keys that lie in several blocks, ranged by all columns among themselves, take the ids that their keys hold."""
    if not cut:
        return Numbered(numbered.df.select(id_column, *columns), numbered.rows)

    keys = F.broadcast(store.spark.createDataFrame([(k,) for k in cut], "_key long"))
    keyed = numbered.df.withColumn("_key", key)
    held = keyed.join(keys, "_key")
    again = [*order, "_origin"]
    # one row per cut key, fewer than blocks
    spans = sorted(
        (row["start"], row["size"], row["end"], row["_key"])
        for row in held.groupBy("_key")
        .agg(F.min(id_column).alias("start"), F.count(F.lit(1)).alias("size"), F.max(id_column).alias("end"))
        .collect()
    )
    if any(end - start + 1 != size for start, size, end, _ in spans):  # two keys share a hash
        whole = numbered.df.select(*columns, "_origin").repartitionByRange(*again).sortWithinPartitions(*again)
        return placed_ids(whole.drop("_origin"), id_column, store, first_id)
    shifts, before = [], 0
    for start, size, _, key_ in spans:
        shifts.append((key_, start - before))
        before += size
    ordered = held.drop(id_column).repartitionByRange(*again).sortWithinPartitions(*again)
    nth = placed_ids(ordered.drop("_origin"), "_nth", store, first_id=0).df
    shift = F.broadcast(store.spark.createDataFrame(shifts, "_key long, _shift long"))
    moved = nth.join(shift, "_key").select((F.col("_nth") + F.col("_shift")).alias(id_column), *columns)
    kept = keyed.join(keys, "_key", "left_anti").select(id_column, *columns)
    return Numbered(kept.unionByName(moved), numbered.rows)


def placed_ids(df: DataFrame, id_column: str, store: StageStore, first_id: int = 1) -> Numbered:
    """Number the rows ``first_id, first_id + 1, …`` in the order in which their tasks write them; no exchange, no sort."""
    table = store.save(df.withColumn("_place", F.monotonically_increasing_id()), id_column)
    # one row per written block, so bounded by the number of tasks
    sizes = sorted(
        (row["block"], row["size"]) for row in table.groupBy(_block().alias("block")).agg((F.max(_position()) + 1).alias("size")).collect()
    )
    return _numbered(table, id_column, df.columns, sizes, first_id)


def _numbered(table: DataFrame, id_column: str, columns: Sequence[str], sizes: Sequence[tuple[int, int]], first_id: int) -> Numbered:
    """Ids of a written table from the sizes of its blocks."""
    offsets, total = [], 0
    for number, size in sizes:
        offsets.append((number, total + first_id))
        total += size

    if len(offsets) <= 1:
        base: Column = F.lit(first_id).cast("long")
        numbered = table
    else:
        starts = table.sparkSession.createDataFrame(offsets, "_block long, _start long")
        numbered = table.withColumn("_block", _block()).join(F.broadcast(starts), "_block")
        base = F.col("_start")
    found = [(base + _position()).alias(id_column), *(F.col(c) for c in columns)]
    return Numbered(numbered.select(*found), total)
