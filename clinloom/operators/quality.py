"""Key, reference and required-value checks of written tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinloom import schemas as S


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where(F.col("row_count") > 1)


def assert_unique(df: DataFrame, name: str, *keys: str) -> None:
    found = duplicate_keys(df, *keys).take(1)
    if found:
        raise ValueError(f"{name} has more than one row for {', '.join(f'{k}={found[0][k]}' for k in keys)}.")


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child values without a parent, with their number of rows.

    Values are counted before the join, so a frequent one is one row.
    """
    values = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("row_count"))
    return values.join(parent.select(F.col(key).alias("value")), "value", "left_anti")


@dataclass(frozen=True)
class IdSpan:
    """What bitmaps tell of an integer key: rows, NULLs, distinct values, and the first and last one."""

    rows: int
    nulls: int
    values: int
    first: int | None
    last: int | None

    @property
    def unique(self) -> bool:
        return self.values + self.nulls == self.rows and self.nulls <= 1

    @property
    def gapless(self) -> bool:
        """Every integer from the first to the last value is there."""
        return self.values > 0 and self.last - self.first + 1 == self.values


_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def id_span(df: DataFrame, key: str) -> IdSpan | None:
    """The span of an integer key; None for a key of another type.

    One scan of the key column. Values meet as bitmaps of 32,768 each, so what
    is exchanged is a bit for each value (of sorted tables), not the values.
    """
    if not isinstance(df.schema[key].dataType, _INTEGERS):
        return None
    value = F.col(key).cast("long")
    buckets = df.groupBy(F.bitmap_bucket_number(value).alias("_bucket")).agg(
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(value))).alias("_values"),
        F.count(F.lit(1)).alias("_rows"),
        F.count(value).alias("_known"),
        F.min(value).alias("_first"),
        F.max(value).alias("_last"),
    )
    values = F.sum(F.when(F.col("_bucket").isNotNull(), F.col("_values")))
    row = buckets.agg(F.sum("_rows"), F.sum(F.col("_rows") - F.col("_known")), values, F.min("_first"), F.max("_last")).first()
    return IdSpan(row[0] or 0, row[1] or 0, row[2] or 0, row[3], row[4])


def _outside(child: DataFrame, name: str, spans: Mapping[tuple[str, str], IdSpan]) -> DataFrame:
    """Orphans of several columns in one scan of the child: only values outside their parent's span leave it."""
    entries = list(spans.items())

    def cell(n: int, column: str, span: IdSpan):
        value = F.col(column).cast("long")
        return F.struct(F.lit(n).alias("n"), F.when(~value.between(span.first, span.last), value).alias("value"))

    cells = F.array(*(cell(n, column, span) for n, ((column, _), span) in enumerate(entries)))
    values = child.select(F.inline(F.filter(cells, lambda c: c["value"].isNotNull()))).groupBy("n", "value").agg(F.count("*").alias("row_count"))
    counts = values.groupBy("n").agg(F.sum("row_count").alias("orphan_rows"), F.count("*").alias("orphan_values"))
    labels = [(n, name, column, parent) for n, ((column, parent), _) in enumerate(entries)]
    named = child.sparkSession.createDataFrame(labels, "n int, child_table string, child_column string, parent_table string")
    # one row per foreign key on either side
    return named.join(F.broadcast(counts), "n", "left").select(
        "child_table", "child_column", "parent_table",
        F.coalesce("orphan_rows", F.lit(0)).alias("orphan_rows"), F.coalesce("orphan_values", F.lit(0)).alias("orphan_values"),
    )


def parent_spans(tables: Mapping[str, DataFrame], keys: Iterable[tuple[str, str, str, str]]) -> dict[tuple[str, str], IdSpan | None]:
    """The span of every parent key, by table and column."""
    return {place: id_span(tables[place[0]], place[1]) for place in dict.fromkeys((parent, key) for _, _, parent, key in keys)}


def orphan_report(
    tables: Mapping[str, DataFrame],
    keys: Iterable[tuple[str, str, str, str]] = S.FOREIGN_KEYS,
    spans: Mapping[tuple[str, str], IdSpan | None] | None = None,
) -> DataFrame:
    """Per foreign key the rows and distinct values that point nowhere.

    Where the parent's ids have no gaps, a child value is an orphan exactly if
    it lies outside the parent's first and last id: all such keys of a child
    are checked in one scan. Other parents are joined with the counted values.
    ``spans`` are those of the parents, where they are known.
    """
    keys = list(keys)
    spans = parent_spans(tables, keys) if spans is None else spans
    ranged: dict[str, dict[tuple[str, str], IdSpan]] = {}
    joined = []
    for child, column, parent, key in keys:
        span = spans[parent, key]
        if span and span.gapless and isinstance(tables[child].schema[column].dataType, _INTEGERS):
            ranged.setdefault(child, {})[column, parent] = span
        else:
            joined.append((child, column, parent, key))

    def of_key(child: str, column: str, parent: str, key: str) -> DataFrame:
        return orphans(tables[child], column, tables[parent], key).agg(
            F.coalesce(F.sum("row_count"), F.lit(0)).alias("orphan_rows"), F.count("*").alias("orphan_values")
        ).select(
            F.lit(child).alias("child_table"), F.lit(column).alias("child_column"), F.lit(parent).alias("parent_table"),
            "orphan_rows", "orphan_values",
        )

    parts = [*(_outside(tables[name], name, found) for name, found in ranged.items()), *(of_key(*entry) for entry in joined)]
    return reduce(DataFrame.unionByName, parts)


def not_null_violations(tables: Mapping[str, DataFrame], required: Mapping[str, Iterable[str]] = S.REQUIRED_COLUMNS) -> DataFrame:
    """Per required column the rows without a value; one pass per table."""

    def of_table(name: str, columns: Iterable[str]) -> DataFrame:
        columns = list(columns)
        counts = tables[name].agg(*(F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns))
        cells = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in columns))
        return counts.select(F.lit(name).alias("table_name"), F.inline(cells))

    return reduce(DataFrame.unionByName, (of_table(n, c) for n, c in required.items()))


def key_report(tables: Mapping[str, DataFrame], keys: Mapping[str, str] = S.PRIMARY_KEYS) -> DataFrame:
    """Per table the key values that repeat and the rows they hold.

    An integer key is counted by bitmaps first; only where values repeat are its rows grouped.
    """
    clean, parts = [], []
    for name, key in keys.items():
        span = id_span(tables[name], key)
        if span and span.unique:
            clean.append((name, key, 0, 0))
            continue
        parts.append(
            duplicate_keys(tables[name], key)
            .agg(F.count("*").alias("duplicate_keys"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("duplicate_rows"))
            .select(F.lit(name).alias("table_name"), F.lit(key).alias("key_column"), "duplicate_keys", "duplicate_rows")
        )
    if clean:
        spark = next(iter(tables.values())).sparkSession
        parts.append(spark.createDataFrame(clean, "table_name string, key_column string, duplicate_keys long, duplicate_rows long"))
    return reduce(DataFrame.unionByName, parts)
