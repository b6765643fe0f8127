"""Writes to catalog tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinloom import schemas as S
from clinloom.operators.ids import dense_ids, placed_ids
from clinloom.sinks import journal
from clinloom.staging import COMPRESSION, StageStore, shuffles_removed, walk_files


@dataclass(frozen=True)
class Later:
    """Rows of a known schema that are worked out when it is their turn to be written."""

    schema: T.StructType
    rows: Callable[[], DataFrame]


def ensure_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`{place}")


def change_tables(
    spark: SparkSession, schema: str, replace: Mapping[str, DataFrame | Later] | None = None, append: Mapping[str, DataFrame | Later] | None = None,
    without: Mapping[str, Column] | None = None, workers: int = 4,
) -> dict[str, int]:
    """Replace tables and append to others; returns the rows written to each. Either all of them change, or none does.

    ``without`` names rows that leave a table that is appended to. Only files
    that hold such rows are replaced, the others stay as they are. Everything
    is written beside the tables first; a journal then carries the change
    through or back (see ``journal``), also after a lost driver. Rows are
    counted while they are written. Those given as ``Later`` are written last,
    one table after another in the given order, appended ones at the end.
    """
    replace, append, without = dict(replace or {}), dict(append or {}), dict(without or {})
    if both := replace.keys() & (append.keys() | without.keys()):
        raise ValueError(f"Tables to replace and to append to: {', '.join(sorted(both))}")
    touched = sorted(append.keys() | without.keys())
    if not replace and not touched:
        return {}
    journal.refuse_unfinished(spark, schema, {*replace, *touched})
    change = journal.Change(schema, [journal.table_step(spark, schema, name, df.schema) for name, df in replace.items()], owner=spark.sparkContext.applicationId)
    homes = {name: _file_table(spark, schema, name) for name in touched}
    beside = {name: f"{home['location']}/_aside-{change.id}" for name, home in homes.items()}
    change.moved_tables, change.aside = touched, [*beside.values()]
    kept_journal = journal.Journal(spark, change)
    counted: dict[str, Observation] = {}

    def write(df: DataFrame, name: str, path: str, home: dict[str, str] | None = None) -> None:
        counted[name] = Observation()
        writer = df.observe(counted[name], F.count(F.lit(1)).alias("rows")).write
        if home:
            writer = writer.format(home["provider"])
            columns = [c.name for c in spark.catalog.listColumns(f"{schema}.{name}") if c.isPartition]
            writer = writer.partitionBy(*columns) if columns else writer
        else:
            writer = writer.format("parquet")
        with shuffles_removed(spark):
            writer.save(path, compression=COMPRESSION)

    kept_journal.enter("writing")
    try:
        jobs = [(replace[step.name], step.name, step.new_path) for step in change.tables]
        jobs += [(df, name, f"{beside[name]}/new", homes[name]) for name, df in append.items()]
        with ThreadPoolExecutor(workers) as pool:
            list(pool.map(lambda job: write(*job), (job for job in jobs if not isinstance(job[0], Later))))
        for later, *place in (job for job in jobs if isinstance(job[0], Later)):
            write(later.rows(), *place)
        for name, gone in without.items():
            change.moves += _taken_out(spark, schema, name, gone, homes[name], beside[name])
        for name in append:
            change.moves += _moved_in(spark, f"{beside[name]}/new", homes[name]["location"])
        kept_journal.enter("switching")
        kept_journal.forward()
    except BaseException:
        kept_journal.enter("undoing")
        kept_journal.back()
        kept_journal.clean(completed=False)
        raise
    kept_journal.enter("done")
    kept_journal.clean(completed=True)
    return {name: counted[name].get["rows"] for name in (*replace, *append)}


def _file_table(spark: SparkSession, schema: str, table: str) -> dict[str, str]:
    """Where and how a table keeps its files; only tables of plain files can be appended to as a whole."""
    found = journal.described(spark, schema, table)
    if found is None:
        raise ValueError(f"Unknown target table: {table}")
    if found["provider"] not in ("parquet", "orc"):
        raise ValueError(f"{table} is kept as {found['provider'] or found['kind']}; rows can be appended to Parquet and ORC tables only.")
    return {**found, "location": found["location"].rstrip("/")}


def _moved_in(spark: SparkSession, folder: str, home: str) -> list[tuple[str, str]]:
    """Moves of written files to the places they have in the table."""
    top = _under(folder)
    return [(path, f"{home}/{_under(path).removeprefix(top).lstrip('/')}") for path in walk_files(spark, folder)]


def _under(path: str) -> str:
    return re.sub(r"^[a-z0-9+.-]+:(//[^/]*)?", "", path)


def _taken_out(spark: SparkSession, schema: str, table: str, gone: Column, home: dict[str, str], beside: str) -> list[tuple[str, str]]:
    """Moves that take the files with unwanted rows out, and those that bring their other rows back in."""
    rows = spark.table(f"`{schema}`.`{table}`")
    gone = F.coalesce(gone, F.lit(False))
    names = [r["name"] for r in rows.where(gone).select(F.col("_metadata.file_name").alias("name")).distinct().collect()]  # one row a file
    if not names:
        return []
    held = spark.createDataFrame([(n,) for n in names], "_name string")
    rest = rows.withColumn("_file", F.col("_metadata.file_name")).join(F.broadcast(held), F.col("_file") == F.col("_name"), "left_semi").where(~gone)
    columns = [c.name for c in spark.catalog.listColumns(f"{schema}.{table}") if c.isPartition]
    writer = rest.drop("_file").write.format(home["provider"])
    (writer.partitionBy(*columns) if columns else writer).save(f"{beside}/kept")
    out = [(path, f"{beside}/out/{i}-{path.rsplit('/', 1)[-1]}") for i, path in enumerate(walk_files(spark, home["location"])) if path.rsplit("/", 1)[-1] in set(names)]
    return [*out, *_moved_in(spark, f"{beside}/kept", home["location"])]


def load_tables(frames: Mapping[str, DataFrame], schema: str, workers: int = 4) -> dict[str, int]:
    """Replace tables and return their numbers of rows. Either all of them change, or none does."""
    if not frames:
        return {}
    return change_tables(next(iter(frames.values())).sparkSession, schema, replace=frames, workers=workers)


def load_table(df: DataFrame, schema: str, table: str) -> int:
    """Replace a table and return its number of rows. Either all rows arrive or the old table stays."""
    return load_tables({table: df}, schema)[table]


def append_tables(frames: Mapping[str, DataFrame], schema: str, replaced: Mapping[str, DataFrame] | None = None) -> dict[str, int]:
    """Append rows to tables, and replace others, all or nothing; returns the rows written to each."""
    spark = next(iter([*frames.values(), *(replaced or {}).values()])).sparkSession
    return change_tables(spark, schema, replace=replaced, append=frames)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a target in its order and types; columns not given are NULL."""
    given = set(df.columns)
    return df.select(
        *(
            (F.col(f.name) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )


REVIEW_ORDER = ["target_table", "source_row_id", "review_status", "review_reason", "payload_json"]


def review_rows_to_add(old: DataFrame, new: DataFrame, store: StageStore, prefix: str | None = S.REVIEW_PREFIX, now: Column | None = None, ordered: bool = False) -> DataFrame:
    """New review rows, numbered after the highest id of the old ones that stay.

    ``ordered`` ids follow the rows' content, the same on every run. Else any
    order will do, and they follow from the rows' places in the written files:
    nothing is sorted or exchanged.
    """
    first_id = first_review_id(old, prefix)
    if ordered:
        numbered = dense_ids(new, "review_id", REVIEW_ORDER, store, first_id=first_id)
    else:
        numbered = placed_ids(new, "review_id", store, first_id=first_id)
    return as_review(numbered.df, now)


def first_review_id(old: DataFrame, prefix: str | None = S.REVIEW_PREFIX) -> int:
    """The id after the highest one of the old review rows that stay."""
    return (old.where(~own_review_rows(prefix)).agg(F.max("review_id")).head()[0] or 0) + 1


def as_review(numbered: DataFrame, now: Column | None = None) -> DataFrame:
    return conform(numbered.withColumn("created_at_utc", F.current_timestamp() if now is None else now), S.REVIEW)


def own_review_rows(prefix: str | None = S.REVIEW_PREFIX) -> Column:
    """Review rows that an earlier run wrote; without a prefix none is."""
    return F.lit(False) if prefix is None else F.coalesce(F.col("source_row_id").startswith(prefix), F.lit(False))


def replace_review(old: DataFrame, new: DataFrame, store: StageStore, prefix: str | None = S.REVIEW_PREFIX, now: Column | None = None) -> DataFrame:
    """The review table after a run: own earlier rows out, new ones in, numbered in the order of their content, other rows untouched."""
    return old.where(~own_review_rows(prefix)).unionByName(review_rows_to_add(old, new, store, prefix, now, ordered=True))


def empty_tables(spark: SparkSession, schema: str, tables: Iterable[str]) -> DataFrame:
    """Empty the listed tables and report rows before and after; missing ones are skipped."""
    report = []
    for table in dict.fromkeys(tables):
        name = f"`{schema}`.`{table}`"
        if not spark.catalog.tableExists(f"{schema}.{table}"):
            report.append((table, "skipped", 0, 0, "table not found"))
            continue
        before = spark.table(name).count()
        after = load_table(spark.createDataFrame([], spark.table(name).schema), schema, table)
        report.append((table, "emptied", before, after, "table cleared"))
    return spark.createDataFrame(
        report, "table_name string, status string, rows_before long, rows_after long, reason string"
    )


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
