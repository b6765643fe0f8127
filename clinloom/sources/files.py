"""Delimited, vocabulary and JSON inputs."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinloom import schemas as S
from clinloom.sources.arrays import read_array
from clinloom.sources.records import breaks_in_quotes, read_records
from clinloom.staging import StageStore

BAD_ROW = "_malformed"
PLACE = "_place"

# --- fixed values: vocabulary files, parents first --------------------------------
VOCABULARY_FILES = {
    "domain": "DOMAIN.CSV",
    "vocabulary": "VOCABULARY.CSV",
    "concept_class": "CONCEPT_CLASS.CSV",
    "relationship": "RELATIONSHIP.CSV",
    "concept": "CONCEPT.CSV",
    "concept_synonym": "CONCEPT_SYNONYM.CSV",
    "concept_relationship": "CONCEPT_RELATIONSHIP.CSV",
    "drug_strength": "DRUG_STRENGTH.CSV",
    "concept_ancestor": "CONCEPT_ANCESTOR.CSV",
}


@dataclass(frozen=True)
class SourceFile:
    path: str
    name: str
    size: int

    @property
    def stem(self) -> str:
        return self.name.rsplit(".", 1)[0]


def list_csv(spark: SparkSession, folder: str, what: str = "CSV") -> list[SourceFile]:
    """The ``*.csv`` entries of a folder by lower-case name; a folder of parts counts as one file."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.endswith(".csv"):
            size = fs.getContentSummary(status.getPath()).getLength() if status.isDirectory() else status.getLen()
            found.append(SourceFile(status.getPath().toString(), name, size))
    if not found:
        raise FileNotFoundError(f"No {what} files were found in {folder}.")
    return sorted(found, key=lambda f: f.name.lower())


DELIMITERS = (",", "\t", "|")


def header_line(spark: SparkSession, path: str) -> str:
    first = spark.read.text(path).head()
    return "" if first is None else first["value"].removeprefix("\ufeff").rstrip("\r")


def choose_delimiter(line: str) -> str:
    """The delimiter that splits a header line into most names, outside quotes; a comma if none does."""
    return max(DELIMITERS, key=lambda sep: (len(next(csv.reader([line], delimiter=sep), [])), -DELIMITERS.index(sep)))


def read_header(spark: SparkSession, path: str, sep: str | None = None) -> list[str]:
    """The header names, checked before Spark reads the file: it would rename duplicates."""
    line = header_line(spark, path)
    header = next(csv.reader([line], delimiter=sep or choose_delimiter(line)), [])
    name = path.rstrip("/").rsplit("/", 1)[-1]
    if not any(header):
        raise ValueError(f"{name} is empty or missing a header row.")
    if len(set(header)) != len(header):
        raise ValueError(f"{name} contains duplicate header names: {header}")
    return header


def read_delimited(
    spark: SparkSession, path: str, sep: str | None = None, multiline: bool = False, columns: Sequence[str] | None = None, has_header: bool = True,
    store: StageStore | None = None,
) -> DataFrame:
    """All columns as text, and rows of another width in ``_malformed``.

    Without ``sep`` the header line tells the delimiter. ``multiline`` allows
    line breaks inside quotes: with a ``store`` for stage tables the file is
    read in splits and ``_place`` says where each record starts, without one by
    a single task.
    """
    sep = sep or choose_delimiter(header_line(spark, path))
    header = list(columns or read_header(spark, path, sep))
    if multiline and store is not None:
        return read_records(spark, path, header, sep, BAD_ROW, PLACE, store, has_header)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, BAD_ROW]])
    return (
        spark.read.schema(schema)
        .option("header", has_header)
        .option("enforceSchema", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
        # a pruned read would not notice rows of another width
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", BAD_ROW)
        .csv(path)
    )


def staged(df: DataFrame, store: StageStore, name: str) -> DataFrame:
    """A file's rows written once, with their place in it in ``_place``; the text is parsed this one time."""
    if PLACE in df.columns:
        return store.save(df, name)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("row"))
    return store.save(df.select("*", place.alias(PLACE)), name)


def _keeps_data(df: DataFrame) -> Column:
    # always true; Spark refuses to scan for the marker column alone
    return F.length(F.coalesce(F.col(f"`{df.columns[0]}`"), F.lit(""))) >= 0


def good_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col(BAD_ROW).isNull() & _keeps_data(df)).drop(BAD_ROW)


def malformed_rows(df: DataFrame) -> DataFrame:
    """Rows whose number of cells is not that of the header, as read."""
    return df.where(F.col(BAD_ROW).isNotNull() & _keeps_data(df))


def assert_well_formed(df: DataFrame, name: str) -> DataFrame:
    """The rows without the marker column; raises if one has another width than the header."""
    bad = malformed_rows(df).count()
    if bad:
        raise ValueError(f"{name} has {bad} rows with an unexpected number of columns.")
    return good_rows(df)


def read_directory(
    spark: SparkSession, folder: str, prefix: str = "", sep: str | None = None, multiline: bool | None = False, store: StageStore | None = None
) -> dict[str, DataFrame]:
    """One table per file, named ``prefix + stem``; ``multiline=None`` looks into each file for line breaks inside quotes."""
    found = list_csv(spark, folder)
    return {prefix + f.stem: read_delimited(spark, f.path, sep, has_breaks(spark, f.path, multiline), store=store) for f in found}


def has_breaks(spark: SparkSession, path: str, told: bool | None = None) -> bool:
    """What the caller says about line breaks inside quotes, or else what the file shows."""
    return breaks_in_quotes(spark, path) if told is None else told


def is_concept_file(name: str) -> bool:
    upper = name.upper()
    others = set(VOCABULARY_FILES.values()) - {"CONCEPT.CSV"}
    return upper == "CONCEPT.CSV" or (upper.startswith("CONCEPT_") and upper not in others)


def _takes(table: str, name: str) -> bool:
    return is_concept_file(name) if table == "concept" else name.upper() == VOCABULARY_FILES[table]


def unmapped_files(found: Sequence[SourceFile]) -> list[SourceFile]:
    """Files that no vocabulary table takes."""
    return sorted((f for f in found if not any(_takes(t, f.name) for t in VOCABULARY_FILES)), key=lambda f: f.name)


def vocabulary_files(found: Sequence[SourceFile]) -> dict[str, list[SourceFile]]:
    """The files of each vocabulary table; raises for files no table takes."""
    stray = unmapped_files(found)
    if stray:
        raise ValueError(f"Unmapped vocabulary CSV files were found: {', '.join(f.name for f in stray)}")
    return {table: [f for f in found if _takes(table, f.name)] for table in VOCABULARY_FILES}


def read_vocabulary_table(spark: SparkSession, table: str, paths: Sequence[str]) -> DataFrame:
    """Tab-separated, one record per line, no quoting, empty as NULL."""
    return (
        spark.read.schema(S.VOCABULARY[table])
        .option("header", True)
        .option("sep", "\t")
        .option("quote", "")
        .option("lineSep", "\n")
        .option("encoding", "UTF-8")
        .option("mode", "FAILFAST")
        .csv(list(paths))
    )


def read_vocabulary(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every vocabulary table that has files, parents first."""
    plan = vocabulary_files(list_csv(spark, folder, "vocabulary CSV"))
    return {t: read_vocabulary_table(spark, t, [f.path for f in files]) for t, files in plan.items() if files}


def read_proposals(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Proposed rows, one object per line; with ``multiline`` from JSON arrays over several lines, which are read in splits."""
    if multiline:
        raw = read_array(spark, path, S.PROPOSED_ROW)
    else:
        raw = spark.read.schema(S.PROPOSED_ROW).option("mode", "FAILFAST").json(path)
    return with_defaults(raw)


def with_defaults(proposals: DataFrame) -> DataFrame:
    """Missing flags are true; a missing person field stays NULL."""
    bindings = F.transform(
        F.coalesce("concept_bindings", F.array().cast(S.PROPOSED_ROW["concept_bindings"].dataType)),
        lambda b: b.withField("requires_standard", F.coalesce(b["requires_standard"], F.lit(True))),
    )
    return proposals.withColumn("concept_bindings", bindings).withColumn(
        "requires_existing_person", F.coalesce("requires_existing_person", F.lit(True))
    ).withColumn("values", F.coalesce("values", F.create_map().cast("map<string,string>")))
