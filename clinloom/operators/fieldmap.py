"""Checks of the field-mapping rules against source columns, target schema and vocabulary."""

from __future__ import annotations

import csv
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinloom import schemas as S
from clinloom.operators import profile

DATABASE = "omop"  # how notes name the target database, unless told otherwise
SAMPLE_VALUES = 3

# Columns the rules name that the conversion itself does not write.
# --- fixed values ---
EXTRA_TARGET_COLUMNS = {
    "provider": ("specialty_concept_id", "specialty_source_concept_id"),
    "episode": (
        "episode_id", "person_id", "episode_concept_id", "episode_start_date", "episode_start_datetime", "episode_end_date",
        "episode_end_datetime", "episode_parent_id", "episode_number", "episode_object_concept_id", "episode_type_concept_id",
        "episode_source_value", "episode_source_concept_id",
    ),
}

_RULES = (
    "source_file string, source_column string, target_table string, target_column string, "
    "mapping_kind string, logic_text string, applies_when string, source_vocabulary string"
)


def mapping_rules(spark: SparkSession) -> DataFrame:
    """The declared rules, a fixed list shipped with the package."""
    lines = files("clinloom").joinpath("data/mapping_rules.csv").read_text(encoding="utf-8").splitlines()
    rows = list(csv.reader(line for line in lines if not line.startswith("#")))[1:]
    return spark.createDataFrame([tuple(cell or None for cell in row) for row in rows], _RULES)


def target_columns(spark: SparkSession) -> DataFrame:
    """``(target_table, target_column)`` of the target schema."""
    pairs = [(t, c) for t, schema in S.TARGETS.items() for c in schema.fieldNames()]
    pairs += [(t, c) for t, columns in EXTRA_TARGET_COLUMNS.items() for c in columns]
    return spark.createDataFrame(pairs, "target_table string, target_column string")


def source_fields(tables: Mapping[str, DataFrame], samples: bool = True, workers: int = 4) -> DataFrame:
    """One row per source column: file, column, rows of its file, sample values.

    Tables have no order, so the samples are the first 3 distinct values in
    text order. They are found by one aggregate a scan, several tables at a
    time; no cell is shuffled.
    """

    def of_table(name: str, df: DataFrame) -> list[tuple]:
        trimmed = {c: F.trim(F.col(f"`{c}`").cast("string")) for c in df.columns}
        values = {c: F.when(v != "", v) for c, v in trimmed.items()}
        rows, found = profile.first_distinct(df, values, SAMPLE_VALUES) if samples else (df.count(), dict.fromkeys(values, ()))
        return [(f"{name}.csv", rows, c, list(found[c]) if found[c] or not samples else None) for c in df.columns]

    with ThreadPoolExecutor(workers) as pool:
        parts = list(pool.map(lambda item: of_table(*item), tables.items()))
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame([row for part in parts for row in part], "file_name string, row_count long, column_name string, sample_values array<string>")


def rule_status(rules: DataFrame, targets: DataFrame, vocabularies: DataFrame, database: str = DATABASE) -> DataFrame:
    """Each rule with its validation status and note."""
    known = targets.withColumn("_known", F.lit(True))
    counts = vocabularies.select(F.col("vocabulary_id").alias("source_vocabulary"), F.col("concept_count").alias("_n"))
    joined = rules.join(known, ["target_table", "target_column"], "left").join(counts, "source_vocabulary", "left")

    kind, vocabulary = F.col("mapping_kind"), F.col("source_vocabulary")
    count = F.coalesce("_n", F.lit(0))
    target = F.concat("target_table", F.lit("."), "target_column")
    unset = (F.coalesce("target_table", F.lit("")) == "") | (F.coalesce("target_column", F.lit("")) == "")
    has_vocabulary = F.coalesce(vocabulary != "", F.lit(False))
    is_lookup = (kind == "concept_lookup") & has_vocabulary

    def text(*parts: Column | str) -> Column:
        return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))

    # --- fixed values: status words and note texts ---
    valid = text("Validated target ", target, f" in {database}.")
    branches = [
        (kind == "no_direct", "no_direct_omop_field", F.col("logic_text")),
        (unset, "unmapped_source_field", F.lit("No OMOP target column is configured for this mapping rule.")),
        (F.col("_known").isNull(), "invalid_target_reference", text("Target ", target, f" does not exist in {database}.")),
        (
            (kind == "review_required") & has_vocabulary,
            "review_required",
            text(valid, " Manual review required. Vocabulary ", vocabulary, " has ", count.cast("string"), " loaded concepts."),
        ),
        (
            kind == "review_required",
            "review_required",
            text(valid, " Manual review required because the source field can branch or requires ETL-specific interpretation."),
        ),
        (
            is_lookup & (count == 0),
            "validated_target_missing_vocabulary",
            text("Validated target ", target, ", but source vocabulary ", vocabulary, " is not loaded in concept."),
        ),
        (is_lookup, "validated", text(valid, " Vocabulary ", vocabulary, " is loaded with ", count.cast("string"), " concepts.")),
        (F.lit(True), "validated", valid),
    ]
    status, note = F.lit(None).cast("string"), F.lit(None).cast("string")
    for condition, label, message in reversed(branches):
        status = F.when(condition, label).otherwise(status)
        note = F.when(condition, message).otherwise(note)
    return joined.select(*rules.columns, status.alias("validation_status"), note.alias("validation_note"))


def match_fields(fields: DataFrame, rules: DataFrame) -> DataFrame:
    """Source columns and rules, matched without regard to case; both unmatched sides are kept."""
    left = fields.select("*", F.lower("file_name").alias("_file"), F.lower("column_name").alias("_column"))
    right = rules.select("*", F.lower("source_file").alias("_file"), F.lower("source_column").alias("_column"))
    return left.join(right, ["_file", "_column"], "full_outer").drop("_file", "_column")


def field_mappings(fields: DataFrame, checked_rules: DataFrame) -> DataFrame:
    """One row per source column and rule, with status and note."""
    has_column, has_rule = F.col("column_name").isNotNull(), F.col("source_column").isNotNull()
    missing = "Mapping rule references a source column that was not found. "

    def pick(no_rule: str, no_column: Column, both: Column) -> Column:
        return F.when(~has_rule, F.lit(no_rule)).when(~has_column, no_column).otherwise(both)

    status, note = F.col("validation_status"), F.col("validation_note")
    return match_fields(fields, checked_rules).select(
        F.coalesce("file_name", "source_file").alias("source_file"),
        F.coalesce("column_name", "source_column").alias("source_column"),
        F.coalesce("sample_values", F.array().cast("array<string>")).alias("sample_values"),
        "target_table",
        "target_column",
        F.coalesce("mapping_kind", F.lit("unmapped")).alias("mapping_kind"),
        "applies_when",
        "source_vocabulary",
        pick("unmapped_source_field", F.lit("source_column_missing"), status).alias("validation_status"),
        F.coalesce("logic_text", F.lit("No OMOP mapping rule is defined for this source field.")).alias("logic_text"),
        pick("Field is source-only or still needs ETL design.", F.concat(F.lit(missing), note), note).alias("validation_note"),
    )


def file_summary(fields: DataFrame, mappings: DataFrame) -> DataFrame:
    """Per scanned file: rows, columns, and columns mapped, to review, unmapped and invalid."""
    statuses = mappings.groupBy("source_file", "source_column").agg(F.collect_set("validation_status").alias("found"))

    def has(*names: str) -> Column:
        return F.arrays_overlap("found", F.array(*map(F.lit, names)))

    only_unmapped = F.size(F.array_except("found", F.array(F.lit("unmapped_source_field")))) == 0

    def count(test: Column, name: str) -> Column:
        return F.count(F.when(test, 1)).alias(name)

    flags = statuses.groupBy(F.col("source_file").alias("file_name")).agg(
        count(has("validated"), "mapped_fields"),
        count(has("review_required"), "review_fields"),
        count(only_unmapped, "unmapped_fields"),
        count(has("invalid_target_reference", "source_column_missing"), "invalid_fields"),
    )
    scanned = fields.groupBy("file_name").agg(F.max("row_count").alias("row_count"), F.count("*").alias("source_columns"))
    return scanned.join(flags, "file_name", "left").orderBy("file_name")


def target_coverage(mappings: DataFrame) -> DataFrame:
    """Per target column the source fields that feed it."""
    targeted = mappings.where((F.col("target_table") != "") & (F.col("target_column") != ""))
    field = F.concat("source_file", F.lit(":"), "source_column")
    return (
        targeted.groupBy("target_table", "target_column")
        .agg(F.array_sort(F.collect_set(field)).alias("_fields"))
        .select(
            "target_table",
            "target_column",
            F.size("_fields").alias("source_field_count"),
            F.array_join("_fields", ", ").alias("source_fields"),
        )
        .orderBy("target_table", "target_column")
    )


def vocabulary_status(rules: DataFrame, vocabularies: DataFrame) -> DataFrame:
    """The vocabularies the rules name, and whether they are loaded."""
    named = rules.where(F.col("source_vocabulary") != "").select(F.col("source_vocabulary").alias("vocabulary_id")).distinct()
    count = F.coalesce("concept_count", F.lit(0))
    note = F.when(count > 0, "Vocabulary available for concept lookup.").otherwise("Vocabulary missing from concept.")
    return (
        named.join(vocabularies, "vocabulary_id", "left")
        .select("vocabulary_id", count.alias("concept_count"), F.lit(True).alias("used_by_validator"), note.alias("note"))
        .orderBy("vocabulary_id")
    )
