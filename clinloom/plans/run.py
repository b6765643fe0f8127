"""Whole runs over catalog tables: load extracts, load the vocabulary, convert, validate."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinloom import schemas as S
from clinloom.operators import fieldmap, profile, rowcheck, vocab
from clinloom.operators.ids import placed_ids
from clinloom.operators.quality import assert_unique
from clinloom.plans.build import CdmBuild
from clinloom.sinks.tables import Later, append_tables, as_review, change_tables, conform, ensure_schema, first_review_id, load_tables, own_review_rows, review_rows_to_add, union_all
from clinloom.sources import files
from clinloom.sources.catalog import TableCheck, require, resolve_sources, resolve_targets
from clinloom.staging import StageStore


def load_extracts(
    spark: SparkSession, folder: str, schema: str = "synthea", prefix: str = "", sep: str | None = None,
    max_rows: int | None = None, multiline: bool | None = None,
) -> dict[str, int]:
    """Delimited files to typed staging tables, all or none; types come from all rows of each file.

    ``max_rows`` keeps the first rows of each file. Line breaks inside quotes
    are looked for in each file unless ``multiline`` tells.
    """
    ensure_schema(spark, schema)
    store = StageStore(spark)
    try:
        typed = {}
        for name, raw in files.read_directory(spark, folder, prefix, sep, multiline, store).items():
            checked = files.assert_well_formed(files.staged(raw, store, "file"), name)
            columns = [c for c in checked.columns if c != files.PLACE]
            rows = checked if max_rows is None else profile.first_rows(checked, max_rows, files.PLACE)
            kinds = profile.infer_load_types(checked, columns).collect()  # one row per column
            typed[name] = profile.coerce(rows.select(*(F.col(f"`{c}`") for c in columns)), {r["column_name"]: r["value_kind"] for r in kinds})
        return load_tables(typed, schema)
    finally:
        store.drop()


def load_vocabulary(spark: SparkSession, folder: str, schema: str = "dbo") -> DataFrame:
    """The nine vocabulary tables, fully reloaded, all or none; one report row per table."""
    ensure_schema(spark, schema)
    tables = files.read_vocabulary(spark, folder)
    loaded = load_tables({name: tables[name] for name in S.VOCABULARY if name in tables}, schema)
    report = []
    for name in S.VOCABULARY:
        if name in loaded:
            report.append((name, "loaded", loaded[name], "loaded from vocabulary files"))
        else:
            report.append((name, "skipped", 0, "no source files found"))
    return spark.createDataFrame(report, "table_name string, status string, rows_loaded long, reason string")


# sources that others refer to by Id; a repeated Id fails the run
KEYED_SOURCES = ("patients", "organizations", "providers", "encounters", "payers")


@dataclass(frozen=True)
class RunReport:
    """What a conversion found and wrote."""

    sources: list[TableCheck]
    targets: list[TableCheck]
    vocabularies: dict[str, int]
    rows_by_table: dict[str, int]
    review_rows: int


def convert(spark: SparkSession, schema: str = "dbo", review_table: str = S.REVIEW_TABLE, as_of: Column | None = None, execute: bool = True, preference=S.SOURCE_PREFERENCE) -> RunReport:
    """Convert the resolved source tables into the target tables of ``schema``.

    A dry run (``execute=False``) checks the tables and writes nothing. The
    tables are built and written one after another, so the disk holds the stage
    tables of a few of them; each is built by all executors.
    """
    sources, targets = resolve_sources(spark, preference), resolve_targets(spark, schema)
    require(sources, targets)
    concept = spark.table(f"{schema}.concept")
    vocabularies = {r["vocabulary_id"]: r["concept_count"] for r in vocab.vocabulary_check(concept).collect()}
    if not execute:
        return RunReport(sources, targets, vocabularies, {}, 0)

    store = StageStore(spark)
    try:
        tables = {check.name: spark.table(check.found_as) for check in sources}
        build = CdmBuild(tables, concept, spark.table(f"{schema}.concept_relationship"), as_of, store)
        # the numbered tables are sorted by Id, and a repeated one shows there without another shuffle
        for name, numbered in (("patients", build.patients), ("organizations", build.organizations), ("providers", build.providers)):
            assert_unique(numbered.df, name, "Id")
        for name in ("encounters", "payers"):
            assert_unique(tables[name], name, "Id")
        following, held = first_review_id(review_of(spark, schema, review_table)), []
        turns = build.in_turn(S.TARGET_TABLES)

        def rows_of(name: str) -> DataFrame:
            nonlocal following
            next(turns)  # the table before is written
            if name in S.REVIEWED_TABLES:
                numbered = placed_ids(build.review_of(name), "review_id", store, first_id=following)
                following += numbered.rows
                held.append(numbered.df)
            return conform(build.table(name), S.TARGETS[name])

        def review_rows() -> DataFrame:
            next(turns, None)
            return as_review(union_all(held))

        frames = {name: Later(S.TARGETS[name], partial(rows_of, name)) for name in build.order(S.TARGET_TABLES)}
        rows = change_tables(spark, schema, frames, {review_table: Later(S.REVIEW, review_rows)}, {review_table: own_review_rows()})
        return RunReport(sources, targets, vocabularies, {name: rows[name] for name in S.TARGET_TABLES}, rows[review_table])
    finally:
        store.drop()


def review_of(spark: SparkSession, schema: str, review_table: str) -> DataFrame:
    """The review table, made if there is none."""
    if not spark.catalog.tableExists(f"`{schema}`.`{review_table}`"):
        load_tables({review_table: spark.createDataFrame([], S.REVIEW)}, schema)
    return spark.table(f"`{schema}`.`{review_table}`")


def validate_proposals(
    proposals: DataFrame, concept: DataFrame, person: DataFrame, order_by: str, as_of: Column | None = None, store: StageStore | None = None
) -> dict[str, DataFrame]:
    """Concept checks, row checks, approved and review rows of proposed rows.

    With a store, which has to outlive the results, every step is written once and runs now.
    """
    today = F.current_date() if as_of is None else as_of
    checks = rowcheck.concept_checks(proposals, concept, order_by, store)
    checked = rowcheck.row_checks(proposals, rowcheck.concept_issues(checks), person, today, store)
    return {
        "concept_checks": checks.select(*rowcheck.CHECK_COLUMNS),
        "row_checks": checked,
        "approved": rowcheck.approved_rows(checked),
        "review": rowcheck.review_rows(checked),
        "summary": rowcheck.validation_summary(checks, checked),
    }


def apply_validation(spark: SparkSession, results: dict[str, DataFrame], schema: str = "dbo", review_table: str = S.REVIEW_TABLE) -> dict[str, int]:
    """Append approved rows to their target tables and held rows to the review table, all or nothing.

    The columns are those of the real target table. A row with a value for a
    column that its table does not have goes to the review table instead.
    """
    store = StageStore(spark)
    try:
        # written aside first: the person table is both read by the checks and a target
        if "row_checks" in results:  # the checks run once for both kinds of rows
            checked = store.save(results["row_checks"], "checked")
            approved, reviewed = rowcheck.approved_rows(checked), rowcheck.review_rows(checked)
        else:
            approved, reviewed = store.save(results["approved"], "approved"), results["review"]
        names = [r["target_table"] for r in approved.select("target_table").distinct().collect()]
        for table in names:
            if not spark.catalog.tableExists(f"`{schema}`.`{table}`"):
                raise ValueError(f"Unknown target table: {table}")
        schemas = {t: spark.table(f"`{schema}`.`{t}`").schema for t in names}
        known = F.create_map(*(x for t, s in schemas.items() for x in (F.lit(t), F.array(*map(F.lit, s.fieldNames()))))) if names else None
        unknown = F.array_except(F.map_keys("values"), known[F.col("target_table")]) if names else F.array()
        approved = store.save(approved.withColumn("_unknown", unknown), "approved-checked")
        fits = F.size("_unknown") == 0
        reason = F.concat(F.lit("Columns not in the target table: "), F.array_join(F.array_sort("_unknown"), ", "), F.lit("."))
        held = rowcheck.review_rows(approved.where(~fits).withColumn("status", F.lit("review")).withColumn("reason", reason))
        review = store.save(reviewed.unionByName(held), "review")
        good = approved.where(fits)
        present = [r["target_table"] for r in good.select("target_table").distinct().collect()]
        rows = {
            table: good.where(F.col("target_table") == table).select(
                *(F.try_element_at("values", F.lit(f.name)).cast(f.dataType).alias(f.name) for f in schemas[table].fields)
            )
            for table in present
        }
        added = review_rows_to_add(review_of(spark, schema, review_table), review, store, prefix=None)
        return append_tables({**rows, review_table: added}, schema)
    finally:
        store.drop()


def profile_extracts(spark: SparkSession, folder: str, schema: str, sep: str | None = None, multiline: bool | None = None) -> dict[str, int]:
    """Profile every delimited file of a folder into ``files_overview`` and ``column_profile``."""
    ensure_schema(spark, schema)
    store = StageStore(spark)
    try:
        overviews, profiles = [], []
        for source in files.list_csv(spark, folder):
            used = sep or files.choose_delimiter(files.header_line(spark, source.path))
            raw = files.staged(files.read_delimited(spark, source.path, used, files.has_breaks(spark, source.path, multiline), store=store), store, "file")
            df = files.assert_well_formed(raw, source.name)
            columns = [c for c in df.columns if c != files.PLACE]
            profiles.append(profile.column_profile(df, columns, source.name, order_by=files.PLACE))
            overviews.append(profile.file_profile(df, columns, source.name, used, source.size))
        rows = load_tables({"files_overview": union_all(overviews), "column_profile": union_all(profiles)}, schema)
    finally:
        store.drop()
    total = spark.table(f"{schema}.files_overview").agg(F.sum("row_count")).head()[0]
    return {"files_profiled": len(overviews), "columns_profiled": rows["column_profile"], "total_rows": total}


def report_field_mappings(
    spark: SparkSession, tables: dict[str, DataFrame], concept: DataFrame, schema: str, targets: DataFrame | None = None
) -> dict[str, int]:
    """Check the field-mapping rules and write the four report tables."""
    ensure_schema(spark, schema)
    rules = fieldmap.mapping_rules(spark)
    vocabularies = vocab.vocabulary_counts(concept)
    fields = fieldmap.source_fields(tables)
    status = fieldmap.rule_status(rules, fieldmap.target_columns(spark) if targets is None else targets, vocabularies)
    mappings = fieldmap.field_mappings(fields, status)
    reports = {
        "file_summary": fieldmap.file_summary(fields, mappings),
        "field_mappings": mappings.withColumn("sample_values", F.array_join("sample_values", " | ")),
        "target_coverage": fieldmap.target_coverage(mappings),
        "vocabulary_status": fieldmap.vocabulary_status(rules, vocabularies),
    }
    return load_tables(reports, schema)
