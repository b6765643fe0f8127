"""Checks of proposed rows against the vocabulary and the person table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom.functions import text as X
from clinloom.operators.lookups import spread
from clinloom.schemas import PRIMARY_CONCEPT
from clinloom.staging import StageStore

_BINDING = (
    "array<struct<step:int,n:int,field_name:string,concept_id:long,given:boolean,value_id:long,"
    "needs_standard:boolean,expected:string>>"
)


def _primary(part: int) -> Column:
    chain = F.lit(None).cast("string")
    for table, rule in PRIMARY_CONCEPT.items():
        chain = F.when(F.col("target_table") == table, rule[part]).otherwise(chain)
    return chain


def _items() -> Column:
    """What to check per row: unbound concept fields, the main field if unbound, each binding."""
    values, primary = F.col("values"), F.col("_primary")
    bindings = F.coalesce("concept_bindings", F.expr("cast(array() as array<struct<field_name:string,concept_id:string,requires_standard:boolean,required_domain:string>>)"))
    bound = F.transform(bindings, lambda b: b["field_name"])
    loose = F.array_sort(
        F.filter(F.map_keys(values), lambda k: k.endswith("_concept_id") & ~F.coalesce(F.array_contains(bound, k), F.lit(False)))
    )

    def item(step, n, field, concept_id, given, value_id, needs, expected):
        return F.struct(
            F.lit(step).alias("step"), n.cast("int").alias("n"), field.alias("field_name"), concept_id.alias("concept_id"),
            given.alias("given"), value_id.alias("value_id"), needs.alias("needs_standard"), expected.alias("expected"),
        )

    nothing, no_id, no_text = F.lit(None).cast("boolean"), F.lit(None).cast("long"), F.lit(None).cast("string")
    of_loose = F.transform(loose, lambda f, n: item(0, n, f, X.safe_id(F.try_element_at(values, f)), nothing, no_id, nothing, no_text))
    of_primary = F.when(
        primary.isNotNull() & ~F.coalesce(F.array_contains(bound, primary), F.lit(False)),
        F.array(item(1, F.lit(0), primary, no_id, nothing, no_id, nothing, no_text)),
    ).otherwise(F.expr(f"cast(array() as {_BINDING})"))

    def of_binding(b, n):
        main = F.coalesce(b["field_name"] == primary, F.lit(False))
        return item(
            2, n, b["field_name"], X.safe_id(b["concept_id"]), F.array_contains(F.map_keys(values), b["field_name"]),
            X.safe_id(F.try_element_at(values, b["field_name"])),
            main | F.coalesce(b["requires_standard"], F.lit(True)),
            F.when(main, F.col("_domain")).otherwise(b["required_domain"]),
        )

    return F.concat(
        of_loose.cast(_BINDING), of_primary.cast(_BINDING), F.transform(bindings, of_binding).cast(_BINDING)
    )


def concept_checks(proposals: DataFrame, concept: DataFrame, order_by: str, store: StageStore | None = None) -> DataFrame:
    """One row per check, the first rule that fails or ``validated``.

    ``order_by`` names the column that tells the order of the proposed rows.
    With a store the checks' items are written once; else the rows are taken
    apart again to find the concepts asked for.
    """
    prepared = proposals.withColumn("_primary", _primary(0)).withColumn("_domain", _primary(1))
    items = prepared.select(F.col(order_by).alias("_row"), "source_row_id", "target_table", F.inline(_items()))
    looked_up = F.when((F.col("step") == 2) & F.col("given") & (F.col("value_id") == F.col("concept_id")), F.col("concept_id"))
    items = items.withColumn("_lookup", looked_up)
    if store is not None:
        items = store.save(items, "check-items")
    # concepts are cut down to those asked for; checks without a lookup stay spread over the partitions
    asked = items.where(F.col("_lookup").isNotNull()).select(F.col("_lookup").alias("_concept")).distinct()
    known = concept.select(
        F.col("concept_id").cast("long").alias("_concept"), "concept_name", "domain_id", "vocabulary_id", "standard_concept"
    ).join(asked, "_concept", "left_semi").withColumn("_key", F.col("_concept").cast("string"))
    spread_key = spread(F.col("_lookup").cast("string"), "_row", "step", "n")
    joined = items.withColumn("_key", spread_key).join(known, "_key", "left").drop("_key")

    field, bound, value = F.col("field_name"), F.col("concept_id"), F.col("value_id")
    name, number = field, bound.cast("string")
    # --- fixed values: reason texts and their order ---
    reason = (
        F.when(F.col("step") == 0, F.concat(F.lit("Missing concept binding metadata for "), name, F.lit(".")))
        .when(F.col("step") == 1, F.concat(F.lit("Missing binding for required primary concept field "), name, F.lit(".")))
        .when(~F.col("given"), F.concat(F.lit("Field "), name, F.lit(" is missing from the proposed values.")))
        .when(bound.isNull() | value.isNull(), F.concat(name, F.lit(" concept_id must not be null.")))
        .when(
            bound != value,
            F.concat(F.lit("Binding mismatch for "), name, F.lit(": values contains "), value.cast("string"), F.lit(", binding contains "), number, F.lit(".")),
        )
        .when(F.col("_concept").isNull(), F.concat(F.lit("concept_id "), number, F.lit(" does not exist in concept.")))
        .when(
            F.col("needs_standard") & ~F.coalesce(F.col("standard_concept") == "S", F.lit(False)),
            F.concat(F.lit("concept_id "), number, F.lit(" is not a standard concept for "), name, F.lit(".")),
        )
        .when(
            (F.col("expected") != "") & ~F.coalesce(F.col("domain_id") == F.col("expected"), F.lit(False)),
            F.concat(
                F.lit("concept_id "), number, F.lit(" belongs to domain "), F.coalesce("domain_id", F.lit("None")),
                F.lit(", expected "), F.col("expected"), F.lit("."),
            ),
        )
    )
    return joined.withColumn("_reason", reason).select(
        "_row",
        "step",
        "n",
        "source_row_id",
        "target_table",
        "field_name",
        "concept_id",
        F.when(F.col("_reason").isNull(), "validated").otherwise("review").alias("status"),
        F.coalesce("_reason", F.lit("Concept binding validated.")).alias("reason"),
        "concept_name",
        "domain_id",
        "vocabulary_id",
        "standard_concept",
    )


CHECK_COLUMNS = (
    "source_row_id", "target_table", "field_name", "concept_id", "status", "reason",
    "concept_name", "domain_id", "vocabulary_id", "standard_concept",
)


def concept_issues(checks: DataFrame) -> DataFrame:
    """The distinct failed-check reasons per source row id, in order of appearance.

    Repeats collapse before the reasons of one id are brought together.
    """
    distinct = (
        checks.where(F.col("status") == "review")
        .groupBy("source_row_id", "reason")
        .agg(F.min(F.struct("_row", "step", "n")).alias("place"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("place", "reason")))
    return distinct.groupBy("source_row_id").agg(F.transform(ordered, lambda s: s["reason"]).alias("issues"))


def birth_dates(person: DataFrame) -> DataFrame:
    born = X.birth_date_from_parts(
        F.col("birth_datetime"), F.col("year_of_birth"), F.col("month_of_birth"), F.col("day_of_birth")
    )
    return person.select(F.col("person_id").alias("known_person"), born.alias("birth_date"))


def _value(field: Column) -> Column:
    return F.try_element_at("values", field)


def proposed_person(proposals: DataFrame) -> DataFrame:
    """Adds ``person_id``, and ``person_is_bad`` where the value is no integer."""
    raw = _value(F.col("person_id_field"))
    return proposals.withColumn("person_id", X.safe_id(raw)).withColumn(
        "person_is_bad", F.coalesce(X.is_bad_id(raw), F.lit(False))
    )


def missing_persons(proposals: DataFrame, person: DataFrame) -> DataFrame:
    """Proposed rows whose person is required but not in the person table."""
    named = proposed_person(proposals).where(
        F.coalesce("requires_existing_person", F.lit(True)) & F.col("person_id").isNotNull()
    )
    return named.join(person.select("person_id"), "person_id", "left_anti").select("source_row_id", "target_table", "person_id")


def row_checks(proposals: DataFrame, issues: DataFrame, person: DataFrame, as_of: Column, store: StageStore | None = None) -> DataFrame:
    """Every proposed row with status ``approved`` or ``review`` and all its reasons.

    With a store the rows with their person ids, and the checked rows, are
    written once. Filters on them would else be answered by working the ids and
    reasons out inside the filter, again for each use in it.
    """
    required = F.coalesce("requires_existing_person", F.lit(True))
    rows = proposed_person(proposals)
    if store is not None:
        rows = store.save(rows, "proposed")
    # persons are looked up for the rows that require one
    asked = rows.where(required & F.col("person_id").isNotNull()).select(F.col("person_id").alias("known_person")).distinct()
    known = birth_dates(person).join(asked, "known_person", "left_semi")
    joined = rows.join(issues, "source_row_id", "left").join(known, F.col("person_id") == F.col("known_person"), "left")

    start_field = F.nullif("start_date_field", F.lit(""))
    event_field = F.coalesce(F.nullif("event_date_field", F.lit("")), start_field)
    start_text, event_text = X.blank_to_null(_value(start_field)), X.blank_to_null(_value(event_field))
    prepared = joined.select(
        "*",
        start_field.alias("_start_field"), event_field.alias("_event_field"),
        start_text.alias("_start_text"), event_text.alias("_event_text"),
        X.event_date(start_text).alias("_start"), X.event_date(event_text).alias("_event"),
    )

    person_id, found = F.col("person_id"), F.col("known_person").isNotNull()
    event, birth = F.col("_event"), F.col("birth_date")
    person_field = F.coalesce(F.nullif("person_id_field", F.lit("")), F.lit("person_id"))
    start_is_bad = F.col("_start_text").isNotNull() & F.col("_start").isNull()
    event_is_bad = F.col("_event_text").isNotNull() & event.isNull()
    uncertainty = F.nullif("uncertainty_reason", F.lit(""))
    reasons = [
        F.concat(F.lit("Uncertain mapping: "), uncertainty),
        F.when(F.col("person_is_bad"), F.concat(person_field, F.lit(" is not an integer."))),
        F.when(required & person_id.isNull() & ~F.col("person_is_bad"), F.concat(person_field, F.lit(" must not be null."))),
        F.when(
            required & person_id.isNotNull() & ~found,
            F.concat(F.lit("person_id "), person_id.cast("string"), F.lit(" does not exist in OMOP person.")),
        ),
        F.when(start_is_bad, F.concat("_start_field", F.lit(" is not a valid date."))),
        F.when(F.col("_start_field").isNotNull() & F.col("_start").isNull(), F.concat("_start_field", F.lit(" must not be null."))),
        F.when(event_is_bad, F.concat("_event_field", F.lit(" is not a valid date."))),
        F.when(
            found & event.isNotNull() & birth.isNull(),
            F.concat(F.lit("Birth date for person_id "), person_id.cast("string"), F.lit(" is unavailable.")),
        ),
        F.when(
            found & (event < birth),
            F.concat("_event_field", F.lit(" "), event.cast("string"), F.lit(" occurs before birth date "), birth.cast("string"), F.lit(".")),
        ),
        F.when(event > as_of, F.concat("_event_field", F.lit(" "), event.cast("string"), F.lit(" is in the future."))),
    ]
    own = F.filter(F.array(*reasons), lambda r: r.isNotNull())
    every = F.array_distinct(F.concat(F.coalesce("issues", F.expr("cast(array() as array<string>)")), own))
    checked = prepared.withColumn("_reasons", every)
    is_clean = F.size("_reasons") == 0
    checked = checked.select(
        *proposals.columns,
        F.when(is_clean, "approved").otherwise("review").alias("status"),
        F.when(is_clean, "Row passed validation and can be rendered into SQL.").otherwise(F.array_join("_reasons", "; ")).alias("reason"),
    )
    return checked if store is None else store.save(checked, "checked")


def approved_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("status") == "approved").drop("status", "reason")


def review_payload() -> Column:
    """The whole proposed row as JSON with keys in alphabetical order."""
    sorted_values = F.map_from_entries(F.array_sort(F.map_entries("values")))
    bindings = F.transform(
        F.coalesce("concept_bindings", F.expr("cast(array() as array<struct<field_name:string,concept_id:string,requires_standard:boolean,required_domain:string>>)")),
        lambda b: F.struct(
            X.safe_id(b["concept_id"]).alias("concept_id"),
            b["field_name"].alias("field_name"),
            b["required_domain"].alias("required_domain"),
            F.coalesce(b["requires_standard"], F.lit(True)).alias("requires_standard"),
        ),
    )
    return F.to_json(
        F.struct(
            bindings.alias("concept_bindings"),
            "event_date_field",
            "person_id_field",
            F.coalesce("requires_existing_person", F.lit(True)).alias("requires_existing_person"),
            "source_row_id",
            "start_date_field",
            "target_table",
            "uncertainty_reason",
            sorted_values.alias("values"),
        ),
        {"ignoreNullFields": "false"},
    )


def review_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("status") == "review").select(
        "target_table",
        "source_row_id",
        F.lit("review").alias("review_status"),
        F.col("reason").alias("review_reason"),
        review_payload().alias("payload_json"),
    )


def validation_summary(checks: DataFrame, checked: DataFrame) -> DataFrame:
    """Counts of proposed, approved and held rows and of checked and passed bindings."""

    def metrics(df: DataFrame, **counts: Column) -> DataFrame:
        wide = df.agg(*(F.count(F.when(test, 1)).alias(name) for name, test in counts.items()))
        return wide.select(F.inline(F.array(*(F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in counts))))

    status = F.col("status")
    of_rows = metrics(
        checked, rows_proposed=F.lit(True), rows_approved=status == "approved", rows_reviewed=status == "review"
    )
    of_checks = metrics(checks, concept_bindings_checked=F.lit(True), concept_bindings_validated=status == "validated")
    return of_rows.unionByName(of_checks)
