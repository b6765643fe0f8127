"""Visits and observation periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom import schemas as S
from clinloom.functions.codes import visit_concept
from clinloom.functions.rules import event_date_reason, first_reason, reason_if
from clinloom.functions.text import clipped, row_id
from clinloom.operators.ids import Cells, Numbered, dense_ids
from clinloom.operators.lookups import lookup_side
from clinloom.staging import StageStore


def person_side(patients: Numbered) -> DataFrame:
    side = patients.df.select(
        F.col("Id").alias("patient_source_id"), "person_id", F.col("BIRTHDATE").alias("birth_date")
    )
    return lookup_side(side, patients.rows)


def provider_side(providers: Numbered) -> DataFrame:
    return lookup_side(providers.df.select(F.col("Id").alias("provider_source_id"), "provider_id"), providers.rows)


def visit_stage(
    encounters: DataFrame, patients: Numbered, providers: Numbered, organizations: Numbered, as_of: Column
) -> DataFrame:
    """All encounters of known patients, with a review reason where one applies."""
    sites = lookup_side(
        organizations.df.select(F.col("Id").alias("organization_source_id"), "care_site_id"), organizations.rows
    )
    begin = F.coalesce("START", "STOP")
    end = F.coalesce("STOP", "START")
    concept = visit_concept("ENCOUNTERCLASS")
    joined = (
        encounters.join(person_side(patients), F.col("PATIENT") == F.col("patient_source_id"))
        .join(provider_side(providers), F.col("PROVIDER") == F.col("provider_source_id"), "left")
        .join(sites, F.col("ORGANIZATION") == F.col("organization_source_id"), "left")
    )
    reason = first_reason(
        event_date_reason(begin.cast("date"), F.col("birth_date"), "visit_start_date", as_of),
        reason_if(concept == S.NO_MATCH, "Encounter class could not be mapped to a standard Visit concept."),
    )
    return joined.select(
        "person_id",
        begin.cast("timestamp_ntz").alias("visit_start_datetime"),
        F.col("Id").alias("encounter_source_id"),
        row_id("encounters", "Id").alias("source_row_id"),
        "provider_id",
        "care_site_id",
        begin.cast("date").alias("visit_start_date"),
        end.cast("date").alias("visit_end_date"),
        end.cast("timestamp_ntz").alias("visit_end_datetime"),
        concept.alias("visit_concept_id"),
        clipped("ENCOUNTERCLASS", 50).alias("visit_source_value"),
        "TOTAL_CLAIM_COST",
        "BASE_ENCOUNTER_COST",
        "PAYER_COVERAGE",
        reason.alias("review_reason"),
    )


def number_visits(stage: DataFrame, store: StageStore, persons: Cells | None = None) -> Numbered:
    """Valid visits get ids 1..n by person, start and encounter; held ones follow after n.

    One sorted table then serves both the visits and the review rows. ``persons`` are the cells of all its rows.
    """
    held = stage.withColumn("_held", F.col("review_reason").isNotNull().cast("int"))
    order = ["_held", "person_id", "visit_start_datetime", "encounter_source_id"]
    # held or not is only known later, so either half is laid out for all
    cells = persons and Cells(F.col("_held") * len(persons.rows) + persons.number, [*persons.rows, *persons.rows])
    numbered = dense_ids(held, "visit_occurrence_id", order, store, cells=cells)
    return Numbered(numbered.df.drop("_held"), numbered.rows)


def valid_visits(numbered: Numbered) -> DataFrame:
    return numbered.df.where(F.col("review_reason").isNull())


def preceding_visits(visits: DataFrame) -> DataFrame:
    """Adds the previous visit of the same person.

    Ids are dense in (person, start) order, so it is the id before, except on a
    person's first visit. First visits are found by one pre-aggregated minimum
    and joined on the visit id, which is unique: no person can make a hot group.
    """
    firsts = visits.groupBy("person_id").agg(F.min("visit_occurrence_id").alias("first_id")).select("first_id")
    joined = visits.join(firsts, F.col("visit_occurrence_id") == F.col("first_id"), "left")
    return joined.withColumn(
        "preceding_visit_occurrence_id", F.when(F.col("first_id").isNull(), F.col("visit_occurrence_id") - 1)
    ).drop("first_id")


def visit_occurrence(numbered: Numbered) -> DataFrame:
    typed = valid_visits(numbered).withColumn("visit_type_concept_id", F.lit(S.VISIT_TYPE))
    return preceding_visits(typed).select(*S.TARGETS["visit_occurrence"].fieldNames())


def observation_period(visits: DataFrame, store: StageStore) -> DataFrame:
    spans = visits.groupBy("person_id").agg(
        F.min("visit_start_date").alias("observation_period_start_date"),
        F.max("visit_end_date").alias("observation_period_end_date"),
    )
    typed = spans.withColumn("period_type_concept_id", F.lit(S.OBSERVATION_PERIOD_TYPE))
    numbered = dense_ids(typed, "observation_period_id", ["person_id"], store).df
    return numbered.select(*S.TARGETS["observation_period"].fieldNames())
