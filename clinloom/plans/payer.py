"""Payer plan periods."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom import schemas as S
from clinloom.functions import text as X
from clinloom.functions.rules import event_date_reason, first_reason, reason_if
from clinloom.operators.vocab import payer_concepts
from clinloom.plans.facts import Links


def payer_map(payers: DataFrame, concept: DataFrame) -> DataFrame:
    """Each payer with its cleaned name and the concept of that exact name."""
    joined = payers.withColumn("concept_name", F.col("NAME")).join(payer_concepts(concept), "concept_name", "left")
    return joined.select(
        F.col("Id").alias("payer_source_id"),
        X.clipped("NAME", 50).alias("payer_name"),
        F.coalesce("payer_concept_id", F.lit(S.NO_MATCH)).alias("payer_concept_id"),
    )


def payer_stage(transitions: DataFrame, payers: DataFrame, links: Links) -> DataFrame:
    joined = (
        transitions.where(F.col("START_YEAR").isNotNull())
        .join(links.persons, F.col("PATIENT") == F.col("patient_source_id"))
        .join(payers, F.col("PAYER") == F.col("payer_source_id"), "left")
    )
    begin = F.col("START_YEAR").cast("date")
    end = F.coalesce("END_YEAR", "START_YEAR").cast("date")
    concept = F.coalesce("payer_concept_id", F.lit(S.NO_MATCH))
    reason = first_reason(
        event_date_reason(begin, F.col("birth_date"), "payer_plan_period_start_date", links.as_of),
        reason_if(concept == S.NO_MATCH, "Payer could not be mapped to a standard Payer concept."),
        reason_if(end < begin, "payer_plan_period_end_date occurs before payer_plan_period_start_date."),
    )
    return joined.select(
        "person_id",
        begin.alias("payer_plan_period_start_date"),
        F.coalesce("payer_name", X.cut("PAYER", 50)).alias("payer_source_value"),
        X.cut("MEMBERID", 50).alias("plan_source_value"),
        X.row_id("payer_transitions", "PATIENT", X.plain_text("START_YEAR"), "PAYER").alias("source_row_id"),
        end.alias("payer_plan_period_end_date"),
        concept.alias("payer_concept_id"),
        X.clipped("OWNERSHIP", 50).alias("sponsor_source_value"),
        X.clipped("OWNERNAME", 50).alias("family_source_value"),
        X.clipped("SECONDARY_PAYER", 50).alias("stop_reason_source_value"),
        reason.alias("review_reason"),
    )
