"""Costs of visits, procedures, drugs and claims."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom import schemas as S
from clinloom.functions.text import patient_share, safe_double

AMOUNTS = ("total_charge", "total_cost", "total_paid", "paid_by_payer", "paid_by_patient")


def _amounts(event: str, domain: str, type_concept: int, *values: Column | None) -> list[Column]:
    return [
        F.col(event).alias("cost_event_id"),
        F.lit(domain).alias("cost_domain_id"),
        F.lit(type_concept).alias("cost_type_concept_id"),
        *(
            (F.lit(None) if value is None else value).cast("double").alias(name)
            for name, value in zip(AMOUNTS, values, strict=True)
        ),
    ]


def has_amount() -> Column:
    return F.coalesce(*AMOUNTS).isNotNull()


def _valid() -> Column:
    return F.col("review_reason").isNull()


def procedure_costs(procedures: DataFrame) -> DataFrame:
    """Costs of the stage table of procedures."""
    raw = F.col("raw_total_cost")
    return procedures.where(_valid() & raw.isNotNull() & (F.col("source_table") == "procedures")).select(
        *_amounts("procedure_occurrence_id", "Procedure", S.COST_TYPE, raw, raw, None, None, raw)
    )


def drug_costs(drugs: DataFrame) -> DataFrame:
    """Costs of the stage table of drugs."""
    raw, payer = F.col("raw_total_cost"), F.col("raw_paid_by_payer")
    return drugs.where(_valid() & raw.isNotNull()).select(
        *_amounts("drug_exposure_id", "Drug", S.COST_TYPE, raw, raw, None, payer, patient_share(raw, payer))
    )


def cost_stage(
    visits: DataFrame, of_procedures: DataFrame, of_drugs: DataFrame, transactions: DataFrame, visit_ids: DataFrame
) -> DataFrame:
    """``visits`` is the stage table, whose rows carry their encounter's amounts; those of procedures and drugs are costs already."""
    charge, covered = safe_double("TOTAL_CLAIM_COST"), safe_double("PAYER_COVERAGE")

    of_visits = visits.where(_valid()).select(
        *_amounts(
            "visit_occurrence_id", "Visit", S.COST_TYPE,
            charge, safe_double("BASE_ENCOUNTER_COST"), None, covered, patient_share(charge, covered),
        )
    )
    amount = safe_double("AMOUNT")
    of_claims = transactions.join(visit_ids, F.col("APPOINTMENTID") == F.col("encounter_source_id")).select(
        *_amounts(
            "visit_occurrence_id", "Visit", S.COST_TYPE_CLAIM,
            amount, amount, safe_double("PAYMENTS"), None, safe_double("OUTSTANDING"),
        )
    )
    branches = of_visits.unionByName(of_procedures).unionByName(of_drugs).unionByName(of_claims)
    return branches.where(F.col("cost_event_id").isNotNull() & has_amount())
