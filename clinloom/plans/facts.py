"""The six clinical fact tables: staged, numbered, and split into loaded and held rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom import schemas as S
from clinloom.functions import text as X
from clinloom.functions.rules import concept_reason, event_date_reason, first_reason, is_measurement
from clinloom.operators.lookups import spread
from clinloom.operators.vocab import ConceptSides, join_concept, unpivot_diagnoses


@dataclass(frozen=True)
class Links:
    """What every fact is joined to. The sides are broadcast only where counted small."""

    persons: DataFrame  # patient_source_id, person_id, birth_date
    visits: DataFrame  # encounter_source_id, visit_occurrence_id, visit_provider_id, visit_start_*
    providers: DataFrame  # provider_source_id, provider_id
    concepts: ConceptSides  # concept lookup
    as_of: Column

    def join(self, facts: DataFrame, patient: str = "PATIENT", encounter: str = "ENCOUNTER") -> DataFrame:
        """Facts of known patients, with their visit where it was accepted."""
        known = facts.join(self.persons, F.col(patient) == F.col("patient_source_id"))
        # the key is part of the condition, so it isn't shuffled beside the encounter
        key = spread(F.col(encounter), patient, *facts.columns[:4])
        return known.join(self.visits, key == F.col("encounter_source_id"), "left")

    def reason(self, day: Column, field: str, expected: str, label: str) -> Column:
        return first_reason(
            event_date_reason(day, F.col("birth_date"), field, self.as_of),
            concept_reason(F.col("standard_concept_id"), F.col("standard_domain_id"), expected, label),
        )


def _concepts(prefix: str, code: str) -> list[Column]:
    return [
        X.cut(code, 50).alias(f"{prefix}_source_value"),
        F.col("source_concept_id").alias(f"{prefix}_source_concept_id"),
        F.col("standard_concept_id").alias(f"{prefix}_concept_id"),
    ]


def _no(kind: str) -> Column:
    return F.lit(None).cast(kind)


# --- conditions ------------------------------------------------------------------


def condition_stage(conditions: DataFrame, claims: DataFrame, links: Links) -> DataFrame:
    start = F.coalesce("START", "visit_start_date")
    coded = join_concept(conditions.where(X.has_code("CODE")), links.concepts, "SNOMED", "CODE")
    recorded = (
        links.join(coded)
        .where(start.isNotNull())
        .select(
            "person_id",
            F.coalesce(F.col("START").cast("timestamp_ntz"), "visit_start_datetime").alias("condition_start_datetime"),
            F.lit("conditions").alias("source_table"),
            *_concepts("condition", "CODE"),
            X.row_id(
                "conditions", "PATIENT", "ENCOUNTER", X.day_text("START"), "CODE"
            ).alias("source_row_id"),
            start.alias("condition_start_date"),
            F.col("STOP").alias("condition_end_date"),
            F.col("STOP").cast("timestamp_ntz").alias("condition_end_datetime"),
            F.col("visit_provider_id").alias("provider_id"),
            "visit_occurrence_id",
            F.lit(S.CONDITION_TYPE_EHR).alias("condition_type_concept_id"),
            links.reason(start, "condition_start_date", "Condition", "Condition code").alias("review_reason"),
        )
    )
    # the eight slots stay in one row until the shuffled joins are done
    served = F.col("SERVICEDATE")
    linked = links.join(claims.where(served.isNotNull()), "PATIENTID", "APPOINTMENTID").join(
        links.providers, F.col("PROVIDERID") == F.col("provider_source_id"), "left"
    )
    diagnoses = unpivot_diagnoses(
        linked, "Id", "SERVICEDATE", "person_id", "birth_date", "visit_occurrence_id", "visit_provider_id", "provider_id"
    )
    claimed = join_concept(diagnoses, links.concepts, "SNOMED", "code").select(
        "person_id",
        served.cast("timestamp_ntz").alias("condition_start_datetime"),
        F.lit("claims").alias("source_table"),
        *_concepts("condition", "code"),
        X.row_id("claims", "Id", F.concat(F.lit("dx"), "slot_number")).alias("source_row_id"),
        served.cast("date").alias("condition_start_date"),
        _no("date").alias("condition_end_date"),
        _no("timestamp_ntz").alias("condition_end_datetime"),
        F.coalesce("visit_provider_id", "provider_id").alias("provider_id"),
        "visit_occurrence_id",
        F.lit(S.CONDITION_TYPE_CLAIM).alias("condition_type_concept_id"),
        links.reason(served.cast("date"), "condition_start_date", "Condition", "Claim diagnosis code").alias("review_reason"),
    )
    return recorded.unionByName(claimed)


# --- procedures ------------------------------------------------------------------


def procedure_stage(procedures: DataFrame, careplans: DataFrame, imaging: DataFrame, links: Links) -> DataFrame:
    def branch(table, joined, code, moment, day, row_id, end, type_concept, modifier, cost, label):
        return joined.select(
            "person_id",
            moment.alias("procedure_datetime"),
            F.lit(table).alias("source_table"),
            *_concepts("procedure", code),
            row_id.alias("source_row_id"),
            day.alias("procedure_date"),
            end.cast("date").alias("procedure_end_date"),
            end.cast("timestamp_ntz").alias("procedure_end_datetime"),
            F.col("visit_provider_id").alias("provider_id"),
            "visit_occurrence_id",
            F.lit(type_concept).alias("procedure_type_concept_id"),
            modifier.alias("modifier_source_value"),
            cost.alias("raw_total_cost"),
            links.reason(day, "procedure_date", "Procedure", label).alias("review_reason"),
        )

    def coded(df, code):
        return links.join(join_concept(df.where(X.has_code(code)), links.concepts, "SNOMED", code))

    start = F.col("START")
    day = F.coalesce(start.cast("date"), "visit_start_date")
    done = branch(
        "procedures",
        coded(procedures, "CODE").where(day.isNotNull()),
        "CODE",
        F.coalesce(start.cast("timestamp_ntz"), "visit_start_datetime"),
        day,
        X.row_id("procedures", "PATIENT", "ENCOUNTER", X.iso_text("START"), "CODE"),
        F.col("STOP"),
        S.PROCEDURE_TYPE,
        _no("string"),
        X.safe_double("BASE_COST"),
        "Procedure code",
    )
    planned = branch(
        "careplans",
        coded(careplans, "CODE").where(day.isNotNull()),
        "CODE",
        day.cast("timestamp_ntz"),
        day,
        X.row_id("careplans", "Id"),
        F.col("STOP"),
        S.PROCEDURE_TYPE,
        _no("string"),
        _no("double"),
        "Care plan code",
    )
    taken = F.col("DATE")
    imaged = branch(
        "imaging_studies",
        coded(imaging.where(taken.isNotNull()), "PROCEDURE_CODE"),
        "PROCEDURE_CODE",
        taken.cast("timestamp_ntz"),
        taken.cast("date"),
        X.row_id("imaging", "Id"),
        _no("timestamp_ntz"),
        S.PROCEDURE_TYPE_IMAGING,
        X.clipped("MODALITY_CODE", 50),
        _no("double"),
        "Imaging procedure code",
    )
    return done.unionByName(planned).unionByName(imaged)


# --- drugs -----------------------------------------------------------------------


def drug_stage(medications: DataFrame, immunizations: DataFrame, links: Links) -> DataFrame:
    def branch(table, df, vocabulary, begin, end, row_time, type_concept, refills, quantity, days, cost, payer, label):
        valid = df.where(begin.isNotNull() & X.has_code("CODE"))
        joined = links.join(join_concept(valid, links.concepts, vocabulary, "CODE"))
        return joined.select(
            "person_id",
            begin.cast("timestamp_ntz").alias("drug_exposure_start_datetime"),
            F.lit(table).alias("source_table"),
            *_concepts("drug", "CODE"),
            X.row_id(table, "PATIENT", "ENCOUNTER", X.iso_text(row_time), "CODE").alias("source_row_id"),
            begin.cast("date").alias("drug_exposure_start_date"),
            end.cast("date").alias("drug_exposure_end_date"),
            end.cast("timestamp_ntz").alias("drug_exposure_end_datetime"),
            F.col("visit_provider_id").alias("provider_id"),
            "visit_occurrence_id",
            F.lit(type_concept).alias("drug_type_concept_id"),
            refills.cast("int").alias("refills"),
            quantity.alias("quantity"),
            days.cast("int").alias("days_supply"),
            cost.alias("raw_total_cost"),
            payer.alias("raw_paid_by_payer"),
            links.reason(begin.cast("date"), "drug_exposure_start_date", "Drug", label).alias("review_reason"),
        )

    start, stop, given = F.col("START"), F.col("STOP"), F.col("DATE")
    prescribed = branch(
        "medications", medications, "RxNorm",
        F.coalesce(start, stop), F.coalesce(stop, start), "START",
        S.DRUG_TYPE_MEDICATION,
        X.refills("DISPENSES"), X.safe_double("DISPENSES"), X.days_supply(start, stop),
        X.safe_double("TOTALCOST"), X.safe_double("PAYER_COVERAGE"),
        "Medication code",
    )
    vaccinated = branch(
        "immunizations", immunizations, "CVX",
        given, given, "DATE",
        S.DRUG_TYPE_IMMUNIZATION,
        F.lit(0), F.lit(1.0), F.lit(1),
        X.safe_double("BASE_COST"), _no("double"),
        "Immunization code",
    )
    return prescribed.unionByName(vaccinated)


# --- measurements and observations -------------------------------------------------


def observation_links(observations: DataFrame, links: Links) -> DataFrame:
    """Source observations with code and unit concepts and the routing flag."""
    valid = observations.where(F.col("DATE").isNotNull() & X.has_code("CODE"))
    coded = join_concept(valid, links.concepts, "LOINC", "CODE")
    united = join_concept(coded, links.concepts, "UCUM", "UNITS", prefix="unit_")
    kind = F.upper(F.nullif(X.normalized("TYPE"), F.lit("")))
    return united.withColumn("_measurement", is_measurement(F.col("standard_domain_id"), kind))


def _observation_row_id() -> Column:
    return X.row_id("observations", "PATIENT", "ENCOUNTER", X.iso_text("DATE"), "CODE")


def measurement_stage(routed: DataFrame, links: Links) -> DataFrame:
    moment = F.col("DATE")
    return links.join(routed.where("_measurement")).select(
        "person_id",
        moment.cast("timestamp_ntz").alias("measurement_datetime"),
        *_concepts("measurement", "CODE"),
        _observation_row_id().alias("source_row_id"),
        moment.cast("date").alias("measurement_date"),
        X.time_text(moment).alias("measurement_time"),
        F.col("visit_provider_id").alias("provider_id"),
        "visit_occurrence_id",
        X.safe_double("VALUE").alias("value_as_number"),
        F.col("unit_standard_concept_id").alias("unit_concept_id"),
        F.col("unit_source_concept_id"),
        X.clipped("UNITS", 50).alias("unit_source_value"),
        X.clipped("VALUE", 50).alias("value_source_value"),
        F.lit(S.MEASUREMENT_TYPE).alias("measurement_type_concept_id"),
        links.reason(moment.cast("date"), "measurement_date", "Measurement", "Observation code").alias("review_reason"),
    )


def observation_stage(routed: DataFrame, allergies: DataFrame, links: Links) -> DataFrame:
    def branch(table, joined, moment, row_id, number, text, unit, unit_text, value_text, qualifier, label):
        return joined.select(
            "person_id",
            moment.cast("timestamp_ntz").alias("observation_datetime"),
            F.lit(table).alias("source_table"),
            *_concepts("observation", "CODE"),
            row_id.alias("source_row_id"),
            moment.cast("date").alias("observation_date"),
            F.col("visit_provider_id").alias("provider_id"),
            "visit_occurrence_id",
            number.alias("value_as_number"),
            F.nullif(X.cut(text, 60), F.lit("")).alias("value_as_string"),
            unit.alias("unit_concept_id"),
            unit_text.alias("unit_source_value"),
            X.clipped(value_text, 50).alias("value_source_value"),
            qualifier.alias("qualifier_source_value"),
            F.lit(S.OBSERVATION_TYPE).alias("observation_type_concept_id"),
            links.reason(moment.cast("date"), "observation_date", "Observation", label).alias("review_reason"),
        )

    observed = branch(
        "observations", links.join(routed.where(~F.col("_measurement"))), F.col("DATE"), _observation_row_id(),
        X.safe_double("VALUE"), "VALUE", F.col("unit_standard_concept_id"), X.clipped("UNITS", 50),
        "VALUE", X.clipped("CATEGORY", 50), "Observation code",
    )
    valid = allergies.where(F.col("START").isNotNull() & X.has_code("CODE"))
    qualifier = F.coalesce(F.nullif(X.normalized("TYPE"), F.lit("")), F.nullif(X.normalized("CATEGORY"), F.lit("")))
    allergic = branch(
        "allergies", links.join(join_concept(valid, links.concepts, "SNOMED", "CODE")), F.col("START"),
        X.row_id("allergies", "PATIENT", "ENCOUNTER", "CODE"),
        _no("double"), "DESCRIPTION", _no("int"), _no("string"),
        "DESCRIPTION", X.cut(qualifier, 50), "Allergy code",
    )
    return observed.unionByName(allergic)


# --- devices ---------------------------------------------------------------------


def device_stage(devices: DataFrame, supplies: DataFrame, links: Links) -> DataFrame:
    def branch(table, df, begin, end, udi, quantity, label):
        valid = df.where(begin.isNotNull() & X.has_code("CODE"))
        joined = links.join(join_concept(valid, links.concepts, "SNOMED", "CODE"))
        return joined.select(
            "person_id",
            begin.cast("timestamp_ntz").alias("device_exposure_start_datetime"),
            F.lit(table).alias("source_table"),
            *_concepts("device", "CODE"),
            X.row_id(table, "PATIENT", "ENCOUNTER", "CODE").alias("source_row_id"),
            begin.cast("date").alias("device_exposure_start_date"),
            end.cast("date").alias("device_exposure_end_date"),
            end.cast("timestamp_ntz").alias("device_exposure_end_datetime"),
            F.col("visit_provider_id").alias("provider_id"),
            "visit_occurrence_id",
            udi.alias("unique_device_id"),
            quantity.cast("int").alias("quantity"),
            F.lit(S.DEVICE_TYPE).alias("device_type_concept_id"),
            links.reason(begin.cast("date"), "device_exposure_start_date", "Device", label).alias("review_reason"),
        )

    fitted = branch(
        "devices", devices, F.coalesce("START", "STOP"), F.col("STOP"),
        F.nullif(X.cut("UDI", 255), F.lit("")), F.lit(1), "Device code",
    )
    issued = branch(
        "supplies", supplies, F.col("DATE"), _no("timestamp_ntz"),
        _no("string"), X.safe_int("QUANTITY"), "Supply code",
    )
    return fitted.unionByName(issued)


# --- orders of the surrogate ids and the final columns ----------------------------

FACT_ORDER = {
    "condition_occurrence": ["person_id", "condition_start_datetime", "source_table", "condition_source_value"],
    "procedure_occurrence": ["person_id", "procedure_datetime", "source_table", "procedure_source_value"],
    "drug_exposure": ["person_id", "drug_exposure_start_datetime", "source_table", "drug_source_value"],
    "measurement": ["person_id", "measurement_datetime", "measurement_source_value"],
    "observation": ["person_id", "observation_datetime", "source_table", "observation_source_value"],
    "device_exposure": ["person_id", "device_exposure_start_datetime", "source_table", "device_source_value"],
    "payer_plan_period": ["person_id", "payer_plan_period_start_date", "payer_source_value", "plan_source_value"],
}


def loaded_rows(stage: DataFrame, table: str) -> DataFrame:
    """The rows without a review reason, in the target's columns."""
    valid = stage.where(F.col("review_reason").isNull())
    for column in ("unit_concept_id", "unit_source_concept_id"):
        if column in stage.columns:
            valid = valid.withColumn(column, X.null_if_unmatched(F.col(column)))
    return valid.select(*S.TARGETS[table].fieldNames())
