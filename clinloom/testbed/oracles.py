"""The same results in plain DuckDB SQL, written apart from the Spark plans."""

from __future__ import annotations

import re

from clinloom.testbed.adapters import ADAPTERS, AS_OF, duckdb_sql

TODAY = f"DATE '{AS_OF}'"


def norm(x: str) -> str:
    return f"trim({x})"


def clip(x: str, n: int) -> str:
    return f"left(nullif({norm(x)}, ''), {n})"


def key(x: str) -> str:
    return f"trim({x})"


def dbl(x: str) -> str:
    pattern = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    return f"CASE WHEN regexp_full_match(trim({x}), '{pattern}') THEN try_cast(trim({x}) AS DOUBLE) END"


def int_(x: str) -> str:
    return f"CASE WHEN regexp_full_match(trim({x}), '[+-]?[0-9]+') THEN try_cast(trim({x}) AS INTEGER) END"


def iso(x: str) -> str:
    return (
        f"strftime({x}, '%Y-%m-%dT%H:%M:%S') || "
        f"CASE WHEN strftime({x}, '%f') = '000000' THEN '' ELSE '.' || strftime({x}, '%f') || '0' END"
    )


def row_id(table: str, *parts: str) -> str:
    return "'synthea:" + table + "' || " + " || ".join(f"':' || {p}" for p in parts)


def fact_id(table: str, when: str | None) -> str:
    parts = ["f.\"PATIENT\"", "f.\"ENCOUNTER\"", when, "f.\"CODE\""]
    return row_id(table, *(p for p in parts if p))


def gender(x: str) -> str:
    return f"CASE upper({norm(x)}) WHEN 'M' THEN 8507 WHEN 'MALE' THEN 8507 WHEN 'F' THEN 8532 WHEN 'FEMALE' THEN 8532 ELSE 8551 END"


def race(x: str) -> str:
    return (
        f"CASE lower({norm(x)}) WHEN 'white' THEN 8527 WHEN 'black' THEN 8516 WHEN 'asian' THEN 8515 "
        f"WHEN 'native' THEN 8657 WHEN 'hawaiian' THEN 8557 WHEN 'other' THEN 8522 ELSE 8552 END"
    )


def ethnicity(x: str) -> str:
    return f"CASE lower({norm(x)}) WHEN 'hispanic' THEN 38003563 WHEN 'nonhispanic' THEN 38003564 ELSE 0 END"


def visit_class(x: str) -> str:
    return (
        f"CASE WHEN lower({norm(x)}) = 'inpatient' THEN 9201 WHEN lower({norm(x)}) = 'emergency' THEN 9203 "
        f"WHEN lower({norm(x)}) IN ('outpatient', 'ambulatory', 'urgentcare', 'wellness') THEN 9202 ELSE 0 END"
    )


def date_rules(event: str, birth: str, field: str) -> str:
    return (
        f"WHEN {event} IS NULL THEN '{field} must not be null.' "
        f"WHEN {event} < {birth} THEN '{field} occurs before birth date.' "
        f"WHEN {event} > {TODAY} THEN '{field} is in the future.' "
    )


def concept_rules(concept: str, domain: str, expected: str, label: str) -> str:
    return (
        f"WHEN coalesce({concept}, 0) = 0 THEN '{label} could not be mapped to a standard {expected} concept.' "
        f"WHEN nullif({domain}, '') IS NOT NULL AND {domain} <> '{expected}' "
        f"THEN '{label} mapped to the wrong OMOP domain for {expected}.' "
    )


def reason(event: str, field: str, expected: str, label: str, alias: str = "c") -> str:
    return (
        f"CASE {date_rules(event, 'p.birth_date', field)}"
        f"{concept_rules(f'{alias}.standard_concept_id', f'{alias}.standard_domain_id', expected, label)} END"
    )


def number(id_column: str, cte: str, order: list[str], columns: list[str]) -> str:
    keys = ", ".join(f"{c} NULLS FIRST" for c in [*order, *(c for c in columns if c not in order)])
    return f"SELECT row_number() OVER (ORDER BY {keys}) AS {id_column}, * FROM {cte}"


PERSON = 'JOIN o_pm p ON p.source_id = f."PATIENT"'
VISIT = 'LEFT JOIN o_vm v ON v.encounter_source_id = f."ENCOUNTER"'


def concept_join(vocabulary: str, code: str, alias: str = "c") -> str:
    return f"LEFT JOIN o_cm {alias} ON {alias}.vocabulary_id = '{vocabulary}' AND {alias}.code = {key(code)}"


def concepts(prefix: str, code: str, alias: str = "c") -> str:
    return (
        f"left({code}, 50) AS {prefix}_source_value, coalesce({alias}.source_concept_id, 0) AS {prefix}_source_concept_id, "
        f"coalesce({alias}.standard_concept_id, 0) AS {prefix}_concept_id"
    )


def filled(code: str) -> str:
    return f"coalesce({key(code)}, '') <> ''"


CODES = [
    ("conditions", "CODE", "SNOMED"), ("procedures", "CODE", "SNOMED"), ("devices", "CODE", "SNOMED"),
    ("supplies", "CODE", "SNOMED"), ("careplans", "CODE", "SNOMED"), ("imaging_studies", "PROCEDURE_CODE", "SNOMED"),
    ("allergies", "CODE", "SNOMED"), *(("claims", f"DIAGNOSIS{n}", "SNOMED") for n in range(1, 9)),
    ("medications", "CODE", "RxNorm"), ("observations", "CODE", "LOINC"), ("observations", "UNITS", "UCUM"),
    ("immunizations", "CODE", "CVX"),
]

STAGE_COLUMNS = {
    "condition": "person_id condition_start_datetime source_table condition_source_value condition_source_concept_id condition_concept_id source_row_id condition_start_date condition_end_date condition_end_datetime provider_id visit_occurrence_id condition_type_concept_id review_reason",
    "procedure": "person_id procedure_datetime source_table procedure_source_value procedure_source_concept_id procedure_concept_id source_row_id procedure_date procedure_end_date procedure_end_datetime provider_id visit_occurrence_id procedure_type_concept_id modifier_source_value raw_total_cost review_reason",
    "drug": "person_id drug_exposure_start_datetime source_table drug_source_value drug_source_concept_id drug_concept_id source_row_id drug_exposure_start_date drug_exposure_end_date drug_exposure_end_datetime provider_id visit_occurrence_id drug_type_concept_id refills quantity days_supply raw_total_cost raw_paid_by_payer review_reason",
    "measurement": "person_id measurement_datetime measurement_source_value measurement_source_concept_id measurement_concept_id source_row_id measurement_date measurement_time provider_id visit_occurrence_id value_as_number unit_concept_id unit_source_concept_id unit_source_value value_source_value measurement_type_concept_id review_reason",
    "observation": "person_id observation_datetime source_table observation_source_value observation_source_concept_id observation_concept_id source_row_id observation_date provider_id visit_occurrence_id value_as_number value_as_string unit_concept_id unit_source_value value_source_value qualifier_source_value observation_type_concept_id review_reason",
    "device": "person_id device_exposure_start_datetime source_table device_source_value device_source_concept_id device_concept_id source_row_id device_exposure_start_date device_exposure_end_date device_exposure_end_datetime provider_id visit_occurrence_id unique_device_id quantity device_type_concept_id review_reason",
    "payer": "person_id payer_plan_period_start_date payer_source_value plan_source_value source_row_id payer_plan_period_end_date payer_concept_id sponsor_source_value family_source_value stop_reason_source_value review_reason",
    "cost": "cost_event_id cost_domain_id cost_type_concept_id total_charge total_cost total_paid paid_by_payer paid_by_patient",
}
STAGE_COLUMNS = {name: columns.split() for name, columns in STAGE_COLUMNS.items()}


def _address(kind: str, county: str) -> str:
    return f"""'{kind.lower()}' AS source_kind, "Id" AS source_id, left('{kind}:' || "Id", 50) AS location_source_value,
  {clip('"ADDRESS"', 50)} AS address_1, {clip('"CITY"', 50)} AS city, {clip('"STATE"', 2)} AS state, {clip('"ZIP"', 9)} AS zip,
  {county} AS county, 'US' AS country_source_value, {dbl('"LAT"')} AS latitude, {dbl('"LON"')} AS longitude"""


def _routing() -> str:
    return (
        "nullif(c.standard_domain_id, '') = 'Measurement' OR (nullif(c.standard_domain_id, '') IS NULL "
        f"AND upper(nullif({norm('f.\"TYPE\"')}, '')) = 'NUMERIC')"
    )


_OBSERVATION_FROM = f"""FROM src_observations f {PERSON} {VISIT} {concept_join('LOINC', 'f."CODE"')}
{concept_join('UCUM', 'f."UNITS"', 'u')} WHERE f."DATE" IS NOT NULL AND {filled('f."CODE"')}"""

_DAY = 'CAST(coalesce(f."START", f."STOP") AS DATE)'

DERIVED: dict[str, str] = {
    "o_keys": "SELECT DISTINCT vocabulary_id, code FROM (" + " UNION ALL ".join(
        f"SELECT '{v}' AS vocabulary_id, {key(f'\"{c}\"')} AS code FROM src_{t}" for t, c, v in CODES
    ) + ") WHERE code <> ''",
    "o_source_match": """SELECT * FROM (SELECT k.vocabulary_id, k.code, c.concept_id, c.standard_concept, c.domain_id,
  row_number() OVER (PARTITION BY k.vocabulary_id, k.code ORDER BY CASE WHEN c.standard_concept = 'S' THEN 0 ELSE 1 END, c.concept_id) AS n
  FROM o_keys k LEFT JOIN src_concept c ON c.vocabulary_id = k.vocabulary_id AND c.concept_code = k.code AND c.invalid_reason IS NULL) WHERE n = 1""",
    "o_maps_to": """SELECT * FROM (SELECT r.concept_id_1, t.concept_id, t.domain_id, t.standard_concept,
  row_number() OVER (PARTITION BY r.concept_id_1 ORDER BY CASE WHEN t.standard_concept = 'S' THEN 0 ELSE 1 END, t.concept_id) AS n
  FROM src_concept_relationship r JOIN src_concept t ON t.concept_id = r.concept_id_2 AND t.invalid_reason IS NULL
  WHERE r.relationship_id = 'Maps to' AND r.invalid_reason IS NULL) WHERE n = 1""",
    "o_cm": """SELECT s.vocabulary_id, s.code, coalesce(s.concept_id, 0) AS source_concept_id,
  CASE WHEN s.standard_concept = 'S' THEN s.concept_id ELSE coalesce(m.concept_id, 0) END AS standard_concept_id,
  CASE WHEN s.standard_concept = 'S' THEN s.domain_id ELSE coalesce(m.domain_id, '') END AS standard_domain_id
  FROM o_source_match s LEFT JOIN o_maps_to m ON m.concept_id_1 = s.concept_id""",
    "o_loc": f"""SELECT row_number() OVER (ORDER BY source_kind, source_id) AS location_id, * FROM (
  SELECT {_address('PATIENT', clip('"COUNTY"', 20))} FROM src_patients
  UNION ALL SELECT {_address('ORGANIZATION', 'NULL')} FROM src_organizations)""",
    "o_pm": """SELECT row_number() OVER (ORDER BY s."Id") AS person_id, s."Id" AS source_id, l.location_id, s."BIRTHDATE" AS birth_date
  FROM src_patients s LEFT JOIN o_loc l ON l.source_kind = 'patient' AND l.source_id = s."Id" """,
    "o_csm": """SELECT row_number() OVER (ORDER BY s."Id") AS care_site_id, s."Id" AS source_id, l.location_id
  FROM src_organizations s LEFT JOIN o_loc l ON l.source_kind = 'organization' AND l.source_id = s."Id" """,
    "o_prm": """SELECT row_number() OVER (ORDER BY s."Id") AS provider_id, s."Id" AS source_id, c.care_site_id
  FROM src_providers s LEFT JOIN o_csm c ON c.source_id = s."ORGANIZATION" """,
    "o_death": f"""SELECT {row_id('patients', 's."Id"', "'death'")} AS source_row_id, p.person_id, s."DEATHDATE" AS death_date,
  CAST(s."DEATHDATE" AS TIMESTAMP) AS death_datetime, CASE {date_rules('s."DEATHDATE"', 'p.birth_date', 'death_date')} END AS review_reason
  FROM src_patients s JOIN o_pm p ON p.source_id = s."Id" WHERE s."DEATHDATE" IS NOT NULL""",
    "o_visit_stage": f"""SELECT {row_id('encounters', 'f."Id"')} AS source_row_id, f."Id" AS encounter_source_id, p.person_id,
  pr.provider_id, cs.care_site_id, {_DAY} AS visit_start_date, coalesce(f."START", f."STOP") AS visit_start_datetime,
  CAST(coalesce(f."STOP", f."START") AS DATE) AS visit_end_date, coalesce(f."STOP", f."START") AS visit_end_datetime,
  {visit_class('f."ENCOUNTERCLASS"')} AS visit_concept_id, {clip('f."ENCOUNTERCLASS"', 50)} AS visit_source_value,
  f."TOTAL_CLAIM_COST" AS claim, f."BASE_ENCOUNTER_COST" AS base, f."PAYER_COVERAGE" AS coverage,
  CASE {date_rules(_DAY, 'p.birth_date', 'visit_start_date')}
    WHEN {visit_class('f."ENCOUNTERCLASS"')} = 0 THEN 'Encounter class could not be mapped to a standard Visit concept.' END AS review_reason
  FROM src_encounters f {PERSON} LEFT JOIN o_prm pr ON pr.source_id = f."PROVIDER" LEFT JOIN o_csm cs ON cs.source_id = f."ORGANIZATION" """,
    "o_vm": """SELECT *, lag(visit_occurrence_id) OVER (PARTITION BY person_id ORDER BY visit_start_datetime, encounter_source_id) AS preceding_visit_occurrence_id
  FROM (SELECT row_number() OVER (ORDER BY person_id, visit_start_datetime, encounter_source_id) AS visit_occurrence_id, *
        FROM o_visit_stage WHERE review_reason IS NULL)""",
    "o_slots": "\nUNION ALL ".join(
        f"SELECT \"Id\", \"PATIENTID\", \"PROVIDERID\", \"APPOINTMENTID\", \"SERVICEDATE\", '{n}' AS slot_number, \"DIAGNOSIS{n}\" AS code FROM src_claims"
        for n in range(1, 9)
    ),
    "o_condition_rows": f"""SELECT p.person_id, coalesce(CAST(f."START" AS TIMESTAMP), v.visit_start_datetime) AS condition_start_datetime,
  'conditions' AS source_table, {concepts('condition', 'f."CODE"')},
  {fact_id('conditions', "strftime(f.\"START\", '%Y-%m-%d')")} AS source_row_id,
  coalesce(f."START", v.visit_start_date) AS condition_start_date, f."STOP" AS condition_end_date, CAST(f."STOP" AS TIMESTAMP) AS condition_end_datetime,
  v.provider_id, v.visit_occurrence_id, 32020 AS condition_type_concept_id,
  {reason('coalesce(f."START", v.visit_start_date)', 'condition_start_date', 'Condition', 'Condition code')} AS review_reason
  FROM src_conditions f {PERSON} {VISIT} {concept_join('SNOMED', 'f."CODE"')}
  WHERE coalesce(f."START", v.visit_start_date) IS NOT NULL AND {filled('f."CODE"')}
  UNION ALL
  SELECT p.person_id, f."SERVICEDATE", 'claims', {concepts('condition', 'f.code')},
  {row_id('claims', 'f."Id"', "'dx' || f.slot_number")}, CAST(f."SERVICEDATE" AS DATE), NULL, NULL,
  coalesce(v.provider_id, pr.provider_id), v.visit_occurrence_id, 32810,
  {reason('CAST(f."SERVICEDATE" AS DATE)', 'condition_start_date', 'Condition', 'Claim diagnosis code')}
  FROM o_slots f JOIN o_pm p ON p.source_id = f."PATIENTID" LEFT JOIN o_prm pr ON pr.source_id = f."PROVIDERID"
  LEFT JOIN o_vm v ON v.encounter_source_id = f."APPOINTMENTID" {concept_join('SNOMED', 'f.code')}
  WHERE f."SERVICEDATE" IS NOT NULL AND {filled('f.code')}""",
    "o_condition": number("condition_occurrence_id", "o_condition_rows",
        ["person_id", "condition_start_datetime", "source_table", "condition_source_value", "source_row_id"], STAGE_COLUMNS["condition"]),
    "o_procedure_rows": f"""SELECT p.person_id, coalesce(f."START", v.visit_start_datetime) AS procedure_datetime, 'procedures' AS source_table,
  {concepts('procedure', 'f."CODE"')}, {fact_id('procedures', iso('f."START"'))} AS source_row_id,
  coalesce(CAST(f."START" AS DATE), v.visit_start_date) AS procedure_date, CAST(f."STOP" AS DATE) AS procedure_end_date,
  f."STOP" AS procedure_end_datetime, v.provider_id, v.visit_occurrence_id, 32827 AS procedure_type_concept_id,
  CAST(NULL AS VARCHAR) AS modifier_source_value, {dbl('f."BASE_COST"')} AS raw_total_cost,
  {reason('coalesce(CAST(f."START" AS DATE), v.visit_start_date)', 'procedure_date', 'Procedure', 'Procedure code')} AS review_reason
  FROM src_procedures f {PERSON} {VISIT} {concept_join('SNOMED', 'f."CODE"')}
  WHERE (f."START" IS NOT NULL OR v.visit_start_date IS NOT NULL) AND {filled('f."CODE"')}
  UNION ALL
  SELECT p.person_id, CAST(coalesce(f."START", v.visit_start_date) AS TIMESTAMP), 'careplans', {concepts('procedure', 'f."CODE"')},
  {row_id('careplans', 'f."Id"')}, coalesce(f."START", v.visit_start_date), f."STOP", CAST(f."STOP" AS TIMESTAMP),
  v.provider_id, v.visit_occurrence_id, 32827, NULL, NULL,
  {reason('coalesce(f."START", v.visit_start_date)', 'procedure_date', 'Procedure', 'Care plan code')}
  FROM src_careplans f {PERSON} {VISIT} {concept_join('SNOMED', 'f."CODE"')}
  WHERE coalesce(f."START", v.visit_start_date) IS NOT NULL AND {filled('f."CODE"')}
  UNION ALL
  SELECT p.person_id, f."DATE", 'imaging_studies', {concepts('procedure', 'f."PROCEDURE_CODE"')},
  {row_id('imaging', 'f."Id"')}, CAST(f."DATE" AS DATE), NULL, NULL, v.provider_id, v.visit_occurrence_id, 32841,
  {clip('f."MODALITY_CODE"', 50)}, NULL,
  {reason('CAST(f."DATE" AS DATE)', 'procedure_date', 'Procedure', 'Imaging procedure code')}
  FROM src_imaging_studies f {PERSON} {VISIT} {concept_join('SNOMED', 'f."PROCEDURE_CODE"')}
  WHERE f."DATE" IS NOT NULL AND {filled('f."PROCEDURE_CODE"')}""",
    "o_procedure": number("procedure_occurrence_id", "o_procedure_rows",
        ["person_id", "procedure_datetime", "source_table", "procedure_source_value", "source_row_id"], STAGE_COLUMNS["procedure"]),
    "o_drug_rows": f"""SELECT p.person_id, coalesce(f."START", f."STOP") AS drug_exposure_start_datetime, 'medications' AS source_table,
  {concepts('drug', 'f."CODE"')}, {fact_id('medications', iso('f."START"'))} AS source_row_id,
  {_DAY} AS drug_exposure_start_date, CAST(coalesce(f."STOP", f."START") AS DATE) AS drug_exposure_end_date,
  coalesce(f."STOP", f."START") AS drug_exposure_end_datetime, v.provider_id, v.visit_occurrence_id, 32825 AS drug_type_concept_id,
  CASE WHEN {int_('f."DISPENSES"')} <= 1 THEN 0 ELSE {int_('f."DISPENSES"')} - 1 END AS refills, {dbl('f."DISPENSES"')} AS quantity,
  CASE WHEN CAST(coalesce(f."STOP", f."START") AS DATE) - {_DAY} <= 0 THEN 1 ELSE CAST(coalesce(f."STOP", f."START") AS DATE) - {_DAY} END AS days_supply,
  {dbl('f."TOTALCOST"')} AS raw_total_cost, {dbl('f."PAYER_COVERAGE"')} AS raw_paid_by_payer,
  {reason(_DAY, 'drug_exposure_start_date', 'Drug', 'Medication code')} AS review_reason
  FROM src_medications f {PERSON} {VISIT} {concept_join('RxNorm', 'f."CODE"')}
  WHERE coalesce(f."START", f."STOP") IS NOT NULL AND {filled('f."CODE"')}
  UNION ALL
  SELECT p.person_id, f."DATE", 'immunizations', {concepts('drug', 'f."CODE"')}, {fact_id('immunizations', iso('f."DATE"'))},
  CAST(f."DATE" AS DATE), CAST(f."DATE" AS DATE), f."DATE", v.provider_id, v.visit_occurrence_id, 32818, 0, 1.0, 1,
  {dbl('f."BASE_COST"')}, NULL, {reason('CAST(f."DATE" AS DATE)', 'drug_exposure_start_date', 'Drug', 'Immunization code')}
  FROM src_immunizations f {PERSON} {VISIT} {concept_join('CVX', 'f."CODE"')} WHERE f."DATE" IS NOT NULL AND {filled('f."CODE"')}""",
    "o_drug": number("drug_exposure_id", "o_drug_rows",
        ["person_id", "drug_exposure_start_datetime", "source_table", "drug_source_value", "source_row_id"], STAGE_COLUMNS["drug"]),
    "o_measurement_rows": f"""SELECT p.person_id, f."DATE" AS measurement_datetime, {concepts('measurement', 'f."CODE"')},
  {fact_id('observations', iso('f."DATE"'))} AS source_row_id, CAST(f."DATE" AS DATE) AS measurement_date,
  strftime(f."DATE", '%H:%M:%S') AS measurement_time, v.provider_id, v.visit_occurrence_id, {dbl('f."VALUE"')} AS value_as_number,
  coalesce(u.standard_concept_id, 0) AS unit_concept_id, coalesce(u.source_concept_id, 0) AS unit_source_concept_id,
  {clip('f."UNITS"', 50)} AS unit_source_value, {clip('f."VALUE"', 50)} AS value_source_value, 44818702 AS measurement_type_concept_id,
  {reason('CAST(f."DATE" AS DATE)', 'measurement_date', 'Measurement', 'Observation code')} AS review_reason
  {_OBSERVATION_FROM} AND ({_routing()})""",
    "o_measurement": number("measurement_id", "o_measurement_rows",
        ["person_id", "measurement_datetime", "measurement_source_value", "source_row_id"], STAGE_COLUMNS["measurement"]),
    "o_observation_rows": f"""SELECT p.person_id, f."DATE" AS observation_datetime, 'observations' AS source_table, {concepts('observation', 'f."CODE"')},
  {fact_id('observations', iso('f."DATE"'))} AS source_row_id, CAST(f."DATE" AS DATE) AS observation_date, v.provider_id, v.visit_occurrence_id,
  {dbl('f."VALUE"')} AS value_as_number, nullif(left(f."VALUE", 60), '') AS value_as_string, coalesce(u.standard_concept_id, 0) AS unit_concept_id,
  {clip('f."UNITS"', 50)} AS unit_source_value, {clip('f."VALUE"', 50)} AS value_source_value, {clip('f."CATEGORY"', 50)} AS qualifier_source_value,
  38000280 AS observation_type_concept_id, {reason('CAST(f."DATE" AS DATE)', 'observation_date', 'Observation', 'Observation code')} AS review_reason
  {_OBSERVATION_FROM} AND NOT ({_routing()})
  UNION ALL
  SELECT p.person_id, CAST(f."START" AS TIMESTAMP), 'allergies', {concepts('observation', 'f."CODE"')}, {fact_id('allergies', None)}, f."START",
  v.provider_id, v.visit_occurrence_id, NULL, nullif(left(f."DESCRIPTION", 60), ''), NULL, NULL, {clip('f."DESCRIPTION"', 50)},
  left(coalesce(nullif({norm('f."TYPE"')}, ''), nullif({norm('f."CATEGORY"')}, '')), 50), 38000280,
  {reason('f."START"', 'observation_date', 'Observation', 'Allergy code')}
  FROM src_allergies f {PERSON} {VISIT} {concept_join('SNOMED', 'f."CODE"')} WHERE f."START" IS NOT NULL AND {filled('f."CODE"')}""",
    "o_observation": number("observation_id", "o_observation_rows",
        ["person_id", "observation_datetime", "source_table", "observation_source_value", "source_row_id"], STAGE_COLUMNS["observation"]),
    "o_device_rows": f"""SELECT p.person_id, coalesce(f."START", f."STOP") AS device_exposure_start_datetime, 'devices' AS source_table,
  {concepts('device', 'f."CODE"')}, {fact_id('devices', None)} AS source_row_id, {_DAY} AS device_exposure_start_date,
  CAST(f."STOP" AS DATE) AS device_exposure_end_date, f."STOP" AS device_exposure_end_datetime, v.provider_id, v.visit_occurrence_id,
  nullif(left(f."UDI", 255), '') AS unique_device_id, 1 AS quantity, 32818 AS device_type_concept_id,
  {reason(_DAY, 'device_exposure_start_date', 'Device', 'Device code')} AS review_reason
  FROM src_devices f {PERSON} {VISIT} {concept_join('SNOMED', 'f."CODE"')}
  WHERE coalesce(f."START", f."STOP") IS NOT NULL AND {filled('f."CODE"')}
  UNION ALL
  SELECT p.person_id, CAST(f."DATE" AS TIMESTAMP), 'supplies', {concepts('device', 'f."CODE"')}, {fact_id('supplies', None)}, f."DATE", NULL, NULL,
  v.provider_id, v.visit_occurrence_id, NULL, {int_('f."QUANTITY"')}, 32818,
  {reason('f."DATE"', 'device_exposure_start_date', 'Device', 'Supply code')}
  FROM src_supplies f {PERSON} {VISIT} {concept_join('SNOMED', 'f."CODE"')} WHERE f."DATE" IS NOT NULL AND {filled('f."CODE"')}""",
    "o_device": number("device_exposure_id", "o_device_rows",
        ["person_id", "device_exposure_start_datetime", "source_table", "device_source_value", "source_row_id"], STAGE_COLUMNS["device"]),
    "o_payer_map": f"""SELECT s."Id" AS payer_source_id, {clip('s."NAME"', 50)} AS payer_name, coalesce(min(c.concept_id), 0) AS payer_concept_id
  FROM src_payers s LEFT JOIN src_concept c ON c.vocabulary_id = 'Payer' AND c.invalid_reason IS NULL AND c.concept_name = s."NAME"
  GROUP BY s."Id", s."NAME" """,
    "o_payer_rows": f"""SELECT p.person_id, CAST(f."START_YEAR" AS DATE) AS payer_plan_period_start_date,
  coalesce(m.payer_name, left(f."PAYER", 50)) AS payer_source_value, left(f."MEMBERID", 50) AS plan_source_value,
  {row_id('payer_transitions', 'f."PATIENT"', "strftime(f.\"START_YEAR\", '%Y-%m-%d %H:%M:%S.%f') || '0'", 'f."PAYER"')} AS source_row_id,
  CAST(coalesce(f."END_YEAR", f."START_YEAR") AS DATE) AS payer_plan_period_end_date, coalesce(m.payer_concept_id, 0) AS payer_concept_id,
  {clip('f."OWNERSHIP"', 50)} AS sponsor_source_value, {clip('f."OWNERNAME"', 50)} AS family_source_value,
  {clip('f."SECONDARY_PAYER"', 50)} AS stop_reason_source_value,
  CASE {date_rules('CAST(f."START_YEAR" AS DATE)', 'p.birth_date', 'payer_plan_period_start_date')}
    WHEN coalesce(m.payer_concept_id, 0) = 0 THEN 'Payer could not be mapped to a standard Payer concept.'
    WHEN CAST(coalesce(f."END_YEAR", f."START_YEAR") AS DATE) < CAST(f."START_YEAR" AS DATE)
      THEN 'payer_plan_period_end_date occurs before payer_plan_period_start_date.' END AS review_reason
  FROM src_payer_transitions f {PERSON} LEFT JOIN o_payer_map m ON m.payer_source_id = f."PAYER" WHERE f."START_YEAR" IS NOT NULL""",
    "o_payer": number("payer_plan_period_id", "o_payer_rows",
        ["person_id", "payer_plan_period_start_date", "payer_source_value", "plan_source_value", "source_row_id"], STAGE_COLUMNS["payer"]),
    "o_cost_rows": f"""SELECT * FROM (
  SELECT visit_occurrence_id AS cost_event_id, 'Visit' AS cost_domain_id, 32814 AS cost_type_concept_id, {dbl('claim')} AS total_charge,
    {dbl('base')} AS total_cost, CAST(NULL AS DOUBLE) AS total_paid, {dbl('coverage')} AS paid_by_payer,
    CASE WHEN {dbl('coverage')} IS NULL THEN {dbl('claim')} ELSE {dbl('claim')} - {dbl('coverage')} END AS paid_by_patient FROM o_vm
  UNION ALL SELECT procedure_occurrence_id, 'Procedure', 32814, raw_total_cost, raw_total_cost, NULL, NULL, raw_total_cost
    FROM o_procedure WHERE source_table = 'procedures' AND raw_total_cost IS NOT NULL AND review_reason IS NULL
  UNION ALL SELECT drug_exposure_id, 'Drug', 32814, raw_total_cost, raw_total_cost, NULL, raw_paid_by_payer,
    CASE WHEN raw_paid_by_payer IS NULL THEN raw_total_cost ELSE raw_total_cost - raw_paid_by_payer END
    FROM o_drug WHERE raw_total_cost IS NOT NULL AND review_reason IS NULL
  UNION ALL SELECT v.visit_occurrence_id, 'Visit', 32810, {dbl('f."AMOUNT"')}, {dbl('f."AMOUNT"')}, {dbl('f."PAYMENTS"')}, NULL, {dbl('f."OUTSTANDING"')}
    FROM src_claims_transactions f JOIN o_vm v ON v.encounter_source_id = f."APPOINTMENTID")
  WHERE total_charge IS NOT NULL OR total_cost IS NOT NULL OR total_paid IS NOT NULL OR paid_by_payer IS NOT NULL OR paid_by_patient IS NOT NULL""",
    "o_cost": number("cost_id", "o_cost_rows", ["cost_domain_id", "cost_event_id"], STAGE_COLUMNS["cost"]),
    "o_held_visits": """SELECT row_number() OVER (ORDER BY review_reason IS NOT NULL, person_id, visit_start_datetime NULLS FIRST, encounter_source_id) AS n, *
  FROM o_visit_stage""",
}


def _held(table: str, stage: str, cte: str, number_column: str | None) -> str:
    own = "source_row_id" if number_column is None else f"coalesce(source_row_id, 'synthea:review:{table}:' || {number_column})"
    return f"""SELECT '{table}' AS target_table, {own} AS source_row_id, 'review' AS review_status, review_reason,
  '{{"stage_table":"{stage}","source_row_id":' || to_json({own}) || '}}' AS payload_json FROM {cte} WHERE review_reason IS NOT NULL"""


DERIVED["o_review"] = "\nUNION ALL ".join(
    _held(*entry)
    for entry in (
        ("death", "#death_stage", "o_death", None),
        ("visit_occurrence", "#visit_stage", "o_held_visits", "n"),
        ("condition_occurrence", "#condition_stage", "o_condition", "condition_occurrence_id"),
        ("procedure_occurrence", "#procedure_stage", "o_procedure", "procedure_occurrence_id"),
        ("drug_exposure", "#drug_stage", "o_drug", "drug_exposure_id"),
        ("measurement", "#measurement_stage", "o_measurement", "measurement_id"),
        ("observation", "#observation_stage", "o_observation", "observation_id"),
        ("device_exposure", "#device_stage", "o_device", "device_exposure_id"),
        ("payer_plan_period", "#payer_plan_stage", "o_payer", "payer_plan_period_id"),
    )
)

_GENDER, _RACE, _ETHNICITY = gender('s."GENDER"'), race('s."RACE"'), ethnicity('s."ETHNICITY"')

# the target tables, in target column order; dates as text
TABLES: dict[str, str] = {
    "location": "SELECT location_id, address_1, city, state, zip, county, location_source_value, country_source_value, latitude, longitude FROM o_loc",
    "person": f"""SELECT p.person_id, {_GENDER} AS gender_concept_id, coalesce(year(s."BIRTHDATE"), 1900) AS year_of_birth,
  month(s."BIRTHDATE") AS month_of_birth, day(s."BIRTHDATE") AS day_of_birth, CAST(s."BIRTHDATE" AS TIMESTAMP) AS birth_datetime,
  {_RACE} AS race_concept_id, {_ETHNICITY} AS ethnicity_concept_id, p.location_id, left(s."Id", 50) AS person_source_value,
  {clip('s."GENDER"', 50)} AS gender_source_value, {_GENDER} AS gender_source_concept_id, {clip('s."RACE"', 50)} AS race_source_value,
  {_RACE} AS race_source_concept_id, {clip('s."ETHNICITY"', 50)} AS ethnicity_source_value, {_ETHNICITY} AS ethnicity_source_concept_id
  FROM src_patients s JOIN o_pm p ON p.source_id = s."Id" """,
    "death": """SELECT person_id, CAST(death_date AS VARCHAR) AS death_date, death_datetime, 32510 AS death_type_concept_id, 0 AS cause_concept_id
  FROM o_death WHERE review_reason IS NULL""",
    "care_site": f"""SELECT m.care_site_id, {clip('s."NAME"', 255)} AS care_site_name, m.location_id, left(s."Id", 50) AS care_site_source_value
  FROM src_organizations s JOIN o_csm m ON m.source_id = s."Id" """,
    "provider": f"""SELECT m.provider_id, {clip('s."NAME"', 255)} AS provider_name, m.care_site_id, {_GENDER} AS gender_concept_id,
  left(s."Id", 50) AS provider_source_value, {clip('s."SPECIALITY"', 50)} AS specialty_source_value,
  {clip('s."GENDER"', 50)} AS gender_source_value, {_GENDER} AS gender_source_concept_id
  FROM src_providers s JOIN o_prm m ON m.source_id = s."Id" """,
    "visit_occurrence": """SELECT visit_occurrence_id, person_id, visit_concept_id, CAST(visit_start_date AS VARCHAR) AS visit_start_date, visit_start_datetime,
  CAST(visit_end_date AS VARCHAR) AS visit_end_date, visit_end_datetime, 44818518 AS visit_type_concept_id, provider_id, care_site_id, visit_source_value,
  preceding_visit_occurrence_id FROM o_vm""",
    "observation_period": """SELECT row_number() OVER (ORDER BY person_id) AS observation_period_id, person_id,
  CAST(min(visit_start_date) AS VARCHAR) AS observation_period_start_date, CAST(max(visit_end_date) AS VARCHAR) AS observation_period_end_date,
  32817 AS period_type_concept_id FROM o_vm GROUP BY person_id""",
    "condition_occurrence": """SELECT condition_occurrence_id, person_id, condition_concept_id, CAST(condition_start_date AS VARCHAR) AS condition_start_date,
  condition_start_datetime, CAST(condition_end_date AS VARCHAR) AS condition_end_date, condition_end_datetime, condition_type_concept_id, provider_id,
  visit_occurrence_id, condition_source_value, condition_source_concept_id FROM o_condition WHERE review_reason IS NULL""",
    "procedure_occurrence": """SELECT procedure_occurrence_id, person_id, procedure_concept_id, CAST(procedure_date AS VARCHAR) AS procedure_date, procedure_datetime,
  CAST(procedure_end_date AS VARCHAR) AS procedure_end_date, procedure_end_datetime, procedure_type_concept_id, provider_id, visit_occurrence_id,
  procedure_source_value, procedure_source_concept_id, modifier_source_value FROM o_procedure WHERE review_reason IS NULL""",
    "drug_exposure": """SELECT drug_exposure_id, person_id, drug_concept_id, CAST(drug_exposure_start_date AS VARCHAR) AS drug_exposure_start_date,
  drug_exposure_start_datetime, CAST(drug_exposure_end_date AS VARCHAR) AS drug_exposure_end_date, drug_exposure_end_datetime, drug_type_concept_id, refills,
  CAST(quantity AS DOUBLE) AS quantity, days_supply, provider_id, visit_occurrence_id, drug_source_value, drug_source_concept_id FROM o_drug WHERE review_reason IS NULL""",
    "measurement": """SELECT measurement_id, person_id, measurement_concept_id, CAST(measurement_date AS VARCHAR) AS measurement_date, measurement_datetime,
  measurement_time, measurement_type_concept_id, value_as_number, nullif(unit_concept_id, 0) AS unit_concept_id, provider_id, visit_occurrence_id,
  measurement_source_value, measurement_source_concept_id, unit_source_value, nullif(unit_source_concept_id, 0) AS unit_source_concept_id, value_source_value
  FROM o_measurement WHERE review_reason IS NULL""",
    "observation": """SELECT observation_id, person_id, observation_concept_id, CAST(observation_date AS VARCHAR) AS observation_date, observation_datetime,
  observation_type_concept_id, value_as_number, value_as_string, nullif(unit_concept_id, 0) AS unit_concept_id, provider_id, visit_occurrence_id,
  observation_source_value, observation_source_concept_id, unit_source_value, qualifier_source_value, value_source_value
  FROM o_observation WHERE review_reason IS NULL""",
    "device_exposure": """SELECT device_exposure_id, person_id, device_concept_id, CAST(device_exposure_start_date AS VARCHAR) AS device_exposure_start_date,
  device_exposure_start_datetime, CAST(device_exposure_end_date AS VARCHAR) AS device_exposure_end_date, device_exposure_end_datetime, device_type_concept_id,
  unique_device_id, quantity, provider_id, visit_occurrence_id, device_source_value, device_source_concept_id FROM o_device WHERE review_reason IS NULL""",
    "payer_plan_period": """SELECT payer_plan_period_id, person_id, CAST(payer_plan_period_start_date AS VARCHAR) AS payer_plan_period_start_date,
  CAST(payer_plan_period_end_date AS VARCHAR) AS payer_plan_period_end_date, payer_concept_id, payer_source_value, plan_source_value, sponsor_source_value,
  family_source_value, stop_reason_source_value FROM o_payer WHERE review_reason IS NULL""",
    "cost": "SELECT * FROM o_cost",
}


def with_ctes(final: str) -> str:
    """``final`` with the table expressions it names, directly or through others."""
    definitions = {
        **{name: duckdb_sql(name) for name in ADAPTERS},
        **DERIVED,
        **{f"t_{name}": sql for name, sql in TABLES.items()},
    }
    names = re.compile(r"\b(?:src|raw|o|t)_[a-z_]+\b")
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in dict.fromkeys(names.findall(sql)):
            if name in definitions and name not in ordered:
                visit(definitions[name])
                ordered.append(name)

    visit(final)
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({definitions[name]})" for name in ordered)
    return f"WITH {ctes}\n{final}" if ctes else final
