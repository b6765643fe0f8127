"""Clinical source tables derived from the given test tables.

Each statement reads whole tables and is written in the SQL that Spark and
DuckDB share, so both sides start from the same rows. Remainders only vary
values (blanks, unknown keys, bad numbers, early and late dates); no row is
left out.
"""

from __future__ import annotations

AS_OF = "2001-06-01"

_PATIENT_OF_ORDER = "CAST(CAST(FLOOR({key} / 10) AS BIGINT) AS STRING)"


def _patient(key: str, unknown: str) -> str:
    known = _PATIENT_OF_ORDER.format(key=key)
    return f"CASE WHEN {unknown} THEN 'U' || CAST({key} AS STRING) ELSE {known} END"


def _encounter(key: str, missing: str, unknown: str) -> str:
    return f"CASE WHEN {missing} THEN NULL WHEN {unknown} THEN 'E-none' ELSE 'E' || CAST({key} AS STRING) END"


def _code(key: str, blank: str, unknown: str) -> str:
    number = f"CAST(CAST(FLOOR({key} / 14) AS BIGINT) AS STRING)"
    return (
        f"CASE WHEN {blank} THEN '  ' WHEN {unknown} THEN 'X' || {number} "
        f"WHEN {key} % 5 = 0 THEN ' C' || {number} || ' ' ELSE 'C' || {number} END"
    )


_LINE_PATIENT = _patient("l_orderkey", "l_orderkey % 59 = 0")
_LINE_ENCOUNTER = _encounter("l_orderkey", "l_partkey % 47 = 0", "l_partkey % 43 = 0")
_LINE_CODE = _code("l_partkey", "l_suppkey % 29 = 0", "l_suppkey % 23 = 0")
_ORDER_PATIENT = "CASE WHEN o_orderkey % 53 = 0 THEN 'U' || CAST(o_orderkey AS STRING) ELSE CAST(o_custkey AS STRING) END"
_ORDER_ENCOUNTER = _encounter("o_orderkey", "o_orderkey % 47 = 0", "o_orderkey % 43 = 0")
_ORDER_CODE = _code("o_custkey", "o_orderkey % 31 = 0", "o_orderkey % 23 = 0")
_EVENT_PATIENT = "CASE WHEN event_id % 37 = 0 THEN 'U' || CAST(event_id AS STRING) ELSE CAST(user_id AS STRING) END"
_EVENT_ENCOUNTER = _encounter("event_id", "event_id % 41 = 0", "event_id % 43 = 0")
_EVENT_TIME = "CASE WHEN event_id % 67 = 0 THEN NULL ELSE ts - INTERVAL '8260' DAY END"

_DIAGNOSES = ",\n  ".join(
    f"CASE WHEN o_orderkey % {n + 2} = 1 THEN NULL WHEN o_orderkey % {n + 11} = 2 THEN '' "
    f"ELSE 'C' || CAST((o_custkey + {n * 3}) % 150 AS STRING) END AS `DIAGNOSIS{n}`"
    for n in range(1, 9)
)

ADAPTERS: dict[str, str] = {
    "src_patients": """
SELECT CAST(c_custkey AS STRING) AS `Id`,
  CASE WHEN c_custkey % 41 = 0 THEN NULL
       ELSE DATE '1930-01-01' + CAST((c_custkey * 7919) % 25000 AS INT) END AS `BIRTHDATE`,
  CASE WHEN c_custkey % 17 = 0 THEN DATE '1990-01-01' + CAST((c_custkey * 31) % 4500 AS INT)
       WHEN c_custkey % 97 = 1 THEN DATE '1929-06-01' END AS `DEATHDATE`,
  CASE c_nationkey % 7 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN ' male ' WHEN 3 THEN 'Female'
       WHEN 4 THEN '' WHEN 5 THEN NULL ELSE 'x' END AS `GENDER`,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'white' WHEN 'BUILDING' THEN 'Black ' WHEN 'AUTOMOBILE' THEN 'asian'
       WHEN 'FURNITURE' THEN CASE WHEN c_custkey % 2 = 0 THEN 'native' ELSE 'hawaiian' END
       ELSE CASE WHEN c_custkey % 3 = 0 THEN 'other' WHEN c_custkey % 3 = 1 THEN NULL ELSE 'unlisted' END END AS `RACE`,
  CASE c_custkey % 4 WHEN 0 THEN 'hispanic' WHEN 1 THEN 'NonHispanic' WHEN 2 THEN ' ' ELSE NULL END AS `ETHNICITY`,
  ' ' || CAST(c_custkey AS STRING) || ' ' || c_name || ' Street, at the corner of a rather long avenue ' AS `ADDRESS`,
  'City ' || CAST(c_nationkey AS STRING) AS `CITY`,
  CASE WHEN c_custkey % 6 = 0 THEN '' ELSE 'Massachusetts' END AS `STATE`,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'County of the nation ' || CAST(c_nationkey AS STRING) END AS `COUNTY`,
  '02139-4307-' || CAST(c_nationkey AS STRING) AS `ZIP`,
  CASE c_custkey % 9 WHEN 0 THEN 'north' WHEN 1 THEN '' WHEN 2 THEN 'NaN' WHEN 3 THEN '5d' WHEN 4 THEN NULL
       WHEN 5 THEN '4.25e1' ELSE CAST(c_acctbal AS STRING) END AS `LAT`,
  CAST(c_acctbal AS STRING) AS `LON`
FROM {customer}""",
    "src_organizations": """
SELECT 'O' || CAST(n_nationkey AS STRING) AS `Id`, ' ' || n_name || ' ' AS `NAME`,
  CASE WHEN n_nationkey % 4 = 0 THEN '  ' ELSE n_name || ' Road' END AS `ADDRESS`,
  'City ' || CAST(n_regionkey AS STRING) AS `CITY`, 'MA' AS `STATE`, '0213' || CAST(n_regionkey AS STRING) AS `ZIP`,
  CAST(n_nationkey AS STRING) AS `LAT`, '-71.' || CAST(n_nationkey AS STRING) AS `LON`
FROM {nation}""",
    "src_providers": """
SELECT CAST(s_suppkey AS STRING) AS `Id`,
  CASE WHEN s_suppkey % 10 = 9 THEN 'O-none' ELSE 'O' || CAST(s_nationkey AS STRING) END AS `ORGANIZATION`,
  s_name AS `NAME`, CASE s_suppkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' ELSE NULL END AS `GENDER`,
  CASE WHEN s_suppkey % 8 = 0 THEN ' ' ELSE 'Speciality ' || CAST(s_nationkey AS STRING) END AS `SPECIALITY`
FROM {supplier}""",
    "src_encounters": f"""
SELECT 'E' || CAST(o_orderkey AS STRING) AS `Id`,
  CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 24 AS INT) END AS `START`,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL
       ELSE o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 24 + o_custkey % 72 AS INT) END AS `STOP`,
  {_ORDER_PATIENT} AS `PATIENT`,
  CAST(o_custkey % 120 AS STRING) AS `PROVIDER`, 'O' || CAST(o_custkey % 30 AS STRING) AS `ORGANIZATION`,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'emergency' WHEN '2-HIGH' THEN ' Inpatient ' WHEN '3-MEDIUM' THEN 'ambulatory'
       WHEN '4-NOT SPECIFIED' THEN CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'wellness' END
       ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'snf' WHEN o_orderkey % 3 = 1 THEN 'outpatient' ELSE 'URGENTCARE' END
  END AS `ENCOUNTERCLASS`,
  CAST(o_custkey AS STRING) || '.5' AS `BASE_ENCOUNTER_COST`,
  CASE WHEN o_orderkey % 13 = 0 THEN 'unknown' ELSE CAST(o_totalprice AS STRING) END AS `TOTAL_CLAIM_COST`,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_custkey % 1000 AS STRING) END AS `PAYER_COVERAGE`
FROM {{orders}}""",
    "src_conditions": f"""
SELECT CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS `START`,
  CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) + CAST(l_quantity AS INT) END AS `STOP`,
  {_LINE_PATIENT} AS `PATIENT`, {_LINE_ENCOUNTER} AS `ENCOUNTER`, {_LINE_CODE} AS `CODE`,
  'Condition ' || l_returnflag AS `DESCRIPTION`
FROM {{lineitem}}""",
    "src_procedures": f"""
SELECT CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE l_shipdate + INTERVAL '1' MINUTE * CAST(l_quantity * 17 AS INT) END AS `START`,
  CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_shipdate + INTERVAL '1' MINUTE * CAST(l_quantity * 31 AS INT) END AS `STOP`,
  {_LINE_PATIENT} AS `PATIENT`, {_LINE_ENCOUNTER} AS `ENCOUNTER`,
  {_code("l_partkey", "l_partkey % 31 = 0", "l_suppkey % 19 = 0")} AS `CODE`,
  CASE WHEN l_linenumber = 4 THEN 'free' ELSE CAST(l_extendedprice AS STRING) END AS `BASE_COST`
FROM {{lineitem}}""",
    "src_careplans": f"""
SELECT 'CP' || CAST(o_orderkey AS STRING) AS `Id`,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS `START`,
  CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + CAST(o_custkey % 90 AS INT) END AS `STOP`,
  {_ORDER_PATIENT} AS `PATIENT`, {_ORDER_ENCOUNTER} AS `ENCOUNTER`, {_ORDER_CODE} AS `CODE`
FROM {{orders}}""",
    "src_imaging_studies": f"""
SELECT 'IM' || CAST(o_orderkey AS STRING) AS `Id`,
  CASE WHEN o_orderkey % 18 = 0 THEN NULL ELSE o_orderdate + INTERVAL '1' MINUTE * CAST(o_orderkey % 1440 AS INT) END AS `DATE`,
  {_ORDER_PATIENT} AS `PATIENT`, {_ORDER_ENCOUNTER} AS `ENCOUNTER`,
  {_code("o_custkey", "o_orderkey % 27 = 0", "o_orderkey % 21 = 0")} AS `PROCEDURE_CODE`,
  CASE o_orderstatus WHEN 'F' THEN ' DX ' WHEN 'P' THEN '' ELSE 'CT' END AS `MODALITY_CODE`
FROM {{orders}}""",
    "src_medications": f"""
SELECT CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE l_shipdate + INTERVAL '1' MINUTE * CAST(l_quantity * 7 AS INT) END AS `START`,
  CASE WHEN l_partkey % 7 = 0 THEN NULL
       WHEN l_partkey % 11 = 0 THEN l_shipdate - INTERVAL '1' HOUR * CAST(l_quantity AS INT)
       ELSE l_shipdate + INTERVAL '1' HOUR * CAST(l_quantity * 5 AS INT) END AS `STOP`,
  {_LINE_PATIENT} AS `PATIENT`, {_LINE_ENCOUNTER} AS `ENCOUNTER`, {_LINE_CODE} AS `CODE`,
  CASE l_linenumber WHEN 1 THEN '12.0' WHEN 2 THEN '0' WHEN 3 THEN 'x' WHEN 4 THEN NULL WHEN 5 THEN ' 3 '
       WHEN 6 THEN '99999999999' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS `DISPENSES`,
  CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE CAST(l_extendedprice AS STRING) END AS `TOTALCOST`,
  CASE WHEN l_suppkey % 5 = 0 THEN 'none' ELSE CAST(l_quantity AS STRING) END AS `PAYER_COVERAGE`
FROM {{lineitem}}""",
    "src_immunizations": f"""
SELECT {_EVENT_TIME} AS `DATE`, {_EVENT_PATIENT} AS `PATIENT`, {_EVENT_ENCOUNTER} AS `ENCOUNTER`,
  {_code("user_id", "event_id % 29 = 0", "event_id % 23 = 0")} AS `CODE`,
  CASE WHEN event_id % 9 = 0 THEN '' ELSE CAST(value AS STRING) END AS `BASE_COST`
FROM {{events}}""",
    "src_observations": f"""
SELECT {_EVENT_TIME} AS `DATE`, {_EVENT_PATIENT} AS `PATIENT`, {_EVENT_ENCOUNTER} AS `ENCOUNTER`,
  CASE event_type WHEN 'view' THEN 'vital-signs' WHEN 'click' THEN '' ELSE ' survey ' END AS `CATEGORY`,
  {_code("event_id % 1500", "event_id % 31 = 0", "event_id % 3 = 0")} AS `CODE`,
  CASE WHEN event_id % 4 = 0 THEN 'positive ' || event_type WHEN event_id % 21 = 0 THEN NULL ELSE CAST(value AS STRING) END AS `VALUE`,
  CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'mg' ELSE 'C' || CAST(event_id % 100 AS STRING) END AS `UNITS`,
  CASE WHEN event_type = 'error' THEN NULL WHEN event_id % 4 = 0 THEN 'text' WHEN event_id % 7 = 0 THEN '  '
       WHEN event_id % 2 = 0 THEN 'numeric' ELSE ' Numeric' END AS `TYPE`
FROM {{events}}""",
    "src_allergies": f"""
SELECT CASE WHEN o_orderkey % 14 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS `START`,
  {_ORDER_PATIENT} AS `PATIENT`, {_ORDER_ENCOUNTER} AS `ENCOUNTER`, {_ORDER_CODE} AS `CODE`,
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE ' Allergy to a substance named at some length for the order ' || CAST(o_custkey AS STRING) END AS `DESCRIPTION`,
  CASE WHEN o_orderstatus = 'F' THEN 'allergy' WHEN o_orderstatus = 'P' THEN '' END AS `TYPE`,
  CASE WHEN o_orderkey % 2 = 0 THEN 'food' ELSE ' environment' END AS `CATEGORY`
FROM {{orders}}""",
    "src_devices": f"""
SELECT CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_shipdate END AS `START`,
  CASE WHEN l_linenumber > 4 THEN NULL ELSE l_shipdate + INTERVAL '1' HOUR * CAST(l_quantity AS INT) END AS `STOP`,
  {_LINE_PATIENT} AS `PATIENT`, {_LINE_ENCOUNTER} AS `ENCOUNTER`,
  {_code("l_partkey", "l_suppkey % 27 = 0", "l_suppkey % 21 = 0")} AS `CODE`,
  CASE WHEN l_linenumber = 1 THEN '' ELSE '(01)' || CAST(l_partkey AS STRING) || '(21)' || CAST(l_suppkey AS STRING) END AS `UDI`
FROM {{lineitem}}""",
    "src_supplies": f"""
SELECT CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS `DATE`,
  {_LINE_PATIENT} AS `PATIENT`, {_LINE_ENCOUNTER} AS `ENCOUNTER`, {_LINE_CODE} AS `CODE`,
  CASE WHEN l_linenumber = 2 THEN 'many' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS `QUANTITY`
FROM {{lineitem}}""",
    "src_payers": """
SELECT CAST(n_nationkey AS STRING) AS `Id`, n_name AS `NAME` FROM {nation}""",
    "src_payer_transitions": f"""
SELECT {_ORDER_PATIENT} AS `PATIENT`,
  CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE o_orderdate END AS `START_YEAR`,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 15 = 1 THEN o_orderdate - INTERVAL '30' DAY
       ELSE o_orderdate + INTERVAL '365' DAY END AS `END_YEAR`,
  CASE WHEN o_orderkey % 22 = 0 THEN NULL ELSE CAST(o_custkey % 28 AS STRING) END AS `PAYER`,
  CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey % 25 AS STRING) ELSE ' ' END AS `SECONDARY_PAYER`,
  CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE 'M' || CAST(o_custkey AS STRING) END AS `MEMBERID`,
  CASE o_orderstatus WHEN 'F' THEN 'Self' WHEN 'P' THEN ' Guardian ' ELSE '' END AS `OWNERSHIP`,
  'Owner ' || CAST(o_custkey AS STRING) AS `OWNERNAME`
FROM {{orders}}""",
    "src_claims": f"""
SELECT 'CL' || CAST(o_orderkey AS STRING) AS `Id`, {_ORDER_PATIENT} AS `PATIENTID`,
  CAST(o_custkey % 110 AS STRING) AS `PROVIDERID`, {_ORDER_ENCOUNTER} AS `APPOINTMENTID`,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 30 AS INT) END AS `SERVICEDATE`,
  {_DIAGNOSES}
FROM {{orders}}""",
    "src_claims_transactions": f"""
SELECT {_LINE_ENCOUNTER} AS `APPOINTMENTID`,
  CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN 'n/a' ELSE CAST(l_extendedprice AS STRING) END AS `AMOUNT`,
  CASE WHEN l_linenumber <= 2 THEN NULL ELSE CAST(l_quantity AS STRING) END AS `PAYMENTS`,
  CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linenumber = 2 AND l_suppkey % 2 = 0 THEN '' ELSE CAST(l_quantity AS STRING) END AS `OUTSTANDING`
FROM {{lineitem}}""",
    "src_concept": """
SELECT CAST(p_partkey + 1 AS INT) AS concept_id,
  CASE WHEN p_partkey % 7 = 6 THEN 'NATION_' || CAST(p_partkey % 23 AS STRING) ELSE p_name END AS concept_name,
  CASE p_partkey % 7
    WHEN 2 THEN CASE WHEN p_size % 6 = 0 THEN 'Device' ELSE 'Drug' END
    WHEN 3 THEN CASE p_size % 4 WHEN 0 THEN 'Observation' WHEN 1 THEN 'Drug' ELSE 'Measurement' END
    WHEN 4 THEN 'Drug' WHEN 5 THEN 'Unit' WHEN 6 THEN 'Payer'
    ELSE CASE p_size % 5 WHEN 0 THEN 'Procedure' WHEN 1 THEN 'Device' WHEN 2 THEN 'Observation' ELSE 'Condition' END
  END AS domain_id,
  CASE p_partkey % 7 WHEN 2 THEN 'RxNorm' WHEN 3 THEN 'LOINC' WHEN 4 THEN 'CVX' WHEN 5 THEN 'UCUM' WHEN 6 THEN 'Payer'
    ELSE 'SNOMED' END AS vocabulary_id,
  p_type AS concept_class_id,
  CASE WHEN p_size % 3 = 0 THEN NULL ELSE 'S' END AS standard_concept,
  'C' || CAST(CAST(FLOOR(p_partkey / 14) AS BIGINT) AS STRING) AS concept_code,
  '19700101' AS valid_start_date, '20991231' AS valid_end_date,
  CASE WHEN p_partkey % 11 = 0 THEN 'D' END AS invalid_reason
FROM {part}""",
    "src_concept_relationship": """
SELECT CAST(p_partkey + 1 AS INT) AS concept_id_1, CAST(p_partkey + 1 + 7 * (p_size % 5) AS INT) AS concept_id_2,
  CASE WHEN p_partkey % 5 = 0 THEN 'Subsumes' ELSE 'Maps to' END AS relationship_id,
  '19700101' AS valid_start_date, '20991231' AS valid_end_date,
  CASE WHEN p_partkey % 9 = 0 THEN 'D' END AS invalid_reason
FROM {part}
UNION ALL
SELECT CAST(p_partkey + 1 AS INT), CAST(p_partkey + 2 AS INT), 'Maps to', '19700101', '20991231',
  CASE WHEN p_size % 4 = 0 THEN 'U' END
FROM {part}""",
    # proposed rows in flat form; the Spark side folds them into maps and arrays
    "src_proposals": """
SELECT event_id,
  CASE event_type WHEN 'click' THEN 'condition_occurrence' WHEN 'view' THEN 'measurement' WHEN 'purchase' THEN 'drug_exposure'
    WHEN 'signup' THEN 'observation' ELSE 'device_exposure' END AS target_table,
  'row-' || CAST(CASE WHEN event_id % 40 = 1 THEN event_id - 1 ELSE event_id END AS STRING) AS source_row_id,
  CASE event_type WHEN 'click' THEN 'condition_concept_id' WHEN 'view' THEN 'measurement_concept_id'
    WHEN 'purchase' THEN 'drug_concept_id' WHEN 'signup' THEN 'observation_concept_id' ELSE 'device_concept_id' END AS concept_field,
  CASE event_type WHEN 'click' THEN 'condition_start_date' WHEN 'view' THEN 'measurement_date'
    WHEN 'purchase' THEN 'drug_exposure_start_date' WHEN 'signup' THEN 'observation_date' ELSE 'device_exposure_start_date' END AS date_field,
  CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 23 = 0 THEN '' WHEN event_id % 29 = 0 THEN '999999999'
    ELSE CAST(user_id + 1 AS STRING) END AS person_text,
  CASE WHEN event_id % 31 = 0 THEN NULL WHEN event_id % 37 = 0 THEN 'abc' WHEN event_id % 13 = 0 THEN '424242424'
    ELSE CAST((event_id * 7) % 1999 + 1 AS STRING) END AS concept_text,
  CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 13 = 0 THEN CAST(424242424 AS BIGINT)
    WHEN event_id % 17 = 0 THEN CAST(5 AS BIGINT) ELSE (event_id * 7) % 1999 + 1 END AS binding_id,
  CASE WHEN event_id % 11 = 0 THEN 'no_value' WHEN event_id % 9 = 0 THEN 'unbound' ELSE 'bound' END AS binding_kind,
  CASE WHEN event_id % 3 = 0 THEN CAST((event_id * 3) % 1999 + 1 AS BIGINT) END AS extra_id,
  CASE WHEN event_id % 2 = 0 THEN 'Drug' END AS extra_domain,
  event_id % 4 = 0 AS extra_standard,
  CASE event_id % 25 WHEN 0 THEN NULL WHEN 1 THEN 'soon' WHEN 2 THEN '2001-02-30' WHEN 3 THEN '2999-01-01' WHEN 4 THEN '1900-05-06'
    WHEN 5 THEN '2001-03-04T05:06:07Z' WHEN 6 THEN '2001-03-04 05:06:07' WHEN 7 THEN '  2000-12-31 ' WHEN 8 THEN ''
    ELSE CAST(CAST(ts - INTERVAL '8300' DAY AS DATE) AS STRING) END AS date_text,
  CASE WHEN event_id % 33 = 0 THEN 'text value could map to two tables' END AS uncertainty_reason,
  event_id % 26 <> 0 AS requires_existing_person
FROM {events}""",
    # all-text tables for inference, coercion and profiling
    "raw_customers": """
SELECT c_custkey AS row_key,
  '0000' || CAST(1000 + c_custkey % 9000 AS STRING) || '-abcd-4EF0-89ab-00000000' || CAST(1000 + c_nationkey AS STRING) AS `UID`,
  CAST(c_custkey AS STRING) AS `CUSTKEY`,
  CASE WHEN c_custkey % 10 = 3 THEN ' ' ELSE CAST(DATE '1950-01-01' + CAST(c_custkey % 5000 AS INT) AS STRING) END AS `BIRTHDATE`,
  ' ' || CAST(DATE '2001-01-01' + CAST(c_custkey % 300 AS INT) AS STRING) || 'T05:07:' || CAST(10 + c_custkey % 50 AS STRING) ||
    CASE WHEN c_custkey % 3 = 0 THEN 'Z' WHEN c_custkey % 3 = 1 THEN '.25' ELSE '' END AS `UPDATED`,
  CAST(c_acctbal AS STRING) AS `BALANCE`,
  CASE WHEN c_custkey % 2 = 0 THEN 'Yes' ELSE 'n' END AS `ACTIVE`,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_mktsegment END AS `SEGMENT`,
  CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE '  ' END AS `EMPTY`,
  CASE WHEN c_custkey % 50 = 11 THEN '12 ' WHEN c_custkey % 50 = 12 THEN '2020-13-45' ELSE c_name END AS `MIXED`,
  CASE WHEN c_custkey > 250 THEN 'unknown' ELSE '2020-01-15' END AS `LATE`
FROM {customer}""",
    "raw_births": """
SELECT c_custkey AS row_key,
  CASE WHEN c_custkey % 3 = 0 THEN CAST(DATE '1950-01-01' + CAST(c_custkey % 9000 AS INT) AS TIMESTAMP) + INTERVAL '7' HOUR END AS birth_moment,
  CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE CAST(1930 + c_custkey % 70 AS INT) END AS birth_year,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey % 14 AS INT) END AS birth_month,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_custkey % 33 AS INT) END AS birth_day
FROM {customer}""",
    "raw_orders": """
SELECT o_orderkey AS row_key, CAST(o_orderkey AS STRING) AS `ORDERKEY`,
  CASE o_orderkey % 12 WHEN 0 THEN '' WHEN 1 THEN '0' WHEN 2 THEN 'x' WHEN 3 THEN '12.0' WHEN 4 THEN '-7' WHEN 5 THEN ' +8 '
    WHEN 6 THEN 'NaN' WHEN 7 THEN '5d' WHEN 8 THEN '1e3' WHEN 9 THEN '.5' WHEN 10 THEN NULL ELSE CAST(o_custkey AS STRING) END AS `NUMBER`,
  CAST(o_totalprice AS STRING) AS `PRICE`,
  CASE o_orderkey % 9 WHEN 0 THEN '' WHEN 1 THEN '2001-02-30' WHEN 2 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T10:20:30Z'
    WHEN 3 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 10:20' WHEN 4 THEN '2001'
    WHEN 5 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T25:00:00'
    WHEN 6 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T10:20:30+05:00'
    ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS `WHEN_TEXT`,
  o_orderpriority AS `PRIORITY`
FROM {orders}""",
}

SOURCE_ADAPTERS = {name.removeprefix("src_"): name for name in ADAPTERS if name.startswith("src_") and name != "src_proposals"}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def tables_of(name: str) -> list[str]:
    """The given tables an adapter reads."""
    return [t for t in TABLES if "{" + t + "}" in ADAPTERS[name]]


def spark_sql(name: str, paths: dict[str, str]) -> str:
    return ADAPTERS[name].format(**{t: f"parquet.`{path}`" for t, path in paths.items()})


def duckdb_sql(name: str) -> str:
    return ADAPTERS[name].format(**{t: t for t in TABLES}).replace("`", '"')
