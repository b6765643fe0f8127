"""Hand-made extracts with one row per rule, and whole runs over catalog tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clinloom import schemas as S
from clinloom.operators.quality import assert_unique
from clinloom.operators import quality
from clinloom.plans.build import FACT_SOURCES, CdmBuild
from clinloom.plans.run import apply_validation, convert, load_extracts, profile_extracts, report_field_mappings, validate_proposals
from clinloom.sources.files import with_defaults
from clinloom.sinks.tables import empty_tables, ensure_schema, load_table, replace_review
from clinloom.staging import StageStore, walk_files

DAY, NOON = dt.date(2020, 5, 1), dt.datetime(2020, 5, 1, 12)

CONCEPTS = [
    # id, name, domain, vocabulary, standard, code, invalid
    (11, "c", "Condition", "SNOMED", None, "cond", None), (12, "c", "Condition", "SNOMED", "S", "cond", None),
    (13, "c", "Condition", "SNOMED", "S", "cond", None), (14, "old", "Condition", "SNOMED", "S", "gone", "D"),
    (20, "mapped", "Procedure", "SNOMED", None, "proc", None), (21, "target", "Procedure", "SNOMED", None, "other", None),
    (30, "m", "Measurement", "LOINC", "S", "meas", None), (31, "o", "Observation", "LOINC", "S", "obs", None),
    (32, "d", "Drug", "LOINC", "S", "drug", None), (40, "mg", "Unit", "UCUM", "S", "mg", None),
    (50, "rx", "Drug", "RxNorm", "S", "rx", None), (60, "Blue", "Payer", "Payer", "S", "p", None),
]


def make(spark, **rows):
    """All source tables; those not given are empty. Rows are dicts of the columns that matter."""

    def table(name):
        schema = S.SOURCES[name]
        return spark.createDataFrame([tuple(r.get(c) for c in schema.fieldNames()) for r in rows.get(name, [])], schema)

    return {name: table(name) for name in S.SOURCE_TABLES}


def vocabulary(spark):
    concept = spark.createDataFrame(
        [(i, n, d, v, "x", s, c, "19700101", "20991231", bad) for i, n, d, v, s, c, bad in CONCEPTS], S.VOCABULARY["concept"]
    )
    links = [(20, 21, "Maps to", None), (20, 14, "Maps to", None), (11, 21, "Maps to", "D"), (31, 12, "Subsumes", None)]
    relationship = spark.createDataFrame([(a, b, r, "", "", bad) for a, b, r, bad in links], S.VOCABULARY["concept_relationship"])
    return concept, relationship


PATIENT = {"Id": "p1", "BIRTHDATE": dt.date(2000, 1, 1), "GENDER": " male ", "RACE": "White", "ETHNICITY": "x", "LAT": "4.2", "LON": "bad"}
VISIT = {"Id": "e1", "START": NOON, "PATIENT": "p1", "ENCOUNTERCLASS": "wellness", "TOTAL_CLAIM_COST": "10", "PAYER_COVERAGE": "4"}


@pytest.fixture(scope="module")
def build(spark):
    def of(**rows):
        rows.setdefault("patients", [PATIENT])
        rows.setdefault("encounters", [VISIT, {**VISIT, "Id": "held", "ENCOUNTERCLASS": "other"}])
        return CdmBuild(make(spark, **rows), *vocabulary(spark), F.lit("2024-06-01").cast("date"))

    return of


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


FACT = {"PATIENT": "p1", "ENCOUNTER": "e1"}
CONDITION = {**FACT, "START": DAY, "CODE": " cond "}
CLAIM = {"Id": "c1", "PATIENTID": "p2", "APPOINTMENTID": "e1", "SERVICEDATE": NOON, "DIAGNOSIS1": "cond", "DIAGNOSIS2": " ", "DIAGNOSIS8": "cond"}
SEEN = {**FACT, "DATE": NOON, "VALUE": "5.5", "UNITS": "mg", "TYPE": "text"}
DRUG = {**FACT, "START": NOON, "CODE": "rx"}
PLAN = {"PATIENT": "p1", "START_YEAR": NOON, "PAYER": "b", "MEMBERID": "m", "SECONDARY_PAYER": " s "}


@pytest.fixture(scope="module")
def common(build):
    """One build with a row per rule of every fact table; claims belong to a second patient."""
    return build(
        patients=[PATIENT, {**PATIENT, "Id": "p2"}],
        conditions=[
            CONDITION, {**CONDITION, "CODE": "none"}, {**CONDITION, "CODE": "proc"},
            {**CONDITION, "ENCOUNTER": "held", "START": dt.date(2021, 1, 1)},
            {**CONDITION, "ENCOUNTER": None, "CODE": "none", "START": dt.date(2022, 1, 1)}, {**CONDITION, "START": None},
            {**CONDITION, "CODE": "  "}, {**CONDITION, "PATIENT": "p9"}, {**CONDITION, "START": None, "ENCOUNTER": "held"},
        ],
        claims=[CLAIM, {**CLAIM, "Id": "c2", "SERVICEDATE": None}],
        observations=[
            {**SEEN, "CODE": "meas"}, {**SEEN, "CODE": "obs"}, {**SEEN, "CODE": "drug"}, {**SEEN, "CODE": "none"},
            {**SEEN, "CODE": "none", "TYPE": None}, {**SEEN, "CODE": "none", "TYPE": " Numeric "},
        ],
        medications=[
            {**DRUG, "DISPENSES": "x", "STOP": dt.datetime(2020, 4, 1)}, {**DRUG, "DISPENSES": "0", "TOTALCOST": "9", "PAYER_COVERAGE": "2"},
            {**DRUG, "DISPENSES": "12.0", "STOP": dt.datetime(2020, 5, 4, 1)}, {**DRUG, "DISPENSES": "3"},
        ],
        payers=[{"Id": "b", "NAME": "Blue"}, {"Id": "g", "NAME": "Green"}],
        payer_transitions=[
            PLAN, {**PLAN, "PAYER": "g"}, {**PLAN, "PAYER": None}, {**PLAN, "END_YEAR": dt.datetime(2020, 4, 1)}, {**PLAN, "START_YEAR": None},
        ],
    )


def held(build, table):
    return rows(build.review().where(F.col("target_table") == table), "source_row_id", "review_reason")


@pytest.fixture(scope="module")
def audit(common):
    return {r["source_table"]: r for r in common.dropped_rows().collect()}


def test_concept_choice(common):
    lookup = {(r["vocabulary_id"], r["code"]): tuple(r)[2:] for r in common.concept_lookup.collect()}
    assert lookup["SNOMED", "cond"] == (12, 12, "Condition")  # standard first, then the lowest id
    assert lookup["SNOMED", "proc"] == (20, 21, "Procedure")  # a target that is not standard itself
    assert lookup["SNOMED", "other"] == (21, 0, "")
    assert ("SNOMED", "gone") not in lookup


def test_conditions_keep_gaps_and_lose_visits_in_review(common, audit):
    # numbered before the filter, so held rows leave gaps
    recorded = common.table("condition_occurrence").where("condition_type_concept_id = 32020")
    assert rows(recorded, "condition_occurrence_id", "condition_start_datetime", "visit_occurrence_id") == [
        (1, dt.datetime(2020, 5, 1), 1), (4, NOON, 1), (5, dt.datetime(2021, 1, 1), None),
    ]
    assert held(common, "condition_occurrence") == [
        ("synthea:conditions:p1:e1:2020-05-01:none", "Condition code could not be mapped to a standard Condition concept."),
        ("synthea:conditions:p1:e1:2020-05-01:proc", "Condition code mapped to the wrong OMOP domain for Condition."),
        ("synthea:review:condition_occurrence:6", "Condition code could not be mapped to a standard Condition concept."),
    ]
    assert tuple(audit["conditions"])[1:] == (9, 6, 3, 3, 3)


def test_claim_slots(common, audit):
    claims = common.condition_stage.where("source_table = 'claims'")
    assert rows(claims, "source_row_id", "condition_type_concept_id") == [("synthea:claims:c1:dx1", 32810), ("synthea:claims:c1:dx8", 32810)]
    assert tuple(audit["claims"])[1:] == (4, 2, 0, 2, 2)


def test_observation_routing(common, audit):
    assert rows(common.measurement_stage, "measurement_source_value", "review_reason") == [
        ("meas", None), ("none", "Observation code could not be mapped to a standard Measurement concept."),
    ]
    assert rows(common.observation_stage, "observation_source_value", "review_reason") == [
        ("drug", "Observation code mapped to the wrong OMOP domain for Observation."), ("obs", None),
    ]
    # unmapped and not numeric: in neither table and not held, but counted
    assert audit["observations"]["rows_dropped"] == 2
    assert rows(common.table("measurement"), "value_as_number", "unit_concept_id", "measurement_time") == [(5.5, 40, "12:00:00")]


def test_drug_numbers(common):
    assert rows(common.table("drug_exposure"), "quantity", "refills", "days_supply") == [
        (0.0, 0, 1), (12.0, None, 3), (3.0, 2, 1), (None, None, 1),
    ]
    costs = rows(common.table("cost"), "cost_domain_id", "total_charge", "paid_by_payer", "paid_by_patient")
    assert costs == [("Drug", 9.0, 2.0, 7.0), ("Visit", 10.0, 4.0, 6.0)]


def test_payer_rules(common):
    assert rows(common.table("payer_plan_period"), "payer_source_value", "payer_concept_id", "stop_reason_source_value") == [("Blue", 60, "s")]
    assert held(common, "payer_plan_period") == [
        ("synthea:payer_transitions:p1:2020-05-01 12:00:00.0000000:b", "payer_plan_period_end_date occurs before payer_plan_period_start_date."),
        ("synthea:payer_transitions:p1:2020-05-01 12:00:00.0000000:g", "Payer could not be mapped to a standard Payer concept."),
        ("synthea:review:payer_plan_period:1", "Payer could not be mapped to a standard Payer concept."),
    ]


def test_visits_and_held_visits(build):
    b = build(encounters=[
        VISIT, {**VISIT, "Id": "e0", "START": None, "STOP": dt.datetime(2019, 1, 1)}, {**VISIT, "Id": "none", "START": None},
        {**VISIT, "Id": "early", "START": dt.datetime(1999, 1, 1)}, {**VISIT, "Id": "late", "START": dt.datetime(2030, 1, 1)},
        {**VISIT, "Id": "class", "ENCOUNTERCLASS": None}, {**VISIT, "Id": "who", "PATIENT": "p9"},
    ])
    assert rows(b.table("visit_occurrence"), "visit_occurrence_id", "visit_start_date", "preceding_visit_occurrence_id") == [
        (1, dt.date(2019, 1, 1), None), (2, DAY, 1),
    ]
    assert held(b, "visit_occurrence") == [
        ("synthea:encounters:class", "Encounter class could not be mapped to a standard Visit concept."),
        ("synthea:encounters:early", "visit_start_date occurs before birth date."),
        ("synthea:encounters:late", "visit_start_date is in the future."),
        ("synthea:encounters:none", "visit_start_date must not be null."),
    ]
    assert rows(b.table("observation_period"), "observation_period_start_date", "observation_period_end_date") == [(dt.date(2019, 1, 1), DAY)]


def test_same_ids_with_other_partitioning(spark, build):
    def found():
        base = {"PATIENT": "p1", "ENCOUNTER": "e1", "CODE": "cond"}
        facts = [{**base, "START": dt.date(2020, 1, 1 + n % 9)} for n in range(60)]
        return rows(build(conditions=facts).condition_stage, "condition_occurrence_id", "condition_start_date", "source_row_id")

    first = found()
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert found() == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_repeated_ids_fail(spark):
    doubled = spark.createDataFrame([("p1",), ("p2",), ("p1",)], "Id string")
    with pytest.raises(ValueError, match="patients has more than one row for Id=p1"):
        assert_unique(doubled, "patients", "Id")
    assert_unique(doubled.distinct(), "patients", "Id")


def test_review_replacement(spark, store):
    old = spark.createDataFrame([(1, "death", "manual:1", "review", "r", "{}", None), (5, "death", "synthea:x", "review", "r", "{}", None)], S.REVIEW)
    new = spark.createDataFrame([("death", "synthea:y", "review", "r2", "{}")], "target_table string, source_row_id string, review_status string, review_reason string, payload_json string")
    assert rows(replace_review(old, new, store), "review_id", "source_row_id") == [(1, "manual:1"), (2, "synthea:y")]


def test_run_over_catalog_tables(spark, build, tmp_path):
    for schema in ("synthea", "dbo"):
        ensure_schema(spark, schema, f"file://{tmp_path}/{schema}")
    for name, df in make(spark, patients=[PATIENT], encounters=[VISIT]).items():
        load_table(df, "synthea", name)
    with pytest.raises(ValueError, match="Missing required OMOP tables: location, person"):
        convert(spark)
    concept, relationship = vocabulary(spark)
    load_table(concept, "dbo", "concept")
    load_table(relationship, "dbo", "concept_relationship")
    for name, schema in S.TARGETS.items():
        load_table(spark.createDataFrame([], schema), "dbo", name)

    as_of = F.lit("2019-06-01").cast("date")
    dry = convert(spark, as_of=as_of, execute=False)
    assert dry.rows_by_table == {} and dry.vocabularies["SNOMED"] == 6 and spark.table("dbo.person").count() == 0
    report = convert(spark, as_of=as_of)
    assert (report.rows_by_table["person"], report.rows_by_table["visit_occurrence"], report.review_rows) == (1, 0, 1)
    again = convert(spark, as_of=F.lit("2024-06-01").cast("date"))
    assert (again.rows_by_table["visit_occurrence"], again.review_rows) == (1, 0)
    assert spark.table("dbo.person").schema == S.TARGETS["person"]

    emptied = {r["table_name"]: tuple(r)[1:] for r in empty_tables(spark, "dbo", ["person", "nothing"]).collect()}
    assert emptied == {"person": ("emptied", 1, 0, "table cleared"), "nothing": ("skipped", 0, 0, "table not found")}
    assert spark.table("synthea.patients").count() == 1


def test_load_extracts(spark, tmp_path):
    (tmp_path / "patients.csv").write_text("Id,BIRTHDATE,LAST\n8c8e1c9a-b310-43c6-33a7-ad11bad21c40,2017-08-24, Ann \n,,\n")
    ensure_schema(spark, "staged", f"file://{tmp_path}/db")
    assert load_extracts(spark, f"file://{tmp_path}", "staged", "x_") == {"x_patients": 2}
    table = spark.table("staged.x_patients")
    assert [f.dataType.simpleString() for f in table.schema.fields] == ["string", "date", "string"]
    assert rows(table.where("Id is not null"), "BIRTHDATE", "LAST") == [(dt.date(2017, 8, 24), "Ann")]


def test_reports_as_tables(spark, tmp_path):
    (tmp_path / "payers.csv").write_text("Id,NAME\n1,Blue\n2,\n")
    ensure_schema(spark, "reports", f"file://{tmp_path}/db")
    assert profile_extracts(spark, f"file://{tmp_path}", "reports") == {"files_profiled": 1, "columns_profiled": 2, "total_rows": 2}
    overview = spark.table("reports.files_overview").head()
    assert (overview["row_count"], overview["column_count"], overview["blank_cells"], overview["file_size_bytes"]) == (2, 2, 1, 18)
    concept, _ = vocabulary(spark)
    written = report_field_mappings(spark, {"payers": spark.createDataFrame([("1", "Blue")], "Id string, NAME string")}, concept, "reports")
    assert written == {"file_summary": 1, "field_mappings": 143, "target_coverage": 103, "vocabulary_status": 5}


def test_approved_and_held_rows_are_written(spark, tmp_path):
    ensure_schema(spark, "checked", f"file://{tmp_path}/db")
    concept, _ = vocabulary(spark)
    person = spark.createDataFrame([(1, dt.datetime(2000, 1, 1), 2000, 1, 1)], "person_id long, birth_datetime timestamp_ntz, year_of_birth int, month_of_birth int, day_of_birth int")
    load_table(spark.createDataFrame([], S.TARGETS["condition_occurrence"]), "checked", "condition_occurrence")

    def proposed(row_id, concept_id):
        values = {"person_id": "1", "condition_occurrence_id": "7", "condition_concept_id": concept_id, "condition_start_date": "2020-01-05"}
        return ("condition_occurrence", row_id, values, [("condition_concept_id", concept_id, True, None)], "condition_start_date", None, "person_id", True, None)

    proposals = with_defaults(spark.createDataFrame([proposed("good", "12"), proposed("bad", "11")], S.PROPOSED_ROW)).withColumn("n", F.monotonically_increasing_id())
    results = validate_proposals(proposals, concept, person, "n", F.lit("2024-06-01").cast("date"))
    assert apply_validation(spark, results, "checked") == {"condition_occurrence": 1, S.REVIEW_TABLE: 1}
    assert rows(spark.table("checked.condition_occurrence"), "condition_occurrence_id", "condition_concept_id", "condition_start_date") == [(7, 12, dt.date(2020, 1, 5))]
    assert rows(spark.table(f"checked.{S.REVIEW_TABLE}"), "review_id", "source_row_id", "review_status") == [(1, "bad", "review")]


def test_review_ids_follow_the_content(spark, store):
    old = spark.createDataFrame([(5, "death", "manual:1", None, "old", None, None)], S.REVIEW)
    columns = "target_table string, source_row_id string, review_status string, review_reason string, payload_json string"
    new = spark.createDataFrame([("t", f"synthea:{n * 7 % 20:02}", "review", "r", "{}") for n in range(20)], columns).repartition(5)
    merged = replace_review(old, new, store).where("review_id > 5").orderBy("review_id").collect()
    assert [(r["review_id"], r["source_row_id"]) for r in merged] == [(6 + n, f"synthea:{n:02}") for n in range(20)]


def test_checks_run_once_for_approved_and_held_rows(spark, monkeypatch):
    from clinloom.operators import rowcheck

    saved = []
    real = rowcheck.approved_rows
    monkeypatch.setattr(rowcheck, "approved_rows", lambda checked: saved.append(checked) or real(checked))
    ensure_schema(spark, "checked_once")
    rows = spark.createDataFrame(
        [("death", "a", {"person_id": "1"}, [], None, None, "person_id", False, None), ("death", "b", {"person_id": "2"}, [], None, None, "person_id", False, "unsure")], S.PROPOSED_ROW
    ).withColumn("n", F.monotonically_increasing_id())
    results = validate_proposals(rows, spark.createDataFrame([], S.VOCABULARY["concept"]), spark.createDataFrame([], S.TARGETS["person"]), "n")
    load_table(spark.createDataFrame([], S.TARGETS["death"]), "checked_once", "death")
    saved.clear()
    assert apply_validation(spark, results, "checked_once") == {"death": 1, S.REVIEW_TABLE: 1}
    assert len(saved) == 1 and "FileScan parquet" in saved[0]._jdf.queryExecution().toString()


WIDE = {"procedure_stage", "drug_stage", "cost_table", "condition_stage", "device_stage", "measurement_stage", "observation_stage", "payer_plan_stage"}


def of_every_kind():
    """Rows for stages of several tables, with costs of visits, procedures and drugs, and held rows."""
    event = {"START": NOON, "PATIENT": "p1", "ENCOUNTER": "e1"}
    return {
        "conditions": [{**event, "START": DAY, "CODE": "cond"}, {**event, "START": DAY, "CODE": "none"}],
        "procedures": [{**event, "CODE": "proc", "BASE_COST": "7"}, {**event, "CODE": "none", "BASE_COST": "8"}],
        "medications": [{**event, "CODE": "rx", "TOTALCOST": "5", "PAYER_COVERAGE": "2"}],
        "observations": [{"DATE": NOON, "PATIENT": "p1", "ENCOUNTER": "e1", "CODE": "meas", "VALUE": "1"}],
        "devices": [{**event, "CODE": "none"}],
    }


def stage_files(build):
    return {path.rsplit("/", 2)[1].rsplit("-", 1)[0] for path in walk_files(build.spark, build.store.folder)}


@pytest.mark.parametrize("report", ["load_counts", "summary", "dropped_rows"])
def test_counts_leave_no_fact_stage_on_disk(build, report):
    """Each table is counted at its turn and its stage table removed, so the disk never holds all of them."""
    short, whole = build(**of_every_kind()), build(**of_every_kind())
    found = sorted(map(tuple, getattr(short, report)().collect()))
    facts = {f"{t}_id" for t in FACT_SOURCES} - {"visit_occurrence_id"} | {"cost_id", "routed_observations", "procedure_costs", "drug_costs"}
    assert not stage_files(short) & facts and not WIDE & set(short.__dict__)
    whole.prepare()
    assert found == sorted(map(tuple, getattr(whole, report)().collect()))
    # what was there before stays, and what went is built again
    assert {"procedure_stage", "condition_stage", "cost_table"} <= set(whole.__dict__) and whole.table("procedure_occurrence").count() == 1
    assert short.table("procedure_occurrence").count() == 1 and short.table("cost").count() == whole.table("cost").count() == 3


def test_tables_in_turn_hold_few_stages(build):
    """No more than one long stage table is there at any turn, costs included."""
    made, at = build(**of_every_kind()), {}
    for name in made.in_turn(S.TARGET_TABLES):
        made.table(name).count()
        at[name] = WIDE & set(made.__dict__)
    assert sorted(at) == sorted(S.TARGET_TABLES) and max(map(len, at.values())) == 1 and at["cost"] == {"cost_table"}


def test_reports_by_table_equal_those_of_all_tables(build):
    made = build(**of_every_kind())
    tables = {t: made.table(t) for t in S.TARGET_TABLES}
    apart = build(**of_every_kind())
    by_table = apart.report(lambda t: quality.not_null_violations({t: apart.table(t)}, {t: S.REQUIRED_COLUMNS[t]}), S.REQUIRED_COLUMNS)
    assert list(map(tuple, by_table.collect())) == list(map(tuple, quality.not_null_violations(tables).collect()))
    spans = quality.parent_spans(tables, S.FOREIGN_KEYS)
    assert sorted(map(tuple, quality.orphan_report(tables, spans=spans).collect())) == sorted(map(tuple, quality.orphan_report(tables).collect()))


def test_conversion_writes_tables_in_turn(spark, build, monkeypatch):
    """A conversion removes a stage table once its rows are written."""
    made = build(**of_every_kind())
    for schema, tables in {
        "turns_from": made.sources,
        "turns_to": {t: spark.createDataFrame([], S.TARGETS[t]) for t in S.TARGET_TABLES} | {"concept": made.concept, "concept_relationship": made.relationship},
    }.items():
        ensure_schema(spark, schema)
        for name, df in tables.items():
            load_table(df, schema, name)
    seen, table = {}, CdmBuild.table

    def watched(self, name):
        found = table(self, name)
        seen[name] = WIDE & set(self.__dict__)
        return found

    monkeypatch.setattr(CdmBuild, "table", watched)
    report = convert(spark, "turns_to", as_of=made.as_of, preference=(("turns_from", "{name}"),))
    assert max(map(len, seen.values())) == 1 and len(seen) == len(S.TARGET_TABLES)
    assert report.rows_by_table["cost"] == 3 and report.rows_by_table["procedure_occurrence"] == 1
    review = spark.table("turns_to." + S.REVIEW_TABLE)
    held = sorted(map(tuple, made.review().collect()))
    assert sorted(map(tuple, review.select(*made.review().columns).collect())) == held and len(held) == report.review_rows
    assert sorted(r[0] for r in review.select("review_id").collect()) == list(range(1, len(held) + 1))


def test_facts_and_visits_are_written_once(build, monkeypatch):
    """Their rows go from the joins straight into the blocks that are numbered."""
    saved, save = [], StageStore.save
    monkeypatch.setattr(StageStore, "save", lambda store, df, name: (saved.append(name), save(store, df, name))[1])
    made = build(**of_every_kind())
    for table in S.REVIEWED_TABLES:
        if table != "death":
            made.stage(table)
            key = S.PRIMARY_KEYS[table]
            assert [n for n in saved if n.startswith(key)] == [key]
