"""Proposed rows against a small vocabulary and person table."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from clinloom import schemas as S
from clinloom.plans.run import validate_proposals
from clinloom.sources.files import read_proposals, with_defaults

CONCEPTS = [
    (1001, "Condition standard", "Condition", "SNOMED", "S"), (1002, "Condition source", "Condition", "SNOMED", None),
    (2001, "Wrong domain standard", "Drug", "SNOMED", "S"), (3001, "Observation standard", "Observation", "LOINC", "S"),
    (4001, "Measurement standard", "Measurement", "LOINC", "S"), (5001, "Drug standard", "Drug", "RxNorm", "S"),
    (5002, "Drug source nonstandard", "Drug", "RxNorm", None),
]


def row(table, row_id, field, concept, date_field, date, person="1", bindings=None, extra=None, uncertain=None, requires=None, event_field=None):
    values = {"person_id": person, field: concept, date_field: date, **(extra or {})}
    bindings = [(field, concept, True, None)] if bindings is None else bindings
    return (table, row_id, values, bindings, date_field, event_field, "person_id", requires, uncertain)


@pytest.fixture(scope="module")
def check(spark):
    concept = spark.createDataFrame(CONCEPTS, "concept_id int, concept_name string, domain_id string, vocabulary_id string, standard_concept string")
    person = spark.createDataFrame(
        [(1, dt.datetime(2000, 1, 1), 2000, 1, 1), (2, None, 1990, None, None), (3, None, None, None, None)],
        "person_id long, birth_datetime timestamp_ntz, year_of_birth int, month_of_birth int, day_of_birth int",
    )

    def run(*rows):
        proposals = with_defaults(spark.createDataFrame(list(rows), S.PROPOSED_ROW)).withColumn("_n", F.monotonically_increasing_id())
        return validate_proposals(proposals, concept, person, "_n", F.lit("2024-06-01").cast("date"))

    return run


def reasons(result):
    return {r["source_row_id"]: (r["status"], r["reason"]) for r in result["row_checks"].collect()}


def test_valid_wrong_domain_and_uncertain(check):
    found = reasons(
        check(
            row("condition_occurrence", "conditions-1", "condition_concept_id", "1001", "condition_start_date", "2020-01-05",
                extra={"condition_source_concept_id": "1002"},
                bindings=[("condition_concept_id", "1001", True, None), ("condition_source_concept_id", "1002", False, "Condition")]),
            row("procedure_occurrence", "procedures-1", "procedure_concept_id", "2001", "procedure_date", "2020-01-06"),
            row("observation", "observations-1", "observation_concept_id", "3001", "observation_date", "2020-01-07", uncertain="two tables fit"),
        )
    )
    assert found["conditions-1"] == ("approved", "Row passed validation and can be rendered into SQL.")
    assert found["procedures-1"] == ("review", "concept_id 2001 belongs to domain Drug, expected Procedure.")
    assert found["observations-1"] == ("review", "Uncertain mapping: two tables fit")


def test_person_and_dates(check):
    found = reasons(
        check(
            row("measurement", "no-person", "measurement_concept_id", "4001", "measurement_date", "2020-01-08", person="99"),
            row("drug_exposure", "early", "drug_concept_id", "5001", "drug_exposure_start_date", "1999-12-31"),
            row("observation", "late", "observation_concept_id", "3001", "observation_date", "2999-01-01"),
            row("observation", "bad-date", "observation_concept_id", "3001", "observation_date", "soon"),
            row("observation", "no-date", "observation_concept_id", "3001", "observation_date", " "),
            row("observation", "no-birth", "observation_concept_id", "3001", "observation_date", "2020-01-01", person="3"),
            row("observation", "partial-birth", "observation_concept_id", "3001", "observation_date", "1989-12-31", person="2"),
            row("observation", "null-person", "observation_concept_id", "3001", "observation_date", "2020-01-01", person=None),
            row("observation", "odd-person", "observation_concept_id", "3001", "observation_date", "2020-01-01", person="x1"),
            row("observation", "any-person", "observation_concept_id", "3001", "observation_date", "2020-01-01T10:00:00Z", person="99", requires=False),
        )
    )
    assert found["no-person"][1] == "person_id 99 does not exist in OMOP person."
    assert found["early"][1] == "drug_exposure_start_date 1999-12-31 occurs before birth date 2000-01-01."
    assert found["late"][1] == "observation_date 2999-01-01 is in the future."
    assert found["bad-date"][1] == "observation_date is not a valid date.; observation_date must not be null."
    assert found["no-date"][1] == "observation_date must not be null."
    assert found["no-birth"][1] == "Birth date for person_id 3 is unavailable."
    assert found["partial-birth"][1] == "observation_date 1989-12-31 occurs before birth date 1990-01-01."
    assert found["null-person"][1] == "person_id must not be null."
    assert found["odd-person"][1] == "person_id is not an integer."
    assert found["any-person"][0] == "approved"


def test_concept_rules_first_failure_per_binding(check):
    result = check(
        row("drug_exposure", "nonstandard", "drug_concept_id", "5002", "d", "2020-01-10"),
        row("condition_occurrence", "unknown", "condition_concept_id", "9999", "d", "2020-01-11"),
        row("condition_occurrence", "unbound", "condition_concept_id", "1001", "d", "2020-01-11", bindings=[]),
        row("condition_occurrence", "mismatch", "condition_concept_id", "1001", "d", "2020-01-11", bindings=[("condition_concept_id", "1002", True, None)]),
        row("condition_occurrence", "absent", "x", "1", "d", "2020-01-11", bindings=[("condition_concept_id", "1001", True, None)]),
        row("condition_occurrence", "null-id", "condition_concept_id", None, "d", "2020-01-11", bindings=[("condition_concept_id", "1001", True, None)]),
    )
    found = {}
    for r in result["concept_checks"].collect():
        found.setdefault(r["source_row_id"], []).append(r["reason"])
    assert found["nonstandard"] == ["concept_id 5002 is not a standard concept for drug_concept_id."]
    assert found["unknown"] == ["concept_id 9999 does not exist in concept."]
    assert sorted(found["unbound"]) == [
        "Missing binding for required primary concept field condition_concept_id.",
        "Missing concept binding metadata for condition_concept_id.",
    ]
    assert found["mismatch"] == ["Binding mismatch for condition_concept_id: values contains 1001, binding contains 1002."]
    assert found["absent"] == ["Field condition_concept_id is missing from the proposed values."]
    assert found["null-id"] == ["condition_concept_id concept_id must not be null."]
    assert reasons(result)["unbound"][1] == (
        "Missing concept binding metadata for condition_concept_id.; "
        "Missing binding for required primary concept field condition_concept_id."
    )


def test_rows_of_one_id_share_concept_issues(check):
    found = [
        r["reason"]
        for r in check(
            row("condition_occurrence", "same", "condition_concept_id", "9999", "d", "2020-01-11"),
            row("condition_occurrence", "same", "condition_concept_id", "1001", "d", "2020-01-11"),
        )["row_checks"].collect()
    ]
    assert found == ["concept_id 9999 does not exist in concept."] * 2


def test_payload_has_sorted_keys(check):
    payload = check(row("drug_exposure", "r", "drug_concept_id", "5002", "a_date", "2020-01-10"))["review"].head()["payload_json"]
    parsed = json.loads(payload)
    assert payload.startswith('{"concept_bindings":[{"concept_id":5002,"field_name":"drug_concept_id","required_domain":null,')
    assert list(parsed) == sorted(parsed) and list(parsed["values"]) == sorted(parsed["values"])


def test_proposal_file_defaults(spark, check, tmp_path):
    path = tmp_path / "rows.json"
    path.write_text(json.dumps([{"target_table": "observation", "source_row_id": "a", "values": {"person_id": 1, "observation_concept_id": 3001, "observation_date": "2020-01-12"},
                                 "concept_bindings": [{"field_name": "observation_concept_id", "concept_id": 3001}], "start_date_field": "observation_date"}]))
    read = read_proposals(spark, f"file://{path}")
    first = read.head()
    assert first["requires_existing_person"] is True and first["person_id_field"] is None
    assert first["concept_bindings"][0]["requires_standard"] is True
    assert reasons(check(tuple(first)))["a"] == ("review", "person_id must not be null.")


@pytest.mark.parametrize("split", ["128", "1m"])
def test_arrays_over_several_lines_are_read_in_splits(spark, tmp_path, split):
    import json

    from clinloom import schemas as S

    rows = [
        {"target_table": "death", "source_row_id": f'r{n} ]}}" \\ [{{,', "values": {"a": str(n), "b": "],\n["}, "concept_bindings": [{"field_name": "f", "concept_id": "1"}], "requires_existing_person": n % 2 == 0}
        for n in range(60)
    ]
    texts = {
        "pretty": json.dumps(rows, indent=2), "line": "[" + "\n,".join(map(json.dumps, rows)) + "\n]\n", "tail": "[\n" + ",\n".join(map(json.dumps, rows)) + "]",
        "mixed": "\n[ " + ",".join(json.dumps(r, indent=n % 3 or None) for n, r in enumerate(rows)) + " ]", "one": json.dumps(rows[0], indent=1), "none": "[\n]",
    }
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        for name, text in texts.items():
            (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
            path = f"file://{tmp_path}/{name}.json"
            plain = with_defaults(spark.read.schema(S.PROPOSED_ROW).option("multiLine", True).json(path))
            key = lambda r: r["source_row_id"]
            assert sorted(read_proposals(spark, path, multiline=True).collect(), key=key) == sorted(plain.collect(), key=key), name
        (tmp_path / "cut.json").write_text(texts["pretty"][:-1], encoding="utf-8")
        with pytest.raises(ValueError, match="brackets"):
            read_proposals(spark, f"file://{tmp_path}/cut.json", multiline=True)
        if split == "128":
            assert spark.read.text(f"file://{tmp_path}/line.json").rdd.getNumPartitions() > 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_steps_written_once_give_the_same_rows(spark, store):
    """With a store the review rows are read from written checked rows, and nothing is checked again."""
    concept = spark.createDataFrame(CONCEPTS, "concept_id int, concept_name string, domain_id string, vocabulary_id string, standard_concept string")
    person = spark.createDataFrame([(1, None, 2000, 1, 1)], "person_id long, birth_datetime timestamp_ntz, year_of_birth int, month_of_birth int, day_of_birth int")
    given = [
        row("condition_occurrence", "a", "condition_concept_id", "1001", "condition_start_date", "2020-01-05"),
        row("condition_occurrence", "a", "condition_concept_id", "2001", "condition_start_date", "soon", person="x"),
        row("observation", None, "observation_concept_id", None, "observation_date", " ", person="9", requires=False),
        row("observation", "b", "observation_concept_id", "3001", "observation_date", "1999-01-07", uncertain="two tables fit"),
        row("drug_exposure", "b", "drug_concept_id", "5002", "", "2030-01-07", person=None, event_field="other_date", extra={"other_date": "2030-02-30"}),
    ]
    proposals = with_defaults(spark.createDataFrame(given, S.PROPOSED_ROW)).withColumn("_n", F.monotonically_increasing_id())
    today = F.lit("2024-06-01").cast("date")
    plain, written = (validate_proposals(proposals, concept, person, "_n", today, *more) for more in ((), (store,)))
    for name in plain:
        rows = [sorted(map(str, found[name].select(*(F.to_json(F.struct(c)).alias(c) for c in found[name].columns)).collect())) for found in (plain, written)]
        assert rows[0] == rows[1]
    plan = written["review"]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan and "Join" in plain["review"]._jdf.queryExecution().optimizedPlan().toString()
