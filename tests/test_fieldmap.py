"""Field-mapping rules on small inputs."""

from clinloom.operators import fieldmap


def inputs(spark, counts):
    rules = fieldmap.mapping_rules(spark)
    vocabularies = spark.createDataFrame(counts, "vocabulary_id string, concept_count long")
    return rules, fieldmap.target_columns(spark), vocabularies


def test_rules_are_complete(spark):
    rules = fieldmap.mapping_rules(spark)
    kinds = {r["mapping_kind"]: r["count"] for r in rules.groupBy("mapping_kind").count().collect()}
    assert kinds == {"direct": 57, "derived": 22, "foreign_key": 18, "concept_lookup": 10, "review_required": 34}
    # every rule points at a column of the target schema
    status = fieldmap.rule_status(*inputs(spark, [("SNOMED", 1)]))
    assert status.where("validation_status = 'invalid_target_reference'").count() == 0


def test_statuses(spark):
    rules, targets, vocabularies = inputs(spark, [("SNOMED", 0), ("RxNorm", 12)])
    odd = spark.createDataFrame(
        [("f.csv", "a", None, None, "direct", "l", None, None), ("f.csv", "b", "person", "nope", "direct", "l", None, None),
         ("f.csv", "c", None, None, "no_direct", "Kept in the source only.", None, None)],
        rules.schema,
    )
    found = {(r["source_file"], r["source_column"], r["target_column"]): (r["validation_status"], r["validation_note"])
             for r in fieldmap.rule_status(rules.unionByName(odd), targets, vocabularies).collect()}
    assert found["conditions.csv", "CODE", "condition_concept_id"] == (
        "validated_target_missing_vocabulary",
        "Validated target condition_occurrence.condition_concept_id, but source vocabulary SNOMED is not loaded in concept.",
    )
    assert found["medications.csv", "CODE", "drug_concept_id"] == (
        "validated", "Validated target drug_exposure.drug_concept_id in omop. Vocabulary RxNorm is loaded with 12 concepts."
    )
    assert found["f.csv", "a", None][0] == "unmapped_source_field"
    assert found["f.csv", "b", "nope"] == ("invalid_target_reference", "Target person.nope does not exist in omop.")
    assert found["f.csv", "c", None] == ("no_direct_omop_field", "Kept in the source only.")


def test_reports(spark):
    rules, targets, vocabularies = inputs(spark, [("SNOMED", 3)])
    tables = {
        "payers": spark.createDataFrame([("p1", "Blue"), ("p2", "Blue"), ("p3", " ")], "Id string, NAME string").coalesce(1),
        "conditions": spark.createDataFrame([("2020-01-01", "c1")], "start string, CODE string"),
    }
    fields = fieldmap.source_fields(tables)
    samples = {(r["file_name"], r["column_name"]): (r["row_count"], r["sample_values"]) for r in fields.collect()}
    assert samples["payers.csv", "NAME"] == (3, ["Blue"]) and samples["payers.csv", "Id"] == (3, ["p1", "p2", "p3"])

    mappings = fieldmap.field_mappings(fields, fieldmap.rule_status(rules, targets, vocabularies))
    rows = mappings.collect()
    name = next(r for r in rows if (r["source_file"], r["source_column"]) == ("payers.csv", "NAME"))
    assert (name["validation_status"], name["mapping_kind"]) == ("unmapped_source_field", "unmapped")
    # matched without regard to case, shown as in the file
    assert any(r["source_column"] == "start" and r["validation_status"] == "validated" for r in rows)
    gone = next(r for r in rows if (r["source_file"], r["source_column"]) == ("conditions.csv", "STOP"))
    assert gone["validation_status"] == "source_column_missing" and gone["validation_note"].startswith("Mapping rule references")

    summary = {r["file_name"]: tuple(r)[1:] for r in fieldmap.file_summary(fields, mappings).collect()}
    assert summary["payers.csv"] == (3, 2, 0, 0, 2, 0)
    assert summary["conditions.csv"] == (1, 2, 2, 0, 0, 3)
    coverage = {(r["target_table"], r["target_column"]): r["source_fields"] for r in fieldmap.target_coverage(mappings).collect()}
    assert coverage["death", "person_id"] == "patients.csv:Id"
    status = {r["vocabulary_id"]: r["note"] for r in fieldmap.vocabulary_status(rules, vocabularies).collect()}
    assert status["SNOMED"].startswith("Vocabulary available") and status["CVX"].startswith("Vocabulary missing")
