"""Delimited, vocabulary and catalog inputs."""

import pytest

from clinloom.sources import catalog, files, records


def write(folder, name, text):
    (folder / name).write_text(text, encoding="utf-8")
    return f"file://{folder / name}"


def test_delimited_with_bom_quotes_and_line_breaks(spark, tmp_path):
    path = write(tmp_path, "a.csv", '﻿Id,NOTE\n1,"two\nlines, ""quoted"""\n2,\n')
    df = files.assert_well_formed(files.read_delimited(spark, path, multiline=True), "a.csv")
    assert df.columns == ["Id", "NOTE"]
    assert [tuple(r) for r in df.collect()] == [("1", 'two\nlines, "quoted"'), ("2", None)]


@pytest.mark.parametrize("split", ["128m", "60b"])
def test_line_breaks_in_quotes_across_splits(spark, store, tmp_path, split):
    import csv
    import random

    draw = random.Random(2)
    values = ["", "plain", 'say ""hi""'.replace('""', '"'), "two\nlines", "a,b", "\n\n", '"', 'x"\n"y', "ä\r\nö", "tail\n", " "]
    rows = [[str(i), draw.choice(values), draw.choice(values)] for i in range(60)]
    folder = tmp_path / "notes.csv"
    folder.mkdir()
    for part, some in (("part-0", rows[:35]), ("part-1", rows[35:])):
        with open(folder / part, "w", newline="", encoding="utf-8") as out:
            writer = csv.writer(out, lineterminator="\r\n" if part == "part-1" else "\n")
            writer.writerows([["Id", "NOTE", "x.y"], *some])
    path = f"file://{folder}"
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        df = files.read_delimited(spark, path, multiline=True, store=store)
        assert records.breaks_in_quotes(spark, path)
        found = files.assert_well_formed(files.staged(df, store, "notes"), "notes").orderBy(files.PLACE).collect()
        if split != "128m":
            assert spark.read.text(path).rdd.getNumPartitions() > 2
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [[r["Id"], r["NOTE"] or "", r["x.y"] or ""] for r in found] == rows


def test_records_of_another_width_and_quotes_left_open(spark, store, tmp_path):
    path = write(tmp_path, "w.csv", 'Id,X\n1,"a\nb"\n2\n3,"c\nd",5\n\n4,e\n')
    df = files.read_delimited(spark, path, multiline=True, store=store)
    assert sorted(r[files.BAD_ROW] for r in files.malformed_rows(df).collect()) == ["2", '3,"c\nd",5']
    assert sorted((r["Id"], r["X"]) for r in files.good_rows(df).collect()) == [("1", "a\nb"), ("4", "e")]
    with pytest.raises(ValueError, match="open.csv ends inside a quoted value"):
        files.read_delimited(spark, write(tmp_path, "open.csv", 'Id,X\n1,"a\n2,b\n'), multiline=True, store=store)
    empty = files.read_delimited(spark, write(tmp_path, "none.csv", "Id,X\n"), multiline=True, store=store)
    assert empty.columns[:2] == ["Id", "X"] and empty.collect() == []
    assert not records.breaks_in_quotes(spark, write(tmp_path, "plain.csv", 'Id,X\n1,"a"\n'))


def test_delimiter_comes_from_the_header(spark, tmp_path):
    for name, sep in (("commas", ","), ("tabs", "\t"), ("pipes", "|")):
        write(tmp_path, f"{name}.csv", f'"a,b|c"{sep}X\n1{sep}2\n')
    found = files.read_directory(spark, f"file://{tmp_path}")
    assert {n: tuple(files.good_rows(df).head()) for n, df in found.items()} == dict.fromkeys(("commas", "tabs", "pipes"), ("1", "2"))
    assert files.choose_delimiter("only") == "," and files.choose_delimiter("a|b,c|d") == "|"
    path = write(tmp_path, "told.csv", "Id|X,Y\n1|2,3\n")
    assert files.read_delimited(spark, path, sep="|").columns == ["Id", "X,Y", files.BAD_ROW]


def test_rows_keep_their_place_in_the_file(spark, store, tmp_path):
    folder = tmp_path / "parts.csv"
    folder.mkdir()
    for part, rows in (("part-0", range(3)), ("part-1", range(3, 400))):
        write(folder, part, "Id\n" + "".join(f"{r}\n" for r in rows))
    df = files.staged(files.read_delimited(spark, f"file://{folder}"), store, "parts")
    assert [r["Id"] for r in df.orderBy(files.PLACE).collect()] == [str(r) for r in range(400)]


def test_rows_of_another_width(spark, tmp_path):
    path = write(tmp_path, "a.csv", "Id,X\n1,2\n3\n4,5,6\n")
    df = files.read_delimited(spark, path)
    assert sorted(r[files.BAD_ROW] for r in files.malformed_rows(df).collect()) == ["3", "4,5,6"]
    assert files.good_rows(df).count() == 1
    with pytest.raises(ValueError, match="a.csv has 2 rows with an unexpected number of columns"):
        files.assert_well_formed(df, "a.csv")


def test_header_problems(spark, tmp_path):
    with pytest.raises(ValueError, match="dup.csv contains duplicate header names"):
        files.read_header(spark, write(tmp_path, "dup.csv", "a,a,b\n1,2,3\n"))
    with pytest.raises(ValueError, match="none.csv is empty or missing a header row"):
        files.read_header(spark, write(tmp_path, "none.csv", ""))


def test_directory(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="No CSV files were found"):
        files.read_directory(spark, f"file://{tmp_path}")
    for name in ("b.csv", "A.csv", "skip.txt"):
        write(tmp_path, name, "Id\n1\n")
    assert list(files.read_directory(spark, f"file://{tmp_path}", "t_")) == ["t_A", "t_b"]


def test_vocabulary_files_by_table():
    def plan(*names):
        return {t: [f.name for f in found] for t, found in files.vocabulary_files([files.SourceFile(n, n, 0) for n in names]).items() if found}

    # one concept file per vocabulary, any case, and the other concept tables apart
    assert plan("concept_rxnorm.csv", "Concept_Snomed.CSV", "CONCEPT_SYNONYM.csv", "Relationship.csv") == {
        "concept": ["concept_rxnorm.csv", "Concept_Snomed.CSV"], "concept_synonym": ["CONCEPT_SYNONYM.csv"], "relationship": ["Relationship.csv"],
    }
    assert plan() == {}
    with pytest.raises(ValueError, match="Unmapped vocabulary CSV files were found: COHORT.csv, readme.csv"):
        plan("readme.csv", "CONCEPT.csv", "COHORT.csv")


def test_vocabulary_rows_are_not_unquoted(spark, tmp_path):
    head = "concept_id\tconcept_name\tdomain_id\tvocabulary_id\tconcept_class_id\tstandard_concept\tconcept_code\tvalid_start_date\tvalid_end_date\tinvalid_reason\n"
    write(tmp_path, "CONCEPT.csv", head + '1\t"open quote\tDrug\tRxNorm\tx\tS\tc\t19700101\t20991231\t\n')
    row = files.read_vocabulary(spark, f"file://{tmp_path}")["concept"].head()
    assert (row["concept_id"], row["concept_name"], row["domain_id"], row["invalid_reason"]) == (1, '"open quote', "Drug", None)


PLACES = (("extracts", "{name}"), ("cdm", "ehr_{name}"), ("cdm", "{name}"))


@pytest.mark.parametrize(
    ("available", "expected"),
    [
        ([("cdm", "payers"), ("cdm", "ehr_payers"), ("extracts", "payers")], ("extracts", "payers")),
        ([("cdm", "payers"), ("cdm", "ehr_payers")], ("cdm", "ehr_payers")),
        ([("cdm", "payers"), ("extracts", "ehr_payers")], ("cdm", "payers")),
        ([("other", "payers"), ("cdm", "payers_old")], None),
    ],
)
def test_first_place_wins(available, expected):
    assert catalog.preferred_table("payers", set(available), PLACES) == expected


def test_all_missing_tables_are_named():
    def check(name, role, found):
        return catalog.TableCheck(name, role, f"db.{name}" if found else None, 0)

    sources = [check("patients", "source", True), check("claims", "source", False), check("payers", "source", False)]
    targets = [check("death", "reload", True), check("concept", "lookup", False)]
    with pytest.raises(ValueError, match="Missing required source tables: claims, payers$"):
        catalog.require(sources, targets)
    with pytest.raises(ValueError, match="Missing required OMOP tables: concept$"):
        catalog.require(sources[:1], targets)
    catalog.require(sources[:1], targets[:1])
