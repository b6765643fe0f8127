"""Loads that change all tables or none."""

import pytest
from pyspark.sql import functions as F

from clinloom.sinks import journal, tables
from clinloom.sinks.tables import Later, append_tables, change_tables, ensure_schema, load_table, load_tables
from clinloom.staging import list_files


@pytest.fixture()
def place(spark, tmp_path):
    ensure_schema(spark, "loads", f"file://{tmp_path}/db")
    yield f"file://{tmp_path}/db"
    spark.sql("DROP DATABASE loads CASCADE")


def broken(spark):
    return spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))


def ids(spark, table):
    return sorted(r["id"] for r in spark.table(f"loads.{table}").collect())


def test_replace_with_other_columns(spark, place):
    assert load_table(spark.range(3), "loads", "a") == 3
    old = list_files(spark, place, "a-*")
    assert load_table(spark.range(5).selectExpr("id", "'x' AS more"), "loads", "a") == 5
    assert spark.table("loads.a").columns == ["id", "more"]
    assert len(list_files(spark, place, "a-*")) == 1 and list_files(spark, place, "a-*") != old  # the version before is gone


def test_failed_replacement_keeps_every_table(spark, place):
    load_tables({"a": spark.range(3), "b": spark.range(4)}, "loads")
    with pytest.raises(Exception, match="broken"):
        load_tables({"a": spark.range(1).selectExpr("id", "1 AS other"), "b": broken(spark), "c": spark.range(2)}, "loads")
    assert ids(spark, "a") == [0, 1, 2] and ids(spark, "b") == [0, 1, 2, 3]
    assert not spark.catalog.tableExists("loads.c") and len(list_files(spark, place, "[abc]-*")) == 2


def refuse(monkeypatch, table):
    """From now on the catalog does not switch this table."""
    real = journal.switch

    def refusing(spark, schema, step):
        if step.name == table:
            raise RuntimeError("no catalog")
        real(spark, schema, step)

    monkeypatch.setattr(journal, "switch", refusing)


def journals(spark, place):
    return list_files(spark, f"{place}/_journal", "*")


def test_switches_are_taken_back(spark, place, monkeypatch):
    load_tables({"a": spark.range(3), "b": spark.range(4)}, "loads")
    refuse(monkeypatch, "b")
    with pytest.raises(RuntimeError, match="no catalog"):
        load_tables({"a": spark.range(9), "c": spark.range(1), "b": spark.range(9)}, "loads")
    assert ids(spark, "a") == [0, 1, 2] and ids(spark, "b") == [0, 1, 2, 3] and not spark.catalog.tableExists("loads.c")
    assert journals(spark, place) == [] and len(list_files(spark, place, "[abc]-*")) == 2


@pytest.mark.parametrize("columns", ["id", "id, 'x' AS more"])
def test_managed_tables_keep_their_rows(spark, place, monkeypatch, columns):
    for t, made in (("m", "parquet"), ("o", "orc")):
        spark.range(3).write.format(made).saveAsTable(f"loads.{t}")
    spark.range(4).withColumn("part", F.col("id") % 2).write.partitionBy("part").saveAsTable("loads.p")
    load_tables({"z": spark.range(1)}, "loads")
    new = spark.range(7).selectExpr(*columns.split(", "))
    with monkeypatch.context() as patch:
        refuse(patch, "z")
        with pytest.raises(RuntimeError, match="no catalog"):
            load_tables({"m": new, "o": new, "p": new, "z": new}, "loads")
    assert (ids(spark, "m"), ids(spark, "o"), ids(spark, "p"), ids(spark, "z")) == ([0, 1, 2], [0, 1, 2], [0, 1, 2, 3], [0])
    assert [r["part"] for r in spark.table("loads.p").orderBy("id").collect()] == [0, 1, 0, 1]
    assert load_tables({"m": new, "o": new, "p": new, "z": new}, "loads") == dict.fromkeys("mopz", 7)
    assert all(ids(spark, t) == list(range(7)) for t in "mopz")
    assert not [t.name for t in spark.catalog.listTables("loads") if "_before_" in t.name] and journals(spark, place) == []
    assert load_tables({"m": spark.range(2)}, "loads") == {"m": 2} and ids(spark, "m") == [0, 1]


def test_files_of_a_users_external_table_stay(spark, place, tmp_path):
    spark.range(3).write.parquet(f"file://{tmp_path}/mine")
    spark.catalog.createTable("loads.e", path=f"file://{tmp_path}/mine", source="parquet")
    load_tables({"e": spark.range(5)}, "loads")
    assert ids(spark, "e") == [0, 1, 2, 3, 4] and spark.read.parquet(f"file://{tmp_path}/mine").count() == 3


@pytest.mark.parametrize("steps", [0, 1, 2])
def test_a_lost_driver_between_switches(spark, place, steps):
    spark.range(3).write.saveAsTable("loads.m")
    load_tables({"a": spark.range(3)}, "loads")
    change = journal.Change("loads", [journal.table_step(spark, "loads", t, new.schema) for t, new in (("a", spark.range(1)), ("m", spark.range(1).selectExpr("id", "1 AS x")))])
    lost = journal.Journal(spark, change)
    lost.enter("writing")
    for step, new in zip(change.tables, (spark.range(8), spark.range(9).selectExpr("id", "1 AS x"))):
        new.write.parquet(step.new_path)
    lost.enter("switching")
    for step in change.tables[:steps]:
        journal.switch(spark, "loads", step)
    with pytest.raises(journal.UnfinishedChange, match="a of loads"):
        load_tables({"a": spark.range(1)}, "loads")
    load_tables({"other": spark.range(1)}, "loads")
    assert [(r["found_in"], r["outcome"], r["tables"]) for r in journal.recover(spark, "loads").collect()] == [("switching", "completed", ["a", "m"])]
    assert ids(spark, "a") == list(range(8)) and ids(spark, "m") == list(range(9)) and spark.table("loads.m").columns == ["id", "x"]
    assert journal.recover(spark, "loads").collect() == [] and journals(spark, place) == []


def test_a_lost_driver_while_writing_and_while_undoing(spark, place):
    load_tables({"a": spark.range(3), "b": spark.range(2)}, "loads")
    change = journal.Change("loads", [journal.table_step(spark, "loads", t, spark.range(1).selectExpr("id", "1 AS x").schema) for t in "ab"])
    journal.Journal(spark, change).enter("writing")
    spark.range(9).write.parquet(change.tables[0].new_path)
    assert journal.recover(spark, "loads").head()["outcome"] == "taken back"
    assert ids(spark, "a") == [0, 1, 2] and len(list_files(spark, place, "a-*")) == 1
    for step in change.tables:
        spark.range(9).selectExpr("id", "1 AS x").write.parquet(step.new_path)
    journal.Journal(spark, change).enter("switching")
    journal.Journal(spark, change).forward()
    journal.Journal(spark, change).enter("undoing")
    journal.switch_back(spark, "loads", change.tables[1])
    assert journal.recover(spark, "loads").head()["outcome"] == "taken back"
    assert ids(spark, "a") == [0, 1, 2] and ids(spark, "b") == [0, 1] and spark.table("loads.a").columns == ["id"]


@pytest.mark.parametrize("moved", [0, 1, 99])
def test_a_lost_driver_between_moves_of_files(spark, place, moved):
    load_tables({"a": spark.range(3)}, "loads")
    home = journal.described(spark, "loads", "a")["location"]
    change = journal.Change("loads", moved_tables=["a"], aside=[f"{home}/_aside-x"])
    spark.range(3, 9).repartition(3).write.parquet(f"{home}/_aside-x/new")
    assert ids(spark, "a") == [0, 1, 2]  # what lies aside is not read
    change.moves = tables._moved_in(spark, f"{home}/_aside-x/new", home)
    journal.Journal(spark, change).enter("switching")
    for source, target in change.moves[:moved]:
        journal.move(spark, source, target)
    journal.recover(spark, "loads")
    assert ids(spark, "a") == list(range(9)) and list_files(spark, home, "_aside*") == []


def test_only_files_with_rows_that_leave_are_replaced(spark, place):
    rows = spark.createDataFrame([(i, "manual" if i < 40 else "own" if i < 60 else "mixed") for i in range(80)], "id long, kind string")
    change_tables(spark, "loads", replace={"r": rows.where("kind = 'manual'").repartition(2)})
    change_tables(spark, "loads", append={"r": rows.where("kind = 'own'").coalesce(1)})
    change_tables(spark, "loads", append={"r": rows.where("kind = 'mixed'").coalesce(1)})
    home = journal.described(spark, "loads", "r")["location"]
    before = {f.rsplit("/", 1)[-1] for f in list_files(spark, home, "part-*")}
    manual = {r["n"] for r in spark.table("loads.r").where("id < 40").selectExpr("_metadata.file_name AS n").distinct().collect()}
    gone = (F.col("kind") == "own") | (F.col("id") >= 70)
    assert change_tables(spark, "loads", append={"r": rows.limit(2).withColumn("id", F.col("id") + 100)}, without={"r": gone}) == {"r": 2}
    after = {f.rsplit("/", 1)[-1] for f in list_files(spark, home, "part-*")}
    assert ids(spark, "r") == [*range(40), *range(60, 70), 100, 101] and before & after == manual
    with pytest.raises(Exception, match="broken"):
        change_tables(spark, "loads", append={"r": broken(spark).withColumn("kind", F.lit("x"))}, without={"r": F.col("id") < 40})
    assert ids(spark, "r") == [*range(40), *range(60, 70), 100, 101] and {f.rsplit("/", 1)[-1] for f in list_files(spark, home, "part-*")} == after


def test_appends_to_other_formats_and_partitions(spark, place):
    spark.range(2).write.format("orc").saveAsTable("loads.o")
    spark.range(4).withColumn("part", F.col("id") % 2).write.partitionBy("part").saveAsTable("loads.p")
    new = spark.range(5, 8)
    assert append_tables({"o": new, "p": new.withColumn("part", F.lit(7).cast("long"))}, "loads") == {"o": 3, "p": 3}
    assert ids(spark, "o") == [0, 1, 5, 6, 7] and ids(spark, "p") == [0, 1, 2, 3, 5, 6, 7]
    assert spark.table("loads.p").where("part = 7").count() == 3
    spark.range(1).write.format("json").saveAsTable("loads.j")
    with pytest.raises(ValueError, match="Parquet and ORC"):
        append_tables({"j": new}, "loads")


def test_rows_are_counted_while_they_are_written(spark, place):
    assert load_tables({"a": spark.range(0), "b": spark.range(1000).repartition(7), "c": spark.createDataFrame([], "id long")}, "loads") == {"a": 0, "b": 1000, "c": 0}
    assert change_tables(spark, "loads") == {} and load_tables({}, "loads") == {}


def test_appends_and_a_replacement_together(spark, place):
    load_tables({"a": spark.range(2), "b": spark.range(1), "r": spark.range(1)}, "loads")
    append_tables({"a": spark.range(5, 7), "b": spark.range(9, 10)}, "loads", {"r": spark.range(3)})
    assert (ids(spark, "a"), ids(spark, "b"), ids(spark, "r")) == ([0, 1, 5, 6], [0, 9], [0, 1, 2])
    with pytest.raises(Exception, match="broken"):
        append_tables({"a": spark.range(8, 9)}, "loads", {"r": broken(spark)})
    with pytest.raises(Exception, match="broken"):
        append_tables({"b": spark.range(8, 9), "a": broken(spark)}, "loads")
    assert (ids(spark, "a"), ids(spark, "b"), ids(spark, "r")) == ([0, 1, 5, 6], [0, 9], [0, 1, 2])


def test_columns_unknown_to_a_table_go_to_review(spark, place):
    from clinloom import schemas as S
    from clinloom.plans.run import apply_validation

    extra = S.TARGETS["death"].add("note_nobody_fills", "string")
    load_tables({"death": spark.createDataFrame([], extra)}, "loads")
    kinds = "target_table string, source_row_id string, values map<string,string>, concept_bindings array<struct<field_name:string,concept_id:string,requires_standard:boolean,required_domain:string>>, start_date_field string, event_date_field string, person_id_field string, requires_existing_person boolean, uncertainty_reason string"
    rows = [("death", "r1", {"person_id": "1", "note_nobody_fills": "kept"}), ("death", "r2", {"person_id": "2", "unheard_of": "x"})]
    approved = spark.createDataFrame([(*r, [], None, None, None, True, None) for r in rows], kinds)
    empty = spark.createDataFrame([], "target_table string, source_row_id string, review_status string, review_reason string, payload_json string")
    assert apply_validation(spark, {"approved": approved, "review": empty}, "loads") == {"death": 1, S.REVIEW_TABLE: 1}
    assert [(r["person_id"], r["note_nobody_fills"]) for r in spark.table("loads.death").collect()] == [(1, "kept")]
    held = spark.table(f"loads.{S.REVIEW_TABLE}").head()
    assert held["source_row_id"] == "r2" and held["review_reason"] == "Columns not in the target table: unheard_of." and "unheard_of" in held["payload_json"]
    with pytest.raises(ValueError, match="Unknown target table: nowhere"):
        apply_validation(spark, {"approved": approved.withColumn("target_table", F.lit("nowhere")), "review": empty}, "loads")
    assert spark.table("loads.death").count() == 1


def test_later_rows_are_worked_out_one_table_after_another(spark):
    ensure_schema(spark, "later")
    order, rows = [], spark.range(3)

    def at(name, df=rows):
        return Later(rows.schema, lambda: order.append(name) or df)

    assert change_tables(spark, "later", replace={"b": at("b"), "a": at("a"), "now": rows}) == {"b": 3, "a": 3, "now": 3} and order == ["b", "a"]
    assert change_tables(spark, "later", replace={"b": at("b")}, append={"a": at("a")}) == {"b": 3, "a": 3} and spark.table("later.a").count() == 6

    def fails():
        raise ValueError("no rows")

    with pytest.raises(ValueError, match="no rows"):
        change_tables(spark, "later", replace={"b": at("b", spark.range(9)), "a": Later(rows.schema, fails)})
    assert spark.table("later.b").count() == 3 and spark.table("later.a").count() == 6
