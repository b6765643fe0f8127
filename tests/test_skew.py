"""Large, skewed join sides: same result without broadcasts, and hot keys are split."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clinloom import schemas as S
from clinloom.operators import lookups
from clinloom.plans import facts
from clinloom.plans.build import CdmBuild

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.shuffle.partitions": "8",
}


def skewed_build(spark):
    """A third of the facts on one patient and encounter, another third without an encounter, one hot code."""
    def empty(name):
        return spark.createDataFrame([], S.SOURCES[name])

    tables = {name: empty(name) for name in S.SOURCE_TABLES}
    ids = spark.range(200, numPartitions=4)
    tables["patients"] = ids.select(F.concat(F.lit("p"), "id").alias("Id"), F.lit(dt.date(1990, 1, 1)).alias("BIRTHDATE"),
                                    *(F.lit(None).cast(f.dataType).alias(f.name) for f in S.SOURCES["patients"].fields[2:]))
    visit = {"Id": F.concat(F.lit("e"), "id"), "START": F.lit(dt.datetime(2020, 1, 1)), "PATIENT": F.concat(F.lit("p"), "id"), "ENCOUNTERCLASS": F.lit("wellness")}
    tables["encounters"] = ids.select(*(visit.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in S.SOURCES["encounters"].fields))
    n = F.col("id")
    tables["conditions"] = spark.range(30_000, numPartitions=6).select(
        F.date_add(F.lit(dt.date(2020, 1, 1)), (n % 400).cast("int")).alias("START"),
        F.lit(None).cast("date").alias("STOP"),
        F.concat(F.lit("p"), F.when(n % 3 == 0, 7).otherwise(n % 200)).alias("PATIENT"),
        F.when(n % 3 != 1, F.concat(F.lit("e"), F.when(n % 3 == 0, 7).otherwise(n % 200))).alias("ENCOUNTER"),
        F.concat(F.lit("c"), F.when(n % 2 == 0, 0).otherwise(n % 500)).alias("CODE"),
        F.col("id").cast("string").alias("DESCRIPTION"),
    )
    concept = spark.range(400).select(
        F.col("id").cast("int").alias("concept_id"), F.lit("n").alias("concept_name"), F.lit("Condition").alias("domain_id"), F.lit("SNOMED").alias("vocabulary_id"),
        F.lit("S").alias("standard_concept"), F.concat(F.lit("c"), F.col("id") - 1).alias("concept_code"), F.lit(None).cast("string").alias("invalid_reason"))
    links = spark.createDataFrame([], "concept_id_1 int, concept_id_2 int, relationship_id string, invalid_reason string")
    return CdmBuild(tables, concept, links, F.lit("2024-01-01").cast("date"))


@pytest.fixture()
def large_sides(spark, monkeypatch):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    monkeypatch.setattr(lookups, "BROADCAST_LIMIT_BYTES", 0)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_hot_keys_are_split_and_nothing_changes(spark, large_sides, monkeypatch):
    build = skewed_build(spark)
    stage = facts.condition_stage(build.sources["conditions"], build.sources["claims"], build.links)
    stage.write.format("noop").mode("overwrite").save()
    joined = build.links.join(build.sources["conditions"])
    rows = joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == 30_000
    assert "SortMergeJoin(skew=true)" in plan and "BroadcastHashJoin" not in plan

    monkeypatch.setattr(lookups, "BROADCAST_LIMIT_BYTES", 1 << 30)
    plain = skewed_build(spark).table("condition_occurrence")
    large = build.table("condition_occurrence")
    assert large.count() == plain.count() > 0
    assert large.exceptAll(plain).count() == 0


def test_staged_sources_are_pruned_and_filtered_at_the_scan(spark, large_sides):
    build = skewed_build(spark)
    conditions = build.store.save(build.sources["conditions"], "conditions")
    claims = build.store.save(build.sources["claims"], "claims")
    plan = facts.condition_stage(conditions, claims, build.links)._jdf.queryExecution().toString()
    scans = [line for line in plan.split("== Physical Plan ==")[1].splitlines() if "FileScan parquet" in line]
    of_conditions = next(line for line in scans if "DESCRIPTION" in line or "CODE#" in line)
    assert "DESCRIPTION" not in of_conditions.split("ReadSchema")[1]
    assert "IsNotNull(PATIENT)" in of_conditions


def test_large_vocabularies_are_cut_to_the_codes_in_use(spark, store):
    from clinloom.operators import vocab

    n = F.col("id")
    lookup = spark.range(2_000_000, numPartitions=4).select(
        F.when(n < 500, "UCUM").otherwise("LOINC").alias("vocabulary_id"), F.concat(F.lit("c"), n).alias("code"),
        n.cast("int").alias("source_concept_id"), n.cast("int").alias("standard_concept_id"), F.lit("Measurement").alias("standard_domain_id"),
    )
    keys = spark.range(600, 900).select(F.lit("LOINC").alias("vocabulary_id"), F.concat(F.lit("c"), n).alias("code"))
    sides = vocab.ConceptSides(store.save(lookup, "lookup"), lambda: keys, store)
    facts_ = spark.range(10_000).select(
        "id", F.concat(F.lit("c"), n % 300 + 600).alias("CODE"), F.when(n % 2 == 0, F.concat(F.lit("c"), n % 20)).alias("UNITS"),
        F.lit("a").alias("A"), F.lit("b").alias("B"),
    )
    joined = vocab.join_concept(vocab.join_concept(facts_, sides, "LOINC", "CODE"), sides, "UCUM", "UNITS", prefix="unit_")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "Exchange hashpartitioning" not in plan
    totals = joined.agg(F.count_if(F.col("standard_concept_id") >= 600), F.count_if(F.col("unit_standard_concept_id") > 0), F.count("*")).first()
    assert tuple(totals) == (10_000, 4_500, 10_000)


def test_null_keys_are_spread(spark):
    df = spark.range(1000).select(lookups.spread(F.lit(None).cast("string"), "id").alias("k"))
    assert df.distinct().count() > 500
    assert spark.range(1).select(lookups.spread(F.lit("x"), "id").alias("k")).head()["k"] == "x"
