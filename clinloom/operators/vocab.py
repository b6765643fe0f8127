"""Source code to concept lookups."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from threading import Lock

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.functions.text import code_key, col, has_code
from clinloom.operators.lookups import fits, lookup_side, spread
from clinloom.schemas import NO_MATCH, REQUIRED_VOCABULARIES
from clinloom.staging import StageStore

DIAGNOSES = tuple(f"DIAGNOSIS{n}" for n in range(1, 9))

# (source table, columns, vocabulary of their codes)
CODE_COLUMNS = (
    ("conditions", ("CODE",), "SNOMED"),
    ("procedures", ("CODE",), "SNOMED"),
    ("devices", ("CODE",), "SNOMED"),
    ("supplies", ("CODE",), "SNOMED"),
    ("careplans", ("CODE",), "SNOMED"),
    ("imaging_studies", ("PROCEDURE_CODE",), "SNOMED"),
    ("allergies", ("CODE",), "SNOMED"),
    ("claims", DIAGNOSES, "SNOMED"),
    ("medications", ("CODE",), "RxNorm"),
    ("observations", ("CODE",), "LOINC"),
    ("observations", ("UNITS",), "UCUM"),
    ("immunizations", ("CODE",), "CVX"),
)


def unpivot_diagnoses(claims: DataFrame, *keep: str) -> DataFrame:
    """One row per filled diagnosis slot, with its slot number ``'1'`` to ``'8'``."""
    slots = F.array(
        *(F.struct(F.lit(str(n)).alias("slot_number"), F.col(c).alias("code")) for n, c in enumerate(DIAGNOSES, 1))
    )
    filled = F.filter(slots, lambda slot: has_code(slot["code"]))
    return claims.select(*keep, F.inline(filled))


def concept_keys(sources: Mapping[str, DataFrame]) -> DataFrame:
    """The distinct (vocabulary, code) pairs used by the source tables."""

    def codes(table: str, columns: tuple[str, ...], vocabulary: str) -> DataFrame:
        values = F.array(*(code_key(c) for c in columns))
        return sources[table].select(
            F.lit(vocabulary).alias("vocabulary_id"),
            F.explode(F.filter(values, lambda v: v != "")).alias("code"),
        )

    return reduce(DataFrame.unionByName, (codes(*entry) for entry in CODE_COLUMNS)).distinct()


def _rank(standard):
    return F.when(standard == "S", 0).otherwise(1)


def source_matches(concept: DataFrame) -> DataFrame:
    """The best valid concept per (vocabulary, code): standard first, then lowest id."""
    best = F.min(F.struct(_rank(F.col("standard_concept")).alias("rank"), "concept_id", "standard_concept", "domain_id"))
    return (
        concept.where(F.col("invalid_reason").isNull())
        .groupBy("vocabulary_id", F.col("concept_code").alias("code"))
        .agg(best.alias("m"))
        .select("vocabulary_id", "code", "m.concept_id", "m.standard_concept", "m.domain_id")
    )


def mapped_matches(concept: DataFrame, relationship: DataFrame) -> DataFrame:
    """The best valid ``Maps to`` target per concept: standard first, but not only standard."""
    links = relationship.where(
        (F.col("relationship_id") == "Maps to") & F.col("invalid_reason").isNull()
    ).select("concept_id_1", F.col("concept_id_2").alias("concept_id"))
    targets = concept.where(F.col("invalid_reason").isNull()).select("concept_id", "standard_concept", "domain_id")
    best = F.min(F.struct(_rank(F.col("standard_concept")).alias("rank"), "concept_id", "domain_id", "standard_concept"))
    return (
        links.join(targets, "concept_id")
        .groupBy("concept_id_1")
        .agg(best.alias("t"))
        .select(
            F.col("concept_id_1").alias("source_concept_id"),
            F.col("t.concept_id").alias("mapped_concept_id"),
            F.col("t.domain_id").alias("mapped_domain_id"),
            F.col("t.standard_concept").alias("mapped_standard_concept"),
        )
    )


def concept_lookup(concept: DataFrame, relationship: DataFrame) -> DataFrame:
    """Every vocabulary code with its source and standard concept.

    It depends on the vocabulary alone, so its size does not follow the
    extracts and fact tables need no second scan to collect their codes.
    """
    wanted = concept.where(F.col("vocabulary_id").isin(*REQUIRED_VOCABULARIES))
    matches = source_matches(wanted).withColumnRenamed("concept_id", "source_concept_id")
    joined = matches.join(mapped_matches(concept, relationship), "source_concept_id", "left")
    standard = F.col("standard_concept") == "S"
    return joined.select(
        "vocabulary_id",
        "code",
        "source_concept_id",
        F.coalesce(F.when(standard, F.col("source_concept_id")), "mapped_concept_id", F.lit(NO_MATCH)).alias("standard_concept_id"),
        F.coalesce(F.when(standard, F.col("domain_id")), "mapped_domain_id", F.lit("")).alias("standard_domain_id"),
    )


def concept_map(keys: DataFrame, lookup: DataFrame) -> DataFrame:
    """The lookup for the codes in use; codes without a concept get 0."""
    return keys.join(lookup, ["vocabulary_id", "code"], "left").select(
        "vocabulary_id",
        "code",
        F.coalesce("source_concept_id", F.lit(NO_MATCH)).alias("source_concept_id"),
        F.coalesce("standard_concept_id", F.lit(NO_MATCH)).alias("standard_concept_id"),
        F.coalesce("standard_domain_id", F.lit("")).alias("standard_domain_id"),
    )


class ConceptSides:
    """The concept lookup by vocabulary, each side judged by its own size.

    A vocabulary that is too large to send to the executors is cut down to the
    codes in use, and sent if those fit.
    """

    def __init__(self, lookup: DataFrame, keys: Callable[[], DataFrame], store: StageStore):
        """``lookup`` and the table of ``keys`` (vocabulary, code), if it is asked for, are written tables."""
        self.lookup, self.keys, self.store = lookup, keys, store
        # one row per vocabulary
        self.rows = {r["vocabulary_id"]: r["count"] for r in lookup.groupBy("vocabulary_id").count().collect()}
        self.sides: dict[str, DataFrame] = {}
        self.lock = Lock()

    def __getitem__(self, vocabulary: str) -> DataFrame:
        with self.lock:
            if vocabulary not in self.sides:
                side, rows = self.lookup.where(F.col("vocabulary_id") == vocabulary), self.rows.get(vocabulary, 0)
                if not fits(side, rows):
                    used = self.keys().where(F.col("vocabulary_id") == vocabulary).select("code")
                    side = self.store.save(side.join(used, "code", "left_semi"), f"lookup-{vocabulary}")
                    rows = side.count()
                self.sides[vocabulary] = lookup_side(side, rows)
            return self.sides[vocabulary]


def join_concept(
    facts: DataFrame, lookup: Mapping[str, DataFrame] | ConceptSides, vocabulary: str, code: str, prefix: str = ""
) -> DataFrame:
    """Left join of the lookup of one vocabulary; adds ``<prefix>source_concept_id`` and so on."""
    names = ("source_concept_id", "standard_concept_id", "standard_domain_id")
    side = lookup[vocabulary].select(F.col("code").alias("_code"), *(F.col(n).alias(prefix + n) for n in names))
    key = spread(F.nullif(code_key(col(code)), F.lit("")), *facts.columns[:4])
    joined = facts.withColumn("_key", key).join(side, F.col("_key") == F.col("_code"), "left")
    return (
        joined.drop("_key", "_code")
        .withColumn(prefix + names[0], F.coalesce(prefix + names[0], F.lit(NO_MATCH)))
        .withColumn(prefix + names[1], F.coalesce(prefix + names[1], F.lit(NO_MATCH)))
    )


def vocabulary_counts(concept: DataFrame) -> DataFrame:
    return concept.groupBy("vocabulary_id").agg(F.count("*").alias("concept_count"))


def vocabulary_check(concept: DataFrame) -> DataFrame:
    """The required vocabularies, each loaded or empty."""
    spark = concept.sparkSession
    required = spark.createDataFrame([(v,) for v in REQUIRED_VOCABULARIES], "vocabulary_id string")
    counts = vocabulary_counts(concept.where(F.col("vocabulary_id").isin(*REQUIRED_VOCABULARIES)))
    joined = required.join(counts, "vocabulary_id", "left")
    count = F.coalesce("concept_count", F.lit(0))
    return joined.select(
        "vocabulary_id", count.alias("concept_count"), F.when(count > 0, "loaded").otherwise("empty").alias("status")
    )


def payer_concepts(concept: DataFrame) -> DataFrame:
    """Lowest valid Payer concept per name."""
    return (
        concept.where((F.col("vocabulary_id") == "Payer") & F.col("invalid_reason").isNull())
        .groupBy(F.col("concept_name"))
        .agg(F.min("concept_id").alias("payer_concept_id"))
    )
