"""The corpus pipeline: toxicity, near duplicates, benchmark leaks, mixing, sharding.

Each stage takes what the one before it kept and passes the columns of
``documents`` on; the last returns each document's shard. ``run`` writes every
stage's rows to the shared folder and reads them back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinloom.llm import jaccard, labelled, mixing, sharding, templates, toxicity
from clinloom.llm.common import new_store, release_executors, small_side, table

#: Documents scored at least so are rejected.
TOXIC_SCORE = 0.7
SHARDS = 16


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the score stay, null and empty texts too. The model learns from the labels of the documents of this input.

    Rows are judged one by one, whatever their ids; a label of a repeated id
    holds for the smallest of its texts. Without labels of both kinds all stay.
    """
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), labelled.fold(F.col("doc_id"), 3) != 1)
    return toxicity.below(docs, model, TOXIC_SCORE)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays: that of the smallest id (a null id is the largest), then of the smallest text hash.

    Rows are told apart by numbers of their own, so null and repeated ids are
    safe: a row only goes if a near copy of its own text stays. Rows that
    repeat id and text are copies. Texts without words are linked with nothing
    and stay, all of them. No rows give no rows.
    """
    store = new_store(spark)
    rows = store.save(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    groups = jaccard.near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"), store)
    groups = store.save(groups.select(F.col("doc_id").alias("_copy"), F.col("component_id").alias("_group")), "groups")
    shared = groups.groupBy("_group").count().filter("count > 1").select("_group")  # most rows are alone and stay
    copies = groups.join(shared, "_group").join(rows.select("_row", "doc_id", F.xxhash64("text").alias("_text")), F.col("_copy") == F.col("_row"))
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "_text", "_copy")
    stays = copies.groupBy("_group").agg(F.min(place).getField("_copy").alias("_stays"))
    gone = store.save(copies.select("_copy", "_group").join(stays, "_group").filter("_copy <> _stays").select("_copy"), "gone")
    release_executors(spark)
    return rows.join(small_side(gone), F.col("_row") == F.col("_copy"), "left_anti").drop("_row")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or a long run of one, go; null and empty texts stay.

    Rows of a repeated id, the null id too, are judged together and go together.
    """
    store = new_store(spark)
    found = store.save(templates.contaminated(docs, table(spark, sf_dir, "benchmark"), store), "leaks")
    return templates.without_contaminated(docs, found)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it, at most three times; null texts have no words and a null source is a source.

    Rows equal in id, size and text are taken or left together.
    """
    return mixing.repeated(docs, mixing.mix_plan(docs, new_store(spark)))


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row's shard and its place there; null texts weigh one byte, and rows that repeat have places of their own."""
    return sharding.kd_shards(docs, new_store(spark), shards=SHARDS, copies_together=True)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near duplicates", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources", mixing_stage),
    ("sharding", sharding_stage),
]

#: The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, store = table(spark, sf_dir, "documents"), new_store(spark)
    for name, stage in STAGES:
        docs = store.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
