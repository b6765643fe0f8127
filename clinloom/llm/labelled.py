"""A bounded sample of labelled rows, the same on every run, for fitting a model in one task."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import give_back, small_batches

#: Bounds of what a model is fitted on: rows of each label, and bytes of one text.
ROWS_PER_LABEL = 3000
TEXT_BYTES = 32 << 10


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % folds


def usable_labels(labels: DataFrame, label: str, learn: Column) -> DataFrame:
    """doc_id and y of the labels that may be used; an id labelled both ways is not."""
    return (
        labels.filter(learn & F.col(label).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min(label).alias("y"), F.max(label).alias("_y"))
        .filter("y = _y")
        .select("doc_id", F.col("y").cast("int").alias("y"), F.xxhash64("doc_id", F.lit(label)).alias("_order"))
    )


def sample(documents: DataFrame, known: DataFrame, rows: int = ROWS_PER_LABEL) -> DataFrame:
    """(y, text) of at most ``rows`` documents of each label, picked by a hash of their ids; of repeated ids the smallest text."""
    picked = known.filter("y = 0").orderBy("_order").limit(rows).unionByName(known.filter("y = 1").orderBy("_order").limit(rows))
    fits = documents.select("doc_id", "text").filter(F.octet_length("text").between(1, TEXT_BYTES))
    return fits.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "y", "_order").agg(F.min("text").alias("text")).select("y", "_order", "text")


def fit(
    documents: DataFrame, labels: DataFrame, label: str, learn: Column, train: Callable[[list[int], list[str], dict[int, int]], bytes]
) -> bytes:
    """The model that ``train`` makes, in one task, of the sample and the number of rows of each label.

    ``learn`` says, from doc_id, which labels may be used.
    """
    small_batches(documents.sparkSession)
    known = usable_labels(labels, label, learn)
    counts = {row["y"]: row["count"] for row in known.groupBy("y").count().collect()}

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("_order", "ascending"), ("y", "ascending")])
        model = train(group["y"].to_pylist(), group["text"].to_pylist(), counts)
        give_back()
        return pa.table({"model": [model]}, schema=pa.schema([("model", pa.binary())]))

    found = sample(documents, known).groupBy(F.lit(1).alias("all")).applyInArrow(run, "model binary").first()
    return bytes(found["model"]) if found else train([], [], counts)
