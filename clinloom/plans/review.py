"""Review rows: staged rows that failed a rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom import schemas as S


def review_rows(stage: DataFrame, table: str, number: Column | None) -> DataFrame:
    """The held rows of one stage. ``number`` names rows whose own id is NULL."""
    own = F.col("source_row_id")
    if number is not None:
        own = F.coalesce(own, F.concat(F.lit(f"synthea:review:{table}:"), number.cast("string")))
    held = stage.where(F.col("review_reason").isNotNull()).select(own.alias("source_row_id"), "review_reason")
    payload = F.struct(F.lit(S.REVIEW_STAGE_LABEL[table]).alias("stage_table"), F.col("source_row_id"))
    return held.select(
        F.lit(table).alias("target_table"),
        "source_row_id",
        F.lit("review").alias("review_status"),
        "review_reason",
        F.to_json(payload).alias("payload_json"),
    )
