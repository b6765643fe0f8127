"""Line de-duplication by winnowing over line hashes.

Windows of two consecutive line hashes each select their least one (the
last of equals). Equal runs of two lines or more hold a whole window, so
they select the same lines: those are their fingerprints, stored with their
positions. Positions of one fingerprint are matched where they also agree when
they are extended to both sides, as far as the windows that selected them reach;
the next line of a longer match lies in a window with a fingerprint of its own,
which is extended in turn. Matches are not listed in pairs: extended positions
that agree are grouped, the first by (document id, text hash, place) stays, and
the lines of all later ones are deleted. So a line goes if it lies in a run of
two lines or more that also begins earlier. With ``alone``, a line of that many
words or more is a fingerprint by itself and goes if an equal line stands
earlier, whatever its neighbours. Matches are judged on the input, not on what
is left.

Null and empty texts, and texts of fewer lines, lose nothing. A null id comes
first. Different texts under one id are documents of their own, in the order of
their hashes; rows that repeat id and text are one document and lose the same
lines. Empty tables give no rows. Other columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.staging import StageStore

#: Words from which a line is long enough to go without its neighbours.
ALONE_WORDS = 8
WORD = r"[^\x20\x09-\x0D]+"


def line_hashes(documents: DataFrame) -> DataFrame:
    """doc_id, text_key (a hash of the text), the lines and their hashes."""
    lines = F.split("text", "\n", -1)
    return documents.filter(F.col("text").isNotNull()).select(
        "doc_id", F.xxhash64("text").alias("text_key"), lines.alias("lines"), F.transform(lines, lambda x: F.xxhash64(x)).alias("h")
    )


def selected(documents: DataFrame, alone: int | None = None) -> DataFrame:
    """Every selected position: its document, place and fingerprint, and the lines before and after it where their window selected it."""
    h, lines = F.col("h"), F.col("lines")

    def position(value, i):
        before, after = F.get(h, i - 1), F.get(h, i + 1)
        long = F.lit(False) if alone is None else F.regexp_count(F.get(lines, i), F.lit(WORD)) >= alone
        return F.struct(
            i.cast("int").alias("at"), value.alias("fp"),
            F.when(value <= before, before).alias("before"), F.when(value < after, after).alias("after"), F.coalesce(long, F.lit(False)).alias("alone"),
        )

    chosen = F.filter(F.transform(h, position), lambda p: p["before"].isNotNull() | p["after"].isNotNull() | p["alone"])
    hashed = line_hashes(documents).select("doc_id", "text_key", F.size(h).alias("n_lines"), F.explode(chosen).alias("p"))
    return hashed.select("doc_id", "text_key", "n_lines", "p.*")


def extended(positions: DataFrame) -> DataFrame:
    """Each position as the runs it stands for: with the line before it, with the line after it, and by itself if it is long."""
    runs = F.array(
        F.when(F.col("before").isNotNull(), F.struct(F.lit(-1).alias("side"), F.col("before").alias("next"), (F.col("at") - 1).alias("start"), F.lit(2).alias("height"))),
        F.when(F.col("after").isNotNull(), F.struct(F.lit(1).alias("side"), F.col("after").alias("next"), F.col("at").alias("start"), F.lit(2).alias("height"))),
        F.when(F.col("alone"), F.struct(F.lit(0).alias("side"), F.lit(0).cast("long").alias("next"), F.col("at").alias("start"), F.lit(1).alias("height"))),
    )
    each = positions.select("doc_id", "text_key", "n_lines", "fp", F.explode(F.filter(runs, lambda r: r.isNotNull())).alias("r"))
    return each.select("doc_id", "text_key", "n_lines", "fp", "r.*")


def repeated_lines(documents: DataFrame, store: StageStore, alone: int | None = None) -> DataFrame:
    """doc_id, text_key, n_lines, n_removed and the numbers (from 0) of the lines to delete, for documents that lose any."""
    positions = store.save(selected(documents.select("doc_id", "text"), alone), "line-positions")
    runs, place = extended(positions), F.struct("doc_id", "text_key", "start")
    # partially aggregated, so a line that stands everywhere gives one row a task
    places = runs.groupBy("fp", "side", "next").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    repeated = store.save(places.filter(~F.col("first").eqNullSafe(F.col("last"))).drop("last"), "line-matches")
    later = runs.join(repeated, ["fp", "side", "next"]).filter(~place.eqNullSafe(F.col("first")))
    covered = F.array_distinct(F.flatten(F.transform("runs", lambda s: F.sequence(s["start"], s["start"] + s["height"] - 1))))
    return (
        later.groupBy("doc_id", "text_key")
        .agg(F.max("n_lines").alias("n_lines"), F.collect_set(F.struct("start", "height")).alias("runs"))
        .select("doc_id", "text_key", "n_lines", F.sort_array(covered).alias("removed"))
        .select("doc_id", "text_key", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")
    )


def without_lines(documents: DataFrame, removed: DataFrame) -> DataFrame:
    """The documents with those lines deleted; all their columns stay."""
    gone = removed.select(F.col("doc_id").alias("_lines_id"), F.col("text_key").alias("_lines_text"), F.col("removed").alias("_lines_gone"))
    lines = F.split("text", "\n", -1)
    kept = F.filter(lines, lambda _, i: ~F.array_contains("_lines_gone", i))
    same = F.col("doc_id").eqNullSafe(F.col("_lines_id")) & (F.xxhash64("text") == F.col("_lines_text"))
    return (
        documents.join(gone, same, "left")
        .withColumn("text", F.when(F.col("_lines_gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")))
        .drop("_lines_id", "_lines_text", "_lines_gone")
    )
