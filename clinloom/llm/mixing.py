"""Mixing sources to target weights by Pareto order sampling.

Every document has an expected number of copies. Its whole part is allocated
for certain; the fraction is its inclusion probability in a sample of unequal
probabilities: documents are ranked by random odds over inclusion odds,
``u/(1-u) / (p/(1-p))``, and each source takes the first of its ranking until
its target in words is met. No source is sorted: a histogram of the ranking
value finds the bin in which a source's target falls, bins below it are taken
whole, and only that bin's documents are ranked one by one.

Null texts have size 0, the null source is a source of its own and comes last.
Equal ranks are ordered by id, size and text checksum; rows equal in all of
them are taken or left together. Empty tables give empty results. Other columns
of the input are left alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinloom.llm.common import small_side
from clinloom.staging import StageStore

#: Most copies of a document, and so the most a source can grow.
MAX_COPIES = 3
#: Inclusion weights are whole numbers from BASE_WEIGHT to twice that.
BASE_WEIGHT = 1000
BINS = 16384
SEED = 17
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def size_weight(size: Column) -> Column:
    """Longer documents are likelier to be repeated or kept: 1000 plus the words up to 1000."""
    return F.lit(BASE_WEIGHT) + F.least(size, F.lit(BASE_WEIGHT))


def source_targets(sizes: DataFrame, weights: Sequence[int]) -> DataFrame:
    """One row per source: its size, and its share of all words by weight.

    Weights follow the sources' code-point order, null last, and repeat. A
    target stops at three times the source's size; what is above goes to the
    others by weight. With the sources ordered by size over weight, the first
    ``k`` are at their limit, and ``k`` is the least number that leaves nobody
    above it. The input is one row per source, so one task orders them.
    """
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.lit(list(weights)), (F.col("_place") % len(weights) + 1).cast("int"))
    ranked = (
        per_source.withColumn("_place", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1)
        .withColumn("weight", weight.cast("long"))
        .withColumn("_all", F.sum("source_size").over(whole))
        .withColumn("_limit", MAX_COPIES * F.col("source_size"))
    )
    order = Window.orderBy(F.col("_limit") / F.col("weight"), "_place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    share = (F.col("_all") - F.coalesce(F.sum("_limit").over(before), F.lit(0))) / F.sum("weight").over(after)
    fits = F.when(F.col("_share") * F.col("weight") <= F.col("_limit"), F.col("_share"))
    return (
        ranked.withColumn("_share", share)
        .withColumn("_common", F.first(fits, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn("_common_from", F.min(F.when(fits.isNotNull(), F.col("_limit") / F.col("weight"))).over(whole))
        .withColumn(
            "target",
            F.when(F.col("_limit") / F.col("weight") >= F.col("_common_from"), F.col("_common") * F.col("weight")).otherwise(
                F.col("_limit").cast("double")
            ),
        )
        .select("source", "source_size", "weight", "target")
    )


def copy_rates(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source the rate: expected copies of a document are ``min(3, rate * weight)`` and fill the target.

    Worked out from the words of each weight: the heaviest weights are at the
    limit, and the largest weight that need not be decides the rate.
    """
    order = Window.partitionBy("source").orderBy(F.col("a").desc())
    per_weight = sizes.groupBy("source", "a").agg(F.sum("size").alias("words"))
    capped = F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum(F.col("words") * F.col("a")).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return (
        per_weight.withColumn("_capped", capped)
        .withColumn("_rest", rest)
        .join(targets, per_weight["source"].eqNullSafe(targets["source"]))
        .select(
            targets["*"],
            "a",
            F.when(F.col("_rest") > 0, (F.col("target") - MAX_COPIES * F.col("_capped")) / F.col("_rest")).alias("_rate"),
        )
        .filter(F.col("_rate") * F.col("a") <= MAX_COPIES)
        .groupBy("source", "source_size", "weight", "target")
        .agg(F.max_by("_rate", "a").alias("rate"))
    )


def measured(documents: DataFrame, seed: int = SEED) -> DataFrame:
    """The documents with a struct ``_mix_m``: size, inclusion weight, random number and text checksum."""
    number = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string"))), 1, 12), 16, 10).cast("long")
    size = word_count(F.col("text"))
    return documents.withColumn("_mix_size", size).withColumn(
        "_mix_m",
        F.struct(
            F.col("_mix_size").alias("size"),
            size_weight(F.col("_mix_size")).cast("long").alias("a"),
            ((number + 0.5) / float(2**48)).alias("u"),
            F.crc32("text").alias("tie"),
        ),
    ).drop("_mix_size")


def _ranked(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds a struct ``_mix_r``: the source's plan, whole copies, ranking value, bin and the whole order of the ranking."""
    side = plan.select(F.col("source").alias("_mix_source"), F.struct(*(c for c in plan.columns if c != "source")).alias("_mix_p"))
    expected = F.least(F.lit(float(MAX_COPIES)), F.coalesce("_mix_p.rate", F.lit(0.0)) * F.col("_mix_m.a"))
    p, u = F.col("_mix_e") - F.floor("_mix_e"), F.col("_mix_m.u")
    q = F.when(p > 0, u / (1 - u) * ((1 - p) / p))
    return (
        rows.join(side, F.col("source").eqNullSafe(F.col("_mix_source")), "left")
        .withColumn("_mix_e", expected)
        .withColumn("_mix_q", q)
        .withColumn(
            "_mix_r",
            F.struct(
                F.floor("_mix_e").alias("whole"),
                F.floor(F.col("_mix_q") / (1 + F.col("_mix_q")) * BINS).alias("bin"),
                F.struct(F.col("_mix_q").alias("q"), F.col("doc_id").alias("id"), F.col("_mix_m.size").alias("size"), F.col("_mix_m.tie").alias("tie")).alias("place"),
            ),
        )
        .drop("_mix_source", "_mix_e", "_mix_q")
    )


def mix_plan(documents: DataFrame, store: StageStore, weights: Sequence[int] = (1, 2, 3), seed: int = SEED) -> DataFrame:
    """One row per source: size, target, rate of copies, and the place in the ranking up to which it takes one more."""
    rows = store.save(measured(documents.select("doc_id", "source", "text"), seed).drop("text"), "mix-sizes")
    sizes = rows.select("source", "_mix_m.size", "_mix_m.a")
    targets = store.save(source_targets(sizes, weights), "mix-targets")
    rates = copy_rates(sizes, small_side(targets)).select(F.col("source").alias("_s"), "rate")
    plan = store.save(targets.join(rates, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s"), "mix-rates")
    ranked = _ranked(rows, small_side(plan)).select("source", "_mix_p.target", "_mix_r", F.col("_mix_m.size").alias("size"))
    # words each source still needs after the certain copies, and the bin of its ranking in which they end
    sums = ranked.groupBy("source", "target", F.col("_mix_r.bin").alias("bin")).agg(
        F.sum(F.col("size") * F.col("_mix_r.whole")).alias("certain"), F.sum("size").alias("words")
    )
    per_source = Window.partitionBy("source")
    earlier = per_source.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = (
        sums.withColumn("need", F.col("target") - F.sum("certain").over(per_source))
        .filter(F.col("bin").isNotNull())
        .withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
        .withColumn("_inside", F.when(F.col("before") + F.col("words") >= F.col("need"), F.col("bin")))
    )
    edges = bins.groupBy(F.col("source").alias("_s")).agg(
        F.coalesce(F.min("_inside"), F.lit(BINS)).alias("edge"), F.first("need").alias("need"), F.min_by("before", "_inside").alias("edge_before")
    )
    edges = store.save(edges, "mix-edges")
    within = Window.partitionBy("source").orderBy("_mix_r.place").rowsBetween(Window.unboundedPreceding, -1)
    inside = (
        ranked.join(small_side(edges), F.col("source").eqNullSafe(F.col("_s")))
        .filter(F.col("_mix_r.bin") == F.col("edge"))
        .withColumn("_before", F.col("edge_before") + F.coalesce(F.sum("size").over(within), F.lit(0)))
        .filter(2 * F.col("_before") + F.col("size") <= 2 * F.col("need"))
        .groupBy(F.col("source").alias("_t"))
        .agg(F.max("_mix_r.place").alias("cut"))
    )
    found = plan.join(edges.select("_s", "edge"), F.col("source").eqNullSafe(F.col("_s")), "left")
    return store.save(found.join(inside, F.col("source").eqNullSafe(F.col("_t")), "left").drop("_s", "_t"), "mix-plan")


def with_copies(documents: DataFrame, plan: DataFrame, seed: int = SEED) -> DataFrame:
    """The documents with a struct ``_mix``: size, source_size, target, copies and taken words.

    A document's copies follow from its own row and its source's plan, so no text is shuffled.
    """
    ranked = _ranked(measured(documents, seed), small_side(plan))
    place, cut, bin_ = F.col("_mix_r.place"), F.col("_mix_p.cut"), F.col("_mix_r.bin")
    extra = F.coalesce((bin_ < F.col("_mix_p.edge")) | ((bin_ == F.col("_mix_p.edge")) & cut.isNotNull() & (place <= cut)), F.lit(False))
    copies = (F.col("_mix_r.whole") + extra.cast("long")).cast("long")
    mix = F.struct(
        F.col("_mix_m.size").alias("size"), F.col("_mix_p.source_size").alias("source_size"), F.col("_mix_p.target").alias("target"),
        copies.alias("copies"), (F.col("_mix_m.size") * copies).alias("taken"),
    )
    return ranked.withColumn("_mix", mix).drop("_mix_m", "_mix_p", "_mix_r")


def repeated(documents: DataFrame, plan: DataFrame, seed: int = SEED) -> DataFrame:
    """Every document as many times as the mix takes it, with the columns it had."""
    copies = F.array_repeat(F.lit(0), F.col("_mix.copies").cast("int"))
    return with_copies(documents, plan, seed).withColumn("_mix_copy", F.explode(copies)).select(*documents.columns)
