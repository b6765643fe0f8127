"""Mixing and sharding: targets, whole copies, gapless slots; odd and empty tables."""

import re
from collections import defaultdict

from clinloom.llm import mixing, sharding
from clinloom.llm.common import new_store


def water(sizes: dict, weights=(1, 2, 3)) -> dict:
    """Shares by weight, nobody above three times its size, worked out round by round."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    while open_:
        rest = sum(sizes.values()) - sum(target.values())
        share = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if share * weight[s] > 3 * sizes[s]}
        if not full:
            return target | {s: share * weight[s] for s in open_}
        target |= {s: 3.0 * sizes[s] for s in full}
        open_ -= full
    return target


def check_mix(spark, df):
    mixed = mixing.with_copies(df, mixing.mix_plan(df, new_store(spark))).select("doc_id", "source", "text", "_mix.*").collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for row in mixed:
        assert row["size"] == len(re.findall("[^\x20\x09-\x0d]+", row["text"] or ""))
        assert 0 <= row["taken"] <= 3 * row["size"] and row["taken"] == row["size"] * row["copies"]
        sizes[row["source"]] += row["size"]
        taken[row["source"]] += row["taken"]
    targets = water(sizes)
    largest = defaultdict(int)
    for row in mixed:
        assert row["source_size"] == sizes[row["source"]]
        assert abs(row["target"] - targets[row["source"]]) < 1e-6
        largest[row["source"]] = max(largest[row["source"]], row["size"])
    return targets, taken, largest, sorted(map(str, mixed))


def test_odd_rows_are_mixed(spark, odd):
    targets, taken, largest, rows = check_mix(spark, odd)
    assert len(rows) == odd.count()
    for source in targets:
        assert abs(taken[source] - targets[source]) <= largest[source]
    assert rows == check_mix(spark, odd.repartition(5))[3]  # the same on another layout


def test_targets_are_met_closely(spark):
    rows = [(i, "w " * (1 + i * 7919 % 90), f"s{i % 4}" if i % 5 else "hot") for i in range(4000)]
    targets, taken, largest, _ = check_mix(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"))
    for source in targets:
        assert abs(taken[source] - targets[source]) <= largest[source]


def test_targets_stop_at_three_times_the_size(spark):
    rows = [(i, "w " * 50, "a") for i in range(99)] + [(200, "w w w", "b"), (201, "w", "c")]
    targets, taken, *_ = check_mix(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert (taken["b"], taken["c"], targets["b"]) == (9, 3, 9.0)


def test_longer_documents_are_likelier(spark):
    rows = [(i, "w " * (900 if i % 2 else 10), "a" if i < 4000 else "b") for i in range(8000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.with_copies(df, mixing.mix_plan(df, new_store(spark))).filter("source = 'a'").select("_mix.*").collect()
    long_, short = ([r["copies"] for r in mixed if (r["size"] > 500) == big] for big in (True, False))
    # weights 1900 and 1010: expected copies are in that proportion
    assert abs((sum(long_) / len(long_)) / (sum(short) / len(short)) - 1900 / 1010) < 0.15


def test_repeated_rows_keep_their_columns(spark, odd, nothing):
    plan = mixing.mix_plan(odd, new_store(spark))
    out = mixing.repeated(odd, plan)
    assert out.columns == odd.columns
    assert out.count() == mixing.with_copies(odd, plan).selectExpr("sum(_mix.copies)").first()[0]
    assert mixing.repeated(nothing, mixing.mix_plan(nothing, new_store(spark))).collect() == []


def shards_of(spark, df, **how):
    rows = sharding.kd_shards(df, new_store(spark), **how).collect()
    slots = defaultdict(list)
    for row in rows:
        slots[row["shard"]].append(row["slot"])
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))
    return rows


def test_odd_rows_are_sharded(spark, odd, nothing):
    rows = shards_of(spark, odd, shards=4)
    assert len(rows) == odd.count() and {r["shard"] for r in rows} <= set(range(4))
    sizes = {(r["doc_id"], r["size"]) for r in rows}
    assert {(4, 1), (5, 1), (7, 8)} <= sizes
    assert shards_of(spark, nothing, shards=4) == []
    assert shards_of(spark, nothing, shards=4, copies_together=True) == []
    together = shards_of(spark, odd, shards=4, copies_together=True)
    assert sorted((str(r["doc_id"]), r["size"]) for r in together) == sorted((str(r["doc_id"]), r["size"]) for r in rows)
    assert sorted(map(str, together)) == sorted(map(str, shards_of(spark, odd.repartition(7), shards=4, copies_together=True)))
    assert sorted(map(str, rows)) == sorted(map(str, shards_of(spark, odd.repartition(7), shards=4)))


def test_leaves_are_even_and_reach_the_target(spark):
    rows = [(i, "x" * (i * 31 % 200), "hot" if i % 3 == 0 else f"s{i % 7}", "en") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    total = sum(len(t) + 1 for _, t, _, _ in rows)
    placed = shards_of(spark, df, target_bytes=total / 9)
    per_shard = defaultdict(int)
    for row in placed:
        per_shard[row["shard"]] += row["size"]
    assert len(per_shard) == 16 and max(per_shard.values()) - min(per_shard.values()) <= 4 * 201


def test_ties_in_every_dimension_are_split(spark):
    df = spark.createDataFrame([(i, "same text", "s", "en") for i in range(1000)], "doc_id long, text string, source string, lang string")
    per_shard = defaultdict(int)
    for row in shards_of(spark, df, shards=4):
        per_shard[row["shard"]] += 1
    assert sorted(per_shard) == [0, 1, 2, 3] and max(per_shard.values()) <= 270


def plain_tree(points: list, depth: int, spans: list) -> list:
    """The leaves of the tree, cut one node after another: lists of rows."""
    if not depth or not points:
        return [points] if not depth else [[]] * (1 << depth)
    widths = [(max(p[f"k{d}"] >> 32 for p in points) - min(p[f"k{d}"] >> 32 for p in points)) / spans[d] for d in range(3)]
    key = f"k{max(range(3), key=lambda d: (widths[d], -d))}"
    weights = defaultdict(int)
    for p in points:
        weights[p[key]] += p["size"]
    below, half = 0, sum(weights.values()) / 2
    for cut in sorted(weights):
        if below + weights[cut] >= half:
            break
        below += weights[cut]
    upto = cut if below + weights[cut] - half <= half - below else cut - 1
    sides = [p for p in points if p[key] <= upto], [p for p in points if p[key] > upto]
    return [leaf for side in sides for leaf in plain_tree(side, depth - 1, spans)]


def copied(spark):
    """Copies of a text in several sources and languages; one text with a quarter of all bytes, null and empty texts."""
    rows = [(i, f"text {i // 3} " + "x" * (i // 3 * 37 % 90), f"s{i % 5}", f"l{i % 2}") for i in range(1500)]
    rows += [(9000 + i, "y" * 80, f"s{i % 5}" if i % 9 else None, "l0") for i in range(450)]
    rows += [(None, None, "s1", None), (None, None, "s2", "l1"), (7, "", None, "l1"), (7, "", "s3", "l0")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")


def test_tree_is_that_of_sorted_nodes(spark):
    store, df = new_store(spark), copied(spark)
    rows = sharding.document_rows(df)
    total = rows.selectExpr("sum(size)").first()[0]
    points = sharding.document_points(rows, store, total / 8, True).collect()
    spans = [max(1, max(r[f"v{d}"] for r in rows.collect()) - min(r[f"v{d}"] for r in rows.collect())) for d in range(3)]
    leaves = [sorted((str(p["doc_id"]), p["size"], p["text_crc32"] or 0) for p in leaf) for leaf in plain_tree(points, 3, spans)]
    found = defaultdict(list)
    for r in shards_of(spark, df, shards=8, copies_together=True):
        found[r["shard"]].append((str(r["doc_id"]), r["size"], r["text_crc32"] or 0))
    assert [sorted(found[i]) for i in range(8)] == leaves


def test_copies_lie_in_one_leaf(spark):
    df = copied(spark)
    placed = shards_of(spark, df, shards=8, copies_together=True)
    leaf = sum(r["size"] for r in placed) / 8
    where, weight = defaultdict(set), defaultdict(int)
    for r in placed:
        where[r["text_crc32"]].add(r["shard"])
        weight[r["text_crc32"]] += r["size"]
    assert len(where) < len(placed) / 2 and {len(s) for c, s in where.items() if weight[c] <= leaf} == {1}
    assert [c for c in where if weight[c] > leaf] and all(len(where[c]) > 1 for c in where if weight[c] > leaf)
    per_shard = defaultdict(int)
    for r in placed:
        per_shard[r["shard"]] += r["size"]
    assert max(per_shard.values()) < 1.1 * leaf
