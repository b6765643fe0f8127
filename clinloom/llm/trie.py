"""The trie of conversation prefixes, by truncation peeling.

A node of depth ``d`` is a distinct sequence of first ``d`` turns. Peeling
starts at the deepest conversations and goes up one level at a time: the
conversations that end at a level meet the nodes left over from the level
below, whose last turn is stripped, and both are grouped by the turns that are
left. One grouping finds the level's nodes and adds up everything a node says
about its subtree, so no prefix is visited twice and no level is read again.

A sequence of turns is known by a chain of 128-bit hashes, one a turn, and is
carried as that chain; texts are read once and not shuffled. Equal
conversations are merged before peeling. What a job finds is a written table, so
a lost executor costs one job at most. A level that many conversations reach is
a job of its own, a grouping with partial sums; levels that few reach, as those
below the depth of most conversations, are peeled several in one job, as many as
have BAND_TURNS turns together, inside the subtrees of the topmost of them.

Turns are ordered by number (null first), then role, then the hash of role and
text; null roles and texts are empty. Rows without a conv_id belong to no
conversation. Repeated rows are turns of their own. An empty table gives no
rows. Other columns of the input are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import small_batches
from clinloom.llm.mixing import word_count
from clinloom.staging import StageStore

#: Every conversation may begin with up to MOST_SHARED - 1 turns of the first of its FAMILY.
FAMILY = 20
MOST_SHARED = 4
#: Letters of joined ids hashed at once.
ID_LETTERS = 32 << 10
#: Turns of all paths in the levels that one job peels, if it peels several.
BAND_TURNS = 50_000
BAND_GROUPS = 8
NO_ENDS = hashlib.sha256(b"").hexdigest()

_PATH = "keys array<binary>, words array<long>"


def own_turns(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order: hash of role and text, and words of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    turn = F.struct(F.col("turn"), role.alias("role"), digest.alias("digest"), word_count(F.col("text")).alias("words"))
    turns = conversations.filter(F.col("conv_id").isNotNull()).groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("_t"))
    return turns.select("conv_id", F.transform("_t", lambda t: F.struct(t["digest"].alias("digest"), t["words"].alias("words"))).alias("turns"))


def rebuilt(own: DataFrame) -> DataFrame:
    """Every conversation with the first h turns of its family's first one in the place of its own."""
    heads = own.filter(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("_base"), F.slice("turns", 1, MOST_SHARED - 1).alias("_head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % MOST_SHARED).cast("int")
    joined = own.withColumn("_h", h).withColumn("_of", F.col("conv_id") - F.col("conv_id") % FAMILY).join(heads, F.col("_of") == F.col("_base"), "left")
    first = F.slice(F.coalesce("_head", F.array().cast(own.schema["turns"].dataType)), F.lit(1), F.col("_h"))
    rest = F.slice("turns", F.col("_h") + 1, F.size("turns"))
    return joined.select("conv_id", F.concat(first, rest).alias("turns"))


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turn hashes to hashes of all turns so far."""
    for batch in batches:
        lists = batch.column("turns")
        turns = lists.flatten()
        ends = (lists.offsets.to_numpy() - lists.offsets[0].as_py()).tolist()
        digests, keys = turns.field("digest").to_pylist(), []
        for a, b in zip(ends, ends[1:]):
            key = b""
            for digest in digests[a:b]:
                key = hashlib.md5(key + digest).digest()
                keys.append(key)
        offsets = pa.array(ends, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.ListArray.from_arrays(offsets, pa.array(keys, pa.binary())), pa.ListArray.from_arrays(offsets, turns.field("words"))],
            names=["conv_id", "keys", "words"],
        )


def _last(column: str, back: int = 1) -> Column:
    """The hash ``back`` from the end; the textless root's is empty."""
    return F.when(F.size(column) >= back, F.element_at(column, -back)).otherwise(F.unhex(F.lit("")))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conv_id) rows to joined ids in pieces: many rows of one key become few."""
    out: list[tuple] = []
    key, first, ids, letters = None, None, [], 0

    def piece() -> None:
        if ids:
            out.append((key, first, len(ids), ",".join(ids)))

    def taken() -> pa.RecordBatch:
        columns = [pa.array(x, t) for x, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.int64(), pa.string()))]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, names=["key", "first", "n", "ids"])

    for batch in batches:
        for k, c in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
            if k != key or letters >= ID_LETTERS:
                piece()
                key, first, ids, letters = k, c, [], 0
            ids.append(str(c))
            letters += len(ids[-1]) + 1
        if len(out) > 1000:
            yield taken()
    piece()
    if out:
        yield taken()


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces of joined ids to one row a key; only one running hash is held."""
    out: list[tuple] = []
    key, smallest, n, running = None, None, 0, None

    def taken() -> pa.RecordBatch:
        columns = [pa.array(x, t) for x, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.int64(), pa.string()))]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, names=["key", "smallest", "n_convs", "ends_sha256"])

    for batch in batches:
        for k, first, count, ids in zip(*(batch.column(c).to_pylist() for c in ("key", "first", "n", "ids"))):
            if running is None or k != key:
                if running is not None:
                    out.append((key, smallest, n, running.hexdigest()))
                key, smallest, n, running = k, first, 0, hashlib.sha256()
            else:
                running.update(b",")
            running.update(ids.encode())
            n += count
        if len(out) > 1000:
            yield taken()
    if running is not None:
        out.append((key, smallest, n, running.hexdigest()))
    if out:
        yield taken()


def distinct_conversations(whole: DataFrame) -> DataFrame:
    """One row for each distinct sequence of turns: its chain, members, smallest member and the hash of its members' ids.

    Members are packed where they lie in a range of (key, conv_id), so a
    sequence that very many conversations share is dealt over several tasks,
    and only its pieces come together.
    """
    members = whole.select(_last("keys").alias("key"), "conv_id")
    packed = members.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(_pack, "key binary, first long, n long, ids string")
    digests = packed.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_digest, "key binary, smallest long, n_convs long, ends_sha256 string")
    return digests.drop("key").join(whole, F.col("smallest") == F.col("conv_id")).select("conv_id", "n_convs", "ends_sha256", "keys", "words", F.size("keys").alias("depth"))


_NODE = "key binary, parent_key binary, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_NODES = f"{_NODE}, {_PATH}, depth int"


def _paths(ended: DataFrame, below: DataFrame | None) -> DataFrame:
    """Conversations that end in some levels, and the nodes of the level below those without their last turn."""
    none = F.lit(0).cast("long")
    parts = ended.select("keys", "words", "conv_id", "n_convs", none.alias("n_children"), none.alias("n_leaves"), none.alias("saved_tokens"), "ends_sha256")
    if below is not None:
        shorter = [F.slice(c, F.lit(1), F.size(c) - 1).alias(c) for c in ("keys", "words")]
        stripped = below.select(*shorter, "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens", F.lit(None).cast("string").alias("ends_sha256"))
        parts = parts.unionByName(stripped)
    return parts


def _level(parts: DataFrame, depth: int) -> DataFrame:
    """The nodes of one level from the paths that reach it."""
    path = F.struct("keys", "words")
    grouped = parts.groupBy(_last("keys").alias("key")).agg(
        F.first(path).alias("_path"), F.min("conv_id").alias("conv_id"), F.max("ends_sha256").alias("ends_sha256"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
    )
    keys, words = F.col("_path.keys"), F.col("_path.words")
    last_words = F.when(F.size(words) > 0, F.element_at(words, -1)).otherwise(F.lit(0))
    return grouped.select(
        "key", _last("_path.keys", 2).alias("parent_key"), "conv_id", "n_convs", "n_children",
        F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * last_words).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"), keys.alias("keys"), words.alias("words"), F.lit(depth).alias("depth"),
    )


def _band(parts: DataFrame, low: int) -> DataFrame:
    """The nodes from level ``low`` down, whole subtrees of that level in a group; paths are kept on that level only."""

    def peel(group: pa.Table) -> pa.Table:
        waiting: dict[int, list] = {}
        for row in group.to_pylist():
            waiting.setdefault(len(row["keys"]), []).append(row)
        out, stripped = [], {}
        for depth in range(max(waiting), low - 1, -1):
            nodes: dict[bytes, dict] = {}
            for row in (*waiting.pop(depth, ()), *stripped.values()):
                key = row["keys"][depth - 1] if depth else b""
                node = nodes.get(key)
                if node is None:
                    nodes[key] = row
                    continue
                for c in ("n_convs", "n_children", "n_leaves", "saved_tokens"):
                    node[c] += row[c]
                node["conv_id"] = min(node["conv_id"], row["conv_id"])
                node["ends_sha256"] = node["ends_sha256"] or row["ends_sha256"]
            stripped = {}
            for key, node in nodes.items():
                keys, words = node["keys"], node["words"]
                leaves = node["n_leaves"] if node["n_children"] else 1
                saved = node["saved_tokens"] + ((node["n_convs"] - 1) * words[depth - 1] if depth else 0)
                done = {
                    "key": key, "parent_key": keys[depth - 2] if depth > 1 else b"", "conv_id": node["conv_id"], "n_convs": node["n_convs"], "n_children": node["n_children"],
                    "n_leaves": leaves, "saved_tokens": saved, "ends_sha256": node["ends_sha256"] or NO_ENDS, "keys": None, "words": None, "depth": depth,
                }
                if depth == low:
                    done |= {"keys": keys[:depth], "words": words[:depth]}
                out.append(done)
                stripped[key] = {"keys": keys, "words": words, "conv_id": node["conv_id"], "n_convs": node["n_convs"], "n_children": 1, "n_leaves": leaves, "saved_tokens": saved, "ends_sha256": None}
        return pa.Table.from_pylist(out, _NODES_ARROW)

    top = F.pmod(F.xxhash64(F.element_at("keys", low)), F.lit(BAND_GROUPS)) if low else F.lit(0)
    return parts.groupBy(top.alias("_top")).applyInArrow(peel, _NODES)


_NODES_ARROW = pa.schema([
    ("key", pa.binary()), ("parent_key", pa.binary()), *((c, pa.int64()) for c in ("conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")),
    ("ends_sha256", pa.string()), ("keys", pa.list_(pa.binary())), ("words", pa.list_(pa.int64())), ("depth", pa.int32()),
])


def bands(conversations: dict[int, int], turns: int) -> list[tuple[int, int]]:
    """Levels that are peeled together, as (deepest, topmost), from the number of distinct conversations of each depth."""
    out, reach, held, deepest = [], 0, 0, None
    for depth in range(max(conversations, default=-1), -1, -1):
        reach += conversations.get(depth, 0)
        if deepest is not None and held + reach > turns:
            out.append((deepest, depth + 1))
            deepest, held = None, 0
        deepest, held = depth if deepest is None else deepest, held + reach
    return out if deepest is None else [*out, (deepest, 0)]


def prefix_trie(conversations: DataFrame, store: StageStore) -> DataFrame:
    """One row per node of the rebuilt conversations: smallest member, depth, parent, members, children, leaves, saved tokens, ends."""
    spark = conversations.sparkSession
    small_batches(spark)
    own = store.save(own_turns(conversations), "turns")
    whole = store.save(rebuilt(own).mapInArrow(_chain, f"conv_id long, {_PATH}"), "rebuilt")
    ends_at = store.path("ends")
    ended = distinct_conversations(whole)
    ended.repartitionByRange("depth", "conv_id").write.partitionBy("depth").parquet(ends_at)
    ended = spark.read.schema(ended.schema).parquet(ends_at)
    counts = {r["depth"]: r["count"] for r in ended.groupBy("depth").count().collect()}  # one row a depth
    below, found = None, store.path("nodes")
    for deepest, low in bands(counts, BAND_TURNS):
        parts = _paths(ended.filter(F.col("depth").between(low, deepest)), below)
        nodes = _level(parts, low) if low == deepest else _band(parts, low)
        nodes.write.parquet(f"{found}/low={low}")
        below = spark.read.schema(_NODES).parquet(f"{found}/low={low}").filter(F.col("depth") == low)
    if below is None:
        return spark.createDataFrame([], "conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    nodes = spark.read.schema(_NODES).parquet(found)
    parents = nodes.filter("n_children > 0").select(F.col("key").alias("_key"), F.col("depth").alias("_depth"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(parents, (F.col("parent_key") == F.col("_key")) & (F.col("depth") == F.col("_depth") + 1), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
