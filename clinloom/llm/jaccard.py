"""N-gram Jaccard join by vertical partitioning.

The shingles of all documents have one global order: first those that are not
known to be frequent, by hash, then the frequent ones, rarest first. The order
is cut into many narrow fragments, and those into a few wide ones. The smaller
of two sets' sizes in each narrow fragment, summed, bounds their overlap, which
ends most pairs. For the others a document's set becomes one segment per wide
fragment, each fragment counts its part of the overlap by itself, and the sum
per pair decides; what the first fragment finds, with the bound of the others,
again ends pairs.

Candidates share a shingle in their prefixes (the first 20 % of a set in the
global order, by which no pair above the threshold is lost). Equal sets are one
node from the start. A shingle's nodes are first linked to one of them only (a
star), so a group of many near copies costs as many pairs as it has members;
then, with the components of those links known, all pairs of different
components that share a prefix shingle and fit in size are counted too, so no
link between components is missed, and components come out exact.

Null and blank texts have no shingles and link with nothing. Texts of fewer
words than a shingle are one shingle. Rows that repeat an id stay rows of their
own; ids of a component are compared without nulls. Very long texts are taken
whole. Empty tables give no rows. Other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import GOLDEN, chunks, distinct_rows, mix, release, shuffle_width, small_side, word_hashes
from clinloom.llm.components import components
from clinloom.llm.fields import PACKED, Field
from clinloom.operators.lookups import lookup_side
from clinloom.staging import StageStore

WORDS = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Fragments of the shingles that are not known to be frequent; the frequent ones are one more.
FRAGMENT_BITS = 2
FREQUENT = 1 << FRAGMENT_BITS
#: Narrow fragments, of which only sizes are kept; the frequent shingles are one more.
NARROW_BITS = 7
#: The frequent shingles that the order knows: at most so many, seen so often in a part of a million shingles.
KNOWN_FREQUENT = 1 << 17
SEEN_IN_PART = 4
PART_SHINGLES = 1_000_000
#: Prefix entries that one group of the star step gets, and the documents of one shingle it gets at most, about.
GROUP_ENTRIES = 200_000
STAR_ENTRIES = 20_000
#: Of so many of the most frequent shingles the entries go to several groups.
SPLIT_SHINGLES = 4096
NO_ID = -(1 << 63)
#: Text handled at once.
PART_BYTES = 1 << 20


def _set_sizes_allow(a: np.ndarray, b: np.ndarray, overlap: np.ndarray) -> np.ndarray:
    return 100 * overlap >= PERCENT * (a + b - overlap)


class ShingleSets:
    """The distinct shingle hashes of each text of a chunk, ascending."""

    def __init__(self, texts: pa.Array, words: int = WORDS):
        word, ends = word_hashes(texts)
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        grams = np.zeros(max(0, len(word) - words + 1), np.uint64)
        for j in range(words):
            grams = grams * GOLDEN + word[j : j + len(grams)]
        grams = mix(grams + np.uint64(words))
        self.sets: list[np.ndarray] = []
        for a, b in zip(starts.tolist(), ends.tolist()):
            if b - a >= words:
                own = np.sort(grams[a : b - words + 1])
                if len(own) > 1:
                    keep = np.empty(len(own), bool)
                    keep[0] = True
                    np.not_equal(own[1:], own[:-1], out=keep[1:])
                    own = own[keep]
            elif b > a:  # the whole sequence is one shingle
                total = np.zeros(1, np.uint64)
                for j in range(a, b):
                    total = total * GOLDEN + word[j : j + 1]
                own = mix(total + np.uint64(b - a))
            else:
                own = np.zeros(0, np.uint64)
            self.sets.append(own)


def node_name(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


class Order:
    """The global order: place in it, and fragment, of shingles."""

    def __init__(self, frequent: np.ndarray):
        """``frequent``: the frequent shingles, rarest first."""
        self.by_hash = np.sort(frequent)
        self.rank = np.argsort(frequent, kind="stable")

    def sort(self, shingles: np.ndarray) -> tuple[np.ndarray, int]:
        """An ascending set in the global order, and the number of frequent shingles at its end."""
        if not len(self.by_hash) or not len(shingles):
            return shingles, 0
        at = np.minimum(np.searchsorted(self.by_hash, shingles), len(self.by_hash) - 1)
        hot = self.by_hash[at] == shingles
        if not hot.any():
            return shingles, 0
        ranks = self.rank[at[hot]]
        return np.concatenate([shingles[~hot], shingles[hot][np.argsort(ranks)]]), int(hot.sum())

    def segments(self, shingles: np.ndarray) -> list[np.ndarray]:
        """One ascending segment per fragment."""
        ordered, hot = self.sort(shingles)
        cold = ordered[: len(ordered) - hot]
        cuts = np.searchsorted(cold >> np.uint64(64 - FRAGMENT_BITS), np.arange(1, FREQUENT, dtype=np.uint64))
        return [*np.split(cold, cuts), np.sort(ordered[len(ordered) - hot :])]


def narrow_sizes(segments: list[np.ndarray]) -> bytes:
    """How many shingles of a set lie in each narrow fragment."""
    cold = np.concatenate(segments[:FREQUENT]) >> np.uint64(64 - NARROW_BITS)
    counts = np.append(np.bincount(cold.astype(np.int64), minlength=1 << NARROW_BITS), len(segments[FREQUENT]))
    return np.minimum(counts, 0xFFFF).astype("<u2").tobytes()


def prefix_length(n: int) -> int:
    return n - (PERCENT * n + 99) // 100 + 1 if n else 0


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"), "text")


def document_sets(documents: DataFrame) -> DataFrame:
    """One pass: (key, n, node) of every document, and (shingle, seen) of what a part of the input often holds."""
    schema = pa.schema([("key", pa.int64()), ("n", pa.int64()), ("node", pa.binary()), ("shingle", pa.int64()), ("seen", pa.int64())])

    def often(held: list[np.ndarray]) -> pa.RecordBatch:
        shingles, seen = np.unique(np.concatenate(held), return_counts=True)
        keep = seen >= SEEN_IN_PART
        k = int(keep.sum())
        return pa.RecordBatch.from_arrays(
            [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.array(shingles[keep].view(np.int64)), pa.array(seen[keep])],
            schema=schema,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in chunks(batches, limit=PART_BYTES):
            sets = ShingleSets(batch.column("text")).sets
            n = len(sets)
            names = [node_name(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())],
                schema=schema,
            )
            held += sets
            size += sum(map(len, sets))
            if size > PART_SHINGLES:
                yield often(held)
                held, size = [], 0
        if size:
            yield often(held)

    return _keyed(documents).mapInArrow(run, "key long, n long, node binary, shingle long, seen long")


def frequent_shingles(sets: DataFrame) -> np.ndarray:
    """At most KNOWN_FREQUENT shingles, rarest first. They only set the order; any order gives the same links."""
    counted = sets.filter(F.col("shingle").isNotNull()).groupBy("shingle").agg(F.sum("seen").alias("seen"))
    rows = counted.orderBy(F.col("seen").desc(), "shingle").limit(KNOWN_FREQUENT).toArrow()
    shingles, seen = rows["shingle"].to_numpy().view(np.uint64), rows["seen"].to_numpy()
    return shingles[np.lexsort((shingles, seen))]


def _prefixes(documents: DataFrame, order) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Order(order.value)
        for batch in chunks(batches, limit=PART_BYTES):
            sets = ShingleSets(batch.column("text")).sets
            heads = [own.sort(s)[0][: prefix_length(len(s))].tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([node_name(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array(heads, pa.binary()),
                ],
                names=["key", "n", "node", "prefix"],
            )

    return _keyed(documents).mapInArrow(run, "key long, n long, node binary, prefix binary").filter(F.col("node").isNotNull())


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of a column of packed sets, and the row of each."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint64), np.repeat(np.arange(len(rows)), [len(r) // 8 for r in rows])


def _shared_prefixes(prefixes: DataFrame, store: StageStore) -> DataFrame:
    """The prefixes' nodes (idx, node, key, n, prefix, places), written, with the shingles only that several nodes may have, and their places in the order."""
    entries = int(prefixes.agg(F.sum(F.length("prefix") / 8)).first()[0] or 0)
    field = Field.for_hashes(shuffle_width(store.spark), entries, 4)

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 4000):
                part = batch.slice(a, 4000)
                shingles, row = _flat(part.column("prefix"))
                names = np.array([int.from_bytes(x[:8], "little") for x in part.column("node").to_pylist()], np.uint64)
                yield field.packed(shingles, names[row])

    shared = field.gather(prefixes.select("node", "prefix").mapInArrow(held, PACKED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            shingles, row = _flat(batch.column("prefix"))
            keep = field.holds(bits, shingles)
            cuts = np.searchsorted(row[keep], np.arange(batch.num_rows + 1))
            shingles = shingles[keep]
            place = (np.arange(len(row)) - np.searchsorted(row, row))[keep].astype("<u4")
            left = [[x[a:b].tobytes() for a, b in zip(cuts, cuts[1:])] for x in (shingles, place)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("n"), batch.column("node"), *(pa.array(x, pa.binary()) for x in left)],
                names=["key", "n", "node", "prefix", "places"],
            )

    found = prefixes.mapInArrow(run, "key long, n long, node binary, prefix binary, places binary")
    firsts = [F.first(c).alias(c) for c in ("n", "prefix", "places")]
    nodes = found.groupBy("node").agg(F.min("key").alias("key"), *firsts)
    nodes = store.save(nodes.withColumn("idx", F.monotonically_increasing_id()), "nodes")
    shared.unpersist()
    return nodes


def _dealt(nodes: DataFrame, groups: int, order) -> DataFrame:
    """Prefix entries packed by group; the entries of the most frequent shingles go to several."""

    def pack(held: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
        shingles = np.frombuffer(b"".join(p for _, p, _ in held), np.uint64)
        places = np.frombuffer(b"".join(p for _, _, p in held), "<u4")
        ids = np.repeat(np.array([i for i, _, _ in held], np.int64), [len(p) // 8 for _, p, _ in held])
        hot = np.isin(shingles, order.value[-SPLIT_SHINGLES:])
        salt = np.where(hot, mix(ids.view(np.uint64) ^ shingles) % np.uint64(spread), 0).astype(np.uint64)
        group = (mix(shingles + salt * GOLDEN) % np.uint64(groups)).astype(np.int64)
        by = np.argsort(group, kind="stable")
        cuts = np.flatnonzero(np.diff(group[by], prepend=-1))
        ends = np.append(cuts[1:], len(by))
        packed = [pa.array([x[by][a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()) for x in (shingles, ids, places)]
        return pa.RecordBatch.from_arrays([pa.array(group[by][cuts]), *packed], names=["group", "shingles", "ids", "places"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("idx", "prefix", "places"))):
                held.append(row)
                size += len(row[1])
                if size > 2 << 20:
                    yield pack(held)
                    held, size = [], 0
        if held:
            yield pack(held)

    # no group gets much more than STAR_ENTRIES entries of one shingle
    spread = max(1, -(-nodes.count() // STAR_ENTRIES))
    return nodes.select("idx", "prefix", "places").mapInArrow(run, "group long, shingles binary, ids binary, places binary")


def _shared(order):
    def run(group: pa.Table) -> pa.Table:
        """(shingle, idx, place) of every shingle that two nodes of the group have."""
        shingles, ids, places = (
            np.frombuffer(b"".join(group[c].to_pylist()), kind) for c, kind in (("shingles", np.uint64), ("ids", np.int64), ("places", "<u4"))
        )
        by = np.argsort(shingles, kind="stable")
        shingles, ids, places = shingles[by], ids[by], places[by]
        first = np.flatnonzero(np.append(True, shingles[1:] != shingles[:-1])) if len(by) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(first, len(by)))
        # of a shingle that is split, nodes of other groups may hold it too
        keep = np.repeat(sizes > 1, sizes) | np.isin(shingles, order.value[-SPLIT_SHINGLES:])
        return pa.table({"shingle": shingles[keep].view(np.int64), "idx": ids[keep], "place": places[keep].astype(np.int32)})

    return run


def _segments(documents: DataFrame, wanted: DataFrame, order, first: bool) -> DataFrame:
    """(idx, fragment, n, sizes, tokens) of the wanted nodes, from their texts: the first fragment, with sizes, or all others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Order(order.value)
        for batch in chunks(batches, limit=PART_BYTES):
            sets = ShingleSets(batch.column("text")).sets
            rows: dict[str, list] = {k: [] for k in ("idx", "fragment", "n", "sizes", "tokens")}
            for i, node, s in zip(batch.column("idx").to_pylist(), batch.column("node").to_pylist(), sets):
                if not len(s) or node_name(s) != node:  # another row with this id
                    continue
                parts = own.segments(s)
                for f, part in enumerate(parts):
                    if first and f == 0 or not first and f and len(part):
                        for k, v in zip(rows, (i, f, len(s), None if f else narrow_sizes(parts), part.tobytes())):
                            rows[k].append(v)
            yield pa.RecordBatch.from_pydict(
                rows,
                schema=pa.schema([("idx", pa.int64()), ("fragment", pa.int32()), ("n", pa.int64()), ("sizes", pa.binary()), ("tokens", pa.binary())]),
            )

    texts = _keyed(documents).join(wanted, "key")
    return texts.select("idx", "node", "text").mapInArrow(run, "idx long, fragment int, n long, sizes binary, tokens binary")


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = []
        for a, b in zip(batch.column("tx").to_pylist(), batch.column("ty").to_pylist()):
            both = np.concatenate([np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)])
            both.sort()
            counts.append(int((both[1:] == both[:-1]).sum()))
        yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("y"), pa.array(counts, pa.int64())], names=["x", "y", "part"])


def _of(segments: DataFrame, pairs: DataFrame, side: str, store: StageStore) -> DataFrame:
    """The segments of one side's nodes of some pairs, picked before anything is shuffled."""
    nodes = store.save(distinct_rows(pairs.select(F.col(side).alias("idx")), ["idx"]), "pair-nodes")
    held = segments.join(small_side(nodes), "idx", "left_semi")
    return held.select(F.col("idx").alias(side), "fragment", F.col("tokens").alias(f"t{side}"))


def _partial(pairs: DataFrame, segments: DataFrame, store: StageStore) -> DataFrame:
    """(x, y, part) per pair and fragment that both have."""
    x, y = (_of(segments, pairs, side, store) for side in "xy")
    return pairs.join(x, "x").join(y, ["y", "fragment"]).select("x", "y", "tx", "ty").mapInArrow(_overlaps, "x long, y long, part long")


def _bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose sizes in the narrow fragments allow a link, with the bound of all but the first wide fragment."""
    first = 1 << (NARROW_BITS - FRAGMENT_BITS)
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(batch.num_rows, -1) for c in ("sx", "sy"))
        most = np.minimum(a, b).astype(np.int64)
        most[most == 0xFFFF] = 1 << 40  # as many or more
        rest = most[:, first:].sum(axis=1)
        nx, ny = (batch.column(c).to_numpy() for c in ("nx", "ny"))
        keep = pa.array(_set_sizes_allow(nx, ny, most[:, :first].sum(axis=1) + rest))
        kept = pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("x", "y", "nx", "ny")), pa.array(rest)], names=["x", "y", "nx", "ny", "rest"])
        yield kept.filter(keep)


def links(pairs: DataFrame, first_segments: DataFrame, other_segments: Callable[[DataFrame], DataFrame], sizes: DataFrame, store: StageStore) -> DataFrame:
    """The pairs (x, y) above the threshold: bounded by sizes, then by the first fragment, then counted in the other fragments.

    ``other_segments`` gives those of some nodes (idx). It is asked for the
    nodes of pairs that are left then, as most nodes have none.
    """
    sx = sizes.select(F.col("idx").alias("x"), F.col("n").alias("nx"), F.col("sizes").alias("sx"))
    sy = sizes.select(F.col("idx").alias("y"), F.col("n").alias("ny"), F.col("sizes").alias("sy"))
    sized = pairs.join(sx, "x").join(sy, "y").select("x", "y", "nx", "ny", "sx", "sy")
    sized = store.save(sized.mapInArrow(_bounds, "x long, y long, nx long, ny long, rest long"), "sized-pairs")

    def allows(overlap):
        return 100 * overlap >= PERCENT * (F.col("nx") + F.col("ny") - overlap)

    first = _partial(sized.select("x", "y"), first_segments, store)
    alive = first.withColumnRenamed("part", "first").join(sized, ["x", "y"]).filter(allows(F.col("first") + F.col("rest"))).drop("rest")
    alive = store.save(alive, "alive-pairs")
    ends = alive.select(F.col("x").alias("idx")).unionByName(alive.select(F.col("y").alias("idx")))
    others = other_segments(store.save(distinct_rows(ends, ["idx"]), "alive-nodes"))
    parts = _partial(alive.select("x", "y"), others, store).groupBy("x", "y").agg(F.sum("part").alias("others"))
    whole = alive.join(parts, ["x", "y"], "left").withColumn("overlap", F.col("first") + F.coalesce(F.col("others"), F.lit(0)))
    return store.save(whole.filter(allows(F.col("overlap"))).select("x", "y"), "links")


def _sizes_fit(a: str, b: str):
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _fitting(shared: DataFrame, nodes: DataFrame, store: StageStore) -> DataFrame:
    """The entries (shingle, idx, place, n, band, rank) that share their shingle with another of about their size.

    Sizes are in bands of the ratio that the threshold allows, so a fitting
    partner is in the same band or the next on either side. ``rank`` grows with
    the number of shared shingles: what a group of near copies goes back to has
    fewer shingles of its own than the copies.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / PERCENT) * (1 + 1e-12)))
    rank = shared.groupBy("idx").agg(F.count(F.lit(1)).alias("rank"))
    sized = store.save(shared.join(nodes.select("idx", "n", band.alias("band")).join(rank, "idx"), "idx"), "shared")
    near = sized.select("shingle", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"))
    near = near.groupBy("shingle", "band").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
    return sized.join(near, ["shingle", "band"], "left_semi")


def _may_link(na: str, pa_: str, nb: str, pb: str):
    """If this is the first shingle that two sets share, as many can follow as a link needs."""
    most = F.least(F.col(na) - F.col(pa_), F.col(nb) - F.col(pb))
    return _sizes_fit(na, nb) & (100 * most >= PERCENT * (F.col(na) + F.col(nb) - most))


def _pairs(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Distinct pairs (x, y) of two sides' entries of different components; their first shared shingle lets every link pass."""
    left = a.select(*on, F.col("idx").alias("a"), F.col("n").alias("na"), F.col("place").alias("pa"), F.col("component").alias("ca"))
    right = b.select(*on, F.col("idx").alias("b"), F.col("n").alias("nb"), F.col("place").alias("pb"), F.col("component").alias("cb"))
    found = left.join(right, on).filter(_may_link("na", "pa", "nb", "pb") & (F.col("ca") != F.col("cb")))
    return distinct_rows(found.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")), ["x", "y"])


def _labelled(entries: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The entries with their component so far, without shingles of one component only."""
    if labels is None:
        known = entries.withColumn("component", F.col("idx"))
    else:
        known = entries.join(labels.withColumnRenamed("node", "idx"), "idx", "left").withColumn("component", F.coalesce("component", "idx"))
    mixed = known.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("shingle")
    return known.join(mixed, "shingle", "left_semi")


def _star_pairs(known: DataFrame, by=None) -> DataFrame:
    """Every node with one of its size among a shingle's nodes, the highest ranked or first ``by``: as many pairs as entries."""
    best = F.max(F.struct(F.col("rank") if by is None else by, -F.col("idx"), "idx", "n", "place", "component"))
    centre = known.groupBy("shingle", "band").agg(best.alias("c"))
    centre = centre.select("shingle", "band", "c.idx", "c.n", "c.place", "c.component")
    return _pairs(known, centre, ["shingle", "band"])


def _random_star_pairs(known: DataFrame) -> DataFrame:
    return _star_pairs(known, F.xxhash64("shingle", "idx"))


def _crossing_pairs(known: DataFrame) -> DataFrame:
    """All pairs of different components: per shingle and size, the nodes outside the largest component with all nodes."""
    per = known.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("c"))
    main = per.groupBy("shingle").agg(F.max_by("component", "c").alias("main"))
    minor = known.join(main, "shingle").filter("component <> main")
    minor = minor.withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
    return _pairs(minor, known, ["shingle", "band"])


def near_duplicates(documents: DataFrame, store: StageStore) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; component_id is the smallest id that links reach."""
    spark = documents.sparkSession
    sets = store.save(document_sets(documents), "sets")
    order = spark.sparkContext.broadcast(frequent_shingles(sets))
    width = shuffle_width(spark)
    prefixes = store.save(_prefixes(documents, order), "prefixes")
    nodes = _shared_prefixes(prefixes, store)
    store.remove("prefixes")
    entries = nodes.agg(F.sum(F.length("prefix") / 8)).first()[0] or 0
    groups = max(width, int(entries // GROUP_ENTRIES) + 1)
    shared = _dealt(nodes, groups, order).groupBy("group").applyInArrow(_shared(order), "shingle long, idx long, place int")
    entries = store.save(_fitting(shared, nodes, store), "entries")
    ends = distinct_rows(entries.select("idx"), ["idx"])
    wanted = store.save(nodes.select("idx", "key", "node").join(ends, "idx"), "wanted")
    repeated = sets.filter(F.col("node").isNotNull()).groupBy("key", "node").count().filter("count > 1").limit(1).count()

    def segments(nodes: DataFrame, name: str, first: bool) -> DataFrame:
        found = _segments(documents, lookup_side(nodes, 2 * nodes.count()), order, first)
        return store.save(found.dropDuplicates(["idx", "fragment"]) if repeated else found, name)  # rows may repeat id and text

    def other_segments(ends: DataFrame) -> DataFrame:
        return segments(store.save(wanted.join(small_side(ends), "idx", "left_semi"), "alive-wanted"), "other-segments", first=False)

    first_segments = segments(wanted, "first-segments", first=True)
    store.remove("shared")
    release(spark)
    sizes = store.save(first_segments.select("idx", "n", "sizes"), "sizes")
    # stars first, then what they leave apart
    found = tried = labels = None
    for step in (_star_pairs, _random_star_pairs, _crossing_pairs):
        pairs = step(store.save(_labelled(entries, labels), "labelled"))
        pairs = store.save(pairs if tried is None else pairs.join(tried, ["x", "y"], "left_anti"), "pairs")
        more = links(pairs, first_segments, other_segments, sizes, store)
        for name in ("other-segments", "alive-nodes", "alive-wanted"):
            store.remove(name)
        found = more if found is None else found.unionByName(more)
        tried = pairs if tried is None else tried.unionByName(pairs)
        labels = components(found, store)
        for name in ("labelled", "sized-pairs", "alive-pairs", "pair-nodes", "large-star", "small-star"):
            store.remove(name)
        release(spark)
    for name in ("entries", "wanted", "first-segments", "sizes", "pairs", "links"):
        store.remove(name)
    # back to documents: nodes of a component, and documents of a node
    placed = nodes.select("idx", "node", "key").join(labels.withColumnRenamed("node", "idx"), "idx", "left")
    placed = store.save(placed.select("node", "key", F.coalesce("component", "idx").alias("component")), "placed")
    own = F.when(F.col("key") != NO_ID, F.col("key"))
    real = sets.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min(own).alias("least"))
    real = real.join(placed.select("node", "component"), "node")
    least = real.groupBy("component").agg(F.min("least").alias("component_id"))
    per_node = store.save(real.select("node", "component").join(least, "component").select("node", "component_id"), "node-components")
    rows = sets.filter(F.col("shingle").isNull())
    return rows.join(per_node, "node", "left").select(
        own.alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), own).otherwise(F.col("component_id")).alias("component_id")
    )
