"""Ranked lexical search the other way round: documents stream past an index of the queries.

The inverted index is over the items' terms, so it is small and goes to every
task; the documents stay where they are. A first pass counts, per document, all
its terms and those that occur in an item, and writes that. Document
frequencies and lengths follow from the written counts. A second pass sends
every document's counts through the index, adds the scores of the items that
it meets, and keeps each item's best documents in a bounded heap; the tasks'
heaps, at most ``k`` documents an item each, are merged at the end.

What is sent to the tasks has a bound: items are taken in blocks of at most
BLOCK_POSTINGS terms and BLOCK_ITEMS items (one larger item is a block of its
own), and the documents stream past the blocks one after another.

A null or empty text holds no term: such an item finds nothing and such a
document is never found. Every row of the items is an item, every row of the
documents a document, whatever its id; equal scores are ordered by id, a null
id last. Texts of any length are read whole. An empty table gives no rows.
Other columns of the inputs are left alone.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinloom.llm.common import byte_rows, chunks, give_back, small_batches, small_side
from clinloom.staging import StageStore

#: Terms: runs of digits, ASCII letters and everything beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK_POSTINGS = 200_000
BLOCK_ITEMS = 4096
#: Scores held at once (documents by items), and single additions made at once.
SCORES_AT_ONCE = 2 << 20
#: Found documents that wait for the next cut back to the best k.
WAITING = 100_000
#: Below this all sums of whole numbers are exact in doubles.
EXACT = 2**53

_LETTERS = np.arange(256, dtype=np.uint8)
_LETTERS[65:91] += 32
_IS_TERM = np.zeros(256, bool)
_IS_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts, A-Z lower-cased, one after another, and how many each text has."""
    data, ends = byte_rows(texts)
    n = len(data)
    if not n:
        return pa.array([], pa.large_binary()), np.zeros(len(ends), np.int64)
    inside = _IS_TERM[data]
    edge = np.zeros(n + 1, bool)  # a text begins here
    edge[0] = edge[ends] = True
    first = np.flatnonzero(inside & (np.concatenate([[True], ~inside[:-1]]) | edge[:n]))
    last = np.flatnonzero(inside & (np.concatenate([~inside[1:], [True]]) | edge[1:]))
    offsets = np.empty(2 * len(first) + 1, np.int64)  # terms and the gaps behind them
    offsets[:-1:2], offsets[1::2] = first, last + 1
    offsets[-1] = n
    both = pa.Array.from_buffers(pa.large_binary(), 2 * len(first), [None, pa.py_buffer(offsets), pa.py_buffer(_LETTERS[data])])
    return both, np.diff(np.concatenate([[0], np.searchsorted(first, ends)]))


def term_counts(texts: pa.Array, known: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each text's number of terms; and text, number and count of every known term in it."""
    both, lengths = terms(texts)
    if not len(both):
        return lengths, *(np.zeros(0, np.int64) for _ in range(3))
    number = pc.fill_null(pc.index_in(both, value_set=known), -1).to_numpy(zero_copy_only=False)[::2]
    there = number >= 0
    row = np.repeat(np.arange(len(lengths)), lengths)[there]
    found, counts = np.unique(row * len(known) + number[there], return_counts=True)
    return lengths, found // len(known), found % len(known), counts


def _counter(known: list[bytes]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(known, pa.large_binary())
        for batch in chunks(batches):
            lengths, row, term, count = term_counts(batch.column("text"), vocabulary)
            offsets = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (term.astype(np.int32), count.astype(np.int64))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lengths.astype(np.int64)), *lists], schema=schema)

    return run


class Index:
    """Items by term: for each term its weight, the items that hold it and how often."""

    def __init__(self, weights: np.ndarray, term: np.ndarray, item: np.ndarray, times: np.ndarray, documents: int, all_terms: int):
        order = np.lexsort((item, term))
        self.weights, self.item, self.times = weights, item[order], times[order]
        self.start = np.searchsorted(term[order], np.arange(len(weights)))
        self.held_by = np.bincount(term, minlength=len(weights))
        self.items, self.documents, self.all_terms = int(item.max()) + 1, documents, all_terms
        most = np.bincount(item, (times * weights[term]).astype(np.float64))
        self.exact = bool(most.max(initial=0) * 1e6 < EXACT)

    def scores(self, lengths: np.ndarray, row: np.ndarray, term: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Scores of some documents (rows) for all items (columns)."""
        m = 75 + (25 * lengths * self.documents) // self.all_terms
        value = self.weights[term] * ((1_000_000_000 * count) // (1000 * count + 12 * m[row]))
        each = self.held_by[term]
        entry = np.repeat(np.arange(len(term)), each)
        place = np.arange(len(entry)) + np.repeat(self.start[term] - (np.cumsum(each) - each), each)
        cell, added = row[entry] * self.items + self.item[place], value[entry] * self.times[place]
        size = len(lengths) * self.items
        if self.exact:
            out = np.bincount(cell, added.astype(np.float64), size).astype(np.int64)
        else:
            out = np.zeros(size, np.int64)
            np.add.at(out, cell, added)
        return out.reshape(len(lengths), self.items)


class Heaps:
    """The best k documents of every item; found documents wait and are cut back together."""

    def __init__(self, items: int, k: int):
        self.k, self.floor = k, np.ones(items, np.int64)  # scores below it cannot be among the best
        self.best = tuple(np.zeros(0, t) for t in (np.int64, bool, np.int64, np.int64))  # item, null id, id, score
        self.waiting: list[tuple[np.ndarray, ...]] = []
        self.n = 0

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        row, item = np.nonzero(scores >= self.floor)
        self.waiting.append((item, null[row], ids[row], scores[row, item]))
        self.n += len(row)
        if self.n > WAITING:
            self.cut()

    def cut(self) -> None:
        item, null, ids, score = (np.concatenate(x) for x in zip(self.best, *self.waiting))
        order = np.lexsort((ids, null, -score, item))
        item = item[order]
        first = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]])) if len(item) else np.zeros(0, np.int64)
        place = np.arange(len(item)) - np.repeat(first, np.diff(np.concatenate([first, [len(item)]])))
        kept = order[place < self.k]
        self.best, self.waiting, self.n = (item[place < self.k], null[kept], ids[kept], score[kept]), [], 0
        full = place == self.k - 1
        self.floor[item[full]] = score[order[full]]


def _searcher(packed: bytes, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = pickle.loads(packed)
        heaps = Heaps(index.items, k)
        for batch in batches:
            ids, lengths = batch.column("doc_id"), batch.column("n").to_numpy()
            null, ids = ids.is_null().to_numpy(zero_copy_only=False), pc.fill_null(ids, 0).to_numpy()
            lists = batch.column("terms")
            ends = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
            term, count = lists.flatten().to_numpy(), batch.column("counts").flatten().to_numpy()
            adds = np.concatenate([[0], np.cumsum(index.held_by[term])])[ends]
            step = np.maximum(np.arange(len(ends)) * index.items, adds) // SCORES_AT_ONCE  # both parts of the work are bounded
            cuts = [0, *(np.flatnonzero(np.diff(step[:-1])) + 1).tolist(), len(ids)]
            for a, b in zip(cuts, cuts[1:]):
                x, y = ends[a], ends[b]
                row = np.repeat(np.arange(b - a), np.diff(ends[a : b + 1]))
                heaps.add(index.scores(lengths[a:b], row, term[x:y], count[x:y]), ids[a:b], null[a:b])
        heaps.cut()
        item, null, ids, score = heaps.best
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(ids, mask=null), pa.array(score)], names=["_item", "doc_id", "score"])
        give_back()

    return run


def _blocks(items: DataFrame, store: StageStore) -> DataFrame:
    """Written postings: block, row number, item number within the block, term, times."""
    rows = store.save(items.select("item_id", "text").withColumn("_row", F.monotonically_increasing_id()), "items")
    text = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = rows.select("_row", F.explode(F.regexp_extract_all(text, F.lit(TERM), F.lit(0))).alias("term"))
    postings = store.save(found.groupBy("_row", "term").agg(F.count(F.lit(1)).alias("times")), "postings")
    before = Window.orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)  # one row an item
    sizes = postings.groupBy("_row").agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.withColumn("_terms", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn("_place", F.row_number().over(Window.orderBy("_row")) - 1)
    block = F.greatest(F.floor(F.col("_terms") / BLOCK_POSTINGS), F.floor(F.col("_place") / BLOCK_ITEMS))
    placed = sizes.select("_row", block.cast("int").alias("block")).withColumn("_item", F.row_number().over(Window.partitionBy("block").orderBy("_row")) - 1)
    placed = store.save(placed.join(rows.select("_row", "item_id"), "_row"), "blocks")
    return placed, postings


def search(documents: DataFrame, items: DataFrame, store: StageStore, k: int = 20) -> DataFrame:
    """item_id, rank, doc_id and score of every item's ``k`` best documents with a score above 0."""
    spark = documents.sparkSession
    small_batches(spark)
    placed, postings = _blocks(items, store)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = []
    for block in sorted(r["block"] for r in placed.select("block").distinct().collect()):
        here = placed.filter(F.col("block") == block)
        rows = postings.join(F.broadcast(here), "_row").select("_item", "term", "times").toArrow()  # bounded by the block
        coded = rows["term"].combine_chunks().cast(pa.large_binary()).dictionary_encode()
        known = coded.dictionary.to_pylist()
        counted = store.save(texts.mapInArrow(_counter(known), "doc_id long, n long, terms array<int>, counts array<long>"), f"counts-{block}")
        whole = counted.agg(F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.sum("n").alias("terms")).first()
        if not whole["terms"]:
            continue
        held = np.zeros(len(known), np.int64)
        for term, n in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # one row a known term
            held[term] = n
        weights = np.array([math.floor(1000 * math.log((2 * whole["documents"] + 2) / (2 * n + 1))) for n in held.tolist()], np.int64)
        index = Index(weights, coded.indices.to_numpy().astype(np.int64), rows["_item"].to_numpy().astype(np.int64), rows["times"].to_numpy(), whole["documents"], whole["terms"])
        found = counted.filter("size(terms) > 0").mapInArrow(_searcher(pickle.dumps(index), k), "_item long, doc_id long, score long")
        order = Window.partitionBy("_item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        named = here.select(F.col("_item").alias("_number"), "item_id")
        parts.append(best.join(small_side(named), F.col("_item") == F.col("_number")).select("item_id", "rank", "doc_id", "score"))
    if not parts:
        kind = items.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found
