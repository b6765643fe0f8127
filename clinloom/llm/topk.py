"""Exact top-k search by columnar branch and bound.

Candidates lie in blocks in vertical layout (one row per dimension, the
dimensions of most mass first). A query's scores are accumulated some
dimensions at a time; after each step the candidates whose score so far plus
the most that the remaining dimensions can add (Cauchy-Schwarz on the
remaining mass) stays below the query's k-th best are dropped, and the
survivors are compacted. Query blocks meet candidate blocks, all queries
against all rows; the blocks' best are merged by Spark. Candidate blocks stay
where they are and the query blocks are sent to them; a task keeps each query's
best, and so its floor, from one candidate block to the next.

Vectors that are null, or hold null or non-finite components, and rows without
an id take no part. Every other row counts: rows that repeat an id are each a
query, with ranks of its own, and candidates of each other. Only vectors of a query's own length are its candidates. Empty vectors score 0.
Scores outside 64 bits stop at its ends. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinloom.staging import StageStore

SCALE = 256
BLOCK_VECTORS = 4096
QUERY_VECTORS = 1024
STEP = 16
#: Query vectors that are sent to the tasks at once.
SENT_BYTES = 32 << 20
#: Sums below this are exact in doubles.
EXACT = float(1 << 53)


def usable_vectors(embeddings: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    whole = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    vector = F.transform(embedding, lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    return (
        embeddings.filter(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & whole)
        .select(F.col(vec_id).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), vector.alias("v"))
        .withColumn("dims", F.size("v"))
    )


def _pack(group: pa.Table) -> pa.Table:
    """One row: the ids in the order of their rows, and the vectors column by column."""
    dims, block = group["dims"][0].as_py(), group["block"][0].as_py()
    ids, rows = group["id"].to_numpy(), group["row"].to_numpy()
    values = np.asarray(group["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(ids), dims)
    order = np.argsort(rows)
    return pa.table(
        {
            "dims": [dims], "block": [block], "ids": [ids[order].astype("<i8").tobytes()], "rows": [rows[order].astype("<i8").tobytes()],
            "v": [np.ascontiguousarray(values[order].T).tobytes()],
        },
        schema=pa.schema([("dims", pa.int32()), ("block", pa.int64()), ("ids", pa.binary()), ("rows", pa.binary()), ("v", pa.binary())]),
    )


def _blocks(vectors: DataFrame, rows: int, per_block: int) -> DataFrame:
    number = max(1, -(-rows // per_block))
    return (
        vectors.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(number)))
        .groupBy("dims", "block")
        .applyInArrow(_pack, "dims int, block long, ids binary, rows binary, v binary")
    )


def _wide_score(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Scores too large for doubles, in whole numbers."""
    exact = np.array([int(x) for x in q], dtype=object) @ np.array([[int(x) for x in row] for row in c], dtype=object).reshape(c.shape)
    return np.array([min(max(int(s), -(1 << 63)), (1 << 63) - 1) for s in np.atleast_1d(exact)], dtype=np.int64)


class Best:
    """The k best of each query of one block so far."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.own_rows, self.vectors, self.k = ids, rows, vectors, k
        self.found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(ids)

    def floor(self, i: int) -> float:
        scores = self.found[i][0]
        return float(scores[self.k - 1]) if len(scores) >= self.k else -np.inf

    def add(self, i: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.found[i][0], scores]), np.concatenate([self.found[i][1], ids])
        order = np.lexsort((ids, -scores.astype(np.float64)))[: 4 * self.k] if len(ids) > 64 and np.abs(scores).max(initial=0) < EXACT else None
        if order is None:
            order = np.array(sorted(range(len(ids)), key=lambda j: (-int(scores[j]), int(ids[j]))), dtype=np.int64)
        order = order[: self.k]
        self.found[i] = scores[order], ids[order]

    def search(self, ids: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> None:
        dims, n = columns.shape
        axis = np.argsort(-(columns * columns).sum(axis=1), kind="stable")
        columns, queries = np.ascontiguousarray(columns[axis]), self.vectors[axis]
        if dims and np.abs(columns).max() * np.abs(queries).max() * dims >= EXACT:
            for i in range(len(self.ids)):
                other = rows != self.own_rows[i]
                self.add(i, _wide_score(queries[:, i], columns[:, other]), ids[other])
            return
        starts = list(range(0, dims, STEP)) or [0]
        # what is left of the length after each step
        c_rest = [np.sqrt((columns[s + STEP :] ** 2).sum(axis=0)) for s in starts]
        q_rest = [np.sqrt((queries[s + STEP :] ** 2).sum(axis=0)) for s in starts]
        first = queries[:STEP].T @ columns[:STEP]
        for i, own in enumerate(self.own_rows):
            place = np.searchsorted(rows, own)
            score, alive = first[i], np.arange(n)
            if place < n and rows[place] == own:
                alive = np.delete(alive, place)
            if len(alive) > self.k and dims > STEP:  # the most promising first, for a floor to prune by
                head = alive[np.argpartition(-score[alive], self.k - 1)[: self.k]]
                self.add(i, (queries[:, i] @ columns[:, head]).astype(np.int64), ids[head])
                alive = np.setdiff1d(alive, head, assume_unique=True)
            part = score[alive]
            for step, s in enumerate(starts):
                if step:
                    part = part + queries[s : s + STEP, i] @ columns[s : s + STEP][:, alive]
                most = part + c_rest[step][alive] * q_rest[step][i] * (1 + 1e-9) + 1e-6
                stay = most >= self.floor(i)
                alive, part = alive[stay], part[stay]
                if not len(alive):
                    break
            self.add(i, np.rint(part).astype(np.int64), ids[alive])

    def best_rows(self) -> pa.RecordBatch:
        scores = np.concatenate([s for s, _ in self.found]) if self.found else np.zeros(0, np.int64)
        ids = np.concatenate([j for _, j in self.found]) if self.found else np.zeros(0, np.int64)
        times = [len(s) for s, _ in self.found]
        columns = (np.repeat(self.own_rows, times), np.repeat(self.ids, times), ids, scores)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_row", "query_id", "vec_id", "score"])


def _searcher(k: int):
    """Pairs of a query block and a candidate block; query blocks come back with every candidate block of the task."""

    def run(batches):
        best: dict[tuple[int, int], Best] = {}
        for batch in batches:
            for row in batch.to_pylist():
                dims, key = row["dims"], (row["dims"], row["query_block"])
                if key not in best:
                    asked, asked_rows = np.frombuffer(row["q_ids"], "<i8"), np.frombuffer(row["q_rows"], "<i8")
                    best[key] = Best(asked, asked_rows, np.frombuffer(row["q_v"]).reshape(dims, len(asked)), k)
                ids, rows = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["rows"], "<i8")
                best[key].search(ids, rows, np.frombuffer(row["v"]).reshape(dims, len(ids)))
        for found in best.values():
            yield found.best_rows()

    return run


def top_k(embeddings: DataFrame, store: StageStore, is_query, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score: each query's ``k`` highest inner products with the other rows, ties to the smaller id.

    ``is_query`` makes a condition from the id column.
    """
    vectors = store.save(usable_vectors(embeddings, vec_id, embedding), "vectors")
    queries = vectors.filter(is_query(F.col("id")))
    rows, asked = vectors.count(), queries.count()
    candidates = store.save(_blocks(vectors, rows, BLOCK_VECTORS), "candidate-blocks")
    ask = store.save(_blocks(queries, asked, QUERY_VECTORS), "query-blocks")
    ask = ask.select("dims", F.col("block").alias("query_block"), F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"), F.col("v").alias("q_v"))
    # groups of query blocks small enough to be sent to all executors; the candidate blocks are read once a group and never shuffled
    sizes = ask.select("dims", "query_block", F.octet_length("q_v").alias("bytes"))
    before = F.sum("bytes").over(Window.orderBy("dims", "query_block").rowsBetween(Window.unboundedPreceding, Window.currentRow))  # one row a block
    dealt = store.save(sizes.withColumn("part", F.floor(before / SENT_BYTES)), "query-parts")
    parts = [r["part"] for r in dealt.select("part").distinct().orderBy("part").collect()]
    best = "query_row long, query_id long, vec_id long, score long"
    found = None
    for part in parts:
        sent = ask.join(F.broadcast(dealt.filter(F.col("part") == part).select("dims", "query_block")), ["dims", "query_block"])
        one = candidates.join(F.broadcast(sent), "dims").mapInArrow(_searcher(k), best)
        found = one if found is None else found.unionByName(one)
    if found is None:
        found = embeddings.sparkSession.createDataFrame([], best)
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
