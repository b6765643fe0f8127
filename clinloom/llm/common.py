"""Helpers the operators share: stage tables, checked broadcasts, bounded text batches, byte and word arrays."""

from __future__ import annotations

import atexit
import ctypes
import gc
import os
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinloom.operators.lookups import lookup_side
from clinloom.staging import StageStore

#: Text handled at once inside a task; one longer document is handled alone.
CHUNK_BYTES = 2 << 20

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


#: Rows and bytes of an Arrow batch at most: rows hold whole texts, and a batch is in memory several times.
BATCH_ROWS = 2000
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """From here on the session hands Python no more than BATCH_ROWS rows at once, and its workers look for this package where it lies."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *known])
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = int(spark.conf.get(key).removesuffix("b"))
        if now <= 0 or now > most:
            spark.conf.set(key, most)


def release(spark: SparkSession) -> None:
    """Let go of what finished jobs left: Spark removes shuffle files and broadcasts when the driver collects what stood for them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def release_executors(spark: SparkSession) -> None:
    """Let executors give heap that they do not use back to the system, as Python workers need memory beside it: a collection on each, once a stage."""
    release(spark)
    tasks = 2 * spark.sparkContext.defaultParallelism
    spark.range(0, tasks, 1, tasks).select(F.expr("java_method('java.lang.System', 'gc')").alias("done")).write.format("noop").mode("overwrite").save()


def new_store(spark: SparkSession) -> StageStore:
    """A folder for one call's stage tables; it goes when the program ends."""
    small_batches(spark)
    store = StageStore(spark, compression=None)
    atexit.register(store.drop)
    return store


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_side(df: DataFrame) -> DataFrame:
    """A written lookup table, broadcast only if its counted rows fit the limit."""
    return lookup_side(df, df.count())


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def distinct_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).drop("_n")


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        block = np.cumsum(lengths, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)
    give_back()


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on after its task, beside an executor's heap."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library, which has its own ways
        pass


#: White space other than the space and the line feed, one character each.
OTHER_SPACE = r"[\t\v\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def plain_space(texts: pa.Array) -> pa.Array:
    """Texts with spaces for all other white space but line feeds; every character keeps its place."""
    return pc.replace_substring_regex(texts, OTHER_SPACE, " ")


def byte_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column in one array, and each row's end in it (null: empty)."""
    column = pc.fill_null(column.cast(pa.large_binary()) if pa.types.is_large_string(column.type) else column.cast(pa.binary()), b"")
    wide = column.cast(pa.large_binary())
    offsets = np.frombuffer(wide.buffers()[1], dtype=np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = wide.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def split_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct pieces between spaces, each piece's number among them, and each text's end (null: no piece but "")."""
    pieces = pc.split_pattern(pc.fill_null(texts, ""), " ")
    coded = pieces.flatten().dictionary_encode()
    ends = pieces.offsets.to_numpy()[1:] - pieces.offsets[0].as_py()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), ends


class WordCache(dict):
    """Word to value, made on first use; ``shrink`` between chunks keeps its size bounded."""

    def __init__(self, make, limit: int = 400_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, word):
        value = self[word] = self.make(word)
        return value

    def shrink(self) -> None:
        if len(self) > self.limit:
            self.clear()


class Bytes:
    """What hashing byte strings needs: white space, values of bytes (also with letters lower-cased), powers of an odd number and its inverse."""

    RAW = mix(np.arange(256, dtype=np.uint64) + GOLDEN)
    SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
    LOWERED = RAW[np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256))]
    BASE = 0xD6E8FEB86659FD93
    powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.powers[0]) < n:
            bases = (cls.BASE, pow(cls.BASE, -1, 1 << 64))
            cls.powers = tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, b, np.uint64)])) for b in bases)
        return cls.powers


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs without ASCII white space, A-Z lower-cased) of a string column, and each row's end among them.

    A word's hash is a polynomial in its bytes: a difference of running sums,
    brought back to the word's start by the inverse powers.
    """
    data, ends = byte_rows(column)
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(ends), np.int64)
    up, down = Bytes.upto(n + 1)
    edge = np.zeros(n + 1, bool)  # a text begins here
    edge[0] = edge[ends] = True
    space = Bytes.SPACE[data]
    before = np.concatenate([[True], space[:-1]]) | edge[:n]
    after = np.concatenate([space[1:], [True]]) | edge[1:]
    first, last = np.flatnonzero(~space & before), np.flatnonzero(~space & after)
    running = np.zeros(n + 1, np.uint64)
    np.cumsum(Bytes.LOWERED[data] * up[:n], out=running[1:])
    hashes = mix((running[last + 1] - running[first]) * down[first] + (last - first).astype(np.uint64))
    return hashes, np.searchsorted(first, ends)
