"""Benchmark decontamination by template canonicalisation.

Words are brought to a canonical form: numbers, names (capitalised inside a
sentence) and units (behind a number) become typed placeholders, all else
lower-case words without punctuation around them. A capital tells little where a
sentence begins, and where it does is not sure: there a word that looks like a
name is read both ways, as are possessives anywhere and, in documents, a name in
front of a window, as an item may begin there. Windows of eight such words
are joined by hash between benchmark and documents, so a question is found
again after its numbers and names were exchanged. The values in the slots tell
such a question from chance: along one alignment, an item's value stands for
one value of the document, the one it has in most places. If half of the slots
agree with that, or hold the item's own value, all windows of the alignment
count; if fewer do, the windows without a deviating slot still count.
A document is contaminated by an item if consistent windows cover a run of it
(``MIN_WINDOWS``), or all of a shorter item. Windows that many items hold, as
those of a common instruction, tell nothing about one of them and do not count,
unless an item has no others. Windows need four real words; an item without
such a window, as one of numbers, is looked for word for word, if it has
``MIN_WORDS`` words of any kind. Before the join, documents only drop windows that
no item has, by a bit field of fixed size.

Null and empty texts match nothing. Rows that repeat a document id are judged
together; a null id is an id. Rows that repeat an item id are one item. Empty
tables give no rows. Very long texts are searched whole. Other columns are left
alone.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import GOLDEN, WordCache, chunks, mix, plain_space, small_side, split_words
from clinloom.staging import StageStore

WINDOW = 8
MIN_WORDS = 4
MIN_WINDOWS = 6
FIELD_BITS = 23
#: Readings of windows that are worked on at once.
BLOCK_READINGS = 1 << 20
#: Share of an alignment's slots that have to agree for all its windows to count.
AGREE = 0.5
#: Items that may hold a window for it to tell something about each of them.
OWN_ITEMS = 10
#: Sets windows of words as they are written apart from canonical ones.
LITERAL = np.uint64(0x5851F42D4C957F2D)

EDGES = "\"'`()[]{}<>*_~#&@.,;:!?¡¿…“”‘’«»–—/\\|+=-"
NUMBER = re.compile(r"[$€£]?\d[\d.,:/]*(?:%|st|nd|rd|th)?")
NUMBER_UNIT = re.compile(r"[$€£]?\d[\d.,]*([^\W\d_]+|°[cf]?)")
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty "
    "thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
UNITS = frozenset(
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms ton tons ounce ounces oz pound pounds lb lbs "
    "ml l liter liters litre litres gallon gallons second seconds sec minute minutes min hour hours hr day days week weeks month months year years "
    "percent % dollar dollars usd euro euros eur cent cents degree degrees °c °f mph kmh w kw v a hz khz mhz ghz kb mb gb tb".split()
)
EMPTY, WORD, NAME, NUM, UNIT, NUM_UNIT = range(6)


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))


#: What a placeholder counts as in a window; words count as their hash.
PLACEHOLDERS = np.array([0, 0, *(_hash(f"<{kind}>") for kind in ("name", "number", "unit", "number unit"))], dtype=np.uint64)


def _looks_a_name(core: str) -> bool:
    return core[:1].isupper() and len(core) > 1 and core[1:].islower() and core.isalpha()


def word_form(raw: str) -> tuple[int, int, bool, int]:
    """Kind (names and units as they would be in a fitting place), hash of the value, whether it ends a sentence, hash of the owner if a possessive."""
    if raw.isalpha():
        ends, core = False, raw
    else:
        ends = raw == "\n" or raw.rstrip("\"')]}”’»*").endswith((".", "!", "?"))
        core = raw.strip().strip(EDGES)
    low = core.lower()
    if core.isalpha():  # most words; the same outcome as below
        kind = NUM if low in NUMBER_WORDS else UNIT if low in UNITS else NAME if _looks_a_name(core) else WORD
        return kind, _hash(low), ends, 0
    if not core:
        return EMPTY, 0, ends, 0
    if NUMBER.fullmatch(low) or low in NUMBER_WORDS:
        return NUM, _hash(low), ends, 0
    if low in UNITS:
        return UNIT, _hash(low), ends, 0
    glued = NUMBER_UNIT.fullmatch(low)
    if glued and glued[1] in UNITS:
        return NUM_UNIT, _hash(low), ends, 0
    owner = _hash(low[:-2]) if low.endswith(("'s", "’s")) and _looks_a_name(core[:-2]) else 0
    return NAME if _looks_a_name(core) else WORD, _hash(low), ends, owner


class Windows:
    """Hashes of the canonical windows of a chunk of texts, and the values in their slots."""

    def __init__(self, texts: pa.Array, cache: WordCache):
        distinct, number, text_ends = split_words(pc.replace_substring(plain_space(pc.fill_null(texts, "")), "\n", " \n "))
        cache.shrink()
        forms = [cache[w] for w in distinct]
        kind = np.array([f[0] for f in forms], np.int8)[number]
        value = np.array([f[1] for f in forms], np.uint64)[number]
        ends = np.array([f[2] for f in forms], bool)[number]
        owner = np.array([f[3] for f in forms], np.uint64)[number]
        text = np.repeat(np.arange(len(text_ends)), np.diff(text_ends, prepend=0))
        blank = np.array([w == "" for w in distinct], bool)[number]
        kind, value, ends, text, owner = (x[~blank] for x in (kind, value, ends, text, owner))
        # a capital at the start of a sentence need not make a name, and a unit without a number is a word
        starts = np.ones(len(kind), bool)
        starts[1:] = ends[:-1] | (text[1:] != text[:-1])
        either = (kind == NAME) & starts | (owner != 0)
        kind[(kind == NAME) & starts] = WORD
        real = kind != EMPTY
        kind, word, self.text, self.either = kind[real], value[real], text[real], either[real]
        self.value = np.where(owner != 0, owner, value)[real]
        self.written = word
        number_before = np.zeros(len(kind), bool)
        number_before[1:] = (kind[:-1] == NUM) & (self.text[1:] == self.text[:-1])
        kind[(kind == UNIT) & ~number_before] = WORD
        self.slot = kind != WORD
        self.form = np.where(self.slot, PLACEHOLDERS[kind], word)
        self.name = kind == NAME
        # what another reading makes of a word's form
        self.other = np.where(self.name, word, PLACEHOLDERS[NAME]) - self.form
        self.first = np.searchsorted(self.text, np.arange(len(text_ends) + 1))

    def hashes(self, length: int, inner: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Where windows of ``length`` with enough real words start, which of their words are read the other way (bits), and their hashes.

        With ``inner`` a name in front of a window is read as a word too.
        """
        n = len(self.form) - length + 1
        if n <= 0:
            return
        real = np.concatenate([[0], np.cumsum(~self.slot)])
        real = real[length:] - real[:-length]
        inside = self.text[:n] == self.text[length - 1 :]
        total = np.full(n, length, np.uint64)
        for j in range(length):
            total = total * GOLDEN + self.form[j : j + n]
        weight = np.array([pow(int(GOLDEN), length - 1 - j, 1 << 64) for j in range(length)], np.uint64)
        at = np.flatnonzero(inside & (real >= MIN_WORDS))
        words, total_at, flipped = real[at], total[at], np.zeros(len(at), np.uint8)
        if inner:
            more = np.flatnonzero(inside & (real >= MIN_WORDS - 1) & self.name[:n])
            total_at = np.concatenate([total_at, total[more] + self.other[more] * weight[0]])
            at, words = np.concatenate([at, more]), np.concatenate([words, real[more] + 1])
            flipped = np.concatenate([flipped, np.ones(len(more), np.uint8)])
        free = np.concatenate([[0], np.cumsum(self.either)])
        block = np.cumsum(1 << (free[at + length] - free[at])) // BLOCK_READINGS
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), len(at)]
        for a, b in zip(cuts, cuts[1:]):
            yield self._readings(at[a:b], words[a:b], total_at[a:b], flipped[a:b], weight)

    def literal(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``hashes``, of the words as they are written."""
        n = max(0, len(self.written) - length + 1)
        total = np.full(n, LITERAL, np.uint64)
        for j in range(length):
            total = total * GOLDEN + self.written[j : j + n]
        at = np.flatnonzero(self.text[:n] == self.text[length - 1 :]) if n else np.zeros(0, np.int64)
        return at, np.zeros(len(at), np.uint8), mix(total[at])

    def _readings(self, at, words, total, flipped, weight) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """These windows and those in which words are names that may be; a name does not count as a real word."""
        for j, w in enumerate(weight):
            more = np.flatnonzero(self.either[at + j] & (words > MIN_WORDS))
            if len(more):
                total = np.concatenate([total, total[more] + self.other[at[more] + j] * w])
                flipped = np.concatenate([flipped, flipped[more] | np.uint8(1 << j)])
                at, words = np.concatenate([at, at[more]]), np.concatenate([words, words[more] - 1])
        return at, flipped, mix(total)

    def places(self, at: int, length: int, flipped: int) -> np.ndarray:
        """Where the slots of a window are."""
        return at + np.flatnonzero(self.slot[at : at + length] ^ ((flipped >> np.arange(length)) & 1).astype(bool))


def _rows(ids: pa.Array, windows: Windows, at: np.ndarray, flipped: np.ndarray, hashes: np.ndarray, length: int, key: str) -> pa.RecordBatch:
    text = windows.text[at]
    slots = [windows.value[windows.places(a, length, f)].view(np.int64).tolist() for a, f in zip(at, flipped)]
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(text)), pa.array(at - windows.first[text], pa.int64()), pa.array(hashes.view(np.int64)), pa.array(slots, pa.list_(pa.int64()))],
        names=[key, "pos", "hash", "slots"],
    )


def _item_rows(ids: pa.Array, windows: Windows, at: np.ndarray, flipped: np.ndarray, hashes: np.ndarray, length: int, literal: bool) -> pa.RecordBatch:
    if literal:  # the words stand for themselves, there are no slots
        text, slots, places = windows.text[at], [[]] * len(at), [[]] * len(at)
        rows = [ids.take(pa.array(text)), pa.array(at - windows.first[text], pa.int64()), pa.array(hashes.view(np.int64)), pa.array(slots, pa.list_(pa.int64()))]
    else:
        first = windows.first[windows.text[at]]
        rows = _rows(ids, windows, at, flipped, hashes, length, "item_id").columns
        places = [(windows.places(a, length, f) - b).tolist() for a, f, b in zip(at, flipped, first)]
    more = [pa.array(np.full(len(at), length)), pa.array(flipped == 0), pa.array(places, pa.list_(pa.int64())), pa.array(np.full(len(at), literal))]
    return pa.RecordBatch.from_arrays([*rows, *more], names=["item_id", "pos", "hash", "slots", "length", "plain", "places", "literal"])


def item_windows(benchmark: DataFrame) -> DataFrame:
    """item_id, pos, hash, slots, length, whether it is the plain reading, the slots' places, and whether it is literal, of every window.

    An item of fewer words is one window.
    """

    def run(batches):
        cache = WordCache(word_form)
        for batch in chunks(batches):
            windows = Windows(batch.column("text"), cache)
            sizes, found = np.diff(windows.first), np.zeros(batch.num_rows, bool)
            for length in range(1, WINDOW + 1):
                for at, flipped, hashes in windows.hashes(length):
                    if length < WINDOW:
                        own = sizes[windows.text[at]] == length
                        at, flipped, hashes = at[own], flipped[own], hashes[own]
                    found[windows.text[at]] = True
                    if len(at):
                        yield _item_rows(batch.column("item_id"), windows, at, flipped, hashes, length, False)
            for length in range(MIN_WORDS, WINDOW + 1):
                at, flipped, hashes = windows.literal(length)
                own = ~found[windows.text[at]] & ((sizes[windows.text[at]] == length) | (length == WINDOW))
                if own.any():
                    yield _item_rows(batch.column("item_id"), windows, at[own], flipped[own], hashes[own], length, True)

    found = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(
        run, "item_id long, pos long, hash long, slots array<long>, length long, plain boolean, places array<long>, literal boolean"
    )
    return found.dropDuplicates(["item_id", "pos", "hash"])


def document_windows(documents: DataFrame, field: bytes, lengths: list[int], literal: Sequence[int] = ()) -> DataFrame:
    """doc_id, pos, hash and slots of the windows whose bit is set."""
    shared = documents.sparkSession.sparkContext.broadcast(field)

    def has(bits, hashes):
        bit = hashes >> np.uint64(64 - FIELD_BITS)
        return (bits[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1

    def run(batches):
        bits, cache = np.frombuffer(shared.value, "<u8"), WordCache(word_form)
        for batch in chunks(batches):
            windows = Windows(batch.column("text"), cache)
            for length in lengths:
                for at, flipped, hashes in windows.hashes(length, inner=True):
                    known = has(bits, hashes)
                    if known.any():
                        yield _rows(batch.column("doc_id"), windows, at[known], flipped[known], hashes[known], length, "doc_id")
            for length in literal:
                at, flipped, hashes = windows.literal(length)
                known = has(bits, hashes)
                if known.any():
                    rows = _item_rows(batch.column("doc_id"), windows, at[known], flipped[known], hashes[known], length, True)
                    yield pa.RecordBatch.from_arrays(rows.columns[:4], names=["doc_id", "pos", "hash", "slots"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, pos long, hash long, slots array<long>"
    )


def _bit_field(items: DataFrame) -> bytes:
    """The windows' bits, at most 2^FIELD_BITS of them however many items there are."""
    bit = F.shiftrightunsigned("hash", 64 - FIELD_BITS)
    words = items.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - FIELD_BITS}) & 63 as int))")).alias("bits"))
    field = np.zeros(1 << (FIELD_BITS - 6), np.int64)
    for row in words.collect():
        field[row["word"]] = row["bits"]
    return field.tobytes()


def counted(windows: list[dict]) -> tuple[list[int], int]:
    """Where in the item the windows of one alignment are that count, and how many different slots those hold."""
    slots = [set(zip(w["places"], w["item_slots"], w["slots"])) for w in windows]
    pairs = set().union(*slots)
    held = Counter((own, value) for _, own, value in pairs)
    partner = {own: value for own, value in sorted(held, key=lambda x: (held[x], x[0] == x[1], x[1]))}
    apart = {x for x in pairs if x[2] not in (x[1], partner[x[1]])}
    if len(apart) > (1 - AGREE) * len(pairs):
        windows = [w for w, x in zip(windows, slots) if not x & apart]
        slots = [x for x in slots if not x & apart]
    return sorted({w["item_pos"] for w in windows}), len({x[1:] for x in set().union(*slots)})


def _aligned(batches):
    for batch in batches:
        found = [counted(w) for w in batch.column("windows").to_pylist()]
        kept = pa.array([bool(places) for places, _ in found], pa.bool_())
        columns = [batch.column(k) for k in ("doc_id", "item_id", "item_windows")]
        columns += [pa.array([x[0] for x in found], pa.list_(pa.int64())), pa.array([x[1] for x in found], pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "item_windows", "places", "slots"]).filter(kept)


def contaminated(documents: DataFrame, benchmark: DataFrame, store: StageStore) -> DataFrame:
    """(doc_id, item_id, hits, item_windows, slots) for every document that holds an item or a long run of it."""
    items = store.save(item_windows(benchmark), "item-windows")
    by_hash = items.groupBy(F.col("hash").alias("_hash")).agg(F.countDistinct(F.coalesce("item_id", F.lit(-(1 << 63)))).alias("_items"))
    items = items.join(by_hash, F.col("hash") == F.col("_hash")).withColumn("_own", F.col("_items") <= OWN_ITEMS)
    totals = items.groupBy(F.col("item_id").alias("_item")).agg(
        F.countDistinct(F.when(F.col("_own"), F.col("pos"))).alias("_own_windows"), F.countDistinct("pos").alias("_windows")
    )
    items = items.join(totals, F.col("item_id").eqNullSafe(F.col("_item"))).filter(F.col("_own") | (F.col("_own_windows") == 0))
    items = items.withColumn("item_windows", F.when(F.col("_own_windows") > 0, F.col("_own_windows")).otherwise(F.col("_windows")))
    items = store.save(items.drop("_hash", "_items", "_own", "_item", "_own_windows", "_windows"), "own-windows")
    lengths = {kind: sorted(r["length"] for r in items.filter(F.col("literal") == kind).select("length").distinct().collect()) for kind in (False, True)}
    found = store.save(document_windows(documents, _bit_field(items), lengths[False], lengths[True]), "document-windows")
    side = items.select("item_id", "item_windows", F.col("pos").alias("item_pos"), "hash", "plain", "places", F.col("slots").alias("item_slots"))
    side = small_side(store.save(side, "items"))
    aligned = (
        found.join(side, "hash")
        .groupBy("doc_id", "item_id", "item_windows", (F.col("pos") - F.col("item_pos")).alias("shift"))
        .agg(F.collect_set(F.struct("item_pos", "plain", "places", "item_slots", "slots")).alias("windows"))
        .mapInArrow(_aligned, "doc_id long, item_id long, item_windows long, places array<long>, slots int")
    )
    return (
        aligned.groupBy("doc_id", "item_id", "item_windows")
        .agg(F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("long").alias("hits"), F.max("slots").alias("slots"))
        .filter(F.col("hits") >= F.least(F.col("item_windows"), F.lit(MIN_WINDOWS)))
        .select("doc_id", "item_id", "hits", "item_windows", "slots")
    )


def without_contaminated(documents: DataFrame, found: DataFrame) -> DataFrame:
    """The documents whose id no item was found in; all their columns stay."""
    ids = found.select(F.col("doc_id").alias("_leaked_id")).distinct()
    return documents.join(ids, F.col("doc_id").eqNullSafe(F.col("_leaked_id")), "left_anti")
