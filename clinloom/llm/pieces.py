"""SentencePiece encoding and decoding of merge-type (BPE) vocabularies.

A text is normalised, cut into symbols, and adjacent pairs of symbols wait in
an agenda ordered by the score of the piece they would make (ties: the left
one first). The best pair is merged, its neighbours form new pairs, until no
pair makes a piece; characters without a piece become byte pieces.

Two characters that stand side by side in no piece are never merged, so a text
is first cut between such characters; the cuts follow from the vocabulary, not
from a rule about languages. Every distinct segment of a batch goes through the
agenda once and its ids are copied to its places. The agendas of short segments
advance side by side, one merge each a round, in numpy; a long segment has a
heap of its own. Every Arrow batch is checked against the sentencepiece
library, id by id and text by text; a difference ends the task with an error.

A null or empty text gives the end id alone and decodes to "". Texts of any
length are encoded whole. Repeated rows and ids give a row each; an empty table
gives no rows. Other columns of the input are left alone.
"""

from __future__ import annotations

import codecs
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from clinloom.llm.common import GOLDEN, byte_rows, chunks, give_back, small_batches

#: Longest segment, in characters, whose agenda advances side by side with others.
SIDE_BY_SIDE = 48
#: Segments whose ids a worker keeps, and their bytes.
KEPT_SEGMENTS = 400_000
KEPT_BYTES = 32 << 20
SEGMENTS_AT_ONCE = 20_000
#: Text encoded at once.
TEXT_BYTES = 4 << 20

#: Kinds of pieces in a model file, and the model type of merge vocabularies (fixed values of the format).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE, UNUSED = 1, 2, 3, 4, 6, 5
BPE = 2
#: How the format writes a space.
SPACE = "▁"

CODE_POINTS = 0x110000


def _one_byte(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("one_byte", _one_byte)


class Vocabulary:
    """What encoding and decoding need of a model file.

    Symbols are numbered: a piece by its id, a character without a piece by the
    number of ids plus its code point.
    """

    _loaded: dict[str, Vocabulary] = {}

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules, trained = model.normalizer_spec, model.trainer_spec
        kinds = [p.type for p in model.pieces]
        if trained.model_type != BPE or not trained.byte_fallback:
            raise ValueError("The agenda needs a merge-type vocabulary with byte pieces.")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces or trained.treat_whitespace_as_suffix:
            raise ValueError("Only spaces may be rewritten by the vocabulary's normaliser.")
        if USER_DEFINED in kinds or UNUSED in kinds:
            raise ValueError("User-defined and unused pieces are not supported.")
        self.library = SentencePieceProcessor(model_file=path)
        self.prefix = " " if rules.add_dummy_prefix else ""
        self.size, self.end_id = len(model.pieces), self.library.eos_id()
        self.surfaces = [self._surface(p.type, p.piece.replace(SPACE, " "), trained.unk_surface) for p in model.pieces]
        firsts = [x[k == NORMAL and x[:1] == b" " :] for x, k in zip(self.surfaces, kinds)]
        self.both_surfaces = pa.array(self.surfaces + firsts, pa.large_binary())
        self.byte_ids = np.zeros(256, np.int64)
        for i, piece in enumerate(model.pieces):
            if piece.type == BYTE:
                self.byte_ids[int(piece.piece[3:5], 16)] = i
        words = {p.piece.replace(SPACE, " "): i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.of_character = np.arange(CODE_POINTS, dtype=np.int64) + self.size
        for word, i in words.items():
            if len(word) == 1:
                self.of_character[ord(word)] = i
        scores = np.array([p.score for p in model.pieces], np.float64)
        self.rank = np.unique(scores, return_inverse=True)[1].astype(np.int32)  # higher is better, equal scores share one
        self._tabulate(words)

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    @staticmethod
    def _surface(kind: int, piece: str, unknown: str) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        return b"" if kind == CONTROL else (unknown if kind == UNKNOWN else piece).encode()

    def _symbol(self, word: str, words: dict[str, int]) -> int | None:
        return int(self.of_character[ord(word)]) if len(word) == 1 else words.get(word)

    def _tabulate(self, words: dict[str, int]) -> None:
        """The pairs that make a piece, and which characters stand side by side in one (all beyond ASCII as one class)."""
        pairs, self.joined = {}, np.zeros((129, 129), bool)
        for word, i in words.items():
            classes = [min(ord(c), 128) for c in word]
            self.joined[classes[:-1], classes[1:]] = True
            for cut in range(1, len(word)):
                left, right = self._symbol(word[:cut], words), self._symbol(word[cut:], words)
                if left is not None and right is not None:
                    pairs[left * (self.size + CODE_POINTS) + right] = i
        self.pairs = pairs
        self._hash(np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int64))

    def _hash(self, keys: np.ndarray, values: np.ndarray) -> None:
        """An open-addressing table, at most a quarter full."""
        self.shift = 64 - max(4, int(4 * len(keys)).bit_length())
        self.slot_keys, self.slot_pieces = (np.full(1 << (64 - self.shift), -1, np.int64) for _ in range(2))
        slots = self._slot(keys)
        while len(keys):
            free = self.slot_keys[slots] < 0
            self.slot_keys[slots[free]], self.slot_pieces[slots[free]] = keys[free], values[free]
            rest = self.slot_keys[slots] != keys  # the place was taken, maybe just now
            keys, values, slots = keys[rest], values[rest], (slots[rest] + 1) & (len(self.slot_keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * GOLDEN) >> np.uint64(self.shift)).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols makes, or -1; a symbol below 0 stands for none."""
        keys = np.where((left >= 0) & (right >= 0), left * (self.size + CODE_POINTS) + right, 0).ravel()
        slots = self._slot(keys)
        there = self.slot_keys[slots]
        found = np.where(there == keys, self.slot_pieces[slots], -1)
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & (len(self.slot_keys) - 1)
            there = self.slot_keys[slots[open_]]
            hit = there == keys[open_]
            found[open_[hit]] = self.slot_pieces[slots[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        return found.reshape(left.shape)

    def symbols(self, text: str) -> np.ndarray:
        return self.of_character[np.frombuffer(text.encode("utf-32-le"), np.uint32)]

    def ids(self, symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of segments from their symbols: a character without a piece is its bytes."""
        if not len(symbols) or symbols.max() < self.size:
            return symbols, counts
        parts = [[s] if s < self.size else self.byte_ids[list(chr(s - self.size).encode())] for s in symbols.tolist()]
        reach = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
        ends = np.cumsum(counts)
        return np.concatenate(parts).astype(np.int64), reach[ends] - reach[ends - counts]


def long_agenda(vocabulary: Vocabulary, symbols: np.ndarray) -> np.ndarray:
    """The symbols that are left of one segment; its agenda is a heap."""
    n = len(symbols)
    at = symbols.tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    rank = vocabulary.rank
    first = vocabulary.merged(symbols[:-1], symbols[1:])
    agenda = [(-int(rank[p]), i, i + 1, at[i], at[i + 1], p) for i, p in enumerate(first.tolist()) if p >= 0]
    heapq.heapify(agenda)
    pairs = vocabulary.pairs
    wide = vocabulary.size + CODE_POINTS
    while agenda:
        _, left, right, was_left, was_right, piece = heapq.heappop(agenda)
        if at[left] != was_left or right >= n or at[right] != was_right or after[left] != right:
            continue  # a neighbour took one of the two
        at[left], at[right] = piece, -1
        after[left] = after[right]
        if after[left] < n:
            before[after[left]] = left
        for a, b in ((before[left], left), (left, after[left])):
            if a >= 0 and b < n and (p := pairs.get(at[a] * wide + at[b])) is not None:
                heapq.heappush(agenda, (-int(rank[p]), a, b, at[a], at[b], p))
    return np.array([s for s in at if s >= 0], np.int64)


def side_by_side(vocabulary: Vocabulary, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols that are left of many segments, one after another, and how many of each.

    ``symbols`` holds the segments one after another. Each segment is a row of
    a matrix; a round takes the best pair of every row that still has one.
    """
    rows, width = len(lengths), int(lengths.max())
    filled = np.arange(width) < lengths[:, None]
    at = np.full((rows, width + 1), -1, np.int64)
    at[:, :width][filled] = symbols
    after = np.tile(np.arange(1, width + 2), (rows, 1))
    before = np.tile(np.arange(-1, width), (rows, 1))
    piece = np.full((rows, width + 1), -1, np.int64)
    piece[:, :width] = vocabulary.merged(at[:, :-1], at[:, 1:])
    score = np.where(piece >= 0, vocabulary.rank[piece], -1)
    live = np.arange(rows)
    while len(live):
        left = score[live].argmax(axis=1)  # the first of equal scores
        some = score[live, left] >= 0
        live, left = live[some], left[some]
        right = after[live, left]
        last = after[live, right]
        at[live, left] = piece[live, left]
        at[live, right], score[live, right] = -1, -1
        after[live, left], before[live, last] = last, left
        first = before[live, left]
        new = vocabulary.merged(at[live, left], at[live, last])
        piece[live, left], score[live, left] = new, np.where(new >= 0, vocabulary.rank[new], -1)
        inner = first >= 0
        r, a = live[inner], first[inner]
        new = vocabulary.merged(at[r, a], at[r, left[inner]])
        piece[r, a], score[r, a] = new, np.where(new >= 0, vocabulary.rank[new], -1)
    kept = at >= 0
    return at[kept], kept.sum(axis=1)


class Encoder:
    """Texts to ids; keeps the ids of a bounded number of segments."""

    _made: dict[str, Encoder] = {}

    def __init__(self, path: str):
        self.vocabulary = Vocabulary.load(path)
        self._forget()

    @classmethod
    def load(cls, path: str) -> Encoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.bytes = 0
        self.flat, self.start, self.count = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.used = 0

    def _learn(self, new: list[bytes]) -> None:
        """Send new segments through their agendas and keep their ids."""
        text = b"".join(new).decode()
        symbols = self.vocabulary.symbols(text)
        lengths = np.fromiter((len(s.decode()) for s in new), np.int64, len(new))
        starts = np.cumsum(lengths) - lengths
        order = np.argsort(lengths, kind="stable")
        sizes = lengths[order]
        ids, counts, a = [], [], 0
        while a < len(order):
            width = int(sizes[a])
            if width > SIDE_BY_SIDE:
                at = starts[order[a]]
                left, b = long_agenda(self.vocabulary, symbols[at : at + width]), a + 1
                each = np.array([len(left)])
            else:
                b = min(a + SEGMENTS_AT_ONCE, int(np.searchsorted(sizes, min(SIDE_BY_SIDE, width + width // 4), side="right")))
                n = sizes[a:b]
                left, each = side_by_side(self.vocabulary, symbols[np.repeat(starts[order[a:b]] - (np.cumsum(n) - n), n) + np.arange(n.sum())], n)
            left, each = self.vocabulary.ids(left, each)
            ids.append(left)
            counts.append(each)
            a = b
        flat, counts, known = np.concatenate(ids), np.concatenate(counts), len(self.number)
        self.flat = self._room(self.flat, self.used + len(flat))
        self.start, self.count = self._room(self.start, known + len(new)), self._room(self.count, known + len(new))
        self.flat[self.used : self.used + len(flat)] = flat
        self.start[known : known + len(new)] = self.used + np.cumsum(counts) - counts
        self.count[known : known + len(new)] = counts
        self.used += len(flat)
        self.number.update(zip(map(new.__getitem__, order.tolist()), range(known, known + len(new))))
        self.bytes += len(text)

    @staticmethod
    def _room(values: np.ndarray, needed: int) -> np.ndarray:
        if needed <= len(values):
            return values
        wider = np.zeros(max(needed, 2 * len(values)), values.dtype)
        wider[: len(values)] = values
        return wider

    def _segments(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The segments of all texts one after another, and each text's end among them."""
        texts = pc.replace_substring(pc.fill_null(texts, ""), SPACE, " ")
        if self.vocabulary.prefix:
            texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(self.vocabulary.prefix, texts, ""))
        data, ends = byte_rows(texts)
        if not len(data):
            return pa.array([], pa.large_binary()), np.zeros(len(ends), np.int64)
        kind = np.minimum(data, 128)
        cut = np.ones(len(data) + 1, bool)
        cut[1:-1] = ~self.vocabulary.joined[kind[:-1], kind[1:]] & ((data[1:] & 0xC0) != 0x80)
        cut[ends] = True
        edges = np.flatnonzero(cut)
        segments = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
        return segments, np.searchsorted(edges, ends)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, end ids included, and each text's end among them."""
        segments, segment_ends = self._segments(texts)
        coded = segments.dictionary_encode()
        distinct, places = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        if len(self.number) > KEPT_SEGMENTS or self.bytes > KEPT_BYTES:
            self._forget()
        new = [s for s in distinct if s not in self.number]
        if new:
            self._learn(new)
        numbers = np.fromiter(map(self.number.__getitem__, distinct), np.int64, len(distinct))[places]
        counts = self.count[numbers]
        reach = np.concatenate([[0], np.cumsum(counts)])
        ends = reach[segment_ends] + np.arange(1, len(segment_ends) + 1)  # an end id behind each text
        ids = np.full(ends[-1] if len(ends) else 0, self.vocabulary.end_id, np.int32)
        inner = np.ones(len(ids), bool)
        inner[ends - 1] = False
        ids[inner] = self.flat[np.repeat(self.start[numbers] - reach[:-1], counts) + np.arange(reach[-1])]
        return ids, ends


def decode(vocabulary: Vocabulary, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The texts of ids that stand one after another; a byte that is no UTF-8 becomes U+FFFD."""
    offsets, which = np.concatenate([[0], ends]), ids.astype(np.int64)
    if vocabulary.prefix:  # the space that encoding put before the text goes
        which[offsets[:-1][ends > offsets[:-1]]] += vocabulary.size
    taken = vocabulary.both_surfaces.take(pa.array(which))
    joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets), taken), pa.scalar(b"", pa.large_binary()))
    try:
        return joined.cast(pa.large_string())
    except pa.ArrowInvalid:
        return pa.array([x.decode("utf-8", "one_byte") for x in joined.to_pylist()], pa.large_string())


def check(vocabulary: Vocabulary, texts: pa.Array, ids: np.ndarray, ends: np.ndarray, decoded: pa.Array) -> None:
    """Compare a batch with the library: ids one by one, texts whole."""
    wanted = vocabulary.library.encode(pc.fill_null(texts, "").to_pylist(), add_eos=True, num_threads=1)
    counts = np.array([len(x) for x in wanted], np.int64)
    same = np.array_equal(np.cumsum(counts), ends) and np.array_equal(np.concatenate([np.array(x, np.int32) for x in wanted]), ids)
    if not same or vocabulary.library.decode(wanted, num_threads=1) != decoded.to_pylist():
        raise RuntimeError("Encoded or decoded texts differ from those of the sentencepiece library.")


def _encoder(model: str, checked: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.load(model)
        for batch in chunks(batches, limit=TEXT_BYTES):
            texts = batch.column("text")
            ids, ends = encoder.encode(texts)
            decoded = decode(encoder.vocabulary, ids, ends)
            if checked:
                check(encoder.vocabulary, texts, ids, ends, decoded)
            offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, decoded.cast(pa.string())], names=["doc_id", "ids", "decoded"])
        give_back()

    return run


def encoded(documents: DataFrame, model: str, checked: bool = True) -> DataFrame:
    """doc_id, ids (end id last) and the text that the ids decode to, of every row."""
    small_batches(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(_encoder(model, checked), f"doc_id {kind}, ids array<int>, decoded string")
