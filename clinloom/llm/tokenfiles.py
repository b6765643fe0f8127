"""Token ids in Arrow files of fixed-size lists.

Documents are range-partitioned on their id and encoded; the ids of a shard,
end ids included, are cut into sequences of equal length and written as one
Arrow file: a column ``tokens`` (fixed-size list) and a column ``mask`` (true:
a token, false: the padding of the last sequence). Record batches hold equally
many sequences, so sequence ``i`` is row ``i % B`` of batch ``i // B`` and a
memory-mapped file gives it without a copy. A second file per shard has each
document's place. Files are written under a name of the attempt and then moved,
so a repeated task only replaces a file by an equal one.

A null text counts as empty (one end id). Repeated ids keep all their rows, in
the order of their texts; a null id comes first. An empty table gives no rows.
Other columns of the input are left alone.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinloom.llm.common import chunks
from clinloom.staging import StageStore

SEQUENCE = 2048
BATCH_SEQUENCES = 64
CACHED_WORDS = 500_000
#: ASCII punctuation but the apostrophe, with which the vocabulary begins words.
PUNCTUATION = r"[!-&(-/:-@\[-`{-~]"
#: Words that every pre-tokenizer keeps whole.
LETTERS = re.compile("[a-zß-öø-ÿ]+")


class Encoder:
    """Whole texts to ids, word by word, with the ids of recent words kept.

    Holds for vocabularies that lower the case, drop white space and never join
    across it or between letters and punctuation, as the given word vocabulary.
    """

    _loaded: dict[str, Encoder] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.words: dict[str, bytes] = {"": b""}
        # the ids that end a word, where the vocabulary tells them apart
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        tokens = map(self.tokenizer.id_to_token, range(self.tokenizer.get_vocab_size()))
        self.last = np.array([bool(suffix and token and token.endswith(suffix)) for token in tokens])

    @classmethod
    def load(cls, path: str) -> Encoder:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _learn(self, new: list[str]) -> None:
        """Words of letters are encoded as one text and parted by the ids that end a word, all others one by one."""
        letters = list(map(LETTERS.fullmatch, new))
        for words, together in (([w for w, m in zip(new, letters) if m], True), ([w for w, m in zip(new, letters) if not m], False)):
            for a in range(0, len(words), 20_000):
                part = words[a : a + 20_000]
                flat, ends = self._together(part) if together else self._apart(part)
                self.words.update((word, flat[a:b]) for word, a, b in zip(part, [0, *ends], ends))

    def _apart(self, words: list[str]) -> tuple[bytes, list[int]]:
        """The ids of all words, and each word's end in their bytes."""
        ids = [found.ids for found in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(ids), self.dtype).tobytes()
        return flat, list(accumulate(len(x) * self.dtype.itemsize for x in ids))

    def _together(self, words: list[str]) -> tuple[bytes, list[int]]:
        """``_apart``, in one call; a vocabulary without as many ends as words has them encoded apart."""
        [found] = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(found.ids, self.dtype)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            return self._apart(words)
        return ids.tobytes(), (ends * self.dtype.itemsize).tolist()

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Each text's ids (null: none). Every distinct word is looked up once, and its ids are copied to its places."""
        texts = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        # fewer distinct words: lower case, and punctuation that ends a word as a word; not where special tokens or other scripts occur
        plain = pc.replace_substring_regex(pc.utf8_lower(texts), f"([a-zß-öø-ÿ])({PUNCTUATION}+)( |$)", r"\1 \2\3")
        texts = pc.if_else(pc.match_substring_regex(texts, r"<\||[^\x{00}-\x{ff}]"), texts, plain)
        split = pc.split_pattern(texts, " ")
        places = split.flatten().dictionary_encode()
        distinct = places.dictionary.to_pylist()
        found = list(map(self.words.get, distinct))
        new = [i for i, ids in enumerate(found) if ids is None]
        if len(self.words) + len(new) > CACHED_WORDS:
            self.words = {"": b""}
        self._learn([distinct[i] for i in new])
        for i in new:
            found[i] = self.words[distinct[i]]
        flat = np.frombuffer(b"".join(found), self.dtype)
        length = np.array([len(x) for x in found], dtype=np.int64) // self.dtype.itemsize
        start = np.cumsum(length) - length
        word = places.indices.to_numpy()
        counts = length[word]
        ends = np.cumsum(counts)
        ids = flat[np.repeat(start[word] - (ends - counts), counts) + np.arange(counts.sum())]
        cuts = np.concatenate([[0], ends])[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]


class SequenceWriter:
    """Appends ids to an Arrow file of fixed-size lists."""

    def __init__(self, sink, dtype: np.dtype, length: int):
        self.dtype, self.length = dtype, length
        self.schema = pa.schema([("tokens", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))])
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.held, self.bytes = [], 0

    def append(self, ids: bytes) -> None:
        self.held.append(ids)
        self.bytes += len(ids)
        block = self.length * BATCH_SEQUENCES * self.dtype.itemsize
        if self.bytes >= block:
            whole = b"".join(self.held)
            cut = len(whole) - len(whole) % block
            for a in range(0, cut, block):
                self._write(np.frombuffer(whole, self.dtype, block // self.dtype.itemsize, a))
            self.held, self.bytes = [whole[cut:]], len(whole) - cut

    def _write(self, ids: np.ndarray) -> None:
        rows = -(-len(ids) // self.length)
        tokens, mask = np.zeros(rows * self.length, self.dtype), np.zeros(rows * self.length, bool)
        tokens[: len(ids)], mask[: len(ids)] = ids, True
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (tokens, mask)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        if self.bytes:
            self._write(np.frombuffer(b"".join(self.held), self.dtype))
        self.writer.close()


def _shard_writer(folder: str, vocabulary: str, end_id: int, length: int):
    places = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.load(vocabulary)
        end = np.array([end_id], encoder.dtype).tobytes()
        shard, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        files, root = pafs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        name = f"{root}/shard-{shard:06d}"
        at = rows = 0
        sink = index = None
        for batch in chunks(batches):
            if sink is None:
                sink, index_sink = (files.open_output_stream(f"{name}{kind}.{attempt}") for kind in (".arrow", ".docs.arrow"))
                writer, index = SequenceWriter(sink, encoder.dtype, length), pa.ipc.new_file(index_sink, places)
            starts, counts = [], []
            for ids in encoder.encode(batch.column("text")):
                writer.append(ids.tobytes() + end)
                starts.append(at)
                counts.append(len(ids) + 1)
                at += counts[-1]
            rows += batch.num_rows
            index.write_batch(pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(starts), pa.array(counts)], schema=places))
        if sink is None:
            return
        for open_file in (writer, index, sink, index_sink):
            open_file.close()
        for kind in (".arrow", ".docs.arrow"):
            files.move(f"{name}{kind}.{attempt}", f"{name}{kind}")
        yield pa.RecordBatch.from_pydict({"shard": [shard], "rows": [rows], "tokens": [at], "name": [f"shard-{shard:06d}"]})

    return run


def write_tokens(documents: DataFrame, store: StageStore, vocabulary: str, end_id: int = 1, length: int = SEQUENCE) -> DataFrame:
    """Encode and write all documents; one row per shard: shard, rows, tokens, first (ids before it), name, folder."""
    folder = store.path("tokens")
    ordered = (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    )
    written = store.save(
        ordered.mapInArrow(_shard_writer(folder, vocabulary, end_id, length), "shard long, rows long, tokens long, name string"), "shards"
    )
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return written.withColumn("first", F.coalesce(F.sum("tokens").over(earlier), F.lit(0))).withColumn("folder", F.lit(folder))


class SequenceReader:
    """Random access to the sequences of one shard file."""

    def __init__(self, files: pafs.FileSystem, path: str):
        self.file = pa.memory_map(path) if isinstance(files, pafs.LocalFileSystem) else files.open_input_file(path)
        self.reader = pa.ipc.open_file(self.file)
        self.length = self.reader.schema.field("tokens").type.list_size
        self._batch: tuple[int, np.ndarray] = (-1, np.zeros(0))

    def batch(self, number: int) -> np.ndarray:
        if self._batch[0] != number:
            column = self.reader.get_batch(number).column("tokens")
            self._batch = number, column.flatten().to_numpy()
        return self._batch[1]

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence ``i``."""
        record = self.reader.get_batch(i // BATCH_SEQUENCES)
        return tuple(record.column(c)[i % BATCH_SEQUENCES].values.to_numpy(zero_copy_only=False) for c in ("tokens", "mask"))

    def span(self, start: int, count: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` on, in pieces of a batch at most."""
        per_batch = self.length * BATCH_SEQUENCES
        while count:
            number, at = divmod(start, per_batch)
            piece = self.batch(number)[at : at + count]
            yield piece
            start, count = start + len(piece), count - len(piece)

    def close(self) -> None:
        self.file.close()


def _shard_reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            files, root = pafs.FileSystem.from_uri(row["folder"])
            reader = SequenceReader(files, f"{root}/{row['name']}.arrow")
            with files.open_input_file(f"{root}/{row['name']}.docs.arrow") as index_file:
                index = pa.ipc.open_file(index_file)
                for number in range(index.num_record_batches):
                    places = index.get_batch(number)
                    checks = []
                    for start, count in zip(places.column("start").to_pylist(), places.column("n_tokens").to_pylist()):
                        check = 0
                        for piece in reader.span(start, count):
                            check = zlib.crc32(piece.astype("<u4").tobytes(), check)
                        checks.append(check)
                    first = np.int64(row["first"])
                    yield pa.RecordBatch.from_arrays(
                        [places.column("doc_id"), pa.array(places.column("start").to_numpy() + first), places.column("n_tokens"), pa.array(checks, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
            reader.close()


def read_tokens(shards: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start among all ids, n_tokens and the checksum of its ids as 32-bit numbers."""
    return shards.repartition("shard").mapInArrow(_shard_reader, "doc_id long, start long, n_tokens long, ids_crc32 long")
