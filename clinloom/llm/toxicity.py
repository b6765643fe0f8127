"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a probability, logistic in
its words and in how they begin; the document's is their noisy-or, ``1 - prod(1 - p)``. Only
documents are labelled, and the word weights are fitted by gradient descent
through the noisy-or, so the model also tells which sentence offends.

Sentences end at ``.``, ``!``, ``?`` or a line break; one of more than 64 words
counts as several, so nothing is left out. Null and empty texts hold no
sentence and score 0. Without labels of both kinds every score is 0. Very long
texts are scored whole. Ties and repeated rows get equal scores. An empty table
gives no rows.
"""

from __future__ import annotations

import pickle
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm import labelled
from clinloom.llm.common import chunks, plain_space

FEATURES = 1 << 18
SENTENCE_WORDS = 64
EPOCHS = 120
RATE = 0.1
CALM = 1e-3
DECAY = 0.3
CLEAR = 3.0
TOXIC_WEIGHT = 4
#: Sentences from this probability on are returned, and documents from this score on are rejected.
SENTENCE_SCORE = 0.05
REJECTED = 0.7
#: Documents counted at once in fitting, and bytes of text scored at once.
BLOCK_DOCUMENTS = 250
CHUNK = 1 << 20
PREFIXES = range(3, 8)
EDGES = "\"'`()[]{}<>*_~#&%$@.,;:!?¡¿…“”‘’«»-–—/\\|+="


SENTENCES = pa.list_(pa.struct([("sentence", pa.int64()), ("score", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]))


def words_of(text: str) -> list[str]:
    return text.replace("\n", " \n ").split(" ") if text else []


def features(word: str) -> list[int]:
    """Of the whole word, and of its beginnings of 3 to 7 letters: inflected and compound words share those."""
    core = word.strip(EDGES).lower()
    if not core.strip():
        return []
    names = {"=" + core, *(core[:n] for n in PREFIXES if len(core) >= n)}
    return sorted({zlib.crc32(x.encode("utf-8", "surrogatepass")) % FEATURES for x in names})


def packed_features(word: str) -> bytes:
    return np.array(features(word), dtype="<u4").tobytes()


def ends(word: str) -> bool:
    return word == "\n" or word.rstrip("\"')]}”’»*").endswith((".", "!", "?"))


class Words(dict):
    """Raw word to twice its number in ``values``, plus one if it ends a sentence."""

    def __init__(self, value, limit: int = 200_000):
        super().__init__()
        self.value, self.limit, self.values = value, limit, []

    def __missing__(self, word: str) -> int:
        code = self[word] = 2 * len(self.values) + ends(word)
        self.values.append(self.value(word))
        return code

    def shrink(self) -> None:
        """Between chunks: forget all, if too much is known."""
        if len(self) > self.limit:
            self.forget()

    def forget(self) -> None:
        self.clear()
        self.values = []


def sentence_numbers(last: np.ndarray, document: np.ndarray) -> np.ndarray:
    """For every word the number of its sentence, over all the documents of a chunk."""
    n = len(last)
    new = np.ones(n, bool)
    new[1:] = last[:-1] | (document[1:] != document[:-1])
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    new |= (np.arange(n) - start) % SENTENCE_WORDS == 0
    return np.cumsum(new) - 1


def _parse(texts: list[str], cache: Words, keep: bool = False) -> tuple[list[list[str]], np.ndarray, np.ndarray, np.ndarray]:
    """The words, each word's number in the cache and in the sentences, and each sentence's document."""
    rows = [words_of(t) for t in texts]
    document = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    if not keep:
        cache.shrink()
    code = np.fromiter((c for r in rows for c in map(cache.__getitem__, r)), np.int32, len(document))
    sentence = sentence_numbers((code & 1).astype(bool), document) if len(document) else document
    first = np.flatnonzero(np.diff(sentence, prepend=-1))
    return rows, code >> 1, sentence, document[first]


def _parse_blocks(texts: list[str], cache: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``_parse``, without the words, and some documents at a time."""
    words, sentences, documents, before = [], [], [], 0
    for a in range(0, len(texts), BLOCK_DOCUMENTS):
        _, word, sentence, document = _parse(texts[a : a + BLOCK_DOCUMENTS], cache, keep=True)
        words.append(word)
        sentences.append((sentence + before).astype(np.int32))
        documents.append(document + a)
        before += len(document)
    return np.concatenate(words), np.concatenate(sentences), np.concatenate(documents)


class Model:
    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def word(self, word: str) -> float:
        return float(self.weights[features(word)].sum())

    def sentences(self, words: np.ndarray, sentence: np.ndarray, count: int) -> np.ndarray:
        z = self.bias + np.bincount(sentence, words, minlength=count)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def noisy_or(p: np.ndarray, document: np.ndarray, count: int) -> np.ndarray:
    return 1 - np.exp(np.bincount(document, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=count))


def _held(word: np.ndarray, document: np.ndarray, label: np.ndarray, start: np.ndarray, of_feature: np.ndarray) -> list[np.ndarray]:
    """How many clean and how many toxic documents hold each feature, some documents at a time."""
    held = [np.zeros(FEATURES, np.int64), np.zeros(FEATURES, np.int64)]
    edges = np.searchsorted(document, np.arange(0, len(label) + BLOCK_DOCUMENTS, BLOCK_DOCUMENTS))
    for a, b in zip(edges, edges[1:]):
        pairs = np.unique(word[a:b].astype(np.int64) * len(label) + document[a:b])
        names, docs = pairs // len(label), pairs % len(label)
        counts = start[names + 1] - start[names]
        place = np.repeat(start[names] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        found = np.unique(of_feature[place].astype(np.int64) * len(label) + np.repeat(docs, counts))
        toxic = label[found % len(label)] == 1
        for v, which in enumerate((~toxic, toxic)):
            held[v] += np.bincount(found[which] // len(label), minlength=FEATURES)
    return held


def train(y: list[int], texts: list[str], counts: dict[int, int]) -> bytes:
    if len(set(y)) < 2:
        return pickle.dumps(Model(np.zeros(FEATURES), -30.0))
    label = np.array(y, dtype=float)
    # each class as often as it was among all labels, the toxic ones some times more
    weight = {v: counts[v] / y.count(v) * (TOXIC_WEIGHT if v else 1) for v in set(y)}
    share = np.array([weight[v] for v in y])
    share *= len(y) / share.sum()
    cache = Words(packed_features)
    word, sentence, document = _parse_blocks(plain_space(pa.array(texts)).to_pylist(), cache)
    # the features of one word after the other
    of_feature = np.frombuffer(b"".join(cache.values), "<u4")
    start = np.concatenate([[0], np.cumsum([len(f) // 4 for f in cache.values])]).astype(np.int64)
    of_word = np.repeat(np.arange(len(cache.values), dtype=np.int32), np.diff(start))
    cache.forget()
    # only what is clearly commoner in documents of one label can tell
    held = _held(word, document[sentence], label, start, of_feature)
    clean, toxic = (label == 0).sum(), (label == 1).sum()
    rate = (held[0] + held[1] + 1) / (clean + toxic + 2)
    z = (held[1] / toxic - held[0] / clean) / np.sqrt(rate * (1 - rate) * (1 / clean + 1 / toxic))
    keep = (np.abs(z) >= CLEAR)[of_feature]
    names, column = np.unique(of_feature[keep], return_inverse=True)
    row, docs, n, words = of_word[keep], len(y), len(names), len(start) - 1
    w, bias = np.zeros(n), -4.0
    moment, square = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, EPOCHS + 1):
        of_words = np.bincount(row, w[column], minlength=words)
        z = bias + np.bincount(sentence, of_words[word], minlength=len(document))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        whole = np.clip(noisy_or(p, document, docs), 1e-9, 1 - 1e-9)
        # d loss / d z: p for a clean document, p (1 - 1 / whole) for a toxic one
        slope = p * (1 - label[document] / whole[document]) * share[document]
        per_word = np.bincount(word, slope[sentence], minlength=words)
        gradient = np.append(np.bincount(column, per_word[row], minlength=n) + DECAY * w, slope.sum())
        moment, square = 0.9 * moment + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        move = RATE * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + CALM)
        w, bias = w - move[:n], bias - move[n]
    weights = np.zeros(FEATURES)
    weights[names] = w
    return pickle.dumps(Model(weights, float(bias)))


def fit(documents: DataFrame, labels: DataFrame, learn) -> bytes:
    return labelled.fit(documents, labels, "toxic", learn, train)


def _scored(batch: pa.RecordBatch, own: Model, cache: Words) -> tuple:
    rows, word, sentence, document = _parse(plain_space(batch.column("text")).to_pylist(), cache)
    p = own.sentences(np.array(cache.values)[word], sentence, len(document)) if len(document) else np.zeros(0)
    score = noisy_or(p, document, len(rows)) if len(document) else np.zeros(len(rows))
    return rows, sentence, document, p, score


def below(documents: DataFrame, model: bytes, limit: float) -> DataFrame:
    """The documents with a score under ``limit``; all their columns stay."""
    shared, schema = documents.sparkSession.sparkContext.broadcast(model), documents.schema

    def run(batches):
        own = pickle.loads(shared.value)
        cache = Words(own.word)
        for batch in chunks(batches, limit=CHUNK):
            yield batch.filter(pa.array(_scored(batch, own, cache)[-1] < limit))

    return documents.mapInArrow(run, schema)


def _spans(text: str, words: list[str], cuts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Where the characters of these runs of words begin and end in the text, without white space around them."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    breaks = np.fromiter((w == "\n" for w in words), np.int64, len(words))
    # a line break stands between two spaces that are not in the text
    start = np.cumsum(lengths + 1 - 2 * breaks) - lengths - 1 + breaks
    spans = []
    for a, b in cuts:
        first, last = int(start[a]), int(start[b - 1] + lengths[b - 1])
        piece = text[first:last]
        first += len(piece) - len(piece.lstrip())
        spans.append((first, first + len(piece.strip())))
    return spans


def score_documents(documents: DataFrame, model: bytes, rejected: float = REJECTED) -> DataFrame:
    """doc_id, score, the number (from 0), probability and words of the likeliest sentence, and all offending sentences.

    Offending are sentences of ``SENTENCE_SCORE`` or more, and the likeliest one
    of a rejected document however weak. Of each ``sentences`` holds the number,
    the probability and where its characters start and end in the text.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = pickle.loads(shared.value)
        cache = Words(own.word)
        for batch in chunks(batches, limit=CHUNK):
            rows, sentence, document, p, score = _scored(batch, own, cache)
            count = len(document)
            # the likeliest sentence of each document
            order = np.lexsort((np.arange(count), -p, document))
            top = order[np.flatnonzero(np.diff(document[order], prepend=-1))]
            first_word = np.flatnonzero(np.diff(sentence, prepend=-1))
            first_sentence = np.searchsorted(document, np.arange(len(rows)))
            before = np.cumsum([0, *(len(r) for r in rows)])
            worst, chance, quote = [None] * len(rows), [None] * len(rows), [None] * len(rows)
            shown = p >= SENTENCE_SCORE
            shown[top[score[document[top]] >= rejected]] = True
            ends_at = np.append(first_word[1:], len(sentence))
            for s in top[shown[top]]:
                d = document[s]
                worst[d], chance[d] = int(s - first_sentence[d]), float(p[s])
                quote[d] = " ".join(rows[d][first_word[s] - before[d] : ends_at[s] - before[d]]).strip()
            found = [[] for _ in rows]
            at = np.flatnonzero(shown)
            for group in np.split(at, np.flatnonzero(np.diff(document[at])) + 1) if len(at) else ():
                d = document[group[0]]
                spans = _spans(batch.column("text")[int(d)].as_py(), rows[d], [(first_word[s] - before[d], ends_at[s] - before[d]) for s in group])
                found[d] = [{"sentence": int(s - first_sentence[d]), "score": float(p[s]), "start": a, "end": b} for s, (a, b) in zip(group, spans)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(score), pa.array(worst, pa.int64()), pa.array(chance, pa.float64()), pa.array(quote, pa.string()),
                    pa.array(found, SENTENCES),
                ],
                names=["doc_id", "score", "worst_sentence", "worst_score", "worst_words", "sentences"],
            )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run,
        "doc_id long, score double, worst_sentence long, worst_score double, worst_words string, "
        "sentences array<struct<sentence: long, score: double, start: long, end: long>>",
    )
