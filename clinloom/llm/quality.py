"""Quality classifier by compression.

Two zstandard dictionaries are built, from texts labelled good and from texts
labelled bad. A text, in blocks of some KB and all of it, is compressed with
each; the difference of the two sizes over the text's length says which class
it resembles. A rising curve over that difference (isotonic regression on
labelled texts that no dictionary has seen, both classes weighing the same)
makes a probability of it.

A null or empty text gets the score of a difference of 0. Without labels of
both kinds every score is 0.5. Very long texts are scored whole. Ties and
repeated rows get equal scores. An empty table gives no rows.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm import labelled
from clinloom.llm.common import chunks

BLOCK = 4096
LEVEL = 3
DICTIONARY_BYTES = 64 << 10


def _dictionary(texts: list[bytes]) -> bytes:
    pieces = [t[a : a + BLOCK] for t in texts for a in range(0, len(t), BLOCK)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few texts to train on: their bytes are the dictionary
        return b"\n".join(pieces)[:DICTIONARY_BYTES] or b" " * 8


class Model:
    def __init__(self, dictionaries: tuple[bytes, bytes], curve: tuple[np.ndarray, np.ndarray]):
        self.dictionaries, self.curve = dictionaries, curve
        self.compressors = []
        for raw in dictionaries:
            kind = zstandard.DICT_TYPE_AUTO
            own = zstandard.ZstdCompressionDict(raw, dict_type=kind)
            own.precompute_compress(level=LEVEL)
            self.compressors.append(
                zstandard.ZstdCompressor(dict_data=own, write_content_size=False, write_checksum=False, write_dict_id=False)
            )

    def __reduce__(self):
        return Model, (self.dictionaries, self.curve)

    def difference(self, text: bytes) -> float:
        """(size with the bad dictionary - size with the good one) / length."""
        if not text:
            return 0.0
        bad, good = (sum(len(c.compress(text[a : a + BLOCK])) for a in range(0, len(text), BLOCK)) for c in self.compressors)
        return (bad - good) / len(text)

    def score(self, difference: np.ndarray) -> np.ndarray:
        x, y = self.curve
        return 0.98 * np.interp(difference, x, y) + 0.02 / (1 + np.exp(-np.clip(20 * difference, -35, 35)))


#: The curve of a model that knows nothing.
FLAT = (np.zeros(1), np.full(1, 0.5))


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression by pooling neighbours; the knots are the pools' middles."""
    order = np.argsort(x, kind="stable")
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    pools: list[list[float]] = []  # sum of weight * y, of weight, of weight * x
    for i in order:
        pools.append([weight[i] * y[i], weight[i], weight[i] * x[i]])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    knots = np.array(pools)
    return knots[:, 2] / knots[:, 1], np.clip(knots[:, 0] / knots[:, 1], 0.001, 0.999)


def train(y: list[int], texts: list[str], counts: dict[int, int]) -> bytes:
    """Two thirds of the sample make the dictionaries, the rest the curve."""
    if len(set(y)) < 2:
        return pickle.dumps(Model((b" " * 8, b" " * 8), FLAT))
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    seen = {0: 0, 1: 0}
    fit_on, rest = [], []
    for i, label in enumerate(y):
        (rest if seen[label] % 3 == 2 else fit_on).append(i)
        seen[label] += 1
    model = Model(tuple(_dictionary([raw[i] for i in fit_on if y[i] == label]) for label in (0, 1)), FLAT)
    rest = rest if len({y[i] for i in rest}) == 2 else list(range(len(y)))
    model.curve = _curve(np.array([model.difference(raw[i]) for i in rest]), np.array([y[i] for i in rest], dtype=float))
    return pickle.dumps(model)


def fit(documents: DataFrame, labels: DataFrame, learn) -> bytes:
    return labelled.fit(documents, labels, "quality", learn, train)


def score_documents(documents: DataFrame, model: bytes) -> DataFrame:
    """doc_id, score (1: good) and the size difference of every document."""

    def run(batches):
        own = pickle.loads(model)
        for batch in chunks(batches):
            x = np.array([own.difference((t or "").encode("utf-8", "surrogatepass")) for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(own.score(x)), pa.array(x)], names=["doc_id", "score", "difference"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, difference double")
