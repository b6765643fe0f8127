"""Reversed search against plain scoring."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from clinloom.llm import lexical
from clinloom.llm.common import new_store

from .conftest import odd_rows

PATTERN = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return PATTERN.findall((text or "").translate(LOWER))


def plain(documents, items, k):
    docs = [(i, Counter(t), len(t)) for i, t in ((i, terms(t)) for i, t in documents)]
    n_docs, n_terms = sum(n > 0 for *_, n in docs), sum(n for *_, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, counts, n in docs:
            if n:
                m = 75 + 25 * n * n_docs // n_terms
                score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 12 * m)) for t in terms(text) if counts[t])
                if score > 0:
                    scored.append((-score, i is None, i, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3] if not x[1] else (x[0], True, 0))[:k])]
    return sorted(out, key=str)


def found(spark, documents, items, k=20):
    docs = spark.createDataFrame([(*r, 1, "t") for r in documents], "doc_id long, text string, score long, term string").repartition(3)
    asked = spark.createDataFrame([(*r, 5) for r in items], "item_id long, text string, rank int")
    return sorted((tuple(r) for r in lexical.search(docs, asked, new_store(spark), k).collect()), key=str)


def cases():
    draw = random.Random(8)
    words = [f"w{i}" for i in range(40)] + ["The", "THE", "größe", "日本", "x1"]
    documents = [(i, " ".join(draw.choice(words) + draw.choice(["", ",", "-"]) for _ in range(draw.randint(0, 60)))) for i in range(150)]
    documents += [(i, documents[3][1]) for i in range(200, 230)] + [(None, documents[4][1]), (None, documents[4][1]), (5, documents[3][1])] + [(i, t) for i, t, _ in odd_rows()]
    items = [(j, " ".join(draw.choice(words) for _ in range(draw.randint(1, 12)))) for j in range(20)]
    items += [(1, "the the THE w1"), (None, "w2 Größe"), (30, None), (31, ""), (32, "nowhere-found"), (33, " ".join(words * 3)), (20, "w5"), (20, "w5")]
    return documents, items


def test_best_documents(spark):
    documents, items = cases()
    assert found(spark, documents, items) == plain(documents, items, 20)
    assert found(spark, documents, items, 3) == plain(documents, items, 3)


def test_small_blocks_heaps_and_steps(spark, monkeypatch):
    for name, value in (("BLOCK_POSTINGS", 25), ("BLOCK_ITEMS", 7), ("SCORES_AT_ONCE", 50), ("WAITING", 10)):
        monkeypatch.setattr(lexical, name, value)
    documents, items = cases()
    assert found(spark, documents, items, 5) == plain(documents, items, 5)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "word")]) == []
    assert found(spark, [(1, "word")], []) == []
    assert found(spark, [(1, None), (2, "--")], [(1, "word")]) == []


def test_sums_beyond_doubles():
    index = lexical.Index(np.array([20_000]), np.zeros(1, np.int64), np.zeros(1, np.int64), np.array([10**6]), 1, 1)
    assert not index.exact
    score = index.scores(np.array([7]), np.zeros(1, np.int64), np.zeros(1, np.int64), np.array([999_999_937]))
    assert int(score[0, 0]) == 10**6 * (20_000 * (10**9 * 999_999_937 // (1000 * 999_999_937 + 12 * (75 + 175))))


def test_term_borders():
    both, lengths = lexical.terms(pa.array(["A b", "c", None, "", "-é漢-D9_", "x"]))
    assert [x.decode() for x in both.to_pylist()[::2]] == ["a", "b", "c", "é漢", "d9", "x"] and lengths.tolist() == [2, 1, 0, 0, 2, 1]
