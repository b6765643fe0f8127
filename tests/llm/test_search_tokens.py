"""Top-k search and token files against brute force."""

import zlib

import numpy as np
import pyarrow.fs as pafs
import pytest

from clinloom.llm import tokenfiles, topk
from clinloom.llm.common import new_store


def brute(rows, queries, k):
    """Each query row's list; lists of rows that share an id are told apart by their scores only."""
    usable = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = {}
    for a, (q, own) in enumerate(usable):
        if queries(q):
            scores = [(-sum(x * y for x, y in zip(own, v)), i) for b, (i, v) in enumerate(usable) if a != b and len(v) == len(own)]
            out.setdefault(q, []).extend((n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k]))
    return {q: sorted(found) for q, found in out.items() if found}


def search_rows(spark, rows, k=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    out = {}
    for r in topk.top_k(df, new_store(spark), lambda c: c % 3 == 0, k).collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(found) for q, found in out.items()}


def search(spark, rows, k=5):
    return {q: [found[1:] for found in ranked] for q, ranked in search_rows(spark, rows, k).items()}


def test_search_is_exact(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_VECTORS", 40)
    monkeypatch.setattr(topk, "QUERY_VECTORS", 16)
    draw = np.random.default_rng(3)
    rows = [(i, draw.normal(size=40).astype(np.float32).tolist()) for i in range(150)]
    rows += [(i, rows[0][1]) for i in range(150, 190)]  # ties
    rows += [(None, rows[1][1]), (200, None), (201, [float("nan")] * 40), (202, [None] * 40), (203, [float("inf")] + [0.0] * 39), (204, [0.0] * 40), (3, rows[5][1])]
    expected = brute(rows, lambda i: i % 3 == 0, 5)
    assert search_rows(spark, rows) == expected
    monkeypatch.setattr(topk, "SENT_BYTES", 20_000)  # several groups of query blocks
    assert search_rows(spark, rows) == expected


def test_rows_that_repeat_an_id_all_count(spark):
    rows = [(3, [1.0]), (3, [5.0]), (3, [5.0]), (4, [2.0]), (4, [9.0]), (None, [99.0])]
    assert search_rows(spark, rows, 2) == brute(rows, lambda i: i % 3 == 0, 2)
    assert [i for _, i, _ in search_rows(spark, rows, 1)[3]] == [4, 4, 4]


def test_search_on_odd_vectors(spark):
    assert search(spark, []) == {}
    assert search(spark, [(0, [1.0])]) == {}  # no other row
    mixed = [(0, [1.0, 2.0]), (1, [1.0]), (2, [0.5, 0.5]), (3, []), (4, [])]
    assert search(spark, mixed) == {0: [(2, 384 * 128 * 2 // 1)] if False else [(2, 256 * 128 + 512 * 128)], 3: [(4, 0)]}
    huge = [(0, [3e38, 1.0]), (1, [3e38, 1.0]), (2, [-3e38, 0.0])]
    assert search(spark, huge)[0] == [(1, 2**63 - 1), (2, -(2**63))]


@pytest.fixture(scope="module")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def test_files_hold_every_document(spark, odd, vocabulary, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokenfiles, "CACHED_WORDS", 50)  # the cache is emptied on the way
    shards = tokenfiles.write_tokens(odd, new_store(spark), vocabulary, length=64)
    found = tokenfiles.read_tokens(shards).collect()
    plain = Tokenizer.from_file(vocabulary)
    rows = sorted(odd.select("doc_id", "text").collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"], r["text"] is not None, r["text"]))
    expected, start = [], 0
    for row in rows:
        ids = np.array([*plain.encode(row["text"] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        expected.append((row["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected

    # random access: sequence i of a shard, and the mask of the last one
    shard = max(shards.collect(), key=lambda r: r["tokens"])
    files, root = pafs.FileSystem.from_uri(shard["folder"])
    reader = tokenfiles.SequenceReader(files, f"{root}/{shard['name']}.arrow")
    last = (shard["tokens"] - 1) // 64
    tokens, mask = reader.sequence(last)
    assert len(tokens) == 64 and mask.sum() == shard["tokens"] - 64 * last and (tokens[~mask] == 0).all()
    assert (np.concatenate(list(reader.span(70, 100)))[:20] == np.concatenate([reader.sequence(1)[0], reader.sequence(2)[0]])[6:26]).all()
    reader.close()


def test_no_documents(spark, nothing, vocabulary):
    assert tokenfiles.read_tokens(tokenfiles.write_tokens(nothing, new_store(spark), vocabulary)).collect() == []


def test_words_are_encoded_as_in_their_text(vocabulary):
    import pyarrow as pa

    encoder = tokenfiles.Encoder(vocabulary)
    texts = ["It's a<|startoftext|>B. <|STARTOFTEXT|> ÀÉ, İstanbul ΑΣ. a.b,c d... x., 12. 3,4 Ａ b\tc\rd é. don't, you'RE.  x", "", ".", " , ", "ﬁ. Ǆ. 'S.\n\n's."]
    for ids, text in zip(encoder.encode(pa.array(texts)), texts):
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_new_words_are_encoded_together(vocabulary, monkeypatch):
    """Words of letters are encoded as one text; other words, and vocabularies that mark no word's end, one by one."""
    import pyarrow as pa

    texts = ["straße façade zzzxq naïve it's a1b ÷ über 12 Quux", "don't ÿ ø ﬁn x</w>y </w> the</w> the", "日本 ab ́c é ab́ und"]
    encoder = tokenfiles.Encoder(vocabulary)
    expected = [encoder.tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
    alone = []
    apart = tokenfiles.Encoder._apart
    monkeypatch.setattr(tokenfiles.Encoder, "_apart", lambda self, words: alone.extend(words) or apart(self, words))
    assert [ids.tolist() for ids in encoder.encode(pa.array(texts))] == expected
    assert not {"straße", "façade", "naïve", "zzzxq", "über", "the"} & set(alone)
    assert {"it's", "a1b", "12"} <= set(alone)
    unmarked = tokenfiles.Encoder(vocabulary)
    unmarked.last[:] = False
    assert [ids.tolist() for ids in unmarked.encode(pa.array(texts))] == expected
