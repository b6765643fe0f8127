"""The agenda of a merge vocabulary against the sentencepiece library."""

import random

import numpy as np
import pyarrow as pa
import pytest

from clinloom.llm import pieces

from .conftest import prose

ODD = [
    None, "", "", " ", "  ", "   a  b", "▁x ▁▁ y", "a\tb\n\n c", "日本語テキスト 漢字。", "😀😀 x😀", "x" * 3000, "ab " * 50, "<s> </s> <unk> <0x41>",
    "\x00a", "é̂́ ß", "1234567 12 3.14", " " * 100, "a" * 90 + "b", "the " + "tion" * 200, "\r\n", "Größe über naïve façade", "   x", prose(200, 3),
]


@pytest.fixture(scope="module")
def model():
    return pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")


def drawn(n: int) -> list[str]:
    draw = random.Random(5)
    letters = "aabcdeeéinorsttßçあ漢😀  .,-'\n\t0123▁_<>/(){}="
    return ["".join(draw.choice(letters) for _ in range(draw.randint(0, 400))) for _ in range(n)]


def test_ids_and_texts_are_the_librarys(model):
    encoder = pieces.Encoder(model)
    texts = pa.array(ODD + drawn(200))
    ids, ends = encoder.encode(texts)
    pieces.check(encoder.vocabulary, texts, ids, ends, pieces.decode(encoder.vocabulary, ids, ends))
    assert np.array_equal(encoder.encode(texts)[0], ids)  # now from the kept segments


def test_both_agendas_agree(model, monkeypatch):
    texts = pa.array(ODD + drawn(60))
    short = pieces.Encoder(model).encode(texts)
    monkeypatch.setattr(pieces, "SIDE_BY_SIDE", 0)
    heaps = pieces.Encoder(model).encode(texts)
    assert all(np.array_equal(a, b) for a, b in zip(short, heaps))


def test_few_kept_segments(model, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_SEGMENTS", 10)
    encoder, texts = pieces.Encoder(model), pa.array(drawn(30))
    for a in range(0, 30, 5):
        part = texts.slice(a, 5)
        ids, ends = encoder.encode(part)
        pieces.check(encoder.vocabulary, part, ids, ends, pieces.decode(encoder.vocabulary, ids, ends))


def test_any_ids_decode_as_the_library_does(model):
    vocabulary = pieces.Vocabulary.load(model)
    draw = np.random.default_rng(2)
    rows = [[], [0], [1, 2], [3 + 0xC3], [3 + 0xC3, 3 + 0xA9], [3 + 0xFF, 3 + 0xE2, 500], *(draw.integers(300, vocabulary.size, 20).tolist() for _ in range(50))]
    ends = np.cumsum([len(r) for r in rows])
    found = pieces.decode(vocabulary, np.array([i for r in rows for i in r], np.int32), ends)
    assert found.to_pylist() == vocabulary.library.decode(rows)


def test_a_difference_ends_the_task(model):
    encoder, texts = pieces.Encoder.load(model), pa.array(["some words", "more"])
    ids, ends = encoder.encode(texts)
    decoded = pieces.decode(encoder.vocabulary, ids, ends)
    with pytest.raises(RuntimeError):
        pieces.check(encoder.vocabulary, texts, ids + 1, ends, decoded)
    with pytest.raises(RuntimeError):
        pieces.check(encoder.vocabulary, texts, ids, ends, pa.array(["some words", "moro"]))


def test_rows(spark, odd, nothing, model):
    library = pieces.Vocabulary.load(model).library
    found = pieces.encoded(odd, model).collect()
    wanted = sorted(((r["doc_id"] is None, r["doc_id"], library.encode(r["text"] or "", add_eos=True), r["text"] or "") for r in odd.collect()), key=str)
    assert sorted(((r["doc_id"] is None, r["doc_id"], list(r["ids"]), r["decoded"]) for r in found), key=str) == wanted
    assert pieces.encoded(nothing, model).collect() == []
