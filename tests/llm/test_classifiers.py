"""Quality, toxicity and decontamination on small corpora."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from clinloom.llm import labelled, quality, templates, toxicity
from clinloom.llm.common import WordCache, new_store

from .conftest import prose

DOCS = "doc_id long, text string"


def labelled_corpus(n=240):
    draw = random.Random(5)
    docs, labels = [], []
    for i in range(n):
        words = prose(80, 1000 + i).split(" ")
        toxic, good = i % 4 == 0, i % 3 != 0
        if toxic:
            words[draw.randrange(80)] = draw.choice(["vileword", "vileworder", "nastier"])
        if not good:
            words = [w.upper() + "!!" for w in words[:20]] * 4 if not toxic else words
        docs.append((i, " ".join(words)))
        labels.append((i, int(good or toxic), int(toxic)))
    return docs, labels


def frames(spark):
    docs, labels = labelled_corpus()
    labels += [(1, 0, 1), (None, 1, 1), (900, None, None), (901, 1, 0)]  # both ways, no id, no label, no document
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), docs, labels


def held_out_accuracy(scored, labels, column, folds, fold, limit):
    import zlib

    truth = {d: row[column] for row in labels[:240] for d in [row[0]] if zlib.crc32(str(d).encode()) % folds == fold and d != 1}
    found = {r["doc_id"]: int(r["score"] >= limit) for r in scored}
    return np.mean([found[d] == y for d, y in truth.items()])


def test_quality_of_unseen_documents(spark, odd, nothing):
    df, labels, _, rows = frames(spark)
    model = quality.fit(df, labels, labelled.fold(F.col("doc_id"), 5) != 0)
    assert model == quality.fit(df.repartition(7), labels, labelled.fold(F.col("doc_id"), 5) != 0)
    assert held_out_accuracy(quality.score_documents(df, model).collect(), rows, 1, 5, 0, 0.3) > 0.9
    scores = quality.score_documents(odd, model).collect()
    assert len(scores) == odd.count() and all(0 <= r["score"] <= 1 for r in scores)
    assert len({r["score"] for r in scores if r["doc_id"] in (4, 5)}) == 1
    assert quality.score_documents(nothing, model).collect() == []


def test_toxicity_of_unseen_documents(spark, odd, nothing):
    df, labels, docs, rows = frames(spark)
    model = toxicity.fit(df, labels, labelled.fold(F.col("doc_id"), 3) != 1)
    scored = toxicity.score_documents(df, model).collect()
    assert held_out_accuracy(scored, rows, 2, 3, 1, 0.7) > 0.95
    for row in scored:  # the offending sentence is located
        if row["score"] >= 0.7:
            assert "vile" in row["worst_words"] or "nasti" in row["worst_words"]
    odd_scores = {r["doc_id"]: r["score"] for r in toxicity.score_documents(odd, model).collect()}
    assert odd_scores[4] == odd_scores[5] == 0 and all(0 <= s <= 1 for s in odd_scores.values())
    kept = toxicity.below(df, model, 0.7)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in scored if r["score"] < 0.7}
    assert toxicity.below(odd, model, 2.0).collect() == odd.collect()
    assert toxicity.score_documents(nothing, model).collect() == []


def test_models_without_labels(spark, odd):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality.score_documents(odd, quality.fit(odd, none, F.lit(True))).collect()} == {0.5}
    assert max(r["score"] for r in toxicity.score_documents(odd, toxicity.fit(odd, none, F.lit(True))).collect()) < 1e-3


def test_noisy_or_and_sentences():
    p = np.array([0.5, 0.5, 0.0, 1.0])
    assert np.allclose(toxicity.noisy_or(p, np.array([0, 0, 1, 2]), 4), [0.75, 0, 1, 0])
    last = np.zeros(130, bool)
    numbers = toxicity.sentence_numbers(last, np.zeros(130, int))
    assert (numbers == np.arange(130) // 64).all()  # a run without a full stop is cut, nothing is lost


QUESTION = "If Martha buys 12 apples for 3 dollars each and Peter eats 5 kg of them then how many of the 12 apples are left"


def leaks(spark, docs, items=((1, QUESTION),)):
    found = templates.contaminated(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(list(items), "item_id long, text string"), new_store(spark)
    )
    return {(r["doc_id"], r["item_id"]) for r in found.collect()}


def test_questions_with_other_numbers_and_names_are_found(spark):
    around = prose(40, 7) + " "
    changed = QUESTION.replace("12", "48").replace("Martha", "Olga").replace("Peter", "Igor").replace("5 kg", "7 lb")
    inconsistent = QUESTION.replace("buys 12", "buys 48")  # the same 12 stands for two values
    docs = [
        (1, around + QUESTION + " " + around), (2, around + changed.upper().replace("OLGA", "Olga").replace("IGOR", "Igor")),
        (3, inconsistent), (4, around), (5, " ".join(QUESTION.split()[:16])), (6, " ".join(QUESTION.split()[:9])), (7, None), (8, ""),
        (9, QUESTION.replace("apples", "pears").replace("eats", "sells")), (10, QUESTION), (10, around), (None, QUESTION),
    ]
    assert leaks(spark, docs) == {(1, 1), (2, 1), (3, 1), (5, 1), (10, 1), (None, 1)}


def test_odd_items(spark, odd):
    items = [(1, None), (2, ""), (3, "to be or"), (4, "call me ishmael some"), (5, QUESTION), (5, QUESTION), (None, "what is the capital of the old kingdom by the sea")]
    docs = [(1, "they call me ishmael some years ago"), (2, "to be or not"), (3, "tell me what is the capital of the old kingdom by the sea please")]
    assert leaks(spark, docs, items) == {(1, 4), (3, None)}
    assert leaks(spark, [], items) == set() and leaks(spark, docs, []) == set()
    store = new_store(spark)
    found = store.save(templates.contaminated(odd, spark.createDataFrame([(1, QUESTION)], "item_id long, text string"), store), "leaks")
    assert templates.without_contaminated(odd, found).columns == odd.columns


def test_any_white_space_and_items_of_numbers(spark):
    numbers, few = "12 + 7 = 19 and 30 - 4 = 26 so 19 + 26 = 45", "3 5 8 13"
    items = [(1, QUESTION), (2, numbers), (3, few), (4, "7 9"), (5, "1 2 3 4 5 6 7 8 9 10 11 12")]
    docs = [
        (1, QUESTION.replace(" ", "\t")), (2, QUESTION.replace(" ", "\u00a0")), (3, "x\u2003" + QUESTION.replace(" ", "\r\n")), (4, "see " + numbers + " here"),
        (5, numbers.replace(" ", "\t")), (6, "the row 3 5 8 13 21"), (7, "3 5 8 14"), (8, "7 9"), (9, "count 1 2 3 4 5 6 7 8 9 10 11 12 now"),
        (10, "1 2 3 4 5 6 7 8"), (11, "9 8 7 6 5 4 3 2 1 0 9 8"),
    ]
    assert leaks(spark, docs, items) == {(1, 1), (2, 1), (3, 1), (4, 2), (5, 2), (6, 3), (9, 5)}


def test_an_instruction_of_many_items_is_no_leak(spark):
    instruction = "please read the following question with care and then choose the one answer that fits best of all given"
    items = [(i, f"{instruction} {prose(20, 500 + i)}") for i in range(30)]
    docs = [(i, f"{prose(30, 900 + i)} {instruction} {prose(30, 950 + i)}") for i in range(20)] + [(100, items[7][1]), (101, "so " + items[9][1] + " " + prose(9, 1))]
    assert leaks(spark, docs, items) == {(100, 7), (101, 9)}
    same = [(i, QUESTION) for i in range(30)]  # nothing but common windows
    assert leaks(spark, [(1, QUESTION)], same) == {(1, i) for i in range(30)}


def test_word_forms():
    kinds = [templates.word_form(w)[0] for w in ("1,200", "$5", "seven", "kg", "5kg", "Anna", "McX", "the", "--", "\n")]
    T = templates
    assert kinds == [T.NUM, T.NUM, T.NUM, T.UNIT, T.NUM_UNIT, T.NAME, T.WORD, T.WORD, T.EMPTY, T.EMPTY]
    found = T.Windows(pa.array(["The cat. Anna saw Berta. kg of 5 kg"]), WordCache(T.word_form))
    assert found.slot.tolist() == [False, False, False, False, True, False, False, True, True]


def all_leaks(spark, docs, items):
    """As op9_template_leaks and the pipeline judge."""
    found = templates.contaminated(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(list(items), "item_id long, text string"), new_store(spark)
    )
    return {(r["doc_id"], r["item_id"]) for r in found.collect()}


PEARS = "Anna has 2 apples and 2 pears in the old basket by the door of the house"


def test_one_changed_slot_does_not_clear_a_document(spark):
    long = QUESTION + " when Anna comes home to see her friends and Anna brings 7 plums for Anna from the market near the old mill"
    docs = [
        (1, QUESTION.replace("buys 12", "buys 48")), (2, QUESTION.replace("the 12", "the twelve")), (3, long.replace("for Anna", "for Berta")),
        (4, PEARS.replace("2 apples", "3 apples").replace("2 pears", "5 pears")), (5, prose(60, 7)), (6, QUESTION.replace("apples", "pears").replace("eats", "sells")),
    ]
    assert all_leaks(spark, docs, [(1, QUESTION), (2, long), (3, PEARS)]) == {(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (3, 2), (4, 3)}


def test_windows_without_a_deviating_slot_count():
    def window(pos, *pairs):
        return {"item_pos": pos, "plain": True, "places": [p for p, _, _ in pairs], "item_slots": [a for _, a, _ in pairs], "slots": [b for _, _, b in pairs]}

    scattered = [window(0, (1, 7, 1), (2, 7, 2), (3, 7, 3)), window(1, (2, 7, 2), (3, 7, 3)), window(9, (9, 8, 8)), window(10)]
    scattered += [window(2, (3, 7, 3), (4, 7, 4), (5, 7, 5))]
    assert templates.counted(scattered)[0] == [9, 10]
    agreeing = [window(0, (1, 7, 5), (2, 7, 5)), window(1, (2, 7, 5), (3, 7, 6))]
    assert templates.counted(agreeing) == ([0, 1], 2)


def test_names_and_words_where_a_sentence_begins(spark):
    items = [
        (1, "What is the capital"), (2, "What is the largest river of the old northern kingdom"), (3, "Anna has 7 apples and buys 2 more pears"),
        (4, "Go home. Anna has 7 plums and buys 2 more figs at the fair"), (5, "Then Tom's brother has 4 cats and Mary's aunt has 9 dogs"),
    ]
    docs = [
        (1, "Question: What is the capital please"), (2, "he asked What is the largest river of the old northern kingdom"), (3, "Tom has 5 apples and buys 3 more pears"),
        (4, "they said Tom has 5 apples and buys 3 more pears"), (5, "Go home. Tom has 5 plums and buys 3 more figs at the fair"),
        (6, "Then Anna's brother has 6 cats and Olga's aunt has 8 dogs"), (7, "Who was in the capital"), (8, prose(80, 9)),
    ]
    assert all_leaks(spark, docs, items) == {(1, 1), (2, 2), (3, 3), (4, 3), (5, 4), (6, 5)}
    windows = templates.Windows(pa.array(["Ja.\n" * 60]), WordCache(templates.word_form))
    whole = [np.concatenate(x) for x in zip(*windows.hashes(8, inner=True))]
    templates.BLOCK_READINGS, before = 300, templates.BLOCK_READINGS
    blocks = list(windows.hashes(8, inner=True))
    templates.BLOCK_READINGS = before
    assert len(blocks) > 9 and sorted(zip(*whole)) == sorted(zip(*(np.concatenate(x) for x in zip(*blocks))))
    assert len(whole[0]) == 53 * 163  # every choice of up to four names among eight words


def test_toxic_words_between_any_white_space(spark):
    import pickle

    weights = np.zeros(toxicity.FEATURES)
    weights[toxicity.features("vile")] = 3.0
    model = pickle.dumps(toxicity.Model(weights, -5.0))
    texts = ["so vile here", "so\tvile\there", "so\u00a0vile\u2003here", "so\r\nvile\x0bhere", "\u3000vile\u2028", "so fine\there"]
    rows = toxicity.score_documents(spark.createDataFrame(list(enumerate(texts)), DOCS), model).orderBy("doc_id").collect()
    assert [r["score"] > 0.7 for r in rows] == [True] * 5 + [False]
    assert [texts[i][r["sentences"][0]["start"] : r["sentences"][0]["end"]].split() for i, r in enumerate(rows[:3])] == [["so", "vile", "here"]] * 3


def test_all_offending_sentences_are_returned(spark):
    import pickle

    weights = np.zeros(toxicity.FEATURES)
    weights[toxicity.features("vile")] = 2.0
    model = pickle.dumps(toxicity.Model(weights, -5.0))
    several = "A vile  start.\n\nAll is well here. So vile! Größe 😀 counts.\n\t vile again \nand out"
    weak = pickle.dumps(toxicity.Model(np.zeros(toxicity.FEATURES), -3.2))  # 0.039 each
    rows = {r["doc_id"]: r for r in toxicity.score_documents(spark.createDataFrame([(1, several), (2, "All is well."), (3, None)], DOCS), model).collect()}
    quotes = [several[x["start"] : x["end"]] for x in rows[1]["sentences"]]
    assert quotes == ["A vile  start.", "So vile!", "vile again"] and rows[1]["worst_words"] == quotes[0]
    assert all(x["score"] >= 0.05 for x in rows[1]["sentences"]) and rows[2]["sentences"] == rows[3]["sentences"] == []
    many = " ".join(["It goes on."] * 40)
    row = toxicity.score_documents(spark.createDataFrame([(1, many)], DOCS), weak).first()
    assert row["score"] >= 0.7 and row["worst_score"] < 0.05 and row["worst_words"] == "It goes on."
    assert [(x["sentence"], x["start"], x["end"]) for x in row["sentences"]] == [(0, 0, 11)]
    large = [(i, "So vile! " + "word " * 60_000) for i in range(30)]  # several chunks of text in one task
    scored = toxicity.score_documents(spark.createDataFrame(large, DOCS).coalesce(1), model).collect()
    assert len(scored) == 30 and all([(x["start"], x["end"]) for x in r["sentences"]] == [(0, 8)] for r in scored)
