"""Near duplicates, repeated byte strings and repeated lines against brute force."""

import hashlib

import numpy as np
import pytest

from clinloom.llm import jaccard, suffix, winnow
from clinloom.llm.common import new_store
from clinloom.llm.components import components
from clinloom.llm.queries import ORACLES

from .conftest import odd_rows, prose

KINDS = "doc_id long, text string"


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_components(rows):
    sets, parent = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def near(spark, rows):
    df = spark.createDataFrame(rows, KINDS).repartition(3)
    return sorted(map(tuple, jaccard.near_duplicates(df, new_store(spark)).collect()), key=str)


def edited(text, places, word):
    words = text.split(" ")
    for p in places:
        words[p] = word
    return " ".join(words)


def test_odd_documents_and_a_group_of_near_copies(spark, monkeypatch):
    # small parts and groups, so that shingles count as frequent and are split over groups
    monkeypatch.setattr(jaccard, "PART_SHINGLES", 500)
    monkeypatch.setattr(jaccard, "SEEN_IN_PART", 2)
    monkeypatch.setattr(jaccard, "STAR_ENTRIES", 10)
    monkeypatch.setattr(jaccard, "GROUP_ENTRIES", 100)
    rows = [(d, t) for d, t, _ in odd_rows()]
    base = prose(100, 50)
    rows += [(100 + i, edited(base, [7 * i % 100, 13 * i % 100][: 1 + i % 2], f"w{i}")) for i in range(40)]  # linked through the base or not at all
    rows += [(200 + i, base + " " + prose(40, 60 + i)) for i in range(15)]  # a long shared passage, not similar enough
    rows += [(300, base), (301, edited(base, [50], "x")), (302, base)]
    assert near(spark, rows) == brute_components(rows)


def test_similarity_at_the_threshold(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(0, " ".join(words[:49]))]  # 45 shingles; cutting words off the end keeps 36 of 45, then 35
    rows += [(1, " ".join(words[:40])), (2, " ".join(words[100:149])), (3, " ".join(words[100:139]))]
    assert near(spark, rows) == [(0, 45, 0), (1, 36, 0), (2, 45, 2), (3, 35, 3)]


def test_whole_sets_are_written_for_pairs_left_by_the_first_fragment_only(spark, monkeypatch):
    """Documents that share a passage are candidates, but their sets beyond the first fragment are never written."""
    base, cut = prose(200, 1), jaccard._segments
    written = {True: set(), False: set()}

    def kept(documents, wanted, order, first):
        written[first] |= {r["key"] for r in wanted.collect()}
        return cut(documents, wanted, order, first)

    monkeypatch.setattr(jaccard, "_segments", kept)
    monkeypatch.setattr(jaccard, "SEEN_IN_PART", 1000)  # the passage's shingles come early in the order
    rows = [(i, base + " " + prose(200, 10 + i)) for i in range(30)] + [(100, prose(300, 90)), (101, prose(300, 90) + " more"), (101, prose(300, 90) + " more")]
    assert near(spark, rows) == brute_components(rows)
    assert written[True] >= {*range(30), 100, 101} and written[False] == {100, 101}


def test_no_documents(spark):
    assert near(spark, []) == []


def test_components_of_a_chain_a_ring_and_a_star(spark):
    edges = [(i, i + 1) for i in range(20)] + [(30, 31), (31, 32), (32, 30), (7, 7)] + [(50, i) for i in range(51, 90)]
    found = components(spark.createDataFrame(edges, "x long, y long"), new_store(spark)).collect()
    expected = {i: 0 for i in range(21)} | {i: 30 for i in (30, 31, 32)} | {i: 50 for i in range(50, 90)}
    assert {r["node"]: r["component"] for r in found} == expected
    assert components(spark.createDataFrame([], "x long, y long"), new_store(spark)).collect() == []


def brute_spans(rows):
    first = {}
    rank = {d: -1 if d is None else d for d, _ in rows}
    texts = [(rank[d], d, (t or "").encode()) for d, t in rows]
    for r, _, t in texts:
        for i in range(len(t) - 49):
            first[t[i : i + 50]] = min(first.get(t[i : i + 50], r), r)
    out = []
    for r, d, t in texts:
        gone = np.zeros(len(t) + 2, int)
        for i in range(len(t) - 49):
            if first[t[i : i + 50]] < r:
                gone[i + 1 : i + 51] = 1
        kept = bytes(b for b, g in zip(t, gone[1:]) if not g)
        out.append((d, len(t), int(gone.sum()), int((np.diff(gone) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def spans(spark, rows):
    df = spark.createDataFrame(rows, KINDS).repartition(3)
    return sorted(map(tuple, suffix.deduplicated(df, new_store(spark)).collect()), key=str)


@pytest.mark.parametrize("block", [suffix.BLOCK_BYTES, 300])
def test_repeated_strings_of_odd_documents(spark, monkeypatch, block):
    monkeypatch.setattr(suffix, "BLOCK_BYTES", block)  # small blocks are merged by binary search
    passage = prose(30, 90)
    rows = [(d, t) for d, t, _ in odd_rows()]
    rows += [(40 + i, prose(20, 91 + i) + " " + passage[i:] + prose(15, 120 + i)) for i in range(12)]
    rows += [(60, passage[:49]), (61, "x" + passage[10:59]), (62, "x" + passage[10:60] + "y"), (63, passage[10:60])]
    rows += [(70, "é" * 80), (71, "zé" + "é" * 60), (72, "abc" * 40), (73, "bca" * 40)]
    assert spans(spark, rows) == brute_spans(rows)


def test_no_strings(spark):
    assert spans(spark, []) == []


def test_suffix_arrays_sort_and_blocks_merge():
    draw = np.random.default_rng(1)
    data = draw.integers(97, 99, 400).astype(np.uint8)
    text = data.tobytes()
    order = suffix.suffix_array(suffix.words_at(data), 50)
    assert [text[i : i + 64] for i in order] == sorted(text[i : i + 64] for i in range(400))
    whole = suffix.Block(text, np.array([400]), np.array([5]))
    other = suffix.Block(text[100:200], np.array([100]), np.array([3]))
    whole.merge(other)
    assert sorted(whole.offset[whole.least[whole.kind] == 3]) == list(range(100, 151))


def test_repeated_lines_of_odd_documents(spark, odd):
    import duckdb

    lines = ["alpha", "beta", "gamma", "delta", "", "beta"]
    rows = [(d, t) for d, t, _ in odd_rows() if d not in (11, 12)]
    rows += [(80 + i, "\n".join(lines[j % 6] for j in range(i, i + 2 + i % 5))) for i in range(12)] + [(99, "\n".join(["again"] * 6))]
    df = spark.createDataFrame(rows, KINDS)
    removed = winnow.repeated_lines(df, new_store(spark))
    connection = duckdb.connect()
    connection.register("documents", df.toArrow())
    sql = ORACLES["op7_winnow_lines"].replace("ORDER BY doc_id, pos", "ORDER BY doc_id NULLS FIRST, pos")
    expected = {r[0]: (r[1], r[2], r[3]) for r in connection.execute(sql).fetchall()}
    assert {r["doc_id"]: (r["n_lines"], r["n_removed"], r["removed"]) for r in removed.collect()} == expected
    assert expected[99][2] == [1, 2, 3, 4, 5]
    kept = {r["doc_id"]: r["text"] for r in winnow.without_lines(df, removed).collect()}
    for d, t in rows:
        gone = expected.get(d, (0, 0, []))[2]
        assert kept[d] == (t if not gone else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone))
    assert winnow.without_lines(odd, winnow.repeated_lines(odd, new_store(spark))).columns == odd.columns
    assert winnow.repeated_lines(odd.limit(0), new_store(spark)).collect() == []


def brute_lines(rows, alone):
    """All runs of two lines, and long lines alone, with their places."""
    keys = {}
    texts = sorted({(d is not None, d or 0, t) for d, t in rows if t is not None})
    runs = [((has, d, t), i, t.split("\n")[i : i + n]) for n in (2, 1) for has, d, t in texts for i in range(len(t.split("\n")) - n + 1)]
    for place, i, run in runs:
        if len(run) == 2 or len(run[0].split()) >= alone:
            keys.setdefault(tuple(run), []).append((place, i))
    return keys


def test_lines_of_repeated_and_null_ids(spark):
    first, second = "w\nalpha\nbeta\ngamma", "own\nlines\nof this one\nalpha\nbeta"
    rows = [(1, "alpha\nbeta"), (7, first), (7, second), (7, second), (None, "own\nlines"), (None, "x\ny"), (8, "y\nx\ny"), (9, None), (9, ""), (9, "x")]
    df = spark.createDataFrame(rows, KINDS).repartition(3)
    removed = winnow.repeated_lines(df, new_store(spark))
    kept = sorted(((r["doc_id"], r["text"]) for r in winnow.without_lines(df, removed).collect()), key=str)
    expected = [(1, "alpha\nbeta"), (7, "w\ngamma"), (7, "of this one"), (7, "of this one"), (None, "own\nlines"), (None, "x\ny"), (8, "y"), (9, None), (9, ""), (9, "x")]
    assert kept == sorted(expected, key=str)


def test_later_repeats_against_brute_force(spark):
    import random

    draw = random.Random(5)
    lines = [" ".join(f"{a}{i}" for i in range(n)) for a in "abcdef" for n in (1, 7, 8, 12)] + [""]
    rows = [(i if i else None, "\n".join(draw.choice(lines) for _ in range(draw.randint(0, 9)))) for i in range(60)]
    df = spark.createDataFrame(rows, KINDS).repartition(4)
    for alone in (None, winnow.ALONE_WORDS):
        gone = {}
        for run, places in brute_lines(rows, alone or 10**9).items():
            for (has, d, t), i in places:
                if ((has, d, t), i) != min(places):
                    gone.setdefault((d if has else None, t), set()).update(range(i, i + len(run)))
        found = {(r["doc_id"], r["n_lines"]): r["removed"] for r in winnow.repeated_lines(df, new_store(spark), alone).collect()}
        assert found == {(d, len(t.split("\n"))): sorted(g) for (d, t), g in gone.items()}


def test_long_lines_go_alone(spark):
    passage = " ".join(f"word{i}" for i in range(8))
    texts = [(None, f"a\n{passage}\nb"), (1, f"c\n{passage}\nd\nshort line\ne"), (2, f"f\nshort line\n\ng\n{passage}\n{passage}"), (3, passage), (4, passage + " more"), (5, None)]
    df = spark.createDataFrame(texts, KINDS)
    long = winnow.repeated_lines(df, new_store(spark), alone=winnow.ALONE_WORDS)
    assert {r["doc_id"]: (r["n_lines"], r["n_removed"], r["removed"]) for r in long.collect()} == {1: (5, 1, [1]), 2: (6, 2, [4, 5]), 3: (1, 1, [0])}
    assert winnow.repeated_lines(df, new_store(spark)).collect() == []
