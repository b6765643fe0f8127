"""The prefix trie against a plain one."""

import hashlib
import random
import re
import zlib

import pytest

from clinloom.llm import trie
from clinloom.llm.common import new_store

SCHEMA = "conv_id long, turn long, role string, text string, depth int, key string, words string"


def plain(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append(((turn is not None, turn), role, digest, text))
    own = {c: [(r, t) for _, r, _, t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        whole[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    words = {n: len(re.findall("[^\x20\x09-\x0d]+", n[-1][1])) if n else 0 for n in members}
    out = []
    for n, cs in members.items():
        inside = [m for m in members if m[: len(n)] == n]
        ends = ",".join(str(c) for c in sorted(c for c in cs if len(whole[c]) == len(n)))
        leaves = [m for m in inside if not any(len(x) == len(m) + 1 and x[: len(m)] == m for x in inside)]
        children = [m for m in inside if len(m) == len(n) + 1]
        saved = sum((len(members[m]) - 1) * words[m] for m in inside)
        out.append((min(cs), len(n), min(members[n[:-1]]) if n else None, len(cs), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows):
    frame = spark.createDataFrame([(*r, 9, "k", "w") for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in trie.prefix_trie(frame, new_store(spark)).collect()), key=str)


def conversations(n, seed=4):
    draw = random.Random(seed)
    texts = ["hello there", "a b  c", "", None, "x\ty", "long " * 40]
    return [(c, t, draw.choice(["user", "assistant", None]) if draw.random() < 0.2 else "user", draw.choice(texts[: 2 + c % 5])) for c in range(n) for t in range(draw.randint(1, 5))]


@pytest.fixture(params=[0, 60, 50_000])
def turns(request, monkeypatch):
    """Levels one by one, some together, all together."""
    monkeypatch.setattr(trie, "BAND_TURNS", request.param)


def test_nodes(spark, turns):
    rows = conversations(90)
    rows += [(c, None, "user", "first of all") for c in (3, 20, 45)] + [(7, 0, "user", "again")] * 2 + [(None, 0, "user", "nobody's")]
    rows += [(-3, 0, "user", "below zero"), (-20, 0, "user", "hello there"), (10**12 + 7, 4, None, None)]
    assert found(spark, rows) == plain(rows)


def test_many_equal_conversations(spark, monkeypatch):
    monkeypatch.setattr(trie, "ID_LETTERS", 40)  # many pieces of one key
    rows = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(3)] + [(c, 0, "user", "alone") for c in range(300, 320)]
    assert found(spark, rows) == plain(rows)


def test_a_long_conversation_and_its_beginnings(spark, turns):
    rows = [(0, t, "user", f"word {t}") for t in range(25)] + [(20, t, "user", f"word {t}") for t in range(12)] + [(40, t, "user", f"word {t}") for t in range(25)]
    assert found(spark, rows) == plain(rows)


def test_no_conversations(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "x")]) == []


def test_role_and_text_do_not_run_together(spark):
    rows = [(0, 0, "ab", "c"), (20, 0, "a", "bc"), (40, 0, "ab", "c")]
    assert found(spark, rows) == plain(rows)


def test_bands():
    assert trie.bands({}, 10) == []
    assert trie.bands({0: 1}, 10) == [(0, 0)]
    assert trie.bands({2: 100, 9: 1}, 10) == [(9, 3), (2, 2), (1, 1), (0, 0)]
    assert trie.bands({3: 2, 1: 50}, 4) == [(3, 2), (1, 1), (0, 0)]
