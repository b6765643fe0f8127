import random

import pytest

WORDS = [a + b for a in ("ba", "ko", "mi", "su", "te", "ra", "lo", "ni") for b in ("dan", "fel", "gor", "hin", "jas", "ket", "lum", "pov")]


def prose(n: int, seed: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(["", "", "", ".", ","]) for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls, empty and blank texts, a very long one, copies, near copies, repeated rows and ids."""
    base = prose(120, 1)
    near = base.split(" ")
    near[60] = "other"
    shared = prose(40, 2)
    return [
        (0, base, "a"), (1, base, "b"), (2, " ".join(near), "a"), (3, base.upper(), None),
        (4, None, "a"), (5, "", "b"), (6, " \n\t ", None), (7, "one two", "a"), (8, "One  TWO", "c"),
        (9, prose(30, 3) + "\n" + shared + "\n" + prose(30, 4), "c"), (10, prose(50, 5) + "\n" + shared + "\n" + prose(9, 6), "c"),
        (11, prose(9000, 7), "a"), (11, "same id, other text", "a"), (12, "twice", "b"), (12, "twice", "b"),
        (None, prose(60, 8), "a"), (13, prose(60, 8), "b"), (14, "ab" * 200, "b"), (15, "ab" * 90, "c"), (16, "Größe über naïve façade " * 12, None),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with extra columns named like the operators' own."""
    kinds = "doc_id long, text string, source string, lang string, n_chars long, size long, key string, node int, score double, removed int"
    return spark.createDataFrame([(*r, "xx", 1, 7, "k", 3, 0.5, None) for r in odd_rows()], kinds).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
