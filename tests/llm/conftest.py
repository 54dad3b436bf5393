import random

import pytest

WORDS = [a + b + c for a in ("ba", "ke", "mi", "ro", "tu") for b in ("lan", "vo", "six", "") for c in ("ter", "na", "ig", "us")]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def frame(spark):
    """frame(schema, rows): a DataFrame in a few partitions."""
    return lambda schema, rows, parts=3: spark.createDataFrame(rows, schema).repartition(parts)


@pytest.fixture(scope="session")
def awkward(frame):
    """Documents with NULLs, blanks, repeated rows and ids, a long text, ties, and columns with clashing names."""
    base = prose(1, 300)
    texts = [
        (1, base),
        (2, base),
        (3, base + " and some more words at the end"),
        (4, None),
        (5, ""),
        (6, " \t\n "),
        (7, "tiny text"),
        (8, "tiny text"),
        (9, prose(2, 30_000)),
        (10, prose(3, 120) + " " + prose(1, 80)),
        (10, "another text with the same id"),
        (11, prose(4, 90)),
        (11, prose(4, 90)),
        (None, base),
        (None, "no id"),
        (12, "12345 ?! 67"),
        (13, "é" * 400 + " ünï " + "\U0001f600" * 120),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, id long, `spans` string, block int, size long, `row` string"
    rows = [(i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"s{k % 3}", k, k, "x", k, k, "y") for k, (i, t) in enumerate(texts)]
    return frame(schema, rows)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
