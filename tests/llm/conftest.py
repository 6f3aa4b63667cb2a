import random

import pytest

LONG = " ".join(f"word{i % 977} of the" for i in range(30_000))


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(
        rng.choice(["the", "of", "and", "un"]) if rng.random() < 0.3 else rng.choice(["river", "stone", "über", "niño"]) + str(rng.randrange(40))
        for _ in range(n)
    )


def fixture_rows() -> list[tuple]:
    """Documents with nulls, empty and very long texts, ties, repeats, copies and near copies."""
    rng = random.Random(7)
    shared = sentence(rng, 40)
    rows = [(i, sentence(rng, rng.randrange(3, 120)), rng.choice(["en", "de", None]), rng.choice(["a", "b", None]), 0) for i in range(40)]
    rows += [(100 + i, rows[3][1], "en", "a", 0) for i in range(6)]  # copies
    rows += [(120 + i, f"{sentence(rng, 10)} {shared} {sentence(rng, 10)}", "en", "b", 0) for i in range(8)]  # a shared passage
    rows += [(140, None, None, None, None), (141, "", "en", "a", 0), (142, " \n\t ", "en", "a", 0), (143, "é", "de", "a", 1)]
    rows += [(144, LONG, "en", "a", 0), (145, "a" * 3000, "en", "a", 0), (146, "ab" * 900 + "\x00é" * 200, "en", "", 0)]
    rows += [(5, rows[5][1], rows[5][2], rows[5][3], 0)]  # a repeated row
    return rows


@pytest.fixture(scope="session")
def rows():
    return fixture_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
