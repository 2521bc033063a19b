import random

import pytest

#: Columns that clash with names the operators use themselves.
CLASH = "part int, n long, cls long, gram long, size string, row string, rest string, kept string, group string"


def words(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


@pytest.fixture(scope="session")
def nasty(spark):
    """Documents with null, empty, blank, very long, repeated and nearly repeated texts, null ids and clashing columns."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefgéßж") for _ in range(rng.randint(1, 8))) for _ in range(400)]
    base = words(rng, 200, vocabulary)
    passage = words(rng, 60, vocabulary)
    near = base.split(" ")
    near[100] = "changed"
    rows = [(0, None, "en", "a"), (1, "", "en", "a"), (2, " \t\n\x0b\x0c\r ", None, None), (3, base, "en", "a"), (4, base, "fr", "b"),
            (5, " ".join(near), "en", "a"), (6, base.upper(), "en", "a"), (7, "one two", "de", "b"), (8, "One  TWO", "de", "b"),
            (9, words(rng, 40, vocabulary) + " " + passage + " " + words(rng, 30, vocabulary), "en", "a"),
            (10, passage + "\n" + words(rng, 300, vocabulary), "en", None), (11, "same " * 400, "en", "c"),
            (12, words(rng, 20_000, vocabulary), "en", "c"), (13, "x" * 50_000, "en", "c"), (14, "   . , !", None, "c"),
            (15, "1 2 3 \U0001F600 4", None, "c"), (16, "áİ ﬁx Σσ", "en", "c")]
    rows += [(20 + k, words(rng, rng.randint(1, 120), vocabulary), rng.choice(["en", "fr"]), rng.choice("ab")) for k in range(60)]
    rows += [rows[3], rows[3], (None, None, None, None), (None, base, "en", "a"), (None, "no id here at all", "en", None)]
    rng.shuffle(rows)
    schema = f"doc_id long, text string, lang string, source string, {CLASH}"
    return spark.createDataFrame([(*r, *([None] * 9)) for r in rows], schema).repartition(5)


@pytest.fixture(scope="session")
def none(nasty):
    return nasty.where("false")


@pytest.fixture(scope="session")
def sample(spark):
    """The smallest tables of the driver."""
    folder = "/root/testdata/sf0.001"
    return lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
