import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket int, score double, __mark string"
WORDS = [a + b for a in "ka lo mi ne tu ra so vi".split() for b in "nd st r l mp".split()] + ["école", "größe", "niño"]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls everywhere, empty and long texts, exact and near copies, repeated rows, and columns with clashing names."""
    rng = random.Random(4)
    base, long, passage = prose(rng, 120), prose(rng, 9000), prose(rng, 60)
    near = base.split()
    near[60] = "changed"
    texts = [base, base, " ".join(near), base.upper(), long, None, "", "  \t\n ", "one two", "One  TWO", "x" * 700, passage + " " + prose(rng, 30), prose(rng, 25) + " " + passage]
    texts += [prose(rng, rng.randint(1, 200)) for _ in range(25)] + ["a <|endoftext|> b", "it's  two  spaces\n\n here, and 3 digits 12345 ♥", "\x1c\x85 ends "]
    rows = [(i, t, "en", None if i % 7 == 0 else f"src{i % 3}", len(t) if t else None, i, 0.5, "m") for i, t in enumerate(texts)]
    rows += [rows[0], rows[3], (None, base, None, "src0", None, None, None, None), (None, "nobody's own text here at all", None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
