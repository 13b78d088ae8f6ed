import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tid string, fp long, digest string, _gone int, keep_id int, "
SCHEMA += "own int, row_key int, row_id int, key int, node int, words int, seeds int, row int, at int, share double, part int, root int, u int, v int, m int"
#: Columns whose names also occur inside the operators.
CLASHING = ("x", 1, "d", 7, 9, *range(9), 0.5, *range(5))


@pytest.fixture(scope="session")
def docs(spark):
    """Rows of (doc_id, text) or (doc_id, text, lang) as a documents table with clashing extra columns."""

    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or ""), *CLASHING) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)

    return make


@pytest.fixture(scope="session")
def prose():
    """Deterministic invented prose."""

    def make(seed, n_words, syllables=("ba", "re", "ti", "lo", "mu", "san", "der", "vik")):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n_words))

    return make
