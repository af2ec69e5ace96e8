"""Small tables of awkward rows that the operators' tests share."""

import random

WORDS = "the of and to in a is that for on with as was be by this are or it an".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    made = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(60)]
    return " ".join(rng.choice(WORDS if rng.random() < 0.4 else made) for _ in range(n))


LONG = prose(1, 30_000)
AWKWARD = [None, "", " ", "\n\t \r", "a", "A b", "É ß 中文 😀", "!!! ...", "x" * 50_000, LONG]


def rows(texts, lang="en"):
    return [(i, t, lang, f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, lang="en"):
    return spark.createDataFrame(rows(texts, lang), SCHEMA)
