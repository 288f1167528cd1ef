"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 60)) for _ in range(n))


def edited(text: str, at: int) -> str:
    words = text.split()
    words[at] = f"changed{at}"
    return " ".join(words)


def documents(spark, texts, extra: str = "score"):
    rows = [(i, text, "en", "src0", None if text is None else len(text), "x") for i, text in texts]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {extra} string")
