"""Small frames with the awkward rows every operator has to bear."""

from __future__ import annotations

import random

WORDS = ["alpha", "beta", "gamma", "delta", "épsilon", "Zeta", "eta,", "theta", "iota.", "kappa"]


def text(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, rank int, n_tokens string, domain string"


def documents(spark, texts: dict[int | None, str | None] | list[tuple[int | None, str | None]]):
    """Rows (doc_id, text), with columns whose names operators use themselves."""
    rows = list(texts.items()) if isinstance(texts, dict) else texts
    return spark.createDataFrame(
        [(i, t, None if i == 3 else "en", f"src{(i or 0) % 3}", len(t or ""), 0.5, 1, "x", None) for i, t in rows], SCHEMA
    )


def awkward() -> list[tuple[int | None, str | None]]:
    long = text(5, 3000)
    return [
        (0, text(0, 40)), (1, None), (2, ""), (3, "   \n\t\n"), (4, text(0, 40)), (5, long), (6, long + " more words"),
        (7, "one two"), (8, "one two"), (9, "x" * 5000), (None, text(9, 30)), (10, text(10, 60)), (10, text(10, 60)),
        (11, "İstanbul ΑΣ <|endoftext|>tail \x1c á 日本語 😀 don't 12,5"),
    ]


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
