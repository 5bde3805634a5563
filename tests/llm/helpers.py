from __future__ import annotations

import random


def prose(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def changed(rng: random.Random, text: str, n: int) -> str:
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


#: Names that operators might use for columns of their own.
CLASHES = ["key", "Node", "id", "k0", "found", "base", "live", "lo", "score", "rank", "ids", "host", "pos"]


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("no").alias(c) for c in CLASHES if c.lower() not in [x.lower() for x in df.columns]])
