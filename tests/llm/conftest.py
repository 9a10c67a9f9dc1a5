from __future__ import annotations

import random

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside or return: as extra input columns they must not matter.
EXTRA = ("fp", "size", "score", "text_key", "component_id", "key", "place", "p", "id", "y", "h1", "kind", "tokens", "target")


def prose(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="session")
def doc_frame(spark):
    """A documents frame from texts (ids count up) or from (doc_id, text) pairs, with extra columns."""
    def make(texts, sources=None, extra=True):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(i, t, "en", sources[k] if sources else f"s{k % 3}", len(t or "")) for k, (i, t) in enumerate(pairs)]
        df = spark.createDataFrame(rows, DOC)
        if extra:
            from pyspark.sql import functions as F
            df = df.select("*", *[F.lit(7).alias(c) for c in EXTRA])
        return df
    return make
