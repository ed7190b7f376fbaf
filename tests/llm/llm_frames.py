"""Odd rows that every operator has to bear."""

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that operators use themselves.
    *[T.StructField(n, T.StringType()) for n in ("shard", "slot", "id", "score", "found_id", "gone_id", "target", "copies", "shards", "mix_key", "pii_found", "block", "n_values")],
])
EXTRA = ("x",) * 12 + (None,)


def frame(spark, rows):
    """(doc_id, text, lang, source) with clashing extra columns."""
    return spark.createDataFrame([(*r, len(r[1] or ""), *EXTRA) for r in rows], SCHEMA)


LONG = " ".join(f"w{k % 977}x{k % 31}" for k in range(30_000))
ROWS = [
    (1, "alpha beta gamma delta epsilon zeta", "en", "a"), (2, None, "en", "a"), (3, "", None, None), (4, " \t\n ", "de", "b"), (5, LONG, "de", "b"),
    (6, "one", None, "c"), (None, "no id here at all", "fr", None), (7, "ünï côdé 漢字 words", "fr", "c"), (8, "alpha beta gamma delta epsilon zeta", "en", "a"),
    (9, "alpha beta gamma delta epsilon zeta", None, "b"), (9, "alpha beta gamma delta epsilon zeta", None, "b"), (10, LONG + " tail", None, None),
]


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, ROWS).cache()


@pytest.fixture(scope="session")
def none(spark):
    return frame(spark, [])
