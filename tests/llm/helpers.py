import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["score", "lang_pred", "row", "spans", "kept", "_row", "_new", "piece", "n_words", "key"]


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    syllables = ["the", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en"]
    words = ["".join(random.Random(i).choice(syllables) for _ in range(1 + i % 4)) for i in range(vocabulary)]
    return " ".join(r.choice(words) + ("." if r.random() < 0.1 else "") for _ in range(n))


def edge_rows():
    """Nulls, empty, blank, letterless and very long texts, ties, repeated rows and ids."""
    long_text = prose(5, 60_000, 3000)
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", None, "a", 4), (4, "12 34 -- !!", "en", None, 11),
            (5, long_text, "en", "hot", len(long_text)), (6, prose(1, 300), "en", "hot", 1), (6, prose(1, 300), "en", "hot", 1),
            (7, prose(1, 300), "de", "hot", 1), (8, "x", "fr", "hot", 1), (None, prose(2, 50), None, "hot", 1),
            (None, None, None, None, None), (9, "ΑΣ İ K \u0000 \u001c ½ 日本語 \U0001f600 é", "de", "b", 9),
            (10, "b" * 300_000, "en", "hot", 300_000), (11, prose(3, 40) + " " + "é" * 50, "fr", "b", 2)]
    return rows + [(100 + k, prose(50 + k, 120), ["en", "de"][k % 2], "hot", 1) for k in range(20)]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def clashing(spark, edge):
    from pyspark.sql import functions as F
    return edge.select("*", *[F.lit(f"x{c}").alias(c) for c in CLASH])


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return sorted((tuple(str(v) for v in r) for r in df.collect()))
