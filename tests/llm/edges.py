"""Tables with the awkward rows that every operator must take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, score double, n_words long"


def words(rng, n):
    return " ".join(rng.choice(["the", "of", "Zug", "é", "a1", "und.", "x,y", "%%%"]) + str(rng.randrange(500)) for _ in range(n))


def edge_docs(spark, more=()):
    """Nulls in every column, empty and long texts, equal texts, a repeated row, a null key."""
    rng = random.Random(5)
    base, long = words(rng, 120), words(rng, 9000)
    texts = [None, "", " \n\t ", "one", "a b c", base, base, base + " end", "start " + base, long, "x " * 300, *more]
    rows = [
        (i, t, None if i % 4 == 0 else "en", None if i % 3 == 0 else f"s{i % 2}", None, 7, 3, 0.1, 1)
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame([*rows, rows[5], (None, base, None, None, None, None, None, None, None)], SCHEMA)


def texts_of(df, key="doc_id", value="text"):
    return [(r[key], r[value]) for r in df.select(key, value).collect()]
