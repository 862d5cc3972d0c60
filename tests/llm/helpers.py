"""Small awkward tables for the text operators."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and to in is that for it with house river stone cloud paper garden window silver winter market".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ly", "ing", str(rng.randrange(9))]) for _ in range(n))


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in rows], DOCS)


def awkward(spark):
    """Nulls in every column, empty and very long texts, repeated rows."""
    rng = random.Random(3)
    long = sentence(rng, 30_000)
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t\x0b\x0c\r ", None, "a"), (4, "word", "en", None),
            (None, "no id at all here", "en", "b"), (None, None, None, None), (5, long, "en", "b"), (6, long, "en", "b"),
            (7, sentence(rng, 80), "en", "c"), (7, sentence(rng, 80), "en", "c"), (8, "same row", "en", "c"), (8, "same row", "en", "c"),
            (9, "été \U0001F600 naïve \x1c\x85 word", "fr", "d"), (10, "x" * 200_000, "de", "d"), (11, "!!! 123 ...", "en", "d")]
    return docs_of(spark, rows)


def clashing(df):
    """More columns, under names the operators use inside or give out."""
    from pyspark.sql import functions as F
    for name in ("n", "rid", "key", "rep", "h1", "row_", "copy_", "n_words", "score", "kept", "TEXT"):
        df = df.select("*", F.lit("clash").alias(name))
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)
