"""Small tables with the awkward rows every operator must take."""

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def documents(spark, texts, sources=None, ids=None):
    """Texts as documents with ids from 0 unless `ids` says otherwise."""
    ids = range(len(texts)) if ids is None else ids
    sources = sources or ["s"] * len(texts)
    rows = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in zip(ids, texts, sources)]
    return spark.createDataFrame(rows, DOCS)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))
