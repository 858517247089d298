"""Small inputs with every odd case."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def frame(spark, rows, clash=True):
    """rows of (doc_id, text, source); with clashing extra columns."""
    df = spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOCS)
    if clash:
        from pyspark.sql import functions as F

        for c in ("n", "sig", "rep", "size", "target", "score", "kept", "digest", "w", "spans", "row", "rank", "a", "b"):
            df = df.withColumn(c, F.lit("x"))
    return df.repartition(3)


def odd_rows(seed=0, n=60):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    rows = [(1, None, "a"), (2, "", None), (3, "   \n\t", "b"), (4, "one", "a"), (5, "one", "a"), (5, "one", "a"), (6, "ONE two", "b"), (7, "one two", None), (None, "no id here at all", "a"), (8, "x" * 50_000, "b"), (9, " ".join(rnd.choice(words) for _ in range(20_000)), "a")]
    for i in range(n):
        rows.append((100 + i, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 120))), rnd.choice(["a", "b", "c", None])))
    return rows
