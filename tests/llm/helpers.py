from __future__ import annotations

import random

#: Null and empty texts, odd white space, ties and repeated rows.
EDGE_TEXTS = [None, "", " ", "\n\n", "a", "A", "one two", "one  two", "É è", "x" * 5000, "pass  word\t\ttab\x85nel nbsp"]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(3)


def with_clashes(df):
    """Columns that an operator may also want to use."""
    from pyspark.sql import functions as F

    for name in "fp key kept keep_id count component_id score leak_words digest n_tokens group_size node root".split():
        df = df.withColumn(name, F.lit("own"))
    return df


def prose(seed: int, n: int, vocabulary: int = 50) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def by_id(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}
