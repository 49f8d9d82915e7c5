"""Small document tables for the operator tests."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])

VOCABULARY = [a + b for a in ("ta", "mi", "or", "un", "éa", "sol") for b in ("ne", "rk", "", "ls", "ßo", "vi", "an")]
ODD = [None, "", " \t\n\r ", "\n\n", "a", "Été x  y\tz", "0 1\x00 2", "日本 語", "w " * 60, "x\n" * 70, "nul" * 3000]


def sentence(rng: random.Random, n: int) -> str:
    return "".join(rng.choice(VOCABULARY) + rng.choice([" ", " ", "  ", "\n", ". ", " \t"]) for _ in range(n))


def frame(spark, texts, ids=None, langs=None):
    ids = range(len(texts)) if ids is None else ids
    langs = ["en"] * len(texts) if langs is None else langs
    rows = [(i, t, l, f"src{k % 3}", None if t is None else len(t)) for k, (i, t, l) in enumerate(zip(ids, texts, langs))]
    return spark.createDataFrame(rows, SCHEMA)
