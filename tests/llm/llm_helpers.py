import random
import re

import pytest
from pyspark.sql import types as T

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Texts that operators must take as they come: nothing, white space of every kind, non-ASCII, no words, very long ones.
ODD_TEXTS = [None, "", " ", "\n\n", "a", "A\tb\x0bc\x0cd\re", "ÄÖ ß x €", "####", "x" * 5000, "ab " * 20000, "\x00 \x1f y", "one two\none two\n one two\nthree"]


@pytest.fixture()
def docs(spark):
    """Make a documents table from texts; ids count from 0 unless given. More columns stand beside them."""

    def make(texts, ids=None, sources=None):
        schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
                               T.StructField("score", T.StringType()), T.StructField("Kept", T.StringType())])
        ids = list(range(len(texts))) if ids is None else ids
        sources = ["s"] * len(texts) if sources is None else sources
        return spark.createDataFrame([(i, t, s, "old", "old") for i, t, s in zip(ids, texts, sources)], schema)

    return make


def prose(rng: random.Random, n: int, vocabulary: int = 3000) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
