"""Small document tables with awkward rows, and plain union-find."""

import random

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

WORDS = "the of and river stone garden winter letter music window market engine silver paper bottle forest".split()


def frame(spark, rows, parts=3):
    """A documents table from (doc_id, text) or (doc_id, text, lang, source) tuples."""
    full = [(*r, *(["en", "s"][len(r) - 2 :]), len(r[1]) if r[1] is not None else None)[:5] if len(r) < 5 else r for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(parts)


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b"),
    (4, "one"),
    (5, "éà 漢字 𝄞 ß"),
    (6, "x" * 50_000),
    (7, "word " * 20_000),
    (8, "a\x00b\x01 c"),
    (9, "...!!! 123 456"),
    (10, "same text here for all of us"),
    (11, "same text here for all of us"),
    (11, "same text here for all of us"),
    (None, "a row without an id"),
]


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
