from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"


def same(a, b) -> bool:
    return np.array_equal(a, b)


class Groups:
    """Union-find; the smallest member stands for its group."""

    def __init__(self, members):
        self.parent = {m: m for m in members}

    def of(self, x):
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def link(self, a, b):
        a, b = self.of(a), self.of(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def links(sets, num, den):
    """All pairs of positions whose sets have num/den of their union in common."""
    having, out = {}, []
    for j, s in enumerate(sets):
        common = {}
        for x in s:
            for o in having.get(x, ()):
                common[o] = common.get(o, 0) + 1
            having.setdefault(x, []).append(j)
        out += [(o, j) for o, k in common.items() if den * k >= num * (len(s) + len(sets[o]) - k)]
    return out

LONG = " ".join(f"word{i * 7919 % 10007}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(70))
SPECIAL = [
    (None, "a text without an id\nand a second line of it"),
    (None, None),
    (9000, None),
    (9001, ""),
    (9002, " \t\n\x0b\x0c\r "),
    (9003, "One"),
    (9003, "One"),
    (9004, "... 123 !!"),
    (9005, LONG),
    (9006, "intro " + LONG),
    (9007, "before it " + PASSAGE + " after it"),
    (9008, "other words here " + PASSAGE),
    (9009, PASSAGE),
    (9009, PASSAGE + " but another text of the same id"),
    (9010, "'tis <|endoftext|> we're done \U0001f642 漢字"),
    (9011, "A Line That Is Repeated Fuzzily In Here\nand one that is not"),
    (9012, "a line  that is repeated fuzzily in here\n\nshort\nshort"),
    (9013, "x" * 3000),
]
#: Extra columns, named as operators name theirs.
CLASHES = ["score", "row", "node", "kept", "keep_id", "doc", "row_key", "ranges", "sequence_id", "text_sha256", "hash", "part"]


def documents(spark, rows):
    out = spark.createDataFrame([(d, t, "en", "s", None if t is None else len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return out.withColumns({c: F.lit("extra") for c in CLASHES})


@pytest.fixture(scope="session")
def corpus(spark):
    """(doc_id, text) of the smallest table and of rows that operators must handle, and their DataFrame."""
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    rows = given + SPECIAL
    return rows, documents(spark, rows)


@pytest.fixture(scope="session")
def nothing(spark):
    return documents(spark, [])
