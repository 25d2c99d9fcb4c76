from __future__ import annotations

import pytest
from pyspark.sql import types as T

from tests.conftest import TINY

PROSE = " ".join(f"word{i} of the story" for i in range(30))
LONG = " ".join(f"w{i % 7919}x{i}" for i in range(60_000))

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        *(
            T.StructField(c, T.IntegerType())
            for c in "_doc _row _id _at _h hash node bucket s size kept score text_key copies n_lines n_entities label".split()
        ),
    ]
)
EXTRA = tuple(range(len(SCHEMA) - 4))

#: nulls, empty and very long texts, ties and repeated rows
EDGES = [
    (1, PROSE, "en", "a"),
    (1, PROSE, "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, "b"),
    (4, " \t\r\n ", "en", None),
    (None, PROSE, "en", "b"),
    (None, None, None, None),
    (5, LONG, "de", "b"),
    (6, LONG.replace("w5x5 ", "other "), "de", "c"),
    (7, "a b c", "en", "a"),
    (8, "A B C", None, "b"),
    (9, "123 456 %%%", "fr", None),
    (10, "Café ß œuvre\nCafé ß œuvre\n\nfin", "fr", "c"),
    (-11, PROSE + " end", "en", "c"),
]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame([(*row, *EXTRA) for row in EDGES], SCHEMA).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (5, 1, 0), (9, 0, 0), (9, 0, 0), (None, 1, 0), (10, None, 0), (77, 1, 1)], "doc_id long, quality int, toxic int"
    )


@pytest.fixture(scope="session")
def tiny_docs(spark):
    return spark.read.parquet(f"{TINY}/documents.parquet")


@pytest.fixture(scope="session")
def tiny_rows(tiny_docs):
    return [(r["doc_id"], r["text"]) for r in tiny_docs.select("doc_id", "text").collect()]
