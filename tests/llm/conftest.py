from __future__ import annotations

import re

import pytest
from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use for their own columns.
        *[T.StructField(n, T.StringType()) for n in ("id", "score", "size", "key", "rank", "n", "copies", "lines", "y")],
    ]
)
LABEL = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("quality", T.LongType()), ("toxic", T.LongType()))])


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a table of documents from ``(doc_id, text, lang, source)``."""

    def make(rows):
        full = [(i, t, lang, s, None if t is None else len(t), *["x"] * 9) for i, t, lang, s in rows]
        return spark.createDataFrame(full, DOCUMENT)

    return make


@pytest.fixture(scope="session")
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, LABEL)


def words(text):
    return WORD.findall(text or "")


def prose(rng, n, vocabulary=None):
    vocabulary = vocabulary or [f"word{i}" for i in range(400)]
    return " ".join(vocabulary[i] for i in rng.integers(0, len(vocabulary), n))


# NULL and empty texts, white space, symbols alone, other scripts, one very long text,
# equal texts, a NULL id and an id that two rows share.
ODD = [
    (9001, None, None, None),
    (9002, "", "en", "src0"),
    (9003, " \t\n\x0b\x0c\r ", None, "src1"),
    (9004, "1234 !!! ###", "en", None),
    (9005, "été naïve 漢字 текст", "fr", "src0"),
    (9006, "long " * 200_000, "en", "src0"),
    (9007, "one two three four five six seven", "en", "src1"),
    (9008, "one two three four five six seven", "en", "src1"),
    (9009, "x" * 300_000, "en", "src1"),
    (None, "one two three four five six seven", "en", "src1"),
    (9010, "same row", "en", "src0"),
    (9010, "same row", "en", "src0"),
    (9011, "\n\n\n", "de", "src0"),
]
