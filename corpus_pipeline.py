"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coffer.llm import jaccard, lines, mixing, quality
from coffer.llm.frames import checked_join, table
from coffer.llm.queries import packed
from coffer.session import materialise


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    NULL and empty texts are scored like others, by the statistics of an empty text; rows that
    share an id, and equal rows, are judged one by one.  Texts of any length are scored whole.
    No rows give no rows.
    """
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that occurred before; one of which nothing is left goes.

    ``n_chars`` follows the text.  Documents that lose no line stay, whatever their text.
    """
    cleaned = lines.drop_repeated_lines(docs)
    emptied = (F.col("__lines_gone") > 0) & (F.col("__lines_gone") == F.col("__lines_n"))
    columns = [
        F.when(F.col("__lines_gone") > 0, F.length("text")).otherwise(F.col(c)).alias(c)
        if c == "n_chars"
        else F.col(f"`{c}`")
        for c in docs.columns
    ]
    return cleaned.filter(~emptied).select(*columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near duplicates.

    Of rows that share an id one stays; rows without an id stay, as do texts without a
    word, which link with nothing.
    """
    found = jaccard.similar_documents(docs)
    dropped = materialise(found.filter("doc_id <> component_id").select("doc_id").distinct(), "dropped")
    again = materialise(
        found.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "again"
    )
    kept = checked_join(docs, dropped, "doc_id", "left_anti")
    once = checked_join(kept, again, "doc_id", "left_anti")
    return once.unionByName(checked_join(kept, again, "doc_id", "left_semi").dropDuplicates(["doc_id"]))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for.

    NULL and empty texts and texts of white space have no words and go.  A NULL source is one
    source.  Rows that share an id draw for themselves; of rows equal in all columns a counted
    part has the copy more.
    """
    return mixing.repeated(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences.

    Every row is a document of its own, NULL ids and repeated rows included; a NULL or empty
    text is its end token alone, a very long one many pieces.  No rows give no pieces.
    """
    return packed(docs)


STAGES = [
    ("quality", good_documents),
    ("line_dedup", without_repeated_lines),
    ("near_duplicates", one_of_each_group),
    ("mixing", mixed),
    ("packing", sequences),
]

# A trained classifier and a tokenizer have no SQL; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
