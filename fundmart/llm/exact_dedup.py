"""Exact dedup: group by a 128-bit content hash, compare bytes inside the groups.

Texts are shuffled once, by (hash, text): the hash decides where a text goes, the
equality of the grouping key compares the bytes, and copies are combined before the
shuffle, so a group of any size arrives as one row per task. What follows is narrow.

Defined results: a null text counts as empty; a null id is never the largest, and a
group with null ids only has a null ``keep_id``. Rows that repeat both id and text get
the same verdict in ``exact_groups`` and are one row in ``keep_one_copy``. Other columns
play no part in ``exact_groups``, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundmart.llm.base import named, query, table, text_of, written


def content_hash(text):
    """128 bits of a text's UTF-8 bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def sha256(text):
    return F.sha2(text.cast("binary"), 256)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``keep_id`` (largest id with the same text), ``group_size``,
    ``kept`` and ``text_sha256``.

    Two texts with one hash are two rows of ``classes`` because their bytes differ; the
    SHA-256 that the result carries anyway leads each document to its own row.
    """
    rows = docs.select(named(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    classes = (
        rows.groupBy(content_hash(F.col("text")).alias("hash"), "text")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("hash", sha256(F.col("text")).alias("text_sha256"), "keep_id", "group_size")
    )
    # Written, so that both sides of the join are plain exchanges: a hot hash can be split.
    classes = written(classes, "exact-classes")
    documents = rows.select(
        "doc_id",
        content_hash(F.col("text")).alias("hash"),
        sha256(F.col("text")).alias("text_sha256"),
    )
    return documents.join(classes, ["hash", "text_sha256"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        "text_sha256",
    )


def keep_one_copy(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns: of equal texts the one with the largest id."""
    rest = [c for c in docs.columns if c != text_col]
    kept = (
        docs.select(
            F.struct(*[named(c) for c in rest]).alias("row"),
            F.struct(named(id_col).isNotNull(), named(id_col)).alias("rank"),
            text_of(text_col).alias("text"),
            named(text_col).isNull().alias("no_text"),
        )
        .groupBy(content_hash(F.col("text")).alias("hash"), "text")
        .agg(F.max_by(F.struct("row", "no_text"), F.col("rank")).alias("kept"))
    )
    columns = [
        (F.when(~F.col("kept.no_text"), F.col("text")) if c == text_col
         else F.col("kept.row")[c]).alias(c)
        for c in docs.columns
    ]
    return kept.select(*columns)


@query("""
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
 count(*) OVER (PARTITION BY t) AS group_size,
 doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
""")
def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(table(spark, folder, "documents"))
