"""From documents to token ids: each stage works on all that the one before it kept.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, folder) and returns
a DataFrame. All but the last return the columns of documents. ``run`` writes what each
stage returns to the shared folder and reads it back as the next one's documents, so a
lost executor costs no more than the stage it worked on. The tables of a stage are removed
once the next one is written; those of the last two stay until ``clear_written``, as the
result is lazy.

Defined results: a document without a text passes as one with an empty text, and keeps its
null up to the last stage; of a group a document with an id stays before one without; very
long texts go through whole; of repeated rows one stays; extra columns are passed on; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fundmart.llm.base import own_folder, table, written
from fundmart.llm.exact_dedup import keep_one_copy
from fundmart.llm.mixing import mixed_documents
from fundmart.llm.sentencepiece import encode_decode
from fundmart.llm.simhash import keep_one_of_group
from fundmart.llm.toxicity import learn_lexicon, without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the toxicity operator rejects go."""
    return without_toxic(docs, learn_lexicon(docs, table(spark, folder, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return keep_one_copy(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return keep_one_of_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Each document as often as its source's target and the sample say."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of every text, decoded again and compared."""
    return encode_decode(docs, keep=tuple(c for c in ("source", "lang") if c in docs.columns))


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources", mix_sources),
    ("SentencePiece", tokens),
]

# Scores, fingerprints and token ids are not for SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs, previous = table(spark, folder, "documents"), None
    for name, stage in STAGES[:-1]:
        with own_folder(spark) as remove_own:
            result = stage(spark, docs, folder)
        with own_folder(spark) as remove:
            docs = written(result, "stage-" + name.split()[0].lower())
        # What the stage wrote on its way, and what it read, has served.
        remove_own()
        if previous is not None:
            previous()
        previous = remove
    return STAGES[-1][1](spark, docs, folder)
