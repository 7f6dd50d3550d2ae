"""What the operators share: the query register, text clean-up, and written tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundmart.session import remove_folder, shared_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# A word is a run of anything but a space and the five white-space controls.
NO_SPACE = r"[^\x20\x09-\x0D]+"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, and its SQL where SQL can express it, under the function's name."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def named(column: str) -> Column:
    """A column by its plain name, dots included."""
    return F.col("`" + column.replace("`", "``") + "`")


def text_of(column: str) -> Column:
    """A text column; null counts as empty."""
    return F.coalesce(named(column).cast("string"), F.lit(""))


def held_out(id_col: str, parts: int) -> Column:
    """Rows that no label or count may be learnt from: CRC-32 of the id, modulo ``parts``, is 2.

    A null id is never held out.
    """
    remainder = F.crc32(named(id_col).cast("string")) % parts
    return F.coalesce(remainder == 2, F.lit(False))


_FOLDER: ContextVar[str | None] = ContextVar("folder", default=None)


def _scratch(spark: SparkSession) -> str:
    own = f"{shared_folder(spark)}/fundmart-llm-{spark.sparkContext.applicationId}"
    return _FOLDER.get() or own


@contextmanager
def own_folder(spark: SparkSession) -> Iterator[Callable[[], None]]:
    """Tables written inside go to a folder of their own; the call that it gives removes them."""
    folder = f"{_scratch(spark)}/{uuid.uuid4().hex}"
    token = _FOLDER.set(folder)
    try:
        yield lambda: remove_folder(spark, folder)
    finally:
        _FOLDER.reset(token)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Readers see one fixed set of rows however often tasks are run again, and no
    plan is computed twice. Results are lazy, so the files stay until the
    application calls ``clear_written``.
    """
    spark = df.sparkSession
    path = f"{_scratch(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_written(spark: SparkSession) -> None:
    """Remove this application's written tables, once its results are saved."""
    remove_folder(spark, _scratch(spark))
