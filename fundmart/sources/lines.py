"""Lines of raw files in source order, without a shuffle of the lines.

Spark has no file order, so every line carries its position inside its scan
partition (``_m``, from ``monotonically_increasing_id``). Lines of one file block
lie together in a partition, so the number of a line is its position in the
block plus the count of all earlier blocks; the second part is a running sum over
one row per block, and is joined back. No file, however large, passes one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundmart.functions.text import is_blank
from fundmart.sources.files import literal_path

# Fixed value: line ends that count besides CR and LF (vertical tab, form feed,
# the information separators, next line, line and paragraph separator).
_EXTRA_LINE_ENDS = "\\x0b\\x0c\\x1c\\x1d\\x1e\\x85\\u2028\\u2029"


def raw_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(uri, block_start, value)`` per physical line, bytes untouched."""
    return spark.read.text([literal_path(p) for p in paths]).select(
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_block_start").alias("block_start"),
        "value",
    )


def first_lines(raw: DataFrame) -> DataFrame:
    """First line of each file, ``(uri, value)``."""
    numbered = raw.withColumn("_m", F.monotonically_increasing_id())
    return (
        numbered.filter("block_start = 0").groupBy("uri").agg(F.min_by("value", "_m").alias("value"))
    )


def latin1_files(raw: DataFrame) -> DataFrame:
    """Files with at least one line that is not UTF-8; those are read as Latin-1."""
    valid = raw.groupBy("uri").agg(F.bool_and(F.is_valid_utf8("value")).alias("utf8"))
    return valid.filter("not utf8").select("uri")


def text_lines(raw: DataFrame, latin1: list[str]) -> DataFrame:
    """Decoded lines with their position: ``(uri, block_start, _m, value)``."""
    text = F.col("value")
    if latin1:
        as_latin1 = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
        text = F.when(F.col("uri").isin(latin1), as_latin1).otherwise(text)
    split = raw.select("uri", "block_start", F.explode(F.split(text, f"[{_EXTRA_LINE_ENDS}]", -1)).alias("value"))
    return split.withColumn("_m", F.monotonically_increasing_id())


def numbered_text_lines(
    df: DataFrame, keys: list[str], text: str, number: str, line: str
) -> DataFrame:
    """Non-blank lines of a text column with their 1-based number; blank lines count."""
    lines = F.posexplode(F.split(F.col(text), f"\\r\\n|[\\r\\n{_EXTRA_LINE_ENDS}]", -1))
    split = df.select(*keys, lines.alias("_pos", line))
    return split.filter(~is_blank(F.col(line))).select(
        *keys, (F.col("_pos") + 1).cast("bigint").alias(number), line
    )


def block_offsets(blocks: DataFrame, keys: list[str], count: str, offset: str) -> DataFrame:
    """Add the number of rows in all earlier blocks of the same ``keys``.

    ``blocks`` has one row per file block, so the window holds block counts, not
    lines: about 8,000 rows for a file of 1 TB.
    """
    earlier = (
        W.partitionBy(*keys)
        .orderBy("block_start")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    return blocks.withColumn(offset, F.coalesce(F.sum(count).over(earlier), F.lit(0)))


def number_lines(lines: DataFrame, number: str = "_regelnr") -> DataFrame:
    """1-based line number per file, for ``lines`` that come from a written table."""
    blocks = lines.groupBy("uri", "block_start").agg(
        F.count("*").alias("_n"), F.min("_m").alias("_first")
    )
    offsets = block_offsets(blocks, ["uri"], "_n", "_before").select(
        "uri", "block_start", (F.col("_before") - F.col("_first") + 1).alias("_base")
    )
    return (
        lines.join(offsets, ["uri", "block_start"])
        .withColumn(number, F.col("_m") + F.col("_base"))
        .drop("_base")
    )
