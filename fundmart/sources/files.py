"""Finding delivery files: listing, duplicates, checksums, the synthetic-data guard."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import BinaryIO
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundmart.layouts import ANALYSIS, HEADER, LABEL, load_layout
from fundmart.session import path_exists
from fundmart.sources.names import file_name, readable_path, stem, with_name_parts
from fundmart.texts import DUPLICATE_FILE

CHUNK = 4 << 20
# More than any header record has.
HEAD = 1 << 16

_FILE_SCHEMA = "uri string, Pad string, Bestandsnaam string"


def literal_path(path: str) -> str:
    """Escape glob characters: a listed path is a name, not a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """All files under ``root``, recursively, without reading their content."""
    if not path_exists(spark, root):
        return spark.createDataFrame([], _FILE_SCHEMA)
    return files_at(spark, [root])


def files_at(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(uri, Pad, Bestandsnaam)`` per file, taken from the file index Spark makes.

    A scan would leave out files without a byte; those must be reported.
    """
    index = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load([literal_path(p) for p in paths])
    )
    uris = spark.createDataFrame([(uri,) for uri in index.inputFiles()], "uri string")
    # The index writes a local file with three slashes, a scan with one.
    uri = F.regexp_replace("uri", "^file:/+", "file:/")
    path = readable_path(uri)
    return uris.select(
        uri.alias("uri"), path.alias("Pad"), file_name(path).alias("Bestandsnaam")
    )


def delivery_files(files: DataFrame) -> DataFrame:
    """Name parts plus the delivery label (the file name without its extension)."""
    named = with_name_parts(files, "Bestandsnaam")
    return named.withColumn(LABEL, stem(F.col("Bestandsnaam")))


def mark_duplicates(files: DataFrame, name: str, path: str) -> DataFrame:
    """Add ``Eerste`` (first path of the same delivery, in path order) and ``Dubbel``.

    The first path comes from an aggregate that combines before the shuffle, so a
    name that is repeated very often stays cheap; the join back is skew-split.
    """
    same = files.withColumn("_stam", F.upper(stem(F.col(name))))
    first = same.groupBy("_stam").agg(
        F.min_by(path, F.split(path, "/")).alias("Eerste")
    )
    return (
        same.join(first, "_stam", "left")
        .withColumn("Dubbel", F.col(path) != F.col("Eerste"))
        .drop("_stam")
    )


def duplicate_text(relative_first: Column) -> Column:
    return F.format_string(DUPLICATE_FILE, relative_first)


def checksum(content: Column) -> Column:
    return F.sha2(content, 256)


def _per_file(files: DataFrame, read: Callable[[BinaryIO], str], schema: str) -> DataFrame:
    """Open each ``uri`` in a task and hand the stream to ``read``: (uri, result).

    The stream comes from the file system that the URI names, as executors see it, so a
    file never lies in memory whole. One row per file is dealt out evenly.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            uris = batch.column(0).to_pylist()
            results = []
            for uri in uris:
                # Scans write a local file with one slash and with escapes.
                address = re.sub("^file:/+", "/", uri)
                if address.startswith("/"):
                    system, path = fs.LocalFileSystem(), unquote(address)
                else:
                    system, path = fs.FileSystem.from_uri(address)
                with system.open_input_file(path) as stream:
                    results.append(read(stream))
            columns = [pa.array(uris, pa.string()), pa.array(results, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = [part.split()[0] for part in schema.split(", ")]
    return files.select("uri").repartition("uri").mapInArrow(run, schema)


def checksums(files: DataFrame) -> DataFrame:
    """SHA-256 of the bytes of each file, ``(uri, Sha256)``, whatever its size."""
    chunk = CHUNK

    def digest(stream: BinaryIO) -> str:
        state = hashlib.sha256()
        while part := stream.read(chunk):
            state.update(part)
        return state.hexdigest()

    return _per_file(files, digest, "uri string, Sha256 string")


def file_heads(files: DataFrame) -> DataFrame:
    """First line of each file, ``(uri, value)``; only the head of a file is read."""
    size = HEAD

    def first(stream: BinaryIO) -> str:
        head = stream.read(size).removeprefix(b"\xef\xbb\xbf")
        return head.splitlines()[0].decode("utf-8", "replace") if head else ""

    return _per_file(files, first, "uri string, value string")


def overview(files: DataFrame) -> DataFrame:
    """The recognised files, as the user sees them before processing."""
    return files.filter(F.col("Soort").isNotNull()).select(
        F.col("Bestandsnaam").alias("Bestand"),
        "Soort",
        "Bekostigingsjaar",
        F.date_format("Aangemaakt", "yyyy-MM-dd").alias("Aangemaakt"),
        "BRIN",
    )


def with_guard(files: DataFrame, first_lines: DataFrame, brin: str) -> DataFrame:
    """Add ``synthetic``: the guarded institution code in the name and in the header.

    ``first_lines`` has ``uri`` and ``value``, the first line of each file; a
    renamed real file does not pass, since its header names its own institution.
    """
    place = load_layout(ANALYSIS)[HEADER].names().index("BRIN")
    parts = F.split("value", r"\|", -1)
    header = first_lines.select(
        "uri",
        ((F.get(parts, F.lit(0)) == HEADER) & (F.get(parts, F.lit(place)) == brin)).alias("_kop"),
    )
    synthetic = F.coalesce((F.col("BRIN") == brin) & F.col("_kop"), F.lit(False))
    return files.join(header, "uri", "left").withColumn("synthetic", synthetic).drop("_kop")
