"""The file path of the ingest, as the folder job takes it: delivery files are written from
the orders, then read, routed, staged, numbered, judged and hashed."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundmart.layouts import ANALYSIS, LABEL, LINE_NO, ROW_NO, load_layout
from fundmart.session import Stage, shared_folder
from fundmart.sources.files import checksums, files_at
from fundmart.sources.lines import latin1_files, raw_lines, text_lines
from fundmart.sources.records import (
    UNKNOWN,
    numbered_table,
    route,
    split_table,
    stage_lines,
    staged_messages,
)
from workload.registry import ORDER_YEAR, query, table

_WIDTH = len(load_layout(ANALYSIS)["BRD"].fields)
_BLB_WIDTH = len(load_layout(ANALYSIS)["BLB"].fields)
# A delivery per year and institution.
_DELIVERY = f"""'VLPBEK_' || {ORDER_YEAR} || '_' || {ORDER_YEAR} || '0115_'
 || CAST(o_custkey % 10 + 10 AS STRING) || 'XX'"""
# Short rows, rows of full width with and without more fields, unknown types and blank lines.
_LINE = f"""CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'BLB|' || o_custkey || '|' || o_orderkey
 WHEN '4' THEN 'XYZ|' || o_orderkey WHEN '5' THEN '  '
 ELSE 'BRD|' || o_custkey || '|' || o_orderkey || '|' || o_orderstatus
 || repeat('|', {_WIDTH - 4}) || CASE o_orderstatus WHEN 'O' THEN '|x| |y' WHEN 'P' THEN '| |'
 ELSE '' END END"""
_SQL_LINES = f"""lines AS (SELECT {_DELIVERY} AS levering, o_orderkey, {_LINE} AS regel FROM orders),
routed AS (SELECT levering, o_orderkey, regel, string_split(regel, '|') AS f,
 row_number() OVER (PARTITION BY levering ORDER BY o_orderkey) AS nummer FROM lines),
placed AS (SELECT *, CASE WHEN trim(regel) = '' THEN 'leeg' WHEN f[1] IN ('BLB', 'BRD') THEN f[1]
 ELSE 'onbekend' END AS tabel,
 CASE f[1] WHEN 'BRD' THEN {_WIDTH} WHEN 'BLB' THEN {_BLB_WIDTH} END AS breedte FROM routed),
judged AS (SELECT *, CASE WHEN breedte IS NOT NULL THEN
 len(list_filter(f[breedte + 1:], lambda x: trim(x) <> '')) END AS extra FROM placed)"""


def _delivery_folder(spark: SparkSession, folder: str) -> str:
    """A folder with one text file per delivery, its lines in order."""
    path = f"{shared_folder(spark)}/deliveries-{uuid.uuid4().hex}"
    lines = table(spark, folder, "orders").selectExpr(
        f"{_DELIVERY} AS levering", "o_orderkey", f"{_LINE} AS value"
    )
    # A delivery is a file, so its lines go to one writer.
    lines = lines.repartition("levering").sortWithinPartitions("levering", "o_orderkey")
    lines.select("levering", "value").write.partitionBy("levering").text(path)
    return path


def _staged(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Staged lines of all deliveries and their blocks, both written."""
    raw = raw_lines(spark, [_delivery_folder(spark, folder)])
    lines = text_lines(raw, [row[0] for row in latin1_files(raw).collect()])
    # Spark names the files that it writes by itself; a delivery's name is in the folder.
    named = lines.withColumn("uri", F.regexp_replace("uri", "levering=([^/]+)/[^/]+$", "$1.csv"))
    stage = Stage(spark)
    staged = stage_lines(stage, route(named, None))
    return staged, stage.write(split_table(staged), "splits")


@query(
    f"""WITH {_SQL_LINES}
SELECT levering, tabel, nummer AS regel, row_number() OVER (
 PARTITION BY levering, tabel ORDER BY o_orderkey) - 1 AS rij, f[1] AS rs,
 CASE WHEN breedte IS NOT NULL THEN array_to_string(f[:breedte], '|') END AS velden,
 CAST(extra AS INTEGER) AS extra FROM judged WHERE tabel <> 'leeg'"""
)
def staged_lines(spark: SparkSession, folder: str) -> DataFrame:
    staged, splits = _staged(spark, folder)
    numbered = [numbered_table(staged, splits, name) for name in ("BLB", "BRD", UNKNOWN)]
    return reduce(DataFrame.unionByName, numbered).select(
        LABEL,
        "tabel",
        F.col(LINE_NO).alias("regel"),
        F.col(ROW_NO).alias("rij"),
        "rs",
        F.array_join("velden", "|").alias("velden"),
        "extra",
    )


@query(
    f"""WITH {_SQL_LINES}
SELECT levering, nummer AS "Regelnummer", f[1] AS "Recordsoort",
 CASE WHEN tabel = 'onbekend' THEN 'Onbekende recordsoort'
 ELSE extra || ' meer gevulde velden dan het schema (' || breedte || ')' END AS "Melding"
FROM judged WHERE tabel = 'onbekend' OR extra > 0"""
)
def staged_line_messages(spark: SparkSession, folder: str) -> DataFrame:
    return staged_messages(*_staged(spark, folder))


@query(
    f"""WITH {_SQL_LINES}
SELECT levering, sha256(string_agg(regel || chr(10), '' ORDER BY o_orderkey)) AS sha256
FROM lines GROUP BY levering"""
)
def file_checksums(spark: SparkSession, folder: str) -> DataFrame:
    files = files_at(spark, [_delivery_folder(spark, folder)])
    label = F.regexp_extract("uri", "levering=([^/]+)/", 1).alias("levering")
    return checksums(files).select(label, F.col("Sha256").alias("sha256"))
