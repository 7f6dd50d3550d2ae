"""Coverage and the quality report."""

from __future__ import annotations

import json
import platform
from collections.abc import Iterator
from datetime import datetime

import pyspark
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundmart import __version__
from fundmart.layouts import LABEL, LAYOUT_OF_KIND, load_layout
from fundmart.operators.checks import severity_rank, status_of
from fundmart.session import TextFile, small_side
from fundmart.texts import FAIL, MESSAGE_COLUMNS, OK, SOURCE, STAR_SOURCE, WARN

QUALITY_FILE = "quality.json"
# Version 2: the provenance names Spark.
REPORT_VERSION = 2

_MESSAGE = T.StructType(
    [
        T.StructField("controle", T.StringType()),
        T.StructField("recordsoort", T.StringType()),
        T.StructField("melding", T.StringType()),
        T.StructField("aantal", T.LongType()),
        T.StructField("ernst", T.StringType()),
    ]
)
_PROVENANCE = ("pakketversie", "python", "spark", "aangemaakt")
REPORT_SCHEMA = T.StructType(
    [
        T.StructField("schema_version", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("fouten_toegestaan", T.BooleanType()),
        T.StructField("total_errors", T.LongType()),
        T.StructField("total_warnings", T.LongType()),
        T.StructField(
            "provenance", T.StructType([T.StructField(n, T.StringType()) for n in _PROVENANCE])
        ),
        T.StructField(
            "leveringen",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("levering", T.StringType()),
                        T.StructField("bestandsnaam", T.StringType()),
                        T.StructField("sha256", T.StringType()),
                        T.StructField("status", T.StringType()),
                        T.StructField("meldingen", T.ArrayType(_MESSAGE)),
                    ]
                )
            ),
        ),
        T.StructField(
            "star",
            T.StructType(
                [
                    T.StructField("status", T.StringType()),
                    T.StructField("meldingen", T.ArrayType(_MESSAGE)),
                ]
            ),
        ),
        T.StructField(
            "dekking",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("levering", T.StringType()),
                        T.StructField("recordsoort", T.StringType()),
                        T.StructField("rijen", T.LongType()),
                    ]
                )
            ),
        ),
    ]
)


def coverage(deliveries: DataFrame, kind: str, expected: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows per delivery and record type of its kind; none counts as 0.

    ``expected`` has ``kind`` and ``recordsoort``: an equi-join on the kind gives
    exactly the pairs that can occur. ``counts`` has the label, ``recordsoort``, ``n``.
    """
    return (
        deliveries.select(LABEL, kind)
        .join(small_side(expected), kind)
        .join(counts, [LABEL, "recordsoort"], "left")
        .select(LABEL, "recordsoort", F.coalesce("n", F.lit(0)).cast("bigint").alias("rijen"))
    )


def expected_records(spark: SparkSession) -> DataFrame:
    """Record types per delivery kind, in layout order."""
    rows = [
        (kind, rs, place)
        for kind, layout in LAYOUT_OF_KIND.items()
        for place, rs in enumerate(load_layout(layout))
    ]
    return spark.createDataFrame(rows, "SoortLevering string, recordsoort string, plaats int")


def delivery_coverage(
    spark: SparkSession, stacked: dict[str, DataFrame], deliveries: DataFrame
) -> DataFrame:
    parts = [
        df.groupBy(LABEL).agg(F.count("*").alias("n")).withColumn("recordsoort", F.lit(rs))
        for rs, df in stacked.items()
        if len(rs) == 3
    ]
    counts = spark.createDataFrame([], f"{LABEL} string, n bigint, recordsoort string")
    for part in parts:
        counts = counts.unionByName(part)
    places = expected_records(spark)
    covered = coverage(deliveries, "SoortLevering", places.drop("plaats"), counts)
    kinds = deliveries.select(LABEL, "SoortLevering")
    order = covered.join(kinds, LABEL).join(places, ["SoortLevering", "recordsoort"])
    return order.orderBy(LABEL, "plaats").select(LABEL, "recordsoort", "rijen")


def source_statuses(messages: DataFrame) -> DataFrame:
    """Status per source, combined before the shuffle."""
    return messages.groupBy(SOURCE).agg(status_of(F.col("Ernst")).alias("status"))


def message_items(messages: DataFrame) -> DataFrame:
    """Each message with its JSON object, ``item``, as the report shows it."""
    shown = F.struct(*[F.col(c).alias(c.lower()) for c in MESSAGE_COLUMNS])
    return messages.withColumn("item", F.to_json(shown, {"ignoreNullFields": "false"}))


def message_totals(messages: DataFrame) -> DataFrame:
    """One row: messages, errors, warnings and the overall status."""
    rank = severity_rank(F.col("Ernst"))
    return messages.agg(
        F.count("*").alias("messages"),
        F.count_if(rank == 2).alias("total_errors"),
        F.count_if(rank == 1).alias("total_warnings"),
        status_of(F.col("Ernst")).alias("status"),
    )


def table_totals(tables: dict[str, DataFrame]) -> tuple[int, int]:
    """Number of tables and of rows over all of them, in one query."""
    if not tables:
        return 0, 0
    counts = [df.agg(F.count("*").alias("n")) for df in tables.values()]
    union = counts[0]
    for other in counts[1:]:
        union = union.unionByName(other)
    return len(tables), union.agg(F.sum("n")).first()[0]


def provenance() -> dict[str, str]:
    now = datetime.now().astimezone()
    values = (__version__, platform.python_version(), pyspark.__version__, now.isoformat("T", "seconds"))
    return dict(zip(_PROVENANCE, values, strict=True))


def report_heads(messages: DataFrame, deliveries: DataFrame) -> DataFrame:
    """A row for every delivery with its status, then for sources without a delivery row."""
    found = source_statuses(messages.filter(F.col(SOURCE) != STAR_SOURCE))
    listed = deliveries.select(F.col(LABEL).alias(SOURCE), "Bestandsnaam", "Sha256", F.lit(0).alias("_los"))
    joined = listed.join(found, SOURCE, "full")
    return joined.select(
        F.coalesce("_los", F.lit(1)).alias("_los"),
        SOURCE,
        "Bestandsnaam",
        "Sha256",
        F.coalesce("status", F.lit(OK)).alias("status"),
    )


def write_report(
    spark: SparkSession,
    folder: str,
    messages: DataFrame,
    deliveries: DataFrame,
    allowed: bool,
    covered: DataFrame,
    order: str,
) -> str:
    """Write ``quality.json``, complete at any size.

    Sources and messages are sorted alike and stream through the driver side by side, one
    partition at a time, into the open file; no source's messages are ever held together.
    """
    totals = message_totals(messages).first()
    heads = report_heads(messages, deliveries)
    items = message_items(messages)
    place = heads.select(SOURCE, "_los")
    lines = items.filter(F.col(SOURCE) != STAR_SOURCE).join(place, SOURCE)
    lines = lines.orderBy("_los", SOURCE, order, *MESSAGE_COLUMNS).select("_los", SOURCE, "item")
    star = items.filter(F.col(SOURCE) == STAR_SOURCE)
    status = star.agg(status_of(F.col("Ernst"))).first()[0]
    top = {
        "schema_version": REPORT_VERSION,
        "status": totals["status"],
        "fouten_toegestaan": allowed,
        "total_errors": totals["total_errors"],
        "total_warnings": totals["total_warnings"],
        "provenance": provenance(),
    }
    path = f"{folder}/{QUALITY_FILE}"
    with TextFile(spark, path) as out:
        out.write(json.dumps(top, indent=2, ensure_ascii=False).removesuffix("\n}"))
        out.write(',\n  "leveringen": [')
        _write_sources(out, heads.orderBy("_los", SOURCE), lines)
        out.write(f'],\n  "star": {{"status": {json.dumps(status or OK)}, "meldingen": [')
        _write_list(out, (r["item"] for r in star.orderBy(order, *MESSAGE_COLUMNS).toLocalIterator()))
        out.write(']},\n  "dekking": [')
        rows = covered.toLocalIterator()
        _write_list(out, (json.dumps(r.asDict(), ensure_ascii=False) for r in rows))
        out.write("]\n}\n")
    return path


def _write_list(out: TextFile, items: Iterator[str]) -> None:
    for i, item in enumerate(items):
        out.write(("," if i else "") + "\n    " + item)


def _write_sources(out: TextFile, heads: DataFrame, lines: DataFrame) -> None:
    left = lines.toLocalIterator()
    line = next(left, None)
    for i, head in enumerate(heads.toLocalIterator()):
        shown = {
            "levering": head[SOURCE],
            "bestandsnaam": head["Bestandsnaam"],
            "sha256": head["Sha256"],
            "status": head["status"],
        }
        text = json.dumps(shown, ensure_ascii=False).removesuffix("}")
        out.write(("," if i else "") + f'\n    {text}, "meldingen": [')
        n = 0
        while line is not None and (line["_los"], line[SOURCE]) == (head["_los"], head[SOURCE]):
            out.write(("," if n else "") + "\n      " + line["item"])
            line, n = next(left, None), n + 1
        out.write("]}")


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REPORT_SCHEMA).option("multiLine", True).json(path)


def read_status(spark: SparkSession, path: str) -> tuple[str, int]:
    row = read_report(spark, path).select("status", "total_errors").first()
    return row[0], row[1]


def _keys(text: str, expected: list[str]):
    found = F.array_sort(F.json_object_keys(F.col(text)))
    return ~F.coalesce(found == F.array(*[F.lit(k) for k in sorted(expected)]), F.lit(False))


def report_violations(spark: SparkSession, path: str) -> DataFrame:
    """Where a written report breaks its contract: one row per broken rule."""
    text = spark.read.text(path, wholetext=True)
    doc = text.select("value", F.from_json("value", REPORT_SCHEMA).alias("r"))
    statuses = [OK, WARN, FAIL]
    every = F.concat(F.flatten(F.col("r.leveringen.meldingen")), F.col("r.star.meldingen"))
    bad_message = F.exists(
        every,
        lambda m: m["controle"].isNull()
        | m["recordsoort"].isNull()
        | m["melding"].isNull()
        | ~F.coalesce(m["aantal"] >= 0, F.lit(False))
        | ~F.coalesce(m["ernst"].isin("error", "warning"), F.lit(False)),
    )
    bad_delivery = F.exists(
        F.col("r.leveringen"),
        lambda d: d["levering"].isNull()
        | ~F.coalesce(d["status"].isin(statuses), F.lit(False))
        | ~F.coalesce(d["sha256"].rlike("^[0-9a-f]{64}$"), F.lit(True)),
    )
    bad_coverage = F.exists(
        F.col("r.dekking"),
        lambda c: c["levering"].isNull()
        | c["recordsoort"].isNull()
        | ~F.coalesce(c["rijen"] >= 0, F.lit(False)),
    )
    nested = doc.select(
        "value",
        "r",
        F.get_json_object("value", "$.provenance").alias("_provenance"),
        F.get_json_object("value", "$.star").alias("_star"),
    )
    counts = (F.col("r.total_errors") >= 0) & (F.col("r.total_warnings") >= 0)
    rules = {
        "keys": _keys("value", REPORT_SCHEMA.names),
        "provenance": _keys("_provenance", list(_PROVENANCE)),
        "star": _keys("_star", ["status", "meldingen"]),
        "version": ~F.coalesce(F.col("r.schema_version") == REPORT_VERSION, F.lit(False)),
        "status": ~F.coalesce(
            F.col("r.status").isin(statuses) & F.col("r.star.status").isin(statuses), F.lit(False)
        ),
        "totals": ~F.coalesce(counts, F.lit(False)),
        "allowed": F.col("r.fouten_toegestaan").isNull(),
        "messages": F.coalesce(bad_message, F.lit(True)),
        "deliveries": F.coalesce(bad_delivery, F.lit(True)),
        "coverage": F.coalesce(bad_coverage, F.lit(True)),
    }
    broken = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    return nested.select(F.explode(broken).alias("rule"))
