"""Prepared tables (one folder per table, one partition per delivery) and star tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundmart.layouts import LABEL, merged_record, prepared_schema, record_types
from fundmart.operators.checks import duplicate_keys
from fundmart.plans.delivery_checks import ORDER
from fundmart.plans.star import DELIVERY_SCHEMA, STAR_TABLES, build_star
from fundmart.session import child_names, path_exists
from fundmart.sinks import HELPERS
from fundmart.texts import ERROR, MESSAGE_COLUMNS, OUTDATED

DELIVERY = "LEVERING"
MESSAGES = "VALIDATIE"
# How many messages a delivery was written with; tells whether they are all there.
MESSAGE_COUNT = "_meldingen"


def table_schema(name: str) -> T.StructType:
    """Fixed schema of a prepared table. Reading never infers one: a label such as
    2024 would turn into a number, and an older table lacks columns."""
    if name == DELIVERY:
        extra = [
            T.StructField("SchemaVersie", T.StringType()),
            T.StructField(MESSAGE_COUNT, T.LongType()),
        ]
        return T.StructType(DELIVERY_SCHEMA.fields + extra)
    if name == MESSAGES:
        kinds = {"Aantal": T.LongType()}
        names = (LABEL, *MESSAGE_COLUMNS, ORDER)
        return T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in names])
    return prepared_schema(merged_record(name))


def prepared_tables() -> list[str]:
    return [*record_types(), DELIVERY, MESSAGES]


def _holds_parquet(spark: SparkSession, root: str) -> bool:
    for name in prepared_tables():
        for part in child_names(spark, f"{root}/{name}"):
            if any(f.endswith(".parquet") for f in child_names(spark, f"{root}/{name}/{part}")):
                return True
    return False


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    path = f"{root}/{name}"
    if not path_exists(spark, path):
        return None
    return spark.read.schema(table_schema(name)).parquet(path).select(table_schema(name).names)


def read_csv_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A prepared table as CSV. Every partition has the same columns; they are text."""
    names = [n for n in table_schema(name).names if n not in HELPERS]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    data = T.StructType([f for f in schema if f.name != LABEL] + [schema[LABEL]])
    table = spark.read.schema(data).option("header", True).option("enforceSchema", False)
    return table.csv(f"{root}/{name}").select(names)


def stack_prepared(
    spark: SparkSession, roots: list[str], labels: list[str] | None = None
) -> dict[str, DataFrame]:
    """All prepared tables of the given folders, stacked, label first.

    One folder holds any number of deliveries, so many deliveries are one read.
    ``labels`` renames the delivery of each folder (one per folder).
    """
    if labels is not None and len(labels) != len(roots):
        raise ValueError(f"labels heeft {len(labels)} elementen, sources heeft {len(roots)}")
    for root in roots:
        if not path_exists(spark, root):
            raise FileNotFoundError(f"Bronmap niet gevonden: {root}")
        if not _holds_parquet(spark, root):
            raise ValueError(
                f"Geen Parquet-bestanden in {root}. Het star schema leest alleen Parquet; "
                "verwerk het bestand zonder --fmt csv."
            )
    stacked: dict[str, DataFrame] = {}
    for name in prepared_tables():
        frames = []
        for i, root in enumerate(roots):
            df = read_table(spark, root, name)
            if df is not None:
                frames.append(df.withColumn(LABEL, F.lit(labels[i])) if labels else df)
        if frames:
            stacked[name] = reduce(DataFrame.unionByName, frames)
    refuse_duplicate_labels(stacked)
    return stacked


def refuse_duplicate_labels(stacked: dict[str, DataFrame]) -> None:
    """Two deliveries under one label would silently become one."""
    if DELIVERY not in stacked:
        return
    double = duplicate_keys(stacked[DELIVERY], [LABEL]).select(LABEL).orderBy(LABEL)
    names = [row[0] for row in double.collect()]
    if names:
        raise ValueError(
            f"Leveringslabel(s) komen meer dan eens voor: {', '.join(names)}. "
            "Geef elke levering een eigen naam."
        )


def labels_of(stacked: dict[str, DataFrame]) -> DataFrame:
    """Every delivery that has rows in some prepared table.

    The label is the partition of the tables, so no column is read.
    """
    parts = [df.select(LABEL).distinct() for df in stacked.values()]
    return reduce(DataFrame.unionByName, parts).distinct()


def outdated_labels(stacked: dict[str, DataFrame]) -> DataFrame:
    """Deliveries whose stored messages are not complete with their severities.

    A delivery from before severities has no message count, or its messages read
    back without a severity, or it has no ``LEVERING`` row at all; all of it shows in
    the rows, without opening each file.
    """
    df = labels_of(stacked)
    if DELIVERY in stacked:
        df = df.join(stacked[DELIVERY].select(LABEL, MESSAGE_COUNT), LABEL, "left")
    else:
        df = df.withColumn(MESSAGE_COUNT, F.lit(None).cast("bigint"))
    if MESSAGES in stacked:
        graded = stacked[MESSAGES].filter(F.col("Ernst").isNotNull())
        df = df.join(graded.groupBy(LABEL).agg(F.count("*").alias("_n")), LABEL, "left")
    else:
        df = df.withColumn("_n", F.lit(0))
    complete = F.coalesce(F.col("_n"), F.lit(0)) >= F.col(MESSAGE_COUNT)
    return df.filter(~F.coalesce(complete, F.lit(False))).select(LABEL)


def stored_messages(spark: SparkSession, stacked: dict[str, DataFrame]) -> DataFrame:
    """Messages of all deliveries as report rows with their order, plus one error per
    outdated delivery. Rows without a severity are dropped."""
    schema = f"Bron string, {', '.join(f'{c} string' for c in MESSAGE_COLUMNS)}, {ORDER} string"
    schema = schema.replace("Aantal string", "Aantal bigint")
    if not stacked:
        return spark.createDataFrame([], schema)
    old = outdated_labels(stacked).select(
        F.col(LABEL).alias("Bron"),
        F.lit("Prepared-map").alias("Controle"),
        F.lit(MESSAGES).alias("Recordsoort"),
        F.lit(OUTDATED).alias("Melding"),
        F.lit(1).cast("bigint").alias("Aantal"),
        F.lit(ERROR).alias("Ernst"),
        F.lit("9").alias(ORDER),
    )
    if MESSAGES not in stacked:
        return old
    kept = stacked[MESSAGES].filter(F.col("Ernst").isNotNull())
    return kept.select(F.col(LABEL).alias("Bron"), *MESSAGE_COLUMNS, ORDER).unionByName(old)


def read_star(spark: SparkSession, folder: str) -> dict[str, DataFrame] | None:
    """All star tables with their fixed schemas, or none when one is missing."""
    if not all(path_exists(spark, f"{folder}/{name}") for name in STAR_TABLES):
        return None
    # The schemas of a star of no deliveries; nothing runs.
    schemas = {name: df.schema for name, df in build_star(spark, {}).items()}
    return {
        name: spark.read.schema(schema).parquet(f"{folder}/{name}").select(schema.names)
        for name, schema in schemas.items()
    }
