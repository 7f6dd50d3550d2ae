"""Combining versions and sources: newest first, templates, unions, key sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OLDEST = 2**31 - 1


def recency(date: str, *ties: str) -> Column:
    """Sort key with the newest date lowest; a missing date is never newest."""
    age = F.coalesce(-F.unix_date(F.col(date)), F.lit(_OLDEST))
    return F.struct(age.alias("_age"), *ties)


def newest_first(
    df: DataFrame, key: str, fields: list[str], date: str, ties: list[str]
) -> DataFrame:
    """Per key the first filled value of every field, newest row first.

    One aggregate that combines before the shuffle, so a key with very many rows
    costs its task one row per input partition.
    """
    order = recency(date, *ties)
    firsts = [
        F.min_by(f, F.when(F.col(f).isNotNull(), order)).alias(f) for f in fields
    ]
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(*firsts)


def newest_per_group(df: DataFrame, group: list[str], date: str, ties: list[str]) -> DataFrame:
    """The newest row of each group, as an aggregate instead of a window."""
    rest = [c for c in df.columns if c not in group]
    newest = F.min_by(F.struct(*rest), recency(date, *ties)).alias("_newest")
    return df.groupBy(*group).agg(newest).select(*group, "_newest.*").select(*df.columns)


def template(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table with a fixed schema."""
    return spark.createDataFrame([], schema)


def fit(df: DataFrame, schema: T.StructType) -> DataFrame:
    """All columns of ``schema``, in its order and types; missing ones are null."""

    def column(f: T.StructField) -> str:
        value = f"`{f.name}`" if f.name in df.columns else "NULL"
        return f"CAST({value} AS {f.dataType.simpleString()}) AS `{f.name}`"

    return df.selectExpr(*[column(f) for f in schema.fields])


def stack_tables(frames: list[DataFrame]) -> DataFrame:
    """One below the other by column name; a column a frame lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_template(spark: SparkSession, frames: list[DataFrame], schema: T.StructType) -> DataFrame:
    """Sources below each other, with all columns of ``schema`` guaranteed."""
    return stack_tables([fit(f, schema) for f in frames]) if frames else template(spark, schema)


def key_values(sources: list[tuple[DataFrame, str]], name: str) -> DataFrame:
    """Distinct filled key values over several tables."""
    # Each source is reduced to its own keys first, so little is left to combine.
    parts = [
        df.select(F.col(c).alias(name)).filter(F.col(name).isNotNull()).distinct()
        for df, c in sources
    ]
    return stack_tables(parts).distinct()


def flag_members(df: DataFrame, key: str, members: DataFrame, flag: str) -> DataFrame:
    """Boolean column: is the key one of the (distinct) ``members``?"""
    known = members.select(F.col(members.columns[0]).alias(key)).filter(
        F.col(key).isNotNull()
    ).distinct()
    return df.join(known.withColumn("_in", F.lit(True)), key, "left").select(
        *df.columns, F.col("_in").isNotNull().alias(flag)
    )


def missing_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` does not have."""
    return left.select(key).distinct().join(right.select(key).distinct(), key, "left_anti")


def common_values(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Values both tables have."""
    filled = F.col(column).isNotNull()
    return left.select(column).filter(filled).intersect(right.select(column).filter(filled))
