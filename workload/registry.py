"""Where queries and their SQL are registered, and how tables are read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Expressions that Spark and the SQL engine read alike: a delivery per order year,
# a kind per priority, and a creation date.
ORDER_DATE = "CAST(o_orderdate AS DATE)"
ORDER_YEAR = "CAST(year(o_orderdate) AS BIGINT)"
KIND = """CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'VLPBEK' WHEN '2' THEN 'DEFBEK'
 WHEN '3' THEN 'HISBEK' ELSE 'VLPBEK' END"""
ORDER_LABEL = f"'VLPBEK_' || {ORDER_YEAR}"

# A status list and a funding flag per line item.
LINE_STATUS = """CASE WHEN l_returnflag = 'A' THEN 'pi'
 WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'na,ti'
 WHEN l_returnflag = 'N' THEN 'mv'
 WHEN l_quantity < 10 THEN CAST(NULL AS STRING)
 WHEN l_linestatus = 'F' THEN 'ex,zz' ELSE 'jl' END"""
LINE_FUNDED = """CASE WHEN l_returnflag = 'A' THEN true
 WHEN l_tax > 0.07 THEN CAST(NULL AS BOOLEAN) ELSE false END"""
