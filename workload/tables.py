"""Merging versions, unions, numbering, dimensions and bridges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundmart.codelists import code_list, codes
from fundmart.functions.text import first_filled
from fundmart.functions.text import label as filled_label
from fundmart.operators import merge
from fundmart.operators.numbering import fact_key, number_rows
from fundmart.operators.numbering import order_check as steps
from fundmart.plans import star
from fundmart.plans.indicators import preview as first_rows
from workload.registry import KIND, LINE_STATUS, ORDER_DATE, ORDER_LABEL, ORDER_YEAR, query, table

_VERSION = f"""o_custkey, o_orderkey,
 CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS status,
 CASE WHEN o_totalprice > 300000 THEN NULL ELSE o_orderpriority END AS prioriteit,
 CASE WHEN o_orderpriority LIKE '5%' THEN NULL ELSE {ORDER_DATE} END AS aanmaak"""
_SQL_ORDER = "{d: coalesce(-date_diff('day', DATE '1970-01-01', aanmaak), 2147483647), k: o_orderkey}"


@query(
    f"""WITH v AS (SELECT {_VERSION} FROM orders)
SELECT o_custkey, arg_min(status, {_SQL_ORDER}) FILTER (status IS NOT NULL) AS status,
 arg_min(prioriteit, {_SQL_ORDER}) FILTER (prioriteit IS NOT NULL) AS prioriteit
FROM v GROUP BY 1"""
)
def newest_first_merge(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").selectExpr(
        "o_custkey",
        "o_orderkey",
        "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS status",
        "CASE WHEN o_totalprice > 300000 THEN NULL ELSE o_orderpriority END AS prioriteit",
        f"CASE WHEN o_orderpriority LIKE '5%' THEN NULL ELSE {ORDER_DATE} END AS aanmaak",
    )
    return merge.newest_first(
        orders, "o_custkey", ["status", "prioriteit"], "aanmaak", ["o_orderkey"]
    )


@query(
    f"""WITH v AS (SELECT {_VERSION} FROM orders)
SELECT o_custkey, o_orderkey, status, aanmaak FROM v
QUALIFY row_number() OVER (PARTITION BY o_custkey
 ORDER BY aanmaak DESC NULLS LAST, o_orderkey) = 1"""
)
def newest_per_group(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").selectExpr(
        "o_custkey",
        "o_orderkey",
        "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS status",
        f"CASE WHEN o_orderpriority LIKE '5%' THEN NULL ELSE {ORDER_DATE} END AS aanmaak",
    )
    return merge.newest_per_group(orders, ["o_custkey"], "aanmaak", ["o_orderkey"])


@query(
    f"""SELECT o_orderkey, levering, rij, 'D:' || levering || ':' || rij AS "_feit_id" FROM (
 SELECT o_orderkey, {ORDER_LABEL} AS levering, row_number() OVER (
 PARTITION BY year(o_orderdate) ORDER BY o_orderkey) - 1 AS rij FROM orders)"""
)
def row_number_keys(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").selectExpr("o_orderkey", f"{ORDER_LABEL} AS levering")
    numbered = number_rows(orders, ["levering"], "o_orderkey", "rij")
    return numbered.withColumn("_feit_id", fact_key("D", F.col("levering"), F.col("rij")))


@query(
    """WITH s AS (SELECT event_type, value - lag(value) OVER (
 PARTITION BY event_type ORDER BY event_id) AS step FROM events)
SELECT event_type, count(*) AS rows, count(*) FILTER (step > 0) AS rises,
 count(*) FILTER (step < 0) AS falls, count(*) FILTER (step = 0) AS unchanged
FROM s GROUP BY 1"""
)
def order_check(spark: SparkSession, folder: str) -> DataFrame:
    return steps(table(spark, folder, "events"), "event_type", "event_id", "value")


@query(
    """SELECT c_name AS naam, c_nationkey AS land, c_acctbal AS saldo, c_mktsegment AS segment,
 CAST(NULL AS DATE) AS datum FROM customer
UNION ALL SELECT s_name, s_nationkey, s_acctbal, NULL, NULL FROM supplier"""
)
def union_missing_columns(spark: SparkSession, folder: str) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("naam", T.StringType()),
            T.StructField("land", T.IntegerType()),
            T.StructField("saldo", T.DoubleType()),
            T.StructField("segment", T.StringType()),
            T.StructField("datum", T.DateType()),
        ]
    )
    customers = table(spark, folder, "customer").selectExpr(
        "c_name AS naam", "c_nationkey AS land", "c_acctbal AS saldo", "c_mktsegment AS segment"
    )
    suppliers = table(spark, folder, "supplier").selectExpr(
        "s_acctbal AS saldo", "s_name AS naam", "s_nationkey AS land"
    )
    return merge.with_template(spark, [customers, suppliers], schema)


def _line_bridge(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", f"{LINE_STATUS} AS status"
    )
    return star.status_bridge([(lines, "deelname")], ["l_orderkey", "l_linenumber"], "status")


@query(
    f"""SELECT l_orderkey, l_linenumber, 'deelname' AS "Bron",
 unnest(string_split({LINE_STATUS}, ',')) AS "Code" FROM lineitem"""
)
def status_bridge(spark: SparkSession, folder: str) -> DataFrame:
    return _line_bridge(spark, folder)


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _sql_code_list() -> str:
    """The status code list as SQL rows, from the same fixed values."""
    from fundmart.codelists import _rows

    rows = [
        f"({', '.join(_sql_text(r[c]) for c in ('Code', 'Omschrijving', 'Groep', 'Bekostigd'))})"
        for r in _rows("bekostigingstatus")
    ]
    return f'lijst("Code", "Omschrijving", "Groep", "Bekostigd") AS (VALUES {", ".join(rows)})'


SQL_DIM_STATUS = f"""{_sql_code_list()},
dim_status AS (SELECT "Code", "Omschrijving", "Groep", "Bekostigd" = 'J' AS "Bekostigd" FROM lijst
 UNION ALL SELECT DISTINCT code, 'Onbekende code (niet in de PvE)', 'Onbekend', false
 FROM (SELECT unnest(string_split({LINE_STATUS}, ',')) AS code FROM lineitem)
 WHERE code NOT IN (SELECT "Code" FROM lijst))"""


@query(f"WITH {SQL_DIM_STATUS} SELECT * FROM dim_status")
def status_dimension(spark: SparkSession, folder: str) -> DataFrame:
    known = code_list(spark, "bekostigingstatus")
    return star.dim_status(_line_bridge(spark, folder), known, codes("bekostigingstatus"))


@query(
    """WITH own AS (SELECT s_nationkey AS k FROM supplier WHERE s_acctbal > 5000)
SELECT k AS "BRIN", k IN (SELECT k FROM own) AS "EigenInstelling" FROM (
 SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 0
 UNION SELECT s_nationkey FROM supplier UNION SELECT k FROM own)"""
)
def institution_dimension(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").selectExpr(
        "CASE WHEN c_acctbal > 0 THEN c_nationkey END AS land"
    )
    suppliers = table(spark, folder, "supplier")
    own = suppliers.filter("s_acctbal > 5000").select("s_nationkey")
    return star.dim_institution(
        [(customers, "land"), (suppliers, "s_nationkey"), (own, "s_nationkey")], own
    )


_BSN = "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'B' || o_custkey END"
_ONR = "CASE WHEN o_totalprice < 50000 THEN NULL ELSE 'O' || o_custkey END"


@query(f"SELECT o_orderkey, coalesce({_BSN}, {_ONR}) AS \"_persoon_id\" FROM orders")
def person_key(spark: SparkSession, folder: str) -> DataFrame:
    people = table(spark, folder, "orders").selectExpr(
        "o_orderkey", f"{_BSN} AS bsn", f"{_ONR} AS onr"
    )
    return people.select("o_orderkey", first_filled("bsn", "onr").alias("_persoon_id"))


_OWN_YEAR = "CASE WHEN l_linestatus = 'F' THEN NULL ELSE CAST(year(l_shipdate) AS BIGINT) END"


@query(
    f"""SELECT l_orderkey, l_linenumber, coalesce({_OWN_YEAR}, {ORDER_YEAR}) AS jaar
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus <> 'P'"""
)
def delivery_year(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", f"{_OWN_YEAR} AS eigen"
    )
    years = table(spark, folder, "orders").filter("o_orderstatus <> 'P'").selectExpr(
        "o_orderkey AS l_orderkey", f"{ORDER_YEAR} AS leverjaar"
    )
    return lines.join(years, "l_orderkey", "left").select(
        "l_orderkey", "l_linenumber", F.coalesce("eigen", "leverjaar").alias("jaar")
    )


@query(
    f"""SELECT DISTINCT year AS jaar FROM (SELECT {ORDER_YEAR} AS year FROM orders
 WHERE {KIND} = 'VLPBEK' INTERSECT SELECT {ORDER_YEAR} + 2 FROM orders WHERE {KIND} = 'DEFBEK')"""
)
def comparable_years(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").selectExpr(f"{KIND} AS soort", f"{ORDER_YEAR} AS jaar")
    # A final delivery follows two years later, so not every year has both.
    final = orders.filter("soort = 'DEFBEK'").withColumn("jaar", F.col("jaar") + 2)
    return merge.common_values(orders.filter("soort = 'VLPBEK'"), final, "jaar")


@query(
    """SELECT p_partkey, coalesce(CASE WHEN p_size < 5 THEN NULL ELSE p_brand END, 'onbekend')
 || ' (' || coalesce(CAST(CASE WHEN p_size > 45 THEN NULL ELSE p_size END AS VARCHAR), 'onbekend')
 || ')' AS label FROM part"""
)
def labels(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").selectExpr(
        "p_partkey",
        "CASE WHEN p_size < 5 THEN NULL ELSE p_brand END AS merk",
        "CASE WHEN p_size > 45 THEN NULL ELSE p_size END AS maat",
    )
    return parts.select("p_partkey", filled_label("{} ({})", "merk", "maat"))


@query(
    """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS datum
FROM orders ORDER BY o_orderkey LIMIT 1000"""
)
def preview(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").selectExpr(
        "o_orderkey", "o_custkey", "o_orderstatus", f"{ORDER_DATE} AS datum"
    )
    return first_rows(orders, "o_orderkey")


@query(
    f"""WITH kinds(soort) AS (VALUES ('VLPBEK'), ('DEFBEK'), ('HISBEK'), ('XXXBEK'))
SELECT soort, soort IN (SELECT {KIND} FROM orders) AS aanwezig FROM kinds"""
)
def kind_present(spark: SparkSession, folder: str) -> DataFrame:
    kinds = spark.createDataFrame([("VLPBEK",), ("DEFBEK",), ("HISBEK",), ("XXXBEK",)], "soort string")
    found = table(spark, folder, "orders").selectExpr(f"{KIND} AS soort")
    return merge.flag_members(kinds, "soort", found, "aanwezig")
