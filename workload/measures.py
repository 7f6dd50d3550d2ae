"""Indicators: fact base, funnel, reasons, shares, changes and history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundmart.functions.decode import decode
from fundmart.layouts import load_layout
from fundmart.operators.numbering import positions
from fundmart.plans import indicators as ind
from fundmart.plans import star as s
from fundmart.session import Stage
from fundmart.sources.records import split_records
from workload.registry import (
    KIND,
    LINE_FUNDED,
    LINE_STATUS,
    ORDER_DATE,
    ORDER_YEAR,
    query,
    table,
)
from workload.tables import SQL_DIM_STATUS

_LINE_YEAR = "CAST(year(l_shipdate) AS BIGINT)"
_LINE_FACT = {
    "_feit_id": "'D:' || l_orderkey || ':' || l_linenumber",
    "levering": f"'L' || {_LINE_YEAR}",
    "Bekostigingsjaar": _LINE_YEAR,
    "BRIN": "l_suppkey",
    "Opleidingscode": "l_partkey",
    "CodeBekostigingstatus": LINE_STATUS,
    "Bekostigingsindicatie": LINE_FUNDED,
}
_CHOSEN = ["L1996", "L1997", "L1998", "L1999", "L2000"]
_LEVELS = ["STANDARD", "ECONOMY", "PROMO"]


def _star(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    lines = table(spark, folder, "lineitem").selectExpr(
        *[f"{x} AS {name}" for name, x in _LINE_FACT.items()]
    )
    years = table(spark, folder, "orders").selectExpr(f"{ORDER_YEAR} AS jaar").distinct()
    bridge = s.status_bridge([(lines, "deelname")], ["_feit_id", "levering"])
    return {
        "dim_levering": years.selectExpr(
            "'L' || jaar AS levering",
            "CASE WHEN jaar < 1999 THEN 'VLPBEK' ELSE 'DEFBEK' END AS SoortLevering",
        ),
        "dim_instelling": table(spark, folder, "supplier").selectExpr(
            "s_suppkey AS BRIN", "s_acctbal > 0 AS EigenInstelling"
        ),
        "dim_opleiding": table(spark, folder, "part").filter("p_size < 49").selectExpr(
            "p_partkey AS Opleidingscode", "p_type AS Opleidingsniveau"
        ),
        "fact_deelname": lines,
        "fact_status": bridge,
    }


_SQL_FACTS = f"""facts AS (SELECT {", ".join(f'{x} AS "{n}"' for n, x in _LINE_FACT.items())}
 FROM lineitem),
base AS (SELECT f.*, d.soort AS "SoortLevering", p.p_type AS "Opleidingsniveau",
 NOT coalesce(list_contains(string_split("CodeBekostigingstatus", ','), 'mv'), false)
   AS "Beoordeeld"
 FROM facts f
 LEFT JOIN (SELECT DISTINCT 'L' || {ORDER_YEAR} AS levering,
  CASE WHEN {ORDER_YEAR} < 1999 THEN 'VLPBEK' ELSE 'DEFBEK' END AS soort FROM orders) d
  USING (levering)
 LEFT JOIN part p ON p.p_partkey = "Opleidingscode" AND p.p_size < 49
 WHERE levering IN ({", ".join(f"'{x}'" for x in _CHOSEN)})
 AND "BRIN" IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0))"""


@query(
    f"""WITH {_SQL_FACTS} SELECT * FROM base
WHERE "Opleidingsniveau" IN ({", ".join(f"'{x}'" for x in _LEVELS)})"""
)
def fact_base(spark: SparkSession, folder: str) -> DataFrame:
    return ind.fact_base(_star(spark, folder), "fact_deelname", _CHOSEN, _LEVELS)


@query(
    f"""WITH {_SQL_FACTS}
SELECT 'In bestand' AS "Stap", count(*) AS "Aantal" FROM base
UNION ALL SELECT 'Beoordeeld', count(*) FILTER ("Beoordeeld") FROM base
UNION ALL SELECT 'Bekostigd', count(*) FILTER ("Beoordeeld" AND "Bekostigingsindicatie") FROM base"""
)
def funnel(spark: SparkSession, folder: str) -> DataFrame:
    return ind.funnel(ind.fact_base(_star(spark, folder), "fact_deelname", _CHOSEN))


@query(
    f"""WITH {_SQL_FACTS}, {SQL_DIM_STATUS},
refused AS (SELECT DISTINCT "_feit_id" FROM base WHERE "Beoordeeld" AND NOT "Bekostigingsindicatie"),
bridge AS (SELECT "_feit_id", unnest(string_split("CodeBekostigingstatus", ',')) AS "Code" FROM facts)
SELECT "Groep", "Code", "Omschrijving", count(*) AS "Aantal"
FROM bridge JOIN dim_status USING ("Code")
WHERE NOT "Bekostigd" AND "_feit_id" IN (SELECT "_feit_id" FROM refused) GROUP BY ALL"""
)
def reasons(spark: SparkSession, folder: str) -> DataFrame:
    tables = _star(spark, folder)
    known = s.code_list(spark, "bekostigingstatus")
    tables["dim_status"] = s.dim_status(tables["fact_status"], known, s.codes("bekostigingstatus"))
    base = ind.fact_base(tables, "fact_deelname", _CHOSEN)
    # Keys of these facts repeat, and a bridge row counts if any fact with its key does.
    return ind.not_funded_reasons(base, tables["fact_status"], tables["dim_status"])


@query(
    f"""WITH {_SQL_FACTS}, {SQL_DIM_STATUS},
codes AS (SELECT unnest(string_split("CodeBekostigingstatus", ',')) AS "Code" FROM base
 WHERE "Beoordeeld" AND NOT "Bekostigingsindicatie")
SELECT "Groep", "Code", "Omschrijving", count(*) AS "Aantal"
FROM codes JOIN dim_status USING ("Code") WHERE NOT "Bekostigd" GROUP BY ALL"""
)
def fact_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """As ``reasons``, from the facts' own status lists."""
    tables = _star(spark, folder)
    known = s.code_list(spark, "bekostigingstatus")
    tables["dim_status"] = s.dim_status(tables["fact_status"], known, s.codes("bekostigingstatus"))
    return ind.reasons(ind.fact_base(tables, "fact_deelname", _CHOSEN), tables)


@query(
    f"""WITH {_SQL_FACTS}
SELECT "Opleidingscode", "Opleidingsniveau", count(*) AS "Totaal",
 count(*) FILTER ("Bekostigingsindicatie") AS "Bekostigd",
 count(*) FILTER ("Bekostigingsindicatie") / count(*) AS "AandeelBekostigd"
FROM base WHERE "Beoordeeld" GROUP BY 1, 2"""
)
def share_per_group(spark: SparkSession, folder: str) -> DataFrame:
    base = ind.fact_base(_star(spark, folder), "fact_deelname", _CHOSEN)
    return ind.lowest_share_first(ind.per_programme(base))


# Two versions of the orders: the final one has some statuses repaired, lost or new.
_KEYS = f"{ORDER_YEAR} AS jaar, o_custkey, o_orderpriority"
_BEFORE = "CASE o_orderstatus WHEN 'F' THEN 'pi' WHEN 'O' THEN 'na,ti' END"
_AFTER = "CASE WHEN o_totalprice > 400000 THEN 'pi' WHEN o_totalprice < 50000 THEN NULL ELSE 'na,ti' END"


@query(
    f"""WITH before AS (SELECT {_KEYS}, {_BEFORE} AS "Voorlopig" FROM orders),
after AS (SELECT {_KEYS}, {_AFTER} AS "Definitief" FROM orders)
SELECT jaar, "Voorlopig", "Definitief", count(*) AS "Aantal"
FROM before JOIN after USING (jaar, o_custkey, o_orderpriority)
WHERE "Voorlopig" IS DISTINCT FROM "Definitief" GROUP BY ALL"""
)
def transitions(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    keys = [f"{ORDER_YEAR} AS jaar", "o_custkey", "o_orderpriority"]
    before = orders.selectExpr(*keys, f"{_BEFORE} AS status")
    after = orders.selectExpr(*keys, f"{_AFTER} AS status")
    return ind.status_changes(
        before, after, ["jaar", "o_custkey", "o_orderpriority"], "status", "jaar"
    )


@query(
    f"""WITH rows AS (
SELECT {_LINE_YEAR} AS jaar, 'deelname' AS bron, {LINE_FUNDED} AS bekostigd FROM lineitem
 WHERE NOT coalesce(list_contains(string_split({LINE_STATUS}, ','), 'mv'), false)
UNION ALL SELECT {ORDER_YEAR}, 'resultaat', o_orderstatus = 'F' FROM orders
 WHERE o_orderpriority NOT LIKE '5%')
SELECT jaar AS "Bekostigingsjaar", bron AS "Bron", count(*) AS "Totaal",
 count(*) FILTER (bekostigd) AS "Bekostigd",
 count(*) FILTER (bekostigd) / count(*) AS "AandeelBekostigd" FROM rows GROUP BY ALL"""
)
def history(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").selectExpr(
        f"{_LINE_YEAR} AS jaar", f"{LINE_STATUS} AS status", f"{LINE_FUNDED} AS bekostigd"
    )
    orders = table(spark, folder, "orders").selectExpr(
        f"{ORDER_YEAR} AS jaar",
        "CASE WHEN o_orderpriority LIKE '5%' THEN 'mv,na' ELSE 'pi' END AS status",
        "o_orderstatus = 'F' AS bekostigd",
    )
    parts = [
        (ind.assessed(lines, "status"), "deelname"),
        (ind.assessed(orders, "status"), "resultaat"),
    ]
    return ind.with_share(ind.totals_per_source(parts, "jaar", "bekostigd"))


# The order of results: a row's place in the sorted result, beside what it is sorted by.
@query(
    f"""WITH {_SQL_FACTS}, {SQL_DIM_STATUS},
codes AS (SELECT unnest(string_split("CodeBekostigingstatus", ',')) AS "Code" FROM base
 WHERE "Beoordeeld" AND NOT "Bekostigingsindicatie"),
counted AS (SELECT "Code", count(*) AS "Aantal" FROM codes JOIN dim_status USING ("Code")
 WHERE NOT "Bekostigd" GROUP BY 1)
SELECT row_number() OVER (ORDER BY "Aantal" DESC, "Code") - 1 AS plaats, "Code", "Aantal"
FROM counted"""
)
def reasons_in_order(spark: SparkSession, folder: str) -> DataFrame:
    return positions(fact_reasons(spark, folder), "plaats").select("plaats", "Code", "Aantal")


@query(
    f"""WITH {_SQL_FACTS},
programmes AS (SELECT "Opleidingscode" AS code, count(*) FILTER ("Bekostigingsindicatie")
 / count(*) AS aandeel FROM base WHERE "Beoordeeld" GROUP BY 1, "Opleidingsniveau")
SELECT row_number() OVER (ORDER BY aandeel) - 1 AS plaats, aandeel AS "AandeelBekostigd"
FROM programmes"""
)
def lowest_share_in_order(spark: SparkSession, folder: str) -> DataFrame:
    """Programmes of one share may change places."""
    found = share_per_group(spark, folder)
    return positions(found, "plaats").select("plaats", "AandeelBekostigd")


@query(
    f"""WITH {_SQL_FACTS},
programmes AS (SELECT "Opleidingscode", "Opleidingsniveau", count(*) AS "Totaal" FROM base
 WHERE "Beoordeeld" GROUP BY 1, 2)
SELECT row_number() OVER (ORDER BY "Opleidingscode" NULLS FIRST) - 1 AS plaats, "Opleidingscode"
FROM programmes"""
)
def programmes_in_order(spark: SparkSession, folder: str) -> DataFrame:
    base = ind.fact_base(_star(spark, folder), "fact_deelname", _CHOSEN)
    return positions(ind.per_programme(base), "plaats").select("plaats", "Opleidingscode")


@query(
    f"""WITH before AS (SELECT {_KEYS}, {_BEFORE} AS "Voorlopig" FROM orders),
after AS (SELECT {_KEYS}, {_AFTER} AS "Definitief" FROM orders),
counted AS (SELECT jaar, count(*) AS "Aantal"
 FROM before JOIN after USING (jaar, o_custkey, o_orderpriority)
 WHERE "Voorlopig" IS DISTINCT FROM "Definitief" GROUP BY jaar, "Voorlopig", "Definitief")
SELECT row_number() OVER (ORDER BY jaar, "Aantal" DESC) - 1 AS plaats, jaar, "Aantal" FROM counted"""
)
def transitions_in_order(spark: SparkSession, folder: str) -> DataFrame:
    """Changes of one year that are equally frequent may change places."""
    return positions(transitions(spark, folder), "plaats").select("plaats", "jaar", "Aantal")


# The flagship: raw lines of a delivery per year, all the way to a share per
# institution and programme.
_INSTITUTION = "CASE WHEN o_custkey % 90 < 60 THEN '10XX' ELSE '71AA' END"
_RAW_STATUS = """CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN ' PI' WHEN '2' THEN 'TI, na'
 WHEN '3' THEN 'mv' WHEN '4' THEN 'zz' ELSE '' END"""
_RAW_LINE = f"""'BRD||' || o_custkey || '|' || {_INSTITUTION} || '|I' || o_orderkey || '|'
 || CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'J' ELSE 'N' END || '|' || {_RAW_STATUS}
 || '|LAAG|34' || o_orderstatus || '|HBO-BA|B|' || replace(CAST({ORDER_DATE} AS STRING), '-', '')"""


@query(
    f"""WITH o AS (SELECT '34' || o_orderstatus AS code,
 CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'pi' WHEN '2' THEN 'na,ti' WHEN '3' THEN 'mv'
  WHEN '4' THEN 'zz' END AS status, o_orderpriority LIKE '1%' AS funded
 FROM orders WHERE {_INSTITUTION} = '10XX' AND {KIND} = 'VLPBEK')
SELECT code AS "Opleidingscode", 'HBO-BA' AS "Opleidingsniveau", count(*) AS "Totaal",
 count(*) FILTER (funded) AS "Bekostigd", count(*) FILTER (funded) / count(*) AS "AandeelBekostigd"
FROM o WHERE coalesce(status, '') <> 'mv' GROUP BY 1"""
)
def raw_lines_to_share(spark: SparkSession, folder: str) -> DataFrame:
    """Split, decode, build facts and dimensions, and answer a question on them."""
    lines = table(spark, folder, "orders").selectExpr(
        f"{KIND} || '_' || {ORDER_YEAR} AS levering",
        "o_orderkey + 1 AS _regelnr",
        "o_orderkey AS _rijnr",
        f"{_RAW_LINE} AS value",
    )
    keep = ("levering", "_regelnr", "_rijnr")
    record = load_layout("analyse")["BRD"]
    typed = decode(split_records(lines, {"BRD": record}, keep=keep)["BRD"], record, keep)
    stage = Stage(spark)
    labels = lines.select("levering").distinct()
    delivery = labels.selectExpr(
        "levering",
        "substr(levering, 1, 6) AS SoortLevering",
        "CAST(substr(levering, 8, 4) AS BIGINT) AS Bekostigingsjaar",
        "make_date(CAST(substr(levering, 8, 4) AS INT), 1, 15) AS DatumAanmaak",
        "'10XX' AS BrinOntvanger",
        "levering AS Bestandsnaam",
        "CAST(NULL AS STRING) AS Sha256",
        "true AS Gepseudonimiseerd",
    )
    # Prepared tables are written once, as the job does: what follows reads columns.
    tables = {"LEVERING": stage.write(delivery, "LEVERING"), "BRD": stage.write(typed, "BRD")}
    specs = s.table_specs()
    deliveries = s.table_of_records(spark, tables, specs["dim_levering"])
    enrolments = s.table_of_records(spark, tables, specs["fact_deelname"], deliveries)
    sources = [(enrolments, "BRIN"), (deliveries, "BrinOntvanger")]
    institutions = s.dim_institution(sources, deliveries.select("BrinOntvanger"))
    star = {
        "dim_levering": deliveries,
        "dim_instelling": stage.write(institutions, "dim_instelling"),
        "dim_opleiding": stage.write(s.dim_programme(spark, tables, deliveries), "dim_opleiding"),
        "fact_deelname": enrolments,
    }
    chosen = ind.current_deliveries(star, ind.PROVISIONAL)
    return ind.per_programme(ind.fact_base(star, "fact_deelname", chosen))
