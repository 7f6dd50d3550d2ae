"""Delivery checks, contracts, statuses, coverage and the report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundmart.functions.decode import typed
from fundmart.layouts import load_layout
from fundmart.operators import checks
from fundmart.operators.merge import missing_keys, stack_tables
from fundmart.plans import contracts as c
from fundmart.plans.delivery_checks import check_deliveries, first_row, with_source
from fundmart.plans.report import coverage as covered_rows
from fundmart.plans.report import message_items, message_totals, source_statuses
from fundmart.session import Stage
from workload.registry import KIND, LINE_STATUS, ORDER_LABEL, ORDER_YEAR, query, table

# Orders as enrolment records of a delivery per year: missing values, unknown
# codes and unreadable dates occur.
_ENROLMENT = {
    "BRIN": "lpad(CAST(o_custkey % 90 + 10 AS STRING), 2, '0') || 'XX'",
    "Inschrijvingvolgnummer": "'I' || o_orderkey",
    "Bekostigingsindicatie": "CASE o_orderstatus WHEN 'F' THEN 'J' WHEN 'O' THEN 'N' ELSE '' END",
    "CodeBekostigingstatus": """CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'pi'
 WHEN '2' THEN ' TI, na' WHEN '3' THEN 'zz' WHEN '4' THEN 'na,qq' ELSE ' ' END""",
    "Opleidingscode": "CASE WHEN o_totalprice < 50000 THEN '' ELSE '34' || o_custkey END",
    "Opleidingsniveau": "CASE o_orderstatus WHEN 'F' THEN 'HBO-BA' WHEN 'O' THEN 'WO-MA' ELSE 'MBO' END",
    "Opleidingsfase": "'B'",
    "DatumInschrijving": "CASE o_orderstatus WHEN 'P' THEN '19960230' ELSE '19960901' END",
    "DatumUitschrijving": "'19970831'",
    "EersteInschrijving": "'J'",
    "Inschrijvingsvorm": "'S'",
    "Onderwijsvorm": "CASE WHEN o_custkey < 200 THEN 'AV' ELSE 'VT' END",
    "DatumEersteAanlevering": "'19960915'",
}
_HEADER_BRIN = f"CASE WHEN {ORDER_YEAR} = 1996 THEN '11XX' ELSE '10XX' END"
_HEADER_YEAR = f"CASE WHEN {ORDER_YEAR} = 1998 THEN '1997' ELSE CAST({ORDER_YEAR} AS STRING) END"


def _record(df: DataFrame, rs: str, fields: dict[str, str]) -> DataFrame:
    record = load_layout("analyse")[rs]
    text = df.selectExpr(
        "levering", "_regelnr", "_rijnr", *[f"{x} AS {name}" for name, x in fields.items()]
    )

    def text_of(_: int, field):
        if field.name == "Recordsoort":
            return F.lit(rs)
        return F.col(field.name) if field.name in fields else F.lit("")

    return typed(record, text, text_of, ("levering", "_regelnr", "_rijnr"))


def _funding_tables(spark: SparkSession, folder: str):
    orders = table(spark, folder, "orders").selectExpr(
        "*", f"{ORDER_LABEL} AS levering", f"{ORDER_YEAR} AS jaar",
        "o_orderkey AS _regelnr", "o_orderkey AS _rijnr",
    )
    years = orders.groupBy("levering", "jaar").agg(F.count("*").alias("n")).selectExpr(
        "*", "CAST(1 AS BIGINT) AS _regelnr", "CAST(0 AS BIGINT) AS _rijnr"
    )
    # One row per delivery, read by many checks: written once, as the job does.
    years = Stage(spark).write(years, "years")
    tables = {
        "VLP": _record(
            years,
            "VLP",
            {
                "BRIN": "CASE WHEN jaar = 1996 THEN '11XX' ELSE '10XX' END",
                "Bekostigingsjaar": "CASE WHEN jaar = 1998 THEN 1997 ELSE jaar END",
                "DatumAanmaak": "jaar || '0115'",
            },
        ),
        "BRD": _record(orders, "BRD", _ENROLMENT),
        "SLR": _record(
            years.filter("jaar <> 1997"),
            "SLR",
            {
                "AantalBLBrecords": "CASE WHEN jaar = 1999 THEN 'x' ELSE '0' END",
                "AantalBRDrecords": "CASE WHEN jaar > 1999 THEN n + 1 ELSE n END",
                "AantalBRRrecords": "'0'",
            },
        ),
    }
    reader = orders.filter("o_orderstatus = 'P'").selectExpr(
        "levering", "o_orderkey AS Regelnummer", "'XYZ' AS Recordsoort",
        "'Onbekende recordsoort' AS Melding",
    )
    deliveries = years.selectExpr(
        "levering", "'VLPBEK' AS Soort", "jaar AS Bekostigingsjaar", "'10XX' AS BRIN"
    )
    counts = stack_tables(
        [
            years.selectExpr("levering", "'BRD' AS tabel", "n"),
            years.selectExpr("levering", "'VLP' AS tabel", "CAST(1 AS BIGINT) AS n"),
            years.filter("jaar <> 1997").selectExpr(
                "levering", "'SLR' AS tabel", "CASE WHEN jaar = 1995 THEN 2 ELSE 1 END AS n"
            ),
        ]
    )
    return tables, reader, deliveries, counts


def _required(field: str, empty: str) -> str:
    return (
        f"SELECT levering, 'Verplicht veld', 'BRD', '{field} is leeg', count(*), 'error' "
        f"FROM o WHERE {empty} GROUP BY levering"
    )


def _unknown(field: str, code: str, when: str) -> str:
    return (
        f"SELECT levering, 'Codelijst', 'BRD', '{field}: onbekende code ''{code}''', count(*), "
        f"'warning' FROM o WHERE {when} GROUP BY levering"
    )


@query(
    f"""WITH o AS (SELECT *, {ORDER_LABEL} AS levering, {ORDER_YEAR} AS jaar FROM orders),
y AS (SELECT levering, jaar, count(*) AS n FROM o GROUP BY ALL),
found AS (
SELECT levering, 'Inlezen' AS "Controle", 'XYZ' AS "Recordsoort",
 'Onbekende recordsoort' AS "Melding", count(*) AS "Aantal", 'error' AS "Ernst"
 FROM o WHERE o_orderstatus = 'P' GROUP BY levering
UNION ALL SELECT levering, 'Aantal records', 'SLR', 'Geen sluitrecord (SLR)', 1, 'error'
 FROM y WHERE jaar = 1997
UNION ALL SELECT levering, 'Aantal records', 'BLB', 'SLR meldt None, gevonden 0', 1, 'error'
 FROM y WHERE jaar = 1999
UNION ALL SELECT levering, 'Aantal records', 'BRD',
 'SLR meldt ' || (n + 1) || ', gevonden ' || n, 1, 'error' FROM y WHERE jaar > 1999
UNION ALL SELECT levering, 'Eén rij', 'SLR', 'Verwacht 1 rij, gevonden 2', 1, 'error'
 FROM y WHERE jaar = 1995
UNION ALL SELECT levering, 'Verplicht veld', 'SLR', 'AantalBLBrecords is leeg', 1, 'error'
 FROM y WHERE jaar = 1999
UNION ALL {_required("Bekostigingsindicatie", "o_orderstatus = 'P'")}
UNION ALL {_required("CodeBekostigingstatus", "o_orderpriority LIKE '5%'")}
UNION ALL {_required("Opleidingscode", "o_totalprice < 50000")}
UNION ALL {_required("DatumInschrijving", "o_orderstatus = 'P'")}
UNION ALL {_unknown("CodeBekostigingstatus", "zz", "o_orderpriority LIKE '3%'")}
UNION ALL {_unknown("CodeBekostigingstatus", "qq", "o_orderpriority LIKE '4%'")}
UNION ALL {_unknown("Opleidingsniveau", "MBO", "o_orderstatus = 'P'")}
UNION ALL {_unknown("Onderwijsvorm", "AV", "o_custkey < 200")}
UNION ALL SELECT levering, 'BRIN', 'VLP',
 'BRIN in bestandsnaam (10XX) wijkt af van VLP (11XX)', 1, 'error' FROM y WHERE jaar = 1996
UNION ALL SELECT levering, 'Bekostigingsjaar', 'VLP',
 'Jaar in bestandsnaam (1998) wijkt af van VLP (1997)', 1, 'warning' FROM y WHERE jaar = 1998)
SELECT levering, "Controle", "Recordsoort", "Melding", CAST("Aantal" AS BIGINT) AS "Aantal", "Ernst"
FROM found"""
)
def delivery_checks(spark: SparkSession, folder: str) -> DataFrame:
    return check_deliveries(*_funding_tables(spark, folder)).drop("_orde")


_ORDER_GAPS = [
    "o_orderpriority",
    "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS klant",
    "CASE WHEN o_totalprice < 50000 THEN NULL ELSE o_totalprice END AS bedrag",
    "CASE WHEN o_orderdate < TIMESTAMP '1996-01-01 00:00:00' THEN NULL ELSE o_orderdate END AS datum",
]


@query(
    f"""WITH t AS (SELECT {", ".join(_ORDER_GAPS)} FROM orders),
counts AS (SELECT o_orderpriority AS groep, count(*) FILTER (klant IS NULL) AS klant,
 count(*) FILTER (bedrag IS NULL) AS bedrag, count(*) FILTER (datum IS NULL) AS datum
 FROM t GROUP BY 1),
people AS (SELECT c_mktsegment AS groep, count(*) FILTER (c_acctbal < 0) AS saldo
 FROM customer GROUP BY 1)
SELECT groep, veld, aantal FROM (
 SELECT groep, 'klant' AS veld, klant AS aantal FROM counts
 UNION ALL SELECT groep, 'bedrag', bedrag FROM counts
 UNION ALL SELECT groep, 'datum', datum FROM counts
 UNION ALL SELECT groep, 'saldo', saldo FROM people) WHERE aantal > 0"""
)
def required_nulls(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").selectExpr(*_ORDER_GAPS)
    orders = orders.withColumnRenamed("o_orderpriority", "groep")
    people = table(spark, folder, "customer").selectExpr(
        "c_mktsegment AS groep", "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS saldo"
    )
    return stack_tables(
        [
            checks.empty_counts(orders, ["groep"], ["klant", "bedrag", "datum"]),
            checks.empty_counts(people, ["groep"], ["saldo"]),
        ]
    )


_FLAG_LIST = "CASE WHEN l_quantity > 45 THEN l_returnflag || ',' ELSE l_returnflag END"


@query(
    f"""WITH codes AS (
 SELECT l_linestatus, 'status' AS veld, unnest(string_split({LINE_STATUS}, ',')) AS code
 FROM lineitem
 UNION ALL SELECT l_linestatus, 'vlag', unnest(string_split({_FLAG_LIST}, ',')) FROM lineitem)
SELECT l_linestatus, veld, code, count(*) AS aantal FROM codes
WHERE (veld = 'status' AND code NOT IN ('pi', 'na', 'ti', 'ex'))
 OR (veld = 'vlag' AND code NOT IN ('A', 'N')) GROUP BY ALL"""
)
def unknown_codes(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").selectExpr(
        "l_linestatus", f"{LINE_STATUS} AS status", f"{_FLAG_LIST} AS vlag"
    )
    lists = {"status": ["pi", "na", "ti", "ex"], "vlag": ["A", "N"]}
    return checks.unknown_codes(lines, ["l_linestatus"], lists)


_DECLARED = """o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(1 AS BIGINT) END AS A,
 CASE WHEN o_orderstatus = 'F' THEN CAST(0 AS BIGINT) ELSE CAST(2 AS BIGINT) END AS N,
 CAST(1 AS BIGINT) AS R"""


@query(
    f"""WITH wide AS (SELECT {_DECLARED} FROM orders),
declared AS (SELECT o_orderkey, 'A' AS soort, A AS gemeld FROM wide
 UNION ALL SELECT o_orderkey, 'N', N FROM wide UNION ALL SELECT o_orderkey, 'R', R FROM wide),
counted AS (SELECT l_orderkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT o_orderkey, soort, gemeld, coalesce(n, 0) AS gevonden FROM declared
LEFT JOIN counted ON l_orderkey = o_orderkey AND l_returnflag = soort
WHERE gemeld IS DISTINCT FROM coalesce(n, 0)"""
)
def trailer_counts(spark: SparkSession, folder: str) -> DataFrame:
    wide = table(spark, folder, "orders").selectExpr(*_split(_DECLARED))
    declared = checks.unpivot(wide, ["o_orderkey"], ["A", "N", "R"], "soort", "gemeld")
    counted = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"), F.col("l_returnflag").alias("soort"))
        .agg(F.count("*").alias("gevonden"))
    )
    return checks.trailer_differences(declared, counted, ["o_orderkey"], "soort")


def _split(columns: str) -> list[str]:
    """Top-level columns of a select list (commas inside brackets do not split)."""
    parts, depth, start = [], 0, 0
    for i, char in enumerate(columns):
        depth += (char == "(") - (char == ")")
        if char == "," and depth == 0:
            parts.append(columns[start:i])
            start = i + 1
    return [*parts, columns[start:]]


_HEADER_STATUS = "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END"


@query(
    f"""WITH o AS (SELECT o_orderkey, o_custkey, {_HEADER_STATUS} AS status FROM orders),
firsts AS (SELECT o_custkey, first(status ORDER BY o_orderkey) AS eerste FROM o GROUP BY 1)
SELECT o_orderkey, o_custkey, status, eerste FROM o JOIN firsts USING (o_custkey)
WHERE status IS DISTINCT FROM eerste"""
)
def header_mismatch(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").selectExpr(
        "o_orderkey", "o_custkey", f"{_HEADER_STATUS} AS status"
    )
    first = first_row(orders, ["o_custkey"], ["status"], "o_orderkey")
    both = orders.join(first.withColumnRenamed("status", "eerste"), "o_custkey")
    return both.filter(~F.col("status").eqNullSafe(F.col("eerste")))


@query(
    """SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS aantal FROM (
 SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"""
)
def grain_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return checks.duplicate_rows(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    f"""WITH t AS (SELECT {", ".join(_ORDER_GAPS[1:])} FROM orders)
SELECT veld, aantal FROM (
 SELECT 'klant' AS veld, count(*) FILTER (klant IS NULL) AS aantal FROM t
 UNION ALL SELECT 'bedrag', count(*) FILTER (bedrag IS NULL) FROM t
 UNION ALL SELECT 'datum', count(*) FILTER (datum IS NULL) FROM t) WHERE aantal > 0"""
)
def empty_keys(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").selectExpr(*_ORDER_GAPS[1:])
    return checks.empty_counts(orders, [], ["klant", "bedrag", "datum"])


@query(
    """SELECT 'orders' AS koppeling, count(*) AS aantal FROM lineitem WHERE NOT EXISTS
 (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')
UNION ALL SELECT 'part / supplier', count(*) FROM lineitem WHERE NOT EXISTS
 (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size < 40) AND NOT EXISTS
 (SELECT 1 FROM supplier WHERE s_suppkey = l_partkey)"""
)
def orphan_links(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders").filter("o_orderstatus <> 'P'")
    parts = table(spark, folder, "part").filter("p_size < 40").selectExpr("p_partkey AS l_partkey")
    suppliers = table(spark, folder, "supplier").selectExpr("s_suppkey AS l_partkey")
    by_order = checks.orphan_rows(
        lines, "l_orderkey", [orders.selectExpr("o_orderkey AS l_orderkey")]
    )
    by_part = checks.orphan_rows(lines, "l_partkey", [parts, suppliers])
    return stack_tables(
        [
            by_order.select(F.lit("orders").alias("koppeling"), "aantal"),
            by_part.select(F.lit("part / supplier").alias("koppeling"), "aantal"),
        ]
    )


_CONTRACTS = c.Contracts(
    grain={"klant": ["klantnr"], "bestelling": ["bestelnr"], "regel": ["bestelnr", "regelnr"]},
    links=(
        c.Link("bestelling", "klantnr", ("klant",)),
        c.Link("regel", "bestelnr", ("bestelling",)),
    ),
)


def _contract_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "klant": table(spark, folder, "customer").filter("c_acctbal >= 0").selectExpr(
            "c_custkey AS klantnr"
        ),
        "bestelling": table(spark, folder, "orders").selectExpr(
            "o_orderkey AS bestelnr",
            "CASE WHEN o_totalprice < 50000 THEN NULL ELSE o_custkey END AS klantnr",
        ),
        "regel": table(spark, folder, "lineitem").selectExpr(
            "l_orderkey AS bestelnr", "l_linenumber AS regelnr"
        ),
    }


_SQL_CONTRACTS = """klant AS (SELECT c_custkey AS klantnr FROM customer WHERE c_acctbal >= 0),
bestelling AS (SELECT o_orderkey AS bestelnr,
 CASE WHEN o_totalprice < 50000 THEN NULL ELSE o_custkey END AS klantnr FROM orders),
double AS (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS n FROM (SELECT count(*) AS n
 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)),
leeg AS (SELECT count(*) AS n FROM bestelling WHERE klantnr IS NULL),
wees AS (SELECT count(*) AS n FROM bestelling WHERE klantnr IS NOT NULL
 AND klantnr NOT IN (SELECT klantnr FROM klant)),
found AS (
SELECT 'star schema' AS "Bron", 'Uniciteit' AS "Controle", 'regel' AS "Recordsoort",
 n || ' rijen met een dubbele sleutel (bestelnr, regelnr)' AS "Melding", n AS "Aantal",
 'error' AS "Ernst" FROM double WHERE n > 0
UNION ALL SELECT 'star schema', 'Lege sleutel', 'bestelling', 'klantnr is leeg', n, 'error'
 FROM leeg WHERE n > 0
UNION ALL SELECT 'star schema', 'Koppeling', 'bestelling',
 n || ' waarden van klantnr ontbreken in klant', n, 'error' FROM wees WHERE n > 0)"""


@query(f"WITH {_SQL_CONTRACTS} SELECT * FROM found")
def contract_report(spark: SparkSession, folder: str) -> DataFrame:
    found = c.check_tables(_contract_tables(spark, folder), _CONTRACTS)
    return with_source(found, "star schema")


# A message row per order: the source is a customer group, the severity a status.
_MESSAGE = f"""{KIND} || '_' || {ORDER_YEAR} AS "Bron", o_orderpriority AS "Controle",
 o_orderstatus AS "Recordsoort", CASE o_orderstatus WHEN 'P' THEN 'error' WHEN 'O' THEN 'warning'
 ELSE NULL END AS "Ernst", o_totalprice"""


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    """Counted messages; rows without a severity come from an outdated folder."""
    rows = table(spark, folder, "orders").selectExpr(*[x.replace('"', "`") for x in _split(_MESSAGE)])
    return (
        rows.filter(F.col("Ernst").isNotNull())
        .groupBy("Bron", "Controle", "Recordsoort", "Ernst")
        .agg(F.count("*").alias("Aantal"))
        .withColumn("Melding", F.concat_ws(" ", "Controle", "Recordsoort"))
    )


_SQL_MESSAGES = f"""m AS (SELECT "Bron", "Controle", "Recordsoort", "Ernst", count(*) AS "Aantal",
 "Controle" || ' ' || "Recordsoort" AS "Melding"
 FROM (SELECT {_MESSAGE} FROM orders) WHERE "Ernst" IS NOT NULL
 GROUP BY "Bron", "Controle", "Recordsoort", "Ernst")"""


@query(
    """WITH o AS (SELECT o_custkey, CASE WHEN o_totalprice > 450000 THEN 2
 WHEN o_totalprice > 300000 THEN 1 ELSE 0 END AS rang FROM orders)
SELECT o_custkey, CASE max(rang) WHEN 2 THEN 'fail' WHEN 1 THEN 'warn' ELSE 'ok' END AS status,
 count(*) FILTER (rang = 2) AS fouten FROM o GROUP BY 1"""
)
def message_status(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").selectExpr(
        "o_custkey",
        "CASE WHEN o_totalprice > 450000 THEN 'error' WHEN o_totalprice > 300000 THEN 'warning' END"
        " AS Ernst",
    )
    return rows.groupBy("o_custkey").agg(
        checks.status_of(F.col("Ernst")).alias("status"),
        F.count_if(F.col("Ernst") == "error").alias("fouten"),
    )


@query(
    f"""WITH {_SQL_MESSAGES}
SELECT count(*) AS messages, count(*) FILTER ("Ernst" = 'error') AS total_errors,
 count(*) FILTER ("Ernst" = 'warning') AS total_warnings,
 CASE WHEN count(*) FILTER ("Ernst" = 'error') > 0 THEN 'fail'
 WHEN count(*) > 0 THEN 'warn' ELSE 'ok' END AS status FROM m"""
)
def gate(spark: SparkSession, folder: str) -> DataFrame:
    return message_totals(_messages(spark, folder))


@query(
    f"""WITH {_SQL_MESSAGES},
s AS (SELECT "Bron", CASE WHEN max("Ernst" = 'error') THEN 'fail' ELSE 'warn' END AS status
 FROM m GROUP BY 1)
SELECT "Bron", status, "Controle" AS controle, "Recordsoort" AS recordsoort, "Melding" AS melding,
 "Aantal" AS aantal, "Ernst" AS ernst FROM m JOIN s USING ("Bron")"""
)
def report_json(spark: SparkSession, folder: str) -> DataFrame:
    """The report's messages, through JSON text and back, with their source's status."""
    messages = _messages(spark, folder)
    schema = "controle string, recordsoort string, melding string, aantal bigint, ernst string"
    items = message_items(messages).select("Bron", F.from_json("item", schema).alias("m"))
    return items.join(source_statuses(messages), "Bron").select("Bron", "status", "m.*")


_EXPECTED = [("VLPBEK", "F"), ("VLPBEK", "O"), ("DEFBEK", "P"), ("DEFBEK", "Z"), ("HISBEK", "O")]
_COVER_LABEL = f"{KIND} || '_' || {ORDER_YEAR} || '_' || CAST(o_custkey AS STRING)"


@query(
    f"""WITH o AS (SELECT {_COVER_LABEL} AS levering, {KIND} AS soort,
 CASE WHEN o_totalprice < 250000 THEN 'F' ELSE o_orderstatus END AS recordsoort FROM orders),
labels AS (SELECT DISTINCT levering, soort FROM o),
expected(soort, recordsoort) AS (VALUES {", ".join(f"('{k}', '{r}')" for k, r in _EXPECTED)}),
n AS (SELECT levering, recordsoort, count(*) AS n FROM o GROUP BY ALL)
SELECT l.levering, e.recordsoort, coalesce(n.n, 0) AS rijen FROM labels l
JOIN expected e USING (soort) LEFT JOIN n ON n.levering = l.levering AND n.recordsoort = e.recordsoort"""
)
def coverage(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").selectExpr(
        f"{_COVER_LABEL} AS levering",
        f"{KIND} AS soort",
        "CASE WHEN o_totalprice < 250000 THEN 'F' ELSE o_orderstatus END AS recordsoort",
    )
    expected = spark.createDataFrame(_EXPECTED, "soort string, recordsoort string")
    labels = rows.select("levering", "soort").distinct()
    counts = rows.groupBy("levering", "recordsoort").agg(F.count("*").alias("n"))
    return covered_rows(labels, "soort", expected, counts)


@query(
    """SELECT c_nationkey, count(DISTINCT CASE WHEN c_acctbal < 0 THEN NULL
 ELSE c_mktsegment = 'BUILDING' END) > 1 AS gemengd FROM customer GROUP BY 1"""
)
def mixed_flag_guard(spark: SparkSession, folder: str) -> DataFrame:
    flags = table(spark, folder, "customer").selectExpr(
        "c_nationkey",
        "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment = 'BUILDING' END AS vlag",
    )
    return flags.groupBy("c_nationkey").agg(checks.is_mixed("vlag").alias("gemengd"))


_DAY_LABEL = f"{KIND} || '_' || CAST(CAST(o_orderdate AS DATE) AS STRING)"


@query(
    f"""SELECT {_DAY_LABEL} AS levering, count(*) AS aantal FROM orders
GROUP BY 1 HAVING count(*) > 1"""
)
def duplicate_labels(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "orders").selectExpr(f"{_DAY_LABEL} AS levering")
    return checks.duplicate_keys(labels, ["levering"])


@query(
    f"""SELECT DISTINCT {_DAY_LABEL} AS levering FROM orders WHERE o_orderstatus = 'P'
EXCEPT SELECT {_DAY_LABEL} FROM orders WHERE o_orderstatus = 'F'"""
)
def label_difference(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").selectExpr("o_orderstatus", f"{_DAY_LABEL} AS levering")
    return missing_keys(
        orders.filter("o_orderstatus = 'P'"), orders.filter("o_orderstatus = 'F'"), "levering"
    )
