"""Names, lines, records, decoding, pseudonyms and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundmart.functions import decode as d
from fundmart.functions.pseudonym import BLOCK, pseudonymise as hide
from fundmart.functions.text import normalise_codes
from fundmart.layouts import parse_layout
from fundmart.operators.merge import stack_tables
from fundmart.plans.delivery_checks import reading
from fundmart.session import shared_folder
from fundmart.sinks import write_table
from fundmart.sources.files import checksum, delivery_files, mark_duplicates, overview, with_guard
from fundmart.sources.lines import numbered_text_lines
from fundmart.sources.names import is_csv, with_name_parts
from fundmart.sources.records import reader_messages as messages_of
from fundmart.sources.records import split_records as split_by_layout
from workload.registry import KIND, ORDER_DATE, ORDER_YEAR, query, table

# File names per order: lower case, a tolerated space, a bad date, a second
# download and an unknown kind all occur.
_PREFIX = """CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'VLPBEK_' WHEN '2' THEN 'DEFBEK_ '
 WHEN '3' THEN 'hisbek_' WHEN '4' THEN 'XXXBEK_' ELSE 'VLPBEK_' END"""
_DAY = f"""CASE o_orderstatus WHEN 'P' THEN {ORDER_YEAR} || '0230'
 ELSE replace(CAST({ORDER_DATE} AS STRING), '-', '') END"""
_TAIL = """CASE substr(o_orderpriority, 1, 1) WHEN '5' THEN ' (1)' ELSE '' END
 || CASE o_orderstatus WHEN 'O' THEN '.CSV' ELSE '.csv' END"""
_NAME = f"""{_PREFIX} || {ORDER_YEAR} || '_' || {_DAY} || '_'
 || lpad(CAST(o_custkey % 90 + 10 AS STRING), 2, '0') || 'xx' || {_TAIL}"""
_SQL_PATTERN = r"^(VLPBEK|DEFBEK|HISBEK)_ ?(\d{4})_(\d{8})_(\d{2}[A-Z]{2})$"
_SQL_NAMES = f"""
 named AS (SELECT o_orderkey, {_NAME} AS naam FROM orders),
 parts AS (SELECT *, upper(regexp_replace(naam, '\\.[^.]*$', '')) AS stam FROM named),
 checked AS (SELECT *, regexp_matches(stam, '{_SQL_PATTERN}')
   AND try_strptime(regexp_extract(stam, '{_SQL_PATTERN}', 3), '%Y%m%d') IS NOT NULL AS bekend
   FROM parts)"""


@query(
    f"""WITH {_SQL_NAMES}
SELECT o_orderkey, naam, NOT bekend AS onherkend,
 CASE WHEN bekend THEN regexp_extract(stam, '{_SQL_PATTERN}', 1) END AS "Soort",
 CASE WHEN bekend THEN CAST(regexp_extract(stam, '{_SQL_PATTERN}', 2) AS BIGINT) END
   AS "Bekostigingsjaar",
 CASE WHEN bekend THEN CAST(try_strptime(regexp_extract(stam, '{_SQL_PATTERN}', 3), '%Y%m%d')
   AS DATE) END AS "Aangemaakt",
 CASE WHEN bekend THEN regexp_extract(stam, '{_SQL_PATTERN}', 4) END AS "BRIN"
FROM checked"""
)
def parse_delivery_names(spark: SparkSession, folder: str) -> DataFrame:
    names = table(spark, folder, "orders").selectExpr("o_orderkey", f"{_NAME} AS naam")
    unknown = F.col("Soort").isNull() & is_csv(F.col("naam"))
    return with_name_parts(names, "naam").withColumn("onherkend", unknown)


@query(
    f"""WITH {_SQL_NAMES}
SELECT naam AS "Bestand", regexp_extract(stam, '{_SQL_PATTERN}', 1) AS "Soort",
 CAST(regexp_extract(stam, '{_SQL_PATTERN}', 2) AS BIGINT) AS "Bekostigingsjaar",
 strftime(try_strptime(regexp_extract(stam, '{_SQL_PATTERN}', 3), '%Y%m%d'), '%Y-%m-%d')
   AS "Aangemaakt",
 regexp_extract(stam, '{_SQL_PATTERN}', 4) AS "BRIN"
FROM checked WHERE bekend"""
)
def file_overview(spark: SparkSession, folder: str) -> DataFrame:
    names = table(spark, folder, "orders").selectExpr(f"{_NAME} AS Bestandsnaam")
    return overview(delivery_files(names))


_COPY_NAME = f"""CASE o_orderstatus WHEN 'F' THEN lower({KIND}) ELSE {KIND} END || '_' || {ORDER_YEAR}
 || '_' || replace(CAST({ORDER_DATE} AS STRING), '-', '') || '_10XX.csv'"""
_COPY_PATH = f"'raw/' || o_custkey || '/' || o_orderkey || '/' || {_COPY_NAME}"


@query(
    f"""WITH paths AS (SELECT o_orderkey, {_COPY_NAME} AS naam, {_COPY_PATH} AS pad FROM orders),
firsts AS (SELECT upper(naam) AS stam, arg_min(pad, string_split(pad, '/')) AS eerste
 FROM paths GROUP BY 1)
SELECT o_orderkey, naam, pad, eerste AS "Eerste", pad <> eerste AS "Dubbel"
FROM paths JOIN firsts ON upper(naam) = stam"""
)
def dedupe_deliveries(spark: SparkSession, folder: str) -> DataFrame:
    paths = table(spark, folder, "orders").selectExpr(
        "o_orderkey", f"{_COPY_NAME} AS naam", f"{_COPY_PATH} AS pad"
    )
    return mark_duplicates(paths, "naam", "pad")


# Lines of two record types: short, exact and long rows, and unknown types.
_ORDER_LINE = f"""CASE substr(o_orderpriority, 1, 1) WHEN '4' THEN 'XYZ' WHEN '5' THEN 'ord' ELSE 'ORD'
 END || '|' || o_orderkey || '|' || o_custkey
 || CASE o_orderstatus WHEN 'F' THEN '' WHEN 'O' THEN '|' || {ORDER_DATE} || '|O||'
 ELSE '|' || {ORDER_DATE} || '|P|extra| |meer' END"""
_CUSTOMER_LINE = "'CUS|' || c_custkey || '|' || c_name || '|' || c_mktsegment || '|x'"
_LINE_LAYOUT = parse_layout("""
ORD
  Recordsoort text required
  sleutel int required
  klant int
  datum date
  status text
CUS
  Recordsoort text required
  sleutel int required
  naam text
  segment text
""")


def _order_lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr("o_orderkey", f"{_ORDER_LINE} AS value")


@query(
    f"""WITH lines AS (SELECT {_ORDER_LINE} AS v FROM orders
 UNION ALL SELECT {_CUSTOMER_LINE} FROM customer),
parts AS (SELECT string_split(v, '|') AS p FROM lines)
SELECT p[1] AS "Recordsoort", coalesce(p[2], '') AS sleutel, coalesce(p[3], '') AS klant,
 coalesce(p[4], '') AS datum, coalesce(p[5], '') AS status,
 CAST(NULL AS VARCHAR) AS naam, CAST(NULL AS VARCHAR) AS segment FROM parts WHERE p[1] = 'ORD'
UNION ALL
SELECT p[1], coalesce(p[2], ''), NULL, NULL, NULL, coalesce(p[3], ''), coalesce(p[4], '')
FROM parts WHERE p[1] = 'CUS'"""
)
def split_records(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").selectExpr(f"{_CUSTOMER_LINE} AS value")
    lines = _order_lines(spark, folder).select("value").unionByName(customers)
    return stack_tables(list(split_by_layout(lines, _LINE_LAYOUT).values()))


@query(
    f"""WITH lines AS (SELECT o_orderkey, string_split({_ORDER_LINE}, '|') AS p FROM orders),
judged AS (SELECT o_orderkey, p[1] AS rs,
 CASE WHEN p[1] = 'ORD' THEN len(list_filter(p[6:], lambda x: trim(x) <> '')) END AS extra
 FROM lines),
messages AS (SELECT rs, CASE WHEN extra IS NULL THEN 'Onbekende recordsoort'
 ELSE extra || ' meer gevulde velden dan het schema (5)' END AS tekst
 FROM judged WHERE extra IS NULL OR extra > 0)
SELECT 'orders' AS levering, 'Inlezen' AS "Controle", rs AS "Recordsoort", tekst AS "Melding",
 count(*) AS "Aantal", 'error' AS "Ernst" FROM messages GROUP BY rs, tekst"""
)
def reader_messages(spark: SparkSession, folder: str) -> DataFrame:
    found = messages_of(_order_lines(spark, folder), _LINE_LAYOUT, keep=("o_orderkey",))
    return reading(
        found.withColumnRenamed("o_orderkey", "Regelnummer").withColumn("levering", F.lit("orders"))
    ).drop("_orde")


_SQL_LINE_END = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x{85}\\x{2028}\\x{2029}]"
_SQL_BLANK = (
    "[\\t\\n\\x0b\\f\\r \\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
    "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]*"
)


@query(
    f"""WITH lines AS (SELECT doc_id, regexp_split_to_array(text, '{_SQL_LINE_END}') AS l
 FROM documents),
numbered AS (SELECT doc_id, unnest(l) AS regel, CAST(generate_subscripts(l, 1) AS BIGINT) AS regelnr
 FROM lines)
SELECT doc_id, regelnr, regel FROM numbered WHERE NOT regexp_full_match(regel, '{_SQL_BLANK}')"""
)
def document_lines(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return numbered_text_lines(documents, ["doc_id"], "text", "regelnr", "regel")


_DATE_TEXT = f"""CASE o_orderstatus WHEN 'F' THEN replace(CAST({ORDER_DATE} AS STRING), '-', '')
 WHEN 'O' THEN CASE WHEN o_custkey < 100 THEN '  ' ELSE CAST({ORDER_DATE} AS STRING) END
 ELSE {ORDER_YEAR} || '0230' END"""


@query(
    f"""WITH t AS (SELECT o_orderkey, nullif(trim({_DATE_TEXT}), '') AS x FROM orders)
SELECT o_orderkey, CAST(try_strptime(x, '%Y%m%d') AS DATE) AS datum,
 CASE WHEN try_strptime(x, '%Y%m%d') IS NULL THEN x END AS "datum_Ruw" FROM t"""
)
def decode_dates_raw(spark: SparkSession, folder: str) -> DataFrame:
    layout = parse_layout("ORD\n  datum date\n")
    text = table(spark, folder, "orders").selectExpr("o_orderkey", f"{_DATE_TEXT} AS datum")
    return d.decode(text, layout["ORD"], keep=("o_orderkey",))


_BOOL_TEXT = "CASE l_returnflag WHEN 'A' THEN 'J' WHEN 'N' THEN ' N ' ELSE 'x' END"
_INT_TEXT = """CASE l_linestatus WHEN 'O' THEN CAST(CAST(l_quantity AS INTEGER) AS STRING)
 ELSE CAST(l_quantity AS STRING) END"""
_FLOAT_TEXT = """CASE l_returnflag WHEN 'A' THEN replace(CAST(l_discount AS STRING), '.', ',')
 WHEN 'N' THEN CAST(l_discount AS STRING) WHEN 'R' THEN CASE l_linestatus WHEN 'O'
 THEN CAST(l_discount AS STRING) || 'd' ELSE '1,' || CAST(l_tax AS STRING) END END"""


@query(
    f"""WITH t AS (SELECT l_orderkey, l_linenumber, trim({_BOOL_TEXT}) AS b, {_INT_TEXT} AS i,
 regexp_replace({_FLOAT_TEXT}, ',', '.') AS f FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE b WHEN 'J' THEN true WHEN 'N' THEN false END AS vlag,
 CASE WHEN regexp_full_match(i, '[+-]?\\d+') THEN try_cast(i AS BIGINT) END AS aantal,
 CASE WHEN regexp_full_match(f, '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?')
   THEN try_cast(f AS DOUBLE) END AS factor FROM t"""
)
def decode_bool_int_float(spark: SparkSession, folder: str) -> DataFrame:
    layout = parse_layout("REG\n  vlag bool\n  aantal int\n  factor float\n")
    text = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        f"{_BOOL_TEXT} AS vlag",
        f"{_INT_TEXT} AS aantal",
        f"{_FLOAT_TEXT} AS factor",
    )
    return d.decode_tables({"REG": text}, layout, ("l_orderkey", "l_linenumber"))["REG"]


_NA_TEXT = """CASE WHEN p_size < 10 THEN '-1' WHEN p_size > 45 THEN ' '
 ELSE CAST(p_size AS STRING) END"""


@query(
    f"""WITH t AS (SELECT p_partkey, nullif(trim({_NA_TEXT}), '') AS x FROM part)
SELECT p_partkey, CAST(nullif(x, '-1') AS BIGINT) AS teller,
 coalesce(x = '-1', false) AS "teller_NVT" FROM t"""
)
def decode_not_applicable(spark: SparkSession, folder: str) -> DataFrame:
    layout = parse_layout("PRT\n  teller int na\n")
    text = table(spark, folder, "part").selectExpr("p_partkey", f"{_NA_TEXT} AS teller")
    return d.decode(text, layout["PRT"], keep=("p_partkey",))


_STATUS_TEXT = """CASE l_returnflag WHEN 'A' THEN ' TI, na' WHEN 'N' THEN 'na,,Na ' ELSE ' ' END
 || CASE l_linestatus WHEN 'O' THEN ',mv' ELSE ' , ' END
 || CASE WHEN l_quantity > 40 THEN ', Ex' ELSE '' END"""


@query(
    f"""WITH t AS (SELECT l_orderkey, l_linenumber,
 list_sort(list_filter(string_split(replace(lower({_STATUS_TEXT}), ' ', ''), ','),
 lambda x: x <> '')) AS c FROM lineitem)
SELECT l_orderkey, l_linenumber, nullif(array_to_string(c, ','), '') AS status FROM t"""
)
def normalise_status(spark: SparkSession, folder: str) -> DataFrame:
    text = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", f"{_STATUS_TEXT} AS status"
    )
    return text.withColumn("status", normalise_codes(F.col("status")))


_TEST_KEY = b"fixed key for the registered query, never used for real person numbers"[:BLOCK]
_PADS = [bytes(b ^ pad for b in _TEST_KEY.ljust(BLOCK, b"\0")).hex() for pad in (0x36, 0x5C)]


def _sql_pseudonym(value: str) -> str:
    inner = f"sha256(unhex('{_PADS[0]}') || encode({value}))"
    return f"CASE WHEN {value} IS NOT NULL THEN sha256(unhex('{_PADS[1]}') || unhex({inner})) END"


@query(
    f"""WITH t AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS bsn,
 CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS onr
 FROM customer)
SELECT c_custkey, {_sql_pseudonym("bsn")} AS "Burgerservicenummer",
 {_sql_pseudonym("onr")} AS "Onderwijsnummer" FROM t"""
)
def pseudonymise(spark: SparkSession, folder: str) -> DataFrame:
    people = table(spark, folder, "customer").selectExpr(
        "c_custkey",
        "CASE WHEN c_acctbal < 0 THEN '' ELSE c_name END AS Burgerservicenummer",
        "CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE CAST(c_custkey AS STRING) END"
        " AS Onderwijsnummer",
    )
    return hide(people, _TEST_KEY)


@query("SELECT doc_id, sha256(text) AS sha256 FROM documents")
def checksum_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", checksum(F.col("text")).alias("sha256"))


_GUARDED = "50XX"
_HEADER_LINE = """CASE o_orderstatus WHEN 'P' THEN 'XXX' ELSE 'VLP' END
 || '|' || CASE WHEN o_custkey % 90 + 10 = 50 AND o_orderstatus = 'O' THEN '99XX'
 ELSE lpad(CAST(o_custkey % 90 + 10 AS STRING), 2, '0') || 'XX' END || '|' || o_orderkey"""
_PLAIN_NAME = f"""{KIND} || '_' || {ORDER_YEAR} || '_' || replace(CAST({ORDER_DATE} AS STRING), '-', '')
 || '_' || lpad(CAST(o_custkey % 90 + 10 AS STRING), 2, '0') || 'XX.csv'"""


@query(
    f"""WITH t AS (SELECT o_orderkey, {_PLAIN_NAME} AS naam, string_split({_HEADER_LINE}, '|') AS p
 FROM orders)
SELECT o_orderkey, naam, (naam LIKE '%\\_{_GUARDED}.csv' ESCAPE '\\' AND p[1] = 'VLP'
 AND p[2] = '{_GUARDED}') AS synthetic FROM t"""
)
def guarded_files(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    files = orders.selectExpr("o_orderkey AS uri", f"{_PLAIN_NAME} AS Bestandsnaam")
    first = orders.selectExpr("o_orderkey AS uri", f"{_HEADER_LINE} AS value")
    return with_guard(delivery_files(files), first, _GUARDED).select(
        F.col("uri").alias("o_orderkey"), F.col("Bestandsnaam").alias("naam"), "synthetic"
    )


@query(
    """SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS datum,
 'VLPBEK_' || CAST(year(o_orderdate) AS BIGINT) AS levering FROM orders"""
)
def sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").selectExpr(
        "o_orderkey",
        "o_orderstatus",
        f"{ORDER_DATE} AS datum",
        f"'VLPBEK_' || {ORDER_YEAR} AS levering",
    )
    path = f"{shared_folder(spark)}/roundtrip-{uuid.uuid4().hex}"
    write_table(rows, path, by="levering")
    return spark.read.schema(rows.schema).parquet(path)
