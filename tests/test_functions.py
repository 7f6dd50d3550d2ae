import datetime
import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from fundmart.functions import decode as d
from fundmart.functions import pseudonym as p
from fundmart.functions import text as t
from fundmart.layouts import parse_layout

from .conftest import TEST_KEY, rows


def _one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "raw,expected",
    [("  a b ", "a b"), (" \t x ", "x"), ("   ", None), ("", None), (None, None), (" y　", "y")],
)
def test_clean(spark, raw, expected):
    assert _one(spark, raw, t.clean) == expected


@pytest.mark.parametrize(
    "raw,expected",
    [(" TI, na", "na,ti"), ("na,na", "na,na"), (",,", None), ("pi", "pi"), ("n a , b", "b,na"), (None, None)],
)
def test_normalise_codes(spark, raw, expected):
    assert _one(spark, raw, t.normalise_codes) == expected


@pytest.mark.parametrize(
    "raw,expected",
    [
        ("60.5", 60.5), ("60,5", 60.5), ("1,234,5", None), ("1.0d", None), ("1f", None), ("1e3", 1000.0),
        (".5", 0.5), ("5.", 5.0), ("abc", None), ("-inf", float("-inf")), (None, None),
    ],
)
def test_to_double(spark, raw, expected):
    assert _one(spark, raw, d.to_double) == expected


@pytest.mark.parametrize(
    "raw,expected",
    [("12", 12), ("-3", -3), ("5.0", None), ("1e3", None), ("x", None), ("99999999999999999999", None)],
)
def test_to_long(spark, raw, expected):
    assert _one(spark, raw, d.to_long) == expected


@pytest.mark.parametrize("raw", ["20230000", "20230230", "2023625", "202306251", "x"])
def test_invalid_dates_keep_their_text(spark, raw):
    layout = parse_layout("REC\n  datum date\n")
    df = spark.createDataFrame([(raw,)], "datum string")
    assert tuple(d.decode(df, layout["REC"]).first()) == (None, raw)


def test_decode_record(spark):
    layout = parse_layout(
        "REC\n  naam text\n  datum date\n  vlag bool\n  n int na\n  f float\n  CodeBekostigingstatus text\n"
    )
    df = spark.createDataFrame(
        [
            (" Jan ", "20230625", "J", "-1", "1,5", " TI,na"),
            ("", "20230000", "x", "7", "", ""),
            ("001", "", "N", " ", "2.25", "pi"),
        ],
        "naam string, datum string, vlag string, n string, f string, CodeBekostigingstatus string",
    )
    got = d.decode(df, layout["REC"])
    assert got.columns == ["naam", "datum", "vlag", "n", "f", "CodeBekostigingstatus", "datum_Ruw", "n_NVT"]
    day = datetime.date(2023, 6, 25)
    assert rows(got) == rows(
        spark.createDataFrame(
            [
                ("Jan", day, True, None, 1.5, "na,ti", None, True),
                (None, None, None, 7, None, None, "20230000", False),
                ("001", None, False, None, 2.25, "pi", None, False),
            ],
            got.schema,
        )
    )
    kept = d.decode_tables({"REC": df, "_X": df}, layout)
    assert kept["_X"] is df


def test_labels_and_assessment(spark):
    df = spark.createDataFrame([("a", 1), (None, None)], "x string, y int")
    assert rows(df.select(t.label("{}: {}!", "x", "y"))) == [("a: 1!",), ("onbekend: onbekend!",)]
    with pytest.raises(ValueError):
        t.label("{}", "x", "y")
    codes = spark.createDataFrame([("mv",), ("a,mv",), ("mvx",), (None,)], "s string")
    assert [r[0] for r in codes.select(t.lacks_code(F.col("s"), "mv")).collect()] == [
        False, False, True, True,
    ]


@pytest.mark.parametrize("key", [TEST_KEY.encode(), b"s" * 64, b"long" * 40])
def test_pseudonym_equals_the_standard(spark, key):
    values = ["012345678", "246813577", "é"]
    df = spark.createDataFrame([(v,) for v in [*values, "", None]], "x string")
    got = [r[0] for r in df.select(p.pseudonym(F.col("x"), key)).collect()]
    expected = [hmac.new(key, v.encode(), hashlib.sha256).hexdigest() for v in values]
    assert got == [*expected, None, None]


def test_key_stays_out_of_printed_plans(spark):
    df = spark.createDataFrame([("1", "2")], "Burgerservicenummer string, x string")
    hidden = p.pseudonymise(df, TEST_KEY.encode())
    inner = bytes(b ^ 0x36 for b in hashlib.sha256(TEST_KEY.encode()).digest()).hex().upper()
    plan = hidden._jdf.queryExecution().toString()
    assert hidden.columns == df.columns
    assert inner[:40] not in plan.upper()


def test_key_sources(tmp_path):
    file = tmp_path / "key.txt"
    file.write_text(TEST_KEY + "\n", encoding="utf-8")
    env = {p.KEY_ENV: "e" * 64}
    assert p.load_key("a" * 64, file, environ=env) == b"a" * 64
    assert p.load_key(key_file=file, environ=env) == TEST_KEY.encode()
    assert p.load_key(environ=env) == b"e" * 64
    assert p.load_key(env="OTHER", environ={"OTHER": "o" * 64}) == b"o" * 64
    with pytest.raises(ValueError, match="te kort"):
        p.load_key("short")
    with pytest.raises(ValueError, match=p.KEY_ENV):
        p.load_key(environ={})
    assert len(p.load_key("é" * 32)) == 64


def test_public_key_only_for_synthetic_files(spark):
    schema = "Bestandsnaam string, synthetic boolean"
    safe = spark.createDataFrame([("a.csv", True)], schema)
    mixed = spark.createDataFrame([("a.csv", True), ("b.csv", False), ("c.csv", None)], schema)
    public = "d" * 64
    assert p.key_for_files(safe, public, environ={}) == b"d" * 64
    with pytest.raises(ValueError, match="b.csv, c.csv"):
        p.key_for_files(mixed, public, environ={})
    assert p.key_for_files(mixed, public, environ={p.KEY_ENV: "e" * 64}) == b"e" * 64
    with pytest.raises(ValueError, match=p.KEY_ENV):
        p.key_for_files(safe, None, environ={})
