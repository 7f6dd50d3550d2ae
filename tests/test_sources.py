import random

import pytest
from pyspark.sql import functions as F

from fundmart.layouts import load_layout, parse_layout
from fundmart.session import Stage
from fundmart.sources.files import delivery_files, files_at, list_files, mark_duplicates, with_guard
from fundmart.sources.lines import first_lines, latin1_files, number_lines, raw_lines, text_lines
from fundmart.sources.names import with_name_parts
from fundmart.sources.records import numbered_table, route, split_records, split_table, stage_lines, staged_messages
from fundmart.plans.jobs import find_files, unrecognised_files

from .conftest import ANALYSIS, PROVISIONAL_NAME, rows, write_file


@pytest.mark.parametrize(
    "name,kind",
    [
        ("VLPBEK_2026_20250122_27KM.csv", "VLPBEK"),
        ("vlpbek_2026_20250122_27km.CSV", "VLPBEK"),
        ("DEFBEK_ 2026_20250122_27KM.csv", "DEFBEK"),
        ("HISBEK_2025_20250411_27KM.Csv", "HISBEK"),
        ("VLPBEK_2026_20250230_27KM.csv", None),
        ("VLPBEK_2026_20250122_27KM (1).csv", None),
        ("VLPBEK_2026_20250122_27KM.txt", None),
        ("XXXBEK_2026_20250122_27KM.csv", None),
        ("VLPBEK__2026_20250122_27KM.csv", None),
        ("VLPBEK_2026_20250122_2KMX.csv", None),
        (".csv", None),
    ],
)
def test_file_names(spark, name, kind):
    df = with_name_parts(spark.createDataFrame([(name,)], "naam string"), "naam")
    assert df.first()["Soort"] == kind


def test_listing_recognised_and_not(spark, tmp_path):
    raw = tmp_path / "raw [1]"
    write_file(raw, PROVISIONAL_NAME, ANALYSIS)
    write_file(raw / "sub map", "DEFBEK_ 2026_20250903_27KM.CSV", ANALYSIS)
    write_file(raw, "VLPBEK_2026_20250122_27KM (1).csv", ANALYSIS)
    (raw / "readme.txt").write_text("x")
    found = find_files(spark, str(raw)).collect()
    assert [r["Bestandsnaam"] for r in found] == [PROVISIONAL_NAME, "DEFBEK_ 2026_20250903_27KM.CSV"]
    assert found[1]["levering"] == "DEFBEK_ 2026_20250903_27KM"
    odd = unrecognised_files(spark, str(raw)).collect()
    assert [r["Bestandsnaam"] for r in odd] == ["VLPBEK_2026_20250122_27KM (1).csv"]
    assert list_files(spark, str(tmp_path / "none")).count() == 0


def test_first_path_wins_among_duplicates(spark):
    paths = ["b/VLPBEK_2026_20250122_27KM.csv", "a/vlpbek_2026_20250122_27km.csv", "a/z/other.csv"]
    df = spark.createDataFrame([(p, p.rsplit("/", 1)[-1]) for p in paths], "pad string, naam string")
    got = {r["pad"]: (r["Eerste"], r["Dubbel"]) for r in mark_duplicates(df, "naam", "pad").collect()}
    assert got[paths[0]] == (paths[1], True)
    assert got[paths[1]] == (paths[1], False)
    assert got[paths[2]] == (paths[2], False)


def test_line_numbers_over_many_blocks(spark, tmp_path):
    """Line and row numbers against a plain count, with files far larger than a block."""
    rng = random.Random(7)
    expected = {}
    paths = []
    for i, name in enumerate(("VLPBEK_2026_20250122_27KM.csv", "HISBEK_2025_20250411_27KM.csv")):
        kinds = [["BLB", "BRD", "BRR", "", "XYZ"], ["HRD", "HRR", "", "XYZ", "BRD"]][i]
        known = [["BLB", "BRD", "BRR"], ["HRD", "HRR"]][i]
        seen: dict[str, int] = {}
        lines = []
        for n in range(1, 4001):
            rs = rng.choice(kinds)
            lines.append(f"{rs}|p{n}|q|r{'x' * rng.randrange(60)}" if rs else rng.choice(["", "  "]))
            if rs in known:
                expected[name[:-4], n] = (rs, seen.get(rs, 0))
                seen[rs] = seen.get(rs, 0) + 1
        path = tmp_path / name
        path.write_text("\n".join(lines) + "\n", encoding="utf-8")
        paths.append(str(path))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        raw = raw_lines(spark, paths)
        assert raw.rdd.getNumPartitions() > 20
        with Stage(spark) as stage:
            staged = stage_lines(stage, route(text_lines(raw, []), None))
            splits = stage.write(split_table(staged), "splits")
            got = {}
            for rs in ("BLB", "BRD", "BRR", "HRD", "HRR"):
                for r in numbered_table(staged, splits, rs).collect():
                    got[r["levering"], r["_regelnr"]] = (rs, r["_rijnr"])
                    assert r["velden"][1] == f"p{r['_regelnr']}"
            assert got == expected
            unknown = staged_messages(staged, splits).collect()
            assert all(r["Recordsoort"] in ("XYZ", "BRD") for r in unknown)
            lines = stage.write(text_lines(raw, []), "plain")
            numbered = number_lines(lines).filter("value like '%|p%'").collect()
            assert numbered and all(r["value"].split("|")[1] == f"p{r['_regelnr']}" for r in numbered)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)


def test_line_ends_and_encodings(spark, tmp_path):
    utf8 = tmp_path / "a.csv"
    utf8.write_bytes("﻿aé|1\r\nb\x0bc\rd e\n\nf".encode("utf-8"))
    latin = tmp_path / "b.csv"
    latin.write_bytes("INSé02|x\nplain\x85next\n".encode("latin-1"))
    raw = raw_lines(spark, [str(utf8), str(latin)])
    odd = [r[0] for r in latin1_files(raw).collect()]
    assert len(odd) == 1 and odd[0].endswith("b.csv")
    with Stage(spark) as stage:
        lines = number_lines(stage.write(text_lines(raw, odd), "t"))
        got = {}
        for r in lines.orderBy("uri", "_regelnr").collect():
            got.setdefault(r["uri"][-5:], []).append((r["_regelnr"], r["value"]))
    expected = utf8.read_text(encoding="utf-8-sig").splitlines()
    assert got["a.csv"] == list(enumerate(expected, start=1))
    assert got["b.csv"] == list(enumerate(latin.read_text(encoding="latin-1").splitlines(), start=1))


def test_short_and_long_rows(spark):
    layout = parse_layout("AAA\n  Recordsoort text\n  x text\n  y text\n")
    df = spark.createDataFrame([("AAA|1",), ("AAA|1|2|3|4",), ("BBB|1",), ("",)], "value string")
    got = rows(split_records(df, layout)["AAA"])
    assert got == [("AAA", "1", ""), ("AAA", "1", "2")]


def test_guard_needs_name_and_header(spark, tmp_path):
    good = write_file(tmp_path, "VLPBEK_2026_20250122_27KM.csv", ANALYSIS)
    renamed = write_file(tmp_path, "DEFBEK_2026_20250122_27KM.csv", ["VLP|05RZ|2026|20250122"])
    other = write_file(tmp_path, "VLPBEK_2026_20250122_05RZ.csv", ANALYSIS)
    empty = tmp_path / "HISBEK_2025_20250411_27KM.csv"
    empty.write_text("")
    paths = [str(p) for p in (good, renamed, other, empty)]
    files = delivery_files(files_at(spark, paths))
    first = first_lines(raw_lines(spark, paths))
    got = {r["Bestandsnaam"]: r["synthetic"] for r in with_guard(files, first, "27KM").collect()}
    assert got == {good.name: True, renamed.name: False, other.name: False, empty.name: False}


def test_person_fields_have_a_fixed_place():
    for layout in ("analyse", "hisbek"):
        for record in load_layout(layout).values():
            if "Burgerservicenummer" in record.names():
                assert record.names()[1:3] == ["Burgerservicenummer", "Onderwijsnummer"]


def test_hidden_person_fields_in_staged_lines(spark, tmp_path):
    from fundmart.functions.pseudonym import pseudonym

    path = write_file(tmp_path, PROVISIONAL_NAME, [*ANALYSIS, "XYZ|246813577|"])
    key = b"k" * 64
    staged = route(text_lines(raw_lines(spark, [str(path)]), []), key)
    text = staged.select(F.to_json(F.struct("*"))).collect()
    assert not any("246813577" in r[0] or "918273702" in r[0] for r in text)
    expected = spark.range(1).select(pseudonym(F.lit("246813577"), key)).first()[0]
    assert any(expected in r[0] for r in text)
