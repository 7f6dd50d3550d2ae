import pytest

from fundmart import codelists, layouts


def test_field_counts():
    analysis = layouts.load_layout("analyse")
    history = layouts.load_layout("hisbek")
    assert {n: len(r.fields) for n, r in analysis.items()} == {
        "VLP": 4, "BLB": 21, "BRD": 25, "BRR": 24, "SLR": 4,
    }
    assert {n: len(r.fields) for n, r in history.items()} == {
        "VLP": 3, "HRD": 30, "HRR": 27, "SLR": 3,
    }


def test_every_record_starts_with_its_type_and_lists_exist():
    for name in ("analyse", "hisbek"):
        for record in layouts.load_layout(name).values():
            assert record.names()[0] == "Recordsoort"
            assert len(set(record.names())) == len(record.fields)
            for code_list in record.code_lists().values():
                assert codelists.codes(code_list)


def test_positions_that_matter():
    history = layouts.load_layout("hisbek")
    assert history["HRD"].names()[3:8] == [
        "Bekostigingsjaar", "BRIN", "Inschrijvingvolgnummer", "Bekostigingsindicatie",
        "CodeBekostigingstatus",
    ]
    assert history["HRD"].names()[19:21] == ["ECTS", "ECTSBekostigd"]
    assert history["HRR"].names()[9] == "JointDegreeFactor"
    assert layouts.load_layout("analyse")["SLR"].declared_counts() == {
        "AantalBLBrecords": "BLB", "AantalBRDrecords": "BRD", "AantalBRRrecords": "BRR",
    }


def test_prepared_schema_has_helpers():
    names = layouts.prepared_schema(layouts.merged_record("BLB")).names
    assert names[0] == "levering" and names[-2:] == ["_regelnr", "_rijnr"]
    assert "VerbruikAD_NVT" in names and "DatumGraadBehaaldAD_Ruw" in names


def test_merged_record_covers_both_headers():
    assert layouts.merged_record("VLP").names() == [
        "Recordsoort", "BRIN", "Bekostigingsjaar", "DatumAanmaak",
    ]


def test_unknown_names_raise():
    with pytest.raises(FileNotFoundError):
        layouts.load_layout("mbo")
    with pytest.raises(FileNotFoundError):
        codelists.codes("mbo")
    with pytest.raises(ValueError, match="field type"):
        layouts.parse_layout("X\n  a money\n")


def test_code_list_frame(spark, tmp_path):
    df = codelists.code_list(spark, "bekostigingstatus")
    assert df.columns == ["Code", "Omschrijving", "Groep", "Bekostigd"]
    assert df.count() == 34 and df.filter("Bekostigd = 'J'").count() == 6
    own = tmp_path / "own.csv"
    own.write_text("Code,Omschrijving\n01,een\n", encoding="utf-8")
    assert codelists.code_list(spark, "own", str(own)).collect()[0]["Code"] == "01"
