import hashlib
import json
import os
import shutil

import pytest

from fundmart import cli
from fundmart.functions.pseudonym import KEY_ENV
from fundmart.operators.checks import QualityError
from fundmart.plans import jobs
from fundmart.plans.report import read_status, report_violations, table_totals, write_report
from fundmart.sinks import write_csv, write_table
from fundmart.sources import files as files_module
from fundmart.sources.lines import raw_lines, text_lines
from fundmart.sources.prepared import (
    read_csv_table,
    read_star,
    read_table,
    stack_prepared,
    stored_messages,
)
from fundmart.sources.records import route

from .conftest import (
    ANALYSIS,
    HISTORY,
    HISTORY_NAME,
    LAWYER_ELSEWHERE,
    NURSE,
    PROVISIONAL_NAME,
    TEST_KEY,
    VLP,
    changed,
    rows,
    write_file,
)

KEY = TEST_KEY.encode()


def _name(day: int, brin: str = "27KM", year: int = 2026) -> str:
    return f"VLPBEK_{year}_202503{day:02d}_{brin}.csv"


@pytest.fixture(scope="module")
def broken(spark, tmp_path_factory):
    """One folder with a delivery per kind of defect, each with one effect."""
    base = tmp_path_factory.mktemp("broken")
    raw = base / "raw map"
    files = {
        _name(1): ANALYSIS,
        _name(2): [VLP, "", "XYZ|x", "XYZ|y", *ANALYSIS[1:]],
        _name(3): changed(ANALYSIS, NURSE, NURSE + "|| extra"),
        _name(4): changed(ANALYSIS, "SLR|2|5|2", "SLR|2|6|x"),
        _name(5): changed(ANALYSIS, "|39255|HBO-MA|M|2024", "||HBO-MA|M|2024"),
        _name(6): changed(ANALYSIS, "nr,oc,nl", "nr,QQ"),
        _name(7, "00AA"): ANALYSIS,
        _name(8, year=2025): ANALYSIS,
        _name(9): ANALYSIS[1:],
        _name(11): changed(ANALYSIS, NURSE, NURSE.replace("20240201", "20240200")),
        _name(13): ANALYSIS[:-1],
        _name(14): [VLP, *ANALYSIS],
        _name(15): [*ANALYSIS, "SLR|2|5|2"],
    }
    for name, lines in files.items():
        write_file(raw, name, lines)
    write_file(raw, _name(12), changed(ANALYSIS, "D-44", "Dé-44"), encoding="latin-1")
    write_file(raw, _name(10), ["", "  ", ""])
    (raw / _name(16)).write_bytes(b"")
    write_file(raw / "z nog eens", _name(1).lower(), ANALYSIS)
    write_file(raw, f"{_name(17)[:-4]} (1).csv", ANALYSIS)
    outcome = jobs.process_folder(spark, str(raw), str(base / "prep"), str(base / "out"), KEY)
    return base, outcome


def _messages(broken, day, brin="27KM", year=2026):
    source = _name(day, brin, year)[:-4]
    found = broken[1].messages.filter(f"Bron = '{source}'")
    return rows(found, "Controle", "Recordsoort", "Melding", "Aantal", "Ernst")


def test_clean_delivery_has_no_messages(broken):
    assert _messages(broken, 1) == []


@pytest.mark.parametrize(
    "day,expected",
    [
        (2, [("Inlezen", "XYZ", "Onbekende recordsoort", 2, "error")]),
        (3, [("Inlezen", "BRD", "1 meer gevulde velden dan het schema (25)", 1, "error")]),
        (
            4,
            [
                ("Aantal records", "BRD", "SLR meldt 6, gevonden 5", 1, "error"),
                ("Aantal records", "BRR", "SLR meldt None, gevonden 2", 1, "error"),
                ("Verplicht veld", "SLR", "AantalBRRrecords is leeg", 1, "error"),
            ],
        ),
        (5, [("Verplicht veld", "BRD", "Opleidingscode is leeg", 2, "error")]),
        (6, [("Codelijst", "BRD", "CodeBekostigingstatus: onbekende code 'qq'", 1, "warning")]),
        (11, [("Verplicht veld", "BRD", "DatumInschrijving is leeg", 1, "error")]),
        (12, []),
        (13, [("Aantal records", "SLR", "Geen sluitrecord (SLR)", 1, "error")]),
        (14, [("Eén rij", "VLP", "Verwacht 1 rij, gevonden 2", 1, "error")]),
        (15, [("Eén rij", "SLR", "Verwacht 1 rij, gevonden 2", 1, "error")]),
    ],
)
def test_one_defect_one_message(broken, day, expected):
    assert _messages(broken, day) == expected


def test_name_against_header(broken):
    assert _messages(broken, 7, "00AA") == [
        ("BRIN", "VLP", "BRIN in bestandsnaam (00AA) wijkt af van VLP (27KM)", 1, "error")
    ]
    assert _messages(broken, 8, year=2025) == [
        ("Bekostigingsjaar", "VLP", "Jaar in bestandsnaam (2025) wijkt af van VLP (2026)", 1, "warning")
    ]


def test_files_that_cannot_be_processed(broken):
    outcome = broken[1]
    assert outcome.status == "fail"
    assert outcome.errors[_name(9)] == f"Geen voorlooprecord (VLP) in {_name(9)}"
    assert outcome.errors[_name(10)].startswith("Leeg bestand")
    assert outcome.errors[_name(16)].startswith("Leeg bestand")
    twice = f"z nog eens/{_name(1).lower()}"
    assert outcome.errors[twice].startswith(f"Dubbel: een bestand met dezelfde naam ({_name(1)})")
    assert len(outcome.errors) == 4 and len(outcome.labels) == 13
    files = outcome.messages.filter("Controle in ('Bestand', 'Dubbel')")
    assert rows(files, "Controle", "Recordsoort", "Ernst") == [
        ("Bestand", "VLPBEK", "error"), ("Bestand", "VLPBEK", "error"), ("Bestand", "VLPBEK", "error"),
        ("Dubbel", "VLPBEK", "warning"),
    ]


def test_values_survive(spark, broken):
    base, outcome = broken
    enrolments = read_table(spark, str(base / "prep"), "BRD")
    bad = enrolments.filter("DatumInschrijving_Ruw is not null").collect()
    assert [(r["DatumInschrijving"], r["DatumInschrijving_Ruw"]) for r in bad] == [(None, "20240200")]
    latin = enrolments.filter("Inschrijvingvolgnummer = 'Dé-44'").collect()
    assert len(latin) == 1 and latin[0]["levering"] == _name(12)[:-4]
    unknown = enrolments.filter(f"levering = '{_name(2)[:-4]}'")
    assert rows(unknown, "_regelnr", "_rijnr") == [(11, 3), (13, 4), (5, 0), (7, 1), (9, 2)]
    assert outcome.star["dim_status"].filter("Code = 'qq'").count() == 1


def test_report_follows_its_contract(spark, broken, standard):
    for base in (broken[0], standard[0]):
        path = str(base / "out" / "quality.json")
        assert report_violations(spark, path).count() == 0
    report = json.loads((broken[0] / "out" / "quality.json").read_text(encoding="utf-8"))
    assert report["status"] == "fail" and report["fouten_toegestaan"] is False
    assert read_status(spark, path := str(broken[0] / "out" / "quality.json"))[0] == "fail", path
    total = sum(len(d["meldingen"]) for d in report["leveringen"]) + len(report["star"]["meldingen"])
    assert total == report["total_errors"] + report["total_warnings"]
    labels = [d["levering"] for d in report["leveringen"]]
    assert labels[:13] == sorted(labels[:13]) and len(labels) == 17
    assert "Eén rij" in (broken[0] / "out" / "quality.json").read_text(encoding="utf-8")
    cover = {(c["levering"], c["recordsoort"]): c["rijen"] for c in report["dekking"]}
    assert cover[_name(13)[:-4], "SLR"] == 0 and cover[_name(1)[:-4], "BRD"] == 5
    four = next(d for d in report["leveringen"] if d["levering"] == _name(4)[:-4])
    assert [m["controle"] for m in four["meldingen"]] == ["Aantal records", "Aantal records", "Verplicht veld"]


def test_broken_report_is_noticed(spark, tmp_path, standard):
    text = (standard[0] / "out" / "quality.json").read_text(encoding="utf-8")
    report = json.loads(text)
    changes = {
        "status": {**report, "status": "fine"},
        "keys": {**report, "more": 1},
        "totals": {**report, "total_errors": -1},
        "star": {**report, "star": {"status": "ok"}},
        "deliveries": {**report, "leveringen": [{**report["leveringen"][0], "sha256": "abc"}]},
        "provenance": {**report, "provenance": {"python": "3"}},
    }
    for rule, content in changes.items():
        path = tmp_path / f"{rule}.json"
        path.write_text(json.dumps(content), encoding="utf-8")
        found = {r[0] for r in report_violations(spark, str(path)).collect()}
        assert rule in found, (rule, found)


def test_nothing_readable_is_written(broken):
    base, _ = broken
    for path in [*(base / "prep").rglob("*"), *(base / "out").rglob("*")]:
        if path.is_file():
            assert b"246813577" not in path.read_bytes() and b"918273702" not in path.read_bytes(), path


def test_checksum_is_of_the_bytes(spark, standard):
    base, outcome = standard
    digest = hashlib.sha256((base / "raw" / PROVISIONAL_NAME).read_bytes()).hexdigest()
    got = outcome.star["dim_levering"].filter("SoortLevering = 'VLPBEK'").first()["Sha256"]
    assert got == digest


def test_standard_folder_is_clean(spark, standard):
    base, outcome = standard
    assert outcome.status == "ok" and outcome.errors == {}
    assert read_status(spark, str(base / "out" / "quality.json")) == ("ok", 0)
    assert read_star(spark, str(base / "out" / "nothing")) is None


def test_empty_folder(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    outcome = jobs.process_folder(
        spark, str(tmp_path / "raw"), str(tmp_path / "prep"), str(tmp_path / "out"), KEY
    )
    assert outcome.labels == [] and outcome.status == "ok"
    assert outcome.star["dim_status"].count() == 34 and outcome.star["fact_deelname"].count() == 0


@pytest.fixture(scope="module")
def single(spark, tmp_path_factory):
    """One file into a target that already has a user's own file, then a smaller version."""
    base = tmp_path_factory.mktemp("single")
    target = base / "prep"
    (target / "notes").mkdir(parents=True)
    (target / "notes" / "mine.parquet").write_text("mine")
    path = write_file(base, PROVISIONAL_NAME, ANALYSIS)
    first = jobs.run_pipeline(spark, str(path), str(target), key=KEY)
    other = write_file(base, HISTORY_NAME, HISTORY)
    jobs.run_pipeline(spark, str(other), str(target), key=KEY)
    return base, target, first, path


def test_single_file(spark, single):
    _, target, first, _ = single
    assert table_totals(first.tables) == (7, 12)
    assert first.labels == [PROVISIONAL_NAME[:-4]]
    stacked = stack_prepared(spark, [str(target)])
    assert stacked["LEVERING"].count() == 2
    assert stored_messages(spark, stacked).count() == 0


def test_rerun_replaces_only_its_own_delivery(spark, single):
    base, target, _, path = single
    write_file(base, PROVISIONAL_NAME, changed([VLP, NURSE, LAWYER_ELSEWHERE, "SLR|0|2|0"], "27KM|A-100", "27KM|NEW-1"))
    jobs.run_pipeline(spark, str(path), str(target), key=KEY)
    stacked = stack_prepared(spark, [str(target)])
    assert stacked["BRD"].count() == 2
    assert stacked["BRR"].count() == 0 and stacked["BLB"].count() == 0
    assert stacked["HRD"].count() == 4
    assert (target / "notes" / "mine.parquet").read_text() == "mine"


def test_outdated_delivery_is_an_error(spark, single, tmp_path):
    base, _, _, _ = single
    path = write_file(tmp_path, _name(21), changed(ANALYSIS, "nr,oc,nl", "nr,zz"))
    target = str(tmp_path / "prep")
    jobs.run_pipeline(spark, str(path), target, key=KEY)
    old = read_table(spark, target, "VALIDATIE").drop("Ernst", "_orde")
    kept = spark.createDataFrame(old.collect(), old.schema)
    write_table(kept, f"{target}/VALIDATIE", by="levering")
    found = stored_messages(spark, stack_prepared(spark, [target]))
    assert rows(found, "Bron", "Controle", "Ernst") == [(_name(21)[:-4], "Prepared-map", "error")]
    with pytest.raises(QualityError):
        jobs.run_star(spark, [target], str(tmp_path / "out"))
    assert read_status(spark, str(tmp_path / "out" / "quality.json")) == ("fail", 1)
    assert read_star(spark, str(tmp_path / "out" / "datamodel"))["fact_deelname"].count() == 5


def test_delivery_without_its_own_row_is_outdated(spark, single, tmp_path):
    """Folders from before the delivery table, and a part of one whose row is gone."""
    target = tmp_path / "prep"
    for day in (21, 22):
        path = write_file(tmp_path, _name(day), ANALYSIS)
        jobs.run_pipeline(spark, str(path), str(target), key=KEY, fail_on_errors=False)
    old, new = _name(21)[:-4], _name(22)[:-4]
    shutil.rmtree(target / "LEVERING" / f"levering={old}")
    stacked = stack_prepared(spark, [str(target)])
    found = stored_messages(spark, stacked).filter("Controle = 'Prepared-map'")
    assert rows(found, "Bron", "Recordsoort", "Ernst") == [(old, "VALIDATIE", "error")]
    without = {n: df for n, df in stacked.items() if n != "LEVERING"}
    found = stored_messages(spark, without).filter("Controle = 'Prepared-map'")
    assert rows(found, "Bron") == [(old,), (new,)]
    renamed = stack_prepared(spark, [str(target)], ["own name"])
    assert rows(stored_messages(spark, {"BRD": renamed["BRD"]}), "Bron") == [("own name",)]
    assert stored_messages(spark, {}).count() == 0


def test_stack_refuses_wrong_folders(spark, single, tmp_path):
    target = str(single[1])
    with pytest.raises(FileNotFoundError):
        stack_prepared(spark, [str(tmp_path / "none")])
    (tmp_path / "empty").mkdir()
    with pytest.raises(ValueError, match="Geen Parquet"):
        stack_prepared(spark, [str(tmp_path / "empty")])
    with pytest.raises(ValueError, match="labels heeft 2"):
        stack_prepared(spark, [target], ["a", "b"])
    with pytest.raises(ValueError, match="meer dan eens"):
        stack_prepared(spark, [target, target])
    assert stack_prepared(spark, []) == {}


def test_one_label_per_folder(spark, tmp_path):
    for i in (1, 2):
        path = write_file(tmp_path / f"raw{i}", _name(25), ANALYSIS)
        jobs.run_pipeline(spark, str(path), str(tmp_path / f"p{i}"), key=KEY)
    stacked = stack_prepared(spark, [str(tmp_path / "p1"), str(tmp_path / "p2")], ["2024", "2025"])
    assert rows(stacked["LEVERING"], "levering") == [("2024",), ("2025",)]
    assert stacked["BRD"].count() == 10


def test_wrong_input(spark, tmp_path):
    with pytest.raises(ValueError, match="Onbekend bestandstype"):
        jobs.run_pipeline(spark, str(write_file(tmp_path, "x.csv", ANALYSIS)), str(tmp_path / "p"), key=KEY)
    path = write_file(tmp_path, _name(22), ANALYSIS[1:])
    with pytest.raises(ValueError, match="voorlooprecord"):
        jobs.run_pipeline(spark, str(path), str(tmp_path / "p"), key=KEY)
    assert not (tmp_path / "p").exists()
    with pytest.raises(ValueError, match="Onbekend formaat"):
        jobs.run_pipeline(spark, str(path), str(tmp_path / "p"), fmt="xlsx", key=KEY)


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    good = write_file(tmp_path, _name(23), ANALYSIS)
    bad = write_file(tmp_path, _name(24), changed(ANALYSIS, "SLR|2|5|2", "SLR|2|7|2"))
    monkeypatch.delenv(KEY_ENV, raising=False)
    prep = str(tmp_path / "prep")
    assert cli.run(["verwerk", str(good), prep], spark) == 1
    assert KEY_ENV in capsys.readouterr().err
    key_file = tmp_path / "key"
    key_file.write_text(TEST_KEY)
    monkeypatch.setenv(KEY_ENV, TEST_KEY)
    assert cli.run(["verwerk", str(good), prep, "--sleutelbestand", str(key_file)], spark) == 0
    assert "7 tabellen, 12 rijen" in capsys.readouterr().out
    assert cli.run(["verwerk", str(bad), prep], spark) == 3
    assert cli.run(["verwerk", str(bad), prep, "--allow-quality-errors"], spark) == 0
    assert "toegestaan" in capsys.readouterr().out
    out = str(tmp_path / "out")
    assert cli.run(["star", prep, "--output", out], spark) == 3
    assert (tmp_path / "out" / "quality.json").exists()
    assert cli.run(["star", prep, "--output", out, "--allow-quality-errors"], spark) == 0
    assert "9 tabellen" in capsys.readouterr().out
    assert cli.run(["star", str(tmp_path / "none"), "--output", out], spark) == 1
    csv = str(tmp_path / "csv")
    assert cli.run(["verwerk", str(good), csv, "--fmt", "csv", "--geen-pseudonimisering"], spark) == 0
    assert "NIET gepseudonimiseerd" in capsys.readouterr().err
    header = next((tmp_path / "csv" / "BRD").rglob("*.csv")).read_text(encoding="utf-8").splitlines()[0]
    assert header.startswith("Recordsoort,Burgerservicenummer") and "DatumInschrijving_Ruw" in header
    assert "_regelnr" not in header
    assert cli.run(["star", csv, "--output", out], spark) == 1


def test_download_of_a_table(spark, standard, tmp_path):
    write_csv(standard[1].star["dim_instelling"], str(tmp_path / "download"))
    back = spark.read.option("header", True).csv(str(tmp_path / "download"))
    assert rows(back) == [("05RZ", "false"), ("27KM", "true")]


def test_csv_runs_into_one_folder_keep_their_columns(spark, tmp_path):
    """A second delivery without raw dates must not shift the columns of the first."""
    odd = changed(ANALYSIS, "|20150703||", "|2015x703||")
    first = write_file(tmp_path, _name(1), odd)
    second = write_file(tmp_path, _name(2), ANALYSIS)
    target = str(tmp_path / "csv")
    for path in (first, second):
        result = jobs.run_pipeline(
            spark, str(path), target, fmt="csv", pseudonymise=False, fail_on_errors=False
        )
    rows_back = {r["levering"]: r for r in result.tables["BLB"].filter("VerbruikBA = 4").collect()}
    assert list(rows_back) == [_name(2)[:-4]]
    assert rows_back[_name(2)[:-4]]["DatumGraadBehaaldAD_Ruw"] is None
    both = read_csv_table(spark, target, "BLB").filter("VerbruikBA = 4")
    raw = {r["levering"]: r["DatumGraadBehaaldAD_Ruw"] for r in both.collect()}
    assert raw == {_name(1)[:-4]: "2015x703", _name(2)[:-4]: None}
    with pytest.raises(ValueError, match="andere map"):
        jobs.run_pipeline(spark, str(second), target, fmt="parquet", pseudonymise=False)


def test_report_is_complete_with_very_many_messages(spark, tmp_path):
    n = 250_000
    messages = spark.range(n).selectExpr(
        "concat('d', id % 3) AS Bron", "'Codelijst' AS Controle", "'BRD' AS Recordsoort",
        "concat('melding ', id) AS Melding", "id AS Aantal",
        "if(id = 7, 'error', 'warning') AS Ernst", "lpad(id, 9, '0') AS orde",
    )
    deliveries = spark.createDataFrame(
        [("d0", "a.csv", None), ("d1", "b.csv", None), ("d9", "c.csv", None)],
        "levering string, Bestandsnaam string, Sha256 string",
    )
    covered = spark.createDataFrame([("d0", "BRD", 4)], "levering string, recordsoort string, rijen long")
    path = write_report(spark, str(tmp_path), messages, deliveries, True, covered, "orde")
    assert report_violations(spark, path).count() == 0
    report = json.loads((tmp_path / "quality.json").read_text(encoding="utf-8"))
    found = {d["levering"]: d for d in report["leveringen"]}
    assert list(found) == ["d0", "d1", "d9", "d2"]
    assert [found[d]["status"] for d in found] == ["warn", "fail", "ok", "warn"]
    assert sum(len(d["meldingen"]) for d in found.values()) == n == report["total_warnings"] + 1
    assert [m["aantal"] for m in found["d2"]["meldingen"][:3]] == [2, 5, 8]
    assert report["dekking"] == [{"levering": "d0", "recordsoort": "BRD", "rijen": 4}]


def test_checksum_reads_in_pieces(spark, tmp_path, monkeypatch):
    content = os.urandom(100_003)
    (tmp_path / "a b%.csv").write_bytes(content)
    monkeypatch.setattr(files_module, "CHUNK", 1_000)
    listed = files_module.files_at(spark, [str(tmp_path)])
    found = files_module.checksums(listed).collect()
    assert [r["Sha256"] for r in found] == [hashlib.sha256(content).hexdigest()]
    heads = files_module.file_heads(listed).collect()
    assert len(heads) == 1 and heads[0]["value"] is not None


def test_public_key_is_refused_for_real_files(spark, tmp_path, monkeypatch):
    monkeypatch.delenv(KEY_ENV, raising=False)
    write_file(tmp_path / "raw", _name(1), ANALYSIS)
    arguments = (spark, str(tmp_path / "raw"), str(tmp_path / "p"), str(tmp_path / "o"))
    outcome = jobs.process_folder(*arguments, demo_key="d" * 64, demo_brin="27KM")
    assert outcome.labels == [_name(1)[:-4]]
    write_file(tmp_path / "raw", _name(2, brin="05RZ"), changed(ANALYSIS, "VLP|27KM", "VLP|05RZ"))
    with pytest.raises(ValueError, match="05RZ"):
        jobs.process_folder(*arguments, demo_key="d" * 64, demo_brin="27KM")


def test_job_has_no_python_in_its_lines(spark, tmp_path):
    path = write_file(tmp_path, _name(1), ANALYSIS)
    routed = route(text_lines(raw_lines(spark, [str(path)]), []), KEY)
    plan = routed.sortWithinPartitions("tabel", "_m")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
