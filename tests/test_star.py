import datetime

import pytest

from fundmart.layouts import degree_dates
from fundmart.plans import indicators as ind
from fundmart.plans.contracts import STAR_CONTRACTS, check_tables, unique_keys
from fundmart.plans.star import STAR_TABLES, build_star, refuse_mixed_pseudonyms
from fundmart.sources.prepared import stack_prepared

from .conftest import rows

PROVISIONAL = "VLPBEK_2026_20250122_27KM"
FINAL = "DEFBEK_2026_20250903_27KM"
HISTORIC = "HISBEK_2025_20250411_27KM"


def test_tables_and_grain(standard):
    _, outcome = standard
    star = outcome.star
    assert list(star) == list(STAR_TABLES)
    assert {n: df.count() for n, df in star.items()} == {
        "dim_levering": 3, "dim_persoon": 4, "dim_instelling": 2, "dim_opleiding": 2,
        "dim_status": 34, "fact_deelname": 14, "fact_resultaat": 6, "fact_status": 24,
        "fact_loopbaan": 4,
    }
    assert check_tables(star).count() == 0


def test_facts(standard):
    star = standard[1].star
    got = rows(star["fact_deelname"], "_feit_id", "Recordsoort", "BRIN", "Bekostigingsjaar")
    place = ["27KM", "27KM", "05RZ", "27KM", "27KM"]
    own = [(f"D:{PROVISIONAL}:{i}", "BRD", brin, 2026) for i, brin in enumerate(place)]
    assert [r for r in got if PROVISIONAL in r[0]] == own
    past = [(f"D:{HISTORIC}:{i}", "HRD", "27KM", year) for i, year in enumerate((2022, 2023, 2023, 2024))]
    assert [r for r in got if HISTORIC in r[0]] == past
    assert star["fact_deelname"].columns[:5] == ["_feit_id", "levering", "_persoon_id", "Recordsoort", "BRIN"]
    assert len(star["fact_deelname"].columns) == 27
    assert len(star["fact_resultaat"].columns) == 24
    assert len(star["fact_loopbaan"].columns) == 26
    points = rows(star["fact_deelname"].filter("ECTS is not null"), "_feit_id", "ECTS", "ECTSBekostigd")
    assert [r[1:] for r in points] == [(48.0, 42.5), (60.0, 30.0), (12.0, 0.0), (60.0, 0.0)]


def test_bridge_and_career(standard):
    star = standard[1].star
    refused = star["fact_status"].filter(f"_feit_id = 'D:{PROVISIONAL}:3'")
    assert rows(refused, "Bron", "Code") == [("deelname", c) for c in ("nl", "nr", "oc")]
    career = star["fact_loopbaan"].filter(f"levering = '{PROVISIONAL}' and VerbruikBA = 4").first()
    assert career["VerbruikAD"] == 2 and career["VerbruikMALG"] is None
    assert career["AantalBekostigdeInschrijvingenBaLG"] is None
    assert career["AantalBekostigdeInschrijvingenBaLG_NVT"] is True
    assert career["VerbruikAD_NVT"] is False


def test_dimensions(standard):
    star = standard[1].star
    assert rows(star["dim_instelling"]) == [("05RZ", False), ("27KM", True)]
    person = star["dim_persoon"].filter("Onderwijsnummer is null").collect()
    assert [p["_persoon_id"] for p in person] == [p["Burgerservicenummer"] for p in person]
    dates = [person[0][c] for c in degree_dates()]
    assert dates == [datetime.date(2015, 7, 3), None, datetime.date(2018, 8, 31), None, None, None]
    person = star["dim_persoon"].filter("Burgerservicenummer is null").collect()
    assert [p["_persoon_id"] for p in person] == [p["Onderwijsnummer"] for p in person]
    programmes = rows(star["dim_opleiding"], "Opleidingscode", "Opleidingsniveau", "OpleidingOnderdeel")
    assert programmes == [("39255", "HBO-MA", "GEZONDHEIDSZORG"), ("60301", "WO-BA", "RECHT")]
    delivery = star["dim_levering"].filter(f"levering = '{HISTORIC}'").first()
    assert delivery["SoortLevering"] == "HISBEK" and delivery["Bekostigingsjaar"] == 2025
    assert delivery["DatumAanmaak"] == datetime.date(2025, 4, 11)
    assert delivery["Gepseudonimiseerd"] is True and len(delivery["Sha256"]) == 64


def test_empty_input_keeps_all_columns(spark, standard):
    empty = build_star(spark, {})
    assert list(empty) == list(STAR_TABLES)
    for name, df in empty.items():
        assert df.schema.simpleString() == standard[1].star[name].schema.simpleString(), name
        assert df.count() == (34 if name == "dim_status" else 0)


def test_unknown_status_code_joins_the_dimension(spark, standard):
    base, _ = standard
    stacked = stack_prepared(spark, [str(base / "prepared")])
    from pyspark.sql import functions as F

    stacked["BRD"] = stacked["BRD"].withColumn("CodeBekostigingstatus", F.lit("zz"))
    extra = build_star(spark, stacked)["dim_status"].filter("Groep = 'Onbekend'").collect()
    assert [(r["Code"], r["Bekostigd"]) for r in extra] == [("zz", False)]


def test_mixed_pseudonyms_are_refused(spark):
    df = spark.createDataFrame([(True,), (False,)], "Gepseudonimiseerd boolean")
    with pytest.raises(ValueError, match="deels"):
        refuse_mixed_pseudonyms(df)


def test_contracts_by_breaking(standard):
    star = standard[1].star
    broken = dict(star)
    one = star["dim_opleiding"].limit(1)
    broken["dim_opleiding"] = star["dim_opleiding"].unionByName(one)
    found = rows(check_tables(broken), "Controle", "Recordsoort", "Aantal")
    assert found == [("Uniciteit", "dim_opleiding", 2)]
    from pyspark.sql import functions as F

    broken = {**star, "fact_resultaat": star["fact_resultaat"].withColumn("BRIN", F.lit(None).cast("string"))}
    assert rows(check_tables(broken), "Controle", "Melding", "Aantal") == [
        ("Lege sleutel", "BRIN is leeg", 6)
    ]
    broken = {**star, "dim_instelling": star["dim_instelling"].filter("BRIN <> '05RZ'")}
    assert rows(check_tables(broken), "Controle", "Recordsoort", "Melding") == [
        ("Koppeling", "fact_deelname", "2 waarden van BRIN ontbreken in dim_instelling")
    ]
    only_keys = check_tables(broken, STAR_CONTRACTS, (unique_keys,))
    assert only_keys.count() == 0


def test_indicators(standard):
    star = standard[1].star
    assert ind.has_kind(star, "HISBEK") and not ind.has_kind(star, "XXXBEK")
    assert ind.current_deliveries(star, ind.PROVISIONAL) == [PROVISIONAL]
    assert ind.comparable_years(star) == [2026]
    base = ind.fact_base(star, "fact_deelname", [PROVISIONAL])
    assert rows(base, "BRIN", "SoortLevering", "Opleidingsniveau") == [
        ("27KM", "VLPBEK", level) for level in ("HBO-MA", "HBO-MA", "WO-BA", "WO-BA")
    ]
    assert {r[0]: r[1] for r in ind.funnel(base).collect()} == {
        "In bestand": 4, "Beoordeeld": 4, "Bekostigd": 2,
    }
    assert rows(ind.reasons(base, star), "Code", "Aantal") == [(c, 1) for c in ("ng", "nl", "nr", "oc")]
    assert rows(ind.per_programme(base)) == [
        ("39255", "HBO-MA", 2, 1, 0.5), ("60301", "WO-BA", 2, 1, 0.5)
    ]
    assert rows(ind.provisional_to_final(star)) == [
        (2026, "ng", "pd", 1), (2026, "nl,nr,oc", "nr", 1)
    ]
    assert [tuple(r) for r in ind.history(star).collect()] == [
        (2022, "deelname", 1, 1), (2023, "deelname", 2, 1), (2023, "resultaat", 1, 0),
        (2024, "deelname", 1, 0), (2024, "resultaat", 1, 1),
    ]
    assert ind.fact_base(star, "fact_deelname", [PROVISIONAL], ["HBO-O"]).count() == 0
    assert ind.fact_base(star, "fact_deelname", [PROVISIONAL], ["WO-BA"]).count() == 2
    assert [r[0] for r in ind.level_choices(star).collect()] == ["HBO-MA", "WO-BA"]


def test_indicators_without_their_delivery(spark):
    star = build_star(spark, {})
    assert ind.comparable_years(star) == []
    assert ind.provisional_to_final(star).columns == ["Bekostigingsjaar", "Voorlopig", "Definitief", "Aantal"]
    assert ind.provisional_to_final(star).count() == 0
    assert ind.history(star).count() == 0
    base = ind.fact_base(star, "fact_deelname", [])
    assert [r[1] for r in ind.funnel(base).collect()] == [0, 0, 0]
    assert ind.reasons(base, star).count() == 0


def test_reasons_read_the_facts_of_the_chosen_deliveries_only(standard):
    star = standard[1].star
    base = ind.fact_base(star, "fact_deelname", [PROVISIONAL])
    found = ind.reasons(base, star)
    assert rows(found, "Code", "Aantal") == [(c, 1) for c in ("ng", "nl", "nr", "oc")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "fact_status" not in plan and "SortMergeJoin" not in plan
    scans = [line for line in plan.splitlines() if "fact_deelname" in line]
    assert scans and all("levering" in s.split("PartitionFilters: [")[1].split("]")[0] for s in scans)
    # One shuffle counts the codes; what is sorted afterwards is a row per code.
    assert plan.count("hashpartitioning") == 1


def test_plans_prune_and_stay_in_the_jvm(standard):
    star = standard[1].star
    base = ind.fact_base(star, "fact_deelname", [PROVISIONAL])
    for df in (ind.funnel(base), ind.reasons(base, star), ind.per_programme(base), ind.history(star)):
        plan = df._jdf.queryExecution().toString()
        assert "PythonUDF" not in plan and "ArrowEval" not in plan and "Cartesian" not in plan
    plan = ind.funnel(base)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [levering" in plan.replace("isnotnull(levering), ", "") or (
        "PartitionFilters" in plan and PROVISIONAL in plan
    )
    assert "DatumInschrijving" not in plan
