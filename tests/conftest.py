import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from fundmart.plans.jobs import process_folder  # noqa: E402
from fundmart.session import new_session  # noqa: E402

# Fixed test key of more than 64 bytes; never used for real numbers.
TEST_KEY = "test key for pseudonyms, only used by the test suite " + "k" * 30

OWN, OTHER = "27KM", "05RZ"

# Four students at one institution, one of them enrolled elsewhere too. One has no
# education number, one no citizen number. Lines of the record types are mixed.
VLP = f"VLP|{OWN}|2026|20250122"
NURSE = (
    f"BRD|246813577||{OWN}|A-100|J|pd|HOOG|39255|HBO-MA|M|20240201|20250131|N|S|DT|20240119|7"
    "|GEZONDHEIDSZORG|OPEN_BESTEL|J|M|J|N|J"
)
LAWYER = (
    f"BRD|135792462|918273645|{OWN}|B-7|N|ng|LAAG|60301|WO-BA|B|20240901|20250831|N|S|VT"
    "|20240902||RECHT||N|B|N|J|N"
)
LAWYER_ELSEWHERE = (
    f"BRD|135792462|918273645|{OTHER}|C-1|J|pi|LAAG|60301|WO-BA|B|20240901|20250831|J|S|VT"
    "|20240830|12|RECHT|BEKOSTIGD|N|B|N|J|J"
)
REFUSED = (
    f"BRD||918273702|{OWN}|D-44|N|nr,oc,nl|HOOG|39255|HBO-MA|M|20240901|20250831|J|S|DU"
    "|20240903||GEZONDHEIDSZORG||J|M|J|J|J"
)
FRESHER = (
    f"BRD|864209753|918273811|{OWN}|E-2|J|pi|LAAG|60301|WO-BA|B|20241001|20250831|J|S|VT"
    "|20240927|11|RECHT|BEKOSTIGD|N|B|N|J|J"
)
NURSE_DEGREE = (
    f"BRR|246813577||{OWN}|G-9|J|pg|HOOG|0.5|39255|HBO-MA|M|N|20250115|DT|20250120"
    "|GEZONDHEIDSZORG|OPEN_BESTEL|J|M|J|J|N|J"
)
FRESHER_DEGREE = (
    f"BRR|864209753|918273811|{OWN}|G-10|N|ne,tg|LAAG|1|60301|WO-BA|B|J|20250630|VT|20250702"
    "|RECHT||N|B|N|N|J|J"
)
REFUSED_CAREER = "BLB||918273702|||||||3"
NURSE_CAREER = "BLB|246813577||20150703||20180831||||2|-1|4|-1|1||4|-1|1"
SLR = "SLR|2|5|2"
ANALYSIS = [
    VLP, NURSE, REFUSED_CAREER, LAWYER, NURSE_DEGREE, LAWYER_ELSEWHERE, NURSE_CAREER, REFUSED,
    FRESHER_DEGREE, FRESHER, SLR,
]
FINAL = [line.replace("N|ng|", "J|pd|").replace("nr,oc,nl", "nr") for line in ANALYSIS]


def _past(person: str, year: int, number: str, verdict: str, points: str) -> str:
    return (
        f"HRD|{person}|{year}|{OWN}|{number}|{verdict}|LAAG|60301|WO-BA|B|{year - 1}0901|{year}0831"
        f"|J|S|VT|{year - 1}0829|12|{points}|RECHT|BEKOSTIGD||||||J|J"
    )


HISTORY = [
    f"VLP|{OWN}|20250411",
    _past("135792462|918273645", 2022, "H-1", "J|pi", "48.0|42,5"),
    _past("135792462|918273645", 2023, "H-2", "J|pd", "60.0|30.0"),
    f"HRR|864209753|918273811|2023|{OWN}|G-3|N|np|LAAG|1|60301|WO-BA|P|N|20230704|VT|20230707"
    "|RECHT|||||N|||J|J",
    _past("864209753|918273811", 2023, "H-3", "N|nf", "12.0|0"),
    _past("135792462|918273645", 2024, "H-4", "N|ng", "60.0|0"),
    f"HRR|246813577||2024|{OWN}|G-5|J|pg|HOOG|0.5|39255|HBO-MA|M|J|20240628|DT|20240701"
    "|GEZONDHEIDSZORG|OPEN_BESTEL||||J|||J|J",
    "SLR|4|2",
]
PROVISIONAL_NAME = f"VLPBEK_2026_20250122_{OWN}.csv"
FINAL_NAME = f"DEFBEK_2026_20250903_{OWN}.csv"
HISTORY_NAME = f"HISBEK_2025_20250411_{OWN}.csv"


def write_file(folder: Path, name: str, lines: list[str], encoding: str = "utf-8") -> Path:
    """A delivery as it arrives: CRLF line ends, filled up to at least 25 fields."""
    folder.mkdir(parents=True, exist_ok=True)
    padded = [line + "|" * max(0, 24 - line.count("|")) if line.strip() else line for line in lines]
    path = folder / name
    path.write_bytes("".join(line + "\r\n" for line in padded).encode(encoding))
    return path


def changed(lines: list[str], old: str, new: str) -> list[str]:
    assert any(old in line for line in lines), old
    return [line.replace(old, new) for line in lines]


def rows(df, *columns: str) -> list[tuple]:
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=str)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = new_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def standard(spark, tmp_path_factory):
    """The three deliveries of one institution, processed as one folder."""
    base = tmp_path_factory.mktemp("standard")
    write_file(base / "raw", PROVISIONAL_NAME, ANALYSIS)
    write_file(base / "raw" / "later", FINAL_NAME, FINAL)
    write_file(base / "raw", HISTORY_NAME, HISTORY)
    outcome = process_folder(
        spark, str(base / "raw"), str(base / "prepared"), str(base / "out"), TEST_KEY.encode()
    )
    return base, outcome
