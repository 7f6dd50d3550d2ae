"""Record layouts: which fields a record type has, in file order, and their types.

A layout is declared as text, one line per field, because position is meaning:
the raw files carry no header. Everything else (typed schemas, decode
expressions, required-field and code-list checks) is derived from it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

from pyspark.sql import types as T

LABEL = "levering"
LINE_NO = "_regelnr"
ROW_NO = "_rijnr"
RAW_SUFFIX = "_Ruw"
NOT_APPLICABLE_SUFFIX = "_NVT"
STATUS = "CodeBekostigingstatus"
PERSON_FIELDS = ("Burgerservicenummer", "Onderwijsnummer")
HEADER = "VLP"
TRAILER = "SLR"

ANALYSIS = "analyse"
HISTORY = "hisbek"
LAYOUT_OF_KIND = {"VLPBEK": ANALYSIS, "DEFBEK": ANALYSIS, "HISBEK": HISTORY}
LAYOUT_VERSION = "26.3.1"

# The published field layouts, in file order. A record type starts
# at the margin ("single" = exactly one row per file). A field line reads: name,
# type, then options: "required", "na" (-1 means not applicable) and
# "list:<code list>".
_LAYOUT_TEXT = {
    ANALYSIS: """
VLP single
  Recordsoort text required
  BRIN text required
  Bekostigingsjaar int required
  DatumAanmaak date required
BLB
  Recordsoort text required
  Burgerservicenummer text
  Onderwijsnummer text
  DatumGraadBehaaldAD date
  DatumGraadBehaaldADLG date
  DatumGraadBehaaldBa date
  DatumGraadBehaaldBaLG date
  DatumGraadBehaaldMa date
  DatumGraadBehaaldMaLG date
  VerbruikAD int na
  VerbruikADLG int na
  VerbruikBA int na
  VerbruikBALG int na
  VerbruikMA int na
  VerbruikMALG int na
  AantalBekostigdeInschrijvingenBa int na
  AantalBekostigdeInschrijvingenBaLG int na
  AantalBekostigdeInschrijvingenMa int na
  AantalBekostigdeInschrijvingenMaLG int na
  AantalBekostigdeInschrijvingenBaLGnaGraadBaMa int na
  AantalBekostigdeInschrijvingenMaLGnaGraadMa int na
BRD
  Recordsoort text required
  Burgerservicenummer text
  Onderwijsnummer text
  BRIN text required
  Inschrijvingvolgnummer text required
  Bekostigingsindicatie bool required
  CodeBekostigingstatus text required list:bekostigingstatus
  Bekostigingsniveau text list:bekostigingsniveau
  Opleidingscode text required
  Opleidingsniveau text required list:opleidingsniveau
  Opleidingsfase text required list:opleidingsfase
  DatumInschrijving date required
  DatumUitschrijving date required
  EersteInschrijving bool required
  Inschrijvingsvorm text required list:inschrijvingsvorm
  Onderwijsvorm text required list:onderwijsvorm
  DatumEersteAanlevering date required
  Bekostigingsduur int
  OpleidingOnderdeel text list:opleidingonderdeel
  Bekostigingscode text list:bekostigingscode
  IndicatieSectorLG bool
  IndicatieBaMa text list:indicatiebama
  IndicatieAcademischZiekenhuis bool
  IndicatieNationaliteitsvoorwaardeSF bool
  IndicatieGBARelatie bool
BRR
  Recordsoort text required
  Burgerservicenummer text
  Onderwijsnummer text
  BRIN text required
  Resultaatvolgnummer text required
  Bekostigingsindicatie bool required
  CodeBekostigingstatus text required list:bekostigingstatus
  Bekostigingsniveau text required list:bekostigingsniveau
  JointDegreeFactor float
  Opleidingscode text required
  Opleidingsniveau text required list:opleidingsniveau
  Opleidingsfase text required list:opleidingsfase
  EersteGraad bool required
  DatumDiploma date required
  Onderwijsvorm text required list:onderwijsvorm
  DatumEersteAanlevering date required
  OpleidingOnderdeel text list:opleidingonderdeel
  Bekostigingscode text list:bekostigingscode
  IndicatieSectorLG bool
  IndicatieBaMa text list:indicatiebama
  IndicatieAcademischZiekenhuis bool
  IndicatieGraadTeltVoorBekostigingsloopbaan bool required
  IndicatieNationaliteitsvoorwaardeSF bool required
  IndicatieGBARelatie bool required
SLR single
  Recordsoort text required
  AantalBLBrecords int required
  AantalBRDrecords int required
  AantalBRRrecords int required
""",
    HISTORY: """
VLP single
  Recordsoort text required
  BRIN text required
  DatumAanmaak date required
HRD
  Recordsoort text required
  Burgerservicenummer text
  Onderwijsnummer text
  Bekostigingsjaar int required
  BRIN text required
  Inschrijvingvolgnummer text
  Bekostigingsindicatie bool required
  CodeBekostigingstatus text required list:bekostigingstatus
  Bekostigingsniveau text list:bekostigingsniveau
  Opleidingscode text required
  Opleidingsniveau text required list:opleidingsniveau
  Opleidingsfase text required list:opleidingsfase
  DatumInschrijving date required
  DatumUitschrijving date required
  EersteInschrijving bool required
  Inschrijvingsvorm text required list:inschrijvingsvorm_hisbek
  Onderwijsvorm text required list:onderwijsvorm
  DatumEersteAanlevering date
  Bekostigingsduur int
  ECTS float
  ECTSBekostigd float
  OpleidingOnderdeel text list:opleidingonderdeel
  Bekostigingscode text list:bekostigingscode
  IndicatieSectorLG bool
  IndicatieBaMa text list:indicatiebama
  IndicatieAcademischZiekenhuis bool
  DuitseDeelstaat text
  IndicatieWoonplaatsVereiste bool
  IndicatieNationaliteitsvoorwaardeSF bool required
  IndicatieGBARelatie bool
HRR
  Recordsoort text required
  Burgerservicenummer text
  Onderwijsnummer text
  Bekostigingsjaar int required
  BRIN text required
  Resultaatvolgnummer text
  Bekostigingsindicatie bool required
  CodeBekostigingstatus text required list:bekostigingstatus
  Bekostigingsniveau text list:bekostigingsniveau
  JointDegreeFactor float required
  Opleidingscode text required
  Opleidingsniveau text required list:opleidingsniveau
  Opleidingsfase text required list:opleidingsfase
  EersteGraad bool required
  DatumDiploma date
  Onderwijsvorm text required list:onderwijsvorm
  DatumEersteAanlevering date
  OpleidingOnderdeel text list:opleidingonderdeel
  Bekostigingscode text list:bekostigingscode
  IndicatieSectorLG bool
  IndicatieBaMa text list:indicatiebama
  IndicatieAcademischZiekenhuis bool
  IndicatieGraadTeltVoorBekostigingsloopbaan bool required
  DuitseDeelstaat text
  IndicatieWoonplaatsVereiste bool
  IndicatieNationaliteitsvoorwaardeSF bool required
  IndicatieGBARelatie bool
SLR single
  Recordsoort text required
  AantalHRDrecords int required
  AantalHRRrecords int required
""",
}

SPARK_TYPE = {
    "text": T.StringType(),
    "date": T.DateType(),
    "bool": T.BooleanType(),
    "int": T.LongType(),
    "float": T.DoubleType(),
}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    required: bool = False
    not_applicable: bool = False
    code_list: str | None = None


@dataclass(frozen=True)
class Record:
    """One record type: its fields in file order."""

    name: str
    fields: tuple[Field, ...]
    single_row: bool = False

    def names(self, kind: str | None = None) -> list[str]:
        return [f.name for f in self.fields if kind in (None, f.kind)]

    def code_lists(self) -> dict[str, str]:
        return {f.name: f.code_list for f in self.fields if f.code_list}

    def required(self) -> list[str]:
        return [f.name for f in self.fields if f.required]

    def declared_counts(self) -> dict[str, str]:
        """Trailer fields ``Aantal<rs>records`` -> record type they declare."""
        return {
            n: n[6:9]
            for n in self.names()
            if n.startswith("Aantal") and n.endswith("records") and len(n) == 16
        }


def parse_layout(text: str) -> dict[str, Record]:
    """Read layout text (see ``_LAYOUT_TEXT``) into records, in declared order."""
    found: dict[str, tuple[bool, list[Field]]] = {}
    fields: list[Field] = []
    for line in filter(str.strip, text.splitlines()):
        words = line.split()
        if not line[0].isspace():
            fields = []
            found[words[0]] = ("single" in words, fields)
            continue
        name, kind, *options = words
        if kind not in SPARK_TYPE:
            raise ValueError(f"Unknown field type {kind!r} for {name}")
        lists = [o.removeprefix("list:") for o in options if o.startswith("list:")]
        fields.append(
            Field(
                name,
                kind,
                "required" in options,
                "na" in options,
                lists[0] if lists else None,
            )
        )
    return {n: Record(n, tuple(fs), single) for n, (single, fs) in found.items()}


@cache
def load_layout(name: str) -> dict[str, Record]:
    """Records of a layout (``analyse`` or ``hisbek``)."""
    if name not in _LAYOUT_TEXT:
        raise FileNotFoundError(f"Layout not found: {name}")
    return parse_layout(_LAYOUT_TEXT[name])


def record_types() -> list[str]:
    """All known record types, over all layouts, in declared order."""
    return list(dict.fromkeys(rs for name in _LAYOUT_TEXT for rs in load_layout(name)))


def merged_record(rs: str) -> Record:
    """A record type over all layouts that have it (header and trailer differ)."""
    fields: dict[str, Field] = {}
    single = False
    for name in _LAYOUT_TEXT:
        record = load_layout(name).get(rs)
        if record:
            single = record.single_row
            for f in record.fields:
                fields.setdefault(f.name, f)
    if not fields:
        raise KeyError(f"Record type {rs} is in no layout")
    return Record(rs, tuple(fields.values()), single)


def typed_schema(record: Record) -> T.StructType:
    """Spark schema after decoding, without the helper columns."""
    return T.StructType([T.StructField(f.name, SPARK_TYPE[f.kind]) for f in record.fields])


def helper_schema(record: Record) -> T.StructType:
    """Extra columns decoding adds: raw text of bad dates, not-applicable flags."""
    raw = [T.StructField(n + RAW_SUFFIX, T.StringType()) for n in record.names("date")]
    flags = [
        T.StructField(f.name + NOT_APPLICABLE_SUFFIX, T.BooleanType())
        for f in record.fields
        if f.not_applicable
    ]
    return T.StructType(raw + flags)


def prepared_schema(record: Record) -> T.StructType:
    """Full fixed schema of a prepared record table."""
    position = [T.StructField(LINE_NO, T.LongType()), T.StructField(ROW_NO, T.LongType())]
    return T.StructType(
        [T.StructField(LABEL, T.StringType())]
        + typed_schema(record).fields
        + helper_schema(record).fields
        + position
    )


def degree_dates() -> list[str]:
    return merged_record("BLB").names("date")
