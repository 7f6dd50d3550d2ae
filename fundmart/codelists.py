"""Code lists: small fixed tables, as literal rows or from a CSV the user gives."""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Published codes and descriptions, as CSV text with a header.
_LISTS = {
    "bekostigingscode": """
Code,Omschrijving
BEKOSTIGD,Bekostigd
OPEN_BESTEL,Open bestel (experiment)
""",
    "bekostigingsniveau": """
Code,Omschrijving
LAAG,Laag
HOOG,Hoog
TOP,Top
""",
    "bekostigingstatus": """
Code,Omschrijving,Groep,Bekostigd
pi,De inschrijving wordt bekostigd,Wel bekostigd,J
pd,De inschrijving wordt deels bekostigd,Wel bekostigd,J
pg,De graad wordt bekostigd,Wel bekostigd,J
pb,"Ongedeelde opleiding: alleen de (impliciete) BA-graad wordt bekostigd, niet de MA-graad",Wel bekostigd,J
pm,"Ongedeelde opleiding: alleen de MA-graad wordt bekostigd, niet de (impliciete) BA-graad",Wel bekostigd,J
po,Ongedeelde opleiding: zowel de (impliciete) BA- als de MA-graad wordt bekostigd,Wel bekostigd,J
ex,Het betreft een extraneus-inschrijving,Status van de student,N
jk,Meerdere eerste inschrijvingen aangeleverd voor verschillende opleidingen,Status van de student,N
jl,Geen opleiding van eerste inschrijving (eerste inschrijving is N),Status van de student,N
jm,Meerdere eerste inschrijvingen voor dezelfde opleiding aan dezelfde instelling,Status van de student,N
na,De student voldoet niet aan het woonplaatsvereiste,Status van de student,N
nr,De student voldoet niet aan het nationaliteitsvereiste,Status van de student,N
nb,Niet bekostigd i.v.m. eerder behaalde graad/graden,Verbruik en limieten,N
nd,De student heeft al eerder een MA-graad behaald,Verbruik en limieten,N
nf,Maximaal aantal bekostigde inschrijvingen overschreden (rekening houdend met eerdere graden),Verbruik en limieten,N
ng,Maximaal aantal bekostigde inschrijvingen overschreden (nog geen graad behaald),Verbruik en limieten,N
nh,Ongedeelde opleiding: toegestane te bekostigen jaren MA verbruikt,Verbruik en limieten,N
ni,Ongedeelde opleiding: toegestane jaren MA in een uitzonderingscategorie verbruikt,Verbruik en limieten,N
nk,Toegestane te bekostigen jaren of studielast MA verbruikt,Verbruik en limieten,N
ne,Geen voor bekostiging relevante graad of een AD-graad,Graad-specifiek,N
np,Graad die niet voor bekostiging in aanmerking komt (opleidingsfase P of D of A),Graad-specifiek,N
ns,Aan verschillende instellingen op dezelfde dag een zelfde soort graad behaald,Graad-specifiek,N
nt,"Meerdere graden aan dezelfde instelling, slechts één wordt bekostigd",Graad-specifiek,N
no,Ongedeelde opleiding waarvan de behaalde graden (BA en MA) beide niet bekostigd worden,Graad-specifiek,N
mt,De graad is behaald na de peilperiode,Tijdvak,N
mu,De graad is behaald vóór de peilperiode,Tijdvak,N
mv,De inschrijving is niet geldig op de peildatum / valt buiten het bekostigingsjaar,Tijdvak,N
mw,Graad zonder bijbehorende op datum diploma geldige inschrijving,Tijdvak,N
ob,Datum diploma valt niet in de accreditatieperiode,Opleiding,N
oc,Het betreft geen geaccrediteerde opleiding,Opleiding,N
ti,De inschrijving is niet tijdig aangeleverd,Aanlevering,N
tg,De graad is niet tijdig aangeleverd,Aanlevering,N
nl,Aangeleverd met de markering om niet te bekostigen,Aanlevering,N
nc,Niet bekostigd vanuit de conversie naar HORS,Overig,N
""",
    "indicatiebama": """
Code,Omschrijving
B,Bachelor
M,Master
A,Master met impliciete bachelor
D,Associate Degree
""",
    "inschrijvingsvorm": """
Code,Omschrijving
E,Extraneus
S,Student
""",
    "inschrijvingsvorm_hisbek": """
Code,Omschrijving
A,Auditor
E,Extraneus
S,Student
T,Toegelaten student
""",
    "onderwijsvorm": """
Code,Omschrijving
VT,Voltijd
DT,Deeltijd
DU,Duaal
""",
    "opleidingonderdeel": """
Code,Omschrijving
ECONOMIE,Economie
GEDRAG_EN_MAATSCHAPPIJ,Gedrag en maatschappij
GEZONDHEIDSZORG,Gezondheidszorg
LANDBOUW_EN_NATUURLIJKE_OMGEVING,Landbouw en natuurlijke omgeving
NATUUR,Natuur
ONDERWIJS,Onderwijs
RECHT,Recht
SECTOROVERSTIJGEND,Sectoroverstijgend
TAAL_EN_CULTUUR,Taal en cultuur
TECHNIEK,Techniek
""",
    "opleidingsfase": """
Code,Omschrijving
1,Eerste fase
2,Tweede fase
A,Associate Degree
B,Bachelor
D,Propedeuse bachelor
I,Initiële opleiding
K,Kandidaats
L,Universitaire lerarenopleiding (ULO)
M,Master
P,Propedeuse
S,Schakelprogramma
T,Tussentijds doctoraal examen
V,Vervolg of voortgezette opleiding
W,Voortgezette opleiding
""",
    "opleidingsniveau": """
Code,Omschrijving
HBO-AD,HBO Associate Degree
HBO-BA,HBO Bachelor
HBO-MA,HBO Master
HBO-O,HBO Ongedeeld
WO-BA,WO Bachelor
WO-MA,WO Master
WO-O,WO Ongedeeld
""",
}


def _rows(name: str) -> list[dict[str, str]]:
    if name not in _LISTS:
        raise FileNotFoundError(f"Code list not found: {name}")
    return list(csv.DictReader(io.StringIO(_LISTS[name].strip())))


def codes(name: str) -> list[str]:
    """Valid codes of a list, for literal membership tests inside expressions."""
    return [row["Code"] for row in _rows(name)]


def code_list(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """A code list as a DataFrame with text columns only.

    Literal rows need no file on the executors; ``path`` reads a CSV instead.
    """
    if path is not None:
        return spark.read.csv(path, header=True, inferSchema=False)
    rows = _rows(name)
    columns = list(rows[0])
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], schema)
