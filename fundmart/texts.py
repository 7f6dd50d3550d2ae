"""Names and texts that end up in results: checks, severities, message wording."""

from __future__ import annotations

ERROR = "error"
WARNING = "warning"
OK = "ok"
WARN = "warn"
FAIL = "fail"

MESSAGE_COLUMNS = ("Controle", "Recordsoort", "Melding", "Aantal", "Ernst")
SOURCE = "Bron"
REPORT_COLUMNS = (SOURCE, *MESSAGE_COLUMNS)
STAR_SOURCE = "star schema"

# Severity per check. An unknown code is a warning (the status
# dimension takes it in as unknown); so is a year that differs between file name
# and header. A file that cannot be processed is an error; a duplicate a warning.
SEVERITY = {
    "Inlezen": ERROR,
    "Aantal records": ERROR,
    "Eén rij": ERROR,
    "Verplicht veld": ERROR,
    "BRIN": ERROR,
    "Bekostigingsjaar": WARNING,
    "Codelijst": WARNING,
}
FILE_SEVERITY = {"Bestand": ERROR, "Dubbel": WARNING}
CONTRACT_SEVERITY = {"Uniciteit": ERROR, "Lege sleutel": ERROR, "Koppeling": ERROR}

# Message texts; %s and %d are filled by Spark's format_string.
UNKNOWN_RECORD = "Onbekende recordsoort"
EXTRA_FIELDS = "%d meer gevulde velden dan het schema (%d)"
NO_TRAILER = "Geen sluitrecord (SLR)"
TRAILER_DIFFERS = "SLR meldt %s, gevonden %d"
ONE_ROW = "Verwacht 1 rij, gevonden %d"
EMPTY_FIELD = "%s is leeg"
UNKNOWN_CODE = "%s: onbekende code '%s'"
BRIN_DIFFERS = "BRIN in bestandsnaam (%s) wijkt af van VLP (%s)"
YEAR_DIFFERS = "Jaar in bestandsnaam (%d) wijkt af van VLP (%s)"
NO_HEADER = "Geen voorlooprecord (VLP) in %s"
EMPTY_FILE = "Leeg bestand: %s"
DUPLICATE_FILE = (
    "Dubbel: een bestand met dezelfde naam (%s) is al verwerkt; overgeslagen."
)
UNKNOWN_FILE = (
    "Onbekend bestandstype: %s. Verwacht TTTTTT_JJJJ_EEJJMMDD_99XX.csv met TTTTTT in %s."
)
OUTDATED = (
    "Prepared-map zonder ernst per melding (van vóór de kwaliteitspoort); "
    "verwerk het bestand opnieuw."
)
DUPLICATE_KEY = "%d rijen met een dubbele sleutel (%s)"
ORPHANS = "%d waarden van %s ontbreken in %s"
MIXED_PSEUDONYMS = (
    "De leveringen zijn deels wel en deels niet gepseudonimiseerd. "
    "Verwerk ze allemaal met dezelfde keuze voor pseudonimisering."
)
GATE_CLOSED = "Kwaliteitsstatus fail: %d error(s); %s."
UNKNOWN_STATUS = ("Onbekende code (niet in de PvE)", "Onbekend")
UNKNOWN_LABEL = "onbekend"
FUNNEL_STEPS = ("In bestand", "Beoordeeld", "Bekostigd")
