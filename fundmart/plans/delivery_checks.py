"""All checks on prepared deliveries, over many deliveries at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundmart.codelists import codes
from fundmart.layouts import (
    ANALYSIS,
    HEADER,
    LABEL,
    LAYOUT_OF_KIND,
    LINE_NO,
    TRAILER,
    load_layout,
    merged_record,
    record_types,
    typed_schema,
)
from fundmart.operators import checks
from fundmart.operators.merge import stack_tables
from fundmart.sources.names import layout_of
from fundmart.texts import (
    BRIN_DIFFERS,
    EMPTY_FIELD,
    MESSAGE_COLUMNS,
    NO_TRAILER,
    ONE_ROW,
    SEVERITY,
    TRAILER_DIFFERS,
    UNKNOWN_CODE,
    YEAR_DIFFERS,
)

ORDER = "_orde"
MESSAGE_SCHEMA = (
    "Controle string, Recordsoort string, Melding string, Aantal bigint, Ernst string"
)


def message_columns(
    check: str, record_type: Column, text: Column, count: Column, severity: str
) -> list[Column]:
    values = (F.lit(check), record_type, text, count.cast("bigint"), F.lit(severity))
    return [v.alias(name) for name, v in zip(MESSAGE_COLUMNS, values)]


def _messages(
    df: DataFrame, check: str, record_type: Column, text: Column, count: Column, *order: Column
) -> DataFrame:
    """Message rows plus their place in the report: check, then ``order``."""
    place = F.concat_ws("/", F.lit(str(list(SEVERITY).index(check))), *order)
    return df.select(
        LABEL,
        *message_columns(check, record_type, text, count, SEVERITY[check]),
        place.alias(ORDER),
    )


def _digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 19, "0")


def _place(value: Column, names: list[str]) -> Column:
    """Position of a name in the declared order, as sortable text."""
    listed = F.array(*[F.lit(n) for n in names]).cast("array<string>")
    return _digits(F.array_position(listed, value))


def _rs_place(record_type: Column) -> Column:
    return _place(record_type, record_types())


def reading(reader: DataFrame) -> DataFrame:
    """Reader messages counted per record type and text, in order of first line."""
    counted = reader.groupBy(LABEL, "Recordsoort", "Melding").agg(
        F.count("*").alias("n"), F.min("Regelnummer").alias("eerste")
    )
    return _messages(
        counted,
        "Inlezen",
        F.col("Recordsoort"),
        F.col("Melding"),
        F.col("n"),
        _digits(F.col("eerste")),
    )


def first_row(df: DataFrame, group: list[str], columns: list[str], order: str = LINE_NO) -> DataFrame:
    """The first row per group in source order, as an aggregate."""
    picked = F.min_by(F.struct(*columns), order).alias("_eerste")
    return df.groupBy(*group).agg(picked).select(*group, "_eerste.*")


def record_counts(
    deliveries: DataFrame, trailer: DataFrame, counts: DataFrame
) -> DataFrame:
    """Trailer counts against the rows found, and deliveries without a trailer."""
    parts = []
    with_kind = deliveries.select(LABEL, layout_of(F.col("Soort")).alias("indeling"))
    for name in dict.fromkeys(LAYOUT_OF_KIND.values()):
        declared_in = list(load_layout(name)[TRAILER].declared_counts())
        first = first_row(trailer, [LABEL], declared_in).join(
            with_kind.filter(F.col("indeling") == name), LABEL, "left_semi"
        )
        declared = checks.unpivot(first, [LABEL], declared_in, "_veld", "gemeld").withColumn(
            "tabel", F.substring("_veld", 7, 3)
        )
        found = counts.select(LABEL, "tabel", F.col("n").alias("gevonden"))
        differs = checks.trailer_differences(declared, found, [LABEL], "tabel")
        text = F.format_string(
            TRAILER_DIFFERS, F.coalesce(F.col("gemeld").cast("string"), F.lit("None")), "gevonden"
        )
        parts.append(
            _messages(
                differs,
                "Aantal records",
                F.col("tabel"),
                text,
                F.lit(1),
                _place(F.col("_veld"), declared_in),
            )
        )
    without = deliveries.join(
        counts.filter(F.col("tabel") == TRAILER).select(LABEL), LABEL, "left_anti"
    )
    parts.append(
        _messages(without, "Aantal records", F.lit(TRAILER), F.lit(NO_TRAILER), F.lit(1), F.lit("0"))
    )
    return stack_tables(parts)


def single_rows(counts: DataFrame) -> DataFrame:
    """Record types that must have one row and have another number."""
    single = [rs for rs, record in load_layout(ANALYSIS).items() if record.single_row]
    wrong = counts.filter(F.col("tabel").isin(single) & (F.col("n") != 1))
    return _messages(
        wrong,
        "Eén rij",
        F.col("tabel"),
        F.format_string(ONE_ROW, "n"),
        F.lit(1),
        _rs_place(F.col("tabel")),
    )


def _per_record_type(tables: dict[str, DataFrame], deliveries: DataFrame, build) -> list[DataFrame]:
    """Run ``build`` per layout and record type; header and trailer occur in both layouts."""
    kinds = deliveries.select(LABEL, layout_of(F.col("Soort")).alias("indeling"))
    parts = []
    for name in dict.fromkeys(LAYOUT_OF_KIND.values()):
        for rs, record in load_layout(name).items():
            if rs not in tables:
                continue
            df = tables[rs]
            if record.single_row:
                df = df.join(kinds.filter(F.col("indeling") == name), LABEL, "left_semi")
            parts.append(build(df, rs, record))
    return [p for p in parts if p is not None]


EMPTY_CHECK, CODE_CHECK = "Verplicht veld", "Codelijst"


def field_checks(tables: dict[str, DataFrame], deliveries: DataFrame) -> list[DataFrame]:
    """Empty required fields and unknown codes: one scan and one aggregate per record type."""
    def build(df: DataFrame, rs: str, record) -> DataFrame | None:
        required = record.required()
        lists = {f: codes(name) for f, name in record.code_lists().items()}
        if not required and not lists:
            return None
        found = checks.field_findings(df, [LABEL], required, lists)

        def either(empty: Column, unknown: Column) -> Column:
            return F.when(F.col("code").isNull(), empty).otherwise(unknown)

        number, severity = (
            either(F.lit(of[EMPTY_CHECK]), F.lit(of[CODE_CHECK]))
            for of in ({c: str(i) for i, c in enumerate(SEVERITY)}, SEVERITY)
        )
        values = (
            either(F.lit(EMPTY_CHECK), F.lit(CODE_CHECK)),
            F.lit(rs),
            either(
                F.format_string(EMPTY_FIELD, "veld"), F.format_string(UNKNOWN_CODE, "veld", "code")
            ),
            F.col("aantal").cast("bigint"),
            severity,
        )
        field = either(_place(F.col("veld"), required), _place(F.col("veld"), list(lists)))
        # An empty field has no code, which leaves no trace in the place.
        place = F.concat_ws("/", number, _rs_place(F.lit(rs)), field, F.col("code"))
        named = [v.alias(name) for name, v in zip(MESSAGE_COLUMNS, values, strict=True)]
        return found.select(LABEL, *named, place.alias(ORDER))

    return _per_record_type(tables, deliveries, build)


def header_differences(deliveries: DataFrame, header: DataFrame) -> DataFrame:
    """File name against header: institution (error), and year where the header has one."""
    first = first_row(header, [LABEL], ["BRIN", "Bekostigingsjaar"]).select(
        LABEL, F.col("BRIN").alias("brin_kop"), F.col("Bekostigingsjaar").alias("jaar_kop")
    )
    both = deliveries.join(first, LABEL)
    brin = both.filter(~F.col("BRIN").eqNullSafe(F.col("brin_kop")))
    year = both.filter(
        (layout_of(F.col("Soort")) == ANALYSIS)
        & ~F.col("Bekostigingsjaar").eqNullSafe(F.col("jaar_kop"))
    )

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("None"))

    return stack_tables(
        [
            _messages(
                brin,
                "BRIN",
                F.lit(HEADER),
                F.format_string(BRIN_DIFFERS, "BRIN", shown("brin_kop")),
                F.lit(1),
            ),
            _messages(
                year,
                "Bekostigingsjaar",
                F.lit(HEADER),
                F.format_string(YEAR_DIFFERS, "Bekostigingsjaar", shown("jaar_kop")),
                F.lit(1),
            ),
        ]
    )


def check_deliveries(
    tables: dict[str, DataFrame],
    reader: DataFrame,
    deliveries: DataFrame,
    counts: DataFrame,
) -> DataFrame:
    """All messages of all deliveries: label, message columns, report order.

    ``tables`` are the prepared record tables, ``counts`` the rows per delivery
    and record type (``levering, tabel, n``). Deliveries without a header are not
    among ``deliveries``; they are refused before this point.
    """
    # Header and trailer differ per layout; a column only the other one has is null.
    for rs in (HEADER, TRAILER):
        missing = [f for f in typed_schema(merged_record(rs)).fields if f.name not in tables[rs].columns]
        filled = {f.name: F.lit(None).cast(f.dataType) for f in missing}
        tables = {**tables, rs: tables[rs].withColumns(filled)}
    return stack_tables(
        [
            reading(reader),
            record_counts(deliveries, tables[TRAILER], counts),
            single_rows(counts),
            *field_checks(tables, deliveries),
            header_differences(deliveries, tables[HEADER]),
        ]
    )


def empty_messages(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], f"Bron string, {MESSAGE_SCHEMA}")


def with_source(messages: DataFrame, source: Column | str) -> DataFrame:
    """Report rows: the messages with where they come from."""
    origin = F.lit(source) if isinstance(source, str) else source
    return messages.select(origin.alias("Bron"), *MESSAGE_COLUMNS)
