"""Splitting lines into records and routing them by record type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundmart.functions.decode import typed as decoded
from fundmart.functions.pseudonym import hide_key, pseudonym
from fundmart.functions.text import clean, is_blank
from fundmart.layouts import (
    LABEL,
    LAYOUT_OF_KIND,
    LINE_NO,
    PERSON_FIELDS,
    ROW_NO,
    Record,
    load_layout,
    record_types,
)
from fundmart.session import Stage, small_side
from fundmart.sources.lines import block_offsets
from fundmart.sources.names import file_name, layout_of
from fundmart.texts import EXTRA_FIELDS, UNKNOWN_RECORD

SEPARATOR = r"\|"
BLANK = "leeg"
UNKNOWN = "onbekend"
LAYOUTS = tuple(dict.fromkeys(LAYOUT_OF_KIND.values()))


def parts(value: Column) -> Column:
    return F.split(value, SEPARATOR, -1)


def is_known(record_type: Column, layout: Column) -> Column:
    choice = F.lit(False)
    for name in LAYOUTS:
        choice = F.when(layout == name, record_type.isin(list(load_layout(name)))).otherwise(choice)
    return choice


def width(record_type: Column, layout: Column) -> Column:
    """Number of fields of a record type in its layout; null when unknown."""
    choice = F.lit(None).cast("int")
    for name in LAYOUTS:
        for rs, record in load_layout(name).items():
            known = (layout == name) & (record_type == rs)
            choice = F.when(known, len(record.fields)).otherwise(choice)
    return choice


def extra_filled(fields: Column, n: Column) -> Column:
    """How many fields past the layout hold something.

    Nearly always none: the fields are only gone through one by one when their
    text together is not blank.
    """
    tail = F.slice(fields, n + 1, F.greatest(F.size(fields) - n, F.lit(0)))
    return (
        F.when(n.isNull(), F.lit(None).cast("int"))
        .when((F.size(fields) <= n) | is_blank(F.array_join(tail, "")), 0)
        .otherwise(F.size(F.filter(tail, lambda x: ~is_blank(x))))
    )


def table_of(value: Column, record_type: Column, layout: Column) -> Column:
    """Where a line goes: its record type, ``onbekend`` or ``leeg``."""
    return (
        F.when(is_blank(value), BLANK)
        .when(is_known(record_type, layout), record_type)
        .otherwise(UNKNOWN)
    )


def text_fields(fields: Column, record: Record) -> list[Column]:
    """Text columns of a record: a short row is filled up, a long one cut off."""
    return [
        F.coalesce(F.get(fields, F.lit(i)), F.lit("")).alias(f.name)
        for i, f in enumerate(record.fields)
    ]


def split_records(
    lines: DataFrame, layout: dict[str, Record], value: str = "value", keep: tuple[str, ...] = ()
) -> dict[str, DataFrame]:
    """One frame of text columns per record type of ``layout``."""
    # A column of its own, so a line is split once and not once per field.
    cut = lines.select(*keep, parts(F.col(value)).alias("_velden"))
    fields = F.col("_velden")
    return {
        rs: cut.filter(F.get(fields, F.lit(0)) == rs).select(*keep, *text_fields(fields, record))
        for rs, record in layout.items()
    }


def reader_messages(
    lines: DataFrame, layout: dict[str, Record], value: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Lines that do not fit ``layout``: ``(*keep, Recordsoort, Melding)``."""
    fields = parts(F.col(value))
    record_type = F.get(fields, F.lit(0))
    n = F.lit(None).cast("int")
    for rs, record in layout.items():
        n = F.when(record_type == rs, len(record.fields)).otherwise(n)
    return (
        lines.filter(~is_blank(F.col(value)))
        .select(*keep, record_type.alias("Recordsoort"), n.alias("_n"), fields.alias("_f"))
        .withColumn("_extra", extra_filled(F.col("_f"), F.col("_n")))
        .filter("_n is null or _extra > 0")
        .select(*keep, "Recordsoort", message_text(F.col("_extra"), F.col("_n")).alias("Melding"))
    )


def message_text(extra: Column, n: Column) -> Column:
    return F.when(n.isNull(), UNKNOWN_RECORD).otherwise(F.format_string(EXTRA_FIELDS, extra, n))


def _hidden_person(fields: Column, n: Column, key: bytes | None) -> Column:
    """The record's fields up to its width, with the person fields as pseudonyms."""
    cut = F.slice(fields, 1, n)
    if key is None:
        return cut
    first, second = 1, 2
    for name in LAYOUTS:
        for record in load_layout(name).values():
            places = [i for i, f in enumerate(record.names()) if f in PERSON_FIELDS]
            if places not in ([], [first, second]):
                raise ValueError(f"Person fields of {record.name} are not at their fixed place")
    hidden = F.concat(
        F.slice(fields, 1, 1),
        F.array(*[pseudonym(clean(F.get(fields, F.lit(i))), key) for i in (first, second)]),
        F.slice(fields, 4, F.greatest(n - 3, F.lit(0))),
    )
    return F.when(F.col("tabel").isin(person_tables()), hidden).otherwise(cut)


def person_tables() -> list[str]:
    return [
        rs
        for rs in record_types()
        if any(PERSON_FIELDS[0] in load_layout(n)[rs].names() for n in LAYOUTS if rs in load_layout(n))
    ]


def route(lines: DataFrame, key: bytes | None) -> DataFrame:
    """Lines as rows of one staged table, person numbers already hidden.

    Columns: delivery label, file block and position, ``tabel`` (partition of
    the staged table), the fields, and how many filled fields lie past the layout.
    Unknown lines keep only their record type, never their content.
    """
    if key is not None:
        hide_key(lines.sparkSession)
    # Names that got here match the name pattern, so a space is the only character
    # a URL encodes, and the extension has four characters.
    name = F.replace(file_name(F.col("uri")), F.lit("%20"), F.lit(" "))
    record_type = F.get(F.col("_f"), F.lit(0))
    known = F.col("tabel").isin(record_types())
    return (
        lines.withColumn("_f", parts(F.col("value")))
        .withColumn("indeling", layout_of(F.upper(F.substring(name, 1, 6))))
        .withColumn("tabel", table_of(F.col("value"), record_type, F.col("indeling")))
        .withColumn("_w", width(record_type, F.col("indeling")))
        .select(
            F.substr(name, F.lit(1), F.length(name) - 4).alias(LABEL),
            "uri",
            "block_start",
            "_m",
            "indeling",
            "tabel",
            record_type.alias("rs"),
            F.when(known, _hidden_person(F.col("_f"), F.col("_w"), key)).alias("velden"),
            F.when(known, extra_filled(F.col("_f"), F.col("_w"))).alias("extra"),
            F.col("_w").alias("breedte"),
        )
    )


def stage_lines(stage: Stage, routed: DataFrame) -> DataFrame:
    """Write routed lines and read them with ``_n``, their place in the staged file.

    A task writes its lines in source order to one file per table, so inside a file block
    the place counts the lines of that table; a local sort makes sure of the order.
    """
    staged = stage.write(routed.sortWithinPartitions("tabel", "_m"), "lines", ("tabel",))
    return staged.select("*", F.col("_metadata.row_index").alias("_n"))


def split_table(staged: DataFrame) -> DataFrame:
    """One row per file block and table: row count and the bases of both numbers.

    ``_m + line_base`` is the 1-based line number in the file; ``_n + row_base``
    the 0-based row number of its record type in the delivery.
    """
    counted = staged.groupBy(LABEL, "uri", "block_start", "tabel").agg(
        F.count("*").alias("n"), F.min("_m").alias("_m0"), F.min("_n").alias("_n0")
    )
    blocks = counted.groupBy("uri", "block_start").agg(
        F.sum("n").alias("_lines"), F.min("_m0").alias("_first")
    )
    lines = block_offsets(blocks, ["uri"], "_lines", "_before").select(
        "uri", "block_start", (F.col("_before") - F.col("_first") + 1).alias("line_base")
    )
    rows = block_offsets(counted, ["uri", "tabel"], "n", "_rows")
    return rows.join(lines, ["uri", "block_start"]).select(
        LABEL,
        "uri",
        "block_start",
        "tabel",
        "n",
        "line_base",
        (F.col("_rows") - F.col("_n0")).alias("row_base"),
    )


def numbered_table(staged: DataFrame, splits: DataFrame, table: str) -> DataFrame:
    """Rows of one staged table with ``_regelnr`` and ``_rijnr``.

    The join key is a file block, so its groups are bounded by the block size
    whichever way Spark joins.
    """
    bases = splits.filter(F.col("tabel") == table).select(
        "uri", "block_start", "line_base", "row_base"
    )
    return (
        staged.filter(F.col("tabel") == table)
        .join(small_side(bases), ["uri", "block_start"])
        .withColumn(LINE_NO, F.col("_m") + F.col("line_base"))
        .withColumn(ROW_NO, F.col("_n") + F.col("row_base"))
    )


def typed_table(staged: DataFrame, splits: DataFrame, rs: str) -> DataFrame:
    """A record type, decoded with the layout of its delivery, over all layouts."""
    numbered = numbered_table(staged, splits, rs)
    typed = [
        decoded(
            load_layout(name)[rs],
            numbered.filter(F.col("indeling") == name),
            lambda i, _: F.get("velden", F.lit(i)),
            (LABEL, LINE_NO, ROW_NO),
        )
        for name in LAYOUTS
        if rs in load_layout(name)
    ]
    result = typed[0]
    for other in typed[1:]:
        result = result.unionByName(other, allowMissingColumns=True)
    return result


def staged_messages(staged: DataFrame, splits: DataFrame) -> DataFrame:
    """Reader messages with line numbers: ``(levering, Regelnummer, Recordsoort, Melding)``."""
    odd = staged.filter((F.col("tabel") == UNKNOWN) | (F.col("extra") > 0))
    bases = splits.select("uri", "block_start", "tabel", "line_base")
    text = F.when(F.col("tabel") == UNKNOWN, UNKNOWN_RECORD).otherwise(
        F.format_string(EXTRA_FIELDS, "extra", "breedte")
    )
    return odd.join(bases, ["uri", "block_start", "tabel"]).select(
        LABEL,
        (F.col("_m") + F.col("line_base")).alias("Regelnummer"),
        F.col("rs").alias("Recordsoort"),
        text.alias("Melding"),
    )
