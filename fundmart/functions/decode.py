"""Typed columns from the text of a record, driven by its layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundmart.functions.text import clean, normalise_codes
from fundmart.layouts import (
    NOT_APPLICABLE_SUFFIX,
    RAW_SUFFIX,
    STATUS,
    Field,
    Record,
)

DATE_FORMAT = "yyyyMMdd"
NOT_APPLICABLE = "-1"
_DECIMAL = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?|nan)$"


def to_date(text: Column) -> Column:
    """Eight digits that are a day. A text of another shape would cost an exception."""
    return F.when(text.rlike("^[0-9]{8}$"), F.try_to_date(text, DATE_FORMAT))


def to_boolean(text: Column) -> Column:
    return F.when(text == "J", True).when(text == "N", False)


def to_long(text: Column) -> Column:
    """A whole number. The cast signals other text by a costly exception, so test first."""
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("bigint"))


def to_double(text: Column) -> Column:
    """Decimal point or comma; type suffixes that Spark would accept (``1d``) do not count."""
    number = F.regexp_replace(text, r"^([^,]*),", "$1.")
    return F.when(number.rlike(_DECIMAL), number.try_cast("double"))


def is_not_applicable(text: Column) -> Column:
    return F.coalesce(text == NOT_APPLICABLE, F.lit(False))


def without_not_applicable(text: Column) -> Column:
    return F.nullif(text, F.lit(NOT_APPLICABLE))


_BY_KIND = {
    "text": lambda text: text,
    "date": to_date,
    "bool": to_boolean,
    "int": to_long,
    "float": to_double,
}


def field_text(field: Field, raw: Column) -> Column:
    text = clean(raw)
    return normalise_codes(text) if field.name == STATUS else text


def typed(record: Record, df: DataFrame, text_of, keep: tuple[str, ...]) -> DataFrame:
    """Columns of ``prepared_schema`` for a record: typed fields, raw dates, flags.

    ``text_of(position, field)`` gives the raw text column of a field. The three
    selects keep an expression that is used twice from being computed twice: Spark
    does not merge projections then.
    """
    dates = [f.name for f in record.fields if f.kind == "date"]
    flagged = [f.name for f in record.fields if f.not_applicable]
    texts = df.select(
        *keep, *[field_text(f, text_of(i, f)).alias(f.name) for i, f in enumerate(record.fields)]
    )

    def value(field: Field) -> Column:
        text = F.col(field.name)
        if field.not_applicable:
            text = without_not_applicable(text)
        return _BY_KIND[field.kind](text).alias(field.name)

    values = texts.select(
        *keep,
        *[value(f) for f in record.fields],
        *[F.col(n).alias(n + RAW_SUFFIX) for n in dates],
        *[is_not_applicable(F.col(n)).alias(n + NOT_APPLICABLE_SUFFIX) for n in flagged],
    )
    return values.withColumns(
        {n + RAW_SUFFIX: F.when(F.col(n).isNull(), F.col(n + RAW_SUFFIX)) for n in dates}
    )


def decode(df: DataFrame, record: Record, keep: tuple[str, ...] = ()) -> DataFrame:
    """Type a frame whose columns are the record's text fields."""
    return typed(record, df, lambda _, field: F.col(field.name), keep)


def decode_tables(
    tables: dict[str, DataFrame], layout: dict[str, Record], keep: tuple[str, ...] = ()
) -> dict[str, DataFrame]:
    """Type every record table; tables the layout does not know stay as they are."""
    return {
        name: decode(df, layout[name], keep) if name in layout else df
        for name, df in tables.items()
    }
