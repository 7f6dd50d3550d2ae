"""Data checks as aggregates: counts of findings, never the rows themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundmart.functions.text import LIST_SEPARATOR
from fundmart.operators.merge import stack_tables
from fundmart.texts import ERROR, FAIL, GATE_CLOSED, OK, WARN, WARNING


def unpivot(df: DataFrame, ids: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    return df.unpivot(ids, columns, name, value)


def empty_counts(df: DataFrame, group: list[str], fields: list[str]) -> DataFrame:
    """Rows with an empty field, per group and field: one aggregate for all fields."""
    counts = df.groupBy(*group).agg(
        *[F.count_if(F.col(f).isNull()).alias(f) for f in fields]
    )
    return unpivot(counts, group, fields, "veld", "aantal").filter("aantal > 0")


def _unknown(field: str, valid: list[str]) -> Column:
    """The codes of a field that are not in its list, as (veld, code); null if there are none.

    A value that is itself a listed code (the usual case) is settled by a literal set
    test; only the rest is split up.
    """
    known = ", ".join("'" + code.replace("'", "\\'") + "'" for code in valid)
    return F.expr(
        f"""CASE WHEN `{field}` NOT IN ({known}) THEN transform(
        filter(split(`{field}`, '{LIST_SEPARATOR}'), c -> c NOT IN ({known})),
        c -> named_struct('veld', '{field}', 'code', c)) END"""
    )


def _counted(df: DataFrame, group: list[str], findings: list[Column]) -> DataFrame:
    """Findings (arrays of (veld, code)) per group, field and code, in one pass."""
    found = F.flatten(F.array_compact(F.array(*findings)))
    return (
        df.select(*group, F.explode(found).alias("_f"))
        .groupBy(*group, F.col("_f.veld").alias("veld"), F.col("_f.code").alias("code"))
        .agg(F.count("*").alias("aantal"))
    )


def unknown_codes(
    df: DataFrame, group: list[str], lists: dict[str, list[str]]
) -> DataFrame:
    """Codes outside their list, per group, field and code, with their number."""
    return _counted(df, group, [_unknown(f, valid) for f, valid in lists.items()])


def field_findings(
    df: DataFrame, group: list[str], required: list[str], lists: dict[str, list[str]]
) -> DataFrame:
    """Empty required fields (``code`` is null) and codes outside their list, per group, field
    and code, with their number: one pass for all fields of a table."""
    empty = [
        F.expr(
            f"CASE WHEN `{f}` IS NULL THEN "
            f"array(named_struct('veld', '{f}', 'code', CAST(NULL AS STRING))) END"
        )
        for f in required
    ]
    return _counted(df, group, empty + [_unknown(f, valid) for f, valid in lists.items()])


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how many rows share their key with another row."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .filter("_n > 1")
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("aantal"))
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("aantal")).filter("aantal > 1")


def orphan_rows(fact: DataFrame, column: str, targets: list[DataFrame]) -> DataFrame:
    """One row: how many fact rows have a filled key that no target has.

    Facts are reduced to one row per key before the join, so a key with a third
    of all rows is one row here.
    """
    keys = fact.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    known = stack_tables([t.select(column) for t in targets])
    return keys.join(known, column, "left_anti").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("aantal")
    )


def trailer_differences(
    declared: DataFrame, counted: DataFrame, group: list[str], kind: str
) -> DataFrame:
    """Declared against counted rows; a missing count is 0, an unreadable one differs."""
    return (
        declared.join(counted, [*group, kind], "left")
        .withColumn("gevonden", F.coalesce("gevonden", F.lit(0)))
        .filter(~F.col("gemeld").eqNullSafe(F.col("gevonden")))
    )


def severity_rank(severity: Column) -> Column:
    return F.when(severity == ERROR, 2).when(severity == WARNING, 1).otherwise(0)


def status_of(severity: Column) -> Column:
    """Aggregate: ``fail`` with an error, ``warn`` with a warning, else ``ok``."""
    worst = F.coalesce(F.max(severity_rank(severity)), F.lit(0))
    return F.when(worst == 2, FAIL).when(worst == 1, WARN).otherwise(OK)


def count_severity(messages: DataFrame, severity: str) -> int:
    """Number of messages of this severity (not the sum of their counts)."""
    return messages.filter(F.col("Ernst") == severity).count()


def status(messages: DataFrame) -> str:
    return messages.agg(status_of(F.col("Ernst")).alias("status")).first()[0]


def is_mixed(flag: str) -> Column:
    """Aggregate: a boolean column holds both values; empty ones do not count."""
    return F.coalesce(F.min(flag) != F.max(flag), F.lit(False))


def mixed_flag(df: DataFrame, flag: str) -> bool:
    return df.agg(is_mixed(flag)).first()[0]


class QualityError(Exception):
    """Status is ``fail``; the output is already written. Carries the errors."""

    def __init__(self, text: str, messages: DataFrame) -> None:
        super().__init__(text)
        self.messages = messages


def gate(messages: DataFrame, reference: str) -> None:
    """Raise :class:`QualityError` when there is an error among the messages."""
    errors = messages.filter(F.col("Ernst") == ERROR)
    n = errors.count()
    if n:
        raise QualityError(GATE_CLOSED % (n, reference), errors)
