"""Writing tables: Parquet or CSV, partitioned per delivery, without stale leftovers."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from fundmart.layouts import LABEL, LINE_NO, ROW_NO
from fundmart.session import child_names, remove_folder, together

FORMATS = ("parquet", "csv")
HELPERS = (LINE_NO, ROW_NO, "_orde", "_meldingen")


def check_format(fmt: str) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"Onbekend formaat {fmt!r}. Kies uit {FORMATS}.")


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", by: str | None = None, keep_others: bool = False
) -> None:
    """Replace a table; with ``keep_others`` only the partitions that have new rows."""
    check_format(fmt)
    writer = df.write.format(fmt).mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    if by:
        mode = "dynamic" if keep_others else "static"
        writer = writer.partitionBy(by).option("partitionOverwriteMode", mode)
    writer.save(path)


def write_tables(
    tables: dict[str, DataFrame],
    folder: str,
    fmt: str = "parquet",
    partitioned: tuple[str, ...] = (),
    by: str = LABEL,
    keep_others: bool = False,
) -> list[str]:
    """Write every table under ``folder``; the written paths."""
    check_format(fmt)

    def write(name: str, df: DataFrame) -> None:
        partition = by if name in partitioned else None
        write_table(df, f"{folder}/{name}", fmt, partition, keep_others)

    together(*[partial(write, name, df) for name, df in tables.items()])
    return [f"{folder}/{name}" for name in tables]


def partition_folder(label: str) -> str:
    return f"{LABEL}={label}"


def remove_stale(
    spark: SparkSession, root: str, tables: list[str], labels: list[str], written: set[tuple[str, str]]
) -> None:
    """Drop partitions of these deliveries that the new run did not write.

    Only own tables and own labels: anything else in the folder is the user's.
    """
    for table in tables:
        present = set(child_names(spark, f"{root}/{table}"))
        for label in labels:
            if (table, label) not in written and partition_folder(label) in present:
                remove_folder(spark, f"{root}/{table}/{partition_folder(label)}")


def without_helpers(df: DataFrame) -> DataFrame:
    return df.drop(*HELPERS)


def refuse_other_format(spark: SparkSession, root: str, tables: list[str], fmt: str) -> None:
    """A folder holds one format: a reader of the other one would trip over what is there."""
    check_format(fmt)
    for table in tables:
        for part in child_names(spark, f"{root}/{table}"):
            for file in child_names(spark, f"{root}/{table}/{part}"):
                suffix = file.rsplit(".", 1)[-1]
                if suffix in FORMATS and suffix != fmt:
                    raise ValueError(
                        f"In {root} staan al tabellen als {suffix}; kies voor {fmt} een andere map."
                    )


def write_csv(df: DataFrame, path: str) -> None:
    """A whole table as CSV, for download."""
    write_table(df, path, "csv")
