"""What a delivery's file name says, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundmart.layouts import LAYOUT_OF_KIND

# Fixed value: kind, year, creation date and institution code, in this order; one
# space after the first underscore is tolerated.
NAME_PATTERN = r"^(%s)_ ?(\d{4})_(\d{8})_(\d{2}[A-Z]{2})$" % "|".join(LAYOUT_OF_KIND)
EXTENSION = ".csv"


def readable_path(uri: Column) -> Column:
    """Undo URL encoding (a space arrives as %20); a plus sign stays a plus sign."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def is_csv(name: Column) -> Column:
    return F.lower(name).endswith(EXTENSION) & (F.length(name) > len(EXTENSION))


def with_name_parts(df: DataFrame, name: str) -> DataFrame:
    """Add ``Soort, Bekostigingsjaar, Aangemaakt, BRIN``; all null when not a delivery."""
    upper = F.upper(stem(F.col(name)))
    created = F.try_to_date(F.regexp_extract(upper, NAME_PATTERN, 3), "yyyyMMdd")
    known = is_csv(F.col(name)) & upper.rlike(NAME_PATTERN) & created.isNotNull()

    def part(group: int) -> Column:
        return F.when(known, F.regexp_extract(upper, NAME_PATTERN, group))

    return df.withColumns(
        {
            "Soort": part(1),
            "Bekostigingsjaar": part(2).cast("bigint"),
            "Aangemaakt": F.when(known, created),
            "BRIN": part(4),
        }
    )


def deliveries(df: DataFrame) -> DataFrame:
    return df.filter(F.col("Soort").isNotNull())


def unrecognised(df: DataFrame, name: str) -> DataFrame:
    """CSV files whose name is not a delivery's (a second download, an old copy)."""
    return df.filter(F.col("Soort").isNull() & is_csv(F.col(name)))


def layout_of(kind: Column) -> Column:
    """Layout name of a delivery kind."""
    choice = F.lit(None).cast("string")
    for name, layout in LAYOUT_OF_KIND.items():
        choice = F.when(kind == name, layout).otherwise(choice)
    return choice
