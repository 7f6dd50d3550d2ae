"""Indicators on the star tables; each is one Catalyst plan.

All of them look at the receiving institutions only, and give an empty frame
with the right columns when the delivery they need is absent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundmart.functions.text import code_array, lacks_code, share
from fundmart.layouts import LABEL, STATUS
from fundmart.operators.merge import common_values, newest_per_group, stack_tables
from fundmart.plans.star import FACT_ID, FACT_SOURCE, PERSON_ID
from fundmart.session import small_side
from fundmart.texts import FUNNEL_STEPS

PROVISIONAL = "VLPBEK"
FINAL = "DEFBEK"
HISTORIC = "HISBEK"
# Fixed value: enrolments with this status are not assessed.
NOT_ASSESSED = "mv"
ENROLMENT_KEY = ["Bekostigingsjaar", "BRIN", "Inschrijvingvolgnummer", PERSON_ID]

Star = dict[str, DataFrame]


def has_kind(star: Star, kind: str) -> bool:
    return bool(star["dim_levering"].filter(F.col("SoortLevering") == kind).take(1))


def level_choices(star: Star) -> DataFrame:
    levels = star["dim_opleiding"].select("Opleidingsniveau")
    return levels.filter(F.col("Opleidingsniveau").isNotNull()).distinct().orderBy("Opleidingsniveau")


def newest_deliveries(star: Star, kind: str) -> DataFrame:
    """Per funding year the newest delivery of a kind; ties go to the first label."""
    chosen = star["dim_levering"].filter(F.col("SoortLevering") == kind)
    return newest_per_group(chosen, ["Bekostigingsjaar"], "DatumAanmaak", [LABEL])


def current_deliveries(star: Star, kind: str) -> list[str]:
    """Their labels in year order: at most one per year, to prune partitions with."""
    newest = newest_deliveries(star, kind).orderBy("Bekostigingsjaar")
    return [row[0] for row in newest.select(LABEL).collect()]


def comparable_years(star: Star) -> list[int]:
    """Years with both a provisional and a final delivery."""
    years = common_values(
        newest_deliveries(star, PROVISIONAL), newest_deliveries(star, FINAL), "Bekostigingsjaar"
    )
    return [row[0] for row in years.orderBy("Bekostigingsjaar").collect()]


def assessed(df: DataFrame, status: str = STATUS, code: str = NOT_ASSESSED) -> DataFrame:
    return df.withColumn("Beoordeeld", lacks_code(F.col(status), code))


def fact_base(
    star: Star, fact: str, deliveries: list[str], levels: list[str] | None = None
) -> DataFrame:
    """Facts of the own institutions for the chosen deliveries.

    The labels are literals, so only their folders are read. Dimensions are
    broadcast when their checked size allows it.
    """
    own = star["dim_instelling"].filter("EigenInstelling").select("BRIN")
    kinds = star["dim_levering"].select(LABEL, "SoortLevering")
    programmes = star["dim_opleiding"].select("Opleidingscode", "Opleidingsniveau")
    df = (
        star[fact]
        .filter(F.col(LABEL).isin(deliveries))
        .join(small_side(own), "BRIN", "left_semi")
        .join(small_side(kinds), LABEL, "left")
        .join(small_side(programmes), "Opleidingscode", "left")
    )
    df = assessed(df)
    order = [*star[fact].columns, "SoortLevering", "Opleidingsniveau", "Beoordeeld"]
    if levels:
        df = df.filter(F.col("Opleidingsniveau").isin(levels))
    return df.select(*order)


def funnel(df: DataFrame, funded: str = "Bekostigingsindicatie") -> DataFrame:
    """Rows, assessed rows, and funded ones among those, as three rows."""
    counts = df.agg(
        F.count("*").alias(FUNNEL_STEPS[0]),
        F.count_if("Beoordeeld").alias(FUNNEL_STEPS[1]),
        F.count_if(F.col("Beoordeeld") & F.col(funded)).alias(FUNNEL_STEPS[2]),
    )
    return counts.unpivot([], list(FUNNEL_STEPS), "Stap", "Aantal")


def not_funded_reasons(
    df: DataFrame,
    bridge: DataFrame,
    statuses: DataFrame,
    key: str = FACT_ID,
    funded: str = "Bekostigingsindicatie",
) -> DataFrame:
    """Assessed rows without funding, counted per status code and group, from the status
    bridge: for facts that do not carry their status list, or whose keys repeat."""
    refused = df.filter(F.col("Beoordeeld") & ~F.col(funded)).select(key)
    names = statuses.filter(~F.col("Bekostigd"))
    return (
        bridge.join(small_side(names), "Code")
        .join(refused, key, "left_semi")
        .groupBy("Groep", "Code", "Omschrijving")
        .agg(F.count("*").alias("Aantal"))
        .orderBy(F.desc("Aantal"), "Code")
    )


def reasons(
    df: DataFrame,
    star: Star,
    status: str = STATUS,
    funded: str = "Bekostigingsindicatie",
) -> DataFrame:
    """The same for the facts of a star, whose keys are unique.

    The facts carry their own status list: it is taken apart behind the filter, so neither
    the status bridge nor a join on the fact key is needed. Codes are counted before they
    meet their names.
    """
    refused = df.filter(F.col("Beoordeeld") & ~F.col(funded))
    counts = (
        refused.select(F.explode(code_array(F.col(status))).alias("Code"))
        .groupBy("Code")
        .agg(F.count("*").alias("Aantal"))
    )
    names = star["dim_status"].filter(~F.col("Bekostigd"))
    return (
        counts.join(small_side(names.select("Code", "Groep", "Omschrijving")), "Code")
        .select("Groep", "Code", "Omschrijving", "Aantal")
        .orderBy(F.desc("Aantal"), "Code")
    )


def per_programme(
    df: DataFrame,
    keys: tuple[str, ...] = ("Opleidingscode", "Opleidingsniveau"),
    funded: str = "Bekostigingsindicatie",
) -> DataFrame:
    """Assessed rows, funded rows and their share per programme."""
    return (
        df.filter("Beoordeeld")
        .groupBy(*keys)
        .agg(F.count("*").alias("Totaal"), F.count_if(funded).alias("Bekostigd"))
        .withColumn("AandeelBekostigd", share("Bekostigd", "Totaal"))
        .orderBy(keys[0])
    )


def lowest_share_first(programmes: DataFrame) -> DataFrame:
    return programmes.orderBy("AandeelBekostigd")


def status_changes(
    before: DataFrame, after: DataFrame, keys: list[str], status: str, group: str
) -> DataFrame:
    """Rows whose status differs between two versions, counted per pair of values.

    Both sides are first counted per key and status, and the counts multiplied
    after the join: repeated keys never turn into pairs of rows.
    """

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*keys, F.col(status).alias(name)).agg(F.count("*").alias(f"_{name}"))

    return (
        counted(before, "Voorlopig")
        .join(counted(after, "Definitief"), keys)
        .filter(~F.col("Voorlopig").eqNullSafe(F.col("Definitief")))
        .groupBy(group, "Voorlopig", "Definitief")
        .agg(F.sum(F.col("_Voorlopig") * F.col("_Definitief")).alias("Aantal"))
        .orderBy(group, F.desc("Aantal"))
    )


def provisional_to_final(star: Star) -> DataFrame:
    """Enrolments whose status changed between provisional and final."""
    versions = [
        fact_base(star, "fact_deelname", current_deliveries(star, kind))
        for kind in (PROVISIONAL, FINAL)
    ]
    return status_changes(*versions, ENROLMENT_KEY, STATUS, "Bekostigingsjaar")


def totals_per_source(
    sources: list[tuple[DataFrame, str]], year: str, funded: str
) -> DataFrame:
    """Assessed and funded rows per year and source."""
    parts = [
        df.filter("Beoordeeld").select(
            F.col(year).alias("Bekostigingsjaar"),
            F.lit(source).alias("Bron"),
            F.col(funded).alias("_bekostigd"),
        )
        for df, source in sources
    ]
    return (
        stack_tables(parts)
        .groupBy("Bekostigingsjaar", "Bron")
        .agg(F.count("*").alias("Totaal"), F.count_if("_bekostigd").alias("Bekostigd"))
        .orderBy("Bekostigingsjaar", "Bron")
    )


def history(star: Star) -> DataFrame:
    """Per year and source the totals of the current historic deliveries.

    Several historic deliveries with different last years are all current, so
    years they share count more than once.
    """
    labels = current_deliveries(star, HISTORIC)
    parts = [(fact_base(star, fact, labels), source) for fact, source in FACT_SOURCE.items()]
    return totals_per_source(parts, "Bekostigingsjaar", "Bekostigingsindicatie")


def with_share(df: DataFrame) -> DataFrame:
    return df.withColumn("AandeelBekostigd", share("Bekostigd", "Totaal"))


def preview(df: DataFrame, key: str, n: int = 1000) -> DataFrame:
    """The first rows of a table, for showing it; the size comes from ``shape``."""
    return df.orderBy(key).limit(n)


def shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)
