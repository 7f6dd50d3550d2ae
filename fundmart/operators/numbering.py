"""Row numbers that do not put a whole group in one task, and order checks.

Both spread the rows over all tasks by range: Spark samples the keys, cuts them into ranges
of about equal size, and every task sorts its own range. A group of any size, with keys as
sparse as they like, is then a run of ranges, and what a row needs to know of the ranges
before its own is one row per range and group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundmart.session import small_side, written

RANGE, PLACE = "_range", "_place"
PLACE_BITS = 33


def spread(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The rows in the order of ``group`` and ``order`` over all tasks, with the number of
    their range and their place in it.

    Rows that are equal in all these columns lie in one range: ``order`` should tell the rows
    of a group apart. Written, so that ranges and places stay as they are.
    """
    keys = [F.col(f"`{c}`").asc_nulls_first() for c in [*group, *order]]
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    ranges = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranges = ranges.withColumns({RANGE: F.spark_partition_id(), PLACE: place})
    return written(ranges, "ranges")


def number_rows(
    df: DataFrame, group: list[str], order: str | list[str], number: str
) -> DataFrame:
    """0-based row number per ``group`` in the order of ``order``; no groups: of the table.

    A plain window would sort a whole group in one task. Here a row's number is its distance
    from its group's first place in the range, plus the group's rows in earlier ranges.
    """
    rows = spread(df, group, [order] if isinstance(order, str) else order)
    # The starts have the group under other names, so that the join can tell them apart.
    names = {f"_group_{i}": F.col(f"`{c}`") for i, c in enumerate(group)}
    sizes = rows.groupBy(F.col(RANGE).alias("_of"), *[c.alias(n) for n, c in names.items()]).agg(
        F.min(PLACE).alias("_first"), F.count(F.lit(1)).alias("_size")
    )
    # A window has at most one row per range.
    earlier = W.partitionBy(*names).orderBy("_of").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_size").over(earlier), F.lit(0))
    starts = sizes.select("_of", *names, (before - F.col("_first")).alias("_start"))
    same = F.col(RANGE) == F.col("_of")
    for name, column in names.items():
        same = same & column.eqNullSafe(F.col(name))
    columns = [F.col(f"`{c}`") for c in df.columns if c != number]
    value = F.col(PLACE) + F.col("_start")
    return rows.join(small_side(starts), same).select(*columns, value.alias(number))


def positions(df: DataFrame, number: str) -> DataFrame:
    """The rows of a sorted table with their 0-based place in it.

    A row's place is its place in its own partition plus the rows of the partitions before
    it; nothing is sorted again. Written, so that partitions and places stay as they are.
    """
    place = F.monotonically_increasing_id()
    rows = df.withColumns(
        {
            RANGE: F.shiftright(place, PLACE_BITS).cast("int"),
            PLACE: place.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)),
        }
    )
    rows = written(rows, "positions")
    # One row per partition.
    sizes = rows.groupBy(F.col(RANGE).alias("_of")).agg(F.count(F.lit(1)).alias("_size"))
    earlier = W.orderBy("_of").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before")
    starts = F.broadcast(sizes.select("_of", before))
    value = (F.col("_before") + F.col(PLACE)).alias(number)
    columns = [F.col(f"`{c}`") for c in df.columns]
    return rows.join(starts, F.col(RANGE) == F.col("_of")).select(*columns, value)


def fact_key(prefix: str, delivery: Column, row: Column) -> Column:
    return F.concat_ws(":", F.lit(prefix), delivery, row.cast("string"))


def previous_difference(
    df: DataFrame, group: list[str], order: list[str], value: str, name: str
) -> DataFrame:
    """Difference with the previous row of the group; null on its first row.

    ``group`` is a person-like key: a window needs its rows in one task.
    """
    window = W.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.col(value) - F.lag(value).over(window))


def order_check(df: DataFrame, group: str, order: str, value: str) -> DataFrame:
    """Steps between consecutive rows per group: rows, rises, falls and unchanged.

    Rows are compared inside their range; the step from one range to the next comes from a
    group's first and last row in each, so a very large group is never one window.
    """
    names = ["rows", "rises", "falls", "unchanged"]
    part = spread(df.select(group, order, value), [group], [order])
    inside = W.partitionBy(RANGE, group).orderBy(PLACE)
    steps = part.select(group, (F.col(value) - F.lag(value).over(inside)).alias("_step"))
    # As structs, since a first or last value may be null.
    ends = part.groupBy(RANGE, group).agg(
        F.min_by(F.struct(value), PLACE).alias("_first"),
        F.max_by(F.struct(value), PLACE).alias("_last"),
    )
    border = W.partitionBy(group).orderBy(RANGE)
    step = F.col("_first")[value] - F.lag("_last").over(border)[value]
    crossings = ends.select(group, step.alias("_step"))

    def tally(frame: DataFrame, rows: Column) -> DataFrame:
        return frame.groupBy(group).agg(
            rows.alias("rows"),
            F.count_if(F.col("_step") > 0).alias("rises"),
            F.count_if(F.col("_step") < 0).alias("falls"),
            F.count_if(F.col("_step") == 0).alias("unchanged"),
        )

    both = tally(steps, F.count("*")).unionByName(tally(crossings, F.lit(0).cast("bigint")))
    return both.groupBy(group).agg(*[F.sum(n).alias(n) for n in names])
