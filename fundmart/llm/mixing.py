"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target in words. A document is taken a whole number of times: the
certain copies are the whole part of target / source size, and one more copy goes to a
sample whose fixed size is the rest of the target, in words. Inclusion ``p`` is proportional
to a document's size; sizes for which that would exceed 1 are certain, and the others are
scaled anew. Documents are ranked by random odds divided by inclusion odds, ``(u / (1 - u)) /
(p / (1 - p))``, and the first ones are taken until the rest is used up; the last one only if
that comes nearer. ``u`` is a hash of the id, so reruns agree.

Nothing ranks a whole source in one task. Words are summed per source and bin of the
rank (256 bins, then 256 inside the bin where the target is reached), and only the rows
of that one small bin, 1/65536 of the rank's range, are put in order. The result is one
threshold per source, which each document compares itself with.

Defined results: a null text has size 0 and is taken 0 times its size; null is a source
of its own, the last one; a null id ranks like an empty one; rows that repeat an id and
a size share one rank and one verdict. Very long texts are counted whole. An empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundmart.llm.base import NO_SPACE, named, query, table, text_of, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BINS = 256
SOURCES_BYTES = 16 << 20
SALTS = 64
# 13 hexadecimal digits fit a double exactly.
DRAW_DIGITS = 13


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(NO_SPACE)).cast("long")


def _draw(id_col: str) -> Column:
    """52 random bits of a document, fixed by its id."""
    text = F.coalesce(named(id_col).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, DRAW_DIGITS), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """One row per source: its size and target. ``sizes``: source, size.

    With sources sorted by the level at which they reach their limit, the common level is
    the largest value of (rest of the total) / (rest of the weights). The window runs over
    one row per source, never over documents.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    place = (F.row_number().over(order) - 1) % len(weights) + 1
    weighted = sums.select(
        "*", F.element_at(F.array(*[F.lit(w) for w in weights]), place).alias("weight")
    )
    everything = Window.partitionBy()
    fill = Window.orderBy(
        F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source")
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rest = F.lit(float(share)) * F.sum("source_size").over(everything) - F.lit(most) * (
        F.sum("source_size").over(fill) - F.col("source_size")
    )
    weight_left = F.sum("weight").over(everything) - F.sum("weight").over(fill) + F.col("weight")
    return weighted.select("*", (rest / weight_left).alias("level")).select(
        "source",
        "source_size",
        F.least(
            F.max("level").over(everything) * F.col("weight"),
            (F.lit(most) * F.col("source_size")).cast("double"),
        ).alias("target"),
    )


def with_scales(targets: DataFrame, sizes: DataFrame) -> DataFrame:
    """Targets with what is ``left`` of them after whole copies, and the ``scale`` that makes
    inclusion proportional to size.

    A document's inclusion is its size times the scale, and 1 where that would be more: the
    largest sizes are certain, and the scale is such that the others are expected to bring
    the rest of the words. The window runs over the different sizes of a source.
    """
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
    targets = targets.withColumn("copies", F.coalesce(F.floor(ratio), F.lit(0)).cast("long"))
    targets = targets.withColumn("left", F.col("target") - F.col("copies") * F.col("source_size"))
    counts = sizes.filter("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    same = F.col("c.source").eqNullSafe(F.col("t.source"))
    words, squares = F.col("size") * F.col("n"), F.col("size") * F.col("size") * F.col("n")
    down = Window.partitionBy("source").orderBy(F.desc("size"))
    larger = F.sum(words).over(down) - words
    rest = F.sum(squares).over(Window.partitionBy("source")) - F.sum(squares).over(down) + squares
    scales = (
        counts.alias("c")
        .join(targets.alias("t"), same)
        .select("c.*", "t.left")
        .select("source", "size", ((F.col("left") - larger) / rest).alias("scale"))
        # The largest size that is not certain; all larger ones are.
        .filter(F.col("scale") * F.col("size") < 1)
        .groupBy("source")
        .agg(F.max_by("scale", "size").alias("scale"))
    )
    same = F.col("t.source").eqNullSafe(F.col("s.source"))
    joined = targets.alias("t").join(scales.alias("s"), same, "left")
    return joined.select("t.*", F.coalesce("s.scale", F.lit(0.0)).alias("scale"))


def _beside(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with their source's figures, without bringing a source's rows together.

    There is one row per source, so it is sent to every task when its checked size allows;
    otherwise each source's row is repeated ``SALTS`` times and its documents are dealt out.
    """
    size = F.coalesce(F.octet_length("source"), F.lit(0)) + 100
    used = sources.agg(F.sum(size)).first()[0] or 0
    same = F.col("d.source").eqNullSafe(F.col("s.source"))
    if used <= SOURCES_BYTES:
        joined = rows.alias("d").join(F.broadcast(sources).alias("s"), same)
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        repeated = sources.select("*", salts)
        own = F.pmod(F.col("d.draw"), F.lit(SALTS)) == F.col("s.salt")
        joined = rows.alias("d").join(repeated.alias("s"), same & own)
    return joined.select("d.*", *[F.col(f"s.{c}") for c in sources.columns if c != "source"])


def _ranked(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Each document with its source's figures, its rank and the bin of its rank."""
    u = (F.col("draw") + F.lit(0.5)) / F.lit(float(16**DRAW_DIGITS))
    share = F.col("inclusion") / (1 - F.col("inclusion"))
    at = F.floor(F.col("odds") / (1 + F.col("odds")) * (BINS * BINS)).cast("int")
    odds = F.when(F.col("inclusion") >= 1, 0.0).when(F.col("inclusion") > 0, u / (1 - u) / share)
    return (
        _beside(rows, sources)
        .withColumn("inclusion", F.col("scale") * F.col("size"))
        # Nothing beyond the whole copies: past every bin.
        .withColumn("odds", odds)
        .withColumn("bin", F.coalesce(F.least(at, F.lit(BINS * BINS - 1)), F.lit(BINS * BINS)))
        .withColumn("rank", F.struct("odds", "draw", "doc_id", "size"))
    )


def _fits(before: Column, size: Column) -> Column:
    """Taking this size comes nearer to what is left than stopping before it."""
    return 2 * before + size <= 2 * F.col("left")


def source_cuts(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Targets with the threshold of each source: ``cut_bin`` and the last ``cut_rank`` in it."""
    ranked = _ranked(rows, targets).filter(F.col("bin") < BINS * BINS)
    fine = written(
        ranked.groupBy("source", F.floor(F.col("bin") / BINS).alias("coarse"), "bin", "left").agg(
            F.sum("size").alias("size")
        ),
        "mix-bins",
    )

    def reached(sums: DataFrame, by: str) -> DataFrame:
        """Per source the first place that does not fit whole, and the words before it."""
        so_far = Window.partitionBy("source").orderBy(by)
        before = F.coalesce(F.col("from"), F.lit(0)) + F.sum("size").over(so_far) - F.col("size")
        return (
            sums.select("source", by, "size", "left", before.alias("before"))
            .filter(F.col("before") + F.col("size") > F.col("left"))
            .groupBy("source")
            .agg(F.min_by(F.struct(by, "before"), by).alias("at"))
            .select("source", F.col(f"at.{by}").alias(by), F.col("at.before").alias("from"))
        )

    def meet(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
        same = F.col("l.source").eqNullSafe(F.col("r.source")) & (F.col(f"l.{on}") == F.col(f"r.{on}"))
        return left.alias("l").join(right.alias("r"), same).select("l.*", "r.from")

    coarse = fine.groupBy("source", "coarse", "left").agg(F.sum("size").alias("size"))
    first = reached(coarse.withColumn("from", F.lit(0)), "coarse")
    cut = written(reached(meet(fine, first, "coarse"), "bin"), "mix-cuts")
    in_order = Window.partitionBy("source").orderBy("rank")
    last = (
        meet(ranked, cut, "bin")
        .withColumn("before", F.col("from") + F.sum("size").over(in_order) - F.col("size"))
        .filter(_fits(F.col("before"), F.col("size")))
        .groupBy("source")
        .agg(F.max("rank").alias("cut_rank"))
    )
    cuts = cut.alias("c").join(
        last.alias("l"), F.col("c.source").eqNullSafe(F.col("l.source")), "left"
    )
    cuts = cuts.select("c.source", F.col("c.bin").alias("cut_bin"), "cut_rank")
    joined = targets.alias("t").join(
        cuts.alias("c"), F.col("t.source").eqNullSafe(F.col("c.source")), "left"
    )
    # Without a cut the source ends before its target: all of it is taken.
    return joined.select(
        "t.*", F.coalesce("cut_bin", F.lit(BINS * BINS)).alias("cut_bin"), "cut_rank"
    )


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(
        named(id_col).alias("doc_id"),
        named(source_col).alias("source"),
        n_words(text_of(text_col)).alias("size"),
        _draw(id_col).alias("draw"),
    )


def _copies(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    taken = (F.col("bin") < F.col("cut_bin")) | (
        (F.col("bin") == F.col("cut_bin"))
        & F.coalesce(F.col("rank") <= F.col("cut_rank"), F.lit(False))
    )
    return _ranked(rows, cuts).withColumn("copies", F.col("copies") + taken.cast("long"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
) -> DataFrame:
    """One row per document: size, its source's size and target, and the words taken."""
    rows = written(_sized(docs, id_col, text_col, source_col), "mix-sizes")
    targets = source_targets(rows, weights, share, most)
    targets = written(with_scales(targets, rows), "mix-targets")
    cuts = written(source_cuts(rows, targets), "mix-thresholds")
    return _copies(rows, cuts).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
    )


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
) -> DataFrame:
    """The mix itself: each document as often as it is taken, with all its columns."""
    rows = written(_sized(docs, id_col, text_col, source_col), "mix-sizes")
    targets = source_targets(rows, weights, share, most)
    targets = written(with_scales(targets, rows), "mix-targets")
    cuts = written(source_cuts(rows, targets), "mix-thresholds")
    whole = docs.select(
        F.struct(*[named(c) for c in docs.columns]).alias("row"),
        named(id_col).alias("doc_id"),
        named(source_col).alias("source"),
        n_words(text_of(text_col)).alias("size"),
        _draw(id_col).alias("draw"),
    )
    copies = _copies(whole, cuts).filter(F.col("copies") > 0)
    repeated = copies.select(
        "row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    )
    return repeated.select(*[F.col("row")[c].alias(c) for c in docs.columns])


@query(r"""
WITH d AS (
 SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
  CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) AS draw
 FROM documents),
s AS (
 SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
  CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
   WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight
 FROM d GROUP BY source),
f AS (
 SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - 2 * (sum(source_size) OVER w - source_size))
  / (sum(weight) OVER () - sum(weight) OVER w + weight) AS level
 FROM s
 WINDOW w AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
t AS (
 SELECT source, source_size,
  least(max(level) OVER () * weight, (2 * source_size)::DOUBLE) AS target FROM f),
l AS (
 SELECT *, target - whole * source_size AS rest FROM (SELECT *, CASE WHEN source_size > 0
  THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t)),
h AS (
 SELECT source, size, count(*) AS n FROM d WHERE size > 0 GROUP BY ALL),
g AS (
 SELECT h.source, size, (rest - (sum(size * n) OVER w - size * n)::DOUBLE)
  / (sum(size * size * n) OVER (PARTITION BY h.source) - sum(size * size * n) OVER w
   + size * size * n)::DOUBLE AS scale
 FROM h JOIN l ON h.source IS NOT DISTINCT FROM l.source
 WINDOW w AS (PARTITION BY h.source ORDER BY size DESC)),
k AS (
 SELECT source, arg_max(scale, size) AS scale FROM g WHERE scale * size < 1 GROUP BY source),
p AS (
 SELECT d.*, l.* EXCLUDE (source), coalesce(k.scale, 0) * size AS inclusion,
  (draw + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
 FROM d JOIN l ON d.source IS NOT DISTINCT FROM l.source
 LEFT JOIN k ON d.source IS NOT DISTINCT FROM k.source),
o AS (
 SELECT *, CASE WHEN inclusion >= 1 THEN 0::DOUBLE
  WHEN inclusion > 0 THEN u / (1 - u) / (inclusion / (1 - inclusion)) END AS odds FROM p),
r AS (
 SELECT *, sum(CASE WHEN odds IS NOT NULL THEN size END) OVER (
  PARTITION BY source ORDER BY odds NULLS LAST, draw, doc_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before FROM o),
c AS (
 SELECT *, whole + CASE WHEN odds IS NOT NULL AND 2 * before + size <= 2 * rest
  THEN 1 ELSE 0 END AS copies FROM r)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken,
 CAST(copies AS BIGINT) AS copies
FROM c
""")
def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents"))
