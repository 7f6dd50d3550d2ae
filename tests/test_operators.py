import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundmart.operators import checks, merge, numbering
from fundmart.plans.indicators import status_changes

from .conftest import rows


def test_row_numbers_with_a_hot_group(spark):
    """Chunked numbering equals a plain count, with one group far larger than a chunk."""
    rng = random.Random(3)
    keys = rng.sample(range(100_000), 3000)
    data = [("hot" if i % 3 else f"g{i % 7}", k) for i, k in enumerate(keys)]
    df = spark.createDataFrame(data, "g string, k bigint")
    got = {(r["g"], r["k"]): r["n"] for r in numbering.number_rows(df, ["g"], "k", "n").collect()}
    expected = {}
    for group in {g for g, _ in data}:
        for n, k in enumerate(sorted(k for g, k in data if g == group)):
            expected[group, k] = n
    assert got == expected


def test_row_numbers_of_sparse_keys_null_groups_and_text_order(spark):
    """Keys far apart: a hot group still spreads over several ranges of bounded size."""
    data = [("hot" if i % 3 else None, f"k{(i * 7919) % 5003:05}", 10**14 * i) for i in range(4000)]
    df = spark.createDataFrame(data, "g string, `k.x` string, k bigint")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for order in (["k"], ["k.x"]):
            ranges = numbering.spread(df, ["g"], order).groupBy(numbering.RANGE).count().collect()
            assert len(ranges) == 4 and max(r["count"] for r in ranges) < 2000
            at = df.columns.index(order[0])
            expected = set()
            for group in ("hot", None):
                own = sorted(d[at] for d in data if d[0] == group)
                expected |= {(group, key, n) for n, key in enumerate(own)}
            numbered = numbering.number_rows(df, ["g"], order, "n")
            assert numbered.columns == ["g", "k.x", "k", "n"]
            assert {(r[0], r[at], r[3]) for r in numbered.collect()} == expected
        whole = numbering.number_rows(df, [], "k", "n").select("k", "n").collect()
        assert sorted(whole) == [(10**14 * i, i) for i in range(4000)]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    nothing = df.filter("false")
    assert numbering.number_rows(nothing, ["g"], "k", "n").count() == 0
    nothing = nothing.withColumn("v", nothing["k"])
    assert numbering.order_check(nothing, "g", "k", "v").count() == 0


def test_order_check_over_range_borders(spark):
    rng = random.Random(5)
    data = [(f"g{rng.randrange(3)}", k, rng.randrange(4)) for k in range(500)]
    df = spark.createDataFrame(data, "g string, k bigint, v bigint")
    expected = defaultdict(Counter)
    last = {}
    for g, _, v in data:
        expected[g]["rows"] += 1
        if g in last:
            step = v - last[g]
            expected[g]["rises" if step > 0 else "falls" if step < 0 else "unchanged"] += 1
        last[g] = v
    for r in numbering.order_check(df, "g", "k", "v").collect():
        e = expected[r["g"]]
        assert (r["rows"], r["rises"], r["falls"], r["unchanged"]) == tuple(
            e[n] for n in ("rows", "rises", "falls", "unchanged")
        )


def test_previous_difference(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 3), ("b", 1, 1)], "g string, k int, v int")
    got = numbering.previous_difference(df, ["g"], ["k"], "v", "d")
    assert rows(got, "g", "k", "d") == [("a", 1, None), ("a", 2, -2), ("b", 1, None)]


def test_newest_first_takes_first_filled_value(spark):
    schema = "k string, a string, b string, d date, t int"
    df = spark.createDataFrame([], schema).unionByName(
        spark.sql(
            """SELECT * FROM VALUES ('x', 'old', 'keep', DATE '2023-01-01', 1),
            ('x', 'new', NULL, DATE '2024-01-01', 2), ('x', 'none', 'none', NULL, 0),
            ('y', NULL, NULL, DATE '2024-01-01', 1), (NULL, 'z', 'z', DATE '2024-01-01', 1),
            ('t', 'second', 's', DATE '2024-01-01', 2), ('t', 'first', NULL, DATE '2024-01-01', 1)
            AS v(k, a, b, d, t)"""
        )
    )
    got = merge.newest_first(df, "k", ["a", "b"], "d", ["t"])
    assert rows(got) == [("t", "first", "s"), ("x", "new", "keep"), ("y", None, None)]


def test_newest_per_group_null_date_is_never_newest(spark):
    df = spark.sql(
        """SELECT * FROM VALUES (1, 'a', DATE '2023-01-01'), (1, 'b', NULL), (2, 'd', NULL),
        (2, 'c', NULL), (CAST(NULL AS INT), 'e', DATE '2020-01-01') AS v(jaar, l, d)"""
    )
    got = merge.newest_per_group(df, ["jaar"], "d", ["l"])
    assert rows(got, "jaar", "l") == [(1, "a"), (2, "c"), (None, "e")]


def test_template_and_union(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    assert merge.with_template(spark, [], schema).schema == schema
    one = spark.createDataFrame([(1,)], "a int")
    two = spark.createDataFrame([("x", 2)], "b string, a bigint")
    got = merge.with_template(spark, [one, two], schema)
    assert got.schema == schema and rows(got) == [(1, None), (2, "x")]
    loose = merge.stack_tables([one.select(F.col("a").cast("bigint")), two])
    assert loose.columns == ["a", "b"]


def test_key_sets(spark):
    a = spark.createDataFrame([("x",), ("y",), (None,)], "k string")
    b = spark.createDataFrame([("y",), ("z",)], "q string")
    keys = merge.key_values([(a, "k"), (b, "q")], "k")
    assert rows(keys) == [("x",), ("y",), ("z",)]
    assert rows(merge.flag_members(keys, "k", b, "in")) == [("x", False), ("y", True), ("z", True)]
    assert rows(merge.missing_keys(a.filter("k is not null"), b.toDF("k"), "k")) == [("x",)]
    assert rows(merge.common_values(a, b.toDF("k"), "k")) == [("y",)]


def test_checks(spark):
    df = spark.createDataFrame(
        [("d", "a,b", None), ("d", "a,", "x"), ("e", None, "y")], "g string, s string, v string"
    )
    assert rows(checks.empty_counts(df, ["g"], ["s", "v"])) == [("d", "v", 1), ("e", "s", 1)]
    both = checks.field_findings(df, ["g"], ["s", "v"], {"s": ["a"], "v": ["x"]})
    apart = rows(checks.unknown_codes(df, ["g"], {"s": ["a"], "v": ["x"]}))
    apart += [("d", "v", None, 1), ("e", "s", None, 1)]
    assert rows(both) == sorted(apart, key=str)
    assert rows(checks.unknown_codes(df, ["g"], {"s": ["a"], "v": ["x"]})) == [
        ("d", "s", "", 1), ("d", "s", "b", 1), ("e", "v", "y", 1),
    ]
    assert checks.duplicate_rows(df, ["g"]).first()[0] == 2
    assert checks.duplicate_rows(df, ["g", "v"]).first()[0] == 0
    known = spark.createDataFrame([("d",)], "g string")
    assert checks.orphan_rows(df, "g", [known]).first()[0] == 1
    assert checks.orphan_rows(df, "g", [known, df.select("g")]).first()[0] == 0


def test_status_and_gate(spark):
    def messages(*severities):
        return spark.createDataFrame([(s,) for s in severities], "Ernst string")

    assert checks.status(messages()) == "ok"
    assert checks.status(messages("warning")) == "warn"
    assert checks.status(messages("warning", "error")) == "fail"
    assert checks.count_severity(messages("error", "error", "warning"), "error") == 2
    checks.gate(messages("warning"), "x")
    with pytest.raises(checks.QualityError, match="2 error") as caught:
        checks.gate(messages("error", "warning", "error"), "zie x")
    assert caught.value.messages.count() == 2


def test_mixed_flag(spark):
    def flags(*values):
        return spark.createDataFrame([(v,) for v in values], "f boolean")

    assert checks.mixed_flag(flags(True, False, None), "f")
    assert not checks.mixed_flag(flags(True, True, None), "f")
    assert not checks.mixed_flag(flags(None), "f")


def test_status_changes_count_pairs_of_repeated_keys(spark):
    """Counts per side multiplied give exactly the pairs a plain join gives."""
    rng = random.Random(11)
    make = lambda: [(rng.choice([1, 2, None]), rng.choice(["p", "q", None])) for _ in range(60)]
    before, after = make(), make()
    expected = Counter(
        (k, a, b) for k, a in before for k2, b in after if k is not None and k == k2 and a != b
    )
    schema = "k int, s string"
    got = status_changes(
        spark.createDataFrame(before, schema), spark.createDataFrame(after, schema), ["k"], "s", "k"
    )
    assert {(r[0], r[1], r[2]): r[3] for r in got.collect()} == dict(expected)
