"""Whitening against exact sums and numpy on the plain matrix."""

from collections import Counter
from math import floor, inf, isfinite, nan
from pathlib import Path

import numpy as np
import pytest

from fundmart.llm import whitening
from fundmart.llm.base import table

DATA = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, index string, x int, `a.b` string"


def brute(rows, most=16):
    """(vec_id, n, deviation) per remaining row, with its whitened values, and the shares."""
    sound = [
        r for r in rows if r[1] and all(c is not None and isfinite(c) and abs(c) < 2**56 for c in r[1])
    ]
    lengths = Counter(len(r[1]) for r in sound)
    length = max(lengths, key=lambda k: (lengths[k], k))
    xs = [
        (r[0], tuple(floor(64 * float(c)) + 1000000 for c in r[1]))
        for r in sound
        if len(r[1]) == length
    ]
    fit = sorted({x for _, x in xs})
    n, sums = len(fit), [sum(x[i] for x in fit) for i in range(length)]
    centred = {x: [n * v - s for v, s in zip(x, sums, strict=True)] for x in fit}
    a = np.array([[v / n for v in centred[x]] for x in fit])
    values, vectors = np.linalg.eigh(a.T @ a / n)
    order = np.argsort(-values)[:most]
    order = [i for i in order if values[i] > 1e-9 * values.max()]
    by = vectors[:, order] / np.sqrt(values[order])
    point = {x: np.array([v / n for v in centred[x]]) @ by for x in fit}
    rows = [(i, n, sum(v * v for v in centred[x]), point[x]) for i, x in xs]
    return rows, values[order] / values.sum()


def compare(df, rows):
    expected, shares = brute(rows)
    found = df.collect()
    assert len(found) == len(expected) * len(shares)
    by_row = {}
    for r in found:
        by_row.setdefault((str(r["vec_id"]), r["n"], r["deviation"]), []).append(r)
        assert r["explained"] == pytest.approx(shares[r["component"] - 1], rel=1e-6)
        assert r["identity_error"] <= 1e-4
    assert len({r["identity_error"] for r in found}) == 1
    signs = {}
    repeats = Counter((str(e[0]), e[1], e[2]) for e in expected)
    for vec_id, n, deviation, point in expected:
        own = by_row[(str(vec_id), n, deviation)]
        assert len(own) == repeats[(str(vec_id), n, deviation)] * len(shares)
        for r in own:
            at = r["component"] - 1
            if abs(point[at]) > 1e-3:
                sign = signs.setdefault(at, np.sign(point[at] * r["whitened"]))
                assert r["whitened"] * sign == pytest.approx(point[at], rel=1e-4, abs=1e-6)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0, "i", 3, "b") for r in rows], VECTORS)


def test_whole_table(spark, monkeypatch):
    if not Path(DATA).exists():
        pytest.skip("test tables are not here")
    df = table(spark, DATA, "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    # Many blocks, so that the middle dimension is split.
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 8 * 64 * 10)
    compare(whitening.whiten(df), rows)


def test_odd_rows(spark):
    random = np.random.default_rng(1)
    rows = [(i, random.normal(size=3).astype("float32").tolist()) for i in range(40)]
    rows += [(100, rows[0][1])] * 30 + [(101, rows[0][1]), (None, rows[1][1]), (None, None)]
    rows += [(102, []), (103, [1.0, None, 2.0]), (104, [nan, 1.0, 1.0]), (105, [1.0, inf, 1.0])]
    rows += [(106, [1.0, 2.0]), (107, [1.0] * 400), (108, [1.0, -3e38, 1.0]), (7, rows[3][1])]
    found = whitening.whiten(frame(spark, rows))
    compare(found, rows)
    assert found.columns == whitening.RESULT.replace(",", "").split()[::2]


def test_fewer_components_than_dimensions(spark):
    """One dimension is constant and one twice another: two components are left."""
    rows = [(i, [float(i % 7), 2.0 * (i % 7), 5.0, float(i * i % 11)]) for i in range(50)]
    compare(whitening.whiten(frame(spark, rows)), rows)
    assert whitening.whiten(frame(spark, rows)).agg({"component": "max"}).first()[0] == 2


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(2**40 * i), float(i * i)]) for i in range(9)] + [(9, [2.0**50, 0.0])]
    expected, _ = brute(rows)
    found = whitening.whiten(frame(spark, rows))
    assert {(r["vec_id"], r["deviation"]) for r in found.collect()} == {
        (i, d if d < 2**63 else None) for i, _, d, _ in expected
    }


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)]):
        assert whitening.whiten(frame(spark, rows)).count() == 0
