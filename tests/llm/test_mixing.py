"""Source mixing against a plain computation."""

import hashlib
import re
from math import floor, inf

import pytest

from fundmart.llm import mixing
from tests.llm.conftest import DOCS, EDGE, doc


def brute_mix(rows):
    sizes = {}
    docs = []
    for r in rows:
        size = len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
        draw = int(hashlib.md5(str("" if r[0] is None else r[0]).encode()).hexdigest()[:13], 16)
        docs.append((r[0], r[3], size, draw))
        sizes[r[3]] = sizes.get(r[3], 0) + size
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, open_sources, rest = {}, set(order), 1.5 * sum(sizes.values())
    while True:
        total = sum(weight[s] for s in open_sources)
        level = {s: rest * weight[s] / total for s in open_sources}
        over = {s for s in open_sources if level[s] > 2 * sizes[s]}
        if not over:
            target.update(level)
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            rest -= target[s]
        open_sources -= over
    out = []
    for s in order:
        ratio = target[s] / sizes[s] if sizes[s] else 0
        left, before = target[s] - floor(ratio) * sizes[s], 0
        own = [d for d in docs if d[1] == s]
        # Certain sizes are taken out until the others are all below 1.
        rest, words = [d[2] for d in own if d[2]], left
        while rest and words / sum(n * n for n in rest) * max(rest) >= 1:
            largest = max(rest)
            words -= largest * rest.count(largest)
            rest = [n for n in rest if n < largest]
        scale = words / sum(n * n for n in rest) if rest else 0.0

        def odds(d, scale=scale):
            u, p = (d[3] + 0.5) / 16**13, scale * d[2]
            return 0.0 if p >= 1 else u / (1 - u) / (p / (1 - p)) if p > 0 else inf

        for d in sorted(own, key=lambda d: (odds(d), d[3], d[0] or -1, d[2])):
            extra = odds(d) < inf and 2 * before + d[2] <= 2 * left
            before += d[2]
            out.append((d[0], d[2], sizes[s], target[s], d[2] * (floor(ratio) + extra)))
    return out


def rows_of(df):
    chosen = df.select("doc_id", "size", "source_size", "target", "taken")
    return sorted((tuple(r) for r in chosen.collect()), key=str)


def many():
    rows = []
    for i in range(600):
        source = ["big"] * 3 + ["a", "b", None]
        rows.append(doc(i, "w " * (i * 37 % 400 + 1), source[i % 6]))
    return rows


@pytest.mark.parametrize("which", ["edge", "many"])
def test_mix_equals_plain_computation(spark, edge, which):
    rows = EDGE if which == "edge" else many()
    df = edge if which == "edge" else spark.createDataFrame(rows, DOCS)
    found, expected = rows_of(mixing.mix(df)), sorted(brute_mix(rows), key=str)
    assert [f[:3] + f[4:] for f in found] == [e[:3] + e[4:] for e in expected]
    assert [f[3] for f in found] == pytest.approx([e[3] for e in expected])


def test_many_sources_are_dealt_out_alike(spark, monkeypatch):
    df = spark.createDataFrame(many(), DOCS)
    usual = rows_of(mixing.mix(df))
    monkeypatch.setattr(mixing, "SOURCES_BYTES", 0)
    assert rows_of(mixing.mix(df)) == usual


def test_taken_words_come_near_the_target(spark):
    found = mixing.mix(spark.createDataFrame(many(), DOCS)).collect()
    for size in {r["source_size"] for r in found}:
        own = [r for r in found if r["source_size"] == size]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 200
        assert all(r["taken"] <= 2 * r["size"] for r in own)


def test_larger_documents_are_likelier(spark):
    """Of documents that are not certain, inclusion follows the size."""
    rows = [doc(i, "w " * (50 if i % 2 else 150), "b") for i in range(4000)]
    rows += [doc(4000 + i, "w " * 300, "a") for i in range(2000)]
    found = mixing.mix(spark.createDataFrame(rows, DOCS), share=0.5).filter("doc_id < 4000")
    found = found.collect()
    extra = {n: [r["copies"] for r in found if r["size"] == n] for n in (50, 150)}
    rates = {n: sum(own) / len(own) for n, own in extra.items()}
    assert 0 < rates[150] < 1
    assert rates[150] == pytest.approx(3 * rates[50], rel=0.15)


def test_documents_are_repeated_as_often_as_taken(spark, empty):
    df = spark.createDataFrame(many(), DOCS)
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(df).collect()}
    counted = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counted == {i: n for i, n in copies.items() if n}
    assert mixing.mix(empty).collect() == [] and mixing.mixed_documents(empty).collect() == []
