"""Exact and near dedup against brute force."""

import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from fundmart.llm import exact_dedup, simhash
from tests.llm.conftest import DOCS, EDGE, doc


def brute_groups(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1] or "", []).append(r[0])
    out = []
    for r in rows:
        ids = groups[r[1] or ""]
        keep = max([i for i in ids if i is not None], default=None)
        digest = hashlib.sha256((r[1] or "").encode()).hexdigest()
        out.append((r[0], keep, len(ids), keep is None or r[0] == keep, digest))
    return sorted(out, key=str)


def test_exact_groups(edge, empty):
    found = exact_dedup.exact_groups(edge)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_groups(EDGE)
    assert exact_dedup.exact_groups(empty).collect() == []


def test_keep_one_copy_keeps_columns(edge, empty):
    kept = exact_dedup.keep_one_copy(edge)
    assert kept.columns == edge.columns and kept.schema["n_chars"].dataType.typeName() == "long"
    rows = kept.collect()
    assert len(rows) == len({r[1] or "" for r in EDGE})
    by_text = {r["text"] or "": r for r in rows}
    assert by_text["one two three four"]["doc_id"] == 4
    assert by_text[""]["doc_id"] == 9 and by_text[""]["text"] is None
    assert by_text["no id here"]["a.b"] == "dot"
    assert exact_dedup.keep_one_copy(empty).collect() == []


def test_texts_are_shuffled_once_and_natively(edge):
    plan = exact_dedup.exact_groups(edge)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(fps):
    """fps: (id, fingerprint); id -> smallest id reachable."""
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i][1] ^ fps[j][1]).count("1") <= 3:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(fps):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [least.get(root(i)) for i in range(len(fps))]


def near_texts():
    rnd = random.Random(5)
    words = ["w%d" % i for i in range(300)]
    rows = []
    for group in range(12):
        base = [rnd.choice(words) for _ in range(rnd.randint(150, 400))]
        for _ in range(6):
            changed = list(base)
            for _ in range(rnd.randint(0, 2)):
                changed[rnd.randrange(len(changed))] = rnd.choice(words)
            rows.append(doc(len(rows) + 10 * group, " ".join(changed)))
    return rows


def test_near_groups(spark, edge, empty):
    for df, rows in ((spark.createDataFrame(near_texts(), DOCS), near_texts()), (edge, EDGE)):
        fps = [(r[0], brute_fingerprint(r[1] or "")) for r in rows]
        expected = [
            (i, format(fp, "016x"), c)
            for (i, fp), c in zip(fps, brute_components(fps), strict=True)
        ]
        found = simhash.near_groups(df)
        assert found.columns == ["doc_id", "fingerprint", "component_id"]
        assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    assert simhash.near_groups(empty).collect() == []


def test_links_miss_nothing(spark):
    """Fingerprints around a few centres, up to five bits away: every pair within three."""
    rnd = random.Random(3)
    values = set()
    for _ in range(12):
        centre = rnd.getrandbits(64)
        for _ in range(40):
            bits = rnd.sample(range(64), rnd.randint(0, 4))
            values.add(centre ^ sum(1 << b for b in bits))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = {tuple(r) for r in simhash.links(df).distinct().collect()}
    full = {s: s % (1 << 64) for s in signed}
    expected = {
        (a, b) for a in signed for b in signed if a < b and (full[a] ^ full[b]).bit_count() <= 3
    }
    assert found == expected and len(expected) > 100
    with pytest.raises(ValueError):
        simhash.links(df, 4)


def test_each_anchor_is_near(spark):
    """Seventeen anchors at most, home among them, all within radius + 1."""
    df = spark.createDataFrame([(0,), (-1,), (123456789,), (1 << 62,)], "fp long")
    homes, copies = simhash.anchors(df)
    home = {tuple(r) for r in homes.collect()}
    copied = {(r["anchor"], r["b"]) for r in copies.collect()}
    assert home <= copied
    for anchor, fp in copied:
        half = (fp >> 32 if anchor >> 32 else fp) & 0xFFFFFFFF
        assert ((anchor & 0xFFFFFFFF) ^ half).bit_count() <= 2
    counts = copies.groupBy("b").count().agg(F.max("count")).first()[0]
    assert counts <= 34


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    roots = {tuple(r) for r in simhash.components(edges).collect()}
    assert roots == {(i, 0) for i in range(1, 201)}


def test_one_document_of_each_group_stays(spark, edge, empty):
    rows = near_texts()
    fps = [(r[0], brute_fingerprint(r[1])) for r in rows]
    kept = simhash.keep_one_of_group(spark.createDataFrame(rows, DOCS))
    assert kept.columns == edge.columns
    assert {r["doc_id"] for r in kept.collect()} == set(brute_components(fps))
    assert simhash.keep_one_of_group(empty).collect() == []
    assert simhash.keep_one_of_group(edge).count() >= 3
