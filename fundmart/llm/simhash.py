"""SimHash near-dedup by anchor-point covering.

A fingerprint is cut into two halves of 32 bits. Two fingerprints that differ in at most
three bits differ in at most one bit of some half. The anchors of a half are the words of
a covering code: the perfect Hamming code of length 31 (every word is within radius 1 of
exactly one code word) times one free bit. A fingerprint is at home at the nearest anchor
of each half, and is copied to every anchor within radius + 1; whoever differs from it in
one bit of that half has its home among those 17 anchors. Fingerprints are compared per
anchor, home rows with copied rows, so no link is missed and nothing is capped.

Only different fingerprints take part: copies of a text, however many, are one row. A hot
anchor is an ordinary skewed join key, which adaptive execution splits. Links lead to
components by rounds of star contraction over written tables; only counts reach the driver.

Defined results: a null or wordless text has fingerprint zero and links like any other; a
text of one or two words is one shingle; ``component_id`` is the smallest id reachable,
null ids counting as larger than any other. Repeated rows get equal results. An empty
table gives no rows. Extra columns are ignored by ``near_groups``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundmart.llm.base import named, query, table, text_of, written

SHINGLE = 3
SEED = 42
MAX_BITS = 3
# Shingle hashes whose bits are counted at once.
BLOCK = 65_536


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """A bit is set when it is set in over half of the shingles' hashes."""
    # On bytes, lower() changes A-Z only and split() knows just the six ASCII spaces.
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(len(words) - shingle + 1, 1)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    hashed = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (hashed(joined[a:b], SEED) for a, b in zip(starts, ends, strict=True)), np.uint64, n
    )
    counts = np.zeros(64, np.int64)
    for i in range(0, n, BLOCK):
        part = hashes[i : i + BLOCK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > n, bitorder="little")
    return int(bits.view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.fromiter(
            (fingerprint(t.as_py()) for t in batch.column("text")), np.uint64, batch.num_rows
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("hash"), pa.array(values.view(np.int64))],
            ["doc_id", "hash", "fp"],
        )


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(text_col)
    return docs.select(
        named(id_col).cast("long").alias("doc_id"),
        F.unhex(F.md5(text.cast("binary"))).alias("hash"),
        text.alias("text"),
        F.struct(*[named(c) for c in docs.columns]).alias("row"),
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, a hash of the text, and its 64-bit fingerprint as a long."""
    rows = _keyed(docs, id_col, text_col).drop("row")
    return rows.mapInArrow(_fingerprints, "doc_id long, hash binary, fp long")


def _syndrome(half: Column) -> Column:
    """Place (1 to 31) of the bit that separates a word from its code word; 0: it is one.

    Bit j of the place is the parity of the bits whose place has bit j set.
    """
    parts = []
    for j in range(5):
        mask = sum(1 << (place - 1) for place in range(1, 32) if place >> j & 1)
        parts.append((F.bit_count(half.bitwiseAND(F.lit(mask))) % 2) * (1 << j))
    return sum(parts[1:], parts[0]).cast("int")


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place - 1)


def _halves(fps: DataFrame) -> DataFrame:
    """Two rows per fingerprint: half number, the half's 32 bits, its home anchor's key."""
    high = F.shiftrightunsigned(F.col("fp"), 32)
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    halves = F.explode(
        F.array(
            F.struct(F.lit(0).cast("long").alias("half"), low.alias("word")),
            F.struct(F.lit(1).cast("long").alias("half"), high.alias("word")),
        )
    )
    rows = fps.select("fp", halves.alias("h")).select("fp", "h.half", "h.word")
    rows = rows.withColumn("syndrome", _syndrome(F.col("word")))
    home = F.when(F.col("syndrome") == 0, F.col("word")).otherwise(
        F.col("word").bitwiseXOR(_bit(F.col("syndrome")))
    )
    return rows.withColumn("home", home)


def _key(anchor: Column) -> Column:
    return anchor + F.col("half") * (1 << 32)


def anchors(fps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Home rows (one per half) and copied rows (every anchor within radius + 1)."""
    rows = _halves(fps)
    places = F.array(*[F.lit(i) for i in range(1, 32)])

    def partner(place: Column) -> Column:
        return place.bitwiseXOR(F.col("syndrome"))

    # Code words at distance 2: two flips whose places cancel the syndrome.
    pairs = F.filter(places, lambda i: partner(i) > i)
    far = F.transform(
        pairs, lambda i: F.col("word").bitwiseXOR(_bit(i)).bitwiseXOR(_bit(partner(i)))
    )
    near = F.array(F.col("home"), F.col("home").bitwiseXOR(F.lit(1 << 31)))
    homes = rows.select(_key(F.col("home")).alias("anchor"), F.col("fp").alias("a"))
    copies = rows.select("half", "fp", F.explode(F.concat(near, far)).alias("word"))
    return homes, copies.select(_key(F.col("word")).alias("anchor"), F.col("fp").alias("b"))


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs a < b of different fingerprints that differ in at most ``max_bits`` (3) bits."""
    if max_bits > MAX_BITS:
        raise ValueError(f"the two covering codes reach {MAX_BITS} bits")
    homes, copies = anchors(fps)
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return homes.join(copies, (homes["anchor"] == copies["anchor"]) & (F.col("a") < F.col("b")) & close).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the smallest node.

    Rounds of large star and small star: each links a node's neighbours to the smallest
    one, on its larger and then on its smaller side. A node's minimum is combined before
    the shuffle. It ends when a round changes nothing, which two sums show.
    """

    def star(pairs: DataFrame, larger: bool) -> DataFrame:
        """pairs: u, v. Everything on one side of u is linked to the least of u and its side."""
        if larger:
            both = pairs.select("u", "v").unionByName(
                pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))
            )
        else:
            both = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        side = both.filter(F.col("v") > F.col("u")) if larger else both
        linked = side.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        if not larger:
            linked = linked.unionByName(least.select("u", F.col("m").alias("v")))
        return linked.filter(F.col("u") != F.col("v")).distinct()

    def state(pairs: DataFrame):
        return pairs.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()

    now = written(edges.select(F.col("b").alias("u"), F.col("a").alias("v")), "near-links")
    before = None
    while (after := state(now)) != before:
        before = after
        wide = written(star(now, True), "near-large-star")
        now = written(star(wide, False), "near-small-star")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))



def _rank() -> Column:
    """Where a document stands in its group: the smallest id first, null ids last."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "hash")


def _grouped(docs: DataFrame, id_col: str, text_col: str, max_bits: int) -> DataFrame:
    """doc_id, hash, fp and ``best``, the rank of the first document of the component."""
    rows = written(fingerprints(docs, id_col, text_col), "near-fingerprints")
    distinct = written(rows.groupBy("fp").agg(F.min(_rank()).alias("best")), "near-distinct")
    roots = components(links(distinct.select("fp"), max_bits))
    grouped = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "best", F.coalesce("root", "fp").alias("root")
    )
    least = grouped.groupBy("root").agg(F.min("best").alias("best"))
    of_fp = written(grouped.drop("best").join(least, "root").select("fp", "best"), "near-roots")
    return rows.join(of_fp, "fp")


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per document: fingerprint (16 hexadecimal digits) and ``component_id``."""
    return _grouped(docs, id_col, text_col, max_bits).select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("best.doc_id").alias("component_id"),
    )


def keep_one_of_group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """The first document of each component, with all its columns.

    Rows that agree in id and text cannot be told apart and stay together; exact dedup
    comes before.
    """
    grouped = _grouped(docs, id_col, text_col, max_bits)
    gone = written(grouped.filter(_rank() != F.col("best")).select("doc_id", "hash"), "near-dropped")
    rows = _keyed(docs, id_col, text_col).drop("text")
    same = rows["doc_id"].eqNullSafe(gone["doc_id"]) & (rows["hash"] == gone["hash"])
    stay = rows.join(gone, same, "left_anti")
    return stay.select(*[F.col("row")[c].alias(c) for c in docs.columns])


@query()
def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_groups(table(spark, folder, "documents"))
