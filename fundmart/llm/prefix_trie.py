"""Conversation prefix trie by fixed-length block hashing.

A conversation is a sequence of turns; a node of the trie is a distinct sequence of first
turns. Turns are cut into blocks of ``BLOCK``. Conversations are first grouped by the digests
of their successive blocks: all that share the blocks so far and have the next block in
common go through it together. Only in a block where siblings diverge (or where some of them
end) are the boundaries between its turns looked at one by one; in all others the whole block
is one segment with one set of members. What follows works on segments:

- a node belongs to the smallest of its members, so the nodes that a conversation owns are
  the last part of its path, and a node is known by its owner and its depth;
- a sum over the subtree of a node is a sum over its members, each of which brings what lies
  behind the node on its own path: for saved tokens the words of the turns that it does not
  own, for leaves whether it owns the node in which it ends.

So nothing walks the tree: one sum along each path, and one aggregate per segment. Texts are
read once; afterwards only 256-bit digests of turns and blocks and word counts move.

Sizes: a conversation that holds a third of all turns is numbered over sampled ranges, its
blocks are added up in pieces of ``PIECE`` turns, and first turns that many conversations
share are combined before every shuffle. Conversations that end in one node are hashed in
order, ``IDS`` consecutive ids a row, by a task that holds one batch of rows.

Defined results: rows without a conversation id are left out; a null turn comes first; turns
of equal number are ordered by their digest; null roles and texts are empty; repeated rows are
turns of their own. A conversation of which nothing is left is a member of the root. Very long
texts are hashed whole. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundmart.llm.base import NO_SPACE, named, query, table, text_of, written
from fundmart.operators.numbering import number_rows
from fundmart.session import small_side

BLOCK = 4
PIECE = 4096
IDS = 512
# The contract's rebuilding: conversations of one family share up to three first turns.
FAMILY = 20
SHARED = 4


def turns_of(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Turns in order: conv, k (0, 1, 2, ...), digest, words."""
    role, text = text_of(role_col), text_of(text_col)
    # The length tells where the role ends.
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.select(
        named(conv_col).cast("long").alias("conv"),
        named(turn_col).alias("turn"),
        F.unhex(F.sha2(content.cast("binary"), 256)).alias("digest"),
        F.regexp_count(text, F.lit(NO_SPACE)).cast("long").alias("words"),
        # Tells repeated rows apart, so that they need not lie in one range.
        F.monotonically_increasing_id().alias("row"),
    ).filter("conv IS NOT NULL")
    numbered = number_rows(rows, ["conv"], ["turn", "digest", "row"], "k")
    return numbered.select("conv", "k", "digest", "words")


def rebuilt(
    turns: DataFrame, family: int = FAMILY, shared: int = SHARED
) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first one of their family.

    Returns turns (conv, pos from 1, digest, words, length) and all conversations (conv,
    length), both written.
    """
    turns = written(turns, "trie-turns")
    sizes = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    sizes = written(
        sizes.withColumns(
            {
                "base": F.col("conv") - F.col("conv") % family,
                "h": F.crc32(F.col("conv").cast("string").cast("binary")) % shared,
            }
        ),
        "trie-sizes",
    )
    bases = sizes.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    first = F.least("h", F.coalesce("n_base", F.lit(0)))
    convs = written(
        sizes.join(bases, "base", "left").select(
            "conv",
            "base",
            "h",
            first.alias("first"),
            (first + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"),
        ),
        "trie-conversations",
    )
    given = turns.filter(F.col("k") < shared - 1).withColumnRenamed("conv", "base")
    given = given.join(convs.filter("h > 0"), "base").filter("k < h")
    own = turns.join(convs, "conv").filter("k >= h")
    rows = [
        given.withColumn("pos", F.col("k") + 1),
        own.withColumn("pos", F.col("first") + F.col("k") - F.col("h") + 1),
    ]
    columns = ["conv", "pos", "digest", "words", "length"]
    both = rows[0].select(columns).unionByName(rows[1].select(columns))
    return written(both, "trie-rebuilt"), convs.select("conv", "length")


def _along(rows: DataFrame, at: str, forward: bool, total, **values: Column) -> DataFrame:
    """The rows with running totals (``total``: an aggregate function) of ``values`` along each
    conversation, the row itself included, from its beginning or (``forward`` false) its end.

    Totals run inside pieces of ``PIECE`` turns, and over one row per piece for what lies
    before; only conversations of several pieces have such rows.
    """
    piece = F.floor(F.col(at) / PIECE).alias("piece")
    rows = rows.select("*", piece, *[v.alias(f"_{n}") for n, v in values.items()])
    direction = F.asc if forward else F.desc
    inside = W.partitionBy("conv", "piece").orderBy(direction(at))
    inside = inside.rowsBetween(W.unboundedPreceding, 0)
    pieces = rows.groupBy("conv", "piece").agg(
        *[total(f"_{n}").alias(f"_{n}") for n in values], F.max(at).alias("_last")
    )
    earlier = W.partitionBy("conv").orderBy(direction("piece"))
    earlier = earlier.rowsBetween(W.unboundedPreceding, -1)
    before = pieces.select(
        "conv", "piece", *[total(f"_{n}").over(earlier).alias(f"_{n}_before") for n in values]
    ).filter(F.col(f"_{next(iter(values))}_before").isNotNull())
    here = rows.withColumns({n: total(f"_{n}").over(inside) for n in values})
    here = here.join(small_side(before), ["conv", "piece"], "left")

    def sum_up(name: str) -> Column:
        rest = F.coalesce(f"_{name}_before", F.lit(0).cast("long"))
        if total is F.bit_xor:
            return F.col(name).bitwiseXOR(rest)
        return F.col(name) + rest

    here = here.withColumns({n: sum_up(n) for n in values})
    helpers = [h for n in values for h in (f"_{n}", f"_{n}_before")]
    return here.drop("piece", *helpers)


def _joined(digests: Column) -> Column:
    return F.unhex(F.sha2(F.aggregate(digests, F.lit(b""), lambda a, d: F.concat(a, d)), 256))


def segments_of(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Runs of turns that all conversations in them go through together: conv, length, lo, hi
    (positions), words (of each turn), and the key of the run: lo, before_a, before_b, content."""
    number = F.floor((F.col("pos") - 1) / block)
    blocks = (
        turns.groupBy("conv", number.alias("block"))
        .agg(
            F.sort_array(F.collect_list(F.struct("pos", "digest", "words"))).alias("turns"),
            F.any_value("length").alias("length"),
        )
        .withColumn("content", _joined(F.col("turns.digest")))
    )
    # What stands before a block is known by the blocks' digests, each bound to its place.
    one, other = F.xxhash64("block", "content"), F.xxhash64("content", "block")
    blocks = _along(blocks, "block", True, F.bit_xor, before_a=one, before_b=other)
    blocks = written(
        blocks.withColumns(
            {
                "before_a": F.col("before_a").bitwiseXOR(one),
                "before_b": F.col("before_b").bitwiseXOR(other),
            }
        ),
        "trie-blocks",
    )
    place = ["block", "before_a", "before_b"]
    # Where siblings diverge; a shorter block has another digest, so ends are seen too.
    parting = (
        blocks.groupBy(*place, "content").agg(F.lit(1).alias("one"))
        .groupBy(*place).agg(F.count(F.lit(1)).alias("siblings"))
        .filter("siblings > 1")
    )
    parting = written(parting.select(*place), "trie-parting")
    whole = blocks.join(parting, place, "left_anti").select(
        "conv", "length",
        F.col("turns")[0]["pos"].alias("lo"),
        F.element_at("turns", -1)["pos"].alias("hi"),
        F.col("turns.words").alias("words"),
        "before_a", "before_b", "content",
    )
    single = (
        blocks.join(parting, place, "left_semi")
        .select("*", F.posexplode("turns").alias("i", "turn"))
        .select(
            "conv", "length",
            F.col("turn.pos").alias("lo"), F.col("turn.pos").alias("hi"),
            F.array("turn.words").alias("words"),
            "before_a", "before_b",
            _joined(F.slice("turns.digest", F.lit(1), F.col("i") + 1)).alias("content"),
        )
    )
    return written(whole.unionByName(single), "trie-segments")


def ends_digest(ends: DataFrame) -> DataFrame:
    """conv_id, depth, ends_sha256 of the ids (``conv``) that end in each node, in order."""
    rows = (
        ends.groupBy("conv_id", "depth", F.floor(F.col("conv") / IDS).alias("part"))
        .agg(F.array_join(F.sort_array(F.collect_list("conv")), ",").alias("ids"))
        .repartition("conv_id", "depth")
        .sortWithinPartitions("conv_id", "depth", "part")
        .select("conv_id", "depth", "ids")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for conv_id, depth, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (conv_id, depth) != node:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = (conv_id, depth), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield of(done)
        if node is not None:
            yield of([(*node, state.hexdigest())])

    def of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        types = (pa.int64(), pa.int64(), pa.string())
        arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["conv_id", "depth", "ends_sha256"])

    return rows.mapInArrow(run, "conv_id long, depth long, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per node. ``turns``: conv, pos, digest, words, length; ``convs``: conv, length."""
    segments = segments_of(turns, block)
    key = ["lo", "before_a", "before_b", "content"]
    members = written(
        segments.groupBy(*key).agg(
            F.count(F.lit(1)).alias("n_convs"),
            F.min("conv").alias("owner"),
            F.count_if(F.col("hi") == F.col("length")).alias("ends"),
        ),
        "trie-members",
    )
    own = F.col("conv") == F.col("owner")
    last = F.col("hi") == F.col("length")
    words = F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + w)
    others = F.when(own, F.lit(0).cast("long")).otherwise(words)
    # A conversation stands for the leaf in which it ends if it owns it.
    leaf = F.when(last & own & (F.col("n_convs") == F.col("ends")), 1).otherwise(0).cast("long")
    paths = _along(segments.join(members, key), "lo", False, F.sum, behind=others, leaf=leaf)
    paths = written(paths.withColumn("behind", F.col("behind") - others), "trie-paths")

    runs = paths.groupBy(*key).agg(
        F.any_value("owner").alias("conv_id"),
        F.any_value("n_convs").alias("n_convs"),
        F.sum("leaf").alias("n_leaves"),
        F.sum("behind").alias("behind"),
        F.any_value("words").alias("words"),
    )
    rest = F.aggregate(
        F.slice("words", F.col("i") + 1, F.size("words")), F.lit(0).cast("long"), lambda a, w: a + w
    )
    nodes = runs.select("*", F.posexplode("words").alias("i", "w")).select(
        "conv_id",
        (F.col("lo") + F.col("i")).alias("depth"),
        "n_convs",
        "n_leaves",
        (F.col("behind") + (F.col("n_convs") - 1) * rest).alias("saved_tokens"),
    )

    # Per conversation: where the nodes that it owns begin, who owns the one before, and who
    # owns the one in which it ends. Owners only grow along a path.
    chains = written(
        convs.join(
            paths.groupBy("conv").agg(
                F.min(F.when(own, F.col("lo"))).alias("first"),
                F.max(F.when(~own, F.col("owner"))).alias("above"),
                F.max(F.when(last, F.col("owner"))).alias("end_owner"),
                F.sum(F.when(last, F.col("leaf"))).alias("leaf"),
                F.sum(others).alias("others"),
            ),
            "conv",
            "left",
        ),
        "trie-chains",
    )
    root = chains.agg(
        F.min("conv").alias("conv_id"),
        F.lit(0).cast("long").alias("depth"),
        F.count(F.lit(1)).alias("n_convs"),
        F.greatest(F.sum("leaf"), F.lit(1).cast("long")).alias("n_leaves"),
        F.coalesce(F.sum("others"), F.lit(0)).cast("long").alias("saved_tokens"),
    ).filter("n_convs > 0")
    smallest = F.lit(chains.agg(F.min("conv")).first()[0]).cast("long")
    parent = F.coalesce("above", smallest)
    attached = (
        chains.filter("first IS NOT NULL")
        .groupBy(parent.alias("conv_id"), (F.col("first") - 1).alias("depth"))
        .agg(F.count(F.lit(1)).alias("branches"))
    )
    ends = ends_digest(
        chains.select(
            F.coalesce("end_owner", smallest).alias("conv_id"),
            F.col("length").alias("depth"),
            "conv",
        )
    )
    owners = chains.select(
        F.col("conv").alias("conv_id"), "first", "length", parent.alias("above")
    )
    node = ["conv_id", "depth"]
    all_nodes = nodes.unionByName(root).join(owners, "conv_id")
    all_nodes = all_nodes.join(attached, node, "left").join(ends, node, "left")
    depth = F.col("depth")
    on_path = F.when((depth > 0) & (depth < F.col("length")), 1).otherwise(0)
    above = F.when(depth == F.col("first"), F.col("above")).otherwise(F.col("conv_id"))
    return all_nodes.select(
        "conv_id",
        "depth",
        F.when(depth > 0, above).alias("parent_conv_id"),
        "n_convs",
        (on_path + F.coalesce("branches", F.lit(0))).cast("long").alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )


def prefix_trie(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """The trie of conversations as they are: ``turns`` as ``turns_of`` gives them."""
    length = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("length"))
    rows = turns.join(length, "conv").withColumn("pos", F.col("k") + 1)
    return trie(rows, length, block)


@query(
    r"""
WITH numbered AS (
 SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
  PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k
 FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
 SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(
  list_prepend(4294967295::BIGINT, [ord(x)::BIGINT FOR x IN string_split(conv_id::VARCHAR, '')]),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
   lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 4 AS h
 FROM (SELECT DISTINCT conv_id FROM numbered)),
rebuilt AS (
 SELECT c.conv_id, 0 AS part, n.k, n.role, n.text
 FROM convs c JOIN numbered n ON n.conv_id = c.base AND n.k <= c.h
 UNION ALL SELECT c.conv_id, 1, n.k, n.role, n.text
 FROM convs c JOIN numbered n ON n.conv_id = c.conv_id AND n.k > c.h),
paths AS (
 SELECT conv_id, coalesce(any_value(p), []) AS path FROM convs LEFT JOIN (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY part, k) AS p
  FROM rebuilt GROUP BY 1) USING (conv_id) GROUP BY 1),
members AS (
 SELECT conv_id, len(path) AS length, d, path[1:d] AS path
 FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM paths)),
nodes AS (
 SELECT d, path, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(
   CASE WHEN length = d THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256,
  CASE WHEN d = 0 THEN 0
   ELSE len(regexp_extract_all(path[d].text, '[^\x20\x09-\x0D]+')) END AS words
 FROM members GROUP BY d, path),
above AS (
 SELECT s.*, a.conv_id AS top, a.d AS top_d
 FROM (SELECT *, unnest(range(d + 1)) AS pd FROM nodes) s
 JOIN nodes a ON a.d = s.pd AND a.path = s.path[1:s.pd]),
parents AS (SELECT top AS conv_id, top_d AS depth, count(*) AS n_children FROM above
 WHERE d = top_d + 1 GROUP BY 1, 2)
SELECT n.conv_id, n.d AS depth, p.top AS parent_conv_id, n.n_convs,
 coalesce(c.n_children, 0) AS n_children, t.n_leaves, t.saved_tokens, n.ends_sha256
FROM nodes n
LEFT JOIN above p ON p.conv_id = n.conv_id AND p.d = n.d AND p.top_d = n.d - 1
LEFT JOIN parents c ON c.conv_id = n.conv_id AND c.depth = n.d
JOIN (SELECT a.top, a.top_d, count(*) FILTER (k.n_children IS NULL) AS n_leaves,
  sum((a.n_convs - 1) * a.words)::BIGINT AS saved_tokens
 FROM above a LEFT JOIN parents k ON k.conv_id = a.conv_id AND k.depth = a.d GROUP BY 1, 2) t
 ON t.top = n.conv_id AND t.top_d = n.d
"""
)
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie(*rebuilt(turns_of(table(spark, folder, "conversations"))))
