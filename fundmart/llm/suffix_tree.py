"""LM scoring with a probabilistic suffix tree.

A text is read as its lower-case words, joined by single spaces, and an end symbol; the
symbols of the model are its bytes, so words never seen before have a probability too.
Every training text is counted. Contexts are any strings of up to ``DEPTH`` bytes, and longer
ones that reach back to the beginning of the word. A context is retained when

- it is seen at least ``LEAST_COUNT`` times, whatever the size of the corpus, and
- its next-symbol distribution diverges from the one of its longest suffix: the
  Kullback-Leibler divergence times the context's count must exceed what its number of
  different symbols brings by chance (half of it times the logarithm of the count),

or when it is a suffix of up to ``DEPTH`` bytes of a retained context. A symbol's
probability comes from the longest retained suffix of what stands before it, smoothed by the
next shorter one with the weight of the number of different symbols seen (Witten and Bell),
down to the uniform distribution over bytes. Probabilities of all texts therefore add up to
one.

Sizes: the tree grows with the corpus; all symbols seen after a retained context are kept.
It is a written table, one row per context. As many contexts as ``TREE_BYTES`` hold, the most
frequent ones, are sent to every task; as a context is never more frequent than its suffixes,
the suffixes of a context that is sent are sent too. Of the others tasks get a filter of fixed
size. A symbol whose context may be among those (a few in a thousand, as they are the rarest)
is left open: each document's open symbols are counted and joined with the probabilities that
Spark puts together from the table. Words are treated alike: those that make up at least
``COMMON_SHARE`` of all tokens are sent, the rarer ones of each document, and only these, are
joined with their counts. Counting, tests and joins are Spark jobs over all training texts;
nothing else reaches the driver. Very long texts are scored whole, as a block of their own.

Defined results: a null or empty text is the end symbol alone; a null id is not held out;
without any training text every distribution is uniform, all counts are 0 and ``base_score``
is 0 words of 1 (0.0); repeated rows each get their own, equal result; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundmart.llm.base import held_out, named, query, table, text_of, written

FOLDS = 7
DEPTH = 5
LEAST_COUNT = 4
# Tasks get the most frequent contexts up to this size. A context and each of its pairs with a
# symbol are two numbers.
TREE_BYTES = 96 << 20
PAIR_BYTES = CONTEXT_BYTES = 16
# Codes within the depth whose probabilities a task remembers.
KNOWN_CODES = 500_000
# A task keeps the logarithms of symbols in context in so many (power of two) slots.
SLOT_BITS = 21
# Contexts are sent by classes of their count, so many for each doubling.
CLASSES = 4
# Bits of the filter of those that are not sent.
FILTER_BITS = 26
# Marks the code of a symbol whose context reaches back to the beginning of its word.
BEGUN = 1 << 62
# The same for the code of such a context, by its hash, and a symbol.
BEGUN_PAIR = 1 << 63
# The shortest contexts belong to many symbols and are repeated so many times for the join.
SALTS = 64
# Contexts from the beginning of a word have at most so many bytes of it.
LONGEST = 24
COMMON_SHARE = 2e-6
# Longer words are never sent to every task, however common.
COMMON_BYTES = 64
# Texts are taken together until they have so many bytes: larger blocks combine more counts,
# smaller ones keep what scoring sorts near the processor.
COUNT_BLOCK_BYTES = 4 << 20
BLOCK_BYTES = 1 << 19
# White space, so no word contains it.
END = 0x0A
SPACE = 0x20
# Odd multipliers of a polynomial hash modulo 2**64, and the first one's inverse.
STEP = 0x9E3779B97F4A7C15
BACK = pow(STEP, -1, 1 << 64)
PAIR = 0xC2B2AE3D27D4EB4F


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, list[bytes]]:
    """Lower-case words (A-Z only, split at ASCII spaces) of all texts, how many each has, and
    the bytes that are modelled of each."""
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(texts))
    words = pc.ascii_split_whitespace(texts)
    modelled = pc.binary_join(words, " ").cast(pa.binary()).to_pylist()
    # An empty text is split into one empty word.
    lengths = np.where(pc.equal(pc.binary_length(texts), 0), 0, words.value_lengths())
    words = words.flatten()
    words = words.filter(pc.greater(pc.binary_length(words), 0)).cast(pa.binary())
    return words, lengths, [t + bytes([END]) for t in modelled]


def normalised(text: str) -> tuple[list[bytes], bytes]:
    """The words and the modelled bytes of one text."""
    words, _, modelled = split_words(pa.array([text], pa.string()))
    return words.to_pylist(), modelled[0]


def grams(texts: Sequence[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """A code per symbol (``depth`` bytes of context, then the symbol), and where texts end.

    Before a text there are end symbols.
    """
    pad = bytes([END]) * depth
    data = pad + pad.join(texts)
    n = len(data) - depth
    # The eight bytes from each place on, without those behind the symbol.
    behind = 7 - depth
    codes = np.ndarray((n,), ">u8", data + bytes(behind), strides=(1,)) >> np.uint64(8 * behind)
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths + depth) - depth
    keep = np.ones(n, bool)
    for end in ends[:-1]:
        keep[end : end + depth] = False
    return codes[keep], np.cumsum(lengths)


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows (last column: texts) in groups of about ``most`` bytes."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(-1)), dtype=np.int64)
        start, before = 0, 0
        while start < batch.num_rows:
            stop = min(int(np.searchsorted(ends, before + most)) + 1, batch.num_rows)
            yield batch.slice(start, stop - start)
            start, before = stop, ends[stop - 1]


def known_words(
    words: pa.Array, lengths: np.ndarray, known: pa.Array, logs: np.ndarray
) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """How many words of each text are among the known ones, the sum of their ``logs``, and the
    text's other words (``word``) with how often they occur (``k``)."""
    place = pc.index_in(words, value_set=known)
    text = np.repeat(np.arange(len(lengths)), lengths)
    here = pc.is_valid(place).to_numpy(zero_copy_only=False)
    n_known = np.bincount(text[here], minlength=len(lengths))
    sums = np.bincount(text[here], logs[place.drop_null().to_numpy()], len(lengths))
    others = words.filter(pc.is_null(place)).dictionary_encode()
    kinds, ids = others.dictionary, others.indices.to_numpy().astype(np.int64)
    rare, k = np.unique(text[~here] * len(kinds) + ids, return_counts=True)
    text, word = np.divmod(rare, max(len(kinds), 1))
    pairs = pa.StructArray.from_arrays([kinds.take(pa.array(word)), pa.array(k)], ["word", "k"])
    bounds = np.searchsorted(text, np.arange(len(lengths) + 1)).astype(np.int32)
    return n_known, sums, pa.ListArray.from_arrays(pa.array(bounds), pairs)


def count_corpus(docs: DataFrame, folds: int, id_col: str, text_col: str, depth: int) -> DataFrame:
    """Counts over all training texts: words (``word``), symbols in context (``code``), and
    texts (code -1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, COUNT_BLOCK_BYTES):
            words, _, texts = split_words(block.column(0))
            words = pc.value_counts(words)
            codes, counts = np.unique(grams(texts, depth)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays(
                        [words.field("values"), pa.nulls(len(codes) + 1, pa.binary())]
                    ),
                    pa.concat_arrays(
                        [
                            pa.nulls(len(words), pa.int64()),
                            pa.array(codes.astype(np.int64)),
                            pa.array([-1], pa.int64()),
                        ]
                    ),
                    pa.concat_arrays(
                        [
                            words.field("counts"),
                            pa.array(counts.astype(np.int64)),
                            pa.array([block.num_rows], pa.int64()),
                        ]
                    ),
                ],
                ["word", "code", "n"],
            )

    training = docs.filter(~held_out(id_col, folds)).select(text_of(text_col).alias("text"))
    counted = training.mapInArrow(run, "word binary, code long, n long")
    return counted.groupBy("word", "code").agg(F.sum("n").alias("n"))


def _suffix(column: str, length):
    """The last ``length`` bytes of a context code."""
    return F.col(column).bitwiseAND(
        F.call_function("shiftleft", F.lit(1).cast("long"), 8 * length) - 1
    )


def _distributions(pairs: DataFrame, *keys: str) -> DataFrame:
    """One row per context, from its symbols and their counts: total, kinds, dist.

    A context has 256 symbols at most.
    """
    return pairs.groupBy(*keys).agg(
        F.sum("n").alias("total"),
        F.count(F.lit(1)).alias("kinds"),
        F.collect_list(F.struct("symbol", "n")).alias("dist"),
    )


def retained_contexts(
    counts: DataFrame, words: DataFrame, depth: int
) -> tuple[DataFrame, DataFrame]:
    """The tree's distributions: (length, context, total, kinds, dist) for lengths 0 (the root)
    to ``depth``, and (begin, context: the hash of begin, total, kinds, dist) for the longer
    contexts; ``dist`` holds each symbol and its count.

    ``counts``: code, n; ``words``: word, c.
    """
    context = F.shiftright(F.col("code"), 8)
    cut = [
        F.struct(
            F.lit(k).alias("length"),
            context.bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("context"),
        )
        for k in range(depth + 1)
    ]
    pairs = (
        counts.select(
            F.explode(F.array(*cut)).alias("at"),
            F.col("code").bitwiseAND(F.lit(255)).alias("symbol"),
            "n",
        )
        .groupBy("at.length", "at.context", "symbol")
        .agg(F.sum("n").alias("n"))
    )
    # The root stays however small the corpus.
    frequent = (F.col("total") >= LEAST_COUNT) | (F.col("length") == 0)
    contexts = written(
        _distributions(pairs, "length", "context").filter(frequent), "tree-contexts"
    )

    # A frequent context's suffixes are frequent too.
    child = contexts.filter("length > 0").withColumn("above", F.col("length") - 1)
    child = child.withColumn("parent", _suffix("context", F.col("above")))
    tested = _diverging(child, contexts, ["above", "parent"])
    chain = F.transform(
        F.sequence(F.lit(0), F.col("length")),
        lambda k: F.struct(k.alias("length"), _suffix("context", k).alias("context")),
    )
    long = _word_contexts(words, contexts, depth)
    # The suffixes of contexts from the beginning of a word stay too.
    below = long.select(F.lit(depth).alias("length"), F.col("parent").alias("context")).distinct()
    closed = (
        tested.select("length", "context")
        .unionByName(below)
        .select(F.explode(chain).alias("at"))
        .select("at.length", "at.context")
        .distinct()
    )
    root = contexts.filter("length = 0")
    kept = contexts.filter("length > 0").join(closed, ["length", "context"], "left_semi")
    kept = written(root.unionByName(kept.select(root.columns)), "tree-kept")
    return kept, long


def _diverging(child: DataFrame, contexts: DataFrame, on: list[str]) -> DataFrame:
    """The contexts of ``child`` that pass the test against their parent in ``contexts``.

    ``on``: the parent's length and code in ``child``.
    """
    above = contexts.select(
        F.col("length").alias(on[0]),
        F.col("context").alias(on[1]),
        F.col("total").alias("total_above"),
        F.map_from_entries("dist").alias("n_above"),
    )
    p = lambda x: x["n"] / F.col("total")
    q = lambda x: F.col("n_above")[x["symbol"]] / F.col("total_above")
    # A text's last word ends with the text, which its own contexts count as a space: a space
    # that the parent never saw adds nothing.
    divergence = F.aggregate(
        "dist",
        F.lit(0.0),
        lambda sum_, x: sum_ + F.coalesce(p(x) * F.log(p(x) / q(x)), F.lit(0.0)),
    )
    passed = divergence * F.col("total") >= F.col("kinds") / 2 * F.log("total")
    return child.join(above, on).filter(passed).select(child.columns)


def _word_contexts(words: DataFrame, contexts: DataFrame, depth: int) -> DataFrame:
    """The contexts longer than ``depth`` that begin with their word and are retained: (begin,
    context: its hash, parent, total, kinds, dist). ``words``: word, c.
    """
    length = F.octet_length("word")
    rows = words.filter(length >= depth).select(
        "word", "c", F.explode(F.sequence(F.lit(depth), F.least(length, F.lit(LONGEST)))).alias("k")
    )
    byte = F.conv(F.hex(F.substring("word", F.col("k") + 1, F.lit(1))), 16, 10).cast("long")
    pairs = rows.select(
        F.substring("word", F.lit(1), F.col("k")).alias("begin"),
        F.when(F.col("k") < length, byte).otherwise(F.lit(SPACE)).alias("symbol"),
        "c",
    )
    pairs = pairs.groupBy("begin", "symbol").agg(F.sum("c").alias("n"))
    last = F.substring("begin", F.octet_length("begin") - depth + 1, F.lit(depth))
    frequent = (
        _distributions(pairs, "begin")
        .filter(F.col("total") >= LEAST_COUNT)
        .withColumn("parent", F.conv(F.hex(last), 16, 10).cast("long"))
        .withColumn("above", F.lit(depth))
    )
    kept = _diverging(frequent, contexts.filter(F.col("length") == depth), ["above", "parent"])
    return written(_begin_hashes(kept.drop("above")), "tree-kept-words")


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        return tuple(
            np.cumprod(np.full(size, step, np.uint64), dtype=np.uint64) for step in (STEP, BACK)
        )


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte: a hash of what its word has before it, and how many bytes that is."""
    n = len(data)
    # Blocks are about equally long, so the powers of one serve the others.
    powers, inverse = _powers(1 << max(n, BLOCK_BYTES).bit_length())
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:n], out=sums[1:])
        at = np.arange(n)
        gap = (data == SPACE) | (data == END)
        first = np.zeros(n, np.int64)
        first[1:] = np.where(gap[:-1], at[1:], 0)
        first = np.maximum.accumulate(first)
        return (sums[:n] - sums[first]) * inverse[first], at - first


def _pair_code(contexts: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """Codes of symbols behind hashed contexts; no code within the depth is one of them."""
    with np.errstate(over="ignore"):
        return (contexts * np.uint64(PAIR) + symbols) | np.uint64(BEGUN_PAIR)


def _level(rows: pa.Table, hashed: bool) -> tuple:
    """Sorted contexts, what each leaves to its suffix, and its sorted pairs' own part.

    ``rows``: context, rest, symbols and owns (one list each).
    """
    contexts = rows.column("context").to_numpy().view(np.uint64)
    rest = rows.column("rest").to_numpy()
    lists = rows.column("symbols").combine_chunks()
    of = np.repeat(contexts, lists.value_lengths().to_numpy())
    symbols = lists.flatten().to_numpy().astype(np.uint64)
    own = rows.column("owns").combine_chunks().flatten().to_numpy()
    codes = _pair_code(of, symbols) if hashed else (of << np.uint64(8)) | symbols
    order, by_pair = np.argsort(contexts), np.argsort(codes)
    return contexts[order], rest[order], codes[by_pair], own[by_pair]


def _find(sorted_codes: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each code, and whether it is there."""
    if not len(sorted_codes):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    place = np.searchsorted(sorted_codes, wanted)
    place[place == len(sorted_codes)] = 0
    return place, sorted_codes[place] == wanted


def _filter_bits(length: int | np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """The bit of each context in the filter."""
    with np.errstate(over="ignore"):
        mixed = (contexts ^ (np.uint64(length) * np.uint64(PAIR))) * np.uint64(STEP)
    return mixed >> np.uint64(64 - FILTER_BITS)


class Memory:
    """What ``find`` gives for sorted codes, most of which were asked for before."""

    def __init__(self, find: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, ...]]) -> None:
        self.find, self.codes, self.values = find, np.zeros(0, np.uint64), ()

    def __call__(self, codes: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, ...]:
        """``others`` has one item more for each code, which ``find`` needs too."""
        if len(self.codes) + len(codes) > 2 * KNOWN_CODES:
            self.codes = self.codes[:0]
            self.values = tuple(x[:0] for x in self.values)
        place = np.searchsorted(self.codes, codes)
        new = np.ones(len(codes), bool)
        inside = place < len(self.codes)
        new[inside] = self.codes[place[inside]] != codes[inside]
        if new.any() or not self.values:
            found = self.find(codes[new], others[new])
            old = self.values or tuple(x[:0] for x in found)
            slots = place[new] + np.arange(np.count_nonzero(new))
            stays = np.ones(len(self.codes) + len(slots), bool)
            stays[slots] = False

            def merged(before: np.ndarray, added: np.ndarray) -> np.ndarray:
                both = np.empty(len(stays), added.dtype)
                both[stays], both[slots] = before, added
                return both

            self.codes = merged(self.codes, codes[new])
            self.values = tuple(merged(x, y) for x, y in zip(old, found, strict=True))
            # Each code has moved behind the new ones before it.
            place += np.cumsum(new) - new
        return tuple(x[place] for x in self.values)


class Slots:
    """The number that ``find`` gives for a code, most of which were asked for before.

    A code has one slot, and the last one that came to it stays there. ``find`` gets places of
    different codes that no slot had.
    """

    def __init__(self) -> None:
        size = 1 << SLOT_BITS
        # Nothing is in its own slot yet.
        self.codes, self.values = np.full(size, 1, np.uint64), np.zeros(size)
        self.codes[self._slot(np.uint64(1))] = 0

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((codes * np.uint64(STEP)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def __call__(
        self, codes: np.ndarray, find: Callable[[np.ndarray], np.ndarray]
    ) -> np.ndarray:
        slots = self._slot(codes)
        values = self.values[slots]
        new = np.flatnonzero(self.codes[slots] != codes)
        if len(new):
            different, first, inverse = np.unique(
                codes[new], return_index=True, return_inverse=True
            )
            found = find(new[first])
            values[new] = found[inverse]
            slots = slots[new[first]]
            self.codes[slots] = different
            stays = self.codes[slots] == different
            self.values[slots[stays]] = found[stays]
        return values


class Tree:
    """Retained contexts per length, sorted, with their distributions as flat arrays.

    ``others`` is a filter of the contexts that are not here, or None if all of them are.
    """

    def __init__(
        self, depth: int, root: np.ndarray, levels: list[tuple], others: np.ndarray | None = None
    ) -> None:
        # One level per length up to the depth, and one for all contexts that are longer.
        self.depth, self.root, self.levels, self.others = depth, root, levels, others
        self.within = Memory(lambda codes, _: self.probabilities(codes))
        self.slots = Slots()

    @classmethod
    def of(cls, stored: DataFrame, depth: int, others: np.ndarray | None = None) -> Tree:
        """From contexts as ``_stored`` has them."""
        weight = F.col("total") + F.col("kinds")
        rows = stored.select(
            "length",
            "context",
            (F.col("kinds") / weight).alias("rest"),
            F.transform("dist", lambda x: x["symbol"].cast("smallint")).alias("symbols"),
            F.transform("dist", lambda x: x["n"] / weight).alias("owns"),
        ).toArrow()

        def level(k: int) -> pa.Table:
            return rows.filter(pc.equal(rows.column("length"), k))

        root = np.full(256, 1 / 256)
        for row in level(0).to_pylist():
            root *= row["rest"]
            root[row["symbols"]] += row["owns"]
        levels = [_level(level(k), k > depth) for k in range(1, depth + 2)]
        return cls(depth, root, levels, others)

    def _elsewhere(self, length: int, contexts: np.ndarray) -> np.ndarray:
        """Whether contexts that are not here may be among the others."""
        if self.others is None:
            return np.zeros(len(contexts), bool)
        bits = _filter_bits(length, contexts)
        cells = self.others[(bits >> np.uint64(6)).astype(np.int64)]
        return (cells >> (bits & np.uint64(63))) & np.uint64(1) == 1

    def probabilities(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of the symbol in each code, from its longest suffix within the depth, and
        whether that suffix may not be here."""
        p = self.root[(codes & np.uint64(255)).astype(np.int64)]
        left_open = np.zeros(len(codes), bool)
        rows = np.arange(len(codes))
        for k, (contexts, left, pairs, own) in enumerate(self.levels[: self.depth], 1):
            wanted = codes[rows] & np.uint64((1 << 8 * (k + 1)) - 1)
            place, known = _find(contexts, wanted >> np.uint64(8))
            # Retained contexts have retained suffixes: the others end here.
            left_open[rows[~known]] = self._elsewhere(k, wanted[~known] >> np.uint64(8))
            rows, wanted, place = rows[known], wanted[known], place[known]
            if not len(rows):
                break
            at, there = _find(pairs, wanted)
            p[rows] = p[rows] * left[place] + np.where(there, own[at], 0.0)
        return p, left_open

    def _changes(
        self, codes: np.ndarray, hashes: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What the context with each hash leaves of its suffix's probability and what it adds,
        for the symbol in each (pair) code, and whether the context may not be here."""
        contexts, left, pairs, own = self.levels[self.depth]
        place, known = _find(contexts, hashes)
        at, there = _find(pairs, codes)
        elsewhere = ~known
        elsewhere[~known] = self._elsewhere(self.depth + 1, hashes[~known])
        keeps, adds = np.ones(len(codes)), np.zeros(len(codes))
        keeps[known] = left[place[known]]
        here = known & there
        adds[here] = own[at[here]]
        return keeps, adds, elsewhere

    def longer(
        self,
        p: np.ndarray,
        left_open: np.ndarray,
        symbols: np.ndarray,
        begins: tuple[np.ndarray, np.ndarray] | None = None,
    ) -> None:
        """Put the contexts that reach back to the word's beginning on the probabilities.

        ``begins`` are the symbols' ``word_hashes``, if they are not those of a whole text.
        """
        hashes, before = word_hashes(symbols) if begins is None else begins
        rows = np.flatnonzero(self._begun(before))
        hashes = hashes[rows]
        keeps, adds, elsewhere = self._changes(_pair_code(hashes, symbols[rows]), hashes)
        left_open[rows] |= elsewhere
        p[rows] = p[rows] * keeps + adds

    def _begun(self, before: np.ndarray) -> np.ndarray:
        """Whether so many bytes of its word before a symbol are a context of their own."""
        return (before >= self.depth) & (before <= LONGEST)

    def score(self, texts: Sequence[bytes]) -> tuple[np.ndarray, pa.Array]:
        """log10 probability of each text without its open symbols, and those as keys (code,
        begin) with their number ``k``."""
        codes, ends = grams(texts, self.depth)
        data = np.frombuffer(b"".join(texts), np.uint8)
        hashes, before = word_hashes(data)

        def find(at: np.ndarray) -> np.ndarray:
            different, inverse = np.unique(codes[at], return_inverse=True)
            p, left_open = (x[inverse] for x in self.within(different, different))
            self.longer(p, left_open, data[at], (hashes[at], before[at]))
            return np.where(left_open, np.nan, np.log10(p))

        # Words repeat: a symbol after a word's beginning needs nothing from before the word.
        begun = _pair_code(hashes, data)
        logs = self.slots(np.where(self._begun(before), begun, codes), find)
        left_open = np.isnan(logs)
        logs[left_open] = 0.0
        starts = np.concatenate(([0], ends[:-1]))
        keys = self._keys(codes, hashes, before, left_open, starts)
        return np.add.reduceat(logs, starts), keys

    def _keys(
        self,
        codes: np.ndarray,
        hashes: np.ndarray,
        before: np.ndarray,
        left_open: np.ndarray,
        starts: np.ndarray,
    ) -> pa.Array:
        """The open symbols of each text. A key's code is marked if ``begin``, the hash of what
        its word has before the symbol, belongs to it."""
        at = np.flatnonzero(left_open)
        text = np.searchsorted(starts, at, side="right") - 1
        begun = self._begun(before[at])
        code = codes[at].astype(np.int64) | np.where(begun, BEGUN, 0)
        begin = np.where(begun, hashes[at], np.uint64(0)).view(np.int64)
        order = np.lexsort((begin, code, text))
        text, code, begin = text[order], code[order], begin[order]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (code[1:] != code[:-1]) | (begin[1:] != begin[:-1])
        first = np.flatnonzero(new)
        k = np.diff(np.append(first, len(text)))
        keys = pa.StructArray.from_arrays(
            [pa.array(code[first]), pa.array(begin[first]), pa.array(k.astype(np.int64))],
            ["code", "begin", "k"],
        )
        offsets = np.searchsorted(text[first], np.arange(len(starts) + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), keys)


def _begin_hashes(rows: DataFrame) -> DataFrame:
    """Rows with the hash (``context``) of their ``begin``, as ``word_hashes`` has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begun = batch.column("begin").to_pylist()
            data = np.frombuffer(b"".join(bytes(b) + b" " for b in begun), np.uint8)
            ends = np.cumsum([len(b) + 1 for b in begun], dtype=np.int64) - 1
            hashes = word_hashes(data)[0][ends].view(np.int64) if begun else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(hashes)], [*batch.schema.names, "context"]
            )

    schema = T.StructType([*rows.schema.fields, T.StructField("context", T.LongType())])
    return rows.mapInArrow(run, schema)


def key_logs(keys: DataFrame, tree: DataFrame, root: np.ndarray, depth: int) -> DataFrame:
    """log10 probability (``log``) of each key (code, begin), from a tree that is a table.

    ``begin`` is the hash of the word's bytes before the symbol if the code is marked as
    ``BEGUN``; ``tree``: length, context, total, kinds, dist.
    """
    weight = F.col("total") + F.col("kinds")
    short = F.col("length") <= 2
    salts = F.when(short, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    shares = F.transform(
        "dist",
        lambda x: F.named_struct(F.lit("symbol"), x["symbol"], F.lit("own"), x["n"] / weight),
    )
    contexts = tree.filter("length > 0").select(
        "length",
        "context",
        (F.col("kinds") / weight).alias("rest"),
        shares.alias("own"),
        F.explode(salts).alias("salt"),
    )
    symbol = F.col("code").bitwiseAND(F.lit(255))
    place = F.array_position(F.col("own.symbol"), symbol).cast("int")
    own = F.coalesce(F.get(F.col("own.own"), place - 1), F.lit(0.0))
    before = F.shiftright(F.col("code"), 8)
    chain = F.array(
        *[
            F.struct(
                F.lit(k).alias("length"),
                before.bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("context"),
            )
            for k in range(1, depth + 1)
        ]
    )
    plain = F.col("code").bitwiseAND(F.lit(BEGUN - 1)).alias("code")
    salt = F.when(short, F.pmod(F.hash("code"), F.lit(SALTS))).otherwise(F.lit(0))
    level = F.when(F.col("rest").isNotNull(), F.struct("length", "rest", own.alias("own")))
    first = F.get(F.array(*[F.lit(float(p)) for p in root]), symbol.cast("int"))
    # From the shortest context to the longest, as in Tree: first within the depth, by code alone.
    value = F.aggregate(F.array_sort("levels"), first, lambda p, x: p * x["rest"] + x["own"])
    codes = (
        keys.select(plain)
        .distinct()
        .select("code", F.explode(chain).alias("at"))
        .select("code", "at.length", "at.context")
        .withColumn("salt", salt)
        .join(contexts, ["length", "context", "salt"], "left")
        .select("code", level.alias("level"))
        .groupBy("code")
        .agg(F.collect_list("level").alias("levels"))
        .select("code", value.alias("p"))
    )
    begun = (
        keys.filter(F.col("code") >= BEGUN)
        .select(plain, "begin")
        .join(codes, "code")
        .join(
            contexts.filter(F.col("length") == depth + 1).select(
                F.col("context").alias("begin"), "rest", "own"
            ),
            "begin",
            "left",
        )
    )
    longest = F.col("p") * F.coalesce("rest", F.lit(1.0)) + own
    begun = begun.select(
        (F.col("code") + F.lit(BEGUN)).alias("code"), "begin", F.log10(longest).alias("log")
    )
    rest = keys.filter(F.col("code") < BEGUN).join(codes, "code")
    return begun.unionByName(rest.select("code", "begin", F.log10("p").alias("log")))


def _counted(
    docs: DataFrame, id_col: str, text_col: str, folds: int, depth: int
) -> tuple[DataFrame, DataFrame, int]:
    """The counts of symbols in context and of words, and the number of training texts."""
    counts = written(count_corpus(docs, folds, id_col, text_col, depth), "tree-counts")
    words = counts.filter("word IS NOT NULL").select("word", F.col("n").alias("c"))
    texts = counts.filter("code = -1").agg(F.sum("n")).first()[0] or 0
    return counts.filter("code >= 0").select("code", "n"), words, texts


def learn(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = FOLDS,
    depth: int = DEPTH,
) -> tuple[Tree, DataFrame, int]:
    """The tree, the counts of all training words, and the number of training texts."""
    counts, words, texts = _counted(docs, id_col, text_col, folds, depth)
    kept, long = retained_contexts(counts, words, depth)
    return Tree.of(_stored(kept, long, depth), depth), words, texts


def _stored(kept: DataFrame, long: DataFrame, depth: int) -> DataFrame:
    """The whole tree: length (``depth`` + 1 for all longer ones), context, total, kinds, dist."""
    longer = long.withColumn("length", F.lit(depth + 1))
    return kept.unionByName(longer.select(kept.columns))


def _filter_of(contexts: DataFrame) -> np.ndarray:
    """The filter of these contexts (length, context), put together by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column(1).to_numpy().view(np.uint64)
            bits = np.unique(_filter_bits(batch.column(0).to_numpy().astype(np.uint64), codes))
            cells, first = np.unique(bits >> np.uint64(6), return_index=True)
            masks = np.uint64(1) << (bits & np.uint64(63))
            masks = np.bitwise_or.reduceat(masks, first) if len(first) else masks
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells.astype(np.int32)), pa.array(masks.view(np.int64))],
                ["cell", "mask"],
            )

    cells = contexts.select("length", "context").mapInArrow(run, "cell int, mask long")
    found = cells.groupBy("cell").agg(F.bit_or("mask").alias("mask")).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    bits[found.column("cell").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    return bits


def _sent(stored: DataFrame, depth: int) -> Tree:
    """The most frequent contexts of a tree (length, context, total, kinds, dist), and a filter
    of the others."""
    of_count = F.floor(F.log2(F.col("total") + 1) * CLASSES).cast("int")
    size = F.col("kinds") * PAIR_BYTES + CONTEXT_BYTES
    sizes = stored.groupBy(of_count.alias("class")).agg(F.sum(size).alias("bytes")).collect()
    least, used = None, 0
    for row in sorted(sizes, key=lambda r: -r["class"]):
        used += row["bytes"]
        if used > TREE_BYTES:
            break
        least = row["class"]
    whole = used <= TREE_BYTES
    # The root is always sent.
    here = F.col("length") == 0
    if least is not None:
        here = here | (of_count >= least)
    others = None if whole else _filter_of(stored.filter(~here))
    return Tree.of(stored.filter(here), depth, others)


def score_corpus(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = FOLDS,
    depth: int = DEPTH,
) -> DataFrame:
    """One row per document: base score by word counts and score by the tree."""
    spark = docs.sparkSession
    counts, words, texts = _counted(docs, id_col, text_col, folds, depth)
    kept, long = retained_contexts(counts, words, depth)
    stored = _stored(kept, long, depth)
    tree = _sent(stored, depth)
    model = (tree.depth, tree.root, tree.levels, tree.others)
    whole = tree.others is None
    sums = words.agg(F.sum("c"), F.count(F.lit(1))).first()
    # The end is a token too.
    n_tokens, n_kinds = (sums[0] or 0) + texts, sums[1] + (texts > 0)
    common = words.filter(
        (F.col("c") >= COMMON_SHARE * n_tokens) & (F.octet_length("word") <= COMMON_BYTES)
    )
    common = common.toArrow().combine_chunks()
    known = pa.array(common.column("word").to_pylist(), pa.binary())
    logs = np.log10(common.column("c").to_numpy() + 1.0)
    # Both have a proven bound, see above.
    sent = spark.sparkContext.broadcast((model, known, logs, {}))
    weight = math.log10(n_tokens + n_kinds + 1)
    end_part = math.log10(texts + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, frequent, values, kept = sent.value
        # What one task of a worker has looked up serves the next one.
        if "scorer" not in kept:
            kept["scorer"] = Tree(*model)
        row = TaskContext.get().partitionId() << 40
        # A document's place in its task names it until its parts are added up.
        for block in _blocks(batches, BLOCK_BYTES):
            doc_ids, is_held, own = block.columns
            words, lengths, own = split_words(own)
            scores, keys = kept["scorer"].score(own)
            n_known, base, rare = known_words(words, lengths, frequent, values)
            arrays = [
                pa.array(np.arange(row, row + block.num_rows)),
                doc_ids,
                is_held,
                pa.array(lengths + 1, pa.int64()),
                pa.array(n_known + int(texts > 0)),
                pa.array(base + end_part - (lengths + 1) * weight),
                pa.array(scores),
            ]
            yield pa.RecordBatch.from_arrays([*arrays, rare, keys], names)
            row += block.num_rows

    names = [
        "row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rare", "keys"
    ]
    rows = docs.select(
        named(id_col).cast("long").alias("doc_id"),
        held_out(id_col, folds).alias("held_out"),
        text_of(text_col).alias("text"),
    )
    scored = rows.mapInArrow(
        run,
        "row long, doc_id long, held_out boolean, n_tokens long, n_known long, "
        "base_score double, score double, rare array<struct<word: binary, k: bigint>>, "
        "keys array<struct<code: bigint, begin: bigint, k: bigint>>",
    )
    # Written once: the row numbers that follow are then fixed.
    scored = written(scored, "tree-scored")
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.k")
    more = (
        rare.join(words, "word")
        .groupBy("row")
        .agg(
            F.sum("k").alias("more_known"),
            F.sum(F.col("k") * F.log10(F.col("c") + 1)).alias("more_score"),
        )
    )
    scores = scored.drop("rare", "keys")
    if not whole:
        rest = scored.select("row", F.explode("keys").alias("r")).select("row", "r.*")
        logs = key_logs(rest.select("code", "begin").distinct(), stored, tree.root, depth)
        rest = (
            rest.join(logs, ["code", "begin"])
            .groupBy("row")
            .agg(F.sum(F.col("k") * F.col("log")).alias("rest"))
        )
        scores = scores.join(rest, "row", "left").withColumn(
            "score", F.col("score") + F.coalesce("rest", F.lit(0.0))
        )
    return (
        scores.join(more, "row", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
            F.lit(n_tokens).cast("long").alias("train_tokens"),
            (F.col("base_score") + F.coalesce("more_score", F.lit(0.0))).alias("base_score"),
            "score",
        )
    )


@query()
def op7_suffix_tree(spark: SparkSession, folder: str) -> DataFrame:
    return score_corpus(table(spark, folder, "documents"))
