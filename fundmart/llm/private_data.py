"""Personal data by information-theoretic sanitisation.

E-mail addresses, IP addresses, card and phone numbers are found by pattern; their values
are the protected entities. The corpus then tells what else gives an entity away: counts
over all documents give the pointwise mutual information of an entity and each of the
``WINDOW`` words on each side of its places, and its share of the entity's information content
says how much of the entity the word discloses (1: the word is found with the entity only).
In documents with the entity, words from ``REMOVE`` on are removed and words from ``GENERALISE``
on generalised to a placeholder. A removed word that has the entity near in ``ALONE`` of all
documents that hold it gives the entity away by itself and is removed from every text. A word
must have been seen with the entity in ``LEAST_CONTEXTS``
different surroundings, so copies of one text prove nothing.

One pass finds the patterns and writes one row per document. The words around entities that
have been seen often enough are paired with them and combined before the shuffle. A second pass counts in how many documents each paired word stands, a third finds the places of
disclosing words. Which words matter is sent along as a bitmap of bounded size; false ones drop
out at the join. No pass takes longer than in proportion to the text, however it looks.

Defined results: a null or empty text has no spans; matches that fail their check are
dropped and not tried again; spans do not overlap within a kind; a word span never overlaps
a pattern's; repeated rows each get their own, equal result, whatever their ids; an empty
table gives no rows; extra columns are ignored; very long texts go through whole.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundmart.llm.base import named, query, table, text_of, written

# The kinds in the order that counts and digests use.
KINDS = ("email", "ip", "card", "phone")
# Kinds of the words that the method adds.
GENERALISED = "generalised"
REMOVED = "removed"
WINDOW = 30
LEAST_CONTEXTS = 2
GENERALISE = 0.6
REMOVE = 0.8
ALONE = 0.5
# Bits of the bitmap that is sent: so many for a word, between these sizes.
BITS_A_WORD = 16
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 25
KNOWN = 300_000
SEED = 42

# The patterns. Runs of digits are tried from their beginning only, which
# finds the same matches in linear time.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")
_TERM = re.compile(r"[^\W_]{3,}")

Span = tuple[int, int, str]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        start = at
        if domain:
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
        if domain and start < at:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) << (i & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def pattern_spans(text: str) -> list[Span]:
    """(start, end, kind) in code points, by start, then kind as listed."""
    spans: list[Span] = [(a, b, "email") for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
                spans.append((*m.span(), "ip"))
        for m in _CARD.finditer(text):
            digits = m.end() - m.start()
            if digits >= 12:
                value = _NO_DIGIT.sub("", m.group())
                if 12 <= len(value) <= 19 and _luhn(value):
                    spans.append((*m.span(), "card"))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_NO_DIGIT.sub("", m.group())) <= 15:
                    spans.append((*m.span(), "phone"))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def entity(text: str, span: Span) -> str:
    """What a span names, however it is written."""
    value = text[span[0] : span[1]]
    if span[2] in ("card", "phone"):
        value = _NO_DIGIT.sub("", value)
    return f"{span[2]}:{value.lower()}"


def words_outside(text: str, spans: list[Span]) -> list[Span]:
    """(start, end, word in lower case) for the words that touch no pattern."""
    words, at = [], 0
    for m in _TERM.finditer(text):
        while at < len(spans) and spans[at][1] <= m.start():
            at += 1
        if at == len(spans) or m.end() <= spans[at][0]:
            words.append((*m.span(), m.group().lower()))
    return words


def surroundings(text: str, spans: list[Span], window: int = WINDOW) -> dict[str, list[str]]:
    """Per entity the different words around all its places in this text."""
    words = words_outside(text, spans)
    starts = np.array([w[0] for w in words], np.int64)
    found: dict[str, set[str]] = {}
    for span in spans:
        first = int(np.searchsorted(starts, span[0]))
        last = int(np.searchsorted(starts, span[1]))
        near = words[max(0, first - window) : first] + words[last : last + window]
        found.setdefault(entity(text, span), set()).update(w for _, _, w in near)
    return {e: sorted(near) for e, near in found.items()}


def sanitised(text: str, spans: list[Span]) -> str:
    """The text with patterns replaced by their kind; words are removed or generalised."""
    out, at = [], 0
    for a, b, kind in sorted(spans):
        if a < at:
            continue
        out.append(text[at:a])
        if kind in KINDS:
            out.append(f"[{kind.upper()}]")
        elif kind == GENERALISED:
            out.append("[TERM]")
        at = b
    return "".join(out) + text[at:]


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), SEED)


def _spans_of(line: str) -> list[Span]:
    """What ``joined`` wrote."""
    parts = (p.split(":") for p in line.split(",") if p)
    return [(int(a), int(b), kind) for kind, a, b in parts]


def _found(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: base results, the text, its entities with their surroundings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            columns: list[list] = [[] for _ in range(9)]
            for value in batch.column(1):
                text = value.as_py()
                spans = pattern_spans(text)
                base = joined(spans)
                counts = Counter(kind for _, _, kind in spans)
                near = surroundings(text, spans) if spans else {}
                entities = [{"entity": e, "words": words} for e, words in near.items()]
                digest = hashlib.sha256(base.encode()).hexdigest()
                values = (row, *(counts[k] for k in KINDS), digest, base, text, entities)
                for column, v in zip(columns, values, strict=True):
                    column.append(v)
                row += 1
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    rows = docs.select(named(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    schema = (
        f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, row long, n_email long, "
        "n_ip long, n_card long, n_phone long, base_sha256 string, base_spans string, "
        "text string, entities array<struct<entity: string, words: array<string>>>"
    )
    names = ["doc_id", "row", *(f"n_{k}" for k in KINDS), "base_sha256", "base_spans", "text"]
    names.append("entities")
    types = [pa.int64()] * 5 + [pa.string()] * 3
    place = [("entity", pa.string()), ("words", pa.list_(pa.string()))]
    types.append(pa.list_(pa.struct(place)))
    # Written once: the row numbers, which name a row from here on, are then fixed.
    return written(rows.mapInArrow(run, schema), "private-found")


class Marked:
    """Whether a word may be one of those in a table: never wrong for those that are."""

    def __init__(self, terms: DataFrame) -> None:
        bits = LEAST_BITS
        while bits < min(MOST_BITS, BITS_A_WORD * terms.count()):
            bits *= 2
        # A row for each 64 bits that hold one; Spark's hash is the one that tasks use.
        cells = (
            terms.select(F.xxhash64("term").bitwiseAND(F.lit(bits - 1)).alias("bit"))
            .groupBy(F.expr("shiftright(bit, 6)").alias("cell"))
            .agg(F.expr("bit_or(shiftleft(1L, CAST(bit & 63 AS INT)))").alias("set"))
        )
        marks = np.zeros(bits // 64, np.int64)
        for row in cells.toLocalIterator():
            marks[row["cell"]] = row["set"]
        self.mask = bits - 1
        self.sent = terms.sparkSession.sparkContext.broadcast(marks.astype("<i8").tobytes())

    def test(self) -> Callable[[str], bool]:
        """For use in a task: remembers words, but no more than so many."""
        marks, mask, known = self.sent.value, self.mask, {}

        def marked(term: str) -> bool:
            found = known.get(term)
            if found is None:
                if len(known) > KNOWN:
                    known.clear()
                bit = _hash(term) & mask
                found = known[term] = bool(marks[bit >> 3] >> (bit & 7) & 1)
            return found

        return marked


def paired_words(found: DataFrame) -> DataFrame:
    """(entity, term, together, with_entity): documents with both near, and with the entity."""
    places = found.select(F.explode("entities").alias("e")).select("e.*")
    places = places.withColumn("around", F.xxhash64("words"))
    seen = places.groupBy("entity").agg(
        F.count(F.lit(1)).alias("with_entity"), F.count_distinct("around").alias("contexts")
    )
    # An entity in fewer surroundings cannot have a word in enough of them.
    seen = seen.filter(F.col("contexts") >= LEAST_CONTEXTS).drop("contexts")
    seen = written(seen, "private-entities")
    pairs = (
        places.join(seen.select("entity"), "entity")
        .select("entity", "around", F.explode("words").alias("term"))
        .groupBy("entity", "term", "around")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("entity", "term")
        .agg(F.count(F.lit(1)).alias("contexts"), F.sum("n").alias("together"))
        .filter(F.col("contexts") >= LEAST_CONTEXTS)
    )
    return pairs.drop("contexts").join(seen, "entity")


def disclosing_terms(found: DataFrame) -> DataFrame:
    """(entity, term, remove, alone) from the rows of ``_found``."""
    pairs = written(paired_words(found), "private-pairs")
    candidates = Marked(pairs.select("term").distinct())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = candidates.test()
        for batch in batches:
            counts: Counter[str] = Counter()
            for value in batch.column(0):
                counts.update(filter(marked, set(_TERM.findall(value.as_py().lower()))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                ["term", "n"],
            )

    with_term = (
        found.select("text")
        .mapInArrow(count, "term string, n long")
        .groupBy("term")
        .agg(F.sum("n").alias("with_term"))
    )
    n_documents = F.lit(found.count())
    rate = F.col("together") / F.greatest("with_term", "together")
    information = F.log(n_documents / F.col("with_entity"))
    shared = F.log(n_documents * rate / F.col("with_entity"))
    share = F.when(information > 0, shared / information)
    return (
        pairs.join(with_term, "term")
        .filter(share >= GENERALISE)
        .select(
            "entity",
            "term",
            (share >= REMOVE).alias("remove"),
            ((share >= REMOVE) & (rate >= ALONE)).alias("alone"),
        )
    )


def term_places(found: DataFrame, terms: DataFrame) -> DataFrame:
    """(row, places): where ``terms`` (entity, term, remove, alone) must not stand, per document."""
    wanted = Marked(terms.select("term").distinct())

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = wanted.test()
        for batch in batches:
            hits: list[tuple[int, str, list[dict[str, int]], list[str]]] = []
            for row, value, line, own in zip(*batch.columns, strict=True):
                text = value.as_py()
                if not any(map(marked, set(_TERM.findall(text.lower())))):
                    continue
                here: dict[str, list[dict[str, int]]] = {}
                for a, b, word in words_outside(text, _spans_of(line.as_py())):
                    if marked(word):
                        here.setdefault(word, []).append({"a": a, "b": b})
                hits += [(row.as_py(), word, spans, own.as_py()) for word, spans in here.items()]
            columns = zip(*hits, strict=True) if hits else ([], [], [], [])
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["row", "term", "spans", "own"])

    span = pa.struct([("a", pa.int64()), ("b", pa.int64())])
    types = [pa.int64(), pa.string(), pa.list_(span), pa.list_(pa.string())]
    hits = found.select("row", "text", "base_spans", "entities.entity").mapInArrow(
        find, "row long, term string, spans array<struct<a: long, b: long>>, own array<string>"
    )
    return (
        hits.join(terms, "term")
        .filter(F.col("alone") | F.array_contains("own", F.col("entity")))
        .groupBy("row", "term")
        .agg(F.max("remove").alias("remove"), F.first("spans").alias("spans"))
        .groupBy("row")
        .agg(F.collect_list(F.struct("remove", "spans")).alias("places"))
    )


def find_private(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False
) -> DataFrame:
    """One row per document: counts per kind, the digest of the pattern spans, and all spans.

    ``with_text`` adds ``sanitised``, the text without what it must not show.
    """
    found = _found(docs, id_col, text_col)
    places = term_places(found, written(disclosing_terms(found), "private-terms"))
    kept = found.select("row", "base_spans", F.col("text") if with_text else F.lit("").alias("text"))
    hit = kept.join(places, "row", "left" if with_text else "inner")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans_out, texts_out = [], []
            for line, text, chosen in zip(*batch.columns[1:], strict=True):
                every = _spans_of(line.as_py())
                for term in chosen.as_py() or ():
                    kind = REMOVED if term["remove"] else GENERALISED
                    every += [(s["a"], s["b"], kind) for s in term["spans"]]
                every.sort(key=lambda s: s[0])
                spans_out.append(joined(every))
                texts_out.append(sanitised(text.as_py(), every) if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans_out, pa.string()), pa.array(texts_out, pa.string())],
                ["row", "all_spans", "sanitised"],
            )

    added = hit.select("row", "base_spans", "text", "places").mapInArrow(
        run, "row long, all_spans string, sanitised string"
    )
    result = found.drop("text", "entities").join(added, "row", "left")
    return result.select(
        "doc_id",
        *(f"n_{k}" for k in KINDS),
        "base_sha256",
        F.coalesce("all_spans", "base_spans").alias("spans"),
        *(["sanitised"] if with_text else []),
    )


@query()
def op6_private_data(spark: SparkSession, folder: str) -> DataFrame:
    return find_private(table(spark, folder, "documents"))
