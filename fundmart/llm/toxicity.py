"""Toxicity: Levenshtein automata intersected with a lexicon trie.

The lexicon is learnt from labelled rows: words, and beginnings shared by several words,
that are found in toxic documents far more often than chance allows (a binomial test,
corrected for the number of candidates) and hardly ever elsewhere. All its entries make one
trie. The product of the trie and the Levenshtein automata of the words is made
deterministic on demand: a state is the set of (node, edits so far), so a word that
resembles no entry ends after a few characters. Words of five letters or more may have one
edit, of nine or more two; beginnings must match exactly. A form with edits that the labels
know well counts as they say; others count by how often such rare forms were right.

A window of words around each hit separates quotation from abuse: inside quotation marks a
hit counts less, next to a reporting verb less again, next to a second person in full.

A long text has hits by chance. Hits are counted by how sure they are (as different words),
and each count is held against the one that chance would bring to a text with so many
different words, at the rate of documents that are not toxic. What exceeds it, as a Poisson
log-likelihood ratio, is the evidence; a logistic curve turns it into the score.

Lexicon and curve are fitted on a bounded sample: at most ``fit_rows`` labelled rows, those
with the smallest hash of the id. Scores cover every whole text. Nothing but the text is an
input of a score.

Defined results: null and empty texts score as texts without a hit; with no toxic label at
all every text scores ``BASE_SCORE``. A null id is never held out. Labels that repeat an id
count once, as toxic if any of them says so; null labels are left out. Repeated rows get
equal scores; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundmart.llm.base import held_out, named, query, table, text_of

FOLDS = 4
THRESHOLD = 0.3
FIT_ROWS = 20_000
# A chance finding among all candidates has at most this probability.
ERROR_RATE = 0.01
WORD_PRECISION = 0.8
STEM_PRECISION = 0.95
STEM_LENGTHS = (4, 5, 6)
STEM_WORDS = 4
BASE_SCORE = 0.02
# Bounds between the classes of hits, by the share of toxic documents among those with it.
CLASSES = (0.6, 0.8, 0.9, 0.96)
WINDOW = 6
QUOTED, REPORTED = 0.5, 0.25
# Words whose strength is remembered by a task, of at most so many letters each.
KNOWN_WORDS = 100_000
KNOWN_LETTERS = 60

# Reporting verbs, second persons and quotation marks of the four languages.
REPORTING = frozenset(
    "said says wrote writes quote quoted quotes called calls reported heard term word"
    " dit écrit cité appelé mot sagte schrieb zitat zitiert nannte wort"
    " dijo escribió cita citó llamó palabra".split()
)
SECOND_PERSON = frozenset(
    "you your youre yourself tu toi vous votre du dich dir dein ihr euch usted ustedes vos".split()
)
OPENING = {'"': '"', "“": "”", "„": "“", "«": "»", "‹": "›"}

TOKEN = re.compile(r"[^\W_]+")


def _edits(length: int) -> int:
    return 0 if length < 5 else 1 if length < 9 else 2


class Automaton:
    """All entries at once; a state is a set of (trie node, edits so far)."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.word: dict[int, str] = {}
        self.stem: dict[int, str] = {}
        self.allowed: list[int] = [0]
        for entry, ends, edits in (
            *((w, self.word, _edits(len(w))) for w in words),
            *((s, self.stem, 0) for s in stems),
        ):
            node = 0
            self.allowed[0] = max(self.allowed[0], edits)
            for char in entry:
                if char not in self.children[node]:
                    self.children[node][char] = len(self.children)
                    self.children.append({})
                    self.allowed.append(0)
                node = self.children[node][char]
                # Edits that some word below this node may have.
                self.allowed[node] = max(self.allowed[node], edits)
            ends[node] = entry
        # States by number, with what a text that ends or begins there matches.
        self.number: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.stem_at: list[str | None] = []
        self.word_at: list[tuple[int, str] | None] = []
        self._numbered(self._closed({(0, 0)}))

    def _numbered(self, state: frozenset) -> int:
        """The state's number; -1: nothing can match any more."""
        if not state:
            return -1
        number = self.number.get(state)
        if number is None:
            number = self.number[state] = len(self.states)
            self.states.append(state)
            self.steps.append({})
            stems = [self.stem[n] for n, edits in state if not edits and n in self.stem]
            self.stem_at.append(min(stems, default=None))
            words = [
                (edits, self.word[n])
                for n, edits in state
                if n in self.word and edits <= _edits(len(self.word[n]))
            ]
            self.word_at.append(min(words, default=None))
        return number

    def _closed(self, states: set[tuple[int, int]]) -> frozenset:
        """With the entry's characters that the text leaves out."""
        todo = list(states)
        while todo:
            node, edits = todo.pop()
            for child in self.children[node].values():
                step = (child, edits + 1)
                if edits + 1 <= self.allowed[child] and step not in states:
                    states.add(step)
                    todo.append(step)
        return frozenset(states)

    def _step(self, state: frozenset, char: str) -> frozenset:
        out: set[tuple[int, int]] = set()
        for node, edits in state:
            if (child := self.children[node].get(char)) is not None:
                if edits <= self.allowed[child] or not edits:
                    out.add((child, edits))
            if edits < self.allowed[node]:
                out.add((node, edits + 1))
            for child in self.children[node].values():
                if edits < self.allowed[child]:
                    out.add((child, edits + 1))
        return self._closed(out)

    def match(self, text: str) -> tuple[str, int] | None:
        """The nearest entry and its edits; a beginning counts as no edit."""
        at = 0
        for char in text:
            if self.stem_at[at] is not None:
                return self.stem_at[at], 0
            after = self.steps[at].get(char)
            if after is None:
                after = self._numbered(self._step(self.states[at], char))
                self.steps[at][char] = after
            if after < 0:
                return None
            at = after
        found = [self.word_at[at]] if self.word_at[at] else []
        if self.stem_at[at] is not None:
            found.append((0, self.stem_at[at]))
        if not found:
            return None
        edits, entry = min(found)
        return entry, edits


class Lexicon:
    """Entries with their precision, and the precision of forms with edits."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]) -> None:
        self.words, self.stems = words, stems
        self.forms: dict[str, float] = {}
        self.rare_form = 0.5
        self.rates: list[float] = []
        self.curve: tuple[float, float] | None = None
        self._automaton: Automaton | None = None
        self.known: dict[str, float] = {}

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None, "known": {}}

    @property
    def automaton(self) -> Automaton:
        if self._automaton is None:
            self._automaton = Automaton(self.words, self.stems)
        return self._automaton

    def strength(self, word: str) -> float:
        """Probability that a document with this word is toxic; 0: no hit."""
        value = self.known.get(word)
        if value is None:
            found = self.automaton.match(word)
            if found is None:
                value = 0.0
            elif found[1]:
                value = self.forms.get(word, self.rare_form / found[1])
            else:
                value = self.words.get(found[0]) or self.stems[found[0]]
            if len(self.known) > KNOWN_WORDS:
                self.known.clear()
            if len(word) <= KNOWN_LETTERS:
                self.known[word] = value
        return value


def _quoted_spans(text: str) -> list[tuple[int, int]]:
    """Quotations within one line; an opening mark without an end quotes nothing."""
    spans, at = [], 0
    for line in text.split("\n"):
        i = 0
        while i < len(line):
            end = line.find(OPENING[line[i]], i + 1) if line[i] in OPENING else -1
            if end > i:
                spans.append((at + i, at + end))
                i = end
            i += 1
        at += len(line) + 1
    return spans


def evidence(text: str, lexicon: Lexicon) -> tuple[int, list[float]]:
    """Number of different words, and of the hits among them per class of strength.

    A hit counts as much as its weightiest place in the text.
    """
    lowered = text.lower()
    different = set(TOKEN.findall(lowered))
    counts = [0.0] * (len(CLASSES) + 1)
    known, strength = lexicon.known, lexicon.strength
    hits = {}
    for word in different:
        value = known.get(word)
        if value is None:
            value = strength(word)
        if value:
            hits[word] = value
    if not hits:
        return len(different), counts
    spans = _quoted_spans(lowered) if any(q in lowered for q in OPENING) else []
    tokens = list(TOKEN.finditer(lowered))
    words = [m.group() for m in tokens]
    weights = dict.fromkeys(hits, 0.0)
    at = 0
    for i, word in enumerate(words):
        if word not in hits:
            continue
        start = tokens[i].start()
        while at < len(spans) and spans[at][1] < start:
            at += 1
        weight = 1.0
        if at < len(spans) and spans[at][0] <= start < spans[at][1]:
            near = words[max(0, i - WINDOW) : i + WINDOW + 1]
            if not any(w in SECOND_PERSON for w in near):
                weight = REPORTED if any(w in REPORTING for w in near) else QUOTED
        weights[word] = max(weights[word], weight)
    for word, weight in weights.items():
        counts[bisect(CLASSES, hits[word])] += weight
    return len(different), counts


def excess(n_words: int, counts: list[float], rates: list[float]) -> float:
    """How far the hits exceed chance: Poisson log-likelihood ratio, one-sided."""
    total = 0.0
    for count, rate in zip(counts, rates, strict=True):
        expected = max(n_words, 1) * rate
        if count > expected:
            total += count * math.log(count / expected) - count + expected
    return total


def score_text(text: str, lexicon: Lexicon) -> float:
    """0 to 1; higher means that a toxic label is likelier."""
    if lexicon.curve is None:
        return BASE_SCORE
    level, slope = lexicon.curve
    at = level + slope * excess(*evidence(text, lexicon), lexicon.rates)
    return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, at))))


def _fit_curve(excesses: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Logistic curve, held near (-3, 1) by a weak prior.

    Newton steps are halved until the fit improves: on labels that the hits separate
    completely, whole steps would run away.
    """
    x = np.column_stack([np.ones(len(excesses)), np.minimum(excesses, 20.0)])
    centre = np.array([-3.0, 1.0])

    def fit(beta: np.ndarray) -> float:
        at = x @ beta
        likelihood = labels @ at - np.logaddexp(0.0, at).sum()
        return float(likelihood - (beta - centre) @ (beta - centre) / 2)

    beta, now = centre.copy(), fit(centre)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -60, 60)))
        gradient = x.T @ (labels - p) - (beta - centre)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        while (better := fit(beta + step)) < now and np.abs(step).max() > 1e-9:
            step = step / 2
        if np.abs(step).max() <= 1e-9:
            break
        beta, now = beta + step, better
    return float(beta[0]), max(float(beta[1]), 0.1)


def learn_lexicon(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    folds: int = FOLDS,
    fit_rows: int = FIT_ROWS,
) -> Lexicon:
    """Fit on at most ``fit_rows`` labelled rows that are not held out."""
    marked = (
        labels.filter(named(label_col).isNotNull() & named(id_col).isNotNull())
        .filter(~held_out(id_col, folds))
        .groupBy(named(id_col).alias("own_id"))
        .agg(F.max(named(label_col)).cast("int").alias("label"))
        .orderBy(F.xxhash64("own_id"), "own_id")
        .limit(fit_rows)
    )
    # At most fit_rows rows of 12 bytes: small by construction.
    texts = docs.select(named(id_col).alias("own_id"), text_of(text_col).alias("own_text"))
    chosen = texts.join(F.broadcast(marked), "own_id")
    words = chosen.select(
        "label",
        F.array_distinct(F.regexp_extract_all(F.lower("own_text"), F.lit(r"[\p{L}\p{N}]+"), 0)).alias(
            "words"
        ),
    )
    totals = words.agg(F.count(F.lit(1)), F.sum("label")).first()
    n_rows, n_toxic = totals[0], totals[1] or 0
    if not n_toxic or n_toxic == n_rows:
        return Lexicon({}, {})
    base = n_toxic / n_rows
    counts = (
        words.select("label", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.sum("label").alias("t"), F.count(F.lit(1)).alias("n"))
    )
    # One scan of the sample; its words are bounded as the sample is.
    counts = counts.persist()
    try:
        lexicon = _choose(counts, base)
    finally:
        counts.unpersist()
    if lexicon.words or lexicon.stems:
        _calibrate(chosen.select("label", "own_text"), lexicon)
    return lexicon


def _calibrate(sample: DataFrame, lexicon: Lexicon) -> None:
    """Rates of chance hits and the curve, from one row of counts per row of the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [evidence(t.as_py(), lexicon) for t in batch.column(1)]
            words = pa.array([f[0] for f in found], pa.int64())
            hits = pa.array([f[1] for f in found], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), words, hits], ["label", "words", "hits"]
            )

    rows = sample.mapInArrow(run, "label int, words long, hits array<double>").collect()
    labels = np.array([r["label"] for r in rows], float)
    words = np.array([r["words"] for r in rows], float)
    hits = np.array([r["hits"] for r in rows], float)
    clean = labels == 0
    lexicon.rates = ((hits[clean].sum(axis=0) + 0.5) / (words[clean].sum() + 1)).tolist()
    excesses = np.array(
        [excess(int(n), h, lexicon.rates) for n, h in zip(words, hits.tolist(), strict=True)]
    )
    lexicon.curve = _fit_curve(excesses, labels)


def _choose(counts: DataFrame, base: float) -> Lexicon:
    n_words = counts.count()
    needed = math.log(max(n_words, 1) / ERROR_RATE)
    part = F.col("t") / F.col("n")
    other = F.when(part < 1, (1 - part) * F.log((1 - part) / (1 - base))).otherwise(0.0)
    sure = (part > base) & (F.col("n") * (part * F.log(part / base) + other) >= needed)

    def entries(rows: DataFrame, key: str, precision: float) -> list:
        good = rows.filter((F.col("t") > 0) & (part >= precision) & sure)
        # As many as the bounded sample brings forth.
        return good.orderBy(F.desc("t"), key).collect()

    words = {
        r["word"]: (r["t"] + base) / (r["n"] + 1) for r in entries(counts, "word", WORD_PRECISION)
    }
    stems: dict[str, float] = {}
    for length in STEM_LENGTHS:
        begun = (
            counts.filter(F.length("word") >= length)
            .groupBy(F.substring("word", 1, length).alias("stem"))
            .agg(F.sum("t").alias("t"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("forms"))
            .filter(F.col("forms") >= STEM_WORDS)
        )
        for r in entries(begun, "stem", STEM_PRECISION):
            if not any(r["stem"].startswith(s) for s in stems):
                stems[r["stem"]] = (r["t"] + base) / (r["n"] + 1)
    words = {w: p for w, p in words.items() if not any(w.startswith(s) for s in stems)}
    lexicon = Lexicon(words, stems)

    def forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            match = lexicon.automaton.match
            near = [bool((m := match(w)) and m[1]) for w in batch.column(0).to_pylist()]
            yield batch.filter(pa.array(near, pa.bool_()))

    near = counts.select("word", "t", "n").mapInArrow(forms, "word string, t long, n long")
    often = F.col("n") >= 3
    near = near.persist()
    try:
        for r in near.filter(often).collect():
            lexicon.forms[r["word"]] = (r["t"] + base) / (r["n"] + 1)
        rare = near.filter(~often).agg(F.sum("t"), F.sum("n")).first()
    finally:
        near.unpersist()
    rare_t, rare_n = rare[0] or 0, rare[1] or 0
    # Forms that are as toxic as any document tell nothing.
    lexicon.forms = {w: p if p >= 2 * base else 0.0 for w, p in lexicon.forms.items()}
    lexicon.rare_form = (rare_t + 1) / (rare_n + 2)
    if lexicon.rare_form < 2 * base:
        lexicon.rare_form = 0.0
    return lexicon


def score_documents(
    docs: DataFrame,
    lexicon: Lexicon,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    folds: int = FOLDS,
) -> DataFrame:
    """One row per document: held_out, score and predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [score_text(t.as_py(), lexicon) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "score"],
            )

    rows = docs.select(
        named(id_col).alias("doc_id"),
        held_out(id_col, folds).alias("held_out"),
        text_of(text_col).alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return scored.select("*", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(
    docs: DataFrame, lexicon: Lexicon, text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place)
            scores = [score_text(t.as_py() or "", lexicon) for t in texts]
            yield batch.filter(pc.less(pa.array(scores, pa.float64()), threshold))

    # Plain names on the way, as a name may hold a dot.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


@query()
def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return score_documents(docs, learn_lexicon(docs, table(spark, folder, "labels")))
