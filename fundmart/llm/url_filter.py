"""URL filter: host rules, and for all other URLs the ratio of two character models.

A rule names a verdict, a host and the beginning of a path. It fits its host and all
subdomains of it; of the rules that fit a URL the longest decides. URLs that a rule decides
are the labelled ones. From them one character model is learnt for accepted and one for
rejected URLs: the counts of every context of up to ``ORDER`` characters over all labelled
URLs, each context smoothed by the next shorter one with the weight of the number of
different characters seen after it (Witten and Bell), down to the uniform distribution;
in place of a context never seen stands its longest suffix that was. A URL's score is
log P(rejected model) - log P(accepted model) per character, its end included. The score
above which a URL is blocked is calibrated on labelled URLs that the models did not learn
from (one in ``FOLDS``, by the CRC-32 of the URL): it makes the sum of the accepted share and
the rejected share decided rightly as large as possible.

Sizes: characters are folded into an alphabet of ``len(ALPHABET)`` symbols, which bounds the
counts (two for each of its ``ORDER + 1``-th powers) and the table of log ratios that is sent
to tasks (4 bytes each), whatever the corpus. Counts and calibration cover all labelled rows.

Defined results: a null URL, and one without ``://``, has an empty host and path and is
scored by what it has (a null URL by its end alone). Without a labelled URL on either side
nothing is known and every other URL is allowed; without one to calibrate on, the limit is 0.
A score at the limit is allowed. Very long URLs are scored whole. Repeated rows get equal
results; extra columns are ignored by ``judged`` and kept by ``allowed_only``; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundmart.llm.base import named, query, table, text_of

ORDER = 3
FOLDS = 5
# The end, letters, digits as one, marks of URLs, and all other bytes as one.
ALPHABET = ["end", *"abcdefghijklmnopqrstuvwxyz", "digit", *"/.-_?=&#%:", "other"]
SIZE = len(ALPHABET)
# Scores are counted in bins of this width for the calibration.
BIN = 0.01
# URLs are taken together until they have so many bytes.
BLOCK_BYTES = 1 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """What happens to URLs of a host and its subdomains whose path begins with ``path``."""

    verdict: str
    host: str
    path: str

    @classmethod
    def of(cls, verdict: str, text: str) -> Rule:
        """From a text like ``example.net/en/``."""
        host, slash, rest = text.partition("/")
        return cls(verdict, host, slash + rest)

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule.of(BLOCK, "net/"),
    Rule.of(ALLOW, "example.net/en/"),
    Rule.of(BLOCK, "example.com/de/"),
    Rule.of(ALLOW, "org/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The text of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        fits = fits & F.startswith(path, F.lit(rule.path))
        found = F.when(fits, F.lit(rule.text)).otherwise(found)
    return found


def verdict_of(rule: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    verdict = F.lit(None).cast("string")
    for r in rules:
        verdict = F.when(rule == r.text, F.lit(r.verdict)).otherwise(verdict)
    return verdict


def _folding() -> np.ndarray:
    """Symbol of each byte."""
    fold = np.full(256, ALPHABET.index("other"), np.int64)
    for symbol, name in enumerate(ALPHABET):
        if len(name) == 1:
            fold[ord(name)] = fold[ord(name.upper())] = symbol
    fold[ord("0") : ord("9") + 1] = ALPHABET.index("digit")
    fold[0] = ALPHABET.index("end")
    return fold


FOLD = _folding()


def symbols_in_context(urls: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A code per symbol (``ORDER`` symbols before it, then itself), and the place in the codes
    where each URL begins. Before a URL there are ends."""
    # A zero byte stands for the end.
    encoded = [u.encode("utf-8", "surrogatepass").replace(b"\0", b"\1") + b"\0" for u in urls]
    pad = b"\0" * ORDER
    data = FOLD[np.frombuffer(pad + pad.join(encoded), np.uint8)]
    codes = np.zeros(len(data) - ORDER, np.int64)
    for i in range(ORDER + 1):
        codes *= SIZE
        codes += data[i : i + len(codes)]
    lengths = np.array([len(e) for e in encoded], np.int64)
    # Behind each URL but the last stand the ends that come before the next one.
    starts = np.cumsum(lengths + ORDER) - lengths - ORDER
    keep = np.ones(len(codes), bool)
    for end in (starts + lengths)[:-1]:
        keep[end : end + ORDER] = False
    return codes[keep], np.cumsum(lengths) - lengths


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """ln P of every code, from the counts of all codes."""
    p = np.full((1, SIZE), 1 / SIZE)
    for k in range(ORDER + 1):
        n = counts.reshape(-1, SIZE**k, SIZE).sum(axis=0).astype(np.float64)
        total, kinds = n.sum(axis=1, keepdims=True), (n > 0).sum(axis=1, keepdims=True)
        # A context's next shorter one lacks its first symbol.
        shorter = np.tile(p, (SIZE, 1)) if k else p
        seen = total > 0
        p = np.where(seen, (n + kinds * shorter) / np.where(seen, total + kinds, 1), shorter)
    return np.log(p).reshape(-1)


def _blocks(urls: list[str]) -> Iterator[tuple[int, int]]:
    """Bounds of runs of URLs of about ``BLOCK_BYTES`` together."""
    start = size = 0
    for i, url in enumerate(urls):
        size += len(url)
        if size >= BLOCK_BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(urls):
        yield start, len(urls)


def counted(urls: DataFrame) -> DataFrame:
    """How often each code follows in accepted and in rejected URLs: code, accepted, rejected.

    ``urls``: url, rejected (boolean).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls, rejected = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist())
            for start, stop in _blocks(urls):
                codes, starts = symbols_in_context(urls[start:stop])
                lengths = np.diff(np.append(starts, len(codes)))
                keys = codes * 2 + np.repeat(rejected[start:stop], lengths)
                found, n = np.unique(keys, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), pa.array(n.astype(np.int64))], ["key", "n"]
                )

    parts = urls.select("url", "rejected").mapInArrow(run, "key long, n long")
    code, side = F.shiftright("key", 1).alias("code"), F.col("key") % 2
    return parts.groupBy(code).agg(
        F.sum(F.when(side == 0, F.col("n")).otherwise(0)).alias("accepted"),
        F.sum(F.when(side == 1, F.col("n")).otherwise(0)).alias("rejected"),
    )


@dataclass(frozen=True)
class Model:
    """The log ratio of every code, and the score above which a URL is blocked."""

    ratios: np.ndarray
    limit: float


def scored(rows: DataFrame, ratios: np.ndarray) -> DataFrame:
    """The rows and their ``score``; ``rows`` has a column ``url`` without nulls."""
    sent = rows.sparkSession.sparkContext.broadcast(ratios.astype(np.float32))
    at = rows.columns.index("url")
    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = sent.value
        for batch in batches:
            urls, scores = batch.column(at).to_pylist(), [np.zeros(0)]
            for start, stop in _blocks(urls):
                codes, starts = symbols_in_context(urls[start:stop])
                sums = np.add.reduceat(ratios[codes].astype(np.float64), starts)
                scores.append(sums / np.diff(np.append(starts, len(codes))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate(scores))], [*batch.schema.names, "score"]
            )

    return rows.mapInArrow(run, schema)


def best_limit(accepted: dict[int, int], rejected: dict[int, int]) -> float:
    """The limit that decides the largest shares rightly, from counts of scores per bin.

    Of several, the middle of the first run of bins.
    """
    if not accepted or not rejected:
        return 0.0
    bins = range(min([*accepted, *rejected]) - 1, max([*accepted, *rejected]) + 1)
    all_accepted, all_rejected = sum(accepted.values()), sum(rejected.values())
    allowed, still = 0, all_rejected
    gains = []
    for b in bins:
        # Blocked is what lies in higher bins than this one.
        allowed += accepted.get(b, 0)
        still -= rejected.get(b, 0)
        gains.append(allowed * all_rejected + still * all_accepted)
    first = gains.index(max(gains))
    last = first
    while last + 1 < len(gains) and gains[last + 1] == gains[first]:
        last += 1
    return ((bins[first] + bins[last]) / 2 + 1) * BIN


def learn(urls: DataFrame) -> Model:
    """Both models and the limit, from labelled URLs (url, rejected)."""
    labelled = urls.filter("url IS NOT NULL AND rejected IS NOT NULL")
    held = F.crc32("url") % FOLDS == 2
    rows = counted(labelled.filter(~held)).toArrow()
    sides, ratios = [], np.zeros(SIZE ** (ORDER + 1))
    for name in ("rejected", "accepted"):
        counts = np.zeros(SIZE ** (ORDER + 1), np.int64)
        counts[rows.column("code").to_numpy()] = rows.column(name).to_numpy()
        sides.append(counts.any())
        ratios += log_probabilities(counts) * (1 if name == "rejected" else -1)
    if not all(sides):
        return Model(np.zeros_like(ratios), np.inf)
    bins = (
        scored(labelled.filter(held), ratios)
        .groupBy(F.floor(F.col("score") / BIN).alias("bin"))
        .agg(
            F.count_if(~F.col("rejected")).alias("accepted"),
            F.count_if("rejected").alias("rejected"),
        )
        .collect()
    )
    found = [{r["bin"]: r[side] for r in bins if r[side]} for side in ("accepted", "rejected")]
    return Model(ratios, best_limit(*found))


def _parted(pages: DataFrame, url_col: str, rules: tuple[Rule, ...], *others: Column) -> DataFrame:
    host, path = host_and_path(F.col("url"))
    rows = pages.select(*others, text_of(url_col).alias("url"))
    rows = rows.withColumns({"host": host, "path": path})
    return rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))


def labelled_by_rules(
    pages: DataFrame, url_col: str = "url", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """The URLs that a rule decides: url, rejected."""
    rows = _parted(pages, url_col, rules)
    verdict = verdict_of(F.col("rule"), rules)
    return rows.filter("rule IS NOT NULL").select("url", (verdict == BLOCK).alias("rejected"))


def judged(
    pages: DataFrame,
    model: Model,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """One row per page: host, path, the rule that fits, the verdict and the models' score."""
    rows = scored(_parted(pages, url_col, rules, named(id_col).alias("page_id")), model.ratios)
    own = F.when(F.col("score") > F.lit(float(model.limit)), BLOCK).otherwise(ALLOW)
    verdict = F.coalesce(verdict_of(F.col("rule"), rules), own)
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")


def allowed_only(
    pages: DataFrame, model: Model, url_col: str = "url", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """The pages whose URL is allowed, with all their columns."""
    row = F.struct(*[named(c) for c in pages.columns]).alias("row")
    rows = scored(_parted(pages, url_col, rules, row), model.ratios)
    own = F.when(F.col("score") > F.lit(float(model.limit)), BLOCK).otherwise(ALLOW)
    kept = rows.filter(F.coalesce(verdict_of(F.col("rule"), rules), own) == ALLOW)
    return kept.select(*[F.col("row")[c].alias(c) for c in pages.columns])


@query()
def op13_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return judged(pages, learn(labelled_by_rules(pages)))
