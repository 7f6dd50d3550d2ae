"""Suffix-tree scores: counts against brute force, probabilities against their definition."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from fundmart.llm import suffix_tree
from tests.llm.conftest import DOCS, EDGE, doc


def texts():
    rows = []
    parts = ["the", "Cat", "sat", "on", "mat", "over", "there", "wonderful", "wondering"]
    for i in range(300):
        words = [parts[(i * k + k * k) % len(parts)] for k in range(1, 30)]
        rows.append(doc(i, " ".join(words) + (f" rare{i}" if i % 3 else "")))
    return rows


def brute_base(rows):
    held = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in rows]
    words = [
        re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), r[1] or ""))
        for r in rows
    ]
    counts = Counter()
    for own, out in zip(words, held, strict=True):
        if not out:
            counts.update(own + [None])
    n, kinds = sum(counts.values()), len(counts)
    result = []
    for row, own, out in zip(rows, words, held, strict=True):
        own = own + [None]
        base = sum(math.log10((counts[w] + 1) / (n + kinds + 1)) for w in own)
        result.append((row[0], out, len(own), sum(counts[w] > 0 for w in own), n, round(base, 6)))
    return sorted(result, key=str)


@pytest.mark.parametrize("which", ["texts", "edge"])
def test_base_scores(spark, edge, which):
    rows = texts() if which == "texts" else EDGE
    df = spark.createDataFrame(rows, DOCS) if which == "texts" else edge
    found = suffix_tree.score_corpus(df).collect()
    columns = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    shown = [(*(r[c] for c in columns), round(r["base_score"], 6)) for r in found]
    assert [s[:5] for s in sorted(shown, key=str)] == [b[:5] for b in brute_base(rows)]
    assert [s[5] for s in sorted(shown, key=str)] == pytest.approx(
        [b[5] for b in brute_base(rows)], rel=1e-6, abs=1e-5
    )
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)


def test_words_that_are_not_sent_to_every_task_count_alike(spark, monkeypatch):
    df = spark.createDataFrame(texts(), DOCS)
    columns = ("doc_id", "n_known", "base_score")
    usual = sorted(tuple(r[c] for c in columns) for r in suffix_tree.score_corpus(df).collect())
    monkeypatch.setattr(suffix_tree, "COMMON_SHARE", 0.01)
    fewer = sorted(tuple(r[c] for c in columns) for r in suffix_tree.score_corpus(df).collect())
    assert [u[:2] for u in usual] == [f[:2] for f in fewer]
    assert [u[2] for u in usual] == pytest.approx([f[2] for f in fewer])


def test_contexts_are_kept_by_their_count_however_large_the_corpus(spark):
    def code(six):
        return int.from_bytes(six, "big")

    # "abcde" foretells "f" 3,000 times in 40 billion symbols.
    rows = [(code(b"qqqqq" + bytes([c])), 2_000_000_000) for c in b"fghijklmnopqrstuvwxy"]
    rows += [(code(six), 3_000) for six in (b"abcdef", b"bcdef ", b"bcdefz")]
    counts = spark.createDataFrame(rows, "code long, n long")
    words = spark.createDataFrame([(bytearray(b"abcdef"), 3_000)], "word binary, c long")
    kept, long = suffix_tree.retained_contexts(counts, words, 5)
    found = {(r["length"], r["context"], *d) for r in kept.collect() for d in r["dist"]}
    assert (1, ord("e"), ord("f"), 3_000) in found
    found = [(bytes(r["begin"]), [d["symbol"] for d in r["dist"]]) for r in long.collect()]
    assert found == [(b"abcdef", [0x20])]


def test_a_tree_that_is_not_sent_scores_alike(spark, monkeypatch):
    more = ["wonderful" * 5 + " x", "cat " + "wonderwonder" * 9, "", "wonderful", None]
    rows = texts() + [doc(400 + i, t) for i, t in enumerate(more)]
    df = spark.createDataFrame(rows, DOCS)
    usual = sorted((r["doc_id"], r["score"]) for r in suffix_tree.score_corpus(df).collect())
    for size in (0, 3_000, 40_000):
        monkeypatch.setattr(suffix_tree, "TREE_BYTES", size)
        other = sorted((r["doc_id"], r["score"]) for r in suffix_tree.score_corpus(df).collect())
        assert [u[0] for u in usual] == [o[0] for o in other]
        assert [u[1] for u in usual] == pytest.approx([o[1] for o in other], rel=1e-9)


def test_empty_table(spark, empty):
    assert suffix_tree.score_corpus(empty).collect() == []


def test_distributions_add_up_and_follow_their_definition(spark):
    rows = texts()
    tree, _, _ = suffix_tree.learn(spark.createDataFrame(rows, DOCS))
    assert sum(len(level[0]) for level in tree.levels) > 20

    def last(data):
        p, left_open = tree.probabilities(suffix_tree.grams([data])[0])
        tree.longer(p, left_open, np.frombuffer(data, np.uint8))
        assert not left_open.any()
        return p[-1]

    for before in (b"", b"the ", b"xq", b"wonder", b"on wonderf", b"the cat"):
        assert sum(last(before + bytes([s])) for s in range(256)) == pytest.approx(1.0)
    score = tree.score([b"the cat\n"])[0][0]
    assert score == pytest.approx(sum(math.log10(last(b"the cat\n"[: i + 1])) for i in range(8)))


class BruteTree:
    """The tree by its definition, from all training texts at once."""

    def __init__(self, rows, depth=5, longest=24, least=4):
        self.depth, self.longest = depth, longest
        after = {}
        for text in self.training(rows):
            data = b"\n" * depth + text
            for i in range(depth, len(data)):
                for k in range(depth + 1):
                    after.setdefault((k, data[i - k : i]), Counter())[data[i]] += 1
            for word in text.split():
                for k in range(depth, min(len(word), longest) + 1):
                    symbol = word[k] if k < len(word) else 0x20
                    after.setdefault(("word", word[:k]), Counter())[symbol] += 1
        total = {key: sum(own.values()) for key, own in after.items()}

        def diverges(key, parent):
            own, above = after[key], after[parent]
            divergence = sum(
                n / total[key] * math.log(n / total[key] / (above[s] / total[parent]))
                for s, n in own.items()
                if above[s]
            )
            return divergence * total[key] >= len(own) / 2 * math.log(total[key])

        kept = {(0, b"")}
        for key in after:
            if total[key] < least or key[0] == 0:
                continue
            parent = key[1][-depth:] if key[0] == "word" else key[1][1:]
            if diverges(key, (len(parent), parent)):
                kept.add(key)
                kept |= {(k, parent[len(parent) - k :]) for k in range(len(parent) + 1)}
        self.after = {key: after[key] for key in kept if key in after}

    @staticmethod
    def training(rows):
        for r in rows:
            if r[0] is None or zlib.crc32(str(r[0]).encode()) % 7 != 2:
                yield suffix_tree.normalised(r[1] or "")[1]

    def score(self, text):
        data, sum_ = suffix_tree.normalised(text or "")[1], 0.0
        padded = b"\n" * self.depth + data
        start = 0
        for i, symbol in enumerate(data):
            chain = [(k, padded[i + self.depth - k : i + self.depth]) for k in range(self.depth + 1)]
            if self.depth <= i - start <= self.longest:
                chain.append(("word", data[start:i]))
            p = 1 / 256
            for key in chain:
                own = self.after.get(key)
                if own:
                    p = (own[symbol] + len(own) * p) / (sum(own.values()) + len(own))
            sum_ += math.log10(p)
            if symbol == 0x20:
                start = i + 1
        return sum_


@pytest.mark.parametrize("size", [64 << 20, 20_000])
def test_scores_equal_a_tree_built_by_definition(spark, monkeypatch, size):
    monkeypatch.setattr(suffix_tree, "TREE_BYTES", size)
    more = ["Wonderful" * 5 + " x", "cat " + "wonderwonder" * 9, "", "été wonderful été", None]
    rows = texts() + [doc(400 + i, t) for i, t in enumerate(more)]
    tree = BruteTree(rows)
    found = suffix_tree.score_corpus(spark.createDataFrame(rows, DOCS)).collect()
    assert len(found) == len(rows)
    by_id = {r[0]: tree.score(r[1]) for r in rows}
    for r in found:
        assert r["score"] == pytest.approx(by_id[r["doc_id"]], rel=1e-9)


def test_codes_and_hashes():
    codes, ends = suffix_tree.grams([b"ab\n", b"c\n"], 2)
    expected = [b"\n\na", b"\nab", b"ab\n", b"\n\nc", b"\nc\n"]
    assert codes.tolist() == [int.from_bytes(c, "big") for c in expected]
    assert ends.tolist() == [3, 5]
    data = np.frombuffer(b"wonder on wonder\nwonder x", np.uint8)
    hashes, before = suffix_tree.word_hashes(data)
    assert hashes[6] == hashes[16] == hashes[23] and before[6] == before[16] == before[23] == 6
    assert len(set(hashes[:7].tolist())) == 7


def test_model_beats_word_counts_on_held_out_texts(spark):
    found = suffix_tree.score_corpus(spark.createDataFrame(texts(), DOCS)).collect()
    held = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_memory_gives_what_was_found(monkeypatch):
    monkeypatch.setattr(suffix_tree, "KNOWN_CODES", 150)
    asked = []

    def find(codes, others):
        asked.append(len(codes))
        return codes * np.uint64(3) + others, codes % np.uint64(2) == 1

    memory, rng = suffix_tree.Memory(find), np.random.default_rng(1)
    # Batches that overlap, an empty one, and one beyond what may be remembered.
    for size in (0, 5, 100, 100, 100, 250, 100, 0):
        codes = np.unique(rng.integers(0, 400, size).astype(np.uint64))
        tripled, odd = memory(codes, codes + np.uint64(7))
        assert tripled.tolist() == [4 * c + 7 for c in codes.tolist()]
        assert odd.tolist() == [c % 2 == 1 for c in codes.tolist()]
        assert (np.diff(memory.codes.astype(np.int64)) > 0).all()
    assert sum(asked) < 5 + 4 * 100 + 250


def test_symbols_seen_before_are_not_sorted_again(monkeypatch):
    nothing = (np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, np.uint64), np.zeros(0))
    tree = suffix_tree.Tree(5, np.full(256, 1 / 256), [nothing] * 6)
    words = [b"wonderful cat\n", b"\n", b"the cat sat on the wonderful mat\n"]
    before, _ = tree.score(words)
    sizes, unique = [], np.unique

    def counted(values, *args, **options):
        sizes.append(len(values))
        return unique(values, *args, **options)

    monkeypatch.setattr(np, "unique", counted)
    again, _ = tree.score(words)
    assert sum(sizes) == 0
    assert again.tolist() == before.tolist()
    assert again.tolist() == pytest.approx([-len(w) * math.log10(256) for w in words])


def test_slots_that_codes_take_from_each_other_give_what_was_found(monkeypatch):
    monkeypatch.setattr(suffix_tree, "SLOT_BITS", 3)
    slots, rng = suffix_tree.Slots(), np.random.default_rng(1)
    for size in (0, 1, 5, 50, 50, 2):
        codes = rng.integers(0, 40, size).astype(np.uint64)
        found = slots(codes, lambda at, codes=codes: codes[at] * 3.0)
        assert found.tolist() == [3.0 * c for c in codes.tolist()]


def test_words_of_a_block_equal_those_of_each_text():
    texts = ["", " \t", "Été\x0bThe\x0c  CAT\r\nthe \x85  x\x1cy ", "cat rare cat rare", "mat"]
    words, lengths, modelled = suffix_tree.split_words(pa.array(texts))
    own = [re.sub("[A-Z]", lambda m: m.group().lower(), t).encode().split() for t in texts]
    assert words.to_pylist() == [w for t in own for w in t]
    assert lengths.tolist() == [len(t) for t in own]
    assert modelled == [b" ".join(t) + b"\n" for t in own]
    known = {b"cat": 0.5, b"the": 2.0}
    for some in (known, {}):
        n_known, sums, others = suffix_tree.known_words(
            words, lengths, pa.array(list(some), pa.binary()), np.array(list(some.values()))
        )
        assert n_known.tolist() == [sum(w in some for w in t) for t in own]
        assert sums.tolist() == [sum(some.get(w, 0.0) for w in t) for t in own]
        rare = [Counter(w for w in t if w not in some) for t in own]
        assert [{p["word"]: p["k"] for p in t} for t in others.to_pylist()] == rare
