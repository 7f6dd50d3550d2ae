"""The prefix trie against one that is built turn by turn."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from fundmart.llm import prefix_trie

TURNS = "conv_id long, turn long, role string, text string, conv string, words int, `a.b` string"


def sequences(rows):
    """Turns of each conversation, in order (turns of equal number by their digest)."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs[conv].append(((turn is not None, turn or 0), digest, (role, text)))
    return {c: [t[2] for t in sorted(own)] for c, own in convs.items()}


def remainder(a, b):
    """As SQL has it: with the sign of ``a``."""
    return a - b * int(a / b)


def brute_rebuilt(rows):
    convs, out = sequences(rows), {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - remainder(c, 20), [])[:h] + own[h:]
    return out


def brute_trie(convs):
    members = defaultdict(list)
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)

    def below(path):
        todo = [path]
        for p in todo:
            todo.extend(children[p])
        return todo

    out = []
    for path, own in members.items():
        tree = below(path)
        saved = sum(
            (len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in tree if p
        )
        ends = ",".join(str(c) for c in own if len(convs[c]) == len(path))
        out.append(
            (
                own[0],
                len(path),
                members[path[:-1]][0] if path else None,
                len(own),
                len(children[path]),
                sum(not children[p] for p in tree),
                saved,
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out)


def many():
    rng = random.Random(3)
    rows = []
    for c in list(range(0, 160)) + [-1, -19, -21, -40, 10**12, 10**12 + 7]:
        for turn in range(rng.randrange(1, 12)):
            text = rng.choice(["a", "a", "a b", "b  c\td", ""])
            rows.append((c, turn, rng.choice(["user", "user", "bot"]), text))
    # Copies that diverge late, in the middle of a block and at its border.
    for c in range(200, 260):
        for turn in range(20 + c % 4):
            rows.append((c, turn, "user", f"same {turn}" if turn < 17 + c % 3 else f"own {c}"))
    # One conversation of many turns, and what hides in the columns.
    rows += [(300, t, "user", f"long {t}") for t in range(300)]
    rows += [(301, t, "user", f"long {t}") for t in range(250)]
    rows += [(None, 0, "user", "nobody"), (302, None, None, None), (302, 0, "user", None)]
    rows += [(303, 1, "user", "tie"), (303, 1, "bot", "tie"), (303, 1, "bot", "tie")]
    rows += [(304, 0, "us", "er x"), (305, 0, "user", " x"), (306, 0, "user", "w " * 200_000)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, "dot") for r in rows], TURNS)


def found(df):
    columns = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256"
    assert df.columns == columns.split()
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("block, piece, ids", [(4, 4096, 512), (3, 6, 7), (1, 2, 1)])
def test_rebuilt_conversations(spark, monkeypatch, block, piece, ids):
    monkeypatch.setattr(prefix_trie, "PIECE", piece)
    monkeypatch.setattr(prefix_trie, "IDS", ids)
    rows = many()
    turns, convs = prefix_trie.rebuilt(prefix_trie.turns_of(frame(spark, rows)))
    assert found(prefix_trie.trie(turns, convs, block)) == brute_trie(brute_rebuilt(rows))


def test_conversations_as_they_are(spark):
    rows = many()
    result = prefix_trie.prefix_trie(prefix_trie.turns_of(frame(spark, rows)))
    assert found(result) == brute_trie(sequences(rows))


def test_turnless_conversations_and_none(spark):
    """Conversation 21 has one turn of its own, and none in its family's first one."""
    shared = {c: zlib.crc32(str(c).encode()) % 4 for c in range(21, 40)}
    rows = [(c, 0, "user", "gone") for c, h in shared.items() if h]
    turns, convs = prefix_trie.rebuilt(prefix_trie.turns_of(frame(spark, rows)))
    expected = brute_trie(brute_rebuilt(rows))
    assert found(prefix_trie.trie(turns, convs)) == expected and len(expected) == 1
    turns, convs = prefix_trie.rebuilt(prefix_trie.turns_of(frame(spark, [])))
    assert found(prefix_trie.trie(turns, convs)) == []


def test_only_blocks_where_siblings_diverge_are_refined(spark):
    rows = many()
    turns, _ = prefix_trie.rebuilt(prefix_trie.turns_of(frame(spark, rows)))
    segments = prefix_trie.segments_of(turns).collect()
    common = [s for s in segments if s["conv"] in (300, 301) and s["hi"] <= 248]
    assert common and all(s["hi"] - s["lo"] == 3 for s in common if s["lo"] > 4)
    assert all(s["hi"] == s["lo"] for s in segments if s["conv"] in (300, 301) and s["lo"] < 5)
