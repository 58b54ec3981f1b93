"""The conversation trie against brute force and on awkward input."""

import hashlib
import random
import zlib

import pytest

from tilewright.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, d long, piece int, len string"


def conversations(spark, rows):
    """(conv_id, turn, role, text) with more columns whose names the operator uses itself."""
    return spark.createDataFrame([(*r, 1, 2, "k") for r in rows], SCHEMA)


def brute(rows):
    own: dict = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(own.get(c - c % 100, [])[:h] + ts[h:])
    members: dict = {}
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
    leaf = {p for p in members if not any(len(q) == len(p) + 1 and q[:-1] == p for q in members)}
    out = []
    for p, cs in members.items():
        under = [q for q in members if q[: len(p)] == p]
        saved = sum((len(members[q]) - 1) * len(q[-1][1]) for q in under if q)
        ends = ",".join(str(c) for c in sorted(c for c in cs if whole[c] == p))
        kids = sum(len(q) == len(p) + 1 for q in under)
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), kids, len(leaf.intersection(under)), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(str, out))


def answer(spark, rows):
    return sorted(str(tuple(r)) for r in trie.prefix_trie(conversations(spark, rows)).collect())


def talk(rng, c, n, texts):
    return [(c, t, rng.choice(["user", "assistant", None]), rng.choice(texts)) for t in range(n)]


@pytest.fixture
def narrow(monkeypatch):
    """Pieces, chunks and rounds so small that every border is crossed."""
    monkeypatch.setattr(trie, "PIECE", 2)
    monkeypatch.setattr(trie, "SPAN", 4)
    monkeypatch.setattr(trie, "FAN", 2)
    monkeypatch.setattr(trie, "ENDS", 8)


def test_small_pieces_and_chunks(spark, narrow):
    rng = random.Random(3)
    rows = [r for c in range(60) for r in talk(rng, c, rng.randint(1, 7), ["a", "bb", ""])]
    same = talk(rng, 0, 9, ["x", "yy"])
    # many equal ones, ones that end inside others, and a long one beside it
    rows += [(200 + i, *t[1:]) for i in range(30) for t in same[: rng.choice([5, 6, 9, 9])]]
    rows += [(400, *t[1:]) for t in same + same]
    rng.shuffle(rows)
    assert answer(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "lost"), (7, None, None, None), (7, 2, "user", "b"), (7, 2, "user", "b"), (7, 2, "user", "a"), (100, 1, "user", "ünï 文字 😀"), (101, 5, "user", "x"),
        (102, 0, "user", "ünï 文字 😀"), (102, 1, "user", "long " * 20_000), (103, 1, "", ""), (103, 1, None, None), (305, 1, "user", "no head"),
    ]
    assert answer(spark, rows) == brute(rows)
    assert answer(spark, []) == []


def test_one_conversation_holds_most_turns(spark):
    rng = random.Random(4)
    rows = [(0, t, "user", f"{t % 7}") for t in range(700)] + [(300, t, "user", f"{t % 7}") for t in range(640)] + [r for c in range(1, 9) for r in talk(rng, c, 3, ["0", "1"])]
    assert answer(spark, rows) == brute(rows)
