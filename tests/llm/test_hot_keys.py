"""One value, id or line that most rows share, and results held against code of the tests' own."""

import hashlib
import random
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tilewright.llm import common, lines, merkle, mixing, quality, simhash, topk
from tilewright.operators import graph

rng = random.Random(9)
VOCAB = [f"w{i}" for i in range(80)]


def texts(n, k):
    return [" ".join(rng.choices(VOCAB, k=k)) for _ in range(n)]


def test_equal_rows_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CELL_ROWS", 30)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 8)
    r = np.random.default_rng(3)
    vecs = [(1, [1.0, 2.0, 0.5])] * 70 + [(2, [1.0, 2.0, 0.5])] * 40 + [(i, r.normal(size=3).tolist()) for i in range(3, 60)]
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<double>")
    want = []
    for q in (1, 20):
        v = np.floor(64 * np.array(dict(vecs)[q])).astype(int)
        best = sorted((-int(v @ np.floor(64 * np.array(x)).astype(int)), i) for i, x in vecs if i != q)[:20]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(map(tuple, topk.top_k(df, df.filter("vec_id IN (1, 20)")).collect())) == want


def test_labelled_id_that_repeats(spark):
    docs = spark.createDataFrame([(i % 20 if i < 40 else 7, t) for i, t in enumerate(texts(400, 30))], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    a, b = (quality.train(d, labels) for d in (docs, docs.repartition(7)))
    t = spark.createDataFrame([(x,) for x in texts(20, 30)], "text string")
    got = [[r[0] for r in t.select(quality.score_of(F.col("text"), n, spark)).collect()] for n in (a, b)]
    assert np.allclose(*got, atol=1e-6)


def test_next_of_repeated_and_null_ids(spark):
    rows = [(7, t) for t in texts(60, 20)] + [(None, t) for t in texts(40, 20)] + [(i, t) for i, t in enumerate(texts(30, 20))] + [(7, "same")] * 9 + [(None, "same")] * 9 + [(-(2**63), "least"), (2**63 - 1, "most"), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    signed = lambda t: int.from_bytes(xxhash.xxh64(t.encode(), seed=42).digest(), "big", signed=True)
    order = sorted([(i, t or "") for i, t in rows], key=lambda x: (x[0] is None, -(x[0] or 0), signed(x[1])))
    want = [(i, t, nxt) for (i, t), (_, nxt) in zip(order, order[1:] + order[:1], strict=True)]
    assert sorted(map(str, map(tuple, merkle.with_next(df.repartition(3)).collect()))) == sorted(map(str, want))
    got = merkle.fingerprint_edits(df).collect()
    edited = [(i, t[: len(t) - len(t) // 3] + nxt[: len(t) // 3]) for i, t, nxt in want]
    assert sorted(str((r.doc_id, r.edited_sha256)) for r in got) == sorted(str((i, hashlib.sha256(e.encode()).hexdigest())) for i, e in edited)


def test_variants_are_those_of_the_words():
    some = [x.split() for x in (b"a b c", b"a c", b"", b"a a b", b"b", b"a b c d e", b"a b c e")]
    of, key, place = lines.variants(some)
    by = {}
    for i, k, p in zip(of.tolist(), key.tolist(), place.tolist(), strict=True):
        words = some[i] if p < 0 else some[i][:p] + some[i][p + 1 :]
        assert by.setdefault(k, words) == words
    assert len(by) == len({tuple(w) for w in by.values()}) and len(of) == sum(len(x) + 1 for x in some)


def test_line_of_very_many_words():
    line = [b"w%d" % (i % 977) for i in range(200_000)]
    began = time.time()
    of, key, place = lines.variants([line, line[:500] + line[501:]])
    assert time.time() - began < 5
    assert key[1] in key[(of == 0) & (place >= 0)]


def test_more_candidates_than_a_filter_holds(spark, monkeypatch):
    base = texts(40, 14)
    rows = [(i, "\n".join([t, "short one", t.replace("w1", "x1", 1)])) for i, t in enumerate(base * 2)] + [(500 + i, t) for i, t in enumerate(texts(40, 14))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = sorted(map(tuple, lines.duplicate_lines(df).collect()))
    for module in (common, lines):
        monkeypatch.setattr(module, "MAX_FILTER_BITS", 1 << 6)
    assert sorted(map(tuple, lines.duplicate_lines(df).collect())) == wanted


def fingerprint(text):
    """The contract's fingerprint, bit by bit."""
    for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ":
        text = text.replace(c, chr(ord(c) + 32))
    words = [w for w in "".join(c if c not in " \t\n\v\f\r" else " " for c in text).split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def test_fingerprints_written_out():
    for t in [*texts(20, 40), "", "one", "One TWO", "a a a a a a", "Ünï Ö wörd x y z", "tab\tnew\nline\x0bv\x0cf\rr", "É é E e"]:
        assert simhash.fingerprint(t) == fingerprint(t)


@pytest.mark.parametrize("local", [0, 1 << 20])
def test_components_of_a_star_and_a_path(spark, monkeypatch, local):
    monkeypatch.setattr(graph, "LOCAL", local)
    edges = [(0, i) for i in range(1, 300)] + [(1000 + i, 1001 + i) for i in range(90)] + [(5, 5), (None, 3)]
    got = dict(map(tuple, graph.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {i: 0 for i in range(300)} | {1000 + i: 1000 for i in range(91)}


def test_remix_of_rows_without_an_id(spark):
    rows = [(None, t, "a") for t in texts(30, 10)] + [(i, t, "b") for i, t in enumerate(texts(30, 10))] + [(99, None, "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    took = {}
    for r in mixing.mix(df).collect():
        a, b = took.get(r.doc_id, (0, 0))
        took[r.doc_id] = a + r.taken, b + r.size
    times = {i: 1 if size == 0 else min(3, (2 * taken + size) // (2 * size)) for i, (taken, size) in took.items()}
    want = sorted(str((i, t)) for i, t, _ in rows for _ in range(times[i]))
    assert sorted(str((r.doc_id, r.text)) for r in mixing.remix(df).collect()) == want
