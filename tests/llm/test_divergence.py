"""Divergence of sources against its SQL, exact integers and awkward input."""

import duckdb
import numpy as np

from tilewright.llm import divergence, sql

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, term string, rank int, value long"
COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def same(spark, rows, **kw):
    """rows (text, lang, source): the operator's rows, held against SQL."""
    df = spark.createDataFrame([(i, *r, 1, "t", 1, 1) for i, r in enumerate(rows)], SCHEMA)
    got = sorted(map(str, map(tuple, divergence.source_divergence(df, **kw).select(COLUMNS).collect())))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (text VARCHAR, lang VARCHAR, source VARCHAR)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    assert got == sorted(map(str, con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({sql.OP12})").fetchall()))
    return got


def test_odd_rows(spark):
    rows = [
        (None, None, None), ("", "en", ""), ("one One ONE", "en", "a"), ("one,two;one", "en", "b"), ("one 2two2 x\x00y", "en", None), ("two " * 50_000, "en", "a"), ("Two", "en", "c"),
        ("Ünï ünï 文字 😀", "de", "a"), ("Ünï 文字", "de", "a"), ("Ünï 文字 ünï x", "de", "b"), ("rare", "fr", "a"), ("words", "fr", "b"), ("same row", "es", "a"), ("same row", "es", "a"), ("same row", "es", "b"),
    ]
    assert same(spark, rows)
    assert same(spark, []) == []
    # no kept term at all: pairs of value 0
    assert same(spark, [("a", "en", "x"), ("b", "en", "y")]) == ["('en', 'x', 'pair', 'y', 0, 1)", "('en', 'y', 'pair', 'x', 0, 1)"]


def test_many_sources_and_small_shards(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SHARD", 3)
    monkeypatch.setattr(divergence, "SOURCES", 4)
    monkeypatch.setattr(divergence, "HELD", 20)
    monkeypatch.setattr(divergence, "SLICE", 16)
    rng = np.random.default_rng(1)
    words = ["".join(chr(97 + int(c)) for c in f"{i:03d}") for i in range(300)]
    rows = [(" ".join(rng.choice(words, 30, p=(w := rng.random(300) ** 4) / w.sum())), str(rng.choice(["en", "de"])), f"s{min(int(rng.exponential(4)), 9)}") for _ in range(120)]
    assert same(spark, rows)


def test_exact_shares_and_runs():
    for n, size, v in ((0, 0, 1), (10**12, 3 * 10**12, 10**7), (9 * 10**14, 9 * 10**14 + 5, 3), (7, 22, 1)):
        assert divergence.share(np.array([n]), size, v)[0] == 1 + 10**9 * (n + 1) // (size + v)
    rng = np.random.default_rng(0)
    a, b, run = (np.sort(rng.integers(1, 5, 200)), rng.integers(1, 5, 200), rng.integers(1, 4, 200))
    of = lambda c: divergence.runs_of(np.arange(200), c, 200)
    assert divergence.divergence(of(a), of(b), np.r_[0, np.cumsum(run)]) == sum(int((x - y) ** 2 // y * r) for x, y, r in zip(a, b, run, strict=True))
