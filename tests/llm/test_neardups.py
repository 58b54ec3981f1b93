"""The pipeline's near-duplicate stage against brute force over all pairs."""

import random

import numpy as np

import corpus_pipeline

from tilewright.llm import neardups, simhash

DOCS = "doc_id long, text string, source string"
rng = random.Random(8)
VOCAB = [f"w{i}" for i in range(500)]


def jaccard(a, b):
    a, b = (set(neardups.shingles(t).tolist()) for t in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(words, n):
    words = list(words)
    for i in rng.sample(range(len(words)), n):
        words[i] = f"x{rng.random()}"
    return words


def brute(rows):
    """Row numbers that stay: the first by id (null last) of each group."""
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if comp[i] != comp[j] and jaccard(rows[i][1], rows[j][1]) >= 0.8:
                comp = [comp[j] if c == comp[i] else c for c in comp]
    groups = {}
    for i, c in enumerate(comp):
        groups.setdefault(c, []).append(i)
    return sorted(min((rows[i][0] is None, rows[i][0] or 0) for i in g) for g in groups.values())


def test_stage_reaches_similarity(spark):
    rows = [(5000, None), (5001, " \n"), (5002, "one two"), (5003, "One  two"), (5004, "one two three")]
    for _ in range(40):
        base = rng.choices(VOCAB, k=200)
        rows += [(len(rows), " ".join(edited(base, n))) for n in (0, 1, 2, 4, 4, 6, 12)]
    low = [(i, j) for i in range(len(rows)) for j in range(i) if 0.8 <= jaccard(rows[i][1], rows[j][1]) < 0.85]
    assert len(low) > 20
    got = corpus_pipeline.one_of_each(spark, spark.createDataFrame(rows, DOCS.rsplit(",", 1)[0]), "").collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == brute(rows)


def test_failed_pairs_leave_no_gap(spark, monkeypatch):
    monkeypatch.setattr(neardups, "AGREE", 40)
    rows = []
    for _ in range(10):
        base = rng.choices(VOCAB, k=200)
        for k in range(12):
            rows.append((len(rows), " ".join(base)))
            base = edited(base, 3)
    got = corpus_pipeline.one_of_each(spark, spark.createDataFrame(rows, DOCS.rsplit(",", 1)[0]), "").collect()
    assert sorted((False, r.doc_id) for r in got) == brute(rows)


def test_one_row_stays_whatever_its_id(spark):
    a, b = (" ".join(rng.choices(VOCAB, k=100)) for _ in range(2))
    rows = [(None, a), (None, a + " more"), (7, b), (7, "a text of its own for the same id"), (3, b + " more")]
    got = corpus_pipeline.one_of_each(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert len(got) == 3 and {(r.doc_id, r.text) for r in got} >= {(3, b + " more"), rows[3]} and sum(r.doc_id is None for r in got) == 1


def test_covering_alone_links_all_in_reach(spark, monkeypatch):
    """Without any band, sets within the radius are joined as brute force joins them, through pairs of equal fingerprints too."""
    monkeypatch.setattr(neardups, "_likely", lambda members, spanning: spark.createDataFrame([], "a long, b long"))
    rng.seed(5)
    rows = []
    for _ in range(30):
        base = rng.choices(VOCAB, k=500)
        rows += [(len(rows) + k, " ".join(edited(base, n))) for k, n in enumerate((0, 1, 2))]
    fps = [simhash.majority(neardups.shingles(t)) for _, t in rows]
    assert all((fps[i] ^ fps[j]).bit_count() <= neardups.RADIUS for i in range(len(rows)) for j in range(i) if jaccard(rows[i][1], rows[j][1]) >= 0.9)
    got = corpus_pipeline.one_of_each(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    assert len(brute(rows)) < len(rows) and sorted((False, r.doc_id) for r in got) == brute(rows)


def test_wide_links_are_complete(spark):
    """Components of the links are those of all pairs within 11 bits, some exactly there and in hot buckets."""
    at = np.random.default_rng(3)
    fps = [int(x) for x in at.integers(0, 2**64, 300, dtype=np.uint64)]
    for d in (1, 5, 10, 11, 11, 11, 12):
        fps += [f ^ sum(1 << int(b) for b in at.choice(64, d, replace=False)) for f in fps[:60]]
    fps = sorted(set(fps + [fps[0] ^ k for k in range(300)]))
    signed = np.array(fps, np.uint64).view(np.int64)
    got = simhash.wide_links(spark.createDataFrame([(int(x),) for x in signed], "fp long"), 11, 2).collect()
    place = {int(x): i for i, x in enumerate(signed)}

    def labels(pairs):
        root = np.arange(len(fps))
        for i, j in pairs:
            if root[i] != root[j]:
                root[root == max(root[i], root[j])] = min(root[i], root[j])
        return root.tolist()

    close = np.argwhere(np.triu(np.bitwise_count(np.array(fps, np.uint64)[:, None] ^ np.array(fps, np.uint64)[None]) <= 11, 1))
    linked = [(place[r.u], place[r.v]) for r in got]
    assert all((fps[i] ^ fps[j]).bit_count() <= 11 for i, j in linked)
    assert labels(linked) == labels(close.tolist()) and len(linked) < len(close) // 4
