"""Near-duplicate vectors against brute force and on awkward input."""

import numpy as np
import pytest

from tilewright.llm import itq

SCHEMA = "vec_id long, embedding array<{0}>, label int, uid long, t int, key string"


def vectors(spark, rows, kind="float"):
    """(vec_id, embedding) with more columns whose names the operator uses itself."""
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, 2, "k") for i, v in rows], SCHEMA.format(kind))


def brute(rows, bound=0.95):
    dim = max((len(v) for _, v in rows if v is not None), default=0)
    x = np.zeros((len(rows), dim))
    ok = np.zeros(len(rows), bool)
    for i, (_, v) in enumerate(rows):
        if v is not None and len(v) and all(e is not None and np.isfinite(e) for e in v) and any(v):
            x[i, : len(v)], ok[i] = v, True
    x[ok] /= np.abs(x[ok]).max(axis=1, keepdims=True)
    x[ok] /= np.linalg.norm(x[ok], axis=1, keepdims=True)
    linked = (x @ x.T >= bound) & ok[:, None] & ok[None]
    np.fill_diagonal(linked, False)
    part = np.arange(len(rows))
    while ((low := np.array([min([part[i], *part[linked[i]]]) for i in range(len(rows))])) != part).any():
        part = low
    out = []
    for i, (vec, _) in enumerate(rows):
        ids = [rows[j][0] for j in np.flatnonzero(part == part[i]) if rows[j][0] is not None]
        component = (min(ids) if ids else None) if ok[i] else vec
        out.append((vec, int(linked[i].sum()), component, vec is not None and vec == component))
    return sorted(map(str, out))


def answer(spark, rows, kind="float"):
    return sorted(str(tuple(r)) for r in itq.near_vectors(vectors(spark, rows, kind)).select("vec_id", "n_links", "component_id", "kept").collect())


def at_angle(rng, v, cosine):
    aside = rng.standard_normal(len(v))
    aside -= (aside @ v) / (v @ v) * v
    return cosine * v / np.linalg.norm(v) + np.sqrt(1 - cosine**2) * aside / np.linalg.norm(aside)


def groups(rng, dim=32, sizes=(40, 90, 3, 2), lone=150):
    rows = [v for n in sizes for c in [rng.standard_normal(dim)] for v in [c, *(at_angle(rng, c, 0.99) for _ in range(n - 1))]]
    rows += list(rng.standard_normal((lone, dim)))
    return [(int(i), v.astype(np.float32).tolist()) for i, v in zip(rng.permutation(len(rows)), rows, strict=True)]


@pytest.mark.parametrize("block", [1024, 8])
def test_groups_of_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(itq, "BLOCK", block)
    rng = np.random.default_rng(2)
    rows = groups(rng)
    rows += [(1000 + i, rows[0][1]) for i in range(50)]  # one vector again and again
    assert answer(spark, rows) == brute(rows)


def test_odd_rows(spark):
    v, w = [1.0, 2.0, 3.0], [3.0, -1.0, 0.5]
    rows = [
        (5, v), (4, v), (4, v), (None, v), (None, w), (9, None), (10, []), (11, [0.0, 0.0, 0.0]), (12, [1.0, None, 2.0]), (13, [float("nan"), 1.0, 1.0]), (14, [float("inf"), 1.0, 1.0]),
        (15, [2.0, 4.0, 6.0]), (16, [1e-200, 2e-200, 3e-200]), (17, [1e200, 2e200, 3e200]), (18, [1.0]), (19, [5.0, 0.0, 0.0]), (20, [-1.0, -2.0, -3.0]), (None, None),
    ]
    assert answer(spark, rows, "double") == brute(rows)
    assert answer(spark, []) == []
    assert answer(spark, [(1, None), (2, [0.0])]) == brute([(1, None), (2, [0.0])])
    assert answer(spark, [(3, [1.0]), (1, [2.0]), (2, [-1.0])]) == brute([(3, [1.0]), (1, [2.0]), (2, [-1.0])])


def test_recall_at_the_bound(spark):
    """Of pairs a hair above the bound at least 0.9 are found, none below it."""
    rng = np.random.default_rng(8)
    for shift in (0.0, 3.0):  # vectors all around, and in a narrow cone
        base = rng.standard_normal((400, 48)) + np.eye(48)[0] * shift * 3
        rows = [(2 * i, v.tolist()) for i, v in enumerate(base)] + [(2 * i + 1, at_angle(rng, v, 0.9501).tolist()) for i, v in enumerate(base)]
        want, got = (sum(int(r.split(",")[1]) for r in x) for x in (brute(rows), answer(spark, rows, "double")))
        assert 0.99 * want <= got <= want
