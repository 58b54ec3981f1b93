"""Reduction, regions, contrast, sliding windows and scenes against one pass over the joined raster."""

import numpy as np
import pytest

from tilewright.operators import graph, reduction, regions, scenes, sliding

BLOCKS = "slide string, by int, bx int, pixels binary"


def cut(m, block):
    h, w = m.shape[:2]
    for by in range(-(-h // block)):
        for bx in range(-(-w // block)):
            tile = np.zeros((block, block, *m.shape[2:]), np.uint8)
            part = m[by * block : (by + 1) * block, bx * block : (bx + 1) * block]
            tile[: part.shape[0], : part.shape[1]] = part
            yield by, bx, tile.tobytes()


def blocks(spark, slides, block):
    return spark.createDataFrame([(s, *b) for s, m in slides.items() for b in cut(m, block)], BLOCKS).repartition(3)


def sizes(spark, slides):
    return spark.createDataFrame([(s, *m.shape[:2]) for s, m in slides.items()], "slide string, h int, w int")


def whole(rows, block, shape, column="pixels", dtype=np.uint8):
    out = np.zeros((shape[0] + block, shape[1] + block, *shape[2:]), dtype)
    for r in rows:
        out[r.by * block : (r.by + 1) * block, r.bx * block : (r.bx + 1) * block] = np.frombuffer(r[column], dtype).reshape(block, block, *shape[2:])
    return out[: shape[0], : shape[1]]


def smooth_and_sample(x, scale):
    """Along the first axis: Gaussian with mirrored ends, then interpolation at output centres."""
    n, m = x.shape[0], max(1, round(x.shape[0] * scale))
    sigma = max(0, (n / m - 1) / 2)
    reach = int(4 * sigma + 0.5)
    k = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2) if sigma else np.ones(1)
    padded = np.pad(x.astype(float), ((reach, reach), *[(0, 0)] * (x.ndim - 1)), mode="reflect")
    g = sum(w * padded[i : i + n] for i, w in enumerate(k / k.sum()))
    at = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
    low = np.floor(at).astype(int)
    f = (at - low).reshape(-1, *[1] * (x.ndim - 1))
    return (1 - f) * g[low] + f * g[np.minimum(low + 1, n - 1)]


@pytest.mark.parametrize(("scale", "channels"), [(0.1, 3), (0.5, 1), (0.27, 1)])
def test_reduction_over_blocks(spark, scale, channels):
    r = np.random.default_rng(1)
    slides = {"a": r.integers(0, 256, (203, 154, channels), dtype=np.uint8), "b": np.full((61, 40, channels), 255, np.uint8), "c": r.integers(0, 256, (90, 300, channels), dtype=np.uint8)}
    got = reduction.reduce_slides(blocks(spark, slides, 32), 32, sizes(spark, slides), channels, scale, 16).collect()
    for s, m in slides.items():
        want = smooth_and_sample(smooth_and_sample(m, scale).swapaxes(0, 1), scale).swapaxes(0, 1)
        assert (whole([x for x in got if x.slide == s], 16, want.shape) == np.floor(want + 1e-6)).all()
    assert (whole([x for x in got if x.slide == "b"], 16, (max(1, round(61 * scale)), max(1, round(40 * scale)), channels)) == 255).all()


def flood(m):
    """Regions by flooding from each pixel, corners too."""
    left, out = set(map(tuple, np.argwhere(m).tolist())), []
    while left:
        todo = [left.pop()]
        own = list(todo)
        while todo:
            y, x = todo.pop()
            near = {(y + a, x + b) for a in (-1, 0, 1) for b in (-1, 0, 1)} & left
            left -= near
            own += near
            todo += near
        y, x = zip(*own, strict=True)
        out.append((len(own), min(y), min(x), max(y) + 1, max(x) + 1))
    return sorted(out)


def spiral(n):
    """A path of one pixel's width that winds through the whole square."""
    m = np.zeros((n, n), np.uint8)
    y, x, dy, dx = 0, 0, 0, 1
    m[0, 0] = 1
    while True:
        for _ in range(2):
            a, b = y + 2 * dy, x + 2 * dx
            if 0 <= y + dy < n and 0 <= x + dx < n and not (0 <= a < n and 0 <= b < n and m[a, b]) and not m[y + dy, x + dx]:
                break
            dy, dx = dx, -dy
        else:
            return m
        y, x = y + dy, x + dx
        m[y, x] = 1


@pytest.mark.parametrize("local", [0, 1 << 20])
def test_regions_over_blocks(spark, monkeypatch, local):
    monkeypatch.setattr(graph, "LOCAL", local)
    r = np.random.default_rng(2)
    corner = np.zeros((32, 32), np.uint8)
    corner[15, 15] = corner[16, 16] = corner[15, 16 + 8] = corner[16, 15 - 8] = 1
    anti = corner[:, ::-1].copy()
    slides = {"noise": (r.random((60, 70)) < 0.35).astype(np.uint8), "spiral": spiral(48), "none": np.zeros((20, 20), np.uint8), "all": np.ones((40, 33), np.uint8), "corner": corner, "anti": anti}
    found = regions.regions(blocks(spark, slides, 16), 16)
    got = found.collect()
    for s, m in slides.items():
        assert sorted(tuple(x[1:]) for x in got if x.slide == s) == flood(m)
    top = {x.slide: tuple(x[1:]) for x in regions.largest_region(found).collect()}
    assert top == {s: min(f, key=lambda x: (-x[0], *x[1:])) for s, m in slides.items() if (f := flood(m))}


def test_contrast_over_blocks(spark):
    r = np.random.default_rng(3)
    slides = {"a": np.clip(r.normal(90, 20, (70, 53)) + np.arange(53), 0, 255).astype(np.uint8), "flat": np.full((33, 40), 9, np.uint8), "tiny": r.integers(0, 256, (5, 3), dtype=np.uint8)}
    got = regions.enhance_contrast(blocks(spark, slides, 16), 16, sizes(spark, slides), 0.02, 4).collect()
    for s, m in slides.items():
        h, w = m.shape
        region = lambda i, n: i * 4 // n
        tables = {}
        for gy in range(4):
            for gx in range(4):
                own = [int(m[y, x]) for y in range(h) for x in range(w) if (region(y, h), region(x, w)) == (gy, gx)]
                n = [own.count(v) for v in range(256)]
                if not own:
                    tables[gy, gx] = list(range(256))
                    continue
                most = max(1, int(0.02 * len(own)))
                over = sum(max(0, k - most) for k in n)
                n = [min(k, most) + over // 256 + (v < over % 256) for v, k in enumerate(n)]
                tables[gy, gx] = [int(255 * sum(n[: v + 1]) / len(own) + 0.5) for v in range(256)]
        out = np.zeros_like(m)
        for y in range(h):
            for x in range(w):
                a, b = (min(max((i + 0.5) * 4 / n - 0.5, 0), 3) for i, n in ((y, h), (x, w)))
                gy, gx = int(a), int(b)
                fy, fx = a - gy, b - gx
                t = [[tables[min(gy + i, 3), min(gx + j, 3)][m[y, x]] for j in (0, 1)] for i in (0, 1)]
                out[y, x] = int((1 - fy) * ((1 - fx) * t[0][0] + fx * t[0][1]) + fy * ((1 - fx) * t[1][0] + fx * t[1][1]) + 0.5)
        assert np.abs(whole([x for x in got if x.slide == s], 16, m.shape).astype(int) - out).max() <= 0


def test_sliding_windows_over_blocks(spark):
    def neighbourly(image):
        """A segmenter that looks at a pixel's neighbours, so that what lies beyond a border matters."""
        level = image.mean(axis=0)
        p = np.pad(level, 1, mode="edge")
        around = sum(p[1 + a : p.shape[0] - 1 + a, 1 + b : p.shape[1] - 1 + b] for a in (-1, 0, 1) for b in (-1, 0, 1)) / 9
        return np.stack([np.full_like(level, 0.5), around])

    r = np.random.default_rng(4)
    slides = {"a": r.integers(0, 256, (70, 85, 3), dtype=np.uint8), "small": r.integers(0, 256, (20, 9, 3), dtype=np.uint8), "fits": r.integers(0, 256, (32, 32, 3), dtype=np.uint8)}
    got = sliding.infer_sliding(blocks(spark, slides, 24), 24, sizes(spark, slides), lambda: neighbourly, roi=32, overlap=0.25).collect()
    for s, m in slides.items():
        h, w = m.shape[:2]
        full = np.zeros((max(h, 32), max(w, 32), 3), np.uint8)
        full[:h, :w] = m
        starts = [sorted({min(i * 24, n - 32) for i in range(-(-(n - 32) // 24) + 1)}) for n in full.shape[:2]]
        total, n = np.zeros((2, *full.shape[:2])), np.zeros(full.shape[:2])
        for a in starts[0]:
            for b in starts[1]:
                total[:, a : a + 32, b : b + 32] += neighbourly(full[a : a + 32, b : b + 32].transpose(2, 0, 1).astype(np.float32) / 255).astype(np.float32)
                n[a : a + 32, b : b + 32] += 1
        mean = total / n
        rows = [x for x in got if x.slide == s]
        assert (whole(rows, 24, full.shape[:2], "pred") == np.where(mean[1] > mean[0], 255, 0)).all()
        assert np.allclose(whole(rows, 24, full.shape[:2], "p", np.float32), 1 / (1 + np.exp(mean[0] - mean[1])), atol=1e-6)


def test_scenes_of_any_axes(spark):
    r = np.random.default_rng(5)
    cases = [("YX", (20, 30)), ("ZYX", (4, 20, 30)), ("SCZYX0", (1, 2, 3, 20, 30, 1)), ("TYXC", (3, 20, 30, 2)), ("YX0", (20, 30, 3)), ("ABC", (20, 30, 3)), ("QRS", (3, 20, 30)), ("QRS", (20, 30, 25)), ("XY", (20, 30)), ("CTZ", (2, 20, 30)), ("CTZ", (2, 5, 6)), ("CTZ", (20, 30, 4)), ("Y", (9,)), ("YX", (3, 4, 5))]
    data = [r.integers(0, 256, s, dtype=np.uint8) for _, s in cases]
    df = spark.createDataFrame([("s", k, a, list(x.shape), x.tobytes()) for k, ((a, _), x) in enumerate(zip(cases, data, strict=True))], "slide string, scene int, axes string, shape array<int>, pixels binary")
    got = {x.scene: x for x in scenes.normalise_scenes(df).collect()}
    d = data
    want = [d[0], d[1].max(0), d[2][0, ..., 0].max(1), d[3].max(0).transpose(2, 0, 1), d[4].transpose(2, 0, 1), d[5].max(0), d[6].max(0), d[7].max(0), d[8], d[9], d[10].max(0), d[11].transpose(2, 0, 1)]
    for k, w in enumerate(want):
        x = got[k]
        assert x.error is None and x.axes == ("CYX" if w.ndim == 3 else "YX") and (np.frombuffer(x.pixels, np.uint8).reshape(w.shape) == w).all() and x.c == (w.shape[0] if w.ndim == 3 else 1)
    assert got[12].error and got[13].error
