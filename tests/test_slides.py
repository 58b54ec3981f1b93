"""Operators over whole slides against one pass over the joined raster."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.operators import canvas, distance, maskwindows, tileops

BLOCKS = "slide string, by int, bx int, pixels binary"


def raster(seed, h, w, share=0.02):
    """Mostly set, with holes."""
    r = np.random.default_rng(seed)
    m = np.where(r.random((h, w)) < share, 0, r.integers(1, 256, (h, w))).astype(np.uint8)
    m[: h // 5, w // 2 :] = 0
    return m


def cut(m, block):
    h, w = m.shape
    for by in range(-(-h // block)):
        for bx in range(-(-w // block)):
            tile = np.zeros((block, block), np.uint8)
            part = m[by * block : (by + 1) * block, bx * block : (bx + 1) * block]
            tile[: part.shape[0], : part.shape[1]] = part
            if tile.any():
                yield by, bx, tile.tobytes()


def blocks(spark, slides, block):
    return spark.createDataFrame([(s, *b) for s, m in slides.items() for b in cut(m, block)], BLOCKS).repartition(3)


def whole(rows, block, shape):
    out = np.zeros((shape[0] + block, shape[1] + block), np.uint8)
    for r in rows:
        out[r.by * block : (r.by + 1) * block, r.bx * block : (r.bx + 1) * block] = np.frombuffer(r.pixels, np.uint8).reshape(block, block)
    return out[: shape[0], : shape[1]]


def disk_eroded(m, radius):
    padded = np.pad(m != 0, radius)
    alive = np.ones(m.shape, bool)
    for dy in range(-radius, radius + 1):
        for dx in range(-radius, radius + 1):
            if dy * dy + dx * dx <= radius * radius:
                alive &= padded[radius + dy : radius + dy + m.shape[0], radius + dx : radius + dx + m.shape[1]]
    return np.where(alive, m, 0)


@pytest.mark.parametrize("radius", [1, 3, 9, 20])
def test_erosion_over_blocks(spark, radius):
    slides = {"a": raster(1, 70, 53, 0.004), "b": np.full((40, 90), 7, np.uint8), "c": raster(2, 8, 8, 0.5), "d": np.zeros((9, 9), np.uint8)}
    slides["b"][20, 44] = 0
    got = distance.erode(blocks(spark, slides, 16), 16, radius).collect()
    for s, m in slides.items():
        assert (whole([r for r in got if r.slide == s], 16, m.shape) == disk_eroded(m, radius)).all()


def test_full_tiles_keep_their_common_border(spark):
    m = np.full((16, 32), 255, np.uint8)
    got = whole(distance.erode(blocks(spark, {"a": m}, 16), 16, 2).collect(), 16, m.shape)
    assert (got[2:-2, 2:-2] == 255).all() and got.sum() == 255 * 12 * 28


def test_distances_are_exact(spark):
    m = raster(3, 40, 47, 0.01)
    rows = distance.distances(blocks(spark, {"a": m}, 16), 16, 60).collect()
    zero = np.argwhere(np.pad(m, 61) == 0) - 61
    for r in rows:
        d = np.frombuffer(r.distance, "<i8").reshape(16, 16)
        for y, x in ((0, 0), (3, 12), (15, 15), (8, 1)):
            gy, gx = r.by * 16 + y, r.bx * 16 + x
            assert d[y, x] == ((zero - (gy, gx)) ** 2).sum(axis=1).min()


def test_windows_cross_blocks(spark):
    m = raster(4, 60, 45)
    places = [(0, 0, 0, 60, 45), (1, 10, 20, 30, 3), (2, -4, -6, 20, 20), (3, 50, 40, 20, 20), (4, 100, 100, 5, 5), (5, 15, 15, 2, 2)]
    wanted = spark.createDataFrame([("a", *p) for p in places], "slide string, tile int, up int, left int, h int, w int")
    got = {r.tile: r for r in canvas.windows(blocks(spark, {"a": m}, 16), 16, wanted).collect()}
    padded = np.pad(m, 120)
    for tile, up, left, h, w in places:
        assert (np.frombuffer(got[tile].pixels, np.uint8).reshape(h, w) == padded[up + 120 : up + 120 + h, left + 120 : left + 120 + w]).all()


@pytest.mark.parametrize("method", ["nearest", "bilinear"])
def test_masks_of_tiles(spark, method):
    m = raster(5, 37, 29, 0.3)
    full = (365, 300)
    at = [(0, 0, 0, 100, 100), (1, 100, 0, 265, 100), (2, 0, 100, 100, 200), (3, 100, 100, 265, 200), (4, 364, 299, 1, 1)]
    tiles = spark.createDataFrame([("a", *p, *full) for p in at] + [("no mask", *at[0], *full)], "slide string, tile int, row_up int, col_up int, h int, w int, full_h int, full_w int")
    sizes = spark.createDataFrame([("a", *m.shape)], "slide string, mask_h int, mask_w int")
    got = {r.tile: r.mask for r in maskwindows.tile_masks(tiles, blocks(spark, {"a": m}, 8), sizes, 8, method).collect()}
    assert set(got) == set(range(5))
    y, x = (np.arange(f) + 0.5 for f in full)
    y, x = y * m.shape[0] / full[0], x * m.shape[1] / full[1]
    if method == "nearest":
        want = m[np.ix_(y.astype(int), x.astype(int))]
    else:
        y, x = np.clip(y - 0.5, 0, 36), np.clip(x - 0.5, 0, 28)
        a, b = np.floor(y).astype(int), np.floor(x).astype(int)
        p = np.pad(m.astype(float), ((0, 1), (0, 1)), mode="edge")
        fy, fx = (y - a)[:, None], (x - b)[None]
        want = np.floor((1 - fy) * ((1 - fx) * p[np.ix_(a, b)] + fx * p[np.ix_(a, b + 1)]) + fy * ((1 - fx) * p[np.ix_(a + 1, b)] + fx * p[np.ix_(a + 1, b + 1)]) + 0.5).astype(np.uint8)
    for tile, up, left, h, w in at:
        assert (np.frombuffer(got[tile], np.uint8).reshape(h, w) == want[up : up + h, left : left + w]).all()
    if method == "nearest":  # as with the whole mask beside each tile
        beside = tiles.filter("slide = 'a'").withColumns({"mask": F.lit(m.tobytes()), "mask_h": F.lit(m.shape[0]), "mask_w": F.lit(m.shape[1])})
        assert {r.tile: r.mask for r in tileops.sample_mask(beside).collect()} == got
