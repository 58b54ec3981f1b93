"""Tile-level sums against the pixel forms, the command line, files of whole slides and smaller helpers."""

import io
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.__main__ import main
from tilewright.functions import naming
from tilewright.operators import infer, metrics, mosaic, render, tileops
from tilewright.plans import slides
from tilewright.sources import config, rasters, tiff

TILES = "slide string, tile int, h int, w int, out_h int, out_w int, row_up int, col_up int, small_up int, small_left int, rgb binary, mask binary, pred binary"


def slide_tiles(seed=1, channels=1):
    """A slide of 2 x 2 tiles of 40 pixels whose tissue has an edge."""
    r = np.random.default_rng(seed)
    mask = np.full((80, 80), 255, np.uint8)
    mask[:, 60:] = 0
    rgb = r.integers(1, 256, (80, 80, 3), dtype=np.uint8)
    pred = np.where(r.random((80, 80)) < 0.5, 255, 0).astype(np.uint8)
    out = []
    for k in range(4):
        y, x = k // 2 * 40, k % 2 * 40
        part = lambda a, y=y, x=x: np.ascontiguousarray(a[y : y + 40, x : x + 40])
        m = np.repeat(part(mask)[..., None], channels, axis=2)
        m[..., 1:] = 7
        out.append(("a", k, 40, 40, 8, 8, y, x, y // 5, x // 5, part(rgb).tobytes(), m.tobytes(), part(pred).tobytes()))
    return out


def heat(state):
    rows = state["heatmap"].collect()
    out = np.zeros((16, 16))
    for r in rows:
        out[r.small_up : r.small_up + 8, r.small_left : r.small_left + 8] = np.frombuffer(r.heat, "<f8").reshape(8, 8)
    return out


def test_settings_of_erosion_change_the_plan(spark):
    tiles = spark.createDataFrame(slide_tiles(), TILES)
    state = {"tiles": tiles, "slides": tiles.groupBy("slide").agg(F.count("*").alias("n_tiles"))}
    base = config.Settings(pix_1mm=40, block=32)
    plain = heat(slides.run_stages(state, settings=base))
    assert plain[:, :12].min() > 0 and plain[:, 12:].max() == 0
    small = heat(slides.run_stages(state, settings=config.replace(base, heatmap_erosion_pixels=2)))
    assert (small[2:14, 2:10] == plain[2:14, 2:10]).all() and small[:, 10:].max() == 0 and small[:2].max() == 0
    full = slides.run_stages(state, settings=config.replace(base, erosion_pixels=9))
    masks = {r.tile: np.frombuffer(r.mask, np.uint8).reshape(40, 40) for r in full["masked"].collect()}
    whole = np.vstack([np.hstack([masks[0], masks[1]]), np.hstack([masks[2], masks[3]])])
    assert (whole[9:71, 9:51] == 255).all() and whole.astype(int).sum() == 255 * 62 * 42
    assert heat(full)[:, 11:].max() == 0
    # masks of several channels count by their first
    many = spark.createDataFrame(slide_tiles(channels=3), TILES)
    assert (heat(slides.run_stages(state | {"tiles": many}, settings=base)) == plain).all()


def test_small_masks_as_blocks(spark):
    tiles = spark.createDataFrame(slide_tiles(), TILES).withColumns({"full_h": F.lit(80), "full_w": F.lit(80)})
    small = np.zeros((32, 32), np.uint8)
    small[:8, :6] = 255
    state = {
        "tiles": tiles.drop("mask"), "slides": tiles.groupBy("slide").agg(F.count("*").alias("n_tiles")),
        "masks": spark.createDataFrame([("a", 0, 0, small.tobytes())], "slide string, by int, bx int, pixels binary"), "mask_sizes": spark.createDataFrame([("a", 8, 8)], "slide string, mask_h int, mask_w int"),
    }
    base = config.Settings(pix_1mm=40, block=32)
    want = slides.run_stages({"tiles": tiles, "slides": state["slides"]}, settings=base)
    assert (heat(slides.run_stages(state, settings=base)) == heat(want)).all()
    eroded = slides.run_stages(state, settings=config.replace(base, erosion_pixels=10))["masked"].collect()
    assert sum(np.frombuffer(r.mask, np.uint8).astype(int).sum() for r in eroded) == 255 * 60 * 40


def test_files_of_whole_heatmaps(spark, tmp_path):
    tiles = spark.createDataFrame(slide_tiles(), TILES)
    state = slides.run_stages({"tiles": tiles, "slides": tiles.groupBy("slide").agg(F.count("*").alias("n_tiles"))}, settings=config.Settings(pix_1mm=40, block=16))
    state["sizes"] = spark.createDataFrame([("a", 16, 16)], "slide string, small_h int, small_w int")
    slides.write_heatmaps(state, str(tmp_path), config.Settings(block=16))
    want = heat(state)
    assert (np.load(io.BytesIO((tmp_path / "heatmap/a.npy").read_bytes())) == want).all()
    assert (np.frombuffer((tmp_path / "heatmap/a.nii").read_bytes(), "<f8", offset=352).reshape(16, 16, order="F") == want).all()
    got = tiff.read_tiffs(spark, str(tmp_path / "colormap")).first()
    level = want / 1000 / state["ranges"].first().max_pct
    assert (np.frombuffer(got.pixels, np.uint8).reshape(16, 16) == np.minimum(np.floor(level * 256), 255)).all()


def test_losses_by_tile(spark):
    r = np.random.default_rng(3)
    rows, pixels = [], []
    for s in ("a", "b"):
        for _ in range(3):
            p = r.uniform(0.05, 0.95, 30)
            y, w = r.integers(0, 2, 30).astype(np.uint8), r.uniform(1, 3, 30)
            rows.append((s, y.tobytes(), np.stack([1 - p, p]).tobytes(), w.tobytes()))
            pixels += [(s, float(a), int(b), float(c)) for a, b, c in zip(p, y, w, strict=True)]
    tiles = spark.createDataFrame(rows, "slide string, truth binary, probs binary, weight binary")
    got = {x.slide: x for x in metrics.tile_losses(tiles, (0.3, 0.7), dtype="<f8").collect()}
    for x in metrics.losses(spark.createDataFrame(pixels, "slide string, p1 double, y int, weight double"), ["slide"], (0.3, 0.7)).collect():
        assert all(getattr(got[x.slide], c) == pytest.approx(x[c]) for c in ("focal", "tversky", "loss"))
    three = [("a", bytes([0, 1, 2, 2]), np.full((3, 4), 1 / 3).tobytes(), None)]
    x = metrics.tile_losses(spark.createDataFrame(three, "slide string, truth binary, probs binary, weight binary"), (1.0, 1.0, 1.0), dtype="<f8").first()
    assert x.focal == pytest.approx((2 / 3) ** 2 * np.log(3))
    by = [(tp + 1e-5) / (tp + 0.6 * (4 / 3 - tp) + 0.4 * (n - tp) + 1e-5) for n in (1, 2) for tp in (n / 3,)]
    assert x.tversky == pytest.approx(1 - sum(by) / 2)


def test_confusion_by_tile_and_its_file(spark, tmp_path):
    r = np.random.default_rng(4)
    y, p = r.integers(0, 4, (5, 40)).astype(np.uint8), r.integers(0, 3, (5, 40)).astype(np.uint8)
    tiles = spark.createDataFrame([("a", a.tobytes(), b.tobytes()) for a, b in zip(y, p, strict=True)] + [("a", None, b"")], "slide string, truth binary, pred binary")
    got = metrics.tile_confusion(tiles, 3)
    pixels = spark.createDataFrame([(int(a) if a < 3 else -1, int(b)) for a, b in zip(y.ravel(), p.ravel(), strict=True)], "truth int, pred int")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, metrics.confusion(pixels, "truth", "pred").collect()))
    metrics.write_metrics(metrics.segmentation_metrics(got), str(tmp_path / "stats"))
    assert spark.read.option("header", True).csv(str(tmp_path / "stats")).columns == ["acc", "prec", "recall", "iou", "dice"]


def test_helpers(spark):
    files = spark.createDataFrame([("a.czi", 5), ("Brain.czi", 5), ("big.czi", 500 << 30), ("skip.czi", 1)], "name string, bytes long")
    assert [r.name for r in naming.wanted_files(files, files.filter("name = 'skip.czi'")).collect()] == ["a.czi"]
    assert [r[0] for r in spark.createDataFrame([(" TAU",), ("Iron",)], "s string").select(naming.same_colour(F.col("s"))).collect()] == ["tau", "iron"]
    t = spark.createDataFrame([("a", 0, 8, 8), ("a", 1, 8, 8), ("b", 0, 8, 8)], "slide string, tile int, h int, w int")
    s = spark.createDataFrame([("a", 0, 4, 4), ("a", 1, 4, 4), ("b", 0, 4, 4), ("b", 1, 4, 4)], "slide string, tile int, out_h int, out_w int")
    assert sorted((r.slide, r.tile, r.out_h) for r in render.matched(t, s).collect()) == [("a", 0, 4), ("a", 1, 4)]
    heat = spark.createDataFrame([("a", 0, r, c, float(r * 3 + c)) for r in range(2) for c in range(3)], "slide string, tile int, r int, c int, value double")
    raw = rasters.nifti_tiles(heat).first().nifti
    assert (np.frombuffer(raw, "<f8", offset=352).reshape(2, 3, order="F") == np.arange(6).reshape(2, 3)).all()
    x = np.arange(24, dtype=np.uint8).reshape(3, 2, 4)
    assert (infer.as_rgb(x.tobytes(), 2, 4, channels_first=True) == x.transpose(1, 2, 0)).all()
    m = spark.createDataFrame([(1, 2, bytes([1, 9, 9, 2, 9, 9])), (1, 2, bytes([3, 4])), (1, 2, None)], "h int, w int, mask binary")
    assert [r.mask and bytes(r.mask) for r in tileops.first_channel(m).collect()] == [b"\x01\x02", b"\x03\x04", None]


def test_coordinates_come_back(spark):
    rows = [("a", 1, 0, 5, 4, 9), ("a", 0, 0, 0, 4, 5), ("b", 0, 0, 0, 2, 2)]
    df = spark.createDataFrame(rows, "slide_id string, tile_id int, row_up int, col_up int, row_low int, col_low int")
    assert sorted(map(tuple, tiff.read_coordinates(tiff.coordinates_npy(df)).collect())) == sorted(rows)


def test_scenes_meet_positions_by_their_order(spark):
    scenes = spark.createDataFrame([("a", 3), ("a", 7), ("a", 9), ("b", 0)], "slide string, ordinal int")
    places = spark.createDataFrame([("a", 1, 4e-6, 2e-6, 1e-6), ("a", 2, 1e-6, 9e-6, 1e-6)], "slide string, ordinal int, pos_x double, pos_y double, scale_x double")
    got = {(r.slide, r.ordinal): (r.x0, r.y0) for r in mosaic.with_positions(scenes, places).collect()}
    assert got == {("a", 3): (3, 0), ("a", 7): (0, 7), ("a", 9): (None, None), ("b", 0): (None, None)}


def test_command_line(spark, tmp_path, capsys):
    tiles = spark.createDataFrame(slide_tiles(), TILES)
    tiles.write.parquet(str(tmp_path / "tiles"))
    spark.createDataFrame([("a", 16, 16)], "slide string, small_h int, small_w int").write.parquet(str(tmp_path / "sizes"))
    (tmp_path / "c.ini").write_text("[DEFAULT]\nPIX_1MM = 40\nBLOCK = 16\n[tiling]\nX = 1\n")
    main(["run", "--tiles", str(tmp_path / "tiles"), "--out", str(tmp_path / "out"), "--config", str(tmp_path / "c.ini"), "--sizes", str(tmp_path / "sizes")])
    assert spark.read.parquet(str(tmp_path / "out/report")).first().code == "OK" and (tmp_path / "out/files/heatmap/a.nii").exists()
    (tmp_path / "p.json").write_text(json.dumps({"segmenter": "tilewright.segmenters:bright", "frg_class": 9}))
    main(["predict", "--tiles", str(tmp_path / "tiles"), "--out", str(tmp_path / "pred"), "--config", str(tmp_path / "p.json")])
    got = spark.read.parquet(str(tmp_path / "pred")).collect()
    assert len(got) == 4 and {v for r in got for v in r.pred} == {0, 9}
    main(["tile", "--images", str(tmp_path / "out/files/colormap"), "--out", str(tmp_path / "cut"), "--tile-px", "8"])
    assert spark.read.parquet(str(tmp_path / "cut")).count() == 4
    main(["inspect", "--images", str(tmp_path / "out/files")])
    assert "uint8" in capsys.readouterr().out
