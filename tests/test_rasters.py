"""Raster operators against plain numpy, and their edge cases."""

import struct

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tilewright.functions import geometry, naming
from tilewright.operators import canvas, density, infer, mask, metrics, mosaic, render, runlog, tileops, tiling
from tilewright.plans import slides
from tilewright.sources import config, discovery, rasters, tiff
from tilewright.streaming.ingest import stream_blocks


def tile(h, w, seed, npix):
    rng = np.random.default_rng(seed)
    rgb = rng.integers(0, 256, (h, w, 3), np.uint8) * (rng.random((h, w, 1)) < 0.7)
    m = rng.choice(np.array([0, 254, 255], np.uint8), (h, w), p=[0.1, 0.1, 0.8])
    return rgb.astype(np.uint8), m, rng.choice(np.array([0, 255], np.uint8), (h, w))


def brute(rgb, m, p, npix, wrap=False):
    rgb = rgb.astype(int).copy()
    rgb[m < 255] = 0
    s = rgb.sum(axis=2)
    p = np.where(s > 0, p, 0)
    nr, nc, out = round(len(s) / npix), round(s.shape[1] / npix), {}
    for r in range(nr):
        for c in range(nc):
            at = np.s_[r * npix : None if r == nr - 1 else (r + 1) * npix, c * npix : None if c == nc - 1 else (c + 1) * npix]
            t = np.count_nonzero((s[at] & 255) if wrap else s[at])
            n = np.count_nonzero(p[at])
            out[r, c] = (n, t, 100 * n / t if t else 0.0)
    return out


@pytest.mark.parametrize("wrap", [False, True])
def test_tile_density(spark, wrap):
    shapes = [(9, 9), (10, 11), (4, 20), (5, 5), (2, 30), (25, 24)]
    made = [tile(h, w, i, 5) for i, (h, w) in enumerate(shapes)]
    made[0][0][0, 0] = (128, 64, 64)
    rows = [(1, i, h, w, a.tobytes(), b.tobytes(), c.tobytes()) for i, ((h, w), (a, b, c)) in enumerate(zip(shapes, made, strict=True))]
    df = spark.createDataFrame(rows, "slide int, tile int, h int, w int, rgb binary, mask binary, pred binary")
    got = {(r.tile, r.br, r.bc): (r.n_pred, r.n_tissue, r.pct) for r in density.tile_density(df, 5, wrap=wrap).collect()}
    want = {(i, *k): v for i, t in enumerate(made) for k, v in brute(*t, 5, wrap).items()}
    assert got == want
    px = [(1, i, h, w, r, c, *map(int, a[r, c]), int(b[r, c]), int(p[r, c])) for i, ((h, w), (a, b, p)) in enumerate(zip(shapes, made, strict=True)) for r in range(h) for c in range(w)]
    px = spark.createDataFrame(px, "slide int, tile int, h int, w int, r int, c int, red int, green int, blue int, mask int, pred int")
    both = density.density(mask.clean(mask.segment(px)), 5, wrap=wrap)
    assert {(r.tile, r.br, r.bc): (r.n_pred, r.n_tissue, r.pct) for r in both.collect()} == want


def test_missing_prediction_and_no_tiles(spark):
    schema = "slide int, tile int, h int, w int, rgb binary, mask binary, pred binary"
    a, b, _ = tile(6, 6, 1, 3)
    df = spark.createDataFrame([(1, 0, 6, 6, a.tobytes(), b.tobytes(), None)], schema)
    assert {r.pct for r in density.tile_density(df, 3).collect()} == {0.0}
    assert density.tile_density(spark.createDataFrame([], schema), 3).count() == 0


def test_half_blocks(spark):
    got = spark.range(1).select(*[geometry.block_count(F.lit(n), 289).alias(f"n{n}") for n in (144, 145)], geometry.block_count(F.lit(25), 10).alias("even")).first()
    assert tuple(got) == (0, 1, 2)


def test_grid_covers(spark):
    rows = [(i, h, w) for i, (h, w) in enumerate([(1, 1), (2890, 2891), (10000, 1), (7, 123456)])] + [(9, 0, 5)]
    slides = tiling.grid(spark.createDataFrame(rows, "slide_id int, h int, w int"))
    got = tiling.sanity(slides, tiling.coordinates(slides)).collect()
    assert len(got) == 4 and all(r.ok for r in got)
    near = {r.tile_id: r for r in tiling.adjacency(slides.filter("slide_id = 1")).collect()}
    assert (near[0].north, near[0].south, near[0].east, near[0].west) == (None, None, 1, None)


@pytest.mark.parametrize("radius", [1, 2])
def test_erosion(spark, radius):
    rng = np.random.default_rng(radius)
    m = (rng.random((12, 15)) < 0.85) * rng.integers(1, 256, (12, 15))
    df = spark.createDataFrame([(1, r, c, int(m[r, c])) for r in range(12) for c in range(15)], "slide int, r int, c int, mask int")
    pad = np.pad(m > 0, radius)
    keep = np.all([pad[radius + y : radius + y + 12, radius + x : radius + x + 15] for y, x in mask.disk(radius)], axis=0)
    got = np.zeros_like(m)
    for r in mask.erode(df, ["slide"], radius).collect():
        got[r.r, r.c] = r["mask"]
    assert (got == np.where(keep, m, 0)).all()
    assert mask.erosion_radius(5) == 1 and mask.erosion_radius(50) == 5


def test_reduced_equals_sampling(spark):
    rng = np.random.default_rng(3)
    pct = rng.random((2, 3)) * 100
    blocks = spark.createDataFrame([(1, 0, r, c, float(pct[r, c])) for r in range(2) for c in range(3)], "slide int, tile int, br int, bc int, pct double")
    tiles = spark.createDataFrame([(1, 0, 11, 14, 4, 5), (1, 1, 11, 14, 4, 5)], "slide int, tile int, h int, w int, out_h int, out_w int")
    full = pct[np.minimum(np.arange(11) // 5, 1)][:, np.minimum(np.arange(14) // 5, 2)]
    want = full[np.floor((np.arange(4) + 0.5) * 11 / 4).astype(int)][:, np.floor((np.arange(5) + 0.5) * 14 / 5).astype(int)]
    got = render.reduced(tiles, blocks, 5).collect()
    assert all(abs(r.value - (1000 * want[r.r, r.c] if r.tile == 0 else 0)) < 1e-9 for r in got) and len(got) == 40


def test_verify_and_gray(spark):
    rows = [(1, 0.0), (1, 0.0), (2, 100_000.0), (2, 0.0), (3, 100_000.1)]
    df = spark.createDataFrame(rows, "slide int, value double")
    assert {r.slide: r.code for r in render.verify(df).collect()} == {1: "STAGE3_VERIFY_FAILED", 2: "OK", 3: "STAGE3_ABNORMAL"}
    rng = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 100.0)], "slide int, min_pct double, max_pct double")
    assert sorted((r.slide, r.gray) for r in render.gray(df, rng).collect()) == [(1, 0), (1, 0), (2, 0), (2, 255)]


def test_names(spark):
    names = ["3063_22_#42_Iron_BS", "3063_22_#42_BS-Iron", "1_2_#3_mfg_cp13_x", "nocase", "7_8_PUT_Amyloid"]
    n = F.col("n")
    got = spark.createDataFrame([(x,) for x in names], "n string").select("n", naming.case_id(n), naming.stain(n), naming.region(n), naming.ordered(n)).collect()
    assert [tuple(r)[1:] for r in got] == [
        ("3063_22", "iron", "bs", "3063_22_#42_BS_Iron"), ("3063_22", "iron", "bs", "3063_22_#42_BS-Iron"), ("1_2", "tau", "mfg", "1_2_#3_mfg_cp13_x"), (None, None, None, "nocase"),
        ("7_8", "amyloid", "put", "7_8_PUT_Amyloid"),
    ]


def test_inference_pads_and_reports(spark):
    a, _, _ = tile(33, 40, 5, 5)
    rows = [(1, 0, 33, 40, a.tobytes()), (1, 1, 33, 40, b"short"), (1, 2, 1, 1, bytes([255] * 3))]
    got = {r.tile: r for r in infer.infer(spark.createDataFrame(rows, "slide int, tile int, h int, w int, rgb binary"), lambda: infer.bright).collect()}
    want = np.where(a.astype(np.float32).transpose(2, 0, 1).__truediv__(255).mean(axis=0) > 0.5, 255, 0)
    assert bytes(got[0].pred) == want.astype(np.uint8).tobytes()
    assert got[1].pred is None and "ValueError" in got[1].error and bytes(got[2].pred) == b"\xff"
    same = infer.softmax_argmax(spark.createDataFrame([([1.0, 1.0],)], "logits array<double>")).first()
    assert same.cls == 0 and same.probs == [0.5, 0.5]


def test_metrics_nulls(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (-1, 1), (None, 0), (1, None)], "t int, p int")
    m = metrics.confusion(df, "t", "p")
    assert {(r.truth, r.pred): r.n for r in m.collect()} == {(1, 1): 1, (0, 1): 1}
    assert metrics.segmentation_metrics(m.filter("false")).first().iou is None


def test_mosaic_order(spark):
    df = spark.createDataFrame([(1, 0, 0, 0, 5), (1, 1, 0, 0, 0), (1, 0, 0, 1, 0)], "slide int, scene int, y int, x int, v int")
    assert sorted((r.x, r.v) for r in mosaic.mosaic(df).collect()) == [(0, 5), (1, 0)]
    assert sorted((r.x, r.v) for r in mosaic.stitch(df).collect()) == [(0, 0), (1, 0)]


def test_status(spark):
    df = spark.createDataFrame([("a", "OK", 1, 1), ("a", "STAGE1_FAILED", 1, 2), ("b", "STAGE3_ABNORMAL", 5, 3)], "slide string, code string, ts int, seq int")
    assert {r.slide: r.code for r in runlog.latest(df).collect()} == {"a": "STAGE1_FAILED", "b": "STAGE3_ABNORMAL"}


def test_files(spark, tmp_path):
    data = np.arange(6, dtype=float).reshape(2, 3)
    raw = rasters.nifti(data, (0.5, 0.25, 2.0))
    assert struct.unpack_from("<i", raw)[0] == 348 and raw[344:347] == b"n+1" and struct.unpack_from("<3h", raw, 40) == (2, 2, 3)
    assert (np.frombuffer(raw, "<f8", offset=352).reshape(2, 3, order="F") == data).all()
    tags = [(256, 4, 7), (257, 3, 5), (258, 3, 8), (259, 3, 1), (277, 3, 3)]
    tif = b"II" + struct.pack("<HI", 42, 8) + struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", t, k, 1, v) for t, k, v in tags) + struct.pack("<I", 0)
    (tmp_path / "a.tif").write_bytes(tif)
    (tmp_path / "b.tiff").write_bytes(b"nothing")
    got = {r.path[-5:]: r for r in tiff.inspect_tiffs(spark, str(tmp_path)).collect()}
    assert (got["a.tif"].width, got["a.tif"].height, got["a.tif"].channels, got["a.tif"].pages) == (7, 5, 3, 1) and got[".tiff"].error
    (tmp_path / "list.txt").write_text("a\n\n b \n")
    assert [r.slide for r in rasters.slide_list(spark, str(tmp_path / "list.txt")).collect()] == ["a", "b"]
    assert rasters.discover(spark, str(tmp_path), "*.tif").count() == 1


@pytest.mark.parametrize("radius", [1, 3])
def test_tile_erosion_crosses_borders(spark, radius):
    r = np.random.default_rng(radius)
    whole = (r.random((23, 31)) > 0.04).astype(np.uint8) * r.integers(1, 255, (23, 31)).astype(np.uint8)
    ys, xs = [0, 8, 16, 23], [0, 10, 20, 31]
    rows = [(1, i * 3 + j, i, j, ys[i + 1] - ys[i], xs[j + 1] - xs[j], whole[ys[i] : ys[i + 1], xs[j] : xs[j + 1]].tobytes()) for i in range(3) for j in range(3)]
    got = tileops.erode_tiles(spark.createDataFrame(rows, "slide int, tile int, gr int, gc int, h int, w int, mask binary"), radius).collect()
    out = np.zeros_like(whole)
    for t in got:
        out[ys[t.gr] : ys[t.gr] + t.h, xs[t.gc] : xs[t.gc] + t.w] = np.frombuffer(t.mask, np.uint8).reshape(t.h, t.w)
    padded = np.pad(whole, radius)
    want = whole.copy()
    for y in range(23):
        for x in range(31):
            if any(padded[y + radius + dy, x + radius + dx] == 0 for dy, dx in mask.disk(radius)):
                want[y, x] = 0
    assert len(got) == 9 and (out == want).all() and want.any()


def test_window_of_a_slide_mask(spark):
    m = np.arange(12, dtype=np.uint8).reshape(3, 4)
    rows = [(3, 5, m.tobytes(), 3, 4, 2, 6, 9, 14), (3, 5, None, 3, 4, 2, 6, 9, 14)]
    df = spark.createDataFrame(rows, "h int, w int, mask binary, mask_h int, mask_w int, row_up int, col_up int, full_h int, full_w int")
    got = [x.mask for x in tileops.sample_mask(df).collect()]
    full = m[np.minimum((np.arange(9) + 0.5) * 3 / 9, 2).astype(int)][:, np.minimum((np.arange(14) + 0.5) * 4 / 14, 3).astype(int)]
    assert got[1] is None and (np.frombuffer(got[0], np.uint8).reshape(3, 5) == full[2:5, 6:11]).all()


@pytest.mark.parametrize("mode", canvas.MODES)
def test_paste(spark, mode):
    r = np.random.default_rng(5)
    parts = [(1, k, int(r.integers(-4, 30)), int(r.integers(-4, 30)), 5, 7, (r.integers(0, 4, (5, 7)) * 60).astype(np.uint8).tobytes()) for k in range(40)]
    df = spark.createDataFrame(parts, "slide int, seq long, y0 int, x0 int, h int, w int, pixels binary").repartition(5)
    want = np.zeros((40, 40), np.uint8)
    for _, _, y0, x0, h, w, px in parts:
        for y, x in np.ndindex(h, w):
            v = px[y * w + x]
            if y0 + y >= 0 and x0 + x >= 0 and (mode == "last" or v > (want[y0 + y, x0 + x] if mode == "max" else 0)):
                want[y0 + y, x0 + x] = v
    out = np.zeros((40, 40), np.uint8)
    for b in canvas.paste(df, 8, mode).collect():
        out[b.by * 8 : b.by * 8 + 8, b.bx * 8 : b.bx * 8 + 8] = np.frombuffer(b.pixels, np.uint8).reshape(8, 8)
    assert (out == want).all() and canvas.paste(df.filter("false"), 8, mode).count() == 0


def test_tiff_files(spark, tmp_path):
    r = np.random.default_rng(6)
    images = [(f"s/{k}.tif", h, w, c, r.integers(0, 256, h * w * c).astype(np.uint8).tobytes()) for k, (h, w, c) in enumerate([(1, 1, 1), (5, 7, 3), (4, 3, 4), (9, 2, 1)])]
    df = spark.createDataFrame(images + [("s/bad.tif", 2, 2, 3, b"abc")], "name string, h int, w int, channels int, pixels binary")
    log = {x.name: x for x in tiff.write_tiffs(df, f"file://{tmp_path}").collect()}
    assert log["s/bad.tif"].error and not (tmp_path / "s/bad.tif").exists()
    (tmp_path / "s/none.tiff").write_bytes(b"nothing")
    got = {x.path.rsplit("/", 1)[1]: x for x in tiff.read_tiffs(spark, f"file://{tmp_path}").collect()}
    assert got["none.tiff"].error
    for name, h, w, c, px in images:
        x = got[name[2:]]
        assert (x.h, x.w, x.channels, bytes(x.pixels), x.error) == (h, w, c, px, None)
        big = tiff.encode(px, h, w, c, big=True, description="a micro µ")
        form, pages = tiff.pages_of(lambda at, n, big=big: big[at : at + n])
        assert form["big"] and len(pages) == 1 and tiff.decode(lambda at, n, big=big: big[at : at + n]) == (h, w, c, px)
    two = tiff.encode(b"a", 1, 1, 1)
    at = struct.unpack_from("<I", two, 4)[0]
    linked = two[:-4] + struct.pack("<I", at)  # a directory that points at itself ends the walk
    assert len(tiff.pages_of(lambda a, n: linked[a : a + n])[1]) == 1
    coords = spark.createDataFrame([(1, 1, 0, 5, 4, 9), (1, 0, 0, 0, 4, 5)], "slide_id int, tile_id int, row_up int, col_up int, row_low int, col_low int")
    (tmp_path / "c.npy").write_bytes(tiff.coordinates_npy(coords).first().npy)
    assert np.load(tmp_path / "c.npy").tolist() == [[0, 0, 4, 5], [0, 5, 4, 9]]


def test_channels_and_stats(spark):
    rows = [(1, 0, 2, 2, bytes([255] * 4)), (1, 1, 2, 2, bytes([255] * 16)), (1, 2, 2, 2, b"abc"), (1, 3, 2, 2, bytes([0] * 12))]
    df = spark.createDataFrame(rows, "slide int, tile int, h int, w int, rgb binary")
    got = infer.infer(df.filter("tile < 3"), lambda: infer.bright)
    s = infer.infer_stats(df, got).first()
    assert (s.processed, s.skipped, s.errors) == (2, 1, 1) and "3 bytes" in s.first_error
    x = np.arange(12, dtype=np.uint8)
    assert (infer.as_rgb(x.tobytes(), 2, 2, True) == x.reshape(3, 2, 2).transpose(1, 2, 0)).all()


def test_slides_pass_their_gates(spark):
    a, b, c = tile(6, 6, 1, 3)
    other = lambda m, p: (m if m is None else m.tobytes(), p if p is None else p.tobytes())
    rows = [(s, t, 6, 6, a.tobytes(), *other(m, p), 3, 3) for s, t, m, p in [(1, 0, b, c), (1, 1, b, c), (2, 0, None, None), (3, 0, b, None), (4, 0, b, c[:2]), (5, 0, b, c)]]
    tiles = spark.createDataFrame(rows, "slide int, tile int, h int, w int, rgb binary, mask binary, pred binary, out_h int, out_w int")
    wanted = spark.createDataFrame([(1, 2), (2, 1), (3, 1), (4, 1), (5, 2), (6, 1)], "slide int, n_tiles long")
    state = slides.run_stages({"tiles": tiles, "slides": wanted}, settings=config.Settings(pix_1mm=30))
    got = {r.slide: r for r in state["report"].collect()}
    codes = {1: ("OK", "STAGE3_ABNORMAL"), 2: ("STAGE1_EMPTY",), 3: ("STAGE2_EMPTY",), 4: ("STAGE2_EMPTY",), 5: ("TILEMASKER_LOG_MISSING",), 6: ("DIR_NOT_FOUND",)}
    assert all(got[s].code in c for s, c in codes.items()) and got[4].n_errors == 1
    model = [*slides.STAGES[:1], slides.prediction(lambda: infer.bright), *slides.STAGES[2:]]
    assert slides.run_stages({"tiles": tiles, "slides": wanted}, model, config.Settings(pix_1mm=30))["report"].filter("slide = 3").first().n_pred == 1
    assert set(slides.run_stages({"tiles": tiles}, only=["masking"])) == {"tiles", "masked"}


def test_discovery(spark):
    paths = ["/d/a/heatmap/seg_tiles/t.tif", "/d/a/magick_tmp/x", "/d/b/RES(1)/tiles/tiling_info.xml", "/d/b/RES(0)/tiles/other", "/d/b/RES1/q_000000.tif"]
    f = spark.createDataFrame([(p,) for p in paths], "path string")
    assert sorted(r.slide_dir for r in discovery.slice_dirs(f, "/d").collect()) == ["/d/a", "/d/b"]
    assert [r.slide_dir for r in discovery.slice_dirs(f, "/d/a").collect()] == ["/d/a"]
    assert discovery.tiling_infos(f).first() == ("/d/b", paths[2]) and discovery.iron_images(f).first().path == paths[4]
    t = spark.createDataFrame([(1, 0), (1, 1), (1, 2)], "slide int, tile int")
    p, i = (spark.createDataFrame(x, "slide int, tile int, path string") for x in ([(1, 0, "p0")], [(1, 0, "i0"), (1, 1, "i1")]))
    assert sorted(map(tuple, discovery.tile_sources(t, p, i).collect())) == [(1, 0, "p0", "prediction"), (1, 1, "i1", "image"), (1, 2, None, "none")]


def test_settings():
    s = config.from_ini("[global]\nPIX_1MM=2890\n[tile_masking]\nEROSION_PIXELS = 50\n[heat_map]\nEROSION_PIXELS=9\nHMAP_RES=0.1\n")
    assert (s.npix, s.erosion_pixels, s.heatmap_erosion_pixels) == (289, 50, 9)
    assert config.from_json('{"mask_val": 200, "other": 1}', {"scale_factor": 5}).mask_val == 200


def test_streaming(spark, tmp_path):
    a, b, c = tile(6, 6, 1, 3)
    row = lambda i: [(1, i, 6, 6, a.tobytes(), b.tobytes(), c.tobytes())]
    schema = "slide int, tile long, h int, w int, rgb binary, mask binary, pred binary"
    for i in range(2):
        spark.createDataFrame(row(i), schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream_blocks(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"), 3).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 8 and got.select("tile").distinct().count() == 2 and isinstance(got.toPandas(), pd.DataFrame)
