"""Work that grows with the input alone: paths, splits, XML, tasks of small files and windows, lanes of regions."""

import numpy as np
from pyspark.sql import GroupedData
from pyspark.sql import functions as F

from tilewright.operators import regions, tiling
from tilewright.plans import views
from tilewright.sources import discovery, metadata, tiff, windows

SF = "/root/testdata/sf0.001"


def parts(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_paths_by_slashes(spark):
    folders = ["/data/a b", "/data/a\nb", "d", ""]
    ends = ["out/RES/a.tiff", "out/RES/a_res10.tiff", "mask/final_mask/y_mask.tif", "mask/final_mask/z_WM_mask.tif"]
    f = spark.createDataFrame([(f"{d}/{e}",) for d in folders for e in ends] + [("RES",), ("/RES",), ("a.tiff",), (None,)], "path string")
    got = {(r.path, r.mask) for r in discovery.with_masks(discovery.full_res(f), f).collect()}
    assert got == {(f"{d}/{ends[0]}", f"{d}/{ends[2]}") for d in folders}


def test_slides_are_spread(spark):
    s = views.slides(spark, SF)
    assert s.rdd.getNumPartitions() == parts(spark)
    assert s.select("slide_id").distinct().count() == spark.read.parquet(f"{SF}/part.parquet").count()


def test_small_windows_share_a_task(spark, tmp_path):
    (tmp_path / "a.tif").write_bytes(tiff.encode(bytes(range(256)) * 256, 256, 256, 1))
    assert len(windows.WindowReader({"path": str(tmp_path), "tile_px": "8"}).partitions()) == 1
    got = windows.read_windows(spark, str(tmp_path), 8)
    assert got.count() == 1024 and got.filter("error is not null").count() == 0


def test_tiling_is_parsed_once_a_row(spark):
    s = spark.createDataFrame([(1, 10, 20, 2, 3, " /a&b/ ", 'x<1> "q".tif'), (2, 1, 1, 1, 1, "", "é")], "slide_id int, h int, w int, grid_rows int, grid_cols int, home string, file string")
    got = metadata.parse_tiling(metadata.tiling_xml(s))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "xpath" not in plan
    assert sorted(map(tuple, got.select(*s.columns).collect())) == sorted(map(tuple, s.collect()))


def test_adjacency_is_parsed_once_a_row(spark):
    grid = spark.createDataFrame([(1, 1, 1), (2, 3, 4), (3, 1, 12)], "slide_id int, grid_rows int, grid_cols int")
    near = tiling.adjacency(grid)
    got = metadata.parse_adjacency(metadata.adjacency_xml(near)).select("slide_id", F.explode("tiles").alias("t"))
    same = lambda s: lambda n: n["side"] == s
    got = got.select("slide_id", F.col("t.id").alias("tile_id"), *[F.get(F.filter("t.neighbours", same(s)), F.lit(0))["tile"].alias(s) for s in metadata.SIDES])
    order = lambda rows: sorted(map(str, rows))
    assert order(tuple(r) for r in got.collect()) == order(tuple(r) for r in near.select(*got.columns).collect())


def test_small_files_share_tasks(spark, tmp_path):
    for k in range(400):
        (tmp_path / f"{k}.tif").write_bytes(tiff.encode(bytes([k % 256] * 12), 2, 2, 3))
    assert tiff._files(spark, str(tmp_path)).rdd.getNumPartitions() <= parts(spark)
    got = tiff.read_tiffs(spark, str(tmp_path)).select(views.byte_sum(F.col("pixels")).alias("n")).agg(F.count("*"), F.sum("n")).collect()[0]
    assert tuple(got) == (400, 12 * sum(k % 256 for k in range(400)))


def test_lanes_meet_without_a_group_each(spark, monkeypatch):
    """Frames of three rows cut lanes anywhere; regions stay those of one large block."""

    def refuse(*_):
        raise AssertionError("one call a lane")

    monkeypatch.setattr(GroupedData, "applyInPandas", refuse)
    mask = (np.random.default_rng(4).random((32, 32)) < 0.35).astype(np.uint8)
    small = [(1, y, x, mask[8 * y : 8 * y + 8, 8 * x : 8 * x + 8].tobytes()) for y in range(4) for x in range(4)]
    schema = "slide int, by int, bx int, pixels binary"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got, whole = (sorted(map(tuple, regions.regions(spark.createDataFrame(rows, schema), n).collect())) for rows, n in ((small, 8), ([(1, 0, 0, mask.tobytes())], 32)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == whole and len(got) > 3
