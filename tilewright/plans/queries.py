"""The registered queries of the raster operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import naming
from ..operators import canvas, infer, mask, maskwindows, metrics, mosaic, reduction, regions, render, runlog, scenes, sliding, tileops, tiling
from ..operators import density as dn
from ..sources import discovery, metadata, slidefiles, tiff, windows
from ..sources.config import Settings
from ..sources.shared import shared_dir
from . import slides as sp
from . import views as v

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _r(*names: str, digits: int = 6):
    return [F.round(n, digits).alias(n) for n in names]


def _cleaned(spark, d):
    return mask.clean(mask.segment(v.pixels(spark, d)))


def _blocks(spark, d, wrap=False):
    return dn.density(_cleaned(spark, d), v.NPIX, wrap)


def _grid(spark, d):
    return tiling.grid(v.slides(spark, d))


def _heat(spark, d):
    return render.reduced(v.tile_sizes(spark, d), _blocks(spark, d), v.NPIX)


@query
def q_tile_grid(spark, d):
    return _grid(spark, d).select("slide_id", "h", "w", "grid_rows", "grid_cols")


@query
def q_tile_coords(spark, d):
    return tiling.coordinates(_grid(spark, d))


@query
def q_coord_sanity(spark, d):
    return tiling.sanity(_grid(spark, d), tiling.coordinates(_grid(spark, d)))


@query
def q_adjacency(spark, d):
    return tiling.adjacency(_grid(spark, d))


@query
def q_adjacency_compat(spark, d):
    return tiling.adjacency(_grid(spark, d), wrap=True)


@query
def q_seg_tile(spark, d):
    return mask.segment(v.pixels(spark, d)).select("slide", "tile", "r", "c", "red", "green", "blue")


@query
def q_clean_pred(spark, d):
    return _cleaned(spark, d).select("slide", "tile", "r", "c", "pred", "removed")


@query
def q_clean_stats(spark, d):
    return mask.clean_stats(v.tile_sizes(spark, d).select("slide", "tile"), _cleaned(spark, d))


@query
def q_tile_mask_join(spark, d):
    """Images of all tiles, masks of those with tissue."""
    tissue = v.pixels(spark, d).filter("mask = 255").select("slide", "tile").distinct()
    return mask.join_status(v.tile_sizes(spark, d).select("slide", "tile"), tissue)


@query
def q_block_density(spark, d):
    return _blocks(spark, d).select("slide", "tile", "br", "bc", "n_pred", "n_tissue", *_r("pct"))


@query
def q_block_density_wrap(spark, d):
    return _blocks(spark, d, wrap=True).select("slide", "tile", "br", "bc", "n_pred", "n_tissue", *_r("pct"))


@query
def q_block_density_tiles(spark, d):
    return dn.tile_density(v.tiles(spark, d), v.NPIX).select("slide", "tile", "br", "bc", "n_pred", "n_tissue", *_r("pct"))


@query
def q_slide_minmax(spark, d):
    return dn.slide_range(_blocks(spark, d)).select("slide", *_r("min_pct", "max_pct"))


@query
def q_res10(spark, d):
    return _heat(spark, d).select("slide", "tile", "r", "c", *_r("value"))


@query
def q_colormap(spark, d):
    return render.gray(_heat(spark, d), dn.slide_range(_blocks(spark, d))).select("slide", "tile", "r", "c", "gray")


@query
def q_verify(spark, d):
    return render.verify(_heat(spark, d)).select("slide", *_r("max_value"), "n_nonzero", *_r("pct_nonzero"), "code")


@query
def q_erode_mask(spark, d):
    px = v.pixels(spark, d).select("slide", "tile", "r", "c", "mask")
    return mask.erode(px, ["slide", "tile"], mask.erosion_radius(10)).select("slide", "tile", "r", "c", "mask")


def _heat_tiles(spark, d):
    places = {"small_up": F.expr("cast(tile div 20 * 4 as int)"), "small_left": F.expr("cast(tile % 20 * 4 as int)")}
    return render.heat_tiles(v.tile_sizes(spark, d).withColumns(places), dn.tile_density(v.tiles(spark, d), v.NPIX), v.NPIX)


@query
def q_heatmap_erode(spark, d):
    """Heatmaps eroded over whole slides, so disks cross the tiles' borders."""
    heat = _heat_tiles(spark, d)
    eroded = render.erode_heat(heat, canvas.paste(v.tissue_parts(spark, d), 32, "last"), 32, 1)
    both = render.heat_pixels(heat).join(render.heat_pixels(eroded).withColumnRenamed("value", "value_eroded"), ["slide", "tile", "r", "c"])
    return both.select("slide", "tile", "r", "c", *_r("value", "value_eroded"))


@query
def q_res10_tiles(spark, d):
    """q_res10, a row a tile."""
    return render.heat_pixels(_heat_tiles(spark, d)).select("slide", "tile", "r", "c", *_r("value"))


@query
def q_z_projection(spark, d):
    return mosaic.max_projection(v.z_samples(spark, d), ["slide", "y", "x"])


@query
def q_axis_projection(spark, d):
    return mosaic.max_projection(v.z_samples(spark, d).withColumn("channel", F.col("z") % 3), ["slide", "channel", "y", "x"])


@query
def q_mosaic_last_wins(spark, d):
    return mosaic.mosaic(v.scenes(spark, d))


@query
def q_stitch_paste(spark, d):
    return mosaic.stitch(v.scenes(spark, d))


@query
def q_canvas_extent(spark, d):
    s = v.table(spark, d, "lineitem").select(
        (F.col("l_suppkey") % 5).alias("slide"), (F.col("l_partkey") / 4.0e6).alias("pos_x"), (F.col("l_orderkey") / 4.0e6).alias("pos_y"), F.lit(2.5e-7).alias("scale_x"),
        F.lit(64).alias("h"), F.lit(48).alias("w"), F.lit(3).alias("channels"),
    )
    return mosaic.canvas(mosaic.positions(s))


@query
def q_softmax_argmax(spark, d):
    s = infer.softmax_argmax(v.logits(spark, d))
    return s.select("slide", "tile", "i", F.round(F.col("probs")[0], 6).alias("p0"), F.round(F.col("probs")[1], 6).alias("p1"), "cls")


@query
def q_tile_inference(spark, d):
    got = infer.infer(v.tiles(spark, d), lambda: infer.bright)
    n = F.length(F.regexp_replace(F.hex("pred"), "0", "")) / 2
    return got.select("slide", "tile", n.cast("int").alias("n_positive"), F.octet_length("pred").alias("n_bytes"))


@query
def q_tta_mean(spark, d):
    px = v.pixels(spark, d).select("slide", "tile", "r", "c", F.col("h").alias("n"), "x")
    p = infer.augment(px).withColumn("p", 1 / (1 + F.exp(-(F.col("x") + 0.01 * F.col("ar") - 0.02 * F.col("ac")))))
    return infer.tta_mean(p, ["slide", "tile"]).select("slide", "tile", "r", "c", *_r("p"), "cls")


@query
def q_preprocess(spark, d):
    return infer.unit_channels(v.pixels(spark, d)).select("slide", "tile", "r", "c", *_r("red", "green", "blue"))


@query
def q_confusion(spark, d):
    return metrics.confusion(v.table(spark, d, "labels"), "toxic", "quality")


@query
def q_seg_metrics(spark, d):
    m = metrics.segmentation_metrics(metrics.confusion(v.table(spark, d, "labels"), "toxic", "quality"))
    return m.select(*_r("accuracy", "precision", "recall", "iou", "dice"))


@query
def q_iou_per_class(spark, d):
    return metrics.iou_per_class(metrics.confusion(v.table(spark, d, "labels"), "toxic", "quality")).select("cls", *_r("iou"))


def _losses(spark, d):
    s = infer.softmax_argmax(v.logits(spark, d)).withColumn("p1", F.col("probs")[1]).withColumn("weight", 1.0 + F.col("i") % 4)
    return metrics.losses(s, ["slide"], (0.3, 0.7))


@query
def q_focal_loss(spark, d):
    return _losses(spark, d).select("slide", *_r("focal"))


@query
def q_tversky_loss(spark, d):
    return _losses(spark, d).select("slide", *_r("tversky", "loss"))


@query
def q_dynamic_scale(spark, d):
    s = metrics.dynamic_scale(v.pixels(spark, d), ["slide", "tile"], "x")
    return s.select("slide", "tile", "r", "c", *_r("scaled"))


@query
def q_pad_shape(spark, d):
    s = v.slides(spark, d)
    return s.select("slide_id", g.padded(F.col("h")).alias("pad_h"), g.padded(F.col("w")).alias("pad_w"))


@query
def q_case_id(spark, d):
    return v.slides(spark, d).select("name", naming.case_id(F.col("name")).alias("case_id"))


@query
def q_stain_classify(spark, d):
    return v.slides(spark, d).select("name", naming.stain(F.col("name")).alias("stain"), naming.region(F.col("name")).alias("region"))


@query
def q_roi_swap(spark, d):
    return v.slides(spark, d).select("name", naming.ordered(F.col("name")).alias("ordered"))


@query
def q_tile_name(spark, d):
    t = v.tile_sizes(spark, d).select("tile", naming.tile_name(F.col("tile")).alias("file"), naming.tile_name(F.col("tile"), mask=True).alias("mask_file"))
    return t.withColumn("number", naming.tile_number(F.col("mask_file")))


@query
def q_ascii(spark, d):
    s = F.concat("p_name", F.lit(" 5 µm é "), F.col("p_size").cast("string"))
    return v.table(spark, d, "part").select("p_partkey", naming.ascii_only(s).alias("label"))


@query
def q_pattern_filter(spark, d):
    s = v.slides(spark, d).select("name")
    return s.filter(naming.matches_any(F.col("name"), ["_#7_", "CP13_BS", "3_22"]))


@query
def q_name_exclusions(spark, d):
    s = v.slides(spark, d).select(F.concat("name", F.element_at(F.array(*map(F.lit, ("_res10.tiff", "_brain_mask.tif", "_WM_mask.tif", "_mask.tif"))), (F.col("slide_id") % 4 + 1).cast("int"))).alias("file"))
    return s.filter(~naming.excluded(F.col("file")))


@query
def q_last_mask(spark, d):
    s = v.slides(spark, d).select(naming.stain(F.col("name")).alias("stain"), "name", "slide_id")
    return s.groupBy("stain").agg(F.max_by("name", "slide_id").alias("last_file"), F.min_by("name", "slide_id").alias("first_file"))


def _counts(spark, d):
    n = F.col("grid_rows") * F.col("grid_cols")
    s = _grid(spark, d)
    return s.select(
        "slide_id", (F.col("slide_id") % 19 != 0).alias("dir_exists"),
        F.when(F.col("slide_id") % 17 == 0, None).when(F.col("slide_id") % 13 == 0, 0).otherwise(n).alias("n_seg"), (F.col("slide_id") % 11 != 0).alias("masker_log"),
        F.when(F.col("p_size") == 1, None).when(F.col("p_size") == 2, 0).otherwise(n).alias("n_pred"),
        F.when(F.col("p_size") != 3, F.col("p_retailprice") * 60).alias("max_value"), (F.col("p_size") % 7).alias("n_nonzero"),
    )


@query
def q_failure_codes(spark, d):
    return _counts(spark, d).select("slide_id", runlog.failure_code().alias("code"), runlog.status(runlog.failure_code()).alias("status"))


@query
def q_latest_status(spark, d):
    return runlog.latest(v.run_events(spark, d))


@query
def q_results_by_stain(spark, d):
    return runlog.results_by(v.run_events(spark, d), "stain")


@query
def q_stage_timing(spark, d):
    return runlog.stage_timing(v.run_events(spark, d))


@query
def q_resume_pending(spark, d):
    o = v.table(spark, d, "orders").select(F.col("o_custkey").alias("slide"), F.col("o_orderkey").alias("tile"))
    done = v.table(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("tile"))
    return runlog.pending(o, done, ["tile"])


@query
def q_ready_slides(spark, d):
    c = v.table(spark, d, "customer").select(F.col("c_custkey").alias("slide"))
    return runlog.present(c, v.table(spark, d, "orders").select(F.col("o_custkey").alias("slide")), "slide")


@query
def q_grid_fallback(spark, d):
    s = v.slides(spark, d)
    stored = tiling.grid(s).filter("p_size > 30").select(
        "slide_id", F.col("grid_rows").alias("s_rows"), (F.col("grid_cols") + F.col("slide_id") % 2).cast("int").alias("s_cols"), F.col("h").alias("s_h"), (F.col("w") + F.col("slide_id") % 2).alias("s_w")
    )
    return tiling.with_stored_grid(s, stored)


@query
def q_union_sources(spark, d):
    e = v.table(spark, d, "events")
    return e.filter("event_type = 'view'").select("user_id", "event_type").unionByName(e.filter("event_type = 'click'").select("user_id", "event_type"))


@query
def q_distinct_slides(spark, d):
    return runlog.slides_of(v.run_events(spark, d))


@query
def q_top_errors(spark, d):
    return runlog.first_errors(v.run_events(spark, d), 10)


@query
def q_stain_dim(spark, d):
    s = v.slides(spark, d).select("slide_id", naming.stain(F.col("name")).alias("stain"))
    return s.withColumn("folder", naming.seg_folder(F.col("stain"))).filter("folder IS NOT NULL")


@query
def q_cleanup_report(spark, d):
    o = v.table(spark, d, "orders")
    stain = F.element_at(F.array(*map(F.lit, ("amyloid", "tau", "iron"))), (F.col("o_custkey") % 3 + 1).cast("int"))
    return runlog.would_free(o.select(stain.alias("stain"), F.col("o_custkey").alias("slide"), F.floor(F.col("o_totalprice")).alias("kb")))


@query
def q_label_map(spark, d):
    px = v.pixels(spark, d).withColumn("label", F.when(F.col("x") < -0.2, -1).otherwise(F.col("pred")))
    return metrics.label_counts(px, ["slide"])


@query
def q_mask_resize(spark, d):
    """Masks at half size, sampled for each pixel of the tile."""
    t = v.tiles(spark, d).select("slide", "tile", "h", "w", v.thinned(F.col("mask")).alias("mask"), F.lit(4).alias("mask_h"), F.lit(4).alias("mask_w"))
    return v.pixels_of(tileops.sample_mask(t), "mask")


def _slide_rows(spark, d):
    """Rows of tiles that placed() gives each slide."""
    return v.placed(spark, d).groupBy("slide").agg((F.max("gr") + 1).alias("n"))


@query
def q_mask_windows(spark, d):
    """Masks of whole slides at half size, in blocks, interpolated for each tile from the window below it."""
    n = _slide_rows(spark, d)
    t = v.placed(spark, d).join(n, "slide").select("slide", "tile", (F.col("gr") * 8).alias("row_up"), (F.col("gc") * 8).alias("col_up"), "h", "w", (F.col("n") * 8).alias("full_h"), F.lit(160).alias("full_w"))
    sizes = n.select("slide", (F.col("n") * 4).alias("mask_h"), F.lit(80).alias("mask_w"))
    got = maskwindows.tile_masks(t, canvas.paste(v.tissue_parts(spark, d), 32, "last"), sizes, 32, "bilinear")
    return v.pixels_of(got.select("slide", "tile", F.lit(8).alias("h"), F.lit(8).alias("w"), "mask"), "mask")


@query
def q_window_tiles(spark, d):
    """Whole slides written as tiled BigTIFF files, then cut by a grid that doesn't fit their tiles, each window from the bytes below it."""
    folder = f"{shared_dir(spark)}/slides-{uuid.uuid4().hex}"
    p = v.placed(spark, d)
    parts = p.select("slide", F.col("tile").alias("seq"), (F.col("gr") * 8).alias("y0"), (F.col("gc") * 8).alias("x0"), "h", "w", F.col("mask").alias("pixels"))
    blocks = canvas.paste(parts, 32, "last").join(_slide_rows(spark, d), "slide")
    name = F.concat(F.col("slide").cast("string"), F.lit("_22_#"), F.col("slide").cast("string"), F.lit(" 50%.tif"))
    slidefiles.write_slides(blocks.select(name.alias("name"), F.col("by").alias("gy"), F.col("bx").alias("gx"), (F.col("n") * 8).alias("h"), F.lit(160).alias("w"), "pixels"), folder, 32)
    got = windows.read_windows(spark, folder, 24)
    slide = F.regexp_extract("path", "([0-9]+)_22_#[0-9]+ 50%.tif$", 1).cast("int")
    return got.select(slide.alias("slide"), "tile_id", "row_up", "col_up", "h", "w", v.byte_sum(F.col("pixels")).alias("total"))


def _slide_blocks(spark, d, column, channels=1):
    """Whole slides of placed() tiles in blocks of 32, from the bytes in `column`; and their sizes."""
    p = v.placed(spark, d)
    t = p.select("slide", "tile", "gr", "gc", "h", "w").join(v.tiles(spark, d).select("slide", "tile", F.col(column).alias("pixels")), ["slide", "tile"])
    parts = t.select("slide", F.col("tile").alias("seq"), (F.col("gr") * 8).alias("y0"), (F.col("gc") * 8).alias("x0"), "h", "w", "pixels")
    return canvas.paste(parts, 32, "last", channels=channels), _slide_rows(spark, d).select("slide", (F.col("n") * 8).alias("h"), F.lit(160).alias("w"))


@query
def q_reduce_slides(spark, d):
    """Whole slides at half size by the filter that reaches across all borders."""
    blocks, sizes = _slide_blocks(spark, d, "mask")
    return v.canvas_pixels(reduction.reduce_slides(blocks, 32, sizes, 1, 0.5, 16), 16)


@query
def q_regions(spark, d):
    """The largest region of marked pixels of each slide, and its box."""
    return regions.largest_region(regions.regions(_slide_blocks(spark, d, "pred")[0], 32))


@query
def q_sliding(spark, d):
    """Pixels that overlapping windows over whole slides mark."""
    blocks, sizes = _slide_blocks(spark, d, "rgb", 3)
    got = sliding.infer_sliding(blocks, 32, sizes, lambda: infer.bright, 40)
    return v.canvas_pixels(got.select("slide", "by", "bx", F.col("pred").alias("pixels")), 32)


@query
def q_scene_planes(spark, d):
    """The bytes of each tile as a scene whose axes depend on the slide."""
    k = (F.col("slide") % 3).cast("int")
    of = lambda *x: F.element_at(F.array(*x), k + 1)
    shapes = [F.array(*map(F.lit, s)) for s in ((8, 8, 3), (3, 8, 8), (3, 4, 4, 4))]
    t = v.tiles(spark, d).select("slide", F.col("tile").alias("scene"), of(*map(F.lit, ("YX0", "ZYX", "CZYX"))).alias("axes"), of(*shapes).alias("shape"), F.col("rgb").alias("pixels"))
    got = scenes.normalise_scenes(t).select("slide", F.col("scene").alias("tile"), F.col("axes"), (F.col("c") * F.col("h")).alias("h"), "w", "pixels")
    return v.pixels_of(got, "pixels").join(got.select("slide", "tile", "axes"), ["slide", "tile"])


@query
def q_masking_applied(spark, d):
    return mask.masking_applied(v.pixels(spark, d))


@query
def q_erode_slide_tiles(spark, d):
    """Erosion over tiles placed on a grid, so disks cross the tiles' borders."""
    return v.pixels_of(tileops.erode_tiles(v.placed(spark, d), 1), "mask")


@query
def q_eroded_count(spark, d):
    t = v.placed(spark, d)
    both = t.select("slide", "tile", F.col("mask").alias("before")).join(tileops.erode_tiles(t, 1).select("slide", "tile", "mask"), ["slide", "tile"])
    return both.groupBy("slide").agg(F.sum(v.bytes_set(F.col("before")) - v.bytes_set(F.col("mask"))).alias("n_eroded"))


@query
def q_tta_tiles(spark, d):
    got = tileops.infer_turned(v.tiles(spark, d), lambda: infer.ramp)
    return v.pixels_of(got.join(v.tile_sizes(spark, d), ["slide", "tile"]), "pred").withColumnRenamed("pred", "cls")


@query
def q_scale_tiles(spark, d):
    e = v.table(spark, d, "embeddings").select(F.col("label").alias("slide"), F.col("vec_id").alias("tile"), tileops.scaled(F.col("embedding").cast("array<double>")).alias("s"))
    rows = e.select("slide", "tile", F.posexplode("s").alias("i", "scaled"))
    return rows.select("slide", "tile", F.expr("cast(i div 8 as int)").alias("r"), (F.col("i") % 8).alias("c"), *_r("scaled"))


@query
def q_shrink_tiles(spark, d):
    got = tileops.shrink(v.tiles(spark, d), 3).select("slide", "tile", F.lit(3).alias("h"), F.lit(9).alias("w"), "small")
    return v.pixels_of(got, "small")


@query
def q_cut_tiles(spark, d):
    """Each vector's raster as an image of its own, cut by a grid of 3-pixel tiles."""
    images = v.tiles(spark, d).select(F.col("tile").alias("slide_id"), "h", "w", F.col("rgb").alias("pixels"))
    at = tiling.coordinates(tiling.grid(images.select("slide_id", "h", "w"), 3)).drop("gr", "gc")
    got = tileops.cut(images.join(at, "slide_id"))
    return got.select("slide_id", "tile_id", "row_up", "col_up", F.octet_length("tile").alias("n_bytes"), v.byte_sum(F.col("tile")).alias("total"))


@query
def q_paste_max(spark, d):
    return v.canvas_pixels(canvas.paste(v.parts(spark, d), 16, "max"), 16)


@query
def q_paste_last(spark, d):
    return v.canvas_pixels(canvas.paste(v.parts(spark, d), 16, "last"), 16)


@query
def q_paste_last_set(spark, d):
    return v.canvas_pixels(canvas.paste(v.parts(spark, d), 16, "last_set"), 16)


@query
def q_infer_stats(spark, d):
    """Tiles with bright pixels only; the bytes of those without tissue are cut short, so that they fail."""
    t = v.tiles(spark, d).filter(F.hex("rgb").rlike("^(..)*?[4-9A-F].") | F.hex("mask").rlike("^0*$"))
    short = F.when(F.contains(F.hex("mask"), F.lit("FF")), F.col("rgb")).otherwise(F.expr("substring(rgb, 1, 10)"))
    got = infer.infer(t.withColumn("rgb", short), lambda: infer.bright)
    return infer.infer_stats(v.tile_sizes(spark, d), got).drop("first_error")


@query
def q_error_counts(spark, d):
    return runlog.error_counts(v.run_events(spark, d))


@query
def q_log_entries(spark, d):
    return runlog.entries(runlog.latest(v.run_events(spark, d)))


@query
def q_conversion_state(spark, d):
    o = v.table(spark, d, "orders").select(F.col("o_custkey").alias("slide"), F.when(F.col("o_orderstatus") == "F", "full").otherwise("small").alias("kind"))
    return runlog.conversion_state(v.table(spark, d, "customer").select(F.col("c_custkey").alias("slide")), o)


@query
def q_tiling_xml(spark, d):
    """Tilings written as XML and read again, for slides whose tiles are all found."""
    grid = _grid(spark, d).withColumn("home", F.concat(F.lit("/data/a&b/"), "name")).withColumn("file", F.concat("name", F.lit("<1>.tif")))
    xml = metadata.tiling_xml(grid, tiling.sanity(grid, tiling.coordinates(grid)))
    return metadata.parse_tiling(xml).drop("xml")


@query
def q_adjacency_xml(spark, d):
    xml = metadata.adjacency_xml(tiling.adjacency(_grid(spark, d)))
    t = metadata.parse_adjacency(xml).withColumn("near", F.flatten("tiles.neighbours"))
    south = F.aggregate(F.filter("near", lambda n: n["side"] == "south"), F.lit(0), lambda a, n: a + n["tile"])
    return t.select("slide_id", F.size("tiles").alias("n_tiles"), F.size("near").alias("n_neighbours"), south.alias("south_sum"))


@query
def q_ome_metadata(spark, d):
    s = v.slides(spark, d).select(
        "slide_id", (F.col("p_size") * 1e-7).alias("scale_x"), F.when(F.col("slide_id") > 50, 2.5e-7).alias("scale_y"), F.lit(0.0).alias("scale_z"), F.array(F.lit("5 µm"), "name").alias("channels")
    )
    o = metadata.ome_metadata(s)
    return o.select("slide_id", F.round("ome.PhysicalSizeX", 6).alias("x"), F.round("ome.PhysicalSizeY", 6).alias("y"), "ome.PhysicalSizeYUnit", F.col("ome.PhysicalSizeZ").alias("z"), F.array_join("ome.ChannelNames", ";").alias("channels"))


@query
def q_images_with_masks(spark, d):
    f = v.slide_files(spark, d)
    return discovery.with_masks(discovery.full_res(f), f).select("path", "mask")


@query
def q_res_dirs(spark, d):
    return discovery.res_dirs(v.slide_files(spark, d))


@query
def q_seg_tile_files(spark, d):
    return discovery.seg_tiles(v.slide_files(spark, d)).select("path", "name", "no")


@query
def q_tiff_roundtrip(spark, d):
    """Tiles written as TIFF files to the shared folder, then their headers and pixels read again."""
    folder = f"{shared_dir(spark)}/tiles-{uuid.uuid4().hex}"
    folder_name = F.concat(F.lit("3063_22_#"), F.col("slide").cast("string"), F.lit("_BS_Iron/"))
    t = v.tiles(spark, d).select(F.concat(folder_name, naming.tile_name(F.col("tile"))).alias("name"), "h", "w", F.lit(3).alias("channels"), F.col("rgb").alias("pixels"))
    tiff.write_tiffs(t, folder).write.parquet(f"{folder}-log")
    head = tiff.inspect_tiffs(spark, folder, 4).select("path", "pages", "dtype", "big")
    got = tiff.read_tiffs(spark, folder).join(head, "path")
    name = F.substring_index("path", "/", -2)
    return got.select(name.alias("name"), "h", "w", "channels", "pages", "dtype", "big", v.byte_sum(F.col("pixels")).alias("total"))


@query
def q_name_parts(spark, d):
    return v.slides(spark, d).select("name", naming.without_stain(F.col("name")).alias("plain"), naming.class_numbers(F.col("p_size"), [7, 3, 20]).alias("cls"))


def _slide_state(spark, d, settings=Settings(pix_1mm=30, block=32)):
    tiles = v.tiles(spark, d).withColumn("out_h", F.lit(4)).withColumn("out_w", F.lit(4))
    place = lambda i, n: F.expr(f"cast({i} * {n} as int)")
    tiles = tiles.withColumns({"row_up": place("(tile div 20)", 8), "col_up": place("(tile % 20)", 8), "small_up": place("(tile div 20)", 4), "small_left": place("(tile % 20)", 4)})
    # a tile without any marked pixel has no prediction
    tiles = tiles.withColumn("pred", F.when(~F.hex("pred").rlike("^0*$"), F.col("pred")))
    slides = tiles.groupBy("slide").agg(F.count("*").alias("n_tiles"))
    regions = v.table(spark, d, "region").select((-F.col("r_regionkey") - 1).cast(dict(slides.dtypes)["slide"]).alias("slide"), F.lit(1).cast("bigint").alias("n_tiles"))
    return sp.run_stages({"tiles": tiles, "slides": slides.unionByName(regions)}, settings=settings)


def _report(state):
    return state["report"].select("slide", "n_tiles", "n_seg", "n_pred", "n_errors", *_r("max_value"), "n_nonzero", "code", "status")


@query
def q_slide_pipeline(spark, d):
    """All stages; slides without tiles (one per region) fail at the first gate."""
    return _report(_slide_state(spark, d))


@query
def q_slide_pipeline_eroded(spark, d):
    """All stages with both erosions, of masks at full size and of the heatmap at reduced size."""
    return _report(_slide_state(spark, d, Settings(pix_1mm=30, block=32, erosion_pixels=1, heatmap_erosion_pixels=1)))


@query
def q_slide_colormap(spark, d):
    """Grey levels of the plan's colormap stage."""
    t = _slide_state(spark, d)["colormap"].select("slide", "tile", F.col("out_h").alias("h"), F.col("out_w").alias("w"), "gray")
    return v.pixels_of(t, "gray")


@query
def q_stage_states(spark, d):
    return runlog.stage_states(_slide_state(spark, d)["report"])
