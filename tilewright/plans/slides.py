"""The whole way of slides from tiles to heatmap, colormap, check and status, as one plan of stages."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import canvas, density, distance, infer, mask, maskwindows, render, runlog, tileops
from ..sources.config import Settings
from ..sources.slidefiles import write_slides

#: Named tables that stages read and add to.
State = dict[str, DataFrame]


class Stage(NamedTuple):
    """A step of the plan: its name, and a function that returns the tables it adds to the state."""

    name: str
    run: Callable[[State, Settings], State]


def masking(state: State, settings: Settings) -> State:
    """Tiles (slide, tile, h, w, rgb, mask, out_h, out_w) that have a mask of their own size.

    With erosion_pixels in the settings, masks are eroded over whole slides. Where the
    state has masks (slide, by, bx, pixels) at small scale and their mask_sizes (slide,
    mask_h, mask_w), those are eroded by the pixels that it comes to there, and each tile
    (row_up, col_up, full_h, full_w) takes its window; otherwise the tiles' own masks are
    laid out by row_up and col_up and eroded at full size.
    """
    tiles, block = state["tiles"], settings.block
    if "masks" in state:
        small = state["masks"]
        if settings.erosion_pixels > 0:
            small = distance.erode(small, block, mask.erosion_radius(settings.erosion_pixels, settings.mask_scale))
        tiles = tiles.drop("mask").join(maskwindows.tile_masks(tiles, small, state["mask_sizes"], block), ["slide", "tile"], "left")
    if "masks" not in state:
        tiles = tileops.first_channel(tiles)
    fine = F.col("mask").isNotNull() & (F.octet_length("mask") == F.col("h") * F.col("w"))
    tiles = tiles.withColumn("mask", F.when(fine, F.col("mask")))
    if "masks" not in state and settings.erosion_pixels > 0:
        parts = tiles.filter("mask IS NOT NULL").select("slide", F.col("tile").alias("seq"), F.col("row_up").alias("y0"), F.col("col_up").alias("x0"), "h", "w", F.col("mask").alias("pixels"))
        alive = distance.erode(canvas.paste(parts, block, "last"), block, settings.erosion_pixels)
        wanted = tiles.filter("mask IS NOT NULL").select("slide", "tile", F.col("row_up").alias("up"), F.col("col_up").alias("left"), "h", "w")
        tiles = tiles.drop("mask").join(canvas.windows(alive, block, wanted).select("slide", "tile", F.col("pixels").alias("mask")), ["slide", "tile"], "left")
    return {"masked": tiles}


def prediction(load: Callable[[], infer.Segmenter] | None = None) -> Stage:
    """Predictions of masked tiles: those in the tiles' own pred column, or a model's."""

    def run(state: State, settings: Settings) -> State:
        tiles = state["masked"]
        if load is None:
            found = tiles.select("slide", "tile", "pred", F.lit(None).cast("string").alias("error"))
        else:
            found = infer.infer(tiles.filter("mask IS NOT NULL"), load)
        return {"predictions": render.same_shape(tiles.drop("pred"), found.select("slide", "tile", "pred", F.col("error").alias("model_error")))}

    return Stage("prediction", run)


def heatmap(state: State, settings: Settings) -> State:
    """Blocks of all tiles with a mask, range of each slide, and the reduced heatmap, a row a tile.

    With heatmap_erosion_pixels in the settings, values near the tissue's edge become 0;
    the tissue is that of the state (slide, by, bx, pixels, at reduced scale), or else
    sampled from the tiles' masks, which lie at small_up and small_left there.
    """
    tiles = state["predictions"]
    blocks = density.tile_density(tiles.filter("mask IS NOT NULL"), settings.npix, settings.mask_val)
    places = [c for c in ("small_up", "small_left") if c in tiles.columns]
    heat = render.heat_tiles(tiles.select("slide", "tile", "h", "w", "out_h", "out_w", *places), blocks, settings.npix, settings.scale_factor)
    if settings.heatmap_erosion_pixels > 0:
        tissue = state["tissue"] if "tissue" in state else render.tissue_of(tiles, settings.block)
        heat = render.erode_heat(heat, tissue, settings.block, settings.heatmap_erosion_pixels)
    return {"blocks": blocks, "ranges": density.slide_range(blocks), "heatmap": heat}


def colormap(state: State, settings: Settings) -> State:
    """Heat tiles with their grey levels."""
    return {"colormap": render.gray_tiles(state["heatmap"], state["ranges"], settings.scale_factor)}


def check(state: State, settings: Settings) -> State:
    """One row per slide (slide, n_tiles): counts of the stages, the first gate that it fails and its status."""
    n = state["predictions"].groupBy("slide").agg(
        F.count("*").alias("n_found"), F.count("mask").alias("n_seg"), F.count(F.when(F.col("mask").isNotNull(), F.col("pred"))).alias("n_pred"),
        F.count_if(F.col("error").isNotNull() | F.col("model_error").isNotNull() | F.col("mask").isNull()).alias("n_errors"),
    )
    seen = render.verify_tiles(state["heatmap"]).select("slide", "max_value", "n_nonzero")
    both = state["slides"].join(n, "slide", "left").join(seen, "slide", "left")
    both = both.withColumn("dir_exists", F.col("n_found").isNotNull()).withColumn("masker_log", F.coalesce(F.col("n_seg") == F.col("n_tiles"), F.lit(False)))
    code = runlog.failure_code()
    return {"report": both.select("slide", "n_tiles", "n_found", "n_seg", "n_pred", "n_errors", "max_value", "n_nonzero", code.alias("code"), runlog.status(code).alias("status"))}


STAGES = [Stage("masking", masking), prediction(), Stage("heatmap", heatmap), Stage("colormap", colormap), Stage("check", check)]


def run_stages(state: State, stages: list[Stage] | None = None, settings: Settings = Settings(), only: list[str] | None = None) -> State:
    """The state after all stages, or after those named in only; a stage that fails slides leaves them to the next with their status.

    Nothing runs until a table of the result is used; tables of stages that aren't run
    must be in the state.
    """
    for stage in stages or STAGES:
        if only is None or stage.name in only:
            state = {**state, **stage.run(state, settings)}
    return state


def write_heatmaps(state: State, folder: str, settings: Settings = Settings()) -> None:
    """A file a slide of each kind: folder/heatmap/<slide>.nii and .npy of the values, folder/colormap/<slide>.tif of the grey levels.

    Tiles lie at small_up and small_left of rasters of sizes (slide, small_h, small_w).
    """
    block, sizes = settings.block, state["sizes"].select("slide", F.col("small_h").alias("h"), F.col("small_w").alias("w"))

    def blocks(tiles: DataFrame, column: str, end: str, dtype: str) -> DataFrame:
        parts = tiles.select("slide", F.col("tile").alias("seq"), F.col("small_up").alias("y0"), F.col("small_left").alias("x0"), F.col("out_h").alias("h"), F.col("out_w").alias("w"), F.col(column).alias("pixels"))
        laid = canvas.paste(parts, block, "last", dtype).join(sizes, "slide")
        return laid.select(F.concat(F.col("slide").cast("string"), F.lit(end)).alias("name"), F.col("by").alias("gy"), F.col("bx").alias("gx"), "h", "w", "pixels")

    for kind, end in (("nifti", ".nii"), ("npy", ".npy")):
        write_slides(blocks(state["heatmap"], "heat", end, "f8"), f"{folder}/heatmap", block, kind, scale=(settings.x_dim, settings.y_dim, settings.z_dim))
    write_slides(blocks(state["colormap"], "gray", ".tif", "u1"), f"{folder}/colormap", block)
