"""Heatmaps at reduced scale, grey maps and checks, from blocks alone.

A row of heat tiles holds the values of a tile (float64, row by row); the forms with a row
per pixel (reduced, gray, verify) are for small rasters and checks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g
from . import canvas, distance

SCALE_FACTOR = 1000.0
LEGAL_MAX = 100_000.0


def reduced(tiles: DataFrame, blocks: DataFrame, npix: int, scale: float = SCALE_FACTOR) -> DataFrame:
    """(slide, tile, h, w, out_h, out_w) and blocks -> (slide, tile, r, c, value): nearest sampling of the full-size heatmap, times scale.

    The full-size heatmap is constant per block, so a pixel's block is computed from the
    place it samples, and the full raster is never made. Tiles without blocks give 0.
    """
    rows = tiles.withColumn("r", F.explode(F.expr("sequence(0, out_h - 1)"))).withColumn("c", F.explode(F.expr("sequence(0, out_w - 1)")))
    rows = rows.withColumn("br", g.block_of(g.nearest_source(F.col("r"), F.col("h"), F.col("out_h")), F.col("h"), npix))
    rows = rows.withColumn("bc", g.block_of(g.nearest_source(F.col("c"), F.col("w"), F.col("out_w")), F.col("w"), npix))
    found = rows.join(blocks.select("slide", "tile", "br", "bc", "pct"), ["slide", "tile", "br", "bc"], "left")
    return found.select("slide", "tile", "r", "c", (F.coalesce("pct", F.lit(0.0)) * scale).alias("value"))


def gray(heatmap: DataFrame, ranges: DataFrame, scale: float = SCALE_FACTOR) -> DataFrame:
    """Adds gray: value / scale within the slide's range, in 256 steps; 0 where the range is empty."""
    both = heatmap.join(ranges, "slide")
    x = (F.col("value") / scale - F.col("min_pct")) / (F.col("max_pct") - F.col("min_pct"))
    level = F.greatest(F.lit(0), F.least(F.floor(x * 256).cast("int"), F.lit(255)))
    return both.withColumn("gray", F.when(F.col("max_pct") > F.col("min_pct"), level).otherwise(0)).drop("min_pct", "max_pct")


def verify(heatmap: DataFrame) -> DataFrame:
    """Per slide the greatest value, pixels above zero, their share, and OK, STAGE3_ABNORMAL or STAGE3_VERIFY_FAILED."""
    return _verified(heatmap.groupBy("slide").agg(F.max("value").alias("max_value"), F.count_if(F.col("value") != 0).alias("n_nonzero"), F.count("*").alias("n")))


def _verified(sums: DataFrame) -> DataFrame:
    code = F.when(F.col("max_value") > LEGAL_MAX, "STAGE3_ABNORMAL").when(F.col("n_nonzero") == 0, "STAGE3_VERIFY_FAILED").otherwise("OK")
    return sums.select("slide", "max_value", "n_nonzero", (100.0 * F.col("n_nonzero") / F.col("n")).alias("pct_nonzero"), code.alias("code"))


def _kernel(rows: DataFrame, into: str, make: Callable[[object], bytes], drop: tuple[str, ...] = ()) -> DataFrame:
    """rows with `into`, the bytes that make gives for each row, in place of the columns in drop."""
    fields = [f for f in rows.schema.fields if f.name not in (into, *drop)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [make(t) for t in frame.itertuples()]
            yield frame[[f.name for f in fields]].assign(**{into: pd.Series(made, dtype=object, index=frame.index)})

    return rows.mapInPandas(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", `{into}` binary")


def _nearest(n_out: int, n_in: int) -> np.ndarray:
    """The source places of n_out places under nearest sampling of n_in."""
    return np.minimum(((np.arange(n_out) + 0.5) * n_in / n_out).astype(np.int64), n_in - 1)


def heat_tiles(tiles: DataFrame, blocks: DataFrame, npix: int, scale: float = SCALE_FACTOR) -> DataFrame:
    """tiles (slide, tile, h, w, out_h, out_w, ...) with `heat` binary: as reduced(), a row a tile; 0 where a tile has no blocks."""
    each = blocks.groupBy("slide", "tile").agg(F.collect_list("br").alias("block_rows"), F.collect_list("bc").alias("block_cols"), F.collect_list("pct").alias("block_pct"))

    def fill(t) -> bytes:
        places = [np.minimum(_nearest(int(o), int(n)) // npix, max(int(np.rint(n / npix)) - 1, 0)) for o, n in ((t.out_h, t.h), (t.out_w, t.w))]
        grid = np.zeros((places[0].max(initial=0) + 1, places[1].max(initial=0) + 1))
        if t.block_rows is not None:
            br, bc = (np.asarray(x, np.int64) for x in (t.block_rows, t.block_cols))
            inside = (br < grid.shape[0]) & (bc < grid.shape[1])
            grid[br[inside], bc[inside]] = np.asarray(t.block_pct)[inside]
        return (grid[np.ix_(*places)] * scale).tobytes()

    return _kernel(tiles.join(each, ["slide", "tile"], "left"), "heat", fill, ("block_rows", "block_cols", "block_pct"))


def heat_pixels(heat: DataFrame) -> DataFrame:
    """(slide, tile, out_h, out_w, heat) -> (slide, tile, r, c, value), for small rasters and checks."""
    types = dict(heat.dtypes)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for t in frame.itertuples():
                r, c = np.indices((int(t.out_h), int(t.out_w)), dtype=np.int32)
                yield pd.DataFrame({"slide": t.slide, "tile": t.tile, "r": r.ravel(), "c": c.ravel(), "value": np.frombuffer(t.heat, "<f8")})

    return heat.select("slide", "tile", "out_h", "out_w", "heat").mapInPandas(run, f"slide {types['slide']}, tile {types['tile']}, r int, c int, value double")


def tissue_of(tiles: DataFrame, block: int) -> DataFrame:
    """The tissue of slides at reduced scale, in blocks: each tile's mask (slide, tile, h, w, mask, out_h, out_w, small_up, small_left), sampled."""

    def thin(t) -> bytes:
        m = np.frombuffer(t.mask, np.uint8).reshape(int(t.h), int(t.w))
        return m[np.ix_(_nearest(int(t.out_h), int(t.h)), _nearest(int(t.out_w), int(t.w)))].tobytes()

    small = _kernel(tiles.filter("mask IS NOT NULL").select("slide", "tile", "h", "w", "mask", "out_h", "out_w", "small_up", "small_left"), "pixels", thin, ("mask",))
    parts = small.select("slide", F.col("tile").alias("seq"), F.col("small_up").alias("y0"), F.col("small_left").alias("x0"), F.col("out_h").alias("h"), F.col("out_w").alias("w"), "pixels")
    return canvas.paste(parts, block, "last")


def erode_heat(heat: DataFrame, tissue: DataFrame, block: int, radius: int) -> DataFrame:
    """Heat tiles (slide, tile, out_h, out_w, small_up, small_left, heat): 0 where not the whole disk around a pixel is tissue.

    tissue (slide, by, bx, pixels) is that of the whole slide at reduced scale, so disks
    cross the tiles' borders; slides without any tissue raster keep their values.
    """
    alive = distance.erode(tissue, block, radius)
    wanted = heat.select("slide", "tile", F.col("small_up").alias("up"), F.col("small_left").alias("left"), F.col("out_h").alias("h"), F.col("out_w").alias("w"))
    known = tissue.select("slide").distinct()
    found = canvas.windows(alive, block, wanted.join(known, "slide", "left_semi")).select("slide", "tile", F.col("pixels").alias("alive"))

    def keep(t) -> bytes:
        return t.heat if t.alive is None else np.where(np.frombuffer(t.alive, np.uint8) != 0, np.frombuffer(t.heat, "<f8"), 0.0).tobytes()

    return _kernel(heat.join(found, ["slide", "tile"], "left"), "heat", keep, ("alive",))


def gray_tiles(heat: DataFrame, ranges: DataFrame, scale: float = SCALE_FACTOR) -> DataFrame:
    """Heat tiles with `gray` binary: as gray(), a byte a pixel."""

    def level(t) -> bytes:
        x = np.frombuffer(t.heat, "<f8")
        if t.min_pct is None or not t.max_pct > t.min_pct:
            return bytes(len(x))
        return np.clip(np.floor((x / scale - t.min_pct) / (t.max_pct - t.min_pct) * 256), 0, 255).astype(np.uint8).tobytes()

    return _kernel(heat.join(ranges, "slide", "left"), "gray", level, ("min_pct", "max_pct"))


def verify_tiles(heat: DataFrame) -> DataFrame:
    """As verify(), of heat tiles: each is summed up where it is."""
    types = dict(heat.dtypes)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = [np.frombuffer(h, "<f8") for h in frame.heat]
            yield pd.DataFrame({"slide": frame.slide, "m": [v.max() if len(v) else None for v in x], "k": [np.count_nonzero(v) for v in x], "n": [len(v) for v in x]})

    each = heat.select("slide", "heat").mapInPandas(run, f"slide {types['slide']}, m double, k long, n long")
    return _verified(each.groupBy("slide").agg(F.max("m").alias("max_value"), F.sum("k").alias("n_nonzero"), F.sum("n").alias("n")))


def matched(tiles: DataFrame, small: DataFrame) -> DataFrame:
    """Tiles (slide, tile, h, w) with their sizes at reduced scale (slide, tile, out_h, out_w), of slides where both have as many tiles."""
    n = lambda df, c: df.groupBy("slide").agg(F.count("*").alias(c))
    fit = n(tiles, "_a").join(n(small, "_b"), "slide").filter("_a = _b").select("slide")
    return tiles.join(small, ["slide", "tile"]).join(fit, "slide", "left_semi")


def same_shape(tiles: DataFrame, predictions: DataFrame) -> DataFrame:
    """tiles (slide, tile, h, w) and predictions (slide, tile, pred binary): pred of another size than its tile's goes, error says so."""
    both = tiles.join(predictions, ["slide", "tile"], "left")
    wrong = F.col("pred").isNotNull() & (F.octet_length("pred") != F.col("h") * F.col("w"))
    return both.withColumn("error", F.when(wrong, F.lit("prediction and tile differ in size"))).withColumn("pred", F.when(~wrong, F.col("pred")))
