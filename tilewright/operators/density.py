"""Block density: the share of tissue pixels that a prediction marks, per block of a tile."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g


def density(pixels: DataFrame, npix: int, wrap: bool = False, min_one_block: bool = False) -> DataFrame:
    """(slide, tile, h, w, r, c, red, green, blue, pred) -> (slide, tile, br, bc, n_pred, n_tissue, pct).

    For small rasters and checks; one row per pixel. A tile with a side under half a
    block has no blocks. With wrap, channel sums wrap around at 256 as unsigned bytes do.
    """
    rgb = F.col("red") + F.col("green") + F.col("blue")
    tissue = (rgb.bitwiseAND(F.lit(255)) if wrap else rgb) != 0
    size = {s: F.greatest(F.col(s), F.lit(npix)) if min_one_block else F.col(s) for s in "hw"}
    rows = pixels.withColumn("br", g.block_of(F.col("r"), size["h"], npix)).withColumn("bc", g.block_of(F.col("c"), size["w"], npix))
    sums = rows.filter("br >= 0 AND bc >= 0").groupBy("slide", "tile", "br", "bc").agg(F.count_if(F.col("pred") != 0).alias("n_pred"), F.count_if(tissue).alias("n_tissue"))
    return sums.withColumn("pct", F.when(F.col("n_tissue") == 0, 0.0).otherwise(100.0 * F.col("n_pred") / F.col("n_tissue")))


def tile_density(tiles: DataFrame, npix: int, mask_val: int = 255, threshold: int = 0, wrap: bool = False) -> DataFrame:
    """density() of whole tiles (slide, tile, h, w, rgb binary, mask binary, pred binary), masked and cleaned on the way.

    The form for full-size tiles: pixels never leave the task that holds the tile, and a
    tile yields one row per block. A null pred is a tile without prediction.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = []
            for k, t in enumerate(frame.itertuples()):
                h, w = int(t.h), int(t.w)
                nr, nc = int(np.rint(h / npix)), int(np.rint(w / npix))
                if nr == 0 or nc == 0:
                    continue
                rgb = np.frombuffer(t.rgb, np.uint8).reshape(h, w, 3).astype(np.int32)
                rgb[np.frombuffer(t.mask, np.uint8).reshape(h, w) < mask_val] = 0
                total = rgb.sum(axis=2)
                pred = np.zeros((h, w), bool) if t.pred is None else np.frombuffer(t.pred, np.uint8).reshape(h, w) != 0
                pred &= total > threshold
                tissue = (total & 255 if wrap else total) != 0
                at = [np.arange(n) * npix for n in (nr, nc)]
                sums = [np.add.reduceat(np.add.reduceat(x.astype(np.int64), at[0], axis=0), at[1], axis=1).ravel() for x in (pred, tissue)]
                br, bc = np.divmod(np.arange(nr * nc, dtype=np.int32), nc)
                made.append((np.full(nr * nc, k), br.astype(np.int32), bc.astype(np.int32), *sums))
            if made:
                at, br, bc, n_pred, n_tissue = map(np.concatenate, zip(*made, strict=True))
                yield pd.DataFrame({"slide": frame.slide.to_numpy()[at], "tile": frame.tile.to_numpy()[at], "br": br, "bc": bc, "n_pred": n_pred, "n_tissue": n_tissue})

    types = dict(tiles.dtypes)
    rows = tiles.select("slide", "tile", "h", "w", "rgb", "mask", "pred").mapInPandas(
        run, f"slide {types['slide']}, tile {types['tile']}, br int, bc int, n_pred long, n_tissue long"
    )
    return rows.withColumn("pct", F.when(F.col("n_tissue") == 0, 0.0).otherwise(100.0 * F.col("n_pred") / F.col("n_tissue")))


def slide_range(blocks: DataFrame) -> DataFrame:
    """Per slide the least and greatest pct, both starting from 0."""
    return blocks.groupBy("slide").agg(F.least(F.min("pct"), F.lit(0.0)).alias("min_pct"), F.greatest(F.max("pct"), F.lit(0.0)).alias("max_pct"))
