"""Tissue masks at the tiles' size, from small masks of whole slides kept as blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import canvas

METHODS = ("nearest", "bilinear")


def sample(m: np.ndarray, up: int, left: int, at: tuple[np.ndarray, np.ndarray], full: tuple[int, int], size: tuple[int, int], method: str) -> np.ndarray:
    """Values at rows and columns `at` of the full size, from a window of the small mask (of `size`) that begins at up, left."""
    places = [(o + 0.5) * n / f for o, n, f in zip(at, size, full, strict=True)]
    if method == "nearest":
        r, c = (np.minimum(p.astype(np.int64), n - 1) - a for p, n, a in zip(places, size, (up, left), strict=True))
        return m[np.ix_(r, c)]
    low, share = [], []
    for p, n in zip(places, size, strict=True):
        p = np.clip(p - 0.5, 0, n - 1)
        low.append(np.floor(p).astype(np.int64))
        share.append(p - low[-1])
    rows = [np.minimum(low[0] + k, size[0] - 1) - up for k in (0, 1)]
    cols = [np.minimum(low[1] + k, size[1] - 1) - left for k in (0, 1)]
    y, x = share[0][:, None], share[1][None]
    top, below = ((1 - x) * m[np.ix_(r, cols[0])] + x * m[np.ix_(r, cols[1])] for r in rows)
    return np.floor((1 - y) * top + y * below + 0.5).astype(np.uint8)


def tile_masks(tiles: DataFrame, masks: DataFrame, sizes: DataFrame, block: int, method: str = "nearest") -> DataFrame:
    """Tiles (slide, tile, row_up, col_up, h, w, full_h, full_w) with masks in blocks (slide, by, bx, pixels) of sizes (slide, mask_h, mask_w) -> (slide, tile, mask binary).

    A tile takes the window of the mask below it, one pixel wider on each side, from the
    blocks that it overlaps, and samples it: the nearest pixel, or between the four around
    (half up), with the border's pixels repeated. No row holds more than a block or a
    tile; tiles of slides without a mask have no row.
    """
    if method not in METHODS:
        raise ValueError(f"method is one of {METHODS}")
    both = tiles.select("slide", "tile", "row_up", "col_up", "h", "w", "full_h", "full_w").join(sizes.select("slide", "mask_h", "mask_w"), "slide")
    first = lambda at, n, f: F.greatest(F.floor(F.col(at) * F.col(n) / F.col(f)) - 1, F.lit(0)).cast("int")
    stop = lambda at, size, n, f: F.least(F.ceil((F.col(at) + F.col(size)) * F.col(n) / F.col(f)) + 1, F.col(n)).cast("int")
    both = both.withColumns({"up": first("row_up", "mask_h", "full_h"), "left": first("col_up", "mask_w", "full_w")})
    wanted = both.select("slide", "tile", "up", "left", (stop("row_up", "h", "mask_h", "full_h") - F.col("up")).alias("h"), (stop("col_up", "w", "mask_w", "full_w") - F.col("left")).alias("w"))
    found = canvas.windows(masks, block, wanted).select("slide", "tile", F.col("h").alias("wh"), F.col("w").alias("ww"), "pixels")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for t in f.itertuples():
                at = np.arange(t.h) + t.row_up, np.arange(t.w) + t.col_up
                m = np.frombuffer(t.pixels, np.uint8).reshape(t.wh, t.ww)
                out.append(sample(m, t.up, t.left, at, (t.full_h, t.full_w), (t.mask_h, t.mask_w), method).tobytes())
            yield f[["slide", "tile"]].assign(mask=pd.Series(out, dtype=object, index=f.index))

    types = dict(tiles.dtypes)
    return both.join(found, ["slide", "tile"]).mapInPandas(run, f"slide {types['slide']}, tile {types['tile']}, mask binary")
