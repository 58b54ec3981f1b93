"""Seamless reduction of whole slides: an anti-aliasing filter and interpolation, blocks agreeing across all borders."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import canvas

#: Standard deviations that the filter reaches to.
TRUNCATE = 4.0


def reach_of(factor: float) -> int:
    """Pixels to each side that the filter of a reduction by `factor` takes."""
    return int(TRUNCATE * max(0.0, (factor - 1) / 2) + 0.5)


def weights(first: int, stop: int, n_in: int, n_out: int) -> tuple[int, np.ndarray]:
    """(start, matrix): output pixels first to stop of a line as sums of the input pixels from start on.

    The line is smoothed by a Gaussian of standard deviation (factor - 1) / 2, its end
    pixels being mirrored without repeating them, and interpolated at the centres of the
    output pixels.
    """
    factor = n_in / n_out
    sigma, reach = max(0.0, (factor - 1) / 2), reach_of(factor)
    t = np.arange(-reach, reach + 1)
    kernel = np.exp(-0.5 * (t / sigma) ** 2) if sigma > 0 else np.ones(1)
    kernel = kernel / kernel.sum()
    place = np.clip((np.arange(first, stop) + 0.5) * factor - 0.5, 0, n_in - 1)
    low = np.floor(place).astype(np.int64)
    share = place - low
    taps = low[:, None] + np.arange(-reach, reach + 2)[None]
    each = (1 - share)[:, None] * np.r_[kernel, 0.0] + share[:, None] * np.r_[0.0, kernel]
    period = max(2 * (n_in - 1), 1)
    taps = np.abs((taps + n_in - 1) % period - (n_in - 1)) if n_in > 1 else np.zeros_like(taps)
    start = int(taps.min())
    out = np.zeros((stop - first, int(taps.max()) - start + 1))
    np.add.at(out, (np.arange(stop - first)[:, None], taps - start), each)
    return start, out


def span_of(first: int, stop: int, n_in: int, n_out: int) -> tuple[int, int]:
    start, m = weights(first, stop, n_in, n_out)
    return start, m.shape[1]


def reduce_slides(blocks: DataFrame, block: int, sizes: DataFrame, channels: int = 1, scale: float = 0.1, small_block: int = 128) -> DataFrame:
    """Slides in blocks (slide, by, bx, pixels binary) of sizes (slide, h, w) -> (slide, by, bx, pixels), at `scale`, in blocks of small_block.

    Each output block takes the window of the slide that its filter reaches, from the
    blocks that it overlaps, so results don't depend on where blocks end. Both directions
    are filtered by one product each. Values are cut to whole numbers, those within a
    millionth of the next one rounded up to it. No row exceeds a block or such a window.
    """
    out_n = lambda c: F.greatest(F.rint(F.col(c) * scale).cast("int"), F.lit(1))
    s = sizes.select("slide", F.col("h").cast("int").alias("full_h"), F.col("w").cast("int").alias("full_w"), out_n("h").alias("small_h"), out_n("w").alias("small_w"))
    count = lambda c: F.expr(f"cast(ceil({c} / {small_block}) as int)")
    s = s.withColumn("by", F.explode(F.sequence(F.lit(0), count("small_h") - 1))).withColumn("bx", F.explode(F.sequence(F.lit(0), count("small_w") - 1)))
    # the tile's number of a window is its place among those of the slide
    s = s.withColumn("tile", F.col("by").cast("long") * count("small_w") + F.col("bx"))

    @F.pandas_udf("up int, left int, h int, w int")
    def spans(f: pd.DataFrame) -> pd.DataFrame:
        out = []
        for t in f.itertuples():
            rows, cols = ((b * small_block, min((b + 1) * small_block, n), full, n) for b, n, full in ((t.by, t.small_h, t.full_h), (t.bx, t.small_w, t.full_w)))
            (up, h), (left, w) = span_of(*rows), span_of(*cols)
            out.append((up, left, h, w))
        return pd.DataFrame(out, columns=["up", "left", "h", "w"])

    s = s.withColumn("at", spans(F.struct("by", "bx", "small_h", "small_w", "full_h", "full_w")))
    found = canvas.windows(blocks, block, s.select("slide", "tile", "at.*"), channels).select("slide", "tile", F.col("h").alias("wh"), F.col("w").alias("ww"), "pixels")
    types = dict(blocks.dtypes)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            made = []
            for t in f.itertuples():
                x = np.frombuffer(t.pixels, np.uint8).reshape(t.wh, t.ww, channels).astype(np.float64)
                rows = weights(t.by * small_block, min((t.by + 1) * small_block, t.small_h), t.full_h, t.small_h)[1]
                cols = weights(t.bx * small_block, min((t.bx + 1) * small_block, t.small_w), t.full_w, t.small_w)[1]
                small = np.einsum("ik,kjc->ijc", cols, np.tensordot(rows, x, axes=1).transpose(1, 0, 2)).transpose(1, 0, 2)
                out = np.zeros((small_block, small_block, channels), np.uint8)
                out[: small.shape[0], : small.shape[1]] = np.clip(np.floor(small + 1e-6), 0, 255)
                made.append(out.tobytes())
            yield f[["slide", "by", "bx"]].assign(pixels=pd.Series(made, dtype=object, index=f.index))

    both = s.drop("at").join(found, ["slide", "tile"])
    return both.mapInPandas(run, f"slide {types['slide']}, by int, bx int, pixels binary")
