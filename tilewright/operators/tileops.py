"""Raster kernels on whole tiles: a row holds a tile's bytes, so keys and coordinates stay small beside the pixels.

The forms with a row per pixel (mask, metrics, infer, mosaic) are for small rasters and
checks; these are for full-size tiles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .infer import Segmenter, as_rgb


def _types(df: DataFrame, *names: str) -> str:
    types = dict(df.dtypes)
    return ", ".join(f"{n} {types[n]}" for n in names)


def eroded(mask: np.ndarray, radius: int) -> np.ndarray:
    """Where the whole disk around a pixel is set; the array's border is left out (radius on each side)."""
    h, w = mask.shape[0] - 2 * radius, mask.shape[1] - 2 * radius
    sums = np.zeros((mask.shape[0], mask.shape[1] + 1), np.int32)
    np.cumsum(mask != 0, axis=1, out=sums[:, 1:])
    alive = np.ones((h, w), bool)
    for dy in range(-radius, radius + 1):
        k = int(np.sqrt(radius * radius - dy * dy))
        row = sums[radius + dy : radius + dy + h]
        alive &= row[:, radius + k + 1 : radius + k + 1 + w] - row[:, radius - k : radius - k + w] == 2 * k + 1
    return alive


def erode_tiles(tiles: DataFrame, radius: int) -> DataFrame:
    """(slide, tile, gr, gc, h, w, mask binary) -> the same with mask 0 where the disk around a pixel isn't all tissue.

    Tiles are places of a slide's grid; only strips of `radius` pixels go to the eight
    neighbours. Missing neighbours count as background. Tiles are at least `radius` high
    and wide, but for the last row and column.
    """
    keys = ["slide", "gr", "gc"]
    names = [*keys, "dy", "dx", "tile", "h", "w", "mask"]
    schema = _types(tiles, *keys) + ", dy int, dx int, " + _types(tiles, "tile", "h", "w") + ", mask binary"

    def strips(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for t in frame.itertuples():
                m = np.frombuffer(t.mask, np.uint8).reshape(int(t.h), int(t.w))
                for dy in (-1, 0, 1):
                    rows = {-1: m[:radius], 0: m, 1: m[-radius:]}[dy]
                    for dx in (-1, 0, 1):
                        part = {-1: rows[:, :radius], 0: rows, 1: rows[:, -radius:]}[dx]
                        # this tile lies at (-dy, -dx) of the neighbour that gets the part
                        out.append((t.slide, t.gr + dy, t.gc + dx, -dy, -dx, t.tile, *part.shape, part.tobytes()))
            yield pd.DataFrame(out, columns=names)

    def joined(parts: list) -> tuple | None:
        own = next((t for t in parts if t.dy == 0 and t.dx == 0), None)
        if own is None:
            return None
        h, w = int(own.h), int(own.w)
        m = np.zeros((h + 2 * radius, w + 2 * radius), np.uint8)
        for t in parts:
            part = np.frombuffer(t.mask, np.uint8).reshape(int(t.h), int(t.w))
            y = {-1: radius - t.h, 0: radius, 1: radius + h}[t.dy]
            x = {-1: radius - t.w, 0: radius, 1: radius + w}[t.dx]
            m[y : y + t.h, x : x + t.w] = part
        inner = m[radius : radius + h, radius : radius + w]
        return own.slide, own.tile, own.gr, own.gc, h, w, np.where(eroded(m, radius), inner, 0).astype(np.uint8).tobytes()

    def join(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["slide", "tile", "gr", "gc", "h", "w", "mask"]
        parts: list = []
        for frame in frames:
            out = []
            for t in frame.itertuples():
                if parts and (t.slide, t.gr, t.gc) != (parts[0].slide, parts[0].gr, parts[0].gc):
                    out.append(joined(parts))
                    parts = []
                parts.append(t)
            yield pd.DataFrame([x for x in out if x], columns=columns)
        yield pd.DataFrame([x for x in ([joined(parts)] if parts else []) if x], columns=columns)

    spread = tiles.select(*keys, "tile", "h", "w", "mask").mapInPandas(strips, schema)
    n = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = spread.repartition(n, *keys).sortWithinPartitions(*keys)
    return ordered.mapInPandas(join, _types(tiles, "slide", "tile", "gr", "gc", "h", "w") + ", mask binary")


def each_tile(tiles: DataFrame, column: str, into: str, kernel: Callable[[object], bytes | None]) -> DataFrame:
    """tiles with `into`, the bytes that kernel makes of each row (a named tuple); null where column is null."""
    fields = [f for f in tiles.schema.fields if f.name != into]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", `{into}` binary"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [None if getattr(t, column) is None else kernel(t) for t in frame.itertuples()]
            yield frame[[f.name for f in fields]].assign(**{into: pd.Series(made, dtype=object, index=frame.index)})

    return tiles.mapInPandas(run, schema)


def first_channel(tiles: DataFrame, column: str = "mask") -> DataFrame:
    """tiles (h, w, `column` binary) of any number of channels with the first of them alone."""

    def kernel(t) -> bytes:
        n, size = len(getattr(t, column)), int(t.h) * int(t.w)
        return getattr(t, column)[:: n // size] if size and n % size == 0 and n > size else getattr(t, column)

    return each_tile(tiles, column, column, kernel)


def sample_mask(tiles: DataFrame) -> DataFrame:
    """(h, w, mask binary, mask_h, mask_w) -> mask at the tile's size, by nearest sampling.

    With row_up, col_up, full_h and full_w beside them, mask is that of the whole slide
    and the tile takes its own window of it, so no full-size mask is ever made.
    """
    windowed = {"row_up", "col_up", "full_h", "full_w"} <= set(tiles.columns)

    def kernel(t) -> bytes:
        m = np.frombuffer(t.mask, np.uint8).reshape(int(t.mask_h), int(t.mask_w))
        up, left, full_h, full_w = (t.row_up, t.col_up, t.full_h, t.full_w) if windowed else (0, 0, t.h, t.w)
        r = np.minimum(((np.arange(int(t.h)) + up + 0.5) * t.mask_h / full_h).astype(int), t.mask_h - 1)
        c = np.minimum(((np.arange(int(t.w)) + left + 0.5) * t.mask_w / full_w).astype(int), t.mask_w - 1)
        return m[np.ix_(r, c)].tobytes()

    return each_tile(tiles, "mask", "mask", kernel)


def shrink(tiles: DataFrame, factor: int = 10) -> DataFrame:
    """(h, w, rgb binary) -> small binary: means of factor x factor pixels (fewer at the border), cut to whole numbers."""

    def kernel(t) -> bytes:
        x = np.frombuffer(t.rgb, np.uint8).reshape(int(t.h), int(t.w), -1).astype(np.int64)
        at = [np.arange(0, n, factor) for n in x.shape[:2]]
        sums = np.add.reduceat(np.add.reduceat(x, at[0], axis=0), at[1], axis=1)
        n = np.diff(np.r_[at[0], x.shape[0]])[:, None] * np.diff(np.r_[at[1], x.shape[1]])[None]
        return (sums // n[:, :, None]).astype(np.uint8).tobytes()

    return each_tile(tiles, "rgb", "small", kernel)


def cut(images: DataFrame) -> DataFrame:
    """(slide, h, w, pixels binary, row_up, col_up, row_low, col_low, ...) of an image joined with its tile coordinates -> tile binary."""

    def kernel(t) -> bytes:
        x = np.frombuffer(t.pixels, np.uint8).reshape(int(t.h), int(t.w), -1)
        return np.ascontiguousarray(x[int(t.row_up) : int(t.row_low), int(t.col_up) : int(t.col_low)]).tobytes()

    return each_tile(images, "pixels", "tile", kernel).drop("pixels")


#: name -> the turned tile and back; rotations are counter-clockwise.
TURNS = {
    "identity": (lambda x: x, lambda x: x),
    "hflip": (lambda x: x[:, ::-1], lambda x: x[:, ::-1]),
    "vflip": (lambda x: x[::-1], lambda x: x[::-1]),
    "rot90": (lambda x: np.rot90(x, 1), lambda x: np.rot90(x, -1)),
    "rot180": (lambda x: np.rot90(x, 2), lambda x: np.rot90(x, -2)),
    "rot270": (lambda x: np.rot90(x, 3), lambda x: np.rot90(x, -3)),
}


def infer_turned(tiles: DataFrame, load: Callable[[], Segmenter], divisor: int = 32, fg: int = 255) -> DataFrame:
    """(slide, tile, h, w, rgb) -> (slide, tile, p binary, pred binary): mean foreground probability (float32) over all TURNS of a tile.

    The model runs on each turned tile, padded by reflection like infer(); all but class 0
    is foreground, and pred is fg where the mean is above a half.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for frame in frames:
            p, pred = [], []
            for t in frame.itertuples():
                x = as_rgb(t.rgb, int(t.h), int(t.w)).astype(np.float32) / 255
                total = np.zeros(x.shape[:2])
                for turn, back in TURNS.values():
                    y = turn(x)
                    h, w = y.shape[:2]
                    mode = "reflect" if min(h, w) > 1 else "edge"
                    logits = model(np.pad(y.transpose(2, 0, 1), ((0, 0), (0, -h % divisor), (0, -w % divisor)), mode=mode))[:, :h, :w].astype(np.float64)
                    e = np.exp(logits - logits.max(axis=0))
                    total += back(1 - e[0] / e.sum(axis=0))
                mean = total / len(TURNS)
                p.append(mean.astype(np.float32).tobytes())
                pred.append(np.where(mean > 0.5, fg, 0).astype(np.uint8).tobytes())
            yield pd.DataFrame({"slide": frame.slide, "tile": frame.tile, "p": p, "pred": pred})

    return tiles.select("slide", "tile", "h", "w", "rgb").mapInPandas(run, _types(tiles, "slide", "tile") + ", p binary, pred binary")


def scaled(values: Column) -> Column:
    """An array of numbers within its own range, 0 to 1; zeros where the range is empty."""
    lo, hi = F.array_min(values), F.array_max(values)
    return F.when(hi > lo, F.transform(values, lambda x: F.greatest(F.lit(0.0), F.least((x - lo) / (hi - lo), F.lit(1.0))))).otherwise(F.transform(values, lambda x: F.lit(0.0)))
