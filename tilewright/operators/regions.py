"""Connected regions of whole slides, and contrast by adaptive histograms, over canvas blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import written
from .graph import connected_components

#: Sides of a border: the last rows or columns before it, the first after it.
BEFORE, AFTER = 0, 1


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, stop, label) of the runs of set pixels, stop inclusive; runs that touch, corners too, have one label, its first run's number."""
    h, w = mask.shape
    edge = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, start = np.nonzero(edge == 1)
    stop = np.nonzero(edge == -1)[1] - 1
    lane = w + 4  # more than a row, so that places of neighbouring rows stay apart
    first = np.searchsorted(row * lane + stop, (row + 1) * lane + start - 1, "left")
    last = np.searchsorted(row * lane + start, (row + 1) * lane + stop + 1, "right")
    n = np.maximum(last - first, 0)
    a = np.repeat(np.arange(len(row)), n)
    b = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
    label = np.arange(len(row))
    while (label[a] != label[b]).any():
        x, y = label[a], label[b]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]
    return row, start, stop, label


def regions(blocks: DataFrame, block: int) -> DataFrame:
    """(slide, by, bx, pixels binary) -> (slide, area, top, left, low, right) of each region of pixels above 0, box half-open.

    Pixels that touch, corners too, are one region, across all blocks. Blocks are labelled
    by their runs; runs at a block's border meet those on the other side, which gives the
    edges between labels; a region is a component of these, however it winds.
    """
    kind = dict(blocks.dtypes)["slide"]
    names = ["slide", "by", "bx", "label", "area", "top", "left", "low", "right", "axis", "line", "lane", "start", "stop", "side"]
    schema = f"slide {kind}, " + ", ".join(f"{n} {'long' if n == 'area' else 'int'}" for n in names[1:])

    def labelled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for t in f.itertuples():
                mask = np.frombuffer(t.pixels, np.uint8).reshape(block, block) != 0
                row, start, stop, label = runs_of(mask)
                y0, x0 = t.by * block, t.bx * block
                ids, of = np.unique(label, return_inverse=True)
                n = len(ids)
                ends = [np.full(n, v) for v in (block, block, -1, -1)]
                for k, (values, pick) in enumerate(((row, np.minimum), (start, np.minimum), (row, np.maximum), (stop, np.maximum))):
                    pick.at(ends[k], of, values)
                area = np.bincount(of, stop - start + 1, n).astype(np.int64)
                none = [0] * 6
                out += [(t.slide, t.by, t.bx, int(i), int(a), y0 + int(r), x0 + int(c), y0 + int(r2) + 1, x0 + int(c2) + 1, -1, *none[1:]) for i, a, r, c, r2, c2 in zip(ids, area, *ends, strict=True)]
                by_place = np.full((block, block), -1)
                for r, a, b, i in zip(row, start, stop, label, strict=True):
                    by_place[r, a : b + 1] = i
                for axis, line, side, values, at in ((0, t.by, AFTER, by_place[0], t.bx), (0, t.by + 1, BEFORE, by_place[-1], t.bx), (1, t.bx, AFTER, by_place[:, 0], t.by), (1, t.bx + 1, BEFORE, by_place[:, -1], t.by)):
                    cut = np.flatnonzero(np.diff(values)) + 1
                    for a, b in zip(np.r_[0, cut].tolist(), np.r_[cut, block].tolist(), strict=True):
                        if values[a] >= 0:
                            # corners touch the lanes beside this one; only one side needs to go there
                            beside = [at - 1] * (a == 0) + [at + 1] * (b == block) if side == AFTER else []
                            for lane in (at, *beside):
                                out.append((t.slide, t.by, t.bx, int(values[a]), 0, 0, 0, 0, 0, axis, line, lane, at * block + a, at * block + b - 1, side))
            yield pd.DataFrame(out, columns=names)

    rows = written(blocks.select("slide", "by", "bx", "pixels").mapInPandas(labelled, schema))
    nodes = written(rows.filter("axis < 0").select("slide", "by", "bx", "label", "area", "top", "left", "low", "right", F.monotonically_increasing_id().alias("node")))
    border = rows.filter("axis >= 0").select("slide", "by", "bx", "label", "axis", "line", "lane", "start", "stop", "side").join(nodes.select("slide", "by", "bx", "label", "node"), ["slide", "by", "bx", "label"])

    place = ["slide", "axis", "line", "lane"]

    def met(f: pd.DataFrame) -> pd.DataFrame:
        """Of whole lanes sorted by place and start; each lane has numbers of its own, so all meet at once."""
        away = f.groupby(place, sort=False, dropna=False).ngroup().to_numpy() * (int(f.stop.max()) + 4)
        start, stop, node = f.start.to_numpy() + away, f.stop.to_numpy() + away, f.node.to_numpy()
        a, b = (np.flatnonzero(f.side.to_numpy() == s) for s in (BEFORE, AFTER))
        first = np.searchsorted(stop[b], start[a] - 1, "left")
        last = np.searchsorted(start[b], stop[a] + 1, "right")
        n = np.maximum(last - first, 0)
        at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        return pd.DataFrame({"u": np.repeat(node[a], n), "v": node[b][at]})

    def meet(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for f in frames:
            if not len(f):
                continue
            # the last lane may go on in the next frame
            key = f[place]
            same = ((key == key.iloc[-1]) | (key.isna() & key.iloc[-1].isna())).all(axis=1).to_numpy()
            if same.all() and held and held[-1][place].iloc[-1].equals(key.iloc[0]):
                held.append(f)
                continue
            yield met(pd.concat([*held, f[~same]])) if held or not same.all() else pd.DataFrame({"u": [], "v": []}, dtype="int64")
            held = [f[same]]
        if held:
            yield met(pd.concat(held))

    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    edges = border.select(*place, "start", "stop", "side", "node").repartition(parts, *place).sortWithinPartitions(*place, "start").mapInPandas(meet, "u long, v long")
    roots = connected_components(edges).select(F.col("node").alias("_n"), "root")
    both = nodes.join(roots, F.col("node") == F.col("_n"), "left").withColumn("root", F.coalesce("root", "node"))
    return both.groupBy("slide", "root").agg(F.sum("area").alias("area"), F.min("top").alias("top"), F.min("left").alias("left"), F.max("low").alias("low"), F.max("right").alias("right")).drop("root")


def largest_region(found: DataFrame) -> DataFrame:
    """Of each slide's regions the one of most pixels; of equal ones the first by top, left, low and right."""
    order = Window.partitionBy("slide").orderBy(F.desc("area"), "top", "left", "low", "right")
    return found.withColumn("_k", F.row_number().over(order)).filter("_k = 1").drop("_k")


def clipped_table(counts: np.ndarray, clip: float) -> np.ndarray:
    """256 grey levels by the cumulative counts, after what lies above clip * total (1 at least) is spread over all levels."""
    total = int(counts.sum())
    if not total:
        return np.arange(256, dtype=np.uint8)
    most = max(1, int(clip * total))
    over = int(np.maximum(counts - most, 0).sum())
    counts = np.minimum(counts, most) + over // 256 + (np.arange(256) < over % 256)
    return ((2 * 255 * np.cumsum(counts) + total) // (2 * total)).astype(np.uint8)


def _mixed(first: int, n: int, size: int, grid: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For n places from first: the regions before and after, by their centres, and the share of the second."""
    at = np.clip((np.arange(first, first + n) + 0.5) * grid / size - 0.5, 0, grid - 1)
    low = np.floor(at).astype(np.int64)
    return low, np.minimum(low + 1, grid - 1), at - low


def enhance_contrast(blocks: DataFrame, block: int, sizes: DataFrame, clip: float = 0.01, grid: int = 8) -> DataFrame:
    """Grey slides in blocks (slide, by, bx, pixels) of sizes (slide, h, w) -> the same with each level by the histograms around it.

    A slide is cut into grid x grid regions; each has a table of levels by its clipped
    cumulative histogram, and a pixel mixes those of the four regions whose centres are
    around it (half up). Blocks count their own pixels, so only histograms are sent; a
    slide's tables (256 bytes a region) go to its blocks. Missing blocks count as 0 where
    they are missing whole.
    """
    kind = dict(blocks.dtypes)["slide"]
    rows = blocks.select("slide", "by", "bx", "pixels").join(sizes.select("slide", F.col("h").cast("int").alias("full_h"), F.col("w").cast("int").alias("full_w")), "slide")

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for t in f.itertuples():
                x = np.frombuffer(t.pixels, np.uint8).reshape(block, block)
                h, w = min(block, t.full_h - t.by * block), min(block, t.full_w - t.bx * block)
                if h <= 0 or w <= 0:
                    continue
                gy, gx = ((np.arange(n) + b * block) * grid // full for n, b, full in ((h, t.by, t.full_h), (w, t.bx, t.full_w)))
                cells = gy[:, None] * grid + gx[None]
                n = np.bincount((cells * 256 + x[:h, :w]).ravel(), minlength=grid * grid * 256).reshape(-1, 256)
                out += [(t.slide, int(g), n[g].astype("<i8").tobytes()) for g in np.flatnonzero(n.any(axis=1))]
            yield pd.DataFrame(out, columns=["slide", "cell", "counts"])

    def tabled(f: pd.DataFrame) -> pd.DataFrame:
        sums = np.zeros((grid * grid, 256), np.int64)
        np.add.at(sums, f.cell.to_numpy(), np.stack([np.frombuffer(c, "<i8") for c in f.counts]))
        return pd.DataFrame({"slide": [f.slide.iloc[0]], "tables": [np.stack([clipped_table(s, clip) for s in sums]).tobytes()]})

    def summed(f: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"slide": f.slide.iloc[:1], "cell": f.cell.iloc[:1], "counts": [np.sum([np.frombuffer(c, "<i8") for c in f.counts], axis=0).tobytes()]})

    # a region's counts come together first, so that a slide's own meeting has one row a region
    counts = rows.mapInPandas(counted, f"slide {kind}, cell int, counts binary").groupBy("slide", "cell").applyInPandas(summed, f"slide {kind}, cell int, counts binary")
    tables = counts.groupBy("slide").applyInPandas(tabled, f"slide {kind}, tables binary")

    def mapped(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            made = []
            for t in f.itertuples():
                x = np.frombuffer(t.pixels, np.uint8).reshape(block, block)
                h, w = (int(np.clip(full - b * block, 0, block)) for full, b in ((t.full_h, t.by), (t.full_w, t.bx)))
                table = np.frombuffer(t.tables, np.uint8).reshape(grid, grid, 256).astype(np.float64)
                (a, b, y), (c, d, z) = _mixed(t.by * block, h, t.full_h, grid), _mixed(t.bx * block, w, t.full_w, grid)
                v, y, z = x[:h, :w], y[:, None], z[None]
                get = lambda r, s, table=table, v=v: table[r[:, None], s[None], v]
                out = np.zeros((block, block), np.uint8)
                out[:h, :w] = np.floor((1 - y) * ((1 - z) * get(a, c) + z * get(a, d)) + y * ((1 - z) * get(b, c) + z * get(b, d)) + 0.5)
                made.append(out.tobytes())
            yield f[["slide", "by", "bx"]].assign(pixels=pd.Series(made, dtype=object, index=f.index))

    return rows.join(tables, "slide").mapInPandas(mapped, f"slide {kind}, by int, bx int, pixels binary")
