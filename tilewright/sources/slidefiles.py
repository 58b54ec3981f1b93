"""A data sink of one file a slide, from blocks of its raster: tiled BigTIFF with reduced pages, NIfTI-1 and .npy."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from .paths import filesystem
from .rasters import nifti_head
from .tiff import npy_head

FORMAT = "slide_files"
KINDS = ("tiff", "nifti", "npy")


def _directory(at: int, page: Row, block: int, tiles: dict[tuple[int, int], tuple[int, int]], reduced: bool, compressed: bool, last: bool) -> bytes:
    """A BigTIFF directory that lies at `at`: tags whose values don't fit follow it, then the next directory."""
    rows, cols = -(-page.h // block), -(-page.w // block)
    places = [tiles.get((r, c), (0, 0)) for r in range(rows) for c in range(cols)]
    n = page.channels
    tags = [
        (254, 4, [int(reduced)]), (256, 16, [page.w]), (257, 16, [page.h]), (258, 3, [8] * n), (259, 3, [8 if compressed else 1]), (262, 3, [2 if n >= 3 else 1]), (277, 3, [n]),
        (322, 16, [block]), (323, 16, [block]), (324, 16, [p[0] for p in places]), (325, 16, [p[1] for p in places]),
    ]
    if n > 3:
        tags.append((338, 3, [0] * (n - 3)))
    extra, entries, after = b"", b"", at + 8 + 20 * len(tags) + 8
    for tag, kind, values in sorted(tags):
        raw = struct.pack(f"<{len(values)}{ {3: 'H', 4: 'I', 16: 'Q'}[kind]}", *values)
        if len(raw) > 8:
            inline = struct.pack("<Q", after + len(extra))
            extra += raw + b"\0" * (-len(raw) % 8)
        else:
            inline = raw.ljust(8, b"\0")
        entries += struct.pack("<HHQ", tag, kind, len(values)) + inline
    return struct.pack("<Q", len(tags)) + entries + struct.pack("<Q", 0 if last else after + len(extra)) + extra


def _tiff(rows: Iterator[Row], block: int, compressed: bool) -> Iterator[bytes]:
    """A file in one pass: where the directories begin is known beforehand from the sum of the blocks' lengths."""
    at, pages = 16, []
    for level, own in groupby(rows, key=lambda r: r.level):
        tiles: dict[tuple[int, int], tuple[int, int]] = {}
        for r in own:
            if not pages and not tiles:
                yield struct.pack("<2sHHHQ", b"II", 43, 8, 0, 16 + r.total + -r.total % 8)
                total = r.total
            tiles[r.gy, r.gx] = at, len(r.data)
            at += len(r.data)
            page = r
            yield r.data
        pages.append((level, page, tiles))
    yield b"\0" * (-total % 8)
    at = 16 + total + -total % 8
    for k, (level, page, tiles) in enumerate(pages):
        made = _directory(at, page, block, tiles, level > 0, compressed, k == len(pages) - 1)
        at += len(made)
        yield made


def _raster(rows: Iterator[Row], block: int, dtype: str, by_column: bool, scale: tuple[float, ...]) -> Iterator[bytes]:
    """A whole raster a strip of blocks at a time: rows for .npy, columns for NIfTI; blocks that are missing are 0."""
    done = 0
    for at, own in groupby(rows, key=lambda r: r.gx if by_column else r.gy):
        strip = None
        for r in own:
            if strip is None:
                page = r
                if done == 0:
                    yield nifti_head((page.h, page.w), scale) if by_column else npy_head(np.dtype(dtype).newbyteorder("<").str, (page.h, page.w))
                length, other = (page.w, page.h) if by_column else (page.h, page.w)
                if at * block > done:
                    yield bytes((at * block - done) * other * np.dtype(dtype).itemsize)
                side = min(block, length - at * block)
                strip = np.zeros((page.h, side) if by_column else (side, page.w), dtype)
            tile = np.frombuffer(r.data, dtype).reshape(block, block)
            y, x = (r.gy * block, 0) if by_column else (0, r.gx * block)
            h, w = min(block, strip.shape[0] - y), min(block, strip.shape[1] - x)
            strip[y : y + h, x : x + w] = tile[:h, :w]
        yield strip.tobytes(order="F" if by_column else "C")
        done = at * block + side
    if done < length:
        yield bytes((length - done) * other * np.dtype(dtype).itemsize)


@dataclass
class Written(WriterCommitMessage):
    """Drafts of a task and the names that they get."""

    files: list[tuple[str, str]] = field(default_factory=list)


class SlideWriter(DataSourceWriter):
    """Tasks append whole files to drafts below one folder of the job; commit moves those of the attempts that count."""

    def __init__(self, options: dict[str, str]):
        self.folder, self.kind, self.block = options["path"].rstrip("/"), options["kind"], int(options["block"])
        self.compressed, self.dtype = options.get("compressed") == "true", options.get("dtype", "float64")
        self.scale = tuple(float(x) for x in options.get("scale", "1,1,1").split(","))
        self.drafts = f"{self.folder}/_drafts-{uuid.uuid4().hex}"

    def _bytes(self, rows: Iterator[Row]) -> Iterator[bytes]:
        if self.kind == "tiff":
            return _tiff(rows, self.block, self.compressed)
        return _raster(rows, self.block, self.dtype, self.kind == "nifti", self.scale)

    def write(self, iterator: Iterator[Row]) -> Written:
        fs, base = filesystem(self.drafts)
        out, attempt = Written(), TaskContext.get().taskAttemptId()
        fs.create_dir(base, recursive=True)
        for k, (name, rows) in enumerate(groupby(iterator, key=lambda r: r.name)):
            draft = f"{base}/{attempt}-{k}"
            with fs.open_output_stream(draft) as f:
                for piece in self._bytes(rows):
                    f.write(piece)
            out.files.append((draft, name))
        return out

    def commit(self, messages: list[Written | None]) -> None:
        fs, base = filesystem(self.folder)
        for message in messages:
            for draft, name in message.files if message else []:
                at = f"{base}/{name}"
                fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
                fs.move(draft, at)
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        fs, base = filesystem(self.drafts)
        if fs.get_file_info(base).type.name == "Directory":
            fs.delete_dir(base)


class SlideFiles(DataSource):
    """Options: path of a folder, kind (tiff, nifti or npy), block, compressed, dtype, scale. Use write_slides."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> SlideWriter:
        return SlideWriter(dict(self.options))


def write_slides(blocks: DataFrame, folder: str, block: int, kind: str = "tiff", compress: bool = True, dtype: str = "float64", scale: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> None:
    """Writes folder/name for each name of (name, [level,] gy, gx, h, w, [channels,] pixels), from whole blocks of `block` pixels a side.

    h and w are those of the page; blocks reach past its border, and those that are
    missing are 0. A TIFF takes 8-bit pixels, with a page for each level (0 for the full
    size), tiled and by Deflate unless told otherwise; NIfTI and .npy take one channel of
    `dtype`, float64 for NIfTI. Blocks are compressed where they are; then a file's blocks
    go in order through one task, which holds one of them (a strip of them for NIfTI and
    .npy) and only ever appends. Files appear when all are complete; a write that fails
    leaves none.
    """
    if kind not in KINDS or (kind == "tiff" and block % 16) or (kind == "nifti" and dtype != "float64"):
        raise ValueError(f"kind is one of {KINDS}, tiles of a TIFF are multiples of 16, NIfTI is of float64")
    spark = blocks.sparkSession
    spark.dataSource.register(SlideFiles)
    optional = {c: F.col(c) if c in blocks.columns else F.lit(d) for c, d in (("level", 0), ("channels", 1))}
    rows = blocks.select("name", *[optional.get(c, F.col(c)).cast("long").alias(c) for c in ("level", "gy", "gx", "h", "w", "channels")], F.col("pixels").alias("data"))

    def squeezed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(data=[zlib.compress(d, 6) for d in f.data])

    if compress and kind == "tiff":
        rows = rows.mapInPandas(squeezed, rows.schema)
    order = ["name", "level", *(("gx", "gy") if kind == "nifti" else ("gy", "gx"))]
    if kind == "tiff":
        sums = rows.groupBy(F.col("name").alias("_n")).agg(F.sum(F.octet_length("data")).alias("total"))
        rows = rows.join(sums, F.col("name") == F.col("_n")).drop("_n")
    rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "name").sortWithinPartitions(*order)
    write = rows.write.format(FORMAT).mode("append").option("kind", kind).option("block", block).option("dtype", dtype).option("scale", ",".join(map(str, scale)))
    write.option("compressed", str(compress and kind == "tiff").lower()).save(folder)
