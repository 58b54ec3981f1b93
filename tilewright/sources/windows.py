"""A data source of windows of large TIFF files: each task reads the byte ranges of its own windows."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .codecs import Layout
from .paths import filesystem
from .tiff import opened, pages_of

#: Names of the source and its columns.
FORMAT = "tiff_windows"
SCHEMA = (
    "path string, tile_id int, gr int, gc int, row_up long, col_up long, row_low long, col_low long, full_h long, full_w long, h int, w int, channels int, dtype string, pixels binary, error string"
)
#: Windows of a task: these many bytes of pixels, or FEWEST windows if they are large.
TASK_BYTES, FEWEST = 1 << 20, 8
Box = tuple[int, int, int, int, int, int, int]


@dataclass
class Windows(InputPartition):
    """Windows (tile_id, gr, gc, row_up, col_up, row_low, col_low) of one page, and where their samples lie."""

    path: str
    boxes: list[Box]
    layout: Layout | None
    error: str | None = None

    def __post_init__(self) -> None:
        self.value = None


def boxes_of(height: int, width: int, tile_px: int) -> list[Box]:
    """An even split of the page into ceil(side / tile_px) parts a side, numbered row by row."""
    rows, cols = -(-height // tile_px), -(-width // tile_px)
    cut = lambda i, size, n: i * size // n
    return [
        (r * cols + c, r, c, cut(r, height, rows), cut(c, width, cols), cut(r + 1, height, rows), cut(c + 1, width, cols))
        for r in range(rows)
        for c in range(cols)
    ]


class WindowReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.tile_px, self.page, self.each = (int(options.get(k, d)) for k, d in (("tile_px", 2890), ("page", 0), ("windows_per_task", 0)))
        wanted = options.get("tile_ids")
        self.wanted = {int(x) for x in wanted.split(",")} if wanted else None

    def _files(self) -> list[str]:
        fs, at = filesystem(self.path)
        info = fs.get_file_info(at)
        if info.type == pafs.FileType.File:
            return [self.path]
        base = self.path.rstrip("/")
        found = fs.get_file_info(pafs.FileSelector(at, recursive=True))
        hidden = lambda name: any(p.startswith((".", "_")) for p in name.split("/"))
        names = sorted(f.path[len(at.rstrip("/")) + 1 :] for f in found if f.type == pafs.FileType.File and f.path.lower().endswith((".tif", ".tiff")))
        return [f"{base}/{n}" for n in names if not hidden(n)]

    def _planned(self, path: str) -> list[Windows]:
        try:
            with opened(path) as read:
                form, pages = pages_of(read, self.page + 1)
            layout = Layout(pages[self.page], form["little_endian"])
        except (ValueError, KeyError, IndexError, struct.error, OSError) as e:
            return [Windows(path, [], None, f"{type(e).__name__}: {e}"[:200])]
        boxes = [b for b in boxes_of(layout.height, layout.width, self.tile_px) if self.wanted is None or b[0] in self.wanted]
        size = max(1, max(((b[5] - b[3]) * (b[6] - b[4]) for b in boxes), default=1) * layout.channels * layout.dtype.itemsize)
        each = self.each or max(FEWEST, TASK_BYTES // size)
        parts = [boxes[i : i + each] for i in range(0, len(boxes), each)]
        return [Windows(path, p, layout.kept(min(b[3] for b in p), max(b[5] for b in p))) for p in parts]

    def partitions(self) -> list[Windows]:
        with ThreadPoolExecutor(16) as pool:
            return [w for ws in pool.map(self._planned, self._files()) for w in ws]

    def read(self, partition: Windows) -> Iterator[tuple]:
        if partition.layout is None:
            yield (partition.path, *[None] * 14, partition.error)
            return
        p = partition.layout
        with opened(partition.path) as read:
            for box in partition.boxes:
                up, left, low, right = box[3:]
                size = (p.height, p.width, low - up, right - left, p.channels, p.dtype.name)
                try:
                    yield (partition.path, *box, *size, p.window(read, up, left, low, right).tobytes(), None)
                except Exception as e:  # one broken segment mustn't end the slide
                    yield (partition.path, *box, *size, None, f"{type(e).__name__}: {e}"[:200])


class TiffWindows(DataSource):
    """Options: path of a file or folder, tile_px, page, tile_ids (some windows alone), windows_per_task."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WindowReader:
        return WindowReader(dict(self.options))


def read_windows(spark: SparkSession, path: str, tile_px: int = 2890, page: int = 0, tile_ids: list[int] | None = None) -> DataFrame:
    """Windows of an even split of each TIFF file at or below path, with their samples (rows, then columns, then channels).

    Directories are read when the plan is made, and windows are dealt to tasks with the
    offsets of the segments below them; a task reads those byte ranges alone, a segment at
    a time, so neither the size of a file nor of its strips matters. Strips and tiles,
    uncompressed or by Deflate, LZW or PackBits, with or without horizontal differences,
    of 8 to 64 bits; values come in little-endian order. A file or window that can't be
    read is a row with its error.
    """
    spark.dataSource.register(TiffWindows)
    reader = spark.read.format(FORMAT).option("tile_px", tile_px).option("page", page)
    if tile_ids is not None:
        reader = reader.option("tile_ids", ",".join(map(str, tile_ids)))
    return reader.load(path)
