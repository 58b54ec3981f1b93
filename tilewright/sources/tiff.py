"""Baseline TIFF and BigTIFF: headers by range reads, small images in and out, one file a task at a time (see windows for large ones)."""

from __future__ import annotations

import io
import struct
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .codecs import Layout
from .paths import filesystem

#: Tags of the TIFF 6.0 specification.
TAGS = {
    254: "subfile", 256: "width", 257: "height", 258: "bits", 259: "compression", 262: "photometric", 273: "offsets", 277: "channels", 278: "rows", 279: "counts", 284: "planar", 317: "predictor",
    322: "tile_w", 323: "tile_h", 324: "tile_offsets", 325: "tile_counts", 339: "format",
}
#: struct letters by field type: byte, ascii, short, long and, in BigTIFF, long8.
KINDS = {1: "B", 2: "s", 3: "H", 4: "I", 16: "Q"}
#: Bytes of pixels from which a file needs 64-bit offsets.
BIG = 1 << 32
#: Bytes of pixels that are passed on at a time.
BATCH = 1 << 22
COORDINATES = ["row_up", "col_up", "row_low", "col_low"]
DTYPES = {1: "uint", 2: "int", 3: "float"}

Read = Callable[[int, int], bytes]


def pages_of(read: Read, limit: int | None = None) -> tuple[dict, list[dict]]:
    """Format and pages of a file that read(offset, size) gives bytes of; only directories are read.

    limit ends the walk after as many pages.
    """
    head = read(0, 16)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    version = struct.unpack_from(order + "H", head, 2)[0] if order and len(head) >= 8 else 0
    if version not in (42, 43):
        raise ValueError("no TIFF")
    big = version == 43
    count, entry, word = ("Q", 20, "Q") if big else ("H", 12, "I")
    at = struct.unpack_from(order + word, head, 8 if big else 4)[0]
    pages, seen = [], set()
    while at and at not in seen and (limit is None or len(pages) < limit):
        seen.add(at)
        n = struct.unpack(order + count, read(at, struct.calcsize(count)))[0]
        raw = read(at + struct.calcsize(count), n * entry + struct.calcsize(word))
        page = {}
        for k in range(n):
            tag, kind, items = struct.unpack_from(order + "HH" + word, raw, k * entry)
            if tag in TAGS and kind in KINDS:
                form = order + f"{items}{KINDS[kind]}"
                size, inline = struct.calcsize(form), struct.calcsize(word)
                value = raw[k * entry + entry - inline :][:size] if size <= inline else read(struct.unpack_from(order + word, raw, k * entry + entry - inline)[0], size)
                page[TAGS[tag]] = list(struct.unpack(form, value))
        pages.append(page)
        at = struct.unpack_from(order + word, raw, n * entry)[0]
    return {"big": big, "little_endian": order == "<"}, pages


def encode(pixels: bytes, h: int, w: int, channels: int, big: bool | None = None, description: str = "") -> bytes:
    """A file of one page of 8-bit pixels, rows by rows, grey for one channel and RGB for three; 64-bit offsets from BIG bytes on."""
    if len(pixels) != h * w * channels:
        raise ValueError("pixels don't fill the image")
    big = len(pixels) >= BIG if big is None else big
    count, word, kind, inline = ("Q", "Q", 16, 8) if big else ("H", "I", 4, 4)
    start = 16 if big else 8
    text = description.encode("ascii", "replace") + b"\0" if description else b""
    after = start + len(pixels) + len(pixels) % 2
    bits = struct.pack(f"<{channels}H", *[8] * channels)
    fields = [(256, kind, [w]), (257, kind, [h]), (258, 3, [8] * channels), (259, 3, [1]), (262, 3, [2 if channels >= 3 else 1]), (273, kind, [start]), (277, 3, [channels]), (278, kind, [h]), (279, kind, [len(pixels)])]
    if channels > 3:
        fields.append((338, 3, [0] * (channels - 3)))
    extra = b"" if len(bits) <= inline else bits
    entries = b""
    for tag, k, values in sorted(fields + ([(270, 2, [text])] if text else [])):
        value = values[0] if k == 2 else struct.pack(f"<{len(values)}{KINDS[k]}", *values)
        if len(value) > inline:
            at = after if tag == 258 else after + len(extra)
            value = struct.pack("<" + word, at)
        entries += struct.pack("<HH" + word, tag, k, len(text) if k == 2 else len(values)) + value.ljust(inline, b"\0")
    directory = after + len(extra) + len(text)
    directory += directory % 2
    head = struct.pack("<2sHHHQ", b"II", 43, 8, 0, directory) if big else struct.pack("<2sHI", b"II", 42, directory)
    body = head + pixels + b"\0" * (len(pixels) % 2) + extra + text
    n = len(entries) // (20 if big else 12)
    return body.ljust(directory, b"\0") + struct.pack("<" + count, n) + entries + struct.pack("<" + word, 0)


def decode(read: Read, page: int = 0) -> tuple[int, int, int, bytes]:
    """(h, w, channels, pixels) of a page of 8-bit samples."""
    form, pages = pages_of(read, page + 1)
    p = Layout(pages[page], form["little_endian"])
    if p.dtype.itemsize != 1:
        raise ValueError("only 8-bit samples are read here")
    return p.height, p.width, p.channels, p.window(read, 0, 0, p.height, p.width).tobytes()


@contextmanager
def opened(path: str) -> Iterator[Read]:
    """read(offset, size) of a file, whatever its name holds."""
    fs, at = filesystem(path)
    with fs.open_input_file(at) as f:
        yield lambda start, n: (f.seek(start), f.read(n))[1]


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """Path and length of the .tif and .tiff files below folder; contents aren't read.

    Spark counts 4 MB for opening any file, so it makes a split of each 32; tasks take
    as many of these as leave spark.sql.shuffle.partitions of them.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{tif,tiff}").load(folder)
    return files.select("path", "length").coalesce(int(spark.conf.get("spark.sql.shuffle.partitions")))


def inspect_tiffs(spark: SparkSession, folder: str, max_pages: int | None = None) -> DataFrame:
    """One row per TIFF file below folder: format, pages (up to max_pages are walked) and the first one's size, sample type and compression, or an error.

    Only headers and directories are read, whatever the size of a file.
    """
    names = ["big", "little_endian", "pages", "width", "height", "bits", "compression", "channels", "dtype", "error"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path in frame.path:
                try:
                    with opened(path) as read:
                        form, pages = pages_of(read, max_pages)
                    first = {k: v[0] for k, v in pages[0].items()} if pages else {}
                    kind = DTYPES.get(first.get("format", 1), "void")
                    rows.append(form | {"pages": len(pages), "dtype": f"{kind}{first.get('bits', 1)}", "channels": first.get("channels", 1)} | {k: first.get(k) for k in ("width", "height", "bits", "compression")})
                except (ValueError, struct.error, OSError) as e:
                    rows.append({"error": str(e)[:200]})
            out = pd.DataFrame({n: pd.Series([r.get(n) for r in rows], dtype=object) for n in names})
            out.insert(0, "path", frame.path)
            yield out

    schema = "path string, big boolean, little_endian boolean, pages int, width long, height long, bits int, compression int, channels int, dtype string, error string"
    return _files(spark, folder).select("path").mapInPandas(run, schema)


def inspect_pages(spark: SparkSession, folder: str, max_pages: int = 4) -> DataFrame:
    """A row for each of the first max_pages pages of each TIFF file below folder: its place, size, samples, compression and layout, or the file's error.

    A page is `reduced` where it is marked as a smaller form of another; pages of one size
    and sample type that aren't are one series, numbered in order of their first pages.
    """
    names = ["path", "page", "series", "width", "height", "channels", "dtype", "compression", "tiled", "reduced", "error"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path in frame.path:
                try:
                    with opened(path) as read:
                        pages = pages_of(read, max_pages)[1]
                    series: dict[tuple, int] = {}
                    for k, p in enumerate(pages):
                        one = {n: v[0] for n, v in p.items() if v}
                        reduced = bool(one.get("subfile", 0) & 1)
                        kind = f"{DTYPES.get(one.get('format', 1), 'void')}{one.get('bits', 1)}"
                        key = (one.get("width"), one.get("height"), one.get("channels", 1), kind)
                        no = None if reduced else series.setdefault(key, len(series))
                        rows.append((path, k, no, *key, one.get("compression", 1), "tile_offsets" in p, reduced, None))
                except (ValueError, struct.error, OSError) as e:
                    rows.append((path, *[None] * 9, str(e)[:200]))
            yield pd.DataFrame(rows, columns=names, dtype=object)

    schema = "path string, page int, series int, width long, height long, channels int, dtype string, compression int, tiled boolean, reduced boolean, error string"
    return _files(spark, folder).select("path").mapInPandas(run, schema)


def read_tiffs(spark: SparkSession, folder: str) -> DataFrame:
    """(path, h, w, channels, pixels, error) of the first page of each small 8-bit TIFF file below folder."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows, held = [], 0
            for path in frame.path:
                row = {"path": path, "h": None, "w": None, "channels": None, "pixels": None, "error": None}
                try:
                    with opened(path) as read:
                        row |= dict(zip(("h", "w", "channels", "pixels"), decode(read), strict=True))
                except (ValueError, KeyError, IndexError, struct.error, OSError) as e:
                    row["error"] = str(e)[:200]
                rows.append(row)
                held += len(row["pixels"] or b"")
                if held >= BATCH:
                    yield pd.DataFrame(rows).astype(kinds)
                    rows, held = [], 0
            if rows:
                yield pd.DataFrame(rows).astype(kinds)

    kinds = {"h": "Int64", "w": "Int64", "channels": "Int64"}
    return _files(spark, folder).select("path").mapInPandas(run, "path string, h long, w long, channels long, pixels binary, error string")


def write_tiffs(images: DataFrame, folder: str, column: str = "pixels") -> DataFrame:
    """Writes images (name, h, w, channels, `column` binary) to folder/name; returns (name, bytes, error).

    A file is written under a name of the task's attempt and moved when complete, so a task
    that runs again, or twice at once, replaces it by its like. Nothing is written until the result is used; names
    are taken as unique, and may hold folders.
    """
    names = ["name", "bytes", "error"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = filesystem(folder)
        draft, made = f".draft-{TaskContext.get().taskAttemptId()}", set()
        for frame in frames:
            rows = []
            for t in frame.itertuples():
                try:
                    data = encode(getattr(t, column), int(t.h), int(t.w), int(t.channels))
                    at = f"{base}/{t.name}"
                    if (parent := at.rsplit("/", 1)[0]) not in made:
                        fs.create_dir(parent, recursive=True)
                        made = {parent}
                    with fs.open_output_stream(at + draft) as f:
                        f.write(data)
                    fs.move(at + draft, at)
                    rows.append((t.name, len(data), None))
                except (ValueError, TypeError, OSError) as e:
                    rows.append((t.name, None, str(e)[:200]))
            yield pd.DataFrame(rows, columns=names).astype({"bytes": "Int64"})

    return images.select("name", "h", "w", "channels", column).mapInPandas(run, "name string, bytes long, error string")


def npy_head(descr: str, shape: tuple[int, ...]) -> bytes:
    """What comes before the values of a .npy file of version 1.0, rows first."""
    head = f"{{'descr': '{descr}', 'fortran_order': False, 'shape': {shape!r}, }}"
    head += " " * (-(len(head) + 11) % 64) + "\n"
    return b"\x93NUMPY\x01\x00" + struct.pack("<H", len(head)) + head.encode()


def npy(array: np.ndarray) -> bytes:
    """An array as a .npy file of version 1.0."""
    return npy_head(array.dtype.str, array.shape) + np.ascontiguousarray(array).tobytes()


def read_coordinates(files: DataFrame) -> DataFrame:
    """(slide_id, npy binary) -> (slide_id, tile_id, row_up, col_up, row_low, col_low): the rows of coordinate files, numbers cut to whole ones."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for slide, raw in zip(frame.slide_id, frame.npy, strict=True):
                at = np.load(io.BytesIO(raw), allow_pickle=False).astype(np.int64).reshape(-1, 4)
                yield pd.DataFrame({"slide_id": slide, "tile_id": np.arange(len(at)), **{c: at[:, k] for k, c in enumerate(COORDINATES)}})

    types = dict(files.dtypes)
    return files.select("slide_id", "npy").mapInPandas(run, f"slide_id {types['slide_id']}, tile_id int, " + ", ".join(f"{c} int" for c in COORDINATES))


def coordinates_npy(coordinates: DataFrame) -> DataFrame:
    """(slide_id, tile_id, row_up, col_up, row_low, col_low) -> (slide_id, npy binary): a slide's coordinates as an int64 (n, 4) file, by tile."""
    each = coordinates.groupBy("slide_id").agg(F.array_sort(F.collect_list(F.struct("tile_id", F.array(*COORDINATES).alias("at")))).alias("rows"))

    @F.pandas_udf("binary")
    def file(rows: pd.Series) -> pd.Series:
        return pd.Series([npy(np.stack([np.asarray(x["at"], np.int64) for x in r])) for r in rows], dtype=object)

    return each.select("slide_id", file("rows").alias("npy"))
