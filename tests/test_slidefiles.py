"""Large TIFF files by windows, slide files by blocks, and paths as slides have them."""

import io
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.sources import codecs, slidefiles, tiff, windows

NAME = "3063_22_#42_BS_Iron/50 % done"


def blocks_of(image, block):
    h, w = image.shape[:2]
    for gy in range(-(-h // block)):
        for gx in range(-(-w // block)):
            tile = np.zeros((block, block, *image.shape[2:]), image.dtype)
            part = image[gy * block : (gy + 1) * block, gx * block : (gx + 1) * block]
            tile[: part.shape[0], : part.shape[1]] = part
            yield gy, gx, tile


def image_of(seed, h, w, channels=3):
    return np.random.default_rng(seed).integers(0, 256, (h, w, channels), dtype=np.uint8)


def joined(rows, h, w, channels, dtype="u1"):
    out = np.zeros((h, w, channels), dtype)
    for r in rows:
        assert r.error is None
        out[r.row_up : r.row_low, r.col_up : r.col_low] = np.frombuffer(r.pixels, dtype).reshape(r.h, r.w, r.channels)
    return out


@pytest.mark.parametrize("compress", [True, False])
def test_slides_of_several_blocks(spark, tmp_path, compress):
    folder = tmp_path / NAME
    big, small = image_of(1, 75, 50), image_of(2, 38, 25)
    rows = [("a#1.tif", lev, gy, gx, *x.shape, t.tobytes()) for lev, x in ((0, big), (1, small)) for gy, gx, t in blocks_of(x, 16)]
    rows = [r for r in rows if r[1:4] != (0, 2, 1)]  # a block that is missing
    big[32:48, 16:32] = 0
    rows += [("b/c d.tif", 0, gy, gx, 40, 40, 1, t.tobytes()) for gy, gx, t in blocks_of(image_of(3, 40, 40, 1), 16)]
    df = spark.createDataFrame(rows, "name string, level int, gy int, gx int, h int, w int, channels int, pixels binary")
    slidefiles.write_slides(df.repartition(5), str(folder), 16, compress=compress)
    assert sorted(p.name for p in folder.iterdir()) == ["a#1.tif", "b"]
    for page, x in ((0, big), (1, small)):
        got = windows.read_windows(spark, str(folder / "a#1.tif"), 20, page).collect()
        assert (joined(got, *x.shape) == x).all()
        assert len(got) == -(-x.shape[0] // 20) * -(-x.shape[1] // 20)
    assert {r.pages for r in tiff.inspect_tiffs(spark, str(folder)).collect()} == {1, 2}
    assert {r.h for r in tiff.read_tiffs(spark, str(folder)).collect()} == {75, 40}
    (folder / "broken.tif").write_bytes(b"no image")
    pages = sorted((r.path.rsplit("/", 1)[1], r.page, r.series, r.width, r.height, r.channels, r.dtype, r.compression, r.tiled, r.reduced, r.error is None) for r in tiff.inspect_pages(spark, str(folder)).collect())
    kind = 8 if compress else 1
    assert pages == [
        ("a#1.tif", 0, 0, 50, 75, 3, "uint8", kind, True, False, True), ("a#1.tif", 1, None, 25, 38, 3, "uint8", kind, True, True, True),
        ("broken.tif", *[None] * 9, False), ("c d.tif", 0, 0, 40, 40, 1, "uint8", kind, True, False, True),
    ]


def test_failed_write_leaves_nothing(spark, tmp_path):
    good = [("a.tif", 0, 0, 16, 16, bytes(256))]
    df = spark.createDataFrame(good, "name string, gy int, gx int, h int, w int, pixels binary").withColumn("h", F.when(F.col("gx") == 0, F.raise_error(F.lit("broken"))).cast("int"))
    with pytest.raises(Exception, match="broken"):
        slidefiles.write_slides(df, str(tmp_path), 16)
    assert list(tmp_path.iterdir()) == []


def test_heatmap_files(spark, tmp_path):
    values = np.random.default_rng(5).random((21, 13))
    rows = [("s.x", gy, gx, 21, 13, t.tobytes()) for gy, gx, t in blocks_of(values, 8)]
    rows = [r for r in rows if r[2] != 1 and r[1] != 1]  # a whole strip either way
    values[:, 8:] = values[8:16] = 0
    df = spark.createDataFrame(rows, "name string, gy int, gx int, h int, w int, pixels binary")
    slidefiles.write_slides(df, str(tmp_path / "n"), 8, kind="nifti", scale=(0.5, 0.25, 2.0))
    raw = (tmp_path / "n/s.x").read_bytes()
    assert struct.unpack_from("<3h", raw, 40) == (2, 21, 13) and struct.unpack_from("<4f", raw, 296) == (0, 0.25, 0, 0)
    assert (np.frombuffer(raw, "<f8", offset=352).reshape(21, 13, order="F") == values).all()
    slidefiles.write_slides(df, str(tmp_path / "y"), 8, kind="npy")
    assert (np.load(io.BytesIO((tmp_path / "y/s.x").read_bytes())) == values).all()


def strips(image, rows, pack, compression, predictor=1, order="<"):
    """A TIFF file of strips made by `pack`."""
    h, w, n = image.shape
    x = image.astype(image.dtype.newbyteorder(order))
    if predictor == 2:
        x = np.concatenate([x[:, :1], np.diff(x, axis=1)], axis=1).astype(x.dtype)
    made = [pack(np.ascontiguousarray(x[r : r + rows]).tobytes()) for r in range(0, h, rows)]
    at, body = [], b"\0" * 8
    for m in made:
        at.append(len(body))
        body += m
    fields = [(256, [w]), (257, [h]), (258, [image.dtype.itemsize * 8] * n), (259, [compression]), (273, at), (277, [n]), (278, [rows]), (279, list(map(len, made))), (317, [predictor])]
    entries, extra, start = b"", b"", len(body)
    for tag, values in fields:
        raw = struct.pack(f"{order}{len(values)}I", *values)
        value = raw if len(values) == 1 else struct.pack(order + "I", start + len(extra))
        extra += b"" if len(values) == 1 else raw
        entries += struct.pack(order + "HHI", tag, 4, len(values)) + value
    head = (b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, start + len(extra))
    return head + body[8:] + extra + struct.pack(order + "H", len(fields)) + entries + struct.pack(order + "I", 0)


def pack_bits(data):
    return b"".join(bytes([len(data[i : i + 100]) - 1]) + data[i : i + 100] if len(set(data[i : i + 100])) > 1 else bytes([257 - len(data[i : i + 100]) if len(data[i : i + 100]) > 1 else 0, data[i]]) for i in range(0, len(data), 100))


def pack_lzw(data):
    table, width, bits, held, out, last = {bytes([i]): i for i in range(256)}, 9, 0, 0, bytearray(), b""

    def put(code):
        nonlocal bits, held
        held, bits = held << width | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append(held >> bits & 255)

    put(256)
    size = 258
    for i in range(len(data)):
        nxt = last + data[i : i + 1]
        if nxt in table:
            last = nxt
            continue
        put(table[last])
        table[nxt] = size
        size += 1
        width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
        if size == 4094:
            put(256)
            table, width, size = {bytes([j]): j for j in range(256)}, 9, 258
        last = data[i : i + 1]
    if last:
        put(table[last])
        size += 1
        width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
    put(257)
    if bits:
        out.append(held << (8 - bits) & 255)
    return bytes(out)


@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("dtype", ["u1", "u2"])
def test_strips_of_every_kind(spark, tmp_path, dtype, order):
    image = (image_of(4, 60, 45).astype(dtype) * (257 if dtype == "u2" else 1)) // 16 * 16
    for k, (pack, number) in enumerate([(bytes, 1), (zlib.compress, 8), (pack_bits, 32773), (pack_lzw, 5)]):
        for predictor in (1, 2):
            (tmp_path / f"x{k}#{predictor}.tif").write_bytes(strips(image, 7, pack, number, predictor, order))
    (tmp_path / "broken.tif").write_bytes(b"II*\0\0")
    (tmp_path / "jpeg.tiff").write_bytes(strips(image, 60, bytes, 7, 1, order))
    got = windows.read_windows(spark, str(tmp_path), 25).collect()
    for k in range(4):
        for predictor in (1, 2):
            assert (joined([r for r in got if r.path.endswith(f"x{k}#{predictor}.tif")], 60, 45, 3, f"<{dtype}") == image).all()
    assert sorted(r.path[-8:] for r in got if r.error) == ["oken.tif", "peg.tiff"]


def test_window_of_a_file_of_five_gigabytes(spark, tmp_path):
    """A sparse file with one strip; only the rows of the windows asked for are read."""
    side, path = 72_000, tmp_path / "large #1.tif"
    tile = image_of(6, 50, 40, 1)
    with path.open("wb") as f:
        fields = [(256, 16, side), (257, 16, side), (258, 3, 8), (259, 3, 1), (273, 16, 4096), (277, 3, 1), (278, 16, side), (279, 16, side * side)]
        f.write(struct.pack("<2sHHHQQ", b"II", 43, 8, 0, 16, len(fields)) + b"".join(struct.pack("<HHQQ", t, k, 1, v) for t, k, v in fields) + struct.pack("<Q", 0))
        for r in range(50):
            f.seek(4096 + (71_950 + r) * side + 71_960)
            f.write(tile[r].tobytes())
        f.truncate(4096 + side * side)
    n = 72_000 // 1000
    got = windows.read_windows(spark, str(path), 1000, tile_ids=[n * n - 1]).collect()
    assert [r.error for r in got] == [None]
    x = np.frombuffer(got[0].pixels, np.uint8).reshape(1000, 1000)
    assert (x[-50:, -40:] == tile[..., 0]).all() and x[:-50].max() == 0


def test_deflate_stream_is_read_in_bounded_pieces():
    raw = np.random.default_rng(1).integers(0, 9, 5 << 20, dtype=np.uint8).tobytes()
    packed = zlib.compress(raw, 1)
    read = lambda at, n: packed[at : at + n]
    assert codecs.inflated(read, 0, len(packed), 4_000_001, 4_500_000) == raw[4_000_001:4_500_000]
