"""Segments of TIFF pages: decoding, and the bytes of a window from the segments below it."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np

Read = Callable[[int, int], bytes]

#: Compression numbers of the TIFF 6.0 specification and its supplements.
NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
#: Compressed bytes that are taken from a stream at a time.
CHUNK = 1 << 20


def unpack_bits(data: bytes) -> bytes:
    out, at = bytearray(), 0
    while at < len(data):
        n = data[at]
        at += 1
        if n < 128:
            out += data[at : at + n + 1]
            at += n + 1
        elif n > 128:
            out += data[at : at + 1] * (257 - n)
            at += 1
    return bytes(out)


def unpack_lzw(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, high bits first, that grow one entry early; 256 clears the table, 257 ends."""
    single = [bytes([i]) for i in range(256)]
    table: list[bytes] = []
    out: list[bytes] = []
    bits = held = at = 0
    width, last = 9, b""
    while True:
        while bits < width:
            if at >= len(data):
                return b"".join(out)
            held = (held << 8 | data[at]) & 0xFFFFFFFF
            at, bits = at + 1, bits + 8
        code = held >> (bits - width) & ((1 << width) - 1)
        bits -= width
        if code == 257:
            return b"".join(out)
        if code == 256:
            table, width, last = [], 9, b""
            continue
        if code < 256:
            entry = single[code]
        elif code - 258 < len(table):
            entry = table[code - 258]
        elif code - 258 == len(table) and last:
            entry = last + last[:1]
        else:
            raise ValueError("broken LZW data")
        out.append(entry)
        if last:
            table.append(last + entry[:1])
        last = entry
        if len(table) + 259 >= 1 << width and width < 12:
            width += 1


def _pieces(read: Read, at: int, size: int) -> Iterator[bytes]:
    for start in range(at, at + size, CHUNK):
        yield read(start, min(CHUNK, at + size - start))


def inflated(read: Read, at: int, size: int, first: int, stop: int) -> bytes:
    """Bytes first to stop of a Deflate segment; what lies before is passed over, so memory stays bounded."""
    stream, seen, out = zlib.decompressobj(), 0, []
    for piece in _pieces(read, at, size):
        while piece and seen < stop:
            got = stream.decompress(piece, CHUNK)
            piece = stream.unconsumed_tail
            if seen + len(got) > first:
                out.append(got[max(0, first - seen) : stop - seen])
            seen += len(got)
            if not got and not piece:
                break
        if seen >= stop:
            break
    return b"".join(out)


class Layout:
    """Where the samples of a page lie: segments (strips or tiles) of h x w pixels, `per_row` of them side by side."""

    def __init__(self, page: dict, little: bool):
        one = lambda name, default=None: page.get(name, [default])[0]
        self.height, self.width, self.channels = one("height"), one("width"), one("channels", 1)
        bits = set(page.get("bits", [1]))
        self.compression, self.predictor = one("compression", NONE), one("predictor", 1)
        if not self.height or not self.width or len(bits) != 1 or (size := bits.pop()) not in (8, 16, 32, 64):
            raise ValueError("no page of samples of whole bytes")
        if self.compression not in (NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS) or self.predictor not in (1, 2) or (one("planar", 1) != 1 and self.channels > 1):
            raise ValueError(f"compression {self.compression}, predictor {self.predictor} or separate planes aren't read")
        kind = {1: "u", 2: "i", 3: "f"}.get(one("format", 1), "u")
        self.dtype = np.dtype(f"{'<' if little else '>'}{kind}{size // 8}")
        tiled = "tile_offsets" in page
        self.h, self.w = (one("tile_h"), one("tile_w")) if tiled else (min(one("rows") or self.height, self.height), self.width)
        self.tiled, self.per_row = tiled, -(-self.width // self.w)
        self.offsets, self.counts = page["tile_offsets" if tiled else "offsets"], page["tile_counts" if tiled else "counts"]
        if len(self.offsets) != self.per_row * -(-self.height // self.h):
            raise ValueError("segments don't fill the page")

    def kept(self, first: int, stop: int) -> Layout:
        """The same with the offsets of the segments of rows first to stop alone."""
        out = object.__new__(Layout)
        out.__dict__ |= self.__dict__
        a, b = first // self.h * self.per_row, -(-stop // self.h) * self.per_row
        out.offsets, out.counts = ({i: v for i, v in enumerate(x[a:b], a)} for x in (self.offsets, self.counts))
        return out

    def rows_of(self, read: Read, segment: int, first: int, stop: int, left: int, right: int) -> np.ndarray:
        """Rows first to stop and columns left to right of a segment, as (rows, columns, channels)."""
        at, size = self.offsets[segment], self.counts[segment]
        pixel = self.channels * self.dtype.itemsize
        line = self.w * pixel
        shape = (stop - first, self.w, self.channels)
        if size == 0:  # a segment that was never written
            return np.zeros((stop - first, right - left, self.channels), self.dtype)
        if self.compression == NONE and self.predictor == 1 and (right - left) * 2 < self.w:
            raw = b"".join(read(at + r * line + left * pixel, (right - left) * pixel) for r in range(first, stop))
            return np.frombuffer(raw, self.dtype).reshape(stop - first, right - left, self.channels)
        if self.compression == NONE:
            raw = read(at + first * line, (stop - first) * line)
        elif self.compression in (DEFLATE, OLD_DEFLATE):
            raw = inflated(read, at, size, first * line, stop * line)
        else:
            raw = (unpack_lzw if self.compression == LZW else unpack_bits)(read(at, size))[first * line : stop * line]
        x = np.frombuffer(raw, self.dtype).reshape(shape)
        if self.predictor == 2:
            x = np.cumsum(x, axis=1, dtype=x.dtype)
        return x[:, left:right]

    def window(self, read: Read, up: int, left: int, low: int, right: int) -> np.ndarray:
        """Rows up to low and columns left to right of the page; only segments below them are read, one at a time."""
        out = np.empty((low - up, right - left, self.channels), self.dtype.newbyteorder("<"))
        for sy in range(up // self.h, -(-low // self.h)):
            top = sy * self.h
            for sx in range(left // self.w, -(-right // self.w)):
                side = sx * self.w
                a, b = max(up, top), min(low, top + self.h, self.height)
                c, d = max(left, side), min(right, side + self.w)
                out[a - up : b - up, c - left : d - left] = self.rows_of(read, sy * self.per_row + sx, a - top, b - top, c - side, d - side)
        return out
