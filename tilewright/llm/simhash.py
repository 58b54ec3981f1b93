"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from .common import small_batches, strings_of, table, written

RADIUS = 3
#: Runs of more fingerprints than this are split by masks again before they are compared.
SPLIT_RUN = 1024
#: Pairs of a bucket that are compared at a time.
PAIRS = 1 << 18


def covering_masks(bits: list[int], radius: int) -> np.ndarray:
    """Masks over the given bit positions: any two values that differ there in at most `radius` bits agree under at least one.

    Bit j gets a vector m(j) of radius + 1 binary digits; for each nonzero vector v, the
    mask holds the bits with odd <m(j), v>. Fewer vectors than digits are always
    orthogonal to some v, so that mask holds none of the bits that differ. Few bits get
    odd vectors alone, so that no mask is left with hardly any bit.
    """
    every = np.arange(1, 2 ** (radius + 1))
    vectors = every[::2] if len(bits) <= 2**radius else every
    place = {b: int(vectors[i % len(vectors)]) for i, b in enumerate(bits)}
    return np.array([sum(1 << b for b in bits if (place[b] & int(v)).bit_count() % 2) for v in every], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes have; 0 for none."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536].astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, width: int = 3) -> int:
    """SimHash of a text's word shingles: a bit is set if over half of the shingle hashes have it."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, 42)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    spans = zip((end - size)[: len(words) - width + 1].tolist(), end[width - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return majority(np.array([digest(joined[a:b], 42) for a, b in spans], "<u8"))


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp long) of (doc_id, text): 64-bit SimHash of the shingles of `width` words.

    One row per row of docs, null and repeated ids included; null and empty texts have
    fingerprint zero, and texts of any length are read whole.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t, width) for t in strings_of(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def _forest(fps: np.ndarray, free: int, radius: int, out: list) -> None:
    """Appends links (value, smaller value) that join all of `fps` (distinct) linked within `radius`."""
    if len(fps) > SPLIT_RUN and free.bit_count() > 2 * radius:
        varying = int(np.bitwise_or.reduce(fps ^ fps[0])) & free
        bits = [b for b in range(64) if varying >> b & 1]
        if len(bits) > 2 * radius:
            for mask in covering_masks(bits, radius):
                key = fps & mask
                order = np.argsort(key, kind="stable")
                at = np.flatnonzero(np.diff(key[order])) + 1
                for part in np.split(order, at):
                    if len(part) > 1:
                        rest = varying & ~int(mask)
                        _forest(fps[part], rest if len(part) < len(fps) else 0, radius, out)
            return
    n, root = len(fps), np.arange(len(fps))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    step = max(1, PAIRS // n)
    for a in range(0, n, step):
        rows, cols = np.nonzero(np.bitwise_count(fps[a : a + step, None] ^ fps[None, a:]) <= radius)
        rows, cols = rows + a, cols + a
        # after each block every entry of root is a root, so pairs that agree there are joined already
        new = (rows < cols) & (root[rows] != root[cols])
        for i, j in zip(rows[new].tolist(), cols[new].tolist(), strict=True):
            if (x := find(i)) != (y := find(j)):
                root[max(x, y)] = min(x, y)
        while (root[root] != root).any():
            root = root[root]
    top = root
    moved = np.flatnonzero(top != np.arange(n))
    if len(moved):
        out.append((fps[moved], fps[top[moved]]))


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Distinct fingerprints (fp) -> links (u, v) whose components are those of all pairs within `radius`.

    Each fingerprint goes to one bucket per covering mask. A bucket emits a spanning
    forest of its links, at most one row per member, so groups of near copies never turn
    into all their pairs; a large bucket is split by masks over the bits that still vary.
    """
    masks = covering_masks(list(range(64)), radius).view(np.int64).tolist()
    keyed = fps.select(
        "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("t", "key")
    )
    by_t = np.array(masks, np.int64).view(np.uint64)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def forest(t: int, run: np.ndarray, out: list) -> None:
            run = np.unique(run)
            if len(run) > 1:
                _forest(run, ~int(by_t[t]) & (2**64 - 1), radius, out)

        def flushed(out: list) -> pa.RecordBatch:
            u, v = (np.concatenate([x[i] for x in out]).view(np.int64) if out else np.array([], np.int64) for i in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        held, held_t, held_key = [], -1, None
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            t, key = batch.column("t").to_numpy(), batch.column("key").to_numpy()
            out: list = []
            if len(fp) == 0:
                continue
            at = np.flatnonzero((np.diff(t) != 0) | (np.diff(key) != 0)) + 1
            starts, ends = np.r_[0, at], np.r_[at, len(fp)]
            if held and (t[0] != held_t or key[0] != held_key):
                forest(held_t, np.concatenate(held), out)
                held = []
            for i in np.flatnonzero((ends - starts > 1) | (np.arange(len(starts)) == 0) | (ends == len(fp))).tolist():
                run = fp[starts[i] : ends[i]]
                if i == 0:
                    run = np.concatenate([*held, run])
                    held = []
                if ends[i] == len(fp):
                    held, held_t, held_key = [run], int(t[starts[i]]), key[starts[i]]
                else:
                    forest(int(t[starts[i]]), run, out)
            yield flushed(out)
        out = []
        if held:
            forest(held_t, np.concatenate(held), out)
        yield flushed(out)

    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartition(parts, "t", "key").sortWithinPartitions("t", "key").mapInArrow(solve, "u long, v long")


def near_rows(key: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one key (rows sorted by key) within `radius` bits, as few as join what all of these join.

    Each row is compared with the next, the second next and so on, all keys at once; rows
    of keys that are joined whole drop out, so groups of near copies end early.
    """
    n = len(key)
    root, at, left, right = np.arange(n), np.arange(n - 1), [], []
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    bucket = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, n]))
    step = 0
    while len(at):
        step += 1
        at = at[: np.searchsorted(at, n - step)]
        at = at[bucket[at + step] == bucket[at]]
        if step & (step - 1) == 0 and len(at):
            whole = np.minimum.reduceat(root, starts) == np.maximum.reduceat(root, starts)
            at = at[~whole[bucket[at]]]
        i = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= radius]
        i = i[root[i] != root[i + step]]
        if len(i):
            x, y = root[i], root[i + step]
            i = i[np.unique(np.minimum(x, y) * n + np.maximum(x, y), return_index=True)[1]]
            left.append(i)
            right.append(i + step)
            while (root[i] != root[i + step]).any():
                x, y = root[i], root[i + step]
                np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
                while (root[root] != root).any():
                    root = root[root]
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return join(left), join(right)


def wide_links(fps: DataFrame, radius: int, cuts: int) -> DataFrame:
    """links() for radii whose masks over all bits would be too many: distinct (fp) -> distinct (u, v).

    The bits are cut into `cuts` ranges. Fingerprints within `radius` bits differ in
    radius // cuts at most in one of them, so they agree under one of its covering masks:
    cuts * (2 ** (radius // cuts + 1) - 1) keys a fingerprint in place of 2 ** (radius + 1) - 1.
    """
    width = 64 // cuts
    masks = np.concatenate([covering_masks(list(range(a, a + width)), radius // cuts) for a in range(0, width * cuts, width)]).view(np.int64).tolist()
    keyed = fps.select("fp", F.explode(F.array(*map(F.lit, masks))).alias("m")).select(F.xxhash64("m", F.col("fp").bitwiseAND(F.col("m"))).alias("key"), "fp")

    def linked(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        i, j = near_rows(key, fp.view(np.uint64), radius)
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(fp[i], fp[j])), pa.array(np.minimum(fp[i], fp[j]))], ["u", "v"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            key, fp = batch.column("key").to_numpy(), batch.column("fp").to_numpy()
            last = int(np.searchsorted(key, key[-1], "left"))
            if last or (held and held[-1][0][-1] != key[0]):
                held.append((key[:last], fp[:last]))
                yield linked(*map(np.concatenate, zip(*held, strict=True)))
                held = []
            held.append((key[last:], fp[last:]))
        if held:
            yield linked(*map(np.concatenate, zip(*held, strict=True)))

    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(solve, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, radius: int = RADIUS, width: int = 3) -> DataFrame:
    """(doc_id, text) -> (doc_id, fingerprint, component_id), one row per row of docs.

    component_id is the smallest doc_id reachable over fingerprints that differ in at
    most `radius` bits. Null and empty texts have fingerprint zero and link like any
    other. Rows that repeat an id share whatever their fingerprints link. A null doc_id
    keeps its row; component_id is null where a component has no other id. Texts of any
    length are read whole, an empty table gives an empty one, and other columns of docs,
    whatever their names, take no part.
    """
    got = written(fingerprints(docs, width).repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    unique = written(got.groupBy("fp").agg(F.min("doc_id").alias("least")))
    root = connected_components(links(unique.select("fp"), radius))
    placed = unique.join(root, unique.fp == root.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    lowest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = placed.join(lowest, "root").select(F.col("fp").alias("_fp"), "component_id")
    return got.join(placed, got.fp == F.col("_fp"), "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
