"""Near duplicates by the Jaccard similarity of word shingles: covering SimHash, MinHash bands for what lies beyond its radius, an exact check of both."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from .common import filter_of, small_batches, strings_of, written
from .simhash import majority, wide_links

#: Words of a shingle, and the similarity from which texts are near duplicates.
WIDTH, SIMILARITY = 5, 0.8
#: Bits of 64 in which fingerprints may differ, and ranges that the bits are cut into: 126 keys a fingerprint.
RADIUS, CUTS = 11, 2
#: Hashes of a band and bands: two sets at similarity 0.8 share a band but for 7 cases in a million.
BAND, BANDS = 5, 30
#: Hashes of 150 that must agree before sets are compared; at similarity 0.8 the mean is 120, five standard deviations more.
AGREE = 96
_MULTIPLIERS = np.random.default_rng(11).integers(0, 2**63, BAND * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.random.default_rng(12).integers(0, 2**63, BAND * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles of `width` words; of all its words if they are fewer, none if it has none."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    n = max(1, len(words) - width + 1)
    spans = zip((end - size)[:n].tolist(), end[min(width, len(words)) - 1 :].tolist(), strict=True)
    return np.unique(np.array([xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in spans], np.uint64))


def min_hashes(found: np.ndarray) -> np.ndarray:
    """One minimum for each multiplier; all ones for an empty set."""
    least = np.full(BAND * BANDS, 2**64 - 1, np.uint64)
    for a in range(0, len(found), 1024):
        np.minimum(least, (found[a : a + 1024, None] * _MULTIPLIERS[None]).min(axis=0), out=least)
    return least


def _signed(docs: DataFrame) -> DataFrame:
    """(doc_id, dkey, sid, fp, size, marks, bands), one row per row of docs; sid stands for the set of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sid, fp, size, marks, bands = [], [], [], [], []
            for text in strings_of(batch.column(2)):
                found = shingles(text)
                least = min_hashes(found)
                sid.append(xxhash.xxh64_intdigest(found.tobytes(), 1))
                fp.append(majority(found))
                size.append(len(found))
                marks.append((least * _MIX >> np.uint64(56)).astype(np.uint8).tobytes())
                raw = least.tobytes()
                bands += [xxhash.xxh64_intdigest(raw[8 * BAND * t : 8 * BAND * (t + 1)], t) for t in range(BANDS)]
            flat = pa.array(np.array(bands, np.uint64).view(np.int64))
            offsets = pa.array(np.arange(0, len(bands) + 1, BANDS, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(np.array(x, np.uint64).view(np.int64)) for x in (sid, fp)), pa.array(size, pa.int32()), pa.array(marks, pa.binary()), pa.ListArray.from_arrays(offsets, flat)],
                ["doc_id", "dkey", "sid", "fp", "size", "marks", "bands"],
            )

    return docs.mapInArrow(run, "doc_id long, dkey long, sid long, fp long, size int, marks binary, bands array<long>")


def _pairs_of(sid: np.ndarray, size: np.ndarray, marks: np.ndarray, label: np.ndarray, spanning: bool) -> tuple[np.ndarray, np.ndarray]:
    """Likely pairs between rows of different labels: all of them, or (spanning) as many as join what they link."""
    left, right = [], []
    label = label.copy()
    for i in range(len(sid)):
        other = label != label[i]
        if not spanning:
            other[: i + 1] = False
        elif not other.any():
            break
        j = np.flatnonzero(other)
        j = j[np.minimum(size[j], size[i]) >= SIMILARITY * np.maximum(size[j], size[i]) - 1e-9]
        j = j[(marks[j] == marks[i]).sum(axis=1) >= AGREE]
        if not len(j):
            continue
        if spanning:
            labels, at = np.unique(label[j], return_index=True)
            j = j[at]
            label[np.isin(label, labels)] = label[i]
        left.append(np.full(len(j), sid[i]))
        right.append(sid[j])
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return join(left), join(right)


def _likely(members: DataFrame, spanning: bool) -> DataFrame:
    """(key, sid, size, marks, root) of the buckets -> distinct likely pairs (a, b), a < b, between sets of different roots."""

    def solve(held: list) -> pa.RecordBatch:
        sid, size, root = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("sid", "size", "root"))
        if len(sid) < 2 or (root == root[0]).all():
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, ["a", "b"])
        marks = np.concatenate([np.frombuffer(b"".join(b.column("marks").to_pylist()), np.uint8) for b in held]).reshape(len(sid), -1)
        a, b = _pairs_of(sid, size, marks, root, spanning)
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_key = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("key").to_numpy()
            cuts = np.r_[0, np.flatnonzero(np.diff(key)) + 1, len(key)].tolist()
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if held and key[a] != held_key:
                    yield solve(held)
                    held = []
                held.append(batch.slice(a, b - a))
                held_key = key[a]
        if held:
            yield solve(held)

    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return members.repartition(parts, "key").sortWithinPartitions("key", "sid").mapInArrow(run, "a long, b long").distinct()


def _covered(unique: DataFrame) -> DataFrame:
    """(sid, fp) -> pairs (a, b), a < b, of sets that join what fingerprints within RADIUS bits link."""
    first = written(unique.groupBy("fp").agg(F.min("sid").alias("low")))
    near = wide_links(first.select("fp"), RADIUS, CUTS)
    u, v = (first.select(F.col("fp").alias(n), F.col("low").alias(s)) for n, s in (("u", "x"), ("v", "y")))
    near = near.join(u, "u").join(v, "v").select("x", "y")
    equal = unique.select("sid", "fp").join(first, "fp").filter("sid <> low").select(F.col("low").alias("x"), F.col("sid").alias("y"))
    return near.unionByName(equal).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def _similar(pairs: DataFrame, keyed: DataFrame, unique: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets have SIMILARITY, by the sets themselves."""
    ends = pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))).distinct()
    wanted = written(unique.join(ends, "sid", "left_semi").select("sid", F.col("least.dkey").alias("h")))
    shared = pairs.sparkSession.sparkContext.broadcast(filter_of(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, mask = shared.value
        for batch in batches:
            h = batch.column(0).to_numpy()
            bit = h & mask
            at = np.flatnonzero(bits[bit // 63] >> (bit % 63) & 1)
            for a in range(0, len(at), 512):
                part = pa.array(at[a : a + 512])
                sets = [shingles(t).tobytes() for t in batch.column(1).take(part).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(part), pa.array(sets, pa.binary())], ["h", "found"])

    @F.pandas_udf("boolean")
    def close(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for p, q in zip(x, y, strict=True):
            p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
            both = len(np.intersect1d(p, q, assume_unique=True))
            out.append(both >= SIMILARITY * (len(p) + len(q) - both) - 1e-9)
        return pd.Series(out, dtype=bool)

    sets = keyed.select(F.col("dkey").alias("h"), "text").mapInArrow(run, "h long, found binary")
    sets = written(sets.join(wanted, "h").groupBy("sid").agg(F.max("found").alias("found")))
    x, y = sets.select(F.col("sid").alias("a"), F.col("found").alias("x")), sets.select(F.col("sid").alias("b"), F.col("found").alias("y"))
    return pairs.join(x, "a").join(y, "b").filter(close("x", "y")).select("a", "b")


def _joined(links: DataFrame) -> DataFrame:
    return written(connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """docs with one row of each group of near duplicates: the first by doc_id (null last), then by a hash of id and text.

    Near duplicates are rows whose texts' sets of five-word shingles (letters of ASCII in
    lower case) have a Jaccard similarity of 0.8 or more; groups are what such pairs join.
    Equal sets, those of texts without words among them (null, empty or blank), are near
    duplicates; rows that repeat id and text are one row; texts of any length are compared
    whole; an empty table gives an empty one. All columns of docs are kept, whatever their
    names; of rows equal in id and text any one's other columns stay.

    Covering SimHash goes first: sets whose fingerprints differ in RADIUS bits or fewer all
    meet, and as few pairs as join them are compared by their sets. Some similar sets have
    fingerprints further apart, so sets that aren't joined yet meet in buckets by bands of
    their minimal hashes too. A bucket first passes on as few likely pairs as join its
    members, which are compared likewise. Then it passes on every likely pair that the
    pairs found similar haven't joined, so a pair that failed leaves no gap, and groups of
    near copies never turn into all their pairs.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    dkey = F.xxhash64(F.col("doc_id").cast("long"), text)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), dkey.alias("dkey"), text.alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    signed = written(_signed(keyed.repartition(parts)))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "dkey")
    unique = written(signed.groupBy("sid").agg(F.min(order).alias("least"), F.first("fp").alias("fp"), F.first("size").alias("size"), F.first("marks").alias("marks"), F.first("bands").alias("bands")))
    rows = unique.select("sid", F.explode("bands").alias("key"))
    several = rows.groupBy("key").agg(F.min("sid").alias("_low"), F.max("sid").alias("_high")).filter("_low <> _high").select("key")
    members = written(rows.join(several, "key").join(unique.select("sid", "size", "marks"), "sid"))
    links = written(_similar(written(_covered(unique)), keyed, unique))
    root = _joined(links)
    for spanning in (True, False):
        placed = members.join(root, F.col("sid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "sid")).drop("node")
        more = written(_likely(placed, spanning))
        if more.take(1):
            links = written(links.unionByName(_similar(more, keyed, unique)))
            root = _joined(links)
    group = unique.join(root, F.col("sid") == F.col("node"), "left").select("least", F.coalesce("root", "sid").alias("root"))
    kept = group.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.dkey").alias("_kept"))
    rows = docs.select(F.struct("*").alias("row"), dkey.alias("key")).join(kept, F.col("key") == F.col("_kept"), "left_semi")
    return rows.dropDuplicates(["key"]).select("row.*")
