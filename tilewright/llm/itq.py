"""Near-duplicate vectors: iterative quantisation, multi-index Hamming tables, exact rerank."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.graph import connected_components
from .common import small_batches, table, written

#: Rows, drawn by hash, that rotations are fitted on, and numbers they hold at most.
SAMPLE, SAMPLE_NUMBERS = 8192, 1 << 21
#: Pairs exactly at the bound that some table must bring together, by measure on the sample.
RECALL = 0.998
#: Bits of a rotation's code at most, rounds of its fit, and tables before codes without centring are taken.
BITS, ROUNDS, MAX_TABLES = 64, 20, 256
#: Distinct vectors of a bucket that a task compares with as many others at a time; larger buckets are split.
BLOCK = 1024
#: Pairs whose earlier tables are compared at a time.
PAIRS = 1 << 16


def _units(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square leaves the range of doubles."""
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return x / np.sqrt((x**2).sum(axis=1, keepdims=True))


def rotation(units: np.ndarray, centre: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Directions (columns) whose signs are a balanced code: principal axes, turned until they fit their own signs."""
    x = units - centre
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :BITS]
    x = x @ axes
    turn = np.linalg.qr(rng.standard_normal((axes.shape[1],) * 2))[0]
    for _ in range(ROUNDS):
        u, _, v = np.linalg.svd(np.where(x @ turn >= 0, 1.0, -1.0).T @ x)
        turn = (u @ v).T
    return axes @ turn


def keys_of(units: np.ndarray, centre: np.ndarray, directions: np.ndarray, bits: int) -> np.ndarray:
    """The keys of each row, one for every `bits` directions."""
    signs = (units - centre) @ directions >= 0
    tables = directions.shape[1] // bits
    return (signs[:, : tables * bits].reshape(len(units), tables, bits) << np.arange(bits, dtype=np.int64)).sum(axis=2)


def fit(units: np.ndarray, bound: float, bits: int, recall: float, seed: int = 11) -> tuple[np.ndarray, np.ndarray, int]:
    """(centre, directions, tables): as many tables of `bits` bits as bring together `recall` of pairs at the bound.

    The share is measured: each row of the sample gets a partner at exactly the bound, in
    a random direction. Where centred codes take too many tables (vectors in a narrow
    cone), codes without a centre are taken.
    """
    rng = np.random.default_rng(seed)
    own = units[:2048]
    aside = rng.standard_normal(own.shape)
    aside -= (aside * own).sum(axis=1, keepdims=True) * own
    size = np.linalg.norm(aside, axis=1, keepdims=True)
    partner = bound * own + np.sqrt(1 - bound**2) * np.divide(aside, size, out=np.zeros_like(aside), where=size > 1e-9)
    for centre in (units.mean(axis=0), np.zeros(units.shape[1])):
        directions = np.zeros((units.shape[1], 0))
        missed = np.ones(len(own), bool)
        tables = 0
        while tables < MAX_TABLES or not centre.any():
            directions = np.hstack([directions, rotation(units, centre, rng)])
            found = directions.shape[1] // bits
            for t in range(tables, found):
                cut = directions[:, t * bits : (t + 1) * bits]
                missed &= (keys_of(own, centre, cut, bits) != keys_of(partner, centre, cut, bits))[:, 0]
                if missed.mean() <= 1 - recall:
                    return centre, directions[:, : (t + 1) * bits], t + 1
            tables = found
    raise AssertionError


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The root of each of n places joined by links (a, b)."""
    root = np.arange(n)
    while (root[a] != root[b]).any():
        x, y = root[a], root[b]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
    return root


def distinct_vectors(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (vec_id, h1, h2; hashes null for a vector that takes no part), and distinct vectors (h1, h2, v, copies, least)."""
    single = isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    x = F.col("embedding").cast("array<double>")
    sound = F.col("embedding").isNotNull() & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))) & F.exists(x, lambda e: e != 0)
    kind = "<f4" if single else "<f8"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False).astype(kind) + 0.0, np.cumsum(np.diff(lists.offsets.to_numpy()))
            starts = np.r_[0, ends[:-1]]
            # zeros at the end count for nothing
            v = [np.trim_zeros(flat[i:j], "b").tobytes() if ok else None for i, j, ok in zip(starts.tolist(), ends.tolist(), batch.column("sound").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(v, pa.binary())], ["vec_id", "v"])

    sound = F.coalesce(sound, F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(sound, x).otherwise(F.array().cast("array<double>")).alias("v"), sound.alias("sound"))
    rows = rows.mapInArrow(pack, "vec_id long, v binary")
    rows = written(rows.select("vec_id", "v", F.when(F.col("v").isNotNull(), F.xxhash64("v")).alias("h1"), F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(1), "v")).alias("h2")))
    unique = rows.filter("v IS NOT NULL").groupBy("h1", "h2").agg(F.first("v").alias("v"), F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    return rows.drop("v"), written(unique.withColumn("uid", F.monotonically_increasing_id()).withColumn("kind", F.lit(kind)))


def _unpack(column: pa.Array, kind: str, dim: int) -> np.ndarray:
    raw = column.to_pylist()
    out = np.zeros((len(raw), dim))
    for i, r in enumerate(raw):
        v = np.frombuffer(r, kind)
        out[i, : len(v)] = v
    return out


def links_of(unique: DataFrame, bound: float, recall: float) -> DataFrame:
    """(uid, other, n): links that join all linked vectors (n null), and numbers of linked copies to add up (other null).

    A pair is counted in the first table that brings it together. Buckets of more than
    BLOCK vectors are split into blocks, and each two blocks are compared by one task.
    """
    spark = unique.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = unique.first().kind
    width = int(kind[-1])
    n, dim = unique.agg(F.count("*"), F.max(F.expr(f"length(v) div {width}"))).first()
    drawn = unique.orderBy("h1", "h2").limit(max(64, min(SAMPLE, SAMPLE_NUMBERS // dim))).select("v").toArrow()["v"].combine_chunks()
    bits = int(np.clip(np.ceil(np.log2(n / 8)), 6, 48))
    centre, directions, tables = fit(_units(_unpack(drawn, kind, dim)), bound, bits, recall)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = keys_of(_units(_unpack(batch.column("v"), kind, dim)), centre, directions, bits)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, tables), pa.int32()), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("copies"), batch.column("v"), lists], ["uid", "copies", "v", "keys"])

    coded = written(unique.select("uid", "copies", "v").mapInArrow(encode, "uid long, copies long, v binary, keys array<long>"))
    narrow = coded.select("uid", F.posexplode("keys").alias("t", "key"))
    heavy = narrow.groupBy(F.col("t").alias("_t"), F.col("key").alias("_k")).agg(F.ceil(F.count("*") / BLOCK).alias("cuts")).filter("cuts > 1")
    split = narrow.join(heavy, (F.col("t") == F.col("_t")) & (F.col("key") == F.col("_k"))).groupBy(F.col("uid").alias("_u")).agg(F.map_from_entries(F.collect_list(F.struct("t", "cuts"))).alias("cuts"))
    rows = coded.join(split, F.col("uid") == F.col("_u"), "left").select("uid", "copies", "v", "keys", "cuts", F.posexplode("keys").alias("t", "key"))
    cuts = F.coalesce(F.element_at("cuts", F.col("t")), F.lit(1))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("uid"), cuts)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), cuts - 1)))
    rows = rows.select("uid", "copies", "v", "keys", "t", "key", "own", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
    group = ["t", "key", "a", "b"]

    def compared(batch: pa.RecordBatch) -> tuple[list, list]:
        """Counts and links of one group, whose rows are all here."""
        t, a, b = (batch.column(c)[0].as_py() for c in ("t", "a", "b"))
        uid, copies = batch.column("uid").to_numpy(), batch.column("copies").to_numpy()
        keys = batch.column("keys").flatten().to_numpy().reshape(len(uid), -1)
        side = batch.column("own").to_numpy() == b
        units = _units(_unpack(batch.column("v"), kind, dim))
        count, links = np.zeros(len(uid), np.int64), []
        first, second = (np.arange(len(uid)), np.arange(len(uid))) if a == b else (np.flatnonzero(~side), np.flatnonzero(side))
        for at in range(0, len(first), 256):
            some = first[at : at + 256]
            i, j = np.nonzero(units[some] @ units[second].T >= bound)
            i, j = some[i], second[j]
            if a == b:
                i, j = i[i < j], j[i < j]
            for p in range(0, len(i), PAIRS):
                x, y = i[p : p + PAIRS], j[p : p + PAIRS]
                new = ~(keys[x, :t] == keys[y, :t]).any(axis=1)
                x, y = x[new], y[new]
                count += np.bincount(x, copies[y], len(uid)).astype(np.int64) + np.bincount(y, copies[x], len(uid)).astype(np.int64)
                root = _forest(len(uid), x, y)
                moved = np.flatnonzero(root != np.arange(len(uid)))
                links.append((uid[moved], uid[root[moved]]))
        got = np.flatnonzero(count)
        return [(uid[got], count[got])], links

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(counts: list, links: list) -> pa.RecordBatch:
            join = lambda xs, i: np.concatenate([np.zeros(0, np.int64), *(x[i] for x in xs)])
            u, c, v, w = join(counts, 0), join(counts, 1), join(links, 0), join(links, 1)
            none = lambda m: pa.nulls(m, pa.int64())
            arrays = [pa.array(np.r_[u, v]), pa.concat_arrays([none(len(u)), pa.array(w)]), pa.concat_arrays([pa.array(c), none(len(v))])]
            return pa.RecordBatch.from_arrays(arrays, ["uid", "other", "n"])

        rest: list[pa.RecordBatch] = []
        mark = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([batch.column(c).to_numpy() for c in group])
            cut = np.r_[0, np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1, len(keys)].tolist()
            counts, links = [], []
            for i, j in zip(cut[:-1], cut[1:], strict=True):
                own = tuple(keys[i])
                if rest and mark != own:
                    if sum(r.num_rows for r in rest) > 1:
                        got = compared(pa.concat_batches(rest))
                        counts, links = counts + got[0], links + got[1]
                    rest = []
                rest.append(batch.slice(i, j - i))
                mark = own
            yield out(counts, links)
        if rest:
            yield out(*compared(pa.concat_batches(rest)))

    return written(rows.repartition(parts, *group).sortWithinPartitions(*group).mapInArrow(solve, "uid long, other long, n long"))


def near_vectors(vectors: DataFrame, bound: float = 0.95, recall: float = RECALL) -> DataFrame:
    """(vec_id, embedding) -> (vec_id, n_links, component_id, kept), one row per row of vectors.

    Vectors link where their cosine in double precision is `bound` or more: none below is
    linked, and of pairs at the bound the tables bring together about `recall`, of closer
    ones more. n_links counts the other rows linked directly, component_id is the smallest
    vec_id reachable, kept tells whether that is the row's own. Vectors null, empty, zero
    or holding null or non-finite components link with nothing and are their own
    component; shorter vectors end in zeros. Equal vectors are compared once, with their
    number. Rows that repeat an id are rows each; a null id is counted, never kept, and
    its component_id is null where the component has no other. An empty table gives an
    empty one; other columns, whatever their names, take no part.
    """
    small_batches(vectors.sparkSession)
    rows, unique = distinct_vectors(vectors)
    own = unique.select("uid", "h1", "h2", "least", "copies")
    if unique.isEmpty():
        placed = own.select(F.col("h1").alias("_1"), F.col("h2").alias("_2"), F.lit(0).cast("long").alias("n"), F.col("least").alias("component_id"))
    else:
        links = links_of(unique, bound, recall)
        counts = links.filter("n IS NOT NULL").groupBy(F.col("uid").alias("_u")).agg(F.sum("n").alias("n"))
        roots = connected_components(links.filter("other IS NOT NULL").select(F.col("uid").alias("u"), F.col("other").alias("v")))
        own = own.join(counts, F.col("uid") == F.col("_u"), "left").join(roots, F.col("uid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "uid"))
        least = own.groupBy(F.col("root").alias("_r")).agg(F.min("least").alias("component_id"))
        placed = own.join(least, F.col("root") == F.col("_r")).select(F.col("h1").alias("_1"), F.col("h2").alias("_2"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), "component_id")
    found = rows.join(placed, (F.col("h1") == F.col("_1")) & (F.col("h2") == F.col("_2")), "left")
    component = F.when(F.col("h1").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return found.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def op11_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
