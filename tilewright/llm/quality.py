"""Quality classifier: random-indexing word vectors, pooled per document, under a two-layer network."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, strings_of, table

#: Rows of word vectors (words share rows by hash) and their length.
ROWS, DIM = 1 << 14, 32
#: Labelled rows that the network is fitted on, at most; those with the smallest hashes of their ids.
MAX_LABELLED = 8000
THRESHOLD = 0.7
HIDDEN = 32
#: Chunks whose rows a task remembers.
CACHE = 60_000
#: Rows whose neighbours are summed at a time.
STEP = 256


def index_vectors() -> np.ndarray:
    """A sparse vector for each row: four of its components are +1 or -1."""
    rng = np.random.default_rng(7)
    found = np.zeros((ROWS, DIM), np.float32)
    at = np.argsort(rng.random((ROWS, DIM)), axis=1)[:, :4]
    np.put_along_axis(found, at, rng.choice(np.array([-1, 1], np.float32), (ROWS, 4)), axis=1)
    return found


def _kind(b: int) -> str:
    c = chr(b)
    return "A" if c.isupper() and b < 128 else "a" if c.isalpha() and b < 128 or b >= 128 else "0" if c.isdigit() else c


_KIND = [_kind(b) for b in range(256)]


def _rows(chunk: bytes) -> tuple[int, int]:
    """Rows of a chunk's word (letters in lower case) and of its shape (runs of equal kinds of characters)."""
    shape, last = [], ""
    for b in chunk:
        k = _KIND[b]
        if k != last:
            shape.append(k)
            last = k
    if len(shape) > 1 and shape[:2] == ["A", "a"]:
        shape[0] = ""
    elif shape == ["A"] and len(chunk) > 1:
        shape = ["AA"]
    word = chunk.lower().strip(b".,;:!?\"'()#$%&*|")
    return zlib.crc32(word) % ROWS, zlib.crc32(b"\x00" + "".join(shape).encode()) % ROWS


#: The shape of a word that repeats the one before it.
REPEAT = zlib.crc32(b"\x00again") % ROWS


class Rows:
    """Rows of words and shapes; what a task has seen is remembered up to CACHE chunks."""

    def __init__(self) -> None:
        self.known: dict[bytes, tuple[int, int]] = {}

    def of(self, text: str | None) -> np.ndarray:
        """(n, 2) rows of the words of a text and of their shapes."""
        chunks = (text or "").encode("utf-8", "replace").split()
        known = self.known
        if len(known) > CACHE:
            known.clear()
        for c in set(chunks).difference(known):
            known[c] = _rows(c)
        rows = np.array([known[c] for c in chunks], np.int32).reshape(-1, 2)
        rows[1:][rows[1:, 0] == rows[:-1, 0], 1] = REPEAT
        return rows


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Random indexing over all of docs: each row sums the index vectors of its neighbours' words and shapes.

    The sums are made per task and added up by row; the result has a fixed size whatever
    the corpus. A row's vector is its own index vector plus the direction of its sum.
    """
    base = index_vectors()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, memo = np.zeros((ROWS, DIM), np.float64), Rows()
        for batch in batches:
            held, size = [], 0
            for i, text in enumerate(strings_of(batch.column(0))):
                rows = memo.of(text)
                held.append(rows)
                size += len(rows)
                if size > 100_000 or i == batch.num_rows - 1:
                    pair = [np.zeros(0, np.int64)]
                    for r in held:
                        a, b = r[:-1].astype(np.int64), r[1:].astype(np.int64)
                        for x, y in ((a, b), (b, a)):
                            for k in (0, 1):
                                pair += [x[:, k] * ROWS + y[:, 0], x[:, k] * ROWS + y[:, 1]]
                    keys, n = np.unique(np.concatenate(pair), return_counts=True)
                    held, size, pair = [], 0, []
                    target, source = keys // ROWS, keys % ROWS
                    firsts = np.flatnonzero(np.r_[True, np.diff(target) != 0]) if len(keys) else keys
                    for a in range(0, len(firsts), STEP):
                        lo, hi = firsts[a], firsts[a + STEP] if a + STEP < len(firsts) else len(keys)
                        part = base[source[lo:hi]] * n[lo:hi, None]
                        sums[target[firsts[a : a + STEP]]] += np.add.reduceat(part, firsts[a : a + STEP] - lo, axis=0)
        used = np.flatnonzero(np.abs(sums).sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), *(pa.array(sums[used, k]) for k in range(DIM))], names)

    names = ["row", *(f"c{k}" for k in range(DIM))]
    parts = docs.select(F.col("text").cast("string")).mapInArrow(run, ", ".join(["row int", *(f"{c} double" for c in names[1:])]))
    total = parts.groupBy("row").agg(*[F.sum(c).alias(c) for c in names[1:]]).toPandas()
    vectors = base / 2
    if len(total):
        sums = total[names[1:]].to_numpy(np.float64)
        vectors[total.row.to_numpy()] += (sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)).astype(np.float32)
    return vectors


def pooled(rows: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Means of the vectors of a text's words and of its shapes, and the log of its length; zeros for the empty text."""
    if not len(rows):
        return np.zeros(2 * DIM + 1, np.float32)
    sums = []
    for k in (0, 1):
        used, n = np.unique(rows[:, k], return_counts=True)
        sums.append(n.astype(np.float32) @ vectors[used] / len(rows))
    return np.concatenate([*sums, [np.log1p(len(rows)) / 10]]).astype(np.float32)


class Network(NamedTuple):
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.mean) / self.scale @ self.w1 + self.b1, 0)
        return hidden @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, vectors: np.ndarray, epochs: int = 150) -> Network:
    """Two layers by Adam on three quarters of the rows; the temperature by least log loss on the others.

    Without rows of both labels there is nothing to learn: the score is the share of
    label 1 (0.5 without any rows).
    """
    rng = np.random.default_rng(11)
    d = x.shape[1]
    if len(np.unique(y)) < 2:
        share = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
        return Network(vectors, np.zeros(d), np.ones(d), np.zeros((d, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))), 1.0)
    order = rng.permutation(len(y))
    hold, train = order[: len(y) // 4], order[len(y) // 4 :]
    if len(np.unique(y[train])) < 2 or not len(hold):
        hold = train = order
    mean, scale = x[train].mean(axis=0), x[train].std(axis=0) + 1e-3
    p = [rng.normal(0, 1, (d, HIDDEN)) / np.sqrt(d), np.zeros(HIDDEN), rng.normal(0, 1, HIDDEN) / np.sqrt(HIDDEN), np.zeros(1)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    z = ((x - mean) / scale).astype(np.float64)
    for epoch in range(epochs):
        rate = 5e-3 * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        mixed = rng.permutation(train)
        for at in range(0, len(mixed), 128):
            i = mixed[at : at + 128]
            h = np.maximum(z[i] @ p[0] + p[1], 0)
            g = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -40, 40))) - y[i]) / len(i)
            back = np.outer(g, p[2]) * (h > 0)
            grads = [z[i].T @ back + 1e-4 * p[0], back.sum(axis=0), h.T @ g + 1e-4 * p[2], np.array([g.sum()])]
            step += 1
            for k, grad in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad**2
                p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    raw = Network(vectors, mean, scale, p[0], p[1], p[2], float(p[3][0]), 1.0)
    logit = raw.logits(x[hold])
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 80))
    loss = [np.logaddexp(0, np.where(y[hold] == 1, -1, 1) * np.clip(logit / t, -40, 40)).mean() for t in grid]
    return raw._replace(temperature=float(grid[int(np.argmin(loss))]))


def held_out(doc_id: Column) -> Column:
    """Rows that no label may be learnt from: crc32 of the id as text leaves 2 by 4. False for null ids."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Network:
    """A network for docs (doc_id, text) by labels (doc_id, quality), without those that held_out() names.

    Word vectors come from all of docs, whole texts, repeated rows and null ids included;
    null texts count as empty. Of the labels, at most max_labelled take part; ids with
    several labels count by their mean, at 0.5 as 1; null ids and labels don't count. Rows
    of docs that share a labelled id count by their mean. Without labelled rows the network
    scores 0.5; an empty table gives such a network.
    """
    small_batches(docs.sparkSession)
    vectors = word_vectors(docs)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("_id")).agg((F.avg("quality") >= 0.5).cast("double").alias("y"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(max_labelled)

    @F.pandas_udf("array<float>")
    def pool(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo = Rows()
        for text in texts:
            yield pd.Series([pooled(memo.of(t), shared.value) for t in text], dtype=object)

    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(known), F.col("doc_id") == F.col("_id"))
    # rows of one id are averaged where they are, so that the driver gets one for each label
    # of an outer explode no filter follows that would pool all of docs before they meet the labels
    each = chosen.select("_id", "y", pool("text").alias("x")).select("_id", "y", F.posexplode_outer("x").alias("place", "v"))
    each = each.groupBy("_id", "y", "place").agg(F.avg(F.col("v").cast("double")).cast("float").alias("v"))
    rows = each.groupBy("_id", "y").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "v"))), lambda p: p["v"]).alias("x"))
    rows = rows.toPandas().sort_values("_id", kind="stable")
    x = np.stack(rows.x.to_list()).astype(np.float64) if len(rows) else np.zeros((0, 2 * DIM + 1))
    return fit(x, rows.y.to_numpy(np.float64), vectors)


def score_of(text: Column, network: Network, spark: SparkSession) -> Column:
    """The network's score of each text; null texts score as empty."""
    shared = spark.sparkContext.broadcast(network)

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        net, memo = shared.value, Rows()
        for text in texts:
            x = np.stack([pooled(memo.of(t), net.vectors) for t in text]) if len(text) else np.zeros((0, 2 * DIM + 1))
            yield pd.Series(net.score(x.astype(np.float64)))

    return scored(text.cast("string"))


def score(docs: DataFrame, network: Network, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, text) -> (doc_id, held_out, score, predicted), one row per row of docs.

    Null texts score as empty; texts of any length are read whole; null ids are not held
    out; rows that repeat score alike; an empty table gives an empty one. Other columns
    of docs, whatever their names, take no part.
    """
    scored = score_of(F.col("text"), network, docs.sparkSession).alias("score")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), scored)
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that the classifier doesn't reject, with all their columns."""
    return docs.filter(score_of(F.col("text"), train(docs, labels), docs.sparkSession) >= threshold)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
