"""Exact top-k search by inner product: a Voronoi join of queries and data."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, small_batches, table

#: Rows of a cell on average, and the most pivots; both bound what is broadcast, not what is found.
CELL_ROWS, MAX_PIVOTS = 2048, 1024
#: Rows of a data group and of a query group, at most on average; a task holds one of each.
BLOCK_ROWS, QUERY_ROWS = 1 << 15, 4096
#: Scores that are held at a time.
SCORES = 1 << 21
_SAFE = float(1 << 52)


def integer_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, embedding) -> (vec_id, v array<long>): floor(scale * x), without rows that are null or hold null, NaN or infinity."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(fine)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(e * scale)).alias("v"))


def _stack(column: pd.Series, dim: int) -> np.ndarray:
    """Rows as float64; shorter ones end in zeros."""
    if len(column) and all(len(v) == dim for v in column):
        return np.stack(column.to_list()).astype(np.float64)
    out = np.zeros((len(column), dim))
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def _best(q: np.ndarray, x: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, data row, score) of the k best data rows of each query, rows of the query's own id aside; ids ascend."""
    n = len(ids)
    rows, cols, scores = [], [], []
    bound = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(q.shape[1], 1)
    step = max(1, SCORES // max(n, 1))
    for a in range(0, len(q), step):
        if bound < _SAFE:
            s = (q[a : a + step] @ x.T).astype(np.int64)
        else:
            s = q[a : a + step].astype(np.int64) @ x.T.astype(np.int64)
        mine = own[a : a + step, None] == ids[None]
        # one number orders by score, then by smaller id
        span = int(np.abs(s).max(initial=0)) + 1
        if span < (1 << 62) // max(n, 1):
            key = s * n + np.arange(n - 1, -1, -1)
            key[mine] = np.iinfo(np.int64).min
            top = np.argpartition(key, n - k, axis=1)[:, n - k :] if n > k else np.broadcast_to(np.arange(n), s.shape)
        else:
            top = np.stack([np.lexsort((np.arange(n), -r.astype(np.float64), -r, m))[:k] for r, m in zip(s, mine, strict=True)])
        r = np.broadcast_to(np.arange(len(s))[:, None], top.shape)
        ok = ~mine[r, top]
        rows.append(r[ok] + a)
        cols.append(top[ok])
        scores.append(s[r, top][ok])
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return join(rows), join(cols), join(scores)


def groups_of(counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """First group of each cell and the number of groups that it is cut into by hash, from its number of rows.

    Neighbouring cells share a group of at most `most` rows; a cell with more has groups of its own.
    """
    cuts = np.maximum(1, -(-counts // most))
    first, at, room = np.zeros(len(counts), np.int64), -1, 0
    for cell, n in enumerate(counts.tolist()):
        if cuts[cell] > 1:
            first[cell], at, room = at + 1, at + int(cuts[cell]), 0
            continue
        if n > room or at < 0:
            at, room = at + 1, most
        first[cell], room = at, room - n
    return first, cuts


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, scale: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its k highest integer inner products with other rows, ties to smaller ids.

    vectors and queries hold (vec_id, embedding). Components become floor(scale * x).
    Rows with a null id, and vectors null or holding null or non-finite components, take
    no part. Shorter vectors count as ending in zeros. Queries that repeat an id count
    once; data rows that repeat are candidates each; a query never finds rows of its own
    id. Scores past 2^63 wrap around. An empty table gives an empty one; other columns,
    whatever their names, take no part.

    Pivots are rows drawn by a hash of their ids. Data cells are the rows nearest to each
    pivot, summed up by their number and the largest distance from the pivot. A query's
    score with a row of a cell is at most <query, pivot> + |query| * radius and at least
    the same with a minus, so the sizes of the cells of the best lower bounds give each
    query a score that its k-th result has at least; rows of the query's own id fill no
    place there, however often it repeats. Cells whose upper bound is below that are not
    visited. Queries are grouped by their own nearest pivot; a cell is copied to those
    groups alone that have a query to visit it. Small cells are solved together and large
    ones (a vector with very many copies, say) in pieces, each for a group of queries at a
    time, and each passes on k rows a query.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    data = integer_vectors(vectors, scale)
    asks = integer_vectors(queries, scale).groupBy("vec_id").agg(F.min("v").alias("v"))
    n, dim = data.agg(F.count("*"), F.max(F.size("v"))).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not n:
        return spark.createDataFrame([], schema)
    m = int(np.clip(n // CELL_ROWS, 1, MAX_PIVOTS))
    drawn = data.orderBy(F.xxhash64("vec_id"), "vec_id").limit(m).toPandas()
    pivots = _stack(drawn.v, dim)
    half = (pivots**2).sum(axis=1) / 2

    def nearest(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        near = np.argmin(half[None] - x @ pivots.T, axis=1)
        return near, np.sqrt(((x - pivots[near]) ** 2).sum(axis=1))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for a in range(0, len(f), 8192):
                g = f.iloc[a : a + 8192]
                x = _stack(g.v, dim)
                cell, far = nearest(x)
                yield pd.DataFrame({"vec_id": g.vec_id, "v": [r.astype("<i8").tobytes() for r in x], "cell": cell.astype(np.int32), "far": far})

    data = data.mapInPandas(place, "vec_id long, v binary, cell int, far double")
    # rows are told apart by their place, so that a cell of equal rows can be cut as well
    data = cut(data.repartition(parts).withColumn("place", F.monotonically_increasing_id()))
    sizes = data.groupBy("cell").agg(F.count("*").alias("n")).toPandas()
    held = np.zeros(m, np.int64)
    held[sizes.cell.to_numpy()] = sizes.n.to_numpy()
    numbers = lambda xs, c: F.element_at(F.lit([int(x) for x in xs]), c + 1)
    first, pieces = groups_of(held, BLOCK_ROWS)
    data = data.withColumn("block", (numbers(first, F.col("cell")) + F.pmod(F.xxhash64("place"), numbers(pieces, F.col("cell")))).cast("int"))
    blocks = data.groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("far")).orderBy("cell").toPandas()
    centre, count, radius = pivots[blocks.cell.to_numpy()], blocks.n.to_numpy(np.int64), blocks.far.to_numpy() * (1 + 1e-9) + 1e-6
    cells = blocks.cell.to_numpy(np.int32)
    repeats = data.groupBy("vec_id").agg(F.count("*").alias("own")).filter("own > 1")
    asks = asks.join(repeats, "vec_id", "left").select("vec_id", "v", F.coalesce("own", F.lit(1)).alias("own"))

    def visit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for a in range(0, len(f), 4096):
                g = f.iloc[a : a + 4096]
                q = _stack(g.v, dim)
                cell, _ = nearest(q)
                mid, slack = q @ centre.T, np.linalg.norm(q, axis=1)[:, None] * radius[None]
                low = mid - slack
                order = np.argsort(-low, axis=1)
                need = k + g.own.to_numpy(np.int64)  # any of the rows of the query's own id may be among them
                reach = np.argmax(np.cumsum(count[order], axis=1) >= need[:, None], axis=1)
                least = np.take_along_axis(np.take_along_axis(low, order, 1), reach[:, None], 1)
                least[count.sum() < need] = -np.inf
                wanted = mid + slack + 1e-6 * (1 + np.abs(mid)) >= least
                lists = [cells[w] for w in wanted]
                yield pd.DataFrame({"vec_id": g.vec_id, "v": [r.astype("<i8").tobytes() for r in q], "home": cell.astype(np.int32), "cells": lists})

    asks = cut(asks.mapInPandas(visit, "vec_id long, v binary, home int, cells array<int>").repartition(parts))
    homes = asks.groupBy("home").agg(F.count("*").alias("n")).toPandas()
    asked = np.zeros(m, np.int64)
    asked[homes.home.to_numpy()] = homes.n.to_numpy()
    group, cuts = groups_of(asked, QUERY_ROWS)
    asks = asks.withColumn("asks", (numbers(group, F.col("home")) + F.pmod(F.xxhash64("vec_id"), numbers(cuts, F.col("home")))).cast("int"))
    of_cell = lambda c: F.sequence(numbers(first, c).cast("int"), (numbers(first, c) + numbers(pieces, c) - 1).cast("int"))
    sent = asks.select("asks", "vec_id", "v", F.explode(F.array_distinct(F.flatten(F.transform("cells", of_cell)))).alias("block"))
    pairs = asks.select(F.col("asks").alias("to_asks"), F.explode("cells").alias("to_cell")).distinct()
    pairs = pairs.select("to_asks", "to_cell", F.explode(of_cell(F.col("to_cell"))).alias("to_block"))
    copied = data.select("vec_id", "v", "cell", "block").join(pairs, (F.col("cell") == F.col("to_cell")) & (F.col("block") == F.col("to_block")))
    copied = copied.select("to_asks", "to_block", "vec_id", "v")

    def solve(key: tuple, asked: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        unpack = lambda c: np.frombuffer(b"".join(c), "<i8").reshape(len(c), -1).astype(np.float64)
        if not len(asked) or not len(found):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(np.int64)
        found = found.sort_values("vec_id", kind="stable")
        ids = found.vec_id.to_numpy()
        r, c, s = _best(unpack(asked.v), unpack(found.v), asked.vec_id.to_numpy(), ids, k)
        return pd.DataFrame({"query_id": asked.vec_id.to_numpy()[r], "vec_id": ids[c], "score": s})

    both = sent.groupBy("asks", "block").cogroup(copied.groupBy("to_asks", "to_block"))
    partial = both.applyInPandas(solve, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return partial.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.filter("vec_id % 20 = 0"))
