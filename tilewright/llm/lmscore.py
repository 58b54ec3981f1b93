"""Cross-entropy difference between a target and a background n-gram model."""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import small_batches, strings_of, table, written

#: Tokens are words; both models share this vocabulary of hashed words, 0 standing for the start of a text.
VOCABULARY = 1 << 18
#: Weight of a single word's estimate beside a pair's, in counts.
BACKOFF = 2.0
#: A pair with at least this share of all tokens is heavy: there are at most HEAVY of them.
HEAVY = 4096
#: Cells of the sketch that finds heavy pairs.
CELLS = 1 << 16
#: Numbers in a piece of a summed table.
PIECE = 1 << 14
#: Tokens of texts that are counted at a time (one text at least).
STEP = 1 << 18


def words_of(text: str | None) -> np.ndarray:
    """The vocabulary's numbers of the words of a text, letters of ASCII in lower case."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    return (np.fromiter(map(crc32, words), np.int64, len(words)) % (VOCABULARY - 1) + 1).astype(np.int32)


def _tokens(docs: DataFrame, target: DataFrame, background: DataFrame | None) -> DataFrame:
    """(row, doc_id, n, ids, in_target, in_background), a row for each row of docs; ids are 32-bit numbers.

    Ids of the target and background grow with the corpus, so they meet by sort and merge.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [words_of(t) for t in strings_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(i) for i in ids], pa.int64()), pa.array([i.tobytes() for i in ids], pa.binary())], ["doc_id", "n", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.mapInArrow(run, "doc_id long, n long, ids binary")
    for name, of in (("in_target", target), ("in_background", background)):
        if of is None:
            rows = rows.withColumn(name, F.lit(True))
        else:
            known = of.select(F.col("doc_id").cast("long").alias("known")).distinct()
            rows = rows.join(known.hint("merge"), F.col("doc_id") == F.col("known"), "left").withColumn(name, F.col("known").isNotNull()).drop("known")
    return written(rows.select(F.monotonically_increasing_id().alias("row"), "*"))


def _pairs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all tokens of a batch of _tokens: the text they are in, the token before them (0 at the start) and themselves."""
    n = batch.column("n").to_numpy()
    word = np.frombuffer(b"".join(batch.column("ids").to_pylist()), np.int32).astype(np.int64)
    before = np.r_[0, word[:-1]] if len(word) else word
    some = n[n > 0]
    before[np.cumsum(some) - some] = 0
    return np.repeat(np.arange(len(n)), n), before, word


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends, at = np.cumsum(batch.column("n").to_numpy()), 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + STEP, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


def _flags(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False) for c in ("in_target", "in_background")]


def _cell(pair: np.ndarray) -> np.ndarray:
    """The sketch's cell of a pair, by multiplicative hashing."""
    return (pair.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)).astype(np.int64) % CELLS


def _tables(tokens: DataFrame) -> np.ndarray:
    """Counts over all texts, one after the other: words and histories in the target, in the background, cells of pairs.

    Each task sums up tables of a fixed size; they are added up in pieces.
    """
    size = 4 * VOCABULARY + CELLS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size, np.int64)
        for batch in _steps(batches):
            text, before, word = _pairs(batch)
            for k, flag in enumerate(_flags(batch)):
                own = flag[text]
                for at, ids in ((2 * k, word), (2 * k + 1, before)):
                    sums[at * VOCABULARY : (at + 1) * VOCABULARY] += np.bincount(ids[own], minlength=VOCABULARY)
            sums[4 * VOCABULARY :] += np.bincount(_cell(before * VOCABULARY + word), minlength=CELLS)
        pieces = [(i, sums[i * PIECE : (i + 1) * PIECE]) for i in range(-(-size // PIECE))]
        pieces = [(i, p) for i, p in pieces if p.any()]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in pieces], pa.int32()), pa.array([p.tobytes() for _, p in pieces], pa.binary())], ["piece", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                p = np.frombuffer(p, np.int64)
                held[i] = held[i] + p if i in held else p
        yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.int32()), pa.array([p.tobytes() for p in held.values()], pa.binary())], ["piece", "sums"])

    parts = int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = tokens.mapInArrow(run, "piece int, sums binary").repartition(parts, "piece").mapInArrow(add, "piece int, sums binary").toPandas()
    sums = np.zeros(size, np.int64)
    for i, p in zip(found.piece, found.sums, strict=True):
        sums[i * PIECE : (i + 1) * PIECE] = np.frombuffer(p, np.int64)
    return sums


def _heavy(tokens: DataFrame, cells: np.ndarray, least: int) -> pd.DataFrame:
    """(pair, t, b) of the pairs that occur at least `least` times in all, by their cells; at most HEAVY."""
    if not (cells >= least).any():
        return pd.DataFrame({"pair": [], "t": [], "b": []}).astype(np.int64)
    shared = tokens.sparkSession.sparkContext.broadcast(cells >= least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _steps(batches):
            text, before, word = _pairs(batch)
            pair = before * VOCABULARY + word
            at = shared.value[_cell(pair)]
            pair, back = np.unique(pair[at], return_inverse=True)
            counts = [np.bincount(back, f[text[at]], len(pair)).astype(np.int64) for f in _flags(batch)]
            yield pa.RecordBatch.from_arrays([pa.array(pair), *map(pa.array, counts), pa.array(np.bincount(back, minlength=len(pair)))], ["pair", "t", "b", "n"])

    sums = tokens.mapInArrow(run, "pair long, t long, b long, n long").groupBy("pair").agg(*[F.sum(c).alias(c) for c in "tbn"])
    return sums.filter(F.col("n") >= least).select("pair", "t", "b").orderBy("pair").toPandas()


def _loss(counts, history, single):
    """Nats of a word after another, by the counts of both together and of the first, and BACKOFF times the second's own estimate."""
    log = F.log if isinstance(counts, Column) else np.log
    return log(history + BACKOFF) - log(counts + single)


def cross_entropy(docs: DataFrame, target: DataFrame, background: DataFrame | None = None) -> DataFrame:
    """(doc_id, text) -> (doc_id, n_tokens, target_loss, background_loss, score), one row per row of docs.

    Rows whose id target (doc_id) has count in the target model, those whose id background
    (all, if None) has in the background model; every row is scored. Tokens are words
    (letters of ASCII in lower case), hashed into a vocabulary that both models share;
    each model estimates a word after the one before it from all its texts: the count of
    both in a row, plus BACKOFF times the word's own estimate (its count plus one), over
    the first one's count plus BACKOFF. Losses are means per token in nats, rounded to 9
    digits; score is target_loss - background_loss, so less is closer to the target. Null
    and empty texts have no tokens and zeros; rows with null ids are in no list; repeated
    ids, repeated rows and texts of any length are rows like others; an empty table gives
    an empty one. Other columns of docs, whatever their names, take no part.

    Pairs are counted where they meet, by a shuffle of each text's distinct pairs, and
    their losses are summed per text from there, so what is gathered grows with the
    corpus. Only tables of the vocabulary's size are sent to tasks, and the heavy pairs,
    at most HEAVY: those are summed where the texts are and never meet in one task.
    """
    spark = docs.sparkSession
    small_batches(spark)
    tokens = _tokens(docs, target, background)
    sums = _tables(tokens)
    word_t, before_t, word_b, before_b = sums[: 4 * VOCABULARY].reshape(4, -1).astype(np.float64)
    single = [BACKOFF * (w + 1) / (w.sum() + VOCABULARY) for w in (word_t, word_b)]
    cells = sums[4 * VOCABULARY :]
    heavy = _heavy(tokens, cells, max(int(np.ceil(cells.sum() / HEAVY)), 2))
    keys = heavy.pair.to_numpy(np.int64)
    first, second = keys // VOCABULARY, keys % VOCABULARY
    heavy_loss = [_loss(heavy[c].to_numpy(np.float64), h[first], s[second]) for c, h, s in (("t", before_t, single[0]), ("b", before_b, single[1]))]
    shared = spark.sparkContext.broadcast((keys, *heavy_loss))

    def found(keys: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, pair), max(len(keys) - 1, 0))
        return at, keys[at] == pair if len(keys) else np.zeros(len(pair), bool)

    def light(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _steps(batches):
            text, before, word = _pairs(batch)
            pair = before * VOCABULARY + word
            rest = ~found(shared.value[0], pair)[1]
            order = np.lexsort((pair[rest], text[rest]))
            text, pair = text[rest][order], pair[rest][order]
            new = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (pair[1:] != pair[:-1])]) if len(pair) else pair
            n = np.diff(np.r_[new, len(pair)])
            flags = _flags(batch)
            code = batch.column("row").to_numpy() * 4 + flags[0] * 2 + flags[1]
            yield pa.RecordBatch.from_arrays([pa.array(pair[new]), pa.array(code[text[new]]), pa.array(n.astype(np.int32))], ["pair", "code", "n"])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, *loss = shared.value
        for batch in _steps(batches):
            text, before, word = _pairs(batch)
            at, known = found(keys, before * VOCABULARY + word)
            # of no pairs at all, bincount makes whole numbers
            each = [np.bincount(text[known], x[at[known]], batch.num_rows).astype(np.float64) for x in loss]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *map(pa.array, each)], ["row", "t", "b"])

    rows = tokens.mapInArrow(light, "pair long, code long, n int")
    together = Window.partitionBy("pair")
    counted = [F.sum(F.when(F.col("code").bitwiseAND(bit) > 0, F.col("n")).otherwise(0)).over(together).alias(c) for bit, c in ((2, "t"), (1, "b"))]
    # at most VOCABULARY rows of five numbers
    known = spark.createDataFrame(pa.table({"id": np.arange(VOCABULARY), "ht": before_t, "hb": before_b, "st": single[0], "sb": single[1]}))
    pairs = rows.select("pair", "code", "n", *counted)
    pairs = pairs.join(F.broadcast(known.select(F.col("id").alias("_h"), "ht", "hb")), F.expr(f"pair div {VOCABULARY}") == F.col("_h"))
    pairs = pairs.join(F.broadcast(known.select(F.col("id").alias("_w"), "st", "sb")), F.expr(f"pair % {VOCABULARY}") == F.col("_w"))
    each = pairs.select(F.shiftright("code", 2).alias("row"), *[(F.col("n") * _loss(F.col(c), F.col(f"h{c}"), F.col(f"s{c}"))).alias(c) for c in "tb"])
    if len(keys):
        each = each.unionByName(tokens.mapInArrow(local, "row long, t double, b double"))
    total = each.groupBy("row").agg(F.sum("t").alias("t"), F.sum("b").alias("b"))
    mean = lambda c: F.round(F.coalesce(F.try_divide(F.col(c), F.col("n")), F.lit(0.0)), 9)
    out = tokens.select("row", "doc_id", "n").join(total, "row", "left").select("doc_id", F.col("n").alias("n_tokens"), mean("t").alias("target_loss"), mean("b").alias("background_loss"))
    return out.withColumn("score", F.round(F.col("target_loss") - F.col("background_loss"), 9))


def op8_lmscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents between those labelled good (target) and all (background)."""
    return cross_entropy(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").filter("quality = 1"))
