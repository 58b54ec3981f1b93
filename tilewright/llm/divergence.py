"""Divergence between the sources of a language, over run-length columns of their term counts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import small_batches, strings_of, table, written

#: Documents of a language that a kept term is in, at least.
LEAST_DOCS = 3
#: Shares are counted in billionths.
SCALE = 1_000_000_000
#: Counts that a task holds before it passes them on, and bytes of a text that are split at a time.
HELD, SLICE = 200_000, 1 << 20
#: 2 ** SHARD columns' entries a shard, and sources on one side of the pairs of a task.
SHARD, SOURCES = 13, 256
#: Letters of ASCII in lower case, other bytes below 128 as blanks, bytes from 128 as they are.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def _slices(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, some SLICE bytes of it at a time."""
    raw, at = text.encode("utf-8", "replace").translate(LETTERS), 0
    while at < len(raw):
        stop = raw.find(b" ", at + SLICE)
        stop = len(raw) if stop < 0 else stop
        yield raw[at:stop].split()
        at = stop


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term and documents with it; tasks add up what they meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def passed_on() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, of) in held.items():
                terms = pa.array(n.keys(), pa.binary()).cast(pa.string())
                same = lambda v: pa.array([v], pa.string()).take(pa.array(np.zeros(len(n), np.int32)))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([same(lang), same(source), terms, pa.array(n.values(), pa.int64()), pa.array([of[t] for t in n], pa.int64())], ["lang", "source", "term", "n", "docs"])
            held.clear()

        size = 0
        for batch in batches:
            for lang, source, text in zip(*(strings_of(batch.column(i)) for i in range(3)), strict=True):
                n, of = held.setdefault((lang, source), (Counter(), Counter()))
                before, own = len(n), set()
                for terms in _slices(text):
                    n.update(terms)
                    own.update(terms)
                of.update(own)
                size += len(n) - before
                if size > HELD:
                    yield from passed_on()
                    size = 0
        yield from passed_on()

    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    rows = rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, total, sources, ns): the terms in at least `least` documents of a language, with their counts by source."""
    found = term_counts(docs).groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"), F.array_sort(F.collect_list(F.struct("source", "n"))).alias("c"))
    return found.filter(F.col("docs") >= least).select("lang", "term", "total", F.col("c.source").alias("sources"), F.col("c.n").alias("ns"))


def groups_of(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(lang, source, idx, size, vocabulary, lang_size) of every group: its place among the language's sources and its occurrences of kept terms."""
    keys = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    sizes = terms.select(F.col("lang").alias("_l"), F.explode(F.arrays_zip("sources", "ns")).alias("e")).groupBy("_l", F.col("e.sources").alias("_s")).agg(F.sum("e.ns").alias("size"))
    langs = terms.groupBy(F.col("lang").alias("_v")).agg(F.count("*").alias("vocabulary"), F.sum("total").alias("lang_size"))
    out = keys.join(sizes, (F.col("lang") == F.col("_l")) & (F.col("source") == F.col("_s")), "left").join(langs, F.col("lang") == F.col("_v"), "left")
    idx = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    return out.select("lang", "source", idx.alias("idx"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("size", "vocabulary", "lang_size")])


def share(n: np.ndarray, size: int, vocabulary: int) -> np.ndarray:
    """1 + floor(SCALE * (n + 1) / (size + vocabulary)), exact below 9e15 occurrences: three digits at a time."""
    out, rest = np.zeros(len(n), np.int64), n.astype(np.int64) + 1
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, size + vocabulary)
        out = out * 1000 + digits
    return out + 1


def _shared(n: Column, size: str) -> Column:
    """As share(), of columns."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.call_function("div", wide(n + 1) * F.lit(SCALE).cast("decimal(10,0)"), wide(F.col(size) + F.col("vocabulary"))) + 1


def runs_of(column: np.ndarray, value: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and counts of the runs of a column, zero but at the given places."""
    dense = np.zeros(length, np.int64)
    dense[column] = value
    start = np.r_[0, np.flatnonzero(np.diff(dense)) + 1]
    return start, dense[start]


def divergence(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], terms: np.ndarray) -> int:
    """Sum of floor((p - q)^2 / q) of two run-length columns (start, p) and (start, q); terms[i] terms lie before place i."""
    at = np.union1d(a[0], b[0])
    p, q = (x[1][np.searchsorted(x[0], at, side="right") - 1] for x in (a, b))
    return int(((p - q) ** 2 // q * np.diff(np.r_[terms[at], terms[-1]])).sum())


def _solve(key: tuple, rows: pa.Table, groups: pa.Table) -> pa.Table:
    """(lang, a, b, value): pairs of sources summed over one shard; a from one block of sources."""
    schema = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("value", pa.int64())])
    if not rows.num_rows or not groups.num_rows:
        return schema.empty_table()
    block = key[2].as_py()
    groups = groups.sort_by("idx")
    names, length = groups["source"].combine_chunks(), rows.num_rows
    order = pc.sort_indices(rows, [("place", "ascending")])
    rows = rows.take(order)
    terms = np.r_[0, np.cumsum(rows["run"].to_numpy())]
    lists = rows["sources"].combine_chunks()
    place = np.repeat(np.arange(length), pc.list_value_length(lists).to_numpy())
    of = pc.index_in(lists.flatten(), value_set=names).to_numpy()
    ns = rows["ns"].combine_chunks().flatten().to_numpy()
    by = np.argsort(of, kind="stable")
    cut = np.searchsorted(of[by], np.arange(len(names) + 1))
    columns = []
    for j, (size, vocabulary) in enumerate(zip(groups["size"].to_pylist(), groups["vocabulary"].to_pylist(), strict=True)):
        own = by[cut[j] : cut[j + 1]]
        start, n = runs_of(place[own], ns[own], length)
        columns.append((start, share(n, size, vocabulary)))
    mine = range(block * SOURCES, min((block + 1) * SOURCES, len(names)))
    pairs = [(i, j) for i in mine for j in range(len(names)) if i != j]
    left, right = (names.take(pa.array([p[k] for p in pairs], pa.int64())) for k in (0, 1))
    value = pa.array([divergence(columns[i], columns[j], terms) for i, j in pairs], pa.int64())
    return pa.Table.from_arrays([pa.array([key[0].as_py()] * len(pairs), pa.string()), left, right, value], schema=schema)


def pair_sums(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value): the divergence of source a from source b of a language, over all its kept terms.

    Terms with the same counts in all sources become one entry with their number. Entries
    are sorted by their counts, so that equal counts of a source lie together, and cut
    into shards; in each, a source's counts are runs, and a pair is summed over the
    stretches between the starts of the runs of both. Rows are copied once for each
    SOURCES sources of their language.
    """
    spark = terms.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    equal = terms.groupBy("lang", "sources", "ns").agg(F.count("*").alias("run"))
    rows = equal.repartitionByRange(parts, "lang", "sources", "ns").sortWithinPartitions("lang", "sources", "ns").withColumn("place", F.monotonically_increasing_id())
    rows = written(rows.withColumn("shard", F.shiftright("place", SHARD)))
    blocks = groups.select(F.col("lang").alias("_l"), F.expr(f"idx div {SOURCES}").alias("block")).distinct()
    rows = rows.join(blocks, F.col("lang") == F.col("_l")).drop("_l")
    shards = rows.select(*[F.col(c).alias(f"to_{c}") for c in ("lang", "shard", "block")]).distinct().join(groups.select(F.col("lang").alias("_l"), "source", "idx", "size", "vocabulary"), F.col("to_lang") == F.col("_l")).drop("_l")
    solved = rows.groupBy("lang", "shard", "block").cogroup(shards.groupBy("to_lang", "to_shard", "to_block")).applyInArrow(_solve, "lang string, a string, b string, value long")
    return solved.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def divergent_terms(terms: DataFrame, groups: DataFrame, most: int) -> DataFrame:
    """(lang, source, term, value, rank): the terms that a source uses more than its language does, up to rank `most`."""
    rows = terms.select("lang", "term", "total", F.explode(F.arrays_zip("sources", "ns")).alias("e")).select("lang", "term", "total", F.col("e.sources").alias("source"), F.col("e.ns").alias("n"))
    rows = rows.join(groups.drop("idx"), ["lang", "source"]).withColumns({"p": _shared(F.col("n"), "size"), "q": _shared(F.col("total"), "lang_size")})
    rows = rows.filter("p > q").select("lang", "source", "term", F.expr("(p - q) * (p - q) div q").alias("value"))
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term"))).filter(F.col("rank") <= most)


def source_divergence(docs: DataFrame, least: int = LEAST_DOCS, most: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank) of (text, lang, source): how far sources of a language lie apart, and by which terms.

    Part pair has every other source of the language, part term the terms that the source
    has more often than its language, up to rank `most`; both by falling value, then by
    item. Terms are runs of letters of ASCII (in lower case) and characters beyond ASCII;
    a language keeps those in at least `least` of its documents. Null text, lang and
    source are empty; rows that repeat are documents each; texts of any length are read
    whole; a language without kept terms has pairs of value 0; an empty table gives an
    empty one, and other columns, whatever their names, take no part.
    """
    small_batches(docs.sparkSession)
    terms = written(kept_terms(docs, least))
    groups = written(groups_of(docs, terms))
    by = lambda c: F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), c)).cast("int")
    sums = pair_sums(terms, groups)
    pairs = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").filter("source <> item")
    pairs = pairs.join(sums.withColumnsRenamed({"a": "source", "b": "item"}), ["lang", "source", "item"], "left").withColumn("value", F.coalesce("value", F.lit(0)))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", by("item").alias("rank"))
    own = divergent_terms(terms, groups, most).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", F.col("rank").cast("int").alias("rank"))
    return pairs.unionByName(own)


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))
