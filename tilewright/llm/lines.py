"""Line de-duplication by a deletion-neighbourhood join over words."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import MAX_FILTER_BITS, filter_of, small_batches, strings_of, table, written

#: Equal lines count from MIN_WORDS words on; lines of NEAR_WORDS or more also by edits, with partners one word shorter.
MIN_WORDS, NEAR_WORDS = 1, 5
#: Lines of fewer words have few variants and halves that are too common, so they aren't filtered by halves.
SHORT = 10
#: Distinct lines whose variants meet in a task before they are sent on.
TOGETHER = 4096


def _h(data: bytes, seed: int = 0) -> int:
    x = xxhash.xxh64_intdigest(data, seed)
    return x - (1 << 64) if x >= 1 << 63 else x


def line_words(line: str) -> list[bytes]:
    return line.encode("utf-8", "replace").split()


def half_keys(words: list[bytes]) -> list[int]:
    """Two lines within one edit of a word share one of these.

    For the smaller length t of the two, either the first or the last half of t words
    (cut to an even number) is in both; a line serves as the shorter and the longer one.
    """
    m = len(words)
    keys = []
    for p in {m // 4 * 2, (m - 1) // 4 * 2}:
        keys += [_h(b" ".join(words[:p]), 2 * p), _h(b" ".join(words[m - p :]), 2 * p + 1)]
    return keys


#: Odd, and its inverse by 2 ** 64: a line's key sums up its words' hashes, each times a power of the inverse by its place.
_TURN = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def variants(lines: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, key, place): of each line itself, place -1, and of all lines that the deletion of a word makes of it.

    Lines that share a key and a place differ in the word at that place alone; a line
    that shares its own key with a deletion of another is that line without a word. Keys
    of deletions come from the sums before and after the word, so a line takes as many
    steps as it has words.
    """
    n = np.array([len(w) for w in lines], np.int64)
    of, start = np.repeat(np.arange(len(lines)), n), np.cumsum(n) - n
    place = np.arange(n.sum()) - start[of]
    power = np.cumprod(np.r_[np.uint64(1), np.full(max(int(n.max(initial=0)) - 1, 0), _BACK)])
    digest = xxhash.xxh64_intdigest
    each = np.fromiter((digest(w) for words in lines for w in words), np.uint64, len(of)) * power[place]
    sums = np.r_[np.uint64(0), np.cumsum(each)]
    own = sums[start + n] - sums[start]
    before, after = sums[start[of] + place] - sums[start[of]], sums[start[of] + n[of]] - sums[start[of] + place + 1]
    key = np.r_[own, before + after * _TURN].view(np.int64)
    return np.r_[np.arange(len(lines)), of], key, np.r_[np.full(len(lines), -1), place].astype(np.int32)


def within_one(a: list[bytes], b: list[bytes]) -> bool:
    """Whether at most one word was inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    p = 0
    while p < len(a) and a[p] == b[p]:
        p += 1
    return a[p:] == b[p + 1 :] or a[p + 1 :] == b[p + 1 :] if p < len(b) else True


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("long"), text).alias("dkey"), text.alias("text"))


#: The order of lines: by document id, null last, line and a hash of the document.
_EARLIER = ("no_id", "doc_id", "line", "dkey")


def _first_of(group: np.ndarray, batch: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows by group and order, and for each of them whether it begins a group."""
    by = np.lexsort((batch["dkey"], batch["line"], batch["doc_id"], batch["no_id"], group))
    return by, np.r_[True, group[by][1:] != group[by][:-1]] if len(by) else np.zeros(0, bool)


def _ids(column: pa.Array) -> dict[str, np.ndarray]:
    return {"no_id": column.is_null().to_numpy(zero_copy_only=False), "doc_id": column.fill_null(0).to_numpy()}


def _lines(docs: DataFrame, min_words: int, halves_from: int) -> DataFrame:
    """(h, doc_id, dkey, line, gone, halves) of the lines that may be duplicates.

    Of the equal lines of a batch only the earliest goes on; the others have an earlier
    one for certain and are gone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, line, h, halves, sizes = array("q"), array("i"), array("q"), array("q"), array("i")
            for i, text in enumerate(strings_of(batch.column(2))):
                for k, x in enumerate(text.split("\n")):
                    words = line_words(x)
                    if len(words) >= min_words:
                        at.append(i)
                        line.append(k)
                        h.append(_h(b" ".join(words)))
                        keys = half_keys(words) if len(words) >= halves_from else ()
                        halves.extend(keys)
                        sizes.append(len(keys))
            rows = np.frombuffer(at, np.int64)
            ids = _ids(batch.column(0))
            each = {c: v[rows] for c, v in ids.items()} | {"dkey": batch.column(1).to_numpy()[rows], "line": np.frombuffer(line, np.int32)}
            h = np.frombuffer(h, np.int64)
            by, first = _first_of(h, each)
            head = by[np.maximum.accumulate(np.where(first, np.arange(len(by)), 0))]
            # rows that agree with the first in id, text and line are that row again
            again = ~first & (each["dkey"][by] == each["dkey"][head]) & (each["line"][by] == each["line"][head]) & (each["doc_id"][by] == each["doc_id"][head])
            gone = np.zeros(len(by), bool)
            gone[by] = ~first
            keep = np.ones(len(by), bool)
            keep[by[again]] = False
            keep = np.flatnonzero(keep)
            sizes = np.frombuffer(sizes, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(np.frombuffer(halves, np.int64)))
            lists = pa.compute.if_else(pa.array(gone), pa.scalar(None, lists.type), lists)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[keep]), batch.column(0).take(pa.array(rows[keep])), pa.array(each["dkey"][keep]), pa.array(each["line"][keep]), pa.array(gone[keep]), lists.take(pa.array(keep))],
                ["h", "doc_id", "dkey", "line", "gone", "halves"],
            )

    return _keyed(docs).mapInArrow(run, "h long, doc_id long, dkey long, line int, gone boolean, halves array<long>")


def _shared_halves(lines: DataFrame) -> DataFrame:
    """(h): lines that share a half with another line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key = last_h = None
        for batch in batches:
            key, h = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(key):
                continue
            same = np.r_[False, key[1:] == key[:-1]]
            other = same & np.r_[False, h[1:] != h[:-1]]
            carried = last_key is not None and key[0] == last_key
            # within a run of equal keys, sorted by h, there are several lines if any neighbours differ
            run_no = np.cumsum(~same) - 1
            many = np.zeros(run_no[-1] + 1, bool)
            many[run_no[other]] = True
            if carried and h[0] != last_h:
                many[0] = True
            found = h[many[run_no]]
            if carried and many[0]:
                found = np.r_[found, last_h]
            last_key, last_h = key[-1], h[-1]
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(found))], ["h"])

    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    halves = lines.filter("NOT gone").select(F.explode("halves").alias("key"), "h")
    return halves.repartition(parts, "key").sortWithinPartitions("key", "h").mapInArrow(run, "h long").distinct()


def _sorted(rows: DataFrame, *by: str) -> DataFrame:
    """rows dealt out by the first column of `by` and sorted by all, then in order of the lines."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, by[0]).sortWithinPartitions(*by, F.asc_nulls_last("doc_id"), "line", "dkey")


def _texts(docs: DataFrame, candidates: DataFrame, partner_words: int) -> DataFrame:
    """(h, words, doc_id, dkey, line): the distinct lines that may be near others, each as its earliest."""
    bits, mask = filter_of(candidates)
    shared = docs.sparkSession.sparkContext.broadcast((bits, mask))
    names = ["h", "words", "doc_id", "dkey", "line"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, mask = shared.value
        for batch in batches:
            at, line, h, found = array("q"), array("i"), array("q"), []
            for i, text in enumerate(strings_of(batch.column(2))):
                for k, x in enumerate(text.split("\n")):
                    words = line_words(x)
                    if len(words) >= partner_words:
                        joined = b" ".join(words)
                        key = _h(joined)
                        bit = key & mask
                        if len(words) < SHORT or bits[bit // 63] >> (bit % 63) & 1:
                            at.append(i)
                            line.append(k)
                            h.append(key)
                            found.append(joined)
            rows = np.frombuffer(at, np.int64)
            each = {c: v[rows] for c, v in _ids(batch.column(0)).items()} | {"dkey": batch.column(1).to_numpy()[rows], "line": np.frombuffer(line, np.int32)}
            h = np.frombuffer(h, np.int64)
            by, first = _first_of(h, each)
            keep = pa.array(by[first])
            yield pa.RecordBatch.from_arrays([pa.array(h).take(keep), pa.array(found, pa.binary()).take(keep), batch.column(0).take(pa.array(rows)).take(keep), pa.array(each["dkey"]).take(keep), pa.array(each["line"]).take(keep)], names)

    def earliest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            h = batch.column(0).to_numpy()
            if len(h):
                first = np.r_[h[0] != last, h[1:] != h[:-1]]
                last = h[-1]
                yield batch.filter(pa.array(first))

    schema = "h long, words binary, doc_id long, dkey long, line int"
    found = _sorted(_keyed(docs).mapInArrow(run, schema), "h").mapInArrow(earliest, schema)
    if mask + 1 < MAX_FILTER_BITS:
        return found
    # so many candidates that the filter passes others too: those go by the candidates' own keys
    short = F.size(F.split(F.col("words").cast("string"), " ")) < SHORT
    known = found.join(candidates.withColumnRenamed("h", "_h"), F.col("h") == F.col("_h"), "left").filter(short | F.col("_h").isNotNull())
    return known.select(*names)


def _pairs(lines: DataFrame) -> DataFrame:
    """(h, by) of distinct lines (h, words, doc_id, dkey, line): each line that has an earlier one within one edit, with such a one.

    Lines that share a variant at one place are all near each other, so the earliest of
    them stands for the rest; a line that is another's variant itself is near each line
    that has that variant. Both need one row of state in a sorted sweep, however many
    lines share a variant; the rows of a batch are reduced likewise before they are sent.
    """
    names = ["key", "place", "h", "doc_id", "dkey", "line", "by"]
    schema = "key long, place int, h long, doc_id long, dkey long, line int, by long"

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(a, TOGETHER) for b in batches for a in range(0, b.num_rows, TOGETHER)):
            at, key, place = variants([w.split() for w in batch.column("words").to_pylist()])
            h = batch.column("h").to_numpy()[at]
            each = {c: v[at] for c, v in _ids(batch.column("doc_id")).items()} | {"dkey": batch.column("dkey").to_numpy()[at], "line": batch.column("line").to_numpy()[at]}
            by = np.lexsort((each["dkey"], each["line"], each["doc_id"], each["no_id"], place, key))
            key, place, h, at = key[by], place[by], h[by], at[by]
            first = np.r_[True, (key[1:] != key[:-1]) | (place[1:] != place[:-1])] if len(key) else np.zeros(0, bool)
            head = h[np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))] if len(h) else h
            # the others are near the first of their key and place, which is all there is to know of them
            by = pa.array(head, mask=first)
            key = np.where(first, key, h)
            rest = [batch.column(c).take(pa.array(at)) for c in ("doc_id", "dkey", "line")]
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(place), pa.array(h), *rest, by], names)

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # of the current key: its own line's h and order, whether that is known to be near; of the current place: the first line
        own_key = own = own_order = None
        own_near = True
        at_key = at_place = at_h = None
        for batch in batches:
            near, because = [], []
            cols = [batch.column(c).to_pylist() for c in names]
            for key, place, h, doc, dkey, line, by in zip(*cols, strict=True):
                if by is not None:
                    near.append(h)
                    because.append(by)
                    continue
                order = (doc is None, doc or 0, line, dkey)
                if place < 0:
                    own_key, own, own_order, own_near = key, h, order, False
                elif key == own_key:
                    if order > own_order:
                        near.append(h)
                        because.append(own)
                    elif not own_near:
                        own_near = True
                        near.append(own)
                        because.append(h)
                if key == at_key and place == at_place:
                    if place >= 0 and h != at_h:
                        near.append(h)
                        because.append(at_h)
                else:
                    at_key, at_place, at_h = key, place, h
            yield pa.RecordBatch.from_arrays([pa.array(near, pa.int64()), pa.array(because, pa.int64())], ["h", "by"])

    return _sorted(lines.mapInArrow(emit, schema), "key", "place").mapInArrow(sweep, "h long, by long")


def _near(docs: DataFrame, candidates: DataFrame, near_words: int, partner_words: int) -> DataFrame:
    """(h): distinct lines of near_words that have an earlier line of partner_words within one edit of a word, after verification."""

    @F.pandas_udf("boolean")
    def close(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([len(x) >= near_words and within_one(x, y.split()) for x, y in zip(map(bytes.split, a), b, strict=True)], dtype=bool)

    lines = written(_texts(docs, candidates, partner_words))
    pairs = written(_pairs(lines).distinct())
    a, b = lines.select("h", F.col("words").alias("a")), lines.select(F.col("h").alias("by"), F.col("words").alias("b"))
    return pairs.join(a, "h").join(b, "by").filter(close("a", "b")).select("h").distinct()


def duplicate_lines(docs: DataFrame, max_edits: int = 1, min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """(doc_id, text) -> (dkey, line, kind): the lines that go; line counts from 0, dkey is xxhash64(doc_id, text).

    Lines are cut at \\n and compared by their words (runs of anything but ASCII white
    space). Of equal lines of at least min_words words, the earliest stays, by doc_id
    (null last), line and dkey; kind "copy". With max_edits 1, a line of at least
    near_words words also goes if an earlier line of at least near_words - 1 (and
    min_words) differs from it by one word inserted, deleted or replaced, whether or not
    that line stays itself; kind "near". More than one edit is refused. Documents that
    agree in id and text keep or lose the same lines; null and empty texts have none that
    count; lines and texts of any length are taken whole.

    Each distinct line emits the hashes of all its variants under one deletion; equal
    variants meet, and each group passes on its earliest line, not its pairs, which are
    then verified word by word. Before that, lines of SHORT words or more that share
    neither half with another line are left out, as nothing can be within one edit of
    them. A line, variant or half that very many lines share is reduced to one row for
    each batch before it is sent to a task.
    """
    if max_edits not in (0, 1):
        raise ValueError("max_edits is 0 or 1")
    small_batches(docs.sparkSession)
    # a line of SHORT words may be near one of a word less, which needs its halves then
    lines = written(_lines(docs, min_words, max(SHORT - 1, min_words) if max_edits else 1 << 30))
    order = Window.partitionBy("h").orderBy(F.col("doc_id").asc_nulls_last(), "line", "dkey")
    judged = lines.filter("NOT gone").select("h", "dkey", "line", (F.rank().over(order) > 1).alias("later"))
    kind = F.when(F.col("later"), F.lit("copy"))
    if max_edits:
        near = written(_near(docs, written(_shared_halves(lines)), near_words, max(min_words, near_words - 1)))
        judged = judged.join(near.withColumn("near", F.lit(True)), "h", "left")
        kind = kind.when(F.col("near"), F.lit("near"))
    judged = judged.select("dkey", "line", kind.alias("kind")).filter("kind IS NOT NULL")
    return judged.unionByName(lines.filter("gone").select("dkey", "line", F.lit("copy").alias("kind"))).distinct()


def dedup_lines(docs: DataFrame, max_edits: int = 1, min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """docs with `text` rid of duplicate lines, and three more columns: n_lines, n_copies and n_near (lines that went).

    All rows and columns of docs stay, whatever their names, but for columns named like
    the three, which are replaced; a null text stays null and has no lines. Rows that
    repeat an id and text stay and lose the same lines; an empty table gives an empty
    one. See duplicate_lines for what goes.
    """
    lines_of = lambda kind: F.collect_list(F.when(F.col("kind") == kind, F.col("line")))
    gone = duplicate_lines(docs, max_edits, min_words, near_words).groupBy("dkey").agg(lines_of("copy").alias("copies"), lines_of("near").alias("near"))

    @F.pandas_udf("string")
    def rest(text: pd.Series, gone: pd.Series) -> pd.Series:
        found = []
        for t, g in zip(text, gone, strict=True):
            g = set() if g is None else set(g.tolist())
            found.append(None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in g))
        return pd.Series(found, dtype=object)

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(F.col("doc_id").cast("long"), text).alias("key"))
    rows = rows.join(gone, F.col("key") == F.col("dkey"), "left")
    # only texts that lose lines go to Python
    text, some = F.col("row.text").cast("string"), F.col("dkey").isNotNull()
    left = F.when(some, rest(F.when(some, text), F.concat("copies", "near"))).otherwise(text)
    n = lambda c: F.coalesce(F.size(c), F.lit(0))
    return rows.select(
        *[F.col(f"row.`{c}`") for c in docs.columns if c not in ("text", "n_lines", "n_copies", "n_near")],
        left.alias("text"),
        F.when(text.isNull(), 0).otherwise(F.size(F.split(text, "\n"))).alias("n_lines"),
        F.when(some, n("copies")).otherwise(0).cast("int").alias("n_copies"),
        F.when(some, n("near")).otherwise(0).cast("int").alias("n_near"),
    )


def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_copies", "n_near", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
