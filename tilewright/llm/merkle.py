"""Document fingerprints: Merkle trees over sections, paragraphs and phrases. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

_GAP, _WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
#: Three to twelve words with the space around them, cut after the first word from the third on that
#: ends in s, t or y; so an inserted word moves few cuts. The phrases of a paragraph hold all its characters.
PHRASE = rf"{_GAP}*(?:{_WORD}+{_GAP}+){{2,11}}?{_WORD}*[sty](?:{_GAP}+|\z)|{_GAP}*(?:{_WORD}+{_GAP}*){{1,12}}|{_GAP}+"
#: What sections, paragraphs and phrases count in a likeness.
SHARES = (0.05, 0.15, 0.8)


def _sha(text: Column, digits: int = 16) -> Column:
    return F.substring(F.sha2(text.cast("binary"), 256), 1, digits)


def fingerprint(text: Column) -> Column:
    """root:section=paragraph-phrases,paragraph-phrases/section=... of a text's sections (blank line), paragraphs (line) and phrases.

    A phrase's digest has 8 digits in the fingerprint and 16 in the paragraph's digest,
    which is that of its phrases' digests, and so on up to the root: equal roots mean
    equal texts, and unequal digests on the way down lead to the edits (see edits).
    """
    phrases = lambda p: F.transform(F.regexp_extract_all(p, F.lit(PHRASE), F.lit(0)), lambda w: _sha(w))
    short = lambda ws: F.array_join(F.transform(ws, lambda w: F.substring(w, 1, 8)), "")
    # (digest, digest-phrases) of a paragraph; (digest, digest=paragraphs) of a section
    leaf = lambda ws: F.struct(_sha(F.array_join(ws, "")).alias("h"), short(ws).alias("t"))
    paragraphs = lambda s: F.transform(F.transform(F.split(s, "\n"), phrases), leaf)
    node = lambda ps: F.struct(
        _sha(F.array_join(F.transform(ps, lambda p: p["h"]), ",")).alias("h"), F.array_join(F.transform(ps, lambda p: F.concat(p["h"], F.lit("-"), p["t"])), ",").alias("t")
    )
    sections = F.transform(F.transform(F.split(text, "\n\n"), paragraphs), node)
    root = lambda ss: F.concat(
        _sha(F.array_join(F.transform(ss, lambda s: s["h"]), "/"), 64), F.lit(":"), F.array_join(F.transform(ss, lambda s: F.concat(s["h"], F.lit("="), s["t"])), "/")
    )
    return F.transform(F.array(sections), root)[0]


def tree(fp: Column) -> Column:
    """A fingerprint's sections: array<struct<h, paragraphs: array<struct<h, phrases: array<string>>>>>."""
    paragraph = lambda p: F.struct(
        F.substring_index(p, "-", 1).alias("h"), F.regexp_extract_all(F.substring_index(p, "-", -1), F.lit(".{8}"), F.lit(0)).alias("phrases")
    )
    section = lambda s: F.struct(F.substring_index(s, "=", 1).alias("h"), F.transform(F.split(F.substring_index(s, "=", -1), ","), paragraph).alias("paragraphs"))
    return F.transform(F.split(F.substring_index(fp, ":", -1), "/"), section)


def levels(fp: Column) -> Column:
    """A fingerprint's root and its distinct digests of sections, paragraphs and phrases."""
    sections = tree(fp)
    return F.transform(
        F.array(F.struct(F.substring_index(fp, ":", 1).alias("root"), sections.alias("s"))),
        lambda x: F.struct(
            x["root"].alias("root"),
            F.array_distinct(F.transform(x["s"], lambda s: s["h"])).alias("sections"),
            F.array_distinct(F.flatten(F.transform(x["s"], lambda s: F.transform(s["paragraphs"], lambda p: p["h"])))).alias("paragraphs"),
            F.array_distinct(F.flatten(F.transform(x["s"], lambda s: F.flatten(F.transform(s["paragraphs"], lambda p: p["phrases"]))))).alias("phrases"),
        ),
    )[0]


def likeness(a: Column, b: Column) -> Column:
    """Of two levels(): 1 for equal roots, else SHARES of what each level shares (twice the shared digests over both counts).

    Texts that have all their phrases in other places are less than 1; without phrases on
    either side that level shares nothing.
    """
    each = F.lit(0.0)
    for share, name in zip(SHARES, ("sections", "paragraphs", "phrases"), strict=True):
        x, y = a[name], b[name]
        each = each + F.lit(share) * F.coalesce(F.try_divide(F.size(F.array_intersect(x, y)) * F.lit(2.0), F.size(x) + F.size(y)), F.lit(0.0))
    return F.when(a["root"] == b["root"], F.lit(1.0)).otherwise(each)


def edits(known: Column, new: Column) -> Column:
    """Where the new fingerprint's text has what the old one's hasn't: its paragraphs as section.paragraph from 0, joined by commas.

    known is the column of the old one's levels(), which the walk looks up again and again.

    Only sections whose digest the old tree lacks are walked down into, and only
    paragraphs that it lacks are named.
    """
    # places come before what doesn't count is dropped, so that they are those of the whole tree
    walked = F.transform(
        tree(new),
        lambda s, i: F.filter(
            F.when(F.array_contains(known["sections"], s["h"]), F.array().cast("array<string>")).otherwise(
                F.transform(s["paragraphs"], lambda p, j: F.when(~F.array_contains(known["paragraphs"], p["h"]), F.concat(i.cast("string"), F.lit("."), j.cast("string"))))
            ),
            lambda x: x.isNotNull(),
        ),
    )
    return F.array_join(F.flatten(walked), ",")


def _ranges(rows: DataFrame, n: int) -> Column:
    """The range of each row (doc_id, _hash) in an order by falling doc_id, null last, then by _hash.

    Ids are cut at approximate percentiles. An id (or null) with more rows than a range
    should have is cut further by hash, into ranges of its own.
    """
    cuts = rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n), F.count("*")).first()
    total, cuts = cuts[1], F.array(*[F.lit(int(c)) for c in sorted(set(cuts[0] or []))]).cast("array<long>")
    # at most n of them
    often = {r.doc_id: -(-r["count"] * n // total) for r in rows.groupBy("doc_id").count().filter(F.col("count") > total // n).collect()}
    pieces = F.when(F.col("doc_id").isNull(), F.lit(often.pop(None, 1)))
    if often:
        pieces = pieces.otherwise(F.element_at(F.create_map(*[F.lit(x) for k, v in often.items() for x in (k, v)]), F.col("doc_id")))
    # from 1, as rows of other ids in the same range come before
    of_hash = F.least((F.col("_hash").cast("double") / 2.0**64 + 0.5) * pieces, pieces - 1.0).cast("long") + 1
    main = F.when(F.col("doc_id").isNull(), F.lit(n)).otherwise(F.size(F.filter(cuts, lambda c: c > F.col("doc_id"))))
    return main.cast("long") * (1 << 32) + F.coalesce(of_hash, F.lit(0))


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with next_text, the text of the next row by descending doc_id, null ids last, the last row's next being the first.

    Null texts are empty. The rows are cut into ranges; each is sorted by itself, and the
    last row of a range takes the first of the next. Rows with the same id, or none, go by
    a hash of their texts, however many they are; rows that repeat follow each other. An
    empty table gives an empty one; other columns take no part.
    """
    spark = docs.sparkSession
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("_hash", F.xxhash64("text"))
    rows = rows.withColumn("_piece", _ranges(rows.select("doc_id", "_hash"), n))
    # orders like the falling id, without overflow
    falling = F.bitwise_not("doc_id")
    tops = rows.groupBy("_piece").agg(F.min(F.struct(falling.alias("id"), "_hash")).alias("_top")).select(F.col("_piece").alias("_p"), F.col("_top.id").alias("_id"), F.col("_top._hash").alias("_low"))
    of = (F.col("_piece") == F.col("_p")) & falling.eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_low"))
    # rows that agree in id and hash have one text
    heads = rows.join(F.broadcast(tops), of).groupBy("_piece").agg(F.min("text").alias("_first"))
    heads = heads.select(F.col("_piece").alias("_head"), "_first")
    everyone = Window.partitionBy(F.lit(1)).orderBy("_head")
    ends = tops.select(F.col("_p").alias("_head")).withColumn(
        "_after", F.coalesce(F.lead("_head").over(everyone), F.min("_head").over(Window.partitionBy(F.lit(1))))
    )
    ends = ends.withColumnRenamed("_head", "_piece").join(heads, F.col("_after") == F.col("_head")).select("_piece", "_first")
    within = rows.withColumn("_lead", F.lead("text").over(Window.partitionBy("_piece").orderBy(F.desc_nulls_last("doc_id"), "_hash")))
    return within.join(ends, "_piece").select("doc_id", "text", F.coalesce("_lead", "_first").alias("next_text"))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> fingerprints of each text and of its edited text, and their likenesses.

    Edited: the last floor(n_chars / 3) code points give way to as many from the start of
    the next document (all it has, if fewer). edited_at names the paragraphs of the edited
    text that the text hasn't. Null texts count as empty; the empty text has a fingerprint
    like any other, without phrases. One row per row of docs, null and repeated ids and
    repeated rows included; texts of any length are taken whole; an empty table gives an
    empty one; other columns of docs, whatever their names, take no part.
    """
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn("_edited", F.concat(F.expr("left(text, cast(n_chars - n_chars div 3 as int))"), F.expr("left(next_text, cast(n_chars div 3 as int))")))
    rows = rows.select(
        "doc_id", "n_chars", F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("text")).alias("fingerprint"), fingerprint(F.col("_edited")).alias("edited_fingerprint"), fingerprint(F.col("next_text")).alias("_next"),
    )
    rows = rows.withColumns({f"_l{i}": levels(F.col(c)) for i, c in enumerate(("fingerprint", "edited_fingerprint", "_next"))})
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("_l0"), F.col("_l1")).alias("near_edited"), likeness(F.col("_l0"), F.col("_l2")).alias("near_next"),
        edits(F.col("_l0"), F.col("edited_fingerprint")).alias("edited_at"),
    )


def op7_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))
