"""URL filters by a sort-merge range join over reversed-host keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: (host, path prefix, verdict)
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
#: Keys sampled to lay the boundaries between tasks; they steer the balance alone, never the result.
BOUNDARY_SAMPLE = 20_000
_SEP = "\x01"


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z in lower case; empty if null or without ://."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _reversed(labels: Column) -> Column:
    return F.array_join(F.reverse(labels), ".")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, url) by rules (host, path, verdict) -> (page_id, host, path, rule, verdict), one row per page.

    A rule fits its host and all subdomains if the url's path starts with the rule's; the
    longest rule text wins, then the longer host. Pages that no rule fits have a null
    rule and the default verdict; so do null urls and urls without ://, whose host and
    path are empty. Equal rules with different verdicts: block wins. Null and repeated
    ids, repeated rows and urls of any length are rows like others; an empty table gives
    an empty one; other columns of pages, whatever their names, take no part.

    The key of a rule is its host's labels in reverse, a separator and its path, so all
    it fits at that depth of host is the interval of keys that start with it. A url is
    one point for each depth that rules have. Keys are dealt out by range, a rule to
    every range that its interval touches; a key that fills several ranges is spread
    over them. In a range, a sweep over the sorted keys keeps a stack of open rules.
    """
    spark = pages.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rules = (
        rules.filter("host IS NOT NULL AND path IS NOT NULL")
        .groupBy(F.lower("host").alias("host"), "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(
            F.concat("host", "path").alias("rule"),
            "verdict",
            F.size(F.split("host", r"\.")).alias("depth"),
            F.concat(_reversed(F.split("host", r"\.")), F.lit(_SEP), "path").alias("key"),
        )
    )
    # a rule of n labels takes 2n letters, so there are fewer depths than the square root of all rules' letters
    depths = sorted(r.depth for r in rules.select("depth").distinct().collect())
    url = F.col("url").cast("string")
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    base = base.groupBy("page_id", "host", "path").agg(F.count("*").alias("n"))
    base = base.withColumn("salt", F.xxhash64("page_id", "host", "path"))
    base = base.withColumn("labels", F.split("host", r"\."))
    # each page has one row for each depth of rules that its host has, or one of depth 0, which no rule has
    own = F.array_intersect(F.sequence(F.lit(1), F.size("labels")), F.lit(depths or [0]).cast("array<int>"))
    probes = base.select("page_id", "n", "salt", "host", "path", "labels", F.explode(F.when(F.size(own) > 0, own).otherwise(F.array(F.lit(0)))).alias("depth"))
    tail = F.slice("labels", F.size("labels") - F.col("depth") + 1, F.col("depth"))
    probes = probes.withColumn("key", F.when(F.col("depth") > 0, F.concat(_reversed(tail), F.lit(_SEP), "path")).otherwise("")).drop("labels")
    sample = probes.select("key", F.xxhash64("key", "page_id").alias("h")).orderBy("h").limit(BOUNDARY_SAMPLE)
    keys = sorted(r.key.encode() for r in sample.select("key").collect())
    bounds = [keys[i * len(keys) // parts] for i in range(1, parts)] if keys else []
    edges = np.array(bounds, dtype=object)

    @F.pandas_udf("int")
    def range_of(key: pd.Series, salt: pd.Series) -> pd.Series:
        k = np.array([x.encode() for x in key], dtype=object)
        low, high = np.searchsorted(edges, k, "left"), np.searchsorted(edges, k, "right")
        return pd.Series((low + salt.to_numpy(np.int64) % (high - low + 1)).astype(np.int32))

    @F.pandas_udf("array<int>")
    def ranges_of(key: pd.Series) -> pd.Series:
        k = [x.encode() for x in key]
        low = np.searchsorted(edges, np.array(k, dtype=object), "left")
        high = np.searchsorted(edges, np.array([x + b"\xff" for x in k], dtype=object), "right")
        return pd.Series([list(range(a, b + 1)) for a, b in zip(low, high, strict=True)])

    points = probes.withColumn("part", range_of("key", "salt")).select(
        "part", "key", F.lit(1).alias("kind"), "page_id", "n", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict")
    )
    spans = rules.select(F.explode(ranges_of("key")).alias("part"), "key", "rule", "verdict").select(
        "part", "key", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("page_id"), F.lit(0).cast("long").alias("n"),
        F.lit("").alias("host"), F.lit("").alias("path"), "rule", "verdict",
    )

    def sweep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stack: list[tuple[str, str, str]] = []
        part = None
        for frame in frames:
            found = []
            for p, key, kind, rule, verdict in zip(frame.part, frame.key, frame.kind, frame.rule, frame.verdict, strict=True):
                if p != part:
                    part, stack = p, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    stack.append((key, rule, verdict))
                found.append(stack[-1][1:] if stack and kind else (None, None))
            points = frame.kind == 1
            if not points.any():
                continue
            out = frame.loc[points, ["page_id", "n", "host", "path"]].copy()
            hit = [f for f, is_point in zip(found, points, strict=True) if is_point]
            out["rule"] = [f[0] for f in hit]
            out["verdict"] = [f[1] for f in hit]
            out["page_id"] = out["page_id"].astype("Int64")
            yield out

    merged = points.unionByName(spans).repartition(parts, "part").sortWithinPartitions("part", "key", "kind")
    judged = merged.mapInPandas(sweep, "page_id long, n long, host string, path string, rule string, verdict string")
    size = F.when(F.col("rule").isNotNull(), F.length("rule"))
    at = F.length("rule") - F.length(F.regexp_extract("rule", "(/.*)?$", 0))
    best = judged.groupBy("page_id", "host", "path").agg(
        F.max(F.struct(size.alias("size"), at.alias("at"), "rule", "verdict")).alias("best"),
        F.max("n").alias("n"),
    )
    return best.select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        F.explode(F.expr("sequence(1L, n)")).alias("_"),
    ).drop("_")


def op3_urlrules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(table(spark, sf_dir, "pages"), rules)
