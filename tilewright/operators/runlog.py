"""Run status of slides: gates, latest status, roll-ups, resuming and cleaning up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def failure_code() -> Column:
    """The first gate that a slide's counts fail, else OK.

    Reads dir_exists, n_seg (null: no folder), masker_log, n_pred (null: no folder),
    max_value (null: no heatmap) and n_nonzero.
    """
    return (
        F.when(~F.col("dir_exists"), "DIR_NOT_FOUND")
        .when(F.col("n_seg").isNull(), "STAGE1_FAILED")
        .when(F.col("n_seg") == 0, "STAGE1_EMPTY")
        .when(~F.col("masker_log"), "TILEMASKER_LOG_MISSING")
        .when(F.col("n_pred").isNull(), "STAGE2_FAILED")
        .when(F.col("n_pred") == 0, "STAGE2_EMPTY")
        .when(F.col("max_value").isNull(), "STAGE3_FAILED")
        .when(F.col("max_value") > 100_000, "STAGE3_ABNORMAL")
        .when(F.col("n_nonzero") == 0, "STAGE3_VERIFY_FAILED")
        .otherwise("OK")
    )


def status(code: Column) -> Column:
    return F.when(code == "OK", "OK").when(code == "STAGE3_ABNORMAL", "WARN").otherwise("FAIL")


def latest(log: DataFrame) -> DataFrame:
    """The last (slide, code, ts, seq) of each slide, by ts, then seq."""
    last = F.max_by(F.struct("code", "ts"), F.struct("ts", "seq"))
    return log.groupBy("slide").agg(last.alias("l")).select("slide", "l.code", "l.ts")


def results_by(log: DataFrame, key: str) -> DataFrame:
    """Slides in all, reprocessed (last code OK or a warning) and failed, by key."""
    last = log.groupBy("slide", key).agg(F.max_by("code", F.struct("ts", "seq")).alias("code"))
    state = status(F.col("code"))
    return last.groupBy(key).agg(F.count("*").alias("slides"), F.count_if(state != "FAIL").alias("reprocessed"), F.count_if(state == "FAIL").alias("failed"))


def stage_timing(log: DataFrame) -> DataFrame:
    """Seconds from each entry of a slide (stage, ts, seq) to its next, summed by stage."""
    nxt = F.lead("ts").over(Window.partitionBy("slide").orderBy("ts", "seq"))
    spent = F.timestamp_diff("SECOND", F.col("ts"), F.col("_next"))
    rows = log.withColumn("_next", nxt).filter("_next IS NOT NULL")
    return rows.groupBy("stage").agg(F.count("*").alias("runs"), F.sum(spent).alias("seconds")).withColumn("minutes", F.expr("seconds div 60"))


def pending(wanted: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Wanted rows that aren't done: by identity, not by count."""
    return wanted.join(done.select(*keys), keys, "left_anti")


def present(wanted: DataFrame, there: DataFrame, key: str) -> DataFrame:
    """Wanted rows with a code: OK if there, else DIR_NOT_FOUND."""
    flags = there.select(key).distinct().withColumn("_there", F.lit(True))
    return wanted.join(flags, key, "left").withColumn("code", F.when(F.col("_there"), "OK").otherwise("DIR_NOT_FOUND")).drop("_there")


def would_free(files: DataFrame) -> DataFrame:
    """(stain, slide, kb) of intermediate files -> slides with something to free, kB, MB and GB in whole units."""
    by_slide = files.groupBy("stain", "slide").agg(F.sum("kb").alias("kb")).filter("kb > 0")
    return by_slide.groupBy("stain").agg(F.count("*").alias("slides"), F.sum("kb").alias("kb")).withColumn("mb", F.expr("kb div 1024")).withColumn("gb", F.expr("kb div 1048576"))


def entries(results: DataFrame) -> DataFrame:
    """(slide, code[, detail]) -> (slide, log, line): the log a slide's line goes to, success for OK and warnings, failure for all but OK."""
    detail = F.col("detail") if "detail" in results.columns else F.lit(None).cast("string")
    line = F.when(F.col("code") == "OK", F.col("slide").cast("string")).otherwise(F.concat_ws("|", F.col("slide").cast("string"), "code", detail))
    logs = F.when(F.col("code") == "OK", F.array(F.lit("success"))).when(status(F.col("code")) == "WARN", F.array(F.lit("success"), F.lit("failure"))).otherwise(F.array(F.lit("failure")))
    return results.select("slide", F.explode(logs).alias("log"), line.alias("line"))


def error_counts(log: DataFrame) -> DataFrame:
    """Entries and errors (code other than OK) of each stage."""
    return log.groupBy("stage").agg(F.count("*").alias("entries"), F.count_if(F.col("code") != "OK").alias("errors"))


def first_errors(log: DataFrame, n: int = 10) -> DataFrame:
    """(seq, message): the first n errors by seq and, if there are more, a last row that says how many, seq null."""
    errors = log.filter(F.col("code") != "OK").select("seq", F.concat_ws(" ", F.col("slide").cast("string"), "code").alias("message"))
    more = errors.agg((F.count("*") - n).alias("k")).filter("k > 0").select(F.lit(None).cast("long").alias("seq"), F.format_string("... and %d more", "k").alias("message"))
    return errors.orderBy("seq").limit(n).unionByName(more)


def conversion_state(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """wanted (slide) against files (slide, kind: full or small): done if both are there, resume if only the full one is, else convert."""
    there = files.groupBy("slide").agg(F.count_if(F.col("kind") == "full").alias("_f"), F.count_if(F.col("kind") == "small").alias("_s"))
    state = F.when((F.col("_f") > 0) & (F.col("_s") > 0), "done").when(F.col("_f") > 0, "resume").otherwise("convert")
    return wanted.join(there, "slide", "left").withColumn("state", state).drop("_f", "_s")


def stage_states(slides: DataFrame) -> DataFrame:
    """(slide, code) of slides -> (slide, stage, state): each of the three stages is ok, failed (the code's own) or not reached."""
    failed = F.when(F.col("code") == "DIR_NOT_FOUND", 0).when(F.col("code").startswith("STAGE1") | F.col("code").startswith("TILEMASKER"), 1).when(F.col("code").startswith("STAGE2"), 2)
    failed = failed.when(F.col("code").isin("STAGE3_FAILED", "STAGE3_VERIFY_FAILED"), 3).otherwise(9)
    rows = slides.select("slide", failed.alias("_f"), F.posexplode(F.array(*map(F.lit, ("masking", "prediction", "heatmap")))).alias("_k", "stage"))
    return rows.select("slide", "stage", F.when(F.col("_k") + 1 < F.col("_f"), "ok").when(F.col("_k") + 1 == F.col("_f"), "failed").otherwise("not reached").alias("state"))


def slides_of(log: DataFrame) -> DataFrame:
    """The slides that a log names, once each."""
    return log.select("slide").distinct()
