"""Stages: rows that are not done yet pass through a plan, and the outcome is upserted into the stage's table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from lacuna.functions import text as T
from lacuna.operators import gates, keyed, match, series
from lacuna.schemas import Settings
from lacuna.sources.manifest import read_stage, write_stage


def run_stage(rows: DataFrame, path: str, schema: str, work: Callable[[DataFrame], DataFrame], key: str = "id", force: bool = False, limit: int | None = None) -> DataFrame:
    """work on the rows that path's table lacks; the table as it is then."""
    spark = rows.sparkSession
    cached = read_stage(spark, path, schema)
    left = keyed.todo(rows, cached, key, force)
    left = left.orderBy(key).limit(limit) if limit else left
    fresh = path.rstrip("/") + ".fresh"
    work(left).write.mode("overwrite").parquet(fresh)  # once: the upsert reads it twice, and work may hold a model
    write_stage(keyed.upsert(cached, spark.read.parquet(fresh), key), path)
    return read_stage(spark, path, schema)


def slots(rows: DataFrame, islands: DataFrame, words: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """(id, candidates) of rows (id, text), speech islands (id, lo, hi) and word times (id, w, word, start, stop): the pauses that
    lie between words, each with where it falls in the text. Rows that were measured and offer none have an empty array."""
    pauses = series.pauses(series.merge_close(islands, "id", cfg.merge_gap_s), "id", cfg.margin_s, cfg.min_pause_s)
    spans = T.token_rows(rows.select("id", "text"), "text").drop("stop")
    clean = spans.withColumn("clean", T.aligner_token(F.col("token")))
    spoken = words.select("id", "w", T.aligner_token(F.col("word")).alias("clean"), "start", "stop")
    mapped = match.token_map(spoken, clean.select("id", "p", "clean"), "id").where("ok")
    order = F.row_number().over(keyed.Window.partitionBy("id").orderBy("w"))
    at = mapped.select("id", F.posexplode("at").alias("o", "p")).withColumn("o", F.col("o") + 1)
    timed = spoken.withColumn("o", order).join(at, ["id", "o"]).join(clean.select("id", "p", F.col("start").alias("offset"), F.col("token").alias("after")), ["id", "p"])
    w = keyed.Window.partitionBy("id").orderBy("o")
    gaps = timed.select("id", F.col("o").alias("k"), F.lag("stop").over(w).alias("g_lo"), F.col("start").alias("g_hi"), "offset", F.lag("after").over(w).alias("before"), "after").where("g_lo IS NOT NULL")
    best = match.overlap_argmax(pauses, gaps, "id")
    one = F.struct("k", ((F.col("lo") + F.col("hi")) / 2).alias("time_s"), (F.col("hi") - F.col("lo")).alias("pause_s"), F.col("offset").alias("char_offset"), "before", "after")
    found = best.groupBy("id").agg(F.sort_array(F.collect_list(one)).alias("l"))
    numbered = F.transform("l", lambda x, i: F.struct((i + 1).cast("int").alias("i"), x["time_s"].alias("time_s"), x["pause_s"].alias("pause_s"), x["char_offset"].alias("char_offset"), x["before"].alias("before"), x["after"].alias("after")))
    empty = F.array().cast("array<struct<i:int,time_s:double,pause_s:double,char_offset:int,before:string,after:string>>")
    return rows.select("id").join(found.select("id", numbered.alias("candidates")), "id", "left").withColumn("candidates", F.coalesce("candidates", empty))


def align(rows: DataFrame, estimates: DataFrame, pauses: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Rows with a slot's time keep it; others go from the first aligner that has one (columns of estimates, in order) to the nearest pause."""
    stages = [c for c in estimates.columns if c != "id"]
    stage = F.coalesce(*[F.when(F.col(c).isNotNull(), c) for c in stages])
    chosen = rows.where("insert_at_s IS NOT NULL").select("id", "insert_at_s", F.lit("vad_slot").alias("insert_stage"), F.col("insert_at_s").alias("insert_at_aligned_s"), F.lit("slot").alias("vad_status"), F.lit(0.0).alias("vad_shift_s"), "pause_s")
    rest = rows.where("insert_at_s IS NULL").select("id").join(estimates, "id").select("id", F.coalesce(*stages).alias("t"), stage.alias("insert_stage")).where("t IS NOT NULL")
    snapped = match.snap(rest.select("id", F.lit(0).alias("one"), "t"), pauses, "id", "one", cfg.max_shift_s)
    if cfg.on_no_pause == "skip":
        snapped = snapped.where("status <> 'no_pause'")
    fresh = snapped.join(rest.select("id", "insert_stage"), "id").select("id", F.col("at").alias("insert_at_s"), "insert_stage", F.col("t").alias("insert_at_aligned_s"), F.col("status").alias("vad_status"), F.col("shift").alias("vad_shift_s"), F.col("pause").alias("pause_s"))
    return chosen.unionByName(fresh).withColumnRenamed("pause_s", "vad_pause_s")


def gate(rows: DataFrame, measures: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """rows with their measures and reasons; rows without measures stay, those with a reason have kept false."""
    m, j = F.col, rows.join(measures, "id", "left")
    why = gates.reasons({
        "mos_drop": gates.drop_rule(m("source.mos"), m("para.mos"), cfg.max_mos_drop), "discontinuity_drop": gates.drop_rule(m("source.discontinuity"), m("para.discontinuity"), cfg.max_discontinuity_drop),
        "boundary_activity": gates.boundary_rule(m("boundary_activity.before"), m("boundary_activity.after"), cfg.max_boundary_activity),
    })
    return j.withColumn("reasons", why).withColumn("kept", F.size("reasons") == 0)
