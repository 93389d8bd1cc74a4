"""Interval overlap, containment and nearest-neighbour joins within a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lacuna.operators.keyed import first_by


def overlap_argmax(pauses: DataFrame, gaps: DataFrame, key: str) -> DataFrame:
    """Each pause (key, lo, hi) with the gap (key, k, g_lo, g_hi) it overlaps most, the later of equal ones, and then
    for each gap the longest of its pauses, the first of equal ones. Gaps of a key don't overlap each other.

    One window over a key's ends finds which gaps a pause spans; pauses meet these gaps only."""
    order = Window.partitionBy(key).orderBy("g_lo", "k")
    numbered = gaps.where("g_lo < g_hi").withColumn("__o", F.row_number().over(order))
    ends = lambda c, what: pauses.select(key, F.col(c).alias("at"), F.lit(what).alias("what"), "lo", "hi", F.lit(None).cast("int").alias("__o"))
    starts = numbered.select(key, F.col("g_lo").alias("at"), F.lit(1).alias("what"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"), "__o")
    # a pause's start comes behind a gap that starts there, its end before one
    line = starts.unionByName(ends("lo", 2)).unionByName(ends("hi", 0))
    seen = F.coalesce(F.max("__o").over(Window.partitionBy(key).orderBy("at", "what").rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    spans = line.withColumn("seen", seen).where("what <> 1").groupBy(key, "lo", "hi").agg(F.min("seen").alias("a"), F.max("seen").alias("b"))
    j = spans.select(key, "lo", "hi", F.explode(F.sequence(F.greatest("a", F.lit(1)), F.greatest("b", F.lit(1)))).alias("__o")).join(numbered, [key, "__o"]).drop("__o")
    j = j.withColumn("overlap", F.least("hi", "g_hi") - F.greatest("lo", "g_lo")).where("overlap > 0")
    best = first_by(j, [key, "lo", "hi"], F.desc("overlap"), F.desc("k"))
    return first_by(best, [key, "k"], F.desc(F.col("hi") - F.col("lo")), F.asc("lo"))


def around(points: DataFrame, pauses: DataFrame, key: str) -> DataFrame:
    """points (t and other columns) with `near`: in order, the last two of the key's pauses that start at t or before and the first behind it.

    Pauses of a key don't overlap (they may touch), so that one of these holds t if any does, and one's middle is nearest. One window
    over a key's points and pauses takes the place of a join: its rows are sorted, not multiplied."""
    w = Window.partitionBy(key).orderBy("lo", "hi")
    own = F.struct("lo", "hi")
    marks = pauses.select(key, F.col("lo").alias("__at"), F.lit(0).alias("__kind"), own.alias("__own"), F.lag(own).over(w).alias("__before"))
    rows = points.withColumns({"__at": F.col("t"), "__kind": F.lit(1)})
    line = Window.partitionBy(key).orderBy("__at", "__kind")
    back, ahead = line.rowsBetween(Window.unboundedPreceding, 0), line.rowsBetween(1, Window.unboundedFollowing)
    both = F.when(F.col("__own").isNotNull(), F.struct(F.col("__before").alias("a"), F.col("__own").alias("b")))
    out = rows.unionByName(marks, allowMissingColumns=True).withColumns({"__l": F.last(both, ignorenulls=True).over(back), "__r": F.first("__own", ignorenulls=True).over(ahead)})
    near = F.array_compact(F.array(F.col("__l.a"), F.col("__l.b"), F.col("__r")))
    return out.where("__kind = 1").withColumn("near", near).select(*points.columns, "near")


def middle(p: Column) -> Column:
    return (p["lo"] + p["hi"]) / 2


def holding(t: Column, near: Column) -> Column:
    """The first of the pauses that holds t, ends included; null if none does."""
    return F.get(F.filter(near, lambda p: t.between(p["lo"], p["hi"])), F.lit(0))


def closest(t: Column, near: Column) -> Column:
    """The pause whose middle is nearest to t, the first of equal ones."""
    return F.array_min(F.transform(near, lambda p: F.struct(F.abs(middle(p) - t).alias("away"), p["lo"].alias("lo"), p["hi"].alias("hi"))))


def containing(points: DataFrame, pauses: DataFrame, key: str, point_id: str) -> DataFrame:
    """Each point (key, id, t) with the first pause that holds it, ends included."""
    j = around(points, pauses, key).withColumn("p", holding(F.col("t"), F.col("near"))).where("p IS NOT NULL")
    return j.select(*points.columns, "p.lo", "p.hi")


def nearest(points: DataFrame, pauses: DataFrame, key: str, point_id: str, tolerance: float) -> DataFrame:
    """Each point with the pause whose middle is nearest, the first of equal ones, if within the tolerance."""
    j = around(points, pauses, key).withColumn("p", closest(F.col("t"), F.col("near"))).where(F.col("p.away") <= tolerance)
    return j.select(*points.columns, "p.lo", "p.hi", middle(F.col("p")).alias("mid"), "p.away")


def local_gap(points: DataFrame, pauses: DataFrame, key: str, search: float) -> DataFrame:
    """points with `at`: the middle of the nearest pause within the search on either side, else t itself."""
    j = around(points, pauses, key).withColumn("p", closest(F.col("t"), F.col("near")))
    return j.select(*points.columns, F.when(F.col("p.away") <= search, middle(F.col("p"))).otherwise(F.col("t")).alias("at"))


def snap(points: DataFrame, pauses: DataFrame, key: str, point_id: str, tolerance: float, enabled: bool = True) -> DataFrame:
    """(key, id, t, at, status, shift, pause): into the pause that holds the point, else to the nearest within the tolerance, else where it was.

    Not enabled, every point stays where it was, with the status disabled."""
    none = F.lit(0.0)
    if not enabled:
        return points.select(key, point_id, "t", F.col("t").alias("at"), F.lit("disabled").alias("status"), none.alias("shift"), none.alias("pause"))
    t = F.col("t")
    j = around(points, pauses, key).withColumns({"__in": holding(t, F.col("near")), "__by": closest(t, F.col("near"))})
    inside = F.col("__in").isNotNull()
    ok = F.coalesce(inside | (F.col("__by.away") <= tolerance), F.lit(False))
    pick = F.when(inside, F.col("__in")).when(ok, F.struct(F.col("__by.lo").alias("lo"), F.col("__by.hi").alias("hi")))
    j = j.withColumn("__p", pick)
    status = F.when(inside, "in_pause").when(ok, "snapped").otherwise("no_pause")
    mid = middle(F.col("__p"))
    return j.select(key, point_id, "t", F.coalesce(mid, t).alias("at"), status.alias("status"), F.coalesce(F.abs(mid - t), none).alias("shift"), F.coalesce(F.col("__p.hi") - F.col("__p.lo"), none).alias("pause"))


def island_around(runs: DataFrame, points: DataFrame, key: str) -> DataFrame:
    """(key, before, after): how much of the run (lo, hi) that holds the key's point t lies on either side; 0 without one."""
    j = points.join(runs, key, "left").withColumn("in", F.coalesce(F.col("t").between(F.col("lo"), F.col("hi")), F.lit(False)))
    pick = lambda c: F.coalesce(F.max(F.when(F.col("in"), c)), F.lit(0.0))
    return j.groupBy(key).agg(pick(F.col("t") - F.col("lo")).alias("before"), pick(F.col("hi") - F.col("t")).alias("after"))


def token_map(words: DataFrame, tokens: DataFrame, key: str) -> DataFrame:
    """(key, ok, at): for each word (key, w, clean) its token's number among tokens (key, p, clean), tokens that clean to nothing being
    skipped; ok is false and at null where a word has no equal token at its turn."""
    order = lambda c: F.row_number().over(Window.partitionBy(key).orderBy(c))
    a = words.withColumn("o", order("w"))
    b = tokens.where("clean <> ''").withColumn("o", order("p")).select(key, "o", "p", F.col("clean").alias("token"))
    j = a.join(b, [key, "o"], "left")
    ok = F.every(F.coalesce(F.col("clean") == F.col("token"), F.lit(False)))
    return j.groupBy(key).agg(ok.alias("ok"), F.sort_array(F.collect_list(F.struct("o", "p"))).alias("l")).select(key, "ok", F.when(F.col("ok"), F.transform("l", lambda x: x["p"])).alias("at"))


def gap_column(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))
