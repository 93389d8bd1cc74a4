"""Operators on series in long form: rows (key, i, x) with i = 0, 1, ... for each key, and on intervals (key, lo, hi)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def numbered(rows: DataFrame, key: str, value: str, *order: str) -> DataFrame:
    """(key, i, x, n) of the rows of a key in the order."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.select(key, (F.row_number().over(w) - 1).alias("i"), F.col(value).alias("x"), F.count("*").over(Window.partitionBy(key)).alias("n"))


def frames(series: DataFrame, key: str, win: int, hop: int) -> DataFrame:
    """(key, k, i, rms): root mean squares of frames of win values every hop; a short series is one frame."""
    ahead = Window.partitionBy(key).orderBy("i").rowsBetween(0, win - 1)
    rows = series.withColumn("rms", F.sqrt(F.avg(F.col("x") * F.col("x")).over(ahead)))
    whole = (F.col("i") % hop == 0) & (F.col("i") <= F.col("n") - win)
    return rows.where(whole | ((F.col("n") < win) & (F.col("i") == 0))).select(key, (F.col("i") / hop).cast("int").alias("k"), "i", "rms")


def decibels(rms: Column, reference: Column) -> Column:
    return 20 * F.log10(F.greatest(rms, F.lit(1e-10)) / F.greatest(reference, F.lit(1e-10)))


def islands(frame_rows: DataFrame, key: str, top_db: float) -> DataFrame:
    """(key, first, last): runs of frames less than top_db below the key's loudest."""
    loud = decibels(F.col("rms"), F.max("rms").over(Window.partitionBy(key))) > -top_db
    rows = frame_rows.withColumn("on", loud)
    w = Window.partitionBy(key).orderBy("k")
    flip = (F.col("on") & ~F.coalesce(F.lag("on").over(w), F.lit(False))).cast("int")
    rows = rows.withColumn("flip", flip).withColumn("island", F.sum("flip").over(w)).where("on")
    return rows.groupBy(key, "island").agg(F.min("k").alias("first"), F.max("k").alias("last")).drop("island")


def merge_close(intervals: DataFrame, key: str, gap: float) -> DataFrame:
    """Intervals joined where less than gap lies between; those that overlap earlier ones count too."""
    w = Window.partitionBy(key).orderBy("lo", "hi")
    before = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = intervals.select(key, "lo", "hi", F.coalesce(F.col("lo") - before >= gap, F.lit(True)).cast("int").alias("new"))
    rows = rows.withColumn("region", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(key, "region").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("region")


def pauses(regions: DataFrame, key: str, margin: float, least: float) -> DataFrame:
    """What lies between consecutive regions, less margin on both sides, where least remains; none before or behind."""
    w = Window.partitionBy(key).orderBy("lo")
    rows = regions.select(key, (F.col("hi") + margin).alias("p_lo"), (F.lead("lo").over(w) - margin).alias("p_hi"))
    return rows.where(F.col("p_hi") - F.col("p_lo") >= least).select(key, F.col("p_lo").alias("lo"), F.col("p_hi").alias("hi"))


def gap_summary(regions: DataFrame, key: str, low: float, high: float) -> DataFrame:
    """(key, pause): the median positive gap between consecutive regions within [low, high]; low without any."""
    w = Window.partitionBy(key).orderBy("lo")
    gaps = regions.select(key, (F.lead("lo").over(w) - F.col("hi")).alias("gap"))
    middle = F.percentile(F.when(F.col("gap") > 0, F.col("gap")), F.lit(0.5))
    return gaps.groupBy(key).agg(F.least(F.greatest(F.coalesce(middle, F.lit(low)), F.lit(low)), F.lit(high)).alias("pause"))


def widest_gap(regions: DataFrame, key: str) -> DataFrame:
    """(key, at): the middle of the widest gap, the later of equal ones; the end of the last region where there is one region only."""
    w = Window.partitionBy(key).orderBy("lo")
    gaps = regions.select(key, "hi", F.lead("lo").over(w).alias("next")).withColumn("gap", F.col("next") - F.col("hi"))
    mid = (F.col("hi") + F.col("next")) / 2
    best = F.max_by(mid, F.when(F.col("gap").isNotNull(), F.struct("gap", mid.alias("m"))))
    return gaps.groupBy(key).agg(F.coalesce(best, F.max("hi")).alias("at"))


def quietest(frame_rows: DataFrame, key: str) -> DataFrame:
    """(key, i): the start of the frame with the least level, the first of equal ones."""
    return frame_rows.groupBy(key).agg(F.min_by("i", F.struct("rms", "i")).alias("i"))


def boundary_activity(series: DataFrame, key: str, cut: Column, win: int) -> DataFrame:
    """(key, before, after): the level of the last and first win values around the cut over that of their side; 0 where a side is silent or empty."""
    rows = series.withColumn("cut", cut)
    i, x2 = F.col("i"), F.col("x") * F.col("x")
    level = lambda c: F.sqrt(F.avg(F.when(c, x2)))
    ratio = lambda edge, side: F.when(F.coalesce(side, F.lit(0.0)) > 0, edge / side).otherwise(0.0)
    left, right = i < F.col("cut"), i >= F.col("cut")
    near_l, near_r = left & (i >= F.col("cut") - win), right & (i < F.col("cut") + win)
    return rows.groupBy(key).agg(ratio(level(near_l), level(left)).alias("before"), ratio(level(near_r), level(right)).alias("after"))


def snr_db(frame_rows: DataFrame, key: str) -> DataFrame:
    """(key, snr): decibels from the 10th to the 90th percentile of levels, within 0-60; 60 below four frames."""
    p = F.percentile("rms", F.array(F.lit(0.1), F.lit(0.9)))
    db = decibels(p[1], p[0])
    return frame_rows.groupBy(key).agg(F.when(F.count("*") < 4, 60.0).otherwise(F.least(F.greatest(db, F.lit(0.0)), F.lit(60.0))).alias("snr"))


def tilt_db(frame_rows: DataFrame, key: str) -> DataFrame:
    """(key, tilt): the slope of decibels over the key's length (0-1), floored at 40 below the loudest, within 60; 0 below four frames."""
    all_ = Window.partitionBy(key)
    rows = frame_rows.select(key, "k", decibels(F.col("rms"), F.max("rms").over(all_)).alias("db"), F.count("*").over(all_).alias("m"))
    rows = rows.withColumn("db", F.greatest("db", F.lit(-40.0))).withColumn("t", F.col("k") / F.greatest(F.col("m") - 1, F.lit(1)))
    return rows.groupBy(key).agg(F.when(F.count("*") < 4, 0.0).otherwise(F.least(F.greatest(F.regr_slope("db", "t"), F.lit(-60.0)), F.lit(60.0))).alias("tilt"))


def peak_rate(frame_rows: DataFrame, key: str, threshold: float, min_gap: int, frames_a_second: float) -> DataFrame:
    """(key, peaks, rate): local maxima of the level (the last frame of a plateau) from the threshold's share of the loudest, kept greedily min_gap frames apart.

    A key's series is one window: a recording has to fit a task, as all operators on series here require."""
    w, all_ = Window.partitionBy(key).orderBy("k"), Window.partitionBy(key)
    rows = frame_rows.withColumn("prev", F.lag("rms").over(w)).withColumn("next", F.lead("rms").over(w)).withColumn("top", F.max("rms").over(all_))
    peak = (F.col("rms") >= F.col("prev")) & (F.col("rms") > F.col("next")) & (F.col("rms") / (F.col("top") + 1e-9) >= threshold)
    found = rows.groupBy(key).agg(F.count("*").alias("m"), F.sort_array(F.collect_list(F.when(peak, F.col("k")))).alias("ks"))
    start = F.struct(F.lit(0).alias("n"), F.lit(-(10**9)).alias("last"))
    fold = F.aggregate("ks", start, lambda s, k: F.when(k - s["last"] >= min_gap, F.struct((s["n"] + 1).alias("n"), k.alias("last"))).otherwise(s), lambda s: s["n"])
    return found.select(key, fold.alias("peaks"), (fold * frames_a_second / F.col("m")).alias("rate"))


def position_ranks(rows: DataFrame, group: str, value: str, tie: str, out: str, parts: int = 64) -> DataFrame:
    """Ranks by position in a stable order, from 0 to 1; equal values don't share one, and a lone row has 0.5. Nulls come first.

    A group is cut into ranges of values first, by approximate quantiles: a row's rank is its place in its range and how
    many rows the ranges before have, so that a large group isn't sorted by one task. The cuts decide the work only, not the result."""
    shares = [k / parts for k in range(1, parts)]
    cuts = rows.groupBy(F.col(group).alias("__g")).agg(F.percentile_approx(value, shares, 1000).alias("__cuts"), F.count("*").alias("__n"))
    dealt = rows.join(cuts, F.col(group).eqNullSafe(F.col("__g")))
    dealt = dealt.withColumn("__part", F.size(F.filter(F.coalesce("__cuts", F.array()), lambda x: x < F.col(value)))).drop("__g", "__cuts")
    sizes = dealt.groupBy(F.col(group).alias("__g"), F.col("__part").alias("__p")).agg(F.count("*").alias("__size"))
    ahead = Window.partitionBy("__g").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("__g", "__p", F.coalesce(F.sum("__size").over(ahead), F.lit(0)).alias("__before"))
    placed = dealt.join(sizes, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__part") == F.col("__p")))
    place = F.col("__before") + F.row_number().over(Window.partitionBy(group, "__part").orderBy(value, tie)) - 1
    ranked = placed.withColumn(out, F.when(F.col("__n") > 1, place / (F.col("__n") - 1)).otherwise(0.5))
    return ranked.drop("__n", "__part", "__g", "__p", "__before")


def level_features(series: DataFrame, key: str, rate: float) -> DataFrame:
    """(key, peak, level, duration, clipping): level over peak, length in seconds, share of values at full scale."""
    peak = F.max(F.abs("x"))
    return series.groupBy(key).agg(
        peak.alias("peak"), (F.sqrt(F.avg(F.col("x") * F.col("x"))) / (peak + 1e-9)).alias("level"), (F.count("*") / rate).alias("duration"), F.avg((F.abs("x") >= 0.999).cast("int")).alias("clipping"))


def energy_regions(frame_rows: DataFrame, key: str, top_db: float, win: int, hop: int, gap: float, least: float) -> DataFrame:
    """(key, lo, hi) in values: loud runs of frames, joined where less than gap lies between, of at least `least`."""
    runs = islands(frame_rows, key, top_db).select(key, (F.col("first") * float(hop)).alias("lo"), (F.col("last") * float(hop) + win).alias("hi"))
    return merge_close(runs, key, gap).where(F.col("hi") - F.col("lo") >= least)


def sample_index(seconds: Column, rate: float, n: Column) -> Column:
    """A time's place among n values: cut towards zero, within 0-n."""
    return F.least(F.greatest((seconds * rate).cast("long"), F.lit(0)), n).cast("long")


def spread(value: str, width: float) -> Column:
    """From the 10th to the 90th percentile in widths of an axis."""
    p = F.percentile(value, F.array(F.lit(0.1), F.lit(0.9)))
    return (p[1] - p[0]) / width


def least_squares(rows: DataFrame, y: Column, a: Column, b: Column) -> DataFrame:
    """One row (slope_a, slope_b, const, residual): y by two axes and a constant, from moments of one pass; residual is the deviation that is left."""
    m = rows.agg(F.covar_pop(a, y).alias("ay"), F.covar_pop(b, y).alias("by"), F.covar_pop(a, b).alias("ab"), F.var_pop(a).alias("aa"), F.var_pop(b).alias("bb"), F.var_pop(y).alias("yy"), F.avg(y).alias("y"), F.avg(a).alias("a"), F.avg(b).alias("b"))
    m = m.withColumn("slope_a", F.expr("(ay * bb - by * ab) / (aa * bb - ab * ab)")).withColumn("slope_b", F.expr("(by * aa - ay * ab) / (aa * bb - ab * ab)"))
    return m.select("slope_a", "slope_b", F.expr("y - slope_a * a - slope_b * b").alias("const"), F.expr("sqrt(greatest(yy - slope_a * ay - slope_b * by, 0))").alias("residual"))
