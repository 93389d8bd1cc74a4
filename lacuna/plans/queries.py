"""Registered queries over the driver's tables, and the equivalent SQL.

Rows of events by user are the series (value) and the intervals ([ts, ts + value * 300 s]); part is the clip corpus and
p_type the event class; orders are the rows that need a clip; documents and conversations are transcripts;
labels is a stage table that lacks some rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lacuna.functions import text as T
from lacuna.operators import gates, keyed, match, select, series

QUERIES: dict = {}
SQL: dict[str, str] = {}
WIN, HOP = 8, 4
GAP, MARGIN, LEAST = 3600.0, 300.0, 7200.0


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- keyed tables ------------------------------------------------------------------------------------------------


@query("SELECT d.doc_id, d.source, l.quality FROM documents d JOIN labels l USING (doc_id)")
def pair_inner(spark, d):
    return table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id")


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def resume_todo(spark, d):
    return keyed.todo(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"), "doc_id")


@query("SELECT doc_id, source FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) AND doc_id IN (SELECT vec_id FROM embeddings)")
def resume_done(spark, d):
    evidence = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"))
    return keyed.finished(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"), evidence, "doc_id")


@query("""WITH fresh AS (SELECT doc_id, 1 - quality AS quality, 2 AS version FROM labels WHERE toxic = 1),
cached AS (SELECT doc_id, quality, 1 AS version FROM labels)
SELECT * FROM fresh UNION ALL SELECT * FROM cached WHERE doc_id NOT IN (SELECT doc_id FROM fresh)""")
def upsert_by_id(spark, d):
    """Every label is cached; those of toxic texts come anew."""
    labels = table(spark, d, "labels")
    fresh = labels.where("toxic = 1").select("doc_id", (1 - F.col("quality")).alias("quality"), F.lit(2).alias("version"))
    return keyed.upsert(labels.select("doc_id", "quality", F.lit(1).alias("version")), fresh, "doc_id")


@query("SELECT user_id, max_by(event_id, CAST(epoch_us(ts) AS HUGEINT) * 1000000 + event_id) AS event_id, max_by(event_type, CAST(epoch_us(ts) AS HUGEINT) * 1000000 + event_id) AS event_type FROM events GROUP BY user_id")
def last_wins(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    return keyed.last_wins(rows, "user_id", F.struct("ts", "event_id")).select("user_id", "event_id", "event_type")


@query("SELECT d.doc_id, d.lang, coalesce(l.quality, CAST(d.n_chars % 2 AS INT)) AS quality FROM documents d LEFT JOIN labels l USING (doc_id)")
def overlay_columns(spark, d):
    old = table(spark, d, "documents").select("doc_id", "lang", (F.col("n_chars") % 2).cast("int").alias("quality"))
    return keyed.overlay(old, table(spark, d, "labels").select("doc_id", "quality"), "doc_id")


@query("SELECT l.doc_id, l.toxic, d.lang, d.source FROM labels l LEFT JOIN documents d USING (doc_id)")
def carry_extras(spark, d):
    return table(spark, d, "labels").select("doc_id", "toxic").join(table(spark, d, "documents").select("doc_id", "lang", "source"), "doc_id", "left")


@query("""SELECT d.doc_id, d.n_chars, CASE WHEN l.quality = d.n_chars % 2 AND l.toxic = 0 THEN l.quality END AS quality, coalesce(l.quality = d.n_chars % 2 AND l.toxic = 0 AND l.quality IS NOT NULL, false) AS current
FROM (SELECT doc_id, n_chars, 0 AS stamp FROM documents) d LEFT JOIN labels l USING (doc_id)""")
def cache_validity(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "n_chars", (F.col("n_chars") % 2).cast("int").alias("splice"), F.lit(0).alias("stamp"))
    cache = table(spark, d, "labels").select("doc_id", F.col("quality").alias("splice"), F.col("toxic").alias("stamp"), "quality")
    return keyed.cache_state(rows, cache, "doc_id", ["splice", "stamp"], ["quality"]).select("doc_id", "n_chars", "quality", "current")


@query("SELECT l.doc_id, d.n_chars FROM labels l JOIN documents d USING (doc_id) ORDER BY d.n_chars, l.doc_id LIMIT 5")
def worst_k(spark, d):
    j = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    return j.orderBy("n_chars", "doc_id").limit(5).select("doc_id", "n_chars")


@query("SELECT event_type, count(*) AS n, CAST(sum(CASE WHEN value > 50 THEN 1 ELSE 0 END) AS BIGINT) AS high, min(event_id) AS first_id FROM events GROUP BY event_type")
def status_counts(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), keyed.count_if(F.col("value") > 50).alias("high"), F.min("event_id").alias("first_id"))


@query("SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 20")
def first_rows(spark, d):
    return table(spark, d, "documents").select("doc_id", "source").orderBy("doc_id").limit(20)


# ---- series ----------------------------------------------------------------------------------------------------

SIG = "sig AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, value AS x, count(*) OVER (PARTITION BY user_id) AS n FROM events)"
FRAMES = SIG + f""", raw AS (SELECT *, sqrt(avg(x * x) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {WIN - 1} FOLLOWING)) AS rms FROM sig),
frames AS (SELECT user_id, CAST(i // {HOP} AS INT) AS k, i, rms FROM raw WHERE (i % {HOP} = 0 AND i <= n - {WIN}) OR (n < {WIN} AND i = 0))"""
DB = "20 * log10(greatest(rms, 1e-10) / greatest(max(rms) OVER (PARTITION BY user_id), 1e-10))"
ISLANDS = FRAMES + f""", lit AS (SELECT user_id, k, {DB} > -3 AS loud FROM frames),
flip AS (SELECT user_id, k, loud, CASE WHEN loud AND NOT coalesce(lag(loud) OVER (PARTITION BY user_id ORDER BY k), false) THEN 1 ELSE 0 END AS f FROM lit),
num AS (SELECT user_id, k, loud, sum(f) OVER (PARTITION BY user_id ORDER BY k) AS g FROM flip),
islands AS (SELECT user_id, min(k) AS first, max(k) AS last FROM num WHERE loud GROUP BY user_id, g)"""
REGIONS = f"""iv AS (SELECT user_id, epoch_us(ts) / 1e6 AS lo, epoch_us(ts) / 1e6 + value * 300 AS hi FROM events),
mark AS (SELECT *, CASE WHEN lo - max(hi) OVER (PARTITION BY user_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) < {GAP} THEN 0 ELSE 1 END AS f FROM iv),
num AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS g FROM mark),
regions AS (SELECT user_id, min(lo) AS lo, max(hi) AS hi FROM num GROUP BY user_id, g)"""
PAUSES = REGIONS + f""", cand AS (SELECT user_id, hi + {MARGIN} AS lo, lead(lo) OVER (PARTITION BY user_id ORDER BY lo) - {MARGIN} AS hi FROM regions),
pauses AS (SELECT * FROM cand WHERE hi - lo >= {LEAST})"""


def signal(spark, d):
    return series.numbered(table(spark, d, "events"), "user_id", "value", "ts", "event_id")


def frame_rows(spark, d):
    return series.frames(signal(spark, d), "user_id", WIN, HOP)


def seconds(ts="ts"):
    return F.unix_micros(F.col(ts).cast("timestamp")) / 1e6


def intervals(spark, d):
    return table(spark, d, "events").select("user_id", seconds().alias("lo"), (seconds() + F.col("value") * 300).alias("hi"))


def region_rows(spark, d):
    return series.merge_close(intervals(spark, d), "user_id", GAP)


def pause_rows(spark, d):
    return series.pauses(region_rows(spark, d), "user_id", MARGIN, LEAST)


def r3(df, *cols):
    return df.withColumns({c: F.round(c, 3) for c in cols})


@query(f"WITH {FRAMES} SELECT user_id, k, i, round(rms, 6) AS rms FROM frames")
def frame_rms(spark, d):
    return frame_rows(spark, d).withColumn("rms", F.round("rms", 6))


@query(f"WITH {ISLANDS} SELECT * FROM islands")
def nonsilent_islands(spark, d):
    return series.islands(frame_rows(spark, d), "user_id", 3.0)


@query(f"WITH {ISLANDS} SELECT user_id, greatest(min(first) * {HOP} - 2, 0) AS start, max(last) * {HOP} + {WIN} + 2 AS stop FROM islands GROUP BY user_id")
def trim_bounds(spark, d):
    i = series.islands(frame_rows(spark, d), "user_id", 3.0)
    return i.groupBy("user_id").agg(F.greatest(F.min("first") * HOP - 2, F.lit(0)).alias("start"), (F.max("last") * HOP + WIN + 2).alias("stop"))


@query(f"WITH {REGIONS} SELECT user_id, round(lo, 3) AS lo, round(hi, 3) AS hi FROM regions")
def merge_close(spark, d):
    return r3(region_rows(spark, d), "lo", "hi")


@query(f"WITH {PAUSES} SELECT user_id, round(lo, 3) AS lo, round(hi, 3) AS hi FROM pauses")
def pauses(spark, d):
    return r3(pause_rows(spark, d), "lo", "hi")


@query(f"WITH {REGIONS}, g AS (SELECT user_id, lead(lo) OVER (PARTITION BY user_id ORDER BY lo) - hi AS gap FROM regions) SELECT user_id, round(least(greatest(coalesce(quantile_cont(CASE WHEN gap > 0 THEN gap END, 0.5), 60), 60), 86400), 3) AS pause FROM g GROUP BY user_id")
def median_pause(spark, d):
    return r3(series.gap_summary(region_rows(spark, d), "user_id", 60.0, 86400.0), "pause")


@query(f"""WITH {REGIONS}, g AS (SELECT user_id, hi, lead(lo) OVER (PARTITION BY user_id ORDER BY lo) AS nx FROM regions),
b AS (SELECT user_id, (hi + nx) / 2 AS mid, row_number() OVER (PARTITION BY user_id ORDER BY nx - hi DESC, (hi + nx) / 2 DESC) AS r FROM g WHERE nx IS NOT NULL)
SELECT user_id, round(coalesce(max(mid), max(hi)), 3) AS at FROM (SELECT g.user_id, b.mid, g.hi FROM g LEFT JOIN b ON b.user_id = g.user_id AND b.r = 1) GROUP BY user_id""")
def longest_gap(spark, d):
    return r3(series.widest_gap(region_rows(spark, d), "user_id"), "at")


@query(f"WITH {FRAMES}, b AS (SELECT user_id, i, row_number() OVER (PARTITION BY user_id ORDER BY rms, i) AS r FROM frames) SELECT user_id, i FROM b WHERE r = 1")
def quietest_window(spark, d):
    return series.quietest(frame_rows(spark, d), "user_id")


BOUNDARY = SIG + """, e AS (SELECT user_id, sqrt(avg(CASE WHEN i < n // 2 THEN x * x END)) AS l, sqrt(avg(CASE WHEN i >= n // 2 THEN x * x END)) AS r,
  sqrt(avg(CASE WHEN i < n // 2 AND i >= n // 2 - 4 THEN x * x END)) AS nl, sqrt(avg(CASE WHEN i >= n // 2 AND i < n // 2 + 4 THEN x * x END)) AS nr FROM sig GROUP BY user_id),
boundary AS (SELECT user_id, CASE WHEN coalesce(l, 0) > 0 THEN nl / l ELSE 0 END AS before, CASE WHEN coalesce(r, 0) > 0 THEN nr / r ELSE 0 END AS after FROM e)"""


def boundary_rows(spark, d):
    return series.boundary_activity(signal(spark, d), "user_id", F.floor(F.col("n") / 2), 4)


@query(f"WITH {BOUNDARY} SELECT user_id, round(before, 6) AS before, round(after, 6) AS after, before > 0.2 AS active FROM boundary")
def boundary_activity(spark, d):
    return boundary_rows(spark, d).select("user_id", F.round("before", 6).alias("before"), F.round("after", 6).alias("after"), (F.col("before") > 0.2).alias("active"))


@query(f"""WITH {FRAMES}, p AS (SELECT user_id, count(*) AS m, quantile_cont(rms, 0.1) AS a, quantile_cont(rms, 0.9) AS b FROM frames GROUP BY user_id)
SELECT user_id, round(CASE WHEN m < 4 THEN 60 ELSE least(greatest(20 * log10(greatest(b, 1e-10) / greatest(a, 1e-10)), 0), 60) END, 6) AS snr FROM p""")
def snr_db(spark, d):
    return series.snr_db(frame_rows(spark, d), "user_id").withColumn("snr", F.round("snr", 6))


@query(f"WITH {SIG} SELECT user_id, round(max(abs(x)), 6) AS peak, round(sqrt(avg(x * x)) / (max(abs(x)) + 1e-9), 6) AS level, count(*) / 4.0 AS duration, round(avg(CASE WHEN abs(x) >= 0.999 THEN 1.0 ELSE 0.0 END), 6) AS clipping FROM sig GROUP BY user_id")
def level_features(spark, d):
    out = series.level_features(signal(spark, d), "user_id", 4.0)
    return out.withColumns({c: F.round(c, 6) for c in ("peak", "level", "clipping")})


TILT = FRAMES + f""", db AS (SELECT user_id, greatest({DB}, -40) AS db, k / CAST(greatest(count(*) OVER (PARTITION BY user_id) - 1, 1) AS DOUBLE) AS t FROM frames)"""


@query(f"WITH {TILT} SELECT user_id, round(CASE WHEN count(*) < 4 THEN 0 ELSE least(greatest(regr_slope(db, t), -60), 60) END, 6) AS tilt FROM db GROUP BY user_id")
def envelope_tilt(spark, d):
    return series.tilt_db(frame_rows(spark, d), "user_id").withColumn("tilt", F.round("tilt", 6))


@query(f"""WITH RECURSIVE {FRAMES}, nb AS (SELECT user_id, k, rms, lag(rms) OVER w AS p, lead(rms) OVER w AS q, max(rms) OVER (PARTITION BY user_id) AS top, count(*) OVER (PARTITION BY user_id) AS m FROM frames WINDOW w AS (PARTITION BY user_id ORDER BY k)),
pk AS (SELECT user_id, k FROM nb WHERE rms >= p AND rms > q AND rms / (top + 1e-9) >= 0.25),
kept(user_id, k) AS (SELECT user_id, min(k) FROM pk GROUP BY user_id UNION ALL
  SELECT user_id, k FROM (SELECT pk.user_id, pk.k, row_number() OVER (PARTITION BY pk.user_id ORDER BY pk.k) AS r FROM kept JOIN pk ON pk.user_id = kept.user_id AND pk.k >= kept.k + 6) WHERE r = 1),
c AS (SELECT user_id, count(*) AS n FROM kept GROUP BY user_id), u AS (SELECT user_id, max(m) AS m FROM nb GROUP BY user_id)
SELECT u.user_id, CAST(coalesce(c.n, 0) AS INT) AS peaks, round(coalesce(c.n, 0) * 100.0 / u.m, 6) AS rate FROM u LEFT JOIN c ON c.user_id = u.user_id""")
def envelope_rate(spark, d):
    return series.peak_rate(frame_rows(spark, d), "user_id", 0.25, 6, 100.0).withColumn("rate", F.round("rate", 6))


@query("SELECT event_type, count(value) AS n, round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.9), 6) AS p90 FROM events GROUP BY event_type")
def axis_quantiles(spark, d):
    p = F.percentile("value", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))
    return table(spark, d, "events").groupBy("event_type").agg(F.count("value").alias("n"), p.alias("p")).select("event_type", "n", *[F.round(F.col("p")[i], 6).alias(c) for i, c in enumerate(("p10", "p50", "p90"))])


_OLS = """WITH m AS (SELECT covar_pop(l_quantity, l_extendedprice) AS qy, covar_pop(l_discount, l_extendedprice) AS dy, covar_pop(l_quantity, l_discount) AS qd, var_pop(l_quantity) AS qq, var_pop(l_discount) AS dd,
  avg(l_extendedprice) AS y, avg(l_quantity) AS q, avg(l_discount) AS d, corr(l_quantity, l_extendedprice) AS r FROM lineitem),
s AS (SELECT *, (qy * dd - dy * qd) / (qq * dd - qd * qd) AS b1, (dy * qq - qy * qd) / (qq * dd - qd * qd) AS b2 FROM m)
SELECT round(b1, 3) AS slope_a, round(b2, 3) AS slope_b, round(y - b1 * q - b2 * d, 3) AS const, round(r, 6) AS r FROM s"""


@query(_OLS)
def axis_ols(spark, d):
    q, x, y = F.col("l_quantity"), F.col("l_discount"), F.col("l_extendedprice")
    rows = table(spark, d, "lineitem")
    fit = series.least_squares(rows, y, q, x).join(F.broadcast(rows.agg(F.corr(q, y).alias("r"))))  # one row is broadcast
    return fit.select(*[F.round(c, 3).alias(c) for c in ("slope_a", "slope_b", "const")], F.round("r", 6).alias("r"))


@query(f"""WITH {FRAMES}, c AS (SELECT user_id, sqrt(avg(x * x)) AS ctx FROM sig WHERE i >= n // 2 - {WIN} AND i < n // 2 GROUP BY user_id)
SELECT f.user_id, round(CASE WHEN count(*) < 2 THEN 0.5 ELSE sum(CASE WHEN rms < coalesce(ctx, 0) THEN 1.0 ELSE 0.0 END) / count(*) END, 6) AS energy_rank FROM frames f LEFT JOIN c ON c.user_id = f.user_id GROUP BY f.user_id""")
def energy_rank(spark, d):
    s = signal(spark, d)
    half = F.floor(F.col("n") / 2)
    ctx = s.where((F.col("i") >= half - WIN) & (F.col("i") < half)).groupBy("user_id").agg(F.sqrt(F.avg(F.col("x") * F.col("x"))).alias("ctx"))
    j = series.frames(s, "user_id", WIN, HOP).join(ctx, "user_id", "left")
    less = keyed.count_if(F.col("rms") < F.coalesce("ctx", F.lit(0.0)))
    return j.groupBy("user_id").agg(F.round(F.when(F.count("*") < 2, 0.5).otherwise(less / F.count("*")), 6).alias("energy_rank"))


# ---- interval joins ----------------------------------------------------------------------------------------------

POINTS = "points AS (SELECT user_id, event_id, epoch_us(ts) / 1e6 + 5000 AS t FROM events)"


def point_rows(spark, d):
    return table(spark, d, "events").select("user_id", "event_id", (seconds() + 5000).alias("t"))


@query(f"""WITH {PAUSES}, {POINTS}, j AS (SELECT p.user_id, event_id, t, lo, row_number() OVER (PARTITION BY p.user_id, event_id ORDER BY lo) AS r FROM points p JOIN pauses q ON q.user_id = p.user_id AND t BETWEEN lo AND hi)
SELECT user_id, event_id, round(lo, 3) AS lo FROM j WHERE r = 1""")
def point_in_pause(spark, d):
    return match.containing(point_rows(spark, d), pause_rows(spark, d), "user_id", "event_id").select("user_id", "event_id", F.round("lo", 3).alias("lo"))


@query(f"""WITH {PAUSES}, {POINTS}, j AS (SELECT p.user_id, event_id, abs((lo + hi) / 2 - t) AS away, lo, row_number() OVER (PARTITION BY p.user_id, event_id ORDER BY abs((lo + hi) / 2 - t), lo) AS r FROM points p JOIN pauses q ON q.user_id = p.user_id)
SELECT user_id, event_id, round(lo, 3) AS lo, round(away, 3) AS away FROM j WHERE r = 1 AND away <= 7200""")
def nearest_pause(spark, d):
    out = match.nearest(point_rows(spark, d), pause_rows(spark, d), "user_id", "event_id", 7200.0)
    return out.select("user_id", "event_id", F.round("lo", 3).alias("lo"), F.round("away", 3).alias("away"))


@query(f"""WITH {PAUSES}, {POINTS}, j AS (SELECT p.user_id, event_id, t, lo, hi, coalesce(t BETWEEN lo AND hi, false) AS ins, abs((lo + hi) / 2 - t) AS away FROM points p LEFT JOIN pauses q ON q.user_id = p.user_id),
b AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_id ORDER BY ins DESC, CASE WHEN ins THEN lo ELSE away END, lo) AS r FROM j),
o AS (SELECT *, coalesce(ins OR away <= 7200, false) AS ok FROM b WHERE r = 1)
SELECT user_id, event_id, round(CASE WHEN ok THEN (lo + hi) / 2 ELSE t END, 3) AS at, CASE WHEN ins THEN 'in_pause' WHEN ok THEN 'snapped' ELSE 'no_pause' END AS status, round(CASE WHEN ok THEN away ELSE 0 END, 3) AS shift, round(CASE WHEN ok THEN hi - lo ELSE 0 END, 3) AS pause FROM o""")
def snap_policy(spark, d):
    return r3(match.snap(point_rows(spark, d), pause_rows(spark, d), "user_id", "event_id", 7200.0), "at", "shift", "pause").drop("t")


GAPS = "gaps AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k, epoch_us(ts) / 1e6 AS g_lo, epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) / 1e6 AS g_hi FROM events)"


@query(f"""WITH {PAUSES}, {GAPS}, j AS (SELECT p.user_id, k, lo, hi, least(hi, g_hi) - greatest(lo, g_lo) AS overlap FROM pauses p JOIN gaps g ON g.user_id = p.user_id AND lo < g_hi AND hi > g_lo),
a AS (SELECT *, row_number() OVER (PARTITION BY user_id, lo, hi ORDER BY overlap DESC, k DESC) AS r FROM j WHERE overlap > 0),
b AS (SELECT *, row_number() OVER (PARTITION BY user_id, k ORDER BY hi - lo DESC, lo) AS r2 FROM a WHERE r = 1)
SELECT user_id, k, round(lo, 3) AS lo, round(overlap, 3) AS overlap FROM b WHERE r2 = 1""")
def pause_overlap_gap(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    gaps = table(spark, d, "events").select("user_id", F.row_number().over(w).alias("k"), seconds().alias("g_lo"), (F.unix_micros(F.lead("ts").over(w).cast("timestamp")) / 1e6).alias("g_hi"))
    return match.overlap_argmax(pause_rows(spark, d), gaps, "user_id").select("user_id", "k", F.round("lo", 3).alias("lo"), F.round("overlap", 3).alias("overlap"))


@query(f"""WITH {PAUSES}, mid AS (SELECT user_id, avg(epoch_us(ts) / 1e6) AS t FROM events GROUP BY user_id)
SELECT m.user_id, round(coalesce(max(CASE WHEN t BETWEEN lo AND hi THEN t - lo END), 0), 2) AS before, round(coalesce(max(CASE WHEN t BETWEEN lo AND hi THEN hi - t END), 0), 2) AS after FROM mid m LEFT JOIN pauses p ON p.user_id = m.user_id GROUP BY m.user_id""")
def existing_silence(spark, d):
    points = table(spark, d, "events").groupBy("user_id").agg(F.avg(seconds()).alias("t"))
    return match.island_around(pause_rows(spark, d), points, "user_id").select("user_id", F.round("before", 2).alias("before"), F.round("after", 2).alias("after"))


# ---- text --------------------------------------------------------------------------------------------------------


@query(r"SELECT doc_id, CAST(len(regexp_extract_all(text, '\S+')) AS INT) AS n_tokens, len(regexp_replace(text, '[^\p{L}\p{N}'']', '', 'g')) AS n_letters FROM documents")
def tokens(spark, d):
    return table(spark, d, "documents").select("doc_id", F.size(T.tokens(F.col("text"))).alias("n_tokens"), F.length(T.aligner_token(F.col("text"))).alias("n_letters"))


@query(r"""WITH p AS (SELECT doc_id, unnest(regexp_extract_all(text, '\s*\S+')) AS s, unnest(range(1, len(regexp_extract_all(text, '\s*\S+')) + 1)) AS i FROM documents),
e AS (SELECT doc_id, i, regexp_replace(s, '^\s+', '') AS token, sum(len(s)) OVER (PARTITION BY doc_id ORDER BY i) AS stop FROM p)
SELECT doc_id, token, CAST(stop - len(token) AS INT) AS start, CAST(stop AS INT) AS stop FROM e""")
def token_spans(spark, d):
    return T.token_rows(table(spark, d, "documents").select("doc_id", "text"), "text").drop("p")


TAGGED = "tagged AS (SELECT conv_id, turn, text, text[1:5] || '[' || (CASE turn % 3 WHEN 0 THEN 'sigh' WHEN 1 THEN 'Cough' ELSE 'other' END) || '] ' || text[6:] AS tagged FROM conversations)"


def tagged_rows(spark, d):
    tag = F.element_at(F.array(F.lit("sigh"), F.lit("Cough"), F.lit("other")), (F.col("turn") % 3).cast("int") + 1)
    return table(spark, d, "conversations").select("conv_id", "turn", "text", T.insert_at(F.col("text"), F.lit(5), tag).alias("tagged"))


@query(rf"WITH {TAGGED} SELECT conv_id, turn, tagged, regexp_extract(tagged, '\[[^\[\]]+\]') AS tag FROM tagged")
def insert_tag(spark, d):
    return tagged_rows(spark, d).select("conv_id", "turn", "tagged", T.extract_tag(F.col("tagged")).alias("tag"))


@query(rf"""WITH {TAGGED}, s AS (SELECT *, regexp_extract_all(tagged, '\[([^\[\]]+)\]', 1) AS tags, trim(regexp_replace(regexp_replace(tagged, '\[[^\[\]]+\]', ' ', 'g'), '\s+', ' ', 'g')) AS a, trim(regexp_replace(text, '\s+', ' ', 'g')) AS b FROM tagged)
SELECT conv_id, turn, CASE WHEN len(tags) = 1 AND a = b AND lower(trim(tags[1])) IN ('laughter', 'sigh', 'cough', 'throatclearing', 'sneeze', 'sniff') THEN '[' || lower(trim(tags[1])) || ']' END AS tag FROM s""")
def verify_single_tag(spark, d):
    return tagged_rows(spark, d).select("conv_id", "turn", T.single_tag(F.col("text"), F.col("tagged")).alias("tag"))


@query(rf"""WITH {TAGGED}, s AS (SELECT conv_id, turn, text[1:5] AS l, text[6:] AS r FROM tagged),
w AS (SELECT conv_id, turn, list_filter(list_transform(regexp_extract_all(nfc_normalize(l), '\S+'), lambda x: trim(x, ',.!?;:"''()…')), lambda x: x <> '') AS b, list_filter(list_transform(regexp_extract_all(nfc_normalize(r), '\S+'), lambda x: trim(x, ',.!?;:"''()…')), lambda x: x <> '') AS a FROM s)
SELECT conv_id, turn, CASE WHEN len(a) > 0 AND len(b) > 0 THEN b[len(b)] END AS before, CASE WHEN len(a) > 0 AND len(b) > 0 THEN a[1] END AS after FROM w""")
def words_around_tag(spark, d):
    rows = tagged_rows(spark, d).select("conv_id", "turn", T.words_around(F.col("tagged")).alias("w"))
    return rows.select("conv_id", "turn", F.element_at("w.before", -1).alias("before"), F.element_at("w.after", 1).alias("after"))


@query("SELECT conv_id, turn, text[1:3] || '<1> ' || text[4:7] || '<2> ' || text[8:] AS marked FROM conversations")
def render_markers(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", T.with_markers(F.col("text"), F.array(F.lit(3), F.lit(7))).alias("marked"))


@query(r"""WITH w AS (SELECT conv_id, turn, regexp_extract_all(text, '\S+') AS t FROM conversations)
SELECT conv_id, turn, round(CASE WHEN len(t) > 0 THEN 30.0 * least(2, len(t)) / len(t) ELSE 15.0 END, 6) AS at FROM w""")
def proportional_time(spark, d):
    rows = table(spark, d, "conversations").withColumn("t", T.tokens(F.col("text")))
    tagged = F.concat_ws(" ", F.slice("t", 1, 2), F.lit("[sigh]"), F.expr("slice(t, 3, size(t))"))
    return rows.select("conv_id", "turn", F.round(T.tag_time(tagged, F.lit(30.0)), 6).alias("at"))


TAGLIST = "(VALUES (0, '[Laughter]'), (1, 'cười to'), (2, '[học]'), (3, 'ho khan'), (4, 'a deep sigh'), (5, '[sneeze]'), (6, 'thở dài'), (7, 'hoa'))"


def _class_sql() -> str:
    words = " ".join(f"WHEN regexp_matches(s, '(^|[^\\p{{L}}\\p{{N}}_]){k}([^\\p{{L}}\\p{{N}}_]|$)') THEN '{c}'" for c, ks in T.TAG_WORDS.items() for k in ks)
    names = ", ".join(f"'{c}'" for c in T.CLASSES)
    return f"""WITH t AS (SELECT doc_id, lower(trim(trim(tag, '[]'))) AS s, (CAST(('0x' || substr(sha256('7' || chr(0) || CAST(doc_id AS VARCHAR)), 1, 13)) AS BIGINT) + 0.5) / 4503599627370496.0 AS u FROM documents JOIN {TAGLIST} v(n, tag) ON doc_id % 8 = n)
SELECT doc_id, CASE WHEN s IN ({names}) THEN s {words} ELSE [{names}][CAST(floor(u * 6) AS INT) + 1] END AS class FROM t"""


@query(_class_sql())
def match_class(spark, d):
    tags = ["[Laughter]", "cười to", "[học]", "ho khan", "a deep sigh", "[sneeze]", "thở dài", "hoa"]
    tag = F.element_at(F.array(*[F.lit(t) for t in tags]), (F.col("doc_id") % 8).cast("int") + 1)
    return table(spark, d, "documents").select("doc_id", T.match_class(tag, select.uniform(F.lit("7"), F.col("doc_id"))).alias("class"))


@query("""SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'ok' WHEN 1 THEN 'declined' ELSE 'error' END AS status, CASE WHEN doc_id % 5 = 0 THEN 2 END AS slot, CASE WHEN doc_id % 5 = 0 THEN 'cough' END AS tag FROM documents""")
def parse_slot_choice(spark, d):
    replies = ['so ```json\n{"slot": 2, "tag": "[Cough]"}\n```', '{"slot": null}', '{"slot": 4, "tag": "cough"}', "none", '{"slot": 3.0, "tag": "cough"}']
    reply = F.element_at(F.array(*[F.lit(r) for r in replies]), (F.col("doc_id") % 5).cast("int") + 1)
    return table(spark, d, "documents").select("doc_id", T.slot_choice(reply, F.lit(3)).alias("c")).select("doc_id", "c.*")


@query("SELECT doc_id, replace(replace(strip_accents(text), 'đ', 'd'), 'Đ', 'D') AS plain FROM documents")
def deaccent(spark, d):
    return table(spark, d, "documents").select("doc_id", T.deaccent(F.col("text")).alias("plain"))


@query(r"""WITH t AS (SELECT conv_id * 1000 + turn AS id, regexp_extract_all(text, '\S+') AS w FROM conversations),
c AS (SELECT id, list_filter(list_transform(range(1, len(w) + 1), lambda i: struct_pack(p := i, s := lower(regexp_replace(w[i], '[^\p{L}\p{N}'']', '', 'g')))), lambda x: x.s <> '') AS c FROM t)
SELECT id, id % 4 <> 0 AS ok, CASE WHEN id % 4 <> 0 THEN CAST(c[len(c)].p AS INT) END AS last_token FROM c WHERE len(c) > 0""")
def map_words_tokens(spark, d):
    rows = table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.posexplode(T.tokens(F.col("text"))).alias("p", "token"))
    toks = rows.select("id", (F.col("p") + 1).alias("p"), T.aligner_token(F.col("token")).alias("clean"))
    words = toks.where("clean <> ''").withColumnRenamed("p", "w").withColumn("clean", F.when(F.col("id") % 4 == 0, F.concat("clean", F.lit("?"))).otherwise(F.col("clean")))
    out = match.token_map(words, toks, "id")
    return out.select("id", "ok", F.element_at("at", -1).alias("last_token"))


# ---- selection ---------------------------------------------------------------------------------------------------


@query("SELECT p_partkey, p_type, round(CASE WHEN count(*) OVER (PARTITION BY p_type) > 1 THEN (row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice, p_partkey) - 1) / CAST(count(*) OVER (PARTITION BY p_type) - 1 AS DOUBLE) ELSE 0.5 END, 6) AS rank FROM part")
def percentile_ranks(spark, d):
    return series.position_ranks(table(spark, d, "part").select("p_partkey", "p_type", "p_retailprice"), "p_type", "p_retailprice", "p_partkey", "rank").select("p_partkey", "p_type", F.round("rank", 6).alias("rank"))


U = "((CAST(('0x' || substr(sha256({}), 1, 13)) AS BIGINT) + 0.5) / 4503599627370496.0)"
NUL = " || chr(0) || "
CLIPS = """ranked AS (SELECT p_partkey, p_type, p_size, (row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice, p_partkey) - 1) / CAST(greatest(count(*) OVER (PARTITION BY p_type) - 1, 1) AS DOUBLE) AS rank FROM part),
types AS (SELECT p_type, row_number() OVER (ORDER BY p_type) - 1 AS n FROM (SELECT DISTINCT p_type FROM part)),
need AS (SELECT o_orderkey, p_type, least(o_totalprice / 400000, 1) AS target, 1 + o_custkey % 50 AS tempo FROM orders JOIN types ON o_orderkey % 6 = n)"""
COST = "(abs(rank - target) / 0.35 + 1.0 * abs(log2(CAST(p_size AS DOUBLE) / tempo)))"


def clip_rows(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_type", "p_size", "p_retailprice")
    return series.position_ranks(part, "p_type", "p_retailprice", "p_partkey", "rank").drop("p_retailprice")


def need_rows(spark, d):
    w = Window.orderBy("p_type")  # six classes
    types = table(spark, d, "part").select("p_type").distinct().select("p_type", (F.row_number().over(w) - 1).alias("n"))
    o = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 6).alias("n"), F.least(F.col("o_totalprice") / 400000, F.lit(1.0)).alias("target"), (1 + F.col("o_custkey") % 50).alias("tempo"))
    return o.join(types, "n").drop("n")


def clip_cost():
    return F.abs(F.col("rank") - F.col("target")) / select.INTENSITY_TOLERANCE + select.octaves(F.col("p_size").cast("double"), F.col("tempo"))


@query(f"WITH {CLIPS} SELECT o_orderkey, p_partkey, round(exp(-{COST}), 6) AS weight FROM (SELECT need.*, l_partkey AS p_partkey FROM need JOIN lineitem ON l_orderkey = o_orderkey) JOIN (SELECT p_partkey, rank, p_size FROM ranked) USING (p_partkey)")
def clip_weights(spark, d):
    """What each order's own parts would weigh: a row for each line, not for each pair of an order and a clip."""
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"))
    j = need_rows(spark, d).drop("p_type").join(lines, "o_orderkey").join(clip_rows(spark, d), "p_partkey")
    return j.select("o_orderkey", "p_partkey", F.round(F.exp(-clip_cost()), 6).alias("weight"))


def _draw(what: str) -> str:
    return U.format(f"'3'{NUL}CAST(o_orderkey AS VARCHAR){NUL}CAST(a AS VARCHAR){NUL}'{what}'")


PICK = f"""{CLIPS}, dealt AS (SELECT *, CAST(least(greatest(floor(rank * 16), 0), 15) AS INT) AS c0, CAST(least(greatest(floor(log2(CAST(p_size AS DOUBLE)) / 0.5), 0), 11) AS INT) AS c1 FROM ranked),
pos AS (SELECT *, row_number() OVER (PARTITION BY p_type, c0, c1 ORDER BY p_partkey) - 1 AS pos, count(*) OVER (PARTITION BY p_type, c0, c1) AS n FROM dealt),
grid AS (SELECT DISTINCT p_type, c0, c1, n, CASE WHEN c0 > 0 THEN c0 / 16.0 ELSE -1e9 END AS lo0, CASE WHEN c0 < 15 THEN (c0 + 1) / 16.0 ELSE 1e9 END AS hi0,
  CASE WHEN c1 > 0 THEN c1 * 0.5 ELSE -1e9 END AS lo1, CASE WHEN c1 < 11 THEN (c1 + 1) * 0.5 ELSE 1e9 END AS hi1 FROM pos),
w AS (SELECT need.*, c0, c1, n, greatest(lo0 - target, target - hi0, 0) / 0.35 + greatest(lo1 - log2(CAST(tempo AS DOUBLE)), log2(CAST(tempo AS DOUBLE)) - hi1, 0) AS bound FROM need JOIN grid USING (p_type)),
cum AS (SELECT *, sum(n * exp(-bound)) OVER (PARTITION BY o_orderkey ORDER BY c0, c1 ROWS UNBOUNDED PRECEDING) AS hi FROM w),
cells AS (SELECT *, coalesce(lag(hi) OVER (PARTITION BY o_orderkey ORDER BY c0, c1), 0) AS lo, max(hi) OVER (PARTITION BY o_orderkey) AS total FROM cum),
tries AS (SELECT o_orderkey, a, {_draw("cell")} AS u1, {_draw("clip")} AS u2, {_draw("take")} AS u3 FROM need, range(1, 9) t(a)),
drawn AS (SELECT t.a, t.u2, t.u3, c.* FROM tries t JOIN cells c ON c.o_orderkey = t.o_orderkey AND c.lo < t.u1 * c.total AND c.hi >= t.u1 * c.total),
met AS (SELECT d.o_orderkey, d.a, d.u3, d.bound, p.p_partkey, abs(p.rank - d.target) / 0.35 + abs(log2(CAST(p.p_size AS DOUBLE) / d.tempo)) AS cost FROM drawn d JOIN pos p ON p.p_type = d.p_type AND p.c0 = d.c0 AND p.c1 = d.c1 AND p.pos = floor(d.u2 * d.n)),
best AS (SELECT o_orderkey, arg_min(p_partkey, a) AS picked, arg_min(cost, a) AS cost FROM met WHERE u3 < exp(bound - cost) GROUP BY o_orderkey),
race AS (SELECT o_orderkey, p_partkey, {COST} AS cost, ln(-ln({U.format("'3'" + NUL + "CAST(o_orderkey AS VARCHAR)" + NUL + "CAST(p_partkey AS VARCHAR)")})) + {COST} AS k FROM need JOIN ranked USING (p_type) WHERE o_orderkey NOT IN (SELECT o_orderkey FROM best))
"""


@query(f"WITH {PICK} SELECT o_orderkey, picked, round(cost, 6) AS cost FROM best UNION ALL SELECT o_orderkey, arg_min(p_partkey, k), round(arg_min(cost, k), 6) FROM race GROUP BY o_orderkey")
def weighted_pick(spark, d):
    axes = [select.Axis(F.col("rank"), F.col("target"), 1 / select.INTENSITY_TOLERANCE, 0.0, 1 / 16, 16), select.Axis(F.log2(F.col("p_size").cast("double")), F.log2(F.col("tempo").cast("double")), 1.0, 0.0, 0.5, 12)]
    return select.weighted_pick(need_rows(spark, d), clip_rows(spark, d), "p_type", "o_orderkey", "p_partkey", clip_cost(), "3", axes, exact=True).withColumn("cost", F.round("cost", 6))


@query(f"WITH u AS (SELECT p_partkey, p_type, row_number() OVER (PARTITION BY p_type ORDER BY {U.format("'5'" + NUL + "p_type" + NUL + "CAST(p_partkey AS VARCHAR)")}, p_partkey) AS draw FROM part) SELECT p_partkey, p_type, draw FROM u WHERE draw <= 48")
def sample_pool(spark, d):
    return select.sample(table(spark, d, "part").select("p_partkey", "p_type"), "p_type", "p_partkey", 48, "5")


@query(f"SELECT c_custkey, round(least(greatest(0.5 + 0.2 * sqrt(-2 * ln({U.format('CAST(c_custkey AS VARCHAR)' + NUL + "'u'")})) * cos(2 * pi() * {U.format('CAST(c_custkey AS VARCHAR)' + NUL + "'v'")}), 0), 1), 6) AS target FROM customer")
def gauss_target(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.round(select.gaussian(F.lit(0.5), 0.2, F.col("c_custkey")), 6).alias("target"))


# ---- gates -------------------------------------------------------------------------------------------------------


@query("""WITH a AS (SELECT vec_id, label, embedding FROM embeddings), h AS (SELECT label, min(vec_id) AS head FROM embeddings GROUP BY label)
SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS similarity, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) <= 0.1 AS below FROM a JOIN h USING (label) JOIN a b ON b.vec_id = h.head""")
def cosine_similarity(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", "label", "embedding")
    heads = e.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("head"))
    sim = F.round(gates.cosine(F.col("embedding"), F.col("head")), 6)
    return e.join(heads, "label").select("vec_id", sim.alias("similarity"), (sim <= 0.1).alias("below"))


MEASURES = BOUNDARY + """, halves AS (SELECT user_id, avg(CASE WHEN i < n // 2 THEN x END) AS src, avg(CASE WHEN i >= n // 2 THEN x END) AS fin FROM sig GROUP BY user_id),
m AS (SELECT h.user_id, src, fin, before, after FROM halves h JOIN boundary b USING (user_id))"""


def measure_rows(spark, d):
    s = signal(spark, d)
    half = F.floor(F.col("n") / 2)
    h = s.groupBy("user_id").agg(F.avg(F.when(F.col("i") < half, F.col("x"))).alias("src"), F.avg(F.when(F.col("i") >= half, F.col("x"))).alias("fin"))
    return h.join(boundary_rows(spark, d), "user_id")


def rules():
    return {"level": gates.floor_rule(F.col("fin"), 40.0), "level_drop": gates.drop_rule(F.col("src"), F.col("fin"), 5.0), "noise": gates.floor_rule(F.col("fin"), None), "boundary": gates.boundary_rule(F.col("before"), F.col("after"), 1.2)}


_RULES = "list_filter([CASE WHEN fin < 40 THEN 'level' END, CASE WHEN src - fin > 5 THEN 'level_drop' END, CASE WHEN greatest(before, after) > 1.2 THEN 'boundary' END], lambda x: x IS NOT NULL)"


@query(f"WITH {MEASURES} SELECT user_id, array_to_string({_RULES}, ',') AS reasons, len({_RULES}) = 0 AS kept, CASE WHEN before >= after THEN 'before' ELSE 'after' END AS side FROM m")
def gate_reasons(spark, d):
    why = gates.reasons(rules())
    return measure_rows(spark, d).select("user_id", F.array_join(why, ",").alias("reasons"), (F.size(why) == 0).alias("kept"), gates.side(F.col("before"), F.col("after")).alias("side"))


@query(f"WITH {MEASURES}, u AS (SELECT user_id FROM events UNION SELECT c_custkey FROM customer) SELECT u.user_id, round(m.fin, 6) AS fin FROM u LEFT JOIN m USING (user_id) WHERE m.user_id IS NULL OR len({_RULES}) = 0")
def gate_fail_open(spark, d):
    """All customers and users; those without a series have no measures."""
    users = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id")).union(table(spark, d, "events").select("user_id")).distinct()
    rows = users.join(measure_rows(spark, d).withColumn("failed", F.size(gates.reasons(rules())) > 0), "user_id", "left")
    return rows.where("failed IS NULL OR NOT failed").select("user_id", F.round("fin", 6).alias("fin"))


@query(f"""WITH {REGIONS}, g AS (SELECT user_id, lead(lo) OVER (PARTITION BY user_id ORDER BY lo) - hi AS gap FROM regions),
p AS (SELECT user_id, least(greatest(coalesce(quantile_cont(CASE WHEN gap > 0 THEN gap END, 0.5), 60), 60), 86400) / 3600 AS pause FROM g GROUP BY user_id)
SELECT user_id, greatest(0, CAST(trunc(round((pause * 1.0 * 0.6 - 0.05) * 22050, 3)) AS BIGINT)) AS pre, greatest(0, CAST(trunc(round((pause * 1.0 * 1.4 - 0.05) * 22050, 3)) AS BIGINT)) AS post FROM p""")
def gap_budget(spark, d):
    p = series.gap_summary(region_rows(spark, d), "user_id", 60.0, 86400.0).withColumn("pause", F.col("pause") / 3600)
    pre, post = T.GAP_SHAPE["laughter"]
    budget = lambda shape: F.greatest(F.lit(0), F.round((F.col("pause") * shape - 0.05) * 22050, 3).cast("long"))  # noqa: E731  rounded, so that both engines cut alike
    return p.select("user_id", budget(pre).alias("pre"), budget(post).alias("post"))


@query("""WITH e AS (SELECT vec_id, embedding AS a FROM embeddings) SELECT vec_id, CAST(len(a[1:20]) + 3 + len(a[1:8]) + 3 + len(a[21:]) AS INT) AS n, round(list_sum(list_transform(a[1:20] || a[1:8] || a[21:], lambda x: CAST(x AS DOUBLE))), 5) AS total FROM e""")
def splice_concat(spark, d):
    from lacuna.operators.dsp import splice_arrays

    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("a"))
    out = e.select("vec_id", splice_arrays(F.col("a"), F.expr("slice(a, 1, 8)"), F.lit(20), 3).alias("s"))
    return out.select("vec_id", F.size("s").alias("n"), F.round(F.aggregate("s", F.lit(0.0), lambda t, x: t + x.cast("double")), 5).alias("total"))


@query(f"""WITH s AS (SELECT user_id, event_id, ts, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) < 3600000000 THEN 0 ELSE 1 END AS f FROM events),
g AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM s) SELECT user_id, count(*) AS n, epoch_us(min(ts)) AS first_us FROM g GROUP BY user_id, g""")
def session_pauses(spark, d):
    from lacuna.streaming.sessions import sessions

    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return sessions(e, "user_id", "ts", "1 hour").select("user_id", "n", F.unix_micros("first").alias("first_us"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a clip picked by weight, behind the quality gate of their customer's series."""
    picked = weighted_pick(spark, sf_dir)
    gate = gate_reasons(spark, sf_dir).select("user_id", "reasons", "kept")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"))
    return picked.join(orders, "o_orderkey").join(gate, "user_id", "left").where("kept IS NULL OR kept")


def queries() -> dict:
    from lacuna.plans import stage_queries  # noqa: F401  registers its own

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(SQL)
