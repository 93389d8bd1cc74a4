"""Registered queries of what the stages are made of: files and formats, projections and gates, lookups, measures and array signals.

The proxies are those of queries; documents also stand for recordings (a path is made from each), embeddings for short signals."""

from __future__ import annotations

from pyspark.sql import functions as F

from lacuna.functions import text as T
from lacuna.operators import arrays, gates, keyed, match, select, series
from lacuna.plans import queries as Q
from lacuna.plans import stages
from lacuna.plans.queries import ISLANDS, NUL, PAUSES, POINTS, SIG, SQL, U, pause_rows, point_rows, query, seconds, table
from lacuna.schemas import Settings
from lacuna.sources import manifest

# ---- files and formats ---------------------------------------------------------------------------------------------

FORMATS = ("wav", "FLAC", "mp3", "Ogg", "txt", "json")
FILES = "files AS (SELECT doc_id, '/raw/' || source || '/take.' || CAST(doc_id AS VARCHAR) || '.' || (['wav', 'FLAC', 'mp3', 'Ogg', 'txt', 'json'])[CAST(doc_id % 6 AS INT) + 1] AS path FROM documents)"


def file_rows(spark, d):
    form = F.element_at(F.array(*[F.lit(x) for x in FORMATS]), (F.col("doc_id") % 6).cast("int") + 1)
    return table(spark, d, "documents").select("doc_id", F.concat(F.lit("/raw/"), "source", F.lit("/take."), F.col("doc_id").cast("string"), F.lit("."), form).alias("path"))


@query(f"WITH {FILES} SELECT doc_id, regexp_extract(path, '([^/]+)[.][^.]*$', 1) AS id FROM files WHERE lower(regexp_extract(path, '[.]([^.]*)$', 1)) IN ('wav', 'flac', 'mp3', 'ogg')")
def audio_paths(spark, d):
    """Recordings by extension, without case, and their ids."""
    return file_rows(spark, d).where(manifest.is_audio(F.col("path"))).select("doc_id", manifest.stem(F.col("path")).alias("id"))


@query("SELECT CAST(doc_id AS VARCHAR) AS id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def unpaired_audio(spark, d):
    """Recordings without a transcript."""
    audio = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("source").alias("path"))
    return manifest.paired(audio, table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("id"), F.lit("").alias("text")))[1].select("id")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'f' ELSE 'm' END AS gender, CAST(p_partkey AS VARCHAR) AS speaker, CAST(p_size AS VARCHAR) AS take, CASE WHEN p_size % 3 = 0 THEN 'sigh' ELSE 'cough' END AS kind
FROM part WHERE p_size % 5 <> 0""")
def clip_listing(spark, d):
    """Clips by the parts of their file names; other files are left out."""
    name = F.format_string("%s%d_%d_%s.%s", F.when(F.col("p_partkey") % 2 == 0, "f").otherwise("m"), "p_partkey", "p_size", F.when(F.col("p_size") % 3 == 0, "sigh").otherwise("cough"), F.when(F.col("p_size") % 5 == 0, "mp3").otherwise("wav"))
    rows = table(spark, d, "part").select("p_partkey", manifest.clip_name(name).alias("c"))
    return rows.select("p_partkey", "c.*").where("kind <> ''")


@query("SELECT d.doc_id, d.lang, CASE WHEN l.doc_id IS NOT NULL THEN l.quality END AS quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def stage_round_trip(spark, d):
    """Rows with nulls and characters beyond ASCII through a stage table, written twice and read back."""
    rows = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels").select("doc_id", "quality", "toxic"), "doc_id", "left")
    rows = rows.select("doc_id", F.struct("lang", "quality", "toxic").alias("values"))
    path = manifest.scratch(spark, "round-trip")
    manifest.write_stage(rows.limit(0), path)
    manifest.write_stage(rows, path)
    return manifest.read_stage(spark, path, "doc_id long, values struct<lang:string,quality:int,toxic:int>").select("doc_id", "values.*")


@query("""SELECT CAST(d.doc_id AS VARCHAR) AS id, CASE WHEN source < 'm' THEN source || '/a.wav' ELSE '/else/a.wav' END AS audio_filepath, round_even(n_chars / 17.0, 4) AS duration, '{"lang": "' || d.lang || '"}' AS extra
FROM labels l JOIN documents d USING (doc_id)""")
def export_rows(spark, d):
    """Paths below the manifest's folder as relative ones, four digits, and the source's other keys."""
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), "source", "lang", "n_chars")
    path = F.when(F.col("source") < "m", F.concat(F.lit("/data/"), "source", F.lit("/a.wav"))).otherwise("/else/a.wav")
    rows = table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("id")).join(docs, "id").select("id", path.alias("audio_filepath"), F.lit("").alias("text"), (F.col("n_chars") / 17.0).alias("duration"))
    source = docs.select("id", F.concat(F.lit('{"lang": "'), "lang", F.lit('"}')).alias("extra"))
    return manifest.exported(rows, source, "/data").select("id", "audio_filepath", "duration", "extra")


@query("""SELECT event_id, '{"k":"' || (props ->> 'k') || '"}' AS extra FROM events""")
def extra_keys(spark, d):
    """All keys of a row but those that have columns of their own."""
    whole = F.map_concat(F.from_json("props", "map<string,string>"), F.create_map(F.lit("text"), F.lit("a"), F.lit("audio_filepath"), F.lit("b")))
    return table(spark, d, "events").select("event_id", F.to_json(keyed.others(whole, "audio_filepath", "text")).alias("extra"))


@query("SELECT source, CAST(sum(strlen(text)) AS BIGINT) AS bytes, count(*) AS n, count(*) FILTER (strlen(text) > 2000) AS large FROM documents GROUP BY source")
def byte_sums(spark, d):
    size = F.octet_length("text")
    return table(spark, d, "documents").groupBy("source").agg(F.sum(size).alias("bytes"), F.count("*").alias("n"), F.count(F.when(size > 2000, 1)).alias("large"))


@query("SELECT doc_id, base64(encode(text)) AS body, right(text, 40) AS tail FROM documents")
def encoded_bodies(spark, d):
    return table(spark, d, "documents").select("doc_id", T.base64_body(F.col("text").cast("binary")).alias("body"), T.tail(F.col("text"), 40).alias("tail"))


@query("SELECT count(*) >= 100 AS whole, count(*) AS n FROM part")
def expected_count(spark, d):
    """Whether a corpus has as many files as it should."""
    return table(spark, d, "part").agg((F.count("*") >= 100).alias("whole"), F.count("*").alias("n"))


@query("SELECT user_id, arg_max(event_id, CAST(epoch_us(ts) AS HUGEINT) * 1000000 + event_id) AS event_id FROM events WHERE epoch_us(ts) >= (SELECT min(epoch_us(ts)) FROM events) + 86400000000 - 1000000 GROUP BY user_id")
def latest_file(spark, d):
    """Of each maker the last file written since a start, a second of slack allowed."""
    e = table(spark, d, "events").select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    start = e.agg(F.min("us").alias("start"))
    return keyed.latest_since(e.join(F.broadcast(start)), "user_id", "event_id", F.col("us"), F.col("start") + 86_400_000_000, 1_000_000)  # one row is broadcast


# ---- projections and gates -------------------------------------------------------------------------------------------


@query("SELECT conv_id, turn FROM conversations WHERE turn % 3 = 1")
def tagged_only(spark, d):
    text = F.when(F.col("turn") % 3 == 1, F.concat("text", F.lit(" [sigh]"))).otherwise(F.translate("text", "[]", ""))
    return table(spark, d, "conversations").where(T.extract_tag(text).isNotNull()).select("conv_id", "turn")


LEVELS = f"WITH {SIG}, lv AS (SELECT user_id, max(abs(x)) AS peak, sqrt(avg(x * x)) / (max(abs(x)) + 1e-9) AS level, count(*) / 4.0 AS duration, avg(CASE WHEN abs(x) >= 0.999 THEN 1.0 ELSE 0.0 END) AS clipping FROM sig GROUP BY user_id)"


@query(f"{LEVELS} SELECT user_id FROM lv WHERE level / 6 > 0.05 AND duration / 47 > 0.35")
def usable_clips(spark, d):
    rows = series.level_features(Q.signal(spark, d), "user_id", 4.0)
    return rows.where(gates.usable(F.col("level") / 6, F.col("duration") / 47)).select("user_id")


@query("""WITH p AS (SELECT p_partkey, p_type, CASE WHEN p_size > 45 THEN NULL ELSE p_size / 50.0 + CASE WHEN p_type LIKE '%E%' THEN 1 ELSE 0 END END AS clipping FROM part),
a AS (SELECT *, max(coalesce(clipping, 0) <= 0.3) OVER (PARTITION BY p_type) AS any_clean FROM p) SELECT p_partkey, p_type FROM a WHERE coalesce(clipping, 0) <= 0.3 OR NOT any_clean""")
def clean_pool(spark, d):
    clipping = F.when(F.col("p_size") <= 45, F.col("p_size") / 50.0 + F.col("p_type").contains("E").cast("int"))
    return select.clean_pool(table(spark, d, "part").select("p_partkey", "p_type", clipping.alias("clipping")), "p_type", F.col("clipping"), 0.3).select("p_partkey", "p_type")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0.05 THEN printf('noise_drop %.2f > 0.05', l_discount) ELSE printf('level %.2f < 25', l_quantity) END AS why FROM lineitem WHERE l_discount > 0.05 OR l_quantity < 25")
def reason_texts(spark, d):
    why = F.when(F.col("l_discount") > 0.05, F.format_string("noise_drop %.2f > 0.05", "l_discount")).when(F.col("l_quantity") < 25, F.format_string("level %.2f < 25", "l_quantity"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", why.alias("why")).where("why IS NOT NULL")


@query("""WITH h AS (SELECT label, min(vec_id) AS head, max(vec_id) AS other FROM embeddings GROUP BY label), v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
SELECT v.vec_id, round(list_cosine_similarity(v.e, a.e), 6) <= round(list_cosine_similarity(v.e, b.e), 6) AS warned FROM v JOIN h USING (label) JOIN v a ON a.vec_id = h.head JOIN v b ON b.vec_id = h.other""")
def similarity_warning(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", "label", "embedding")
    ends = e.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("a"), F.max_by("embedding", "vec_id").alias("b"))
    like = lambda c: F.round(gates.cosine(F.col("embedding"), F.col(c)), 6)
    return e.join(ends, "label").select("vec_id", gates.not_better(like("a"), like("b")).alias("warned"))


@query("SELECT event_id, value, CASE WHEN value * 3 > 150 THEN 'too_long' ELSE 'ok' END AS status FROM events")
def audio_cap(spark, d):
    """Recordings longer than the tagger takes aren't sent to it."""
    return table(spark, d, "events").select("event_id", "value", F.when(gates.over_cap(F.col("value") * 3), "too_long").otherwise("ok").alias("status"))


@query("SELECT doc_id, TRY_CAST(split_part(source, '_', 2) AS INT) AS n, CASE WHEN TRY_CAST(split_part(source, '_', 2) AS INT) IS NULL THEN 'not a number: ' || source END AS error FROM documents")
def quarantine(spark, d):
    """A row that can't be worked on has its error and no value; the rest go on."""
    part = F.get(F.split("source", "_"), F.lit(1))
    n = F.coalesce(part, F.lit("")).try_cast("int")
    return table(spark, d, "documents").select("doc_id", n.alias("n"), F.when(n.isNull(), F.concat(F.lit("not a number: "), "source")).alias("error"))


# ---- lookups and joins -----------------------------------------------------------------------------------------------


@query("""WITH c AS (SELECT user_id, CAST(count(*) AS INT) AS n FROM events WHERE value > 90 GROUP BY user_id) SELECT u.c_custkey AS user_id, coalesce(c.n, 0) AS n FROM customer u LEFT JOIN c ON c.user_id = u.c_custkey""")
def candidates_or_none(spark, d):
    """The candidates of each row by id, none where the table has no entry."""
    found = table(spark, d, "events").where("value > 90").groupBy("user_id").agg(F.collect_list("event_id").alias("candidates"))
    users = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    return keyed.array_or_empty(users, found, "user_id", "candidates").select("user_id", F.size("candidates").alias("n"))


@query("SELECT count(DISTINCT user_id) AS row_count, count(*) AS candidate_count FROM events WHERE value > 90")
def total_candidates(spark, d):
    found = table(spark, d, "events").where("value > 90").groupBy("user_id").agg(F.collect_list("event_id").alias("candidates"))
    return found.agg(F.count("*").alias("row_count"), F.sum(F.size("candidates")).alias("candidate_count"))


@query("SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'not aligned' ELSE 'aligned' END AS state FROM documents d LEFT JOIN labels l USING (doc_id)")
def aligned_or_missing(spark, d):
    """Rows that have an alignment, and those reported for having none."""
    docs, labels = table(spark, d, "documents").select("doc_id"), table(spark, d, "labels")
    return keyed.todo(docs, keyed.todo(docs, labels, "doc_id"), "doc_id").withColumn("state", F.lit("aligned")).union(keyed.todo(docs, labels, "doc_id").withColumn("state", F.lit("not aligned")))


def _shape_sql(k: int) -> str:
    return "CASE kind " + " ".join(f"WHEN '{c}' THEN {0.9 if c == 'cough' else v[k]}" for c, v in T.GAP_SHAPE.items()) + " ELSE 1.0 END"


@query(f"""WITH k AS (SELECT p_partkey, (['laughter', 'sigh', 'cough', 'throatclearing', 'sneeze', 'sniff', 'yawn'])[CAST(p_partkey % 7 AS INT) + 1] AS kind FROM part)
SELECT p_partkey, kind, CAST({_shape_sql(0)} AS DOUBLE) AS before, CAST({_shape_sql(1)} AS DOUBLE) AS after, CAST(CASE kind {" ".join(f"WHEN '{c}' THEN {v}" for c, v in T.LEVEL_OFFSET_DB.items())} ELSE 0 END AS DOUBLE) AS level FROM k""")
def class_lookups(spark, d):
    """Shapes of gaps and levels by class: what the settings name, else the table, else a neutral value."""
    kind = F.element_at(F.array(*[F.lit(c) for c in (*T.CLASSES, "yawn")]), (F.col("p_partkey") % 7).cast("int") + 1)
    rows = table(spark, d, "part").select("p_partkey", kind.alias("kind"))
    before, after = (T.by_class(F.col("kind"), {c: v[k] for c, v in T.GAP_SHAPE.items()}, {"cough": 0.9}, 1.0) for k in (0, 1))
    return rows.select("p_partkey", "kind", before.alias("before"), after.alias("after"), T.by_class(F.col("kind"), T.LEVEL_OFFSET_DB, {}, 0.0).alias("level"))


@query(f"""WITH {PAUSES}, {POINTS}, j AS (SELECT p.user_id, event_id, t, (lo + hi) / 2 AS mid, row_number() OVER (PARTITION BY p.user_id, event_id ORDER BY abs((lo + hi) / 2 - t), lo) AS r FROM points p LEFT JOIN pauses q ON q.user_id = p.user_id)
SELECT user_id, event_id, round(CASE WHEN abs(mid - t) <= 3600 THEN mid ELSE t END, 3) AS at FROM j WHERE r = 1""")
def local_gap(spark, d):
    return match.local_gap(point_rows(spark, d), pause_rows(spark, d), "user_id", 3600.0).select("user_id", "event_id", F.round("at", 3).alias("at"))


@query(f"WITH {POINTS} SELECT user_id, event_id, round(t, 3) AS at, 'disabled' AS status FROM points")
def snap_disabled(spark, d):
    out = match.snap(point_rows(spark, d), pause_rows(spark, d), "user_id", "event_id", 7200.0, enabled=False)
    return out.select("user_id", "event_id", F.round("at", 3).alias("at"), "status")


@query(f"""WITH {PAUSES}, b AS (SELECT user_id, min(epoch_us(ts)) / 1e6 AS t0, count(*) AS n FROM events GROUP BY user_id),
e AS (SELECT CAST(user_id AS VARCHAR) AS id, user_id, CASE WHEN user_id % 4 = 0 THEN t0 + 100 END AS slot, CASE WHEN user_id % 3 = 0 THEN NULL ELSE t0 + 40000 END AS qwen3, CASE WHEN user_id % 5 = 0 THEN NULL ELSE t0 + 90000 END AS mms FROM b),
r AS (SELECT *, coalesce(qwen3, mms) AS t, CASE WHEN qwen3 IS NOT NULL THEN 'qwen3' ELSE 'mms' END AS stage FROM e WHERE slot IS NULL AND coalesce(qwen3, mms) IS NOT NULL),
j AS (SELECT r.*, lo, hi, coalesce(t BETWEEN lo AND hi, false) AS ins, abs((lo + hi) / 2 - t) AS away FROM r LEFT JOIN pauses p ON p.user_id = r.user_id),
s AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ins DESC, CASE WHEN ins THEN lo ELSE away END, lo) AS k FROM j)
SELECT id, round(slot, 3) AS insert_at_s, 'vad_slot' AS insert_stage, 'slot' AS vad_status, 0.0 AS vad_shift_s FROM e WHERE slot IS NOT NULL
UNION ALL SELECT id, round((lo + hi) / 2, 3), stage, CASE WHEN ins THEN 'in_pause' ELSE 'snapped' END, round(away, 3) FROM s WHERE k = 1 AND (ins OR away <= 7200)""")
def align_stages(spark, d):
    """Chosen slots stay; other rows go from the first aligner that has a time to a pause, or out where none is near."""
    b = table(spark, d, "events").groupBy("user_id").agg(F.min(seconds()).alias("t0"))
    u = F.col("user_id")
    rows = b.select(u.cast("string").alias("id"), F.when(u % 4 == 0, F.col("t0") + 100).alias("insert_at_s"), F.lit(None).cast("double").alias("pause_s"))
    estimates = b.select(u.cast("string").alias("id"), F.when(u % 3 != 0, F.col("t0") + 40000).alias("qwen3"), F.when(u % 5 != 0, F.col("t0") + 90000).alias("mms"))
    pauses = pause_rows(spark, d).select(u.cast("string").alias("id"), "lo", "hi")
    out = stages.align(rows, estimates, pauses, Settings(max_shift_s=7200.0, on_no_pause="skip"))
    return out.select("id", F.round("insert_at_s", 3).alias("insert_at_s"), "insert_stage", "vad_status", F.round("vad_shift_s", 3).alias("vad_shift_s"))


@query("SELECT doc_id, source FROM documents")
def transcribe_again(spark, d):
    """All rows where what is there is to be overwritten."""
    return keyed.todo(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"), "doc_id", force=True)


# ---- series and measures ---------------------------------------------------------------------------------------------


@query(f"WITH {PAUSES} SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY lo) AS INT) AS i, round((lo + hi) / 2, 3) AS time, round(hi - lo, 3) AS pause FROM pauses")
def numbered_pauses(spark, d):
    one = F.struct("lo", "hi")
    found = pause_rows(spark, d).groupBy("user_id").agg(F.sort_array(F.collect_list(one)).alias("l"))
    rows = found.select("user_id", F.posexplode("l").alias("i", "p"))
    return rows.select("user_id", (F.col("i") + 1).alias("i"), F.round((F.col("p.lo") + F.col("p.hi")) / 2, 3).alias("time"), F.round(F.col("p.hi") - F.col("p.lo"), 3).alias("pause"))


@query(f"""WITH {ISLANDS}, iv AS (SELECT user_id, first * 4.0 AS lo, last * 4.0 + 8 AS hi FROM islands),
mk AS (SELECT *, CASE WHEN lo - max(hi) OVER (PARTITION BY user_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) < 5 THEN 0 ELSE 1 END AS f FROM iv),
nm AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS g FROM mk),
m AS (SELECT user_id, min(lo) AS lo, max(hi) AS hi FROM nm GROUP BY user_id, g) SELECT user_id, lo, hi FROM m WHERE hi - lo >= 12""")
def energy_regions(spark, d):
    """Speech by its level: loud runs, joined where little lies between, without the short ones."""
    return series.energy_regions(Q.frame_rows(spark, d), "user_id", 3.0, 8, 4, 5.0, 12.0)


@query("SELECT event_type, round(quantile_cont(abs(value - 50), 0.999), 6) AS loud FROM events GROUP BY event_type")
def loud_peak(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.round(F.percentile(F.abs(F.col("value") - 50), F.lit(0.999)), 6).alias("loud"))


@query(f"""WITH m AS (SELECT covar_pop(l_quantity, l_extendedprice) AS qy, covar_pop(l_discount, l_extendedprice) AS dy, covar_pop(l_quantity, l_discount) AS qd, var_pop(l_quantity) AS qq, var_pop(l_discount) AS dd, avg(l_extendedprice) AS y, avg(l_quantity) AS q, avg(l_discount) AS d FROM lineitem),
s AS (SELECT *, (qy * dd - dy * qd) / (qq * dd - qd * qd) AS b1, (dy * qq - qy * qd) / (qq * dd - qd * qd) AS b2 FROM m)
SELECT round(stddev_pop(l_extendedprice - (s.y - b1 * s.q - b2 * s.d) - b1 * l_quantity - b2 * l_discount), 2) AS residual FROM lineitem, s""")
def ols_residual(spark, d):
    """What a regression on two axes leaves, from one pass of moments."""
    fit = series.least_squares(table(spark, d, "lineitem"), F.col("l_extendedprice"), F.col("l_quantity"), F.col("l_discount"))
    return fit.select(F.round("residual", 2).alias("residual"))


@query("""WITH h AS (SELECT label, min(vec_id) AS head FROM embeddings GROUP BY label), v AS (SELECT vec_id, label, list_transform(range(0, 48), lambda i: CAST(embedding[CAST(floor(i * 64 / 48.0) AS INT) + 1] AS DOUBLE) + (i * 64 / 48.0 - floor(i * 64 / 48.0)) * (CAST(embedding[least(CAST(floor(i * 64 / 48.0) AS INT) + 2, 64)] AS DOUBLE) - CAST(embedding[CAST(floor(i * 64 / 48.0) AS INT) + 1] AS DOUBLE))) AS e FROM embeddings),
p AS (SELECT v.vec_id, unnest(v.e) AS x, unnest(a.e) AS y FROM v JOIN h USING (label) JOIN v a ON a.vec_id = h.head) SELECT vec_id, round(corr(x, y), 5) AS r FROM p GROUP BY vec_id""")
def contour_correlation(spark, d):
    """Contours brought to one length, and how they correlate with that of their group's first."""
    e = table(spark, d, "embeddings").select("vec_id", "label", arrays.resampled(arrays.doubles(F.col("embedding")), 64, 48).alias("e"))
    heads = e.groupBy("label").agg(F.min_by("e", "vec_id").alias("h"))
    pairs = e.join(heads, "label").select("vec_id", F.explode(F.arrays_zip("e", "h")).alias("p"))
    return pairs.groupBy("vec_id").agg(F.round(F.corr("p.e", "p.h"), 5).alias("r"))


@query(f"SELECT a.user_id, a.energy_rank, b.rate, c.tilt, s.snr FROM ({SQL['energy_rank']}) a JOIN ({SQL['envelope_rate']}) b USING (user_id) JOIN ({SQL['envelope_tilt']}) c USING (user_id) JOIN ({SQL['snr_db']}) s USING (user_id)")
def speaker_profile(spark, d):
    parts = (Q.energy_rank, lambda s, p: Q.envelope_rate(s, p).drop("peaks"), Q.envelope_tilt, Q.snr_db)
    first, *rest = (f(spark, d) for f in parts)
    for other in rest:
        first = first.join(other, "user_id")
    return first


@query(f"SELECT a.user_id, a.level, a.duration, b.rate, c.tilt, s.snr, a.clipping FROM ({SQL['level_features']}) a JOIN ({SQL['envelope_rate']}) b USING (user_id) JOIN ({SQL['envelope_tilt']}) c USING (user_id) JOIN ({SQL['snr_db']}) s USING (user_id) WHERE a.peak > 0.05 AND a.duration > 0.35")
def clip_bundle(spark, d):
    rows = Q.level_features(spark, d).where(gates.usable(F.col("peak"), F.col("duration"))).drop("peak")
    return rows.join(Q.envelope_rate(spark, d).drop("peaks"), "user_id").join(Q.envelope_tilt(spark, d), "user_id").join(Q.snr_db(spark, d), "user_id")


@query("SELECT event_type, round((quantile_cont(value, 0.9) - quantile_cont(value, 0.1)) / 35 * 1.5, 6) AS spread FROM events GROUP BY event_type")
def axis_spread(spark, d):
    """How far an axis reaches, in what it weighs."""
    return table(spark, d, "events").groupBy("event_type").agg(F.round(series.spread("value", 35.0) * 1.5, 6).alias("spread"))


@query("""SELECT user_id, epoch_us(ws) AS start_us, count(*) AS n, round(sqrt(avg(value * value)), 6) AS rms
FROM (SELECT user_id, value, unnest([time_bucket(INTERVAL '6 hours', ts), time_bucket(INTERVAL '6 hours', ts) - INTERVAL '6 hours']) AS ws FROM events) GROUP BY user_id, ws""")
def sliding_levels(spark, d):
    from lacuna.streaming.sessions import sliding_levels as levels

    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    out = levels(e, "user_id", "ts", "value", "12 hours", "6 hours")
    return out.select("user_id", F.unix_micros("start").alias("start_us"), "n", F.round("rms", 6).alias("rms"))


# ---- selection -------------------------------------------------------------------------------------------------------

_PICK = U.format("'9'" + NUL + "p_type" + NUL + "CAST(p_partkey AS VARCHAR)")


@query(f"""WITH u AS (SELECT p_partkey, p_type, p_size, CAST(row_number() OVER (PARTITION BY p_type ORDER BY {_PICK}, p_partkey) AS INT) AS draw FROM part),
f AS (SELECT p_type, arg_min(p_partkey, draw) AS p_partkey, min(draw) AS draw FROM u WHERE draw <= 12 AND p_size > 40 GROUP BY p_type) SELECT * FROM f""")
def first_usable(spark, d):
    rows = table(spark, d, "part").select("p_partkey", "p_type", "p_size")
    return select.first_usable(rows, "p_type", "p_partkey", F.col("p_size") > 40, 12, "9").select("p_type", "p_partkey", "draw")


@query("""SELECT l_orderkey, l_linenumber, round(abs(l_discount * 10 - l_tax * 10) / 0.35, 6) AS intensity, round(abs(l_quantity - p_size) / 12, 6) AS clarity, round(abs(l_tax * 100 - p_size) / 12, 6) AS tilt,
CASE WHEN p_partkey % 3 = 0 THEN round(abs(log2(l_quantity / p_size)), 6) END AS tempo FROM lineitem JOIN part ON p_partkey = l_partkey""")
def axis_distances(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").cast("double").alias("p_size")), "l_partkey")
    c = F.col
    away = select.distances((c("l_discount") * 10, c("l_tax") * 10), (c("l_quantity"), c("p_size")), (c("l_tax") * 100, c("p_size")), (c("l_quantity"), c("p_size")), c("l_partkey") % 3 == 0)
    return rows.select("l_orderkey", "l_linenumber", away.alias("a")).select("l_orderkey", "l_linenumber", *[F.round(f"a.{x}", 6).alias(x) for x in ("intensity", "clarity", "tilt", "tempo")])


@query("""WITH n AS (SELECT p_partkey, count(*) OVER w AS n, row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice, p_partkey) - 1 AS a, row_number() OVER (PARTITION BY p_type ORDER BY p_size, p_partkey) - 1 AS b FROM part WINDOW w AS (PARTITION BY p_type))
SELECT p_partkey, round(CASE WHEN n > 1 THEN (a / CAST(n - 1 AS DOUBLE) + b / CAST(n - 1 AS DOUBLE)) / 2 ELSE 0.5 END, 6) AS intensity FROM n""")
def candidate_intensity(spark, d):
    rows = table(spark, d, "part").select("p_partkey", "p_type", "p_retailprice", "p_size")
    rows = series.position_ranks(series.position_ranks(rows, "p_type", "p_retailprice", "p_partkey", "r1"), "p_type", "p_size", "p_partkey", "r2")
    return rows.select("p_partkey", F.round((F.col("r1") + F.col("r2")) / 2, 6).alias("intensity"))


@query("SELECT event_id, least(greatest(CAST(trunc((value - 20) * 22050 / 7) AS BIGINT), 0), 200000) AS sample FROM events")
def sample_index(spark, d):
    return table(spark, d, "events").select("event_id", series.sample_index((F.col("value") - 20) * 22050 / 7, 1, F.lit(200000)).alias("sample"))


# ---- array signals ---------------------------------------------------------------------------------------------------

VEC = "v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS a FROM embeddings)"
_DIGEST = "CAST(len(s) AS INT) AS n, round(list_sum(s), 5) AS total, round(list_sum(list_transform(s, lambda x, i: x * i)), 4) AS moment"


def vectors(spark, d):
    return table(spark, d, "embeddings").select("vec_id", arrays.doubles(F.col("embedding")).alias("a"))


def digested(rows, s):
    """An array by its length, sum and first moment, as arrays of two engines are compared."""
    total = lambda f: F.aggregate(F.transform("s", f), F.lit(0.0), lambda t, x: t + x)
    return rows.select("vec_id", s.alias("s")).select("vec_id", F.size("s").alias("n"), F.round(total(lambda x: x), 5).alias("total"), F.round(total(lambda x, i: x * (i + 1)), 4).alias("moment"))


@query(f"WITH {VEC}, r AS (SELECT vec_id, list_transform(range(0, 48), lambda i: a[CAST(floor(i * 64 / 48.0) AS INT) + 1] + (i * 64 / 48.0 - floor(i * 64 / 48.0)) * (a[least(CAST(floor(i * 64 / 48.0) AS INT) + 2, 64)] - a[CAST(floor(i * 64 / 48.0) AS INT) + 1])) AS s FROM v) SELECT vec_id, {_DIGEST} FROM r")
def resampled(spark, d):
    return digested(vectors(spark, d), arrays.resampled(F.col("a"), 64, 48))


def _fade_sql(rise: str) -> str:
    """Both ends of 64 values under a curve of 10: rise is that of k, counted from 0."""
    at = lambda k: "CASE WHEN {k} < 10 THEN {r} ELSE 1.0 END".format(k=k, r=rise.format(k=k))
    return f"WITH {VEC}, r AS (SELECT vec_id, list_transform(a, lambda x, i: x * ({at('(i - 1)')}) * ({at('(64 - i)')})) AS s FROM v) SELECT vec_id, {_DIGEST} FROM r"


@query(_fade_sql("{k} / 9.0"))
def linear_fade(spark, d):
    return digested(vectors(spark, d), arrays.faded(F.col("a"), F.lit(10), "linear"))


@query(_fade_sql("0.5 * (1 - cos(pi() * {k} / 9.0))"))
def cosine_fade(spark, d):
    return digested(vectors(spark, d), arrays.faded(F.col("a"), F.lit(10), "cosine"))


@query(_fade_sql("(exp(-5.0 * (9 - {k}) / 9.0) - exp(-5.0)) / (1 - exp(-5.0))"))
def exponential_fade(spark, d):
    return digested(vectors(spark, d), arrays.faded(F.col("a"), F.lit(10), "exponential"))


@query(f"""WITH {VEC}, q AS (SELECT vec_id, a, unnest(range(0, 49, 8)) AS st FROM v),
m AS (SELECT vec_id, a, st, list_sum(list_transform(a[st + 1 : st + 16], lambda x: x * x)) AS e FROM q),
t AS (SELECT vec_id, arg_min(a[st + 1 : st + 16], struct_pack(e := e, st := st)) AS w FROM m GROUP BY vec_id),
u AS (SELECT vec_id, list_transform(range(0, 14), lambda i: CASE WHEN i = 0 THEN w[15] WHEN i = 1 THEN w[2] ELSE w[i + 1] END) AS u FROM t),
r AS (SELECT vec_id, list_transform(range(0, 100), lambda i: u[CAST((i + 3 + vec_id * 0) % 14 AS INT) + 1]) AS s FROM u) SELECT vec_id, {_DIGEST} FROM r""")
def room_tone(spark, d):
    """The quietest sixteen values, looped over a blended seam of two from a quarter of the way."""
    return digested(vectors(spark, d), arrays.looped(arrays.quietest(F.col("a"), 16), F.lit(100), F.lit(0.25)))


@query(f"WITH {VEC}, r AS (SELECT vec_id, list_transform(a, lambda x: x / (list_max(list_transform(a, lambda y: abs(y))) + 1e-9) * 0.95) AS s FROM v) SELECT vec_id, {_DIGEST} FROM r")
def peak_normalised(spark, d):
    return digested(vectors(spark, d), arrays.normalised(F.col("a")))


@query(f"WITH {VEC}, r AS (SELECT vec_id, list_concat(list_concat(list_transform(range(0, 18), lambda i: 0.0), a), list_transform(range(0, 18), lambda i: 0.0)) AS s FROM v) SELECT vec_id, {_DIGEST} FROM r")
def padded_clip(spark, d):
    return digested(vectors(spark, d), arrays.padded(F.col("a"), 101))


@query(f"""WITH {VEC}, p AS (SELECT vec_id, a, a[1:8] AS ins, sqrt(list_sum(list_transform(a[21:40], lambda x: x * x)) / 20) AS ctx, sqrt(list_sum(list_transform(a[1:8], lambda x: x * x)) / 8) AS now,
  list_max(list_transform(a[1:8], lambda x: abs(x))) AS top, list_aggregate(list_transform(a, lambda x: abs(x)), 'quantile_cont', 0.999) AS cap FROM v)
SELECT vec_id, round(least(ctx / now * pow(10, 3.0 / 20), cap * 1.5 / top), 6) AS gain FROM p""")
def level_gain(spark, d):
    return vectors(spark, d).select("vec_id", F.round(arrays.gain(F.slice("a", 1, 8), F.col("a"), F.lit(40), 20, 3.0), 6).alias("gain"))


_TONE = """q AS (SELECT vec_id, a, unnest(range(0, 49, 8)) AS st FROM v),
m AS (SELECT vec_id, st, a, list_sum(list_transform(a[st + 1 : st + 16], lambda x: x * x)) AS e FROM q),
t AS (SELECT vec_id, any_value(a) AS a, arg_min(a[st + 1 : st + 16], struct_pack(e := e, st := st)) AS w FROM m GROUP BY vec_id),
u AS (SELECT vec_id, a, list_transform(range(0, 14), lambda i: CASE WHEN i = 0 THEN w[15] WHEN i = 1 THEN w[2] ELSE w[i + 1] END) AS u FROM t)"""


def _edges(x: str, n: str, rise: str, head: bool, tail: bool) -> str:
    """The list x of n values, its first or last six under a curve: rise is that of k, counted from 0."""
    at = lambda k: f"CASE WHEN {k} < 6 THEN {rise.format(k=k)} ELSE 1.0 END"
    parts = [at("(i - 1)")] * head + [at(f"({n} - i)")] * tail
    return f"list_transform({x}, lambda x, i: x * {' * '.join(f'({p})' for p in parts)})"


def _gap(n: str) -> str:
    return f"list_transform(range(0, {n}), lambda i: u[CAST((i + 3) % 14 AS INT) + 1])"


_DECAY, _COSINE = "((exp(-5.0 * (5 - {k}) / 5.0) - exp(-5.0)) / (1 - exp(-5.0)))", "(0.5 * (1 - cos(pi() * {k} / 5.0)))"
_RMS = lambda x: f"sqrt(list_sum(list_transform({x}, lambda x: x * x)) / len({x}))"


@query(f"""WITH {VEC}, {_TONE}, g AS (SELECT *, least({_RMS("a[5:24]")} / {_RMS("a[1:8]")} * pow(10, 3.0 / 20), list_aggregate(list_transform(a, lambda x: abs(x)), 'quantile_cont', 0.999) * 1.5 / list_max(list_transform(a[1:8], lambda x: abs(x)))) AS gain FROM u),
p AS (SELECT *, list_transform(a[1:8], lambda x: x * gain) AS ins FROM g),
r AS (SELECT vec_id, {_edges("a[1:24]", "24", _DECAY, False, True)} || {_gap("3")} || {_edges("ins", "8", _DECAY, True, True)} || {_gap("5")} || {_edges("a[25:64]", "40", _DECAY, True, False)} AS s FROM p) SELECT vec_id, {_DIGEST} FROM r""")
def splice_tempo(spark, d):
    """An insert at the level of what is before it, between gaps of the recording's own background."""
    insert = F.slice("a", 1, 8)
    gain = arrays.gain(insert, F.col("a"), F.lit(24), 20, 3.0)
    rows = vectors(spark, d).withColumn("insert", arrays.once(gain, lambda g: F.transform(insert, lambda x: x * g)))
    return digested(rows, arrays.spliced(F.col("a"), F.col("insert"), F.lit(24), (F.lit(3), F.lit(5)), 6, F.lit(0.25), 16))


@query(f"""WITH {VEC}, {_TONE}, b AS (SELECT *, {_RMS("a[19:24]")} / {_RMS("a[1:24]")} > 0.2 AS b1, {_RMS("a[41:46]")} / {_RMS("a[41:48]")} > 0.2 AS b2, {_RMS("a[43:48]")} / {_RMS("a[41:48]")} > 0.2 AS b3, {_RMS("a[25:30]")} / {_RMS("a[25:64]")} > 0.2 AS b4 FROM u),
i1 AS (SELECT *, CASE WHEN b2 THEN {_edges("a[41:48]", "8", _COSINE, True, False)} ELSE a[41:48] END AS j FROM b),
r AS (SELECT vec_id, CASE WHEN b1 THEN {_edges("a[1:24]", "24", _COSINE, False, True)} ELSE a[1:24] END || CASE WHEN b1 THEN {_gap("9")} ELSE {_gap("2")} END
  || CASE WHEN b3 THEN {_edges("j", "8", _COSINE, False, True)} ELSE j END || CASE WHEN b3 THEN {_gap("9")} ELSE {_gap("2")} END || CASE WHEN b4 THEN {_edges("a[25:64]", "40", _COSINE, True, False)} ELSE a[25:64] END AS s FROM i1) SELECT vec_id, {_DIGEST} FROM r""")
def splice_adaptive(spark, d):
    return digested(vectors(spark, d), arrays.adapted(F.col("a"), F.slice("a", 41, 8), F.lit(24), 6, 2, 9, F.lit(0.25), 16))


# ---- texts -----------------------------------------------------------------------------------------------------------


@query("""WITH w AS (SELECT conv_id, turn, list_filter(list_transform(regexp_extract_all(nfc_normalize(text), '\\S+'), lambda x: trim(x, ',.!?;:"''()…')), lambda x: x <> '') AS w FROM conversations) SELECT conv_id, turn, CAST(len(w) AS INT) AS n, array_to_string(w, ' ') AS words FROM w""")
def clean_words(spark, d):
    words = F.filter(F.transform(T.tokens(T.composed(F.col("text"))), T.clean_word), lambda w: w != "")
    return table(spark, d, "conversations").select("conv_id", "turn", words.alias("w")).select("conv_id", "turn", F.size("w").alias("n"), F.array_join("w", " ").alias("words"))


@query("SELECT conv_id, turn, 'Put one of <laughter, sigh, cough, throatclearing, sneeze, sniff> at a mark of 2 in: ' || text AS prompt FROM conversations")
def prompts(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", T.filled("Put one of <{tags}> at a mark of {n} in: {text}", tags=F.lit(", ".join(T.CLASSES)), n=F.lit(2), text=F.col("text")).alias("prompt"))


@query("SELECT p_partkey, (p_partkey % 7, p_size % 20) >= (3, 10) AS new_enough FROM part")
def version_order(spark, d):
    version = F.concat_ws(".", (F.col("p_partkey") % 7).cast("string"), (F.col("p_size") % 20).cast("string"))
    return table(spark, d, "part").select("p_partkey", T.version_at_least(version, F.lit("3.10")).alias("new_enough"))


@query(r"SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN regexp_extract_all(text, '\S+')[1] END AS first_word, CASE WHEN turn % 2 = 0 AND len(regexp_extract_all(text, '\S+')) > 0 THEN 0.15 * (30.0 / len(regexp_extract_all(text, '\S+'))) END AS start FROM conversations")
def word_table(spark, d):
    """Word times where the aligner gives some, else null."""
    words = T.even_words(F.col("text"), F.lit(30.0))
    rows = table(spark, d, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 2 == 0, words).alias("w"))
    return rows.select("conv_id", "turn", F.get("w", F.lit(0))["text"].alias("first_word"), F.get("w", F.lit(0))["start"].alias("start"))

