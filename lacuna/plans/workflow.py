"""The whole way from recordings to a filtered data set. Each step reads its inputs, does the rows that its table lacks and upserts them.

Only what models and samples need runs in Python, on Arrow batches of paths: tasks read recordings from shared storage, so
that no audio is shuffled. A row that fails is left out with its error in the log table of its step, and is tried again by the next run.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lacuna import config
from lacuna.backends.protocols import Aligner, Converter, Encoder, EvenAligner, HashTagger, LevelScorer, SameVoice, Scorer, SpectrumEncoder, Tagger, Transcriber, choose_slots
from lacuna.functions import text as T
from lacuna.operators import dsp, gates, keyed, select, series, voice
from lacuna.plans import stages
from lacuna.schemas import ALIGNED, QUALITY, SLOTS, SYNTHESISED, TAGGED
from lacuna.sources import audio, manifest

DIMENSIONS = ("mos", "noisiness", "discontinuity", "coloration")
TEMPO_CLASSES = ("laughter",)


@dataclass(frozen=True)
class Models:
    """The models of a run; by default stand-ins without weights."""

    aligner: Aligner = field(default_factory=EvenAligner)
    tagger: Tagger = field(default_factory=HashTagger)
    converter: Converter = field(default_factory=SameVoice)
    encoder: Encoder = field(default_factory=SpectrumEncoder)
    scorer: Scorer = field(default_factory=LevelScorer)
    transcriber: Transcriber | None = None


def per_row(rows: DataFrame, work: Callable[[SimpleNamespace], dict], schema: str) -> DataFrame:
    """Columns of schema, and error, from work on each row: what a row raises is its error, not the job's."""
    arrow = to_arrow_schema(StructType.fromDDL(f"{schema}, error string"))

    def batches(taken):
        for batch in taken:
            out = []
            for r in batch.to_pylist():
                try:
                    out.append({**work(SimpleNamespace(**r)), "error": None})
                except Exception as x:  # one bad recording must not stop the rest
                    out.append({"id": r["id"], "error": f"{type(x).__name__}: {x}"[:300]})
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return rows.mapInArrow(batches, f"{schema}, error string")


def done_well(found: DataFrame, path: str) -> DataFrame:
    """Rows without an error; the others are appended to the step's log. Found is written first, so that no model runs twice."""
    spark = found.sparkSession
    found.write.mode("overwrite").parquet(path + ".found")
    found = spark.read.schema(found.schema).parquet(path + ".found")
    found.where("error IS NOT NULL").select("id", "error", F.current_timestamp().alias("at")).write.mode("append").json(path + ".errors")
    return found.where("error IS NULL").drop("error")


def first_rows(rows: DataFrame, limit: int | None) -> DataFrame:
    return rows.orderBy("id").limit(limit) if limit else rows


def untagged_rows(spark: SparkSession, cfg) -> DataFrame:
    return manifest.paired(manifest.listing(spark, cfg.paths.raw_audio_dir), manifest.transcripts(spark, cfg.paths.raw_transcript_dir))[0]


def all_rows(spark: SparkSession, cfg, tagged: bool = True) -> DataFrame:
    """(id, audio_filepath, text, extra): of the manifest if the settings name one, else of the folders."""
    if cfg.paths.manifest:
        rows, missing = manifest.present(manifest.read_manifest(spark, cfg.paths.manifest))
        missing.select("id", "audio_filepath", F.current_timestamp().alias("at")).write.mode("overwrite").json(f"{cfg.paths.stage_dir}/missing_audio")
        return rows
    folder = cfg.paths.tagged_transcript_dir if tagged else cfg.paths.raw_transcript_dir
    return manifest.paired(manifest.listing(spark, cfg.paths.raw_audio_dir), manifest.transcripts(spark, folder))[0].withColumn("extra", F.lit(None).cast("string"))


def tagged_rows(spark: SparkSession, cfg, limit: int | None = None) -> DataFrame:
    return first_rows(all_rows(spark, cfg).where(T.extract_tag(F.col("text")).isNotNull()), limit)


def transcribe(spark: SparkSession, cfg, models: Models, overwrite: bool = False) -> DataFrame:
    """(id, text) of recordings that have no transcript yet, or of all; each is also written as a file."""
    if models.transcriber is None:
        raise ValueError("no transcriber is set")
    rows, model, folder, language = manifest.listing(spark, cfg.paths.raw_audio_dir), models.transcriber, cfg.paths.raw_transcript_dir, cfg.asr.language
    if not overwrite and manifest.exists(spark, folder):
        rows = rows.join(manifest.transcripts(spark, folder).select("id"), "id", "left_anti")

    def work(r):
        text = model.transcribe(*audio.decode(audio.read_bytes(r.path)), language)
        audio.write_bytes(f"{folder}/{r.id}.txt", text.encode())
        return {"id": r.id, "text": text}

    return done_well(per_row(rows, work, "id string, text string"), f"{cfg.paths.stage_dir}/transcribe")


def slots(spark: SparkSession, cfg, models: Models, limit: int | None = None, force: bool = False) -> DataFrame:
    """The pauses between words that each recording offers."""
    path, aligner = f"{cfg.paths.stage_dir}/slots.jsonl", models.aligner

    def measure(r):
        x, rate = audio.decode(audio.read_bytes(r.audio_filepath))
        words = aligner.word_times(r.text, len(x) / rate) or []
        return {"id": r.id, "text": r.text, "islands": [{"lo": a / rate, "hi": b / rate} for a, b in dsp.nonsilent(x).tolist()], "words": [{"w": i, "word": w, "start": a, "stop": b} for i, (w, a, b) in enumerate(words)]}

    def work(rows):
        found = done_well(per_row(rows, measure, "id string, text string, islands array<struct<lo:double,hi:double>>, words array<struct<w:int,word:string,start:double,stop:double>>").select("*"), path)
        one = lambda c: found.select("id", F.inline(c))
        return stages.slots(found.select("id", "text"), one("islands"), one("words"), config.stage_settings(cfg))

    return stages.run_stage(first_rows(untagged_rows(spark, cfg), limit), path, SLOTS, work, force=force)


def tag(spark: SparkSession, cfg, models: Models, limit: int | None = None, force: bool = False) -> DataFrame:
    """A pause and a class for each row, by the tagger; rows without a pause or whose reply is no choice stay untagged."""
    path, folder = f"{cfg.paths.stage_dir}/tagged.jsonl", cfg.paths.tagged_transcript_dir
    offered = manifest.read_stage(spark, f"{cfg.paths.stage_dir}/slots.jsonl", SLOTS)

    def save(r):
        audio.write_bytes(f"{folder}/{r.id}.txt", r.tagged.encode())
        return {"id": r.id, "tag": r.tag, "slot_i": r.slot_i, "insert_at_s": r.insert_at_s, "pause_s": r.pause_s}

    def work(rows):
        asked = rows.join(offered, "id").withColumn("slots", F.size("candidates"))
        marked = asked.withColumn("marked", T.with_markers(F.col("text"), F.transform("candidates", lambda c: c["char_offset"])))
        replies = choose_slots(marked.select("id", "marked", "slots"), models.tagger, cfg.tagging.max_retries)
        chosen = asked.join(replies, "id").withColumn("choice", T.slot_choice(F.col("reply"), F.col("slots"))).where("choice.status = 'ok'")
        at = F.element_at("candidates", F.col("choice.slot"))
        placed = chosen.select("id", F.concat(F.lit("["), "choice.tag", F.lit("]")).alias("tag"), F.col("choice.slot").alias("slot_i"), at["time_s"].alias("insert_at_s"), at["pause_s"].alias("pause_s"), T.insert_at(F.col("text"), at["char_offset"], F.col("choice.tag")).alias("tagged"))
        return done_well(per_row(placed, save, TAGGED), path)

    return stages.run_stage(first_rows(untagged_rows(spark, cfg), limit), path, TAGGED, work, force=force)


def align(spark: SparkSession, cfg, models: Models, limit: int | None = None, force: bool = False) -> DataFrame:
    """When each row's event happens: at its chosen pause, else where the aligner or the share of words puts it, moved into a pause."""
    path, aligner = f"{cfg.paths.stage_dir}/align.jsonl", models.aligner
    chosen = manifest.read_stage(spark, f"{cfg.paths.stage_dir}/tagged.jsonl", TAGGED)

    def measure(r):
        x, rate = audio.decode(audio.read_bytes(r.audio_filepath))
        words, k = aligner.word_times(r.plain, len(x) / rate) or [], int(r.before)
        at = (words[k - 1][2] + words[k][1]) / 2 if 0 < k < len(words) else None
        return {"id": r.id, "duration": len(x) / rate, "aligner": at, "islands": [{"lo": a / rate, "hi": b / rate} for a, b in dsp.nonsilent(x).tolist()]}

    def work(rows):
        text, cut = F.col("text"), F.regexp_instr(F.col("text"), F.lit(T.TAG))
        todo = rows.join(chosen.select("id", "insert_at_s", "pause_s"), "id", "left")
        rest = todo.where("insert_at_s IS NULL").select("id", "audio_filepath", T.squeezed(F.regexp_replace(text, T.TAG, " ")).alias("plain"), F.size(T.tokens(F.substr(text, F.lit(1), cut - 1))).alias("before"))
        found = done_well(per_row(rest, measure, "id string, duration double, aligner double, islands array<struct<lo:double,hi:double>>"), path)
        estimates = found.join(rows.select("id", "text"), "id").select("id", "aligner", T.tag_time(text, F.col("duration")).alias("proportional"))
        regions = series.merge_close(found.select("id", F.inline("islands")), "id", cfg.vad.merge_gap_s)
        pauses = series.pauses(regions, "id", cfg.vad.edge_margin_s, cfg.vad.min_pause_s)
        return stages.align(todo, estimates, pauses if cfg.vad.enabled else pauses.where("false"), config.stage_settings(cfg))

    return stages.run_stage(tagged_rows(spark, cfg, limit), path, ALIGNED, work, force=force)


def clip_table(spark: SparkSession, cfg) -> DataFrame:
    """(vs_class, name, path, six measures, intensity) of the usable clips, measured once; clipped ones only where a class has no others."""
    path = cfg.selection.feature_manifest or f"{cfg.paths.stage_dir}/clips.parquet"
    if not audio.current(spark, path):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(cfg.paths.clip_dir)
        audio.feature_table(files.where(F.lower("path").rlike(r"\.wav$"))).write.mode("overwrite").parquet(path)
    rows = spark.read.parquet(path).where(F.col("error").isNull() & gates.usable(F.col("peak"), F.col("duration")))
    rows = rows.withColumn("vs_class", manifest.clip_name(F.col("name"))["kind"])
    rows = select.clean_pool(rows, "vs_class", F.col("clipping"), cfg.selection.max_clipping)
    ranked = series.position_ranks(series.position_ranks(rows, "vs_class", "crest", "name", "r1"), "vs_class", "duration", "name", "r2")
    return ranked.withColumn("intensity", (F.col("r1") + F.col("r2")) / 2).drop("r1", "r2", "error", "feature_version")


def clip_cost(cfg) -> Column:
    s, c = cfg.selection, F.col
    away = select.distances((c("intensity"), c("aim")), (c("snr_db"), c("speaker_snr")), (c("tilt_db"), c("speaker_tilt")), (c("rate_hz"), c("speaker_rate")), c("vs_class").isin(*TEMPO_CLASSES))
    return s.energy_weight * away["intensity"] + s.clarity_weight * away["clarity"] + s.tilt_weight * away["tilt"] + s.tempo_weight * F.coalesce(away["tempo"], F.lit(0.0))


def clip_axes(cfg) -> list[select.Axis]:
    """The axes by which clips are dealt into cells: loudness ranks and clarity."""
    s = cfg.selection
    return [select.Axis(F.col("intensity"), F.col("aim"), s.energy_weight / select.INTENSITY_TOLERANCE, 0.0, 1 / 16, 16), select.Axis(F.col("snr_db"), F.col("speaker_snr"), s.clarity_weight / select.CLARITY_TOLERANCE_DB, 0.0, 6.0, 10)]


def spliced(speech, event, rate: int, at_s: float, vs_class: str, phase: float, cfg) -> tuple[np.ndarray, float]:
    """The recording with the event, and where it was cut."""
    p, event, fade = cfg.splice, np.asarray(event, np.float64), cfg.splice.fade_ms / 1000
    cut = int(at_s * rate)
    if p.mode == "tempo":
        offset = p.level_offsets_db.get(vs_class, T.LEVEL_OFFSET_DB.get(vs_class, 0.0))
        if p.level_ref == "context_rms":
            gain = dsp.level_gain(event, speech, rate, cut, p.context_gain_db, offset, cfg.selection.context_s)
        else:
            gain = np.abs(speech).max(initial=0) / max(np.abs(event).max(initial=0), 1e-9) * 10 ** ((p.para_gain_db + offset) / 20)
        pause, there, shape = voice.typical_pause(speech, rate), voice.silence_around(speech, rate, at_s), p.gap_shape.get(vs_class, T.GAP_SHAPE.get(vs_class, (1.0, 1.0)))
        pad = tuple(max(0, int((pause * p.gap_scale * k - have) * rate)) for k, have in zip(shape, there))
        return dsp.splice(speech, event * gain, rate, at_s, pad, phase, fade), at_s
    gain = np.abs(speech).max(initial=0) / max(np.abs(event).max(initial=0), 1e-9) * 10 ** (p.para_gain_db / 20)
    if p.mode == "adaptive":
        return dsp.adaptive_splice(speech, event * gain, rate, at_s, phase, fade, p.min_pad_ms / 1000, p.max_gap_ms / 1000), min(max(0, cut), len(speech)) / rate
    cut = {"before": 0, "after": len(speech)}.get(p.placement, min(max(0, cut), len(speech)))
    silence = np.zeros(int(p.pad_ms / 1000 * rate))
    body = event * gain * dsp.linear_envelope(len(event), int(fade * rate))
    return np.concatenate([speech[:cut], silence, body, silence, speech[cut:]]), cut / rate


def synth(spark: SparkSession, cfg, models: Models, limit: int | None = None, force: bool = False) -> DataFrame:
    """A recording with an event for each aligned row; a row is done if its entry and its file exist."""
    path, rate, seed = f"{cfg.paths.output_dir}/metadata_synth.jsonl", cfg.sample_rate, str(cfg.seed)
    cached, aligned = manifest.read_stage(spark, path, SYNTHESISED), manifest.read_stage(spark, f"{cfg.paths.stage_dir}/align.jsonl", ALIGNED)
    tagged = tagged_rows(spark, cfg, limit)
    rows = tagged.join(aligned.select("id", "insert_at_s", "insert_stage"), "id")
    keyed.todo(tagged, aligned).select("id", F.current_timestamp().alias("at")).write.mode("overwrite").json(f"{cfg.paths.stage_dir}/not_aligned")
    if manifest.exists(spark, cfg.paths.output_dir):
        files = manifest.listing(spark, cfg.paths.output_dir).select(F.regexp_replace("id", "^para_", "").alias("id"))
        rows = rows if force else rows.join(keyed.finished(cached.select("id"), cached, files), "id", "left_anti")

    def measure(r):
        x, _ = audio.decode(audio.read_bytes(r.audio_filepath), rate)
        return {"id": r.id, **voice.profile(x, rate, r.insert_at_s, cfg.selection.context_s)}

    def render(r):
        speech, _ = audio.decode(audio.read_bytes(r.audio_filepath), rate)
        clip = voice.ready_clip(audio.decode(audio.read_bytes(r.clip_path), rate)[0], rate)
        event = voice.trimmed(models.converter.convert(clip, speech, rate), rate, 0.0)
        out, at = spliced(speech, event, rate, r.insert_at_s, r.vs_class, r.phase, cfg)
        to = f"{cfg.paths.output_dir}/para_{r.id}.wav"
        audio.write_bytes(to, audio.encode(dsp.normalised(out), rate))
        like = [models.encoder.similarity(speech, y, rate) for y in (event, clip)]
        return {"id": r.id, "source_audio": r.audio_filepath, "para_audio": to, "vs_clip": r.vs_clip, "vs_class": r.vs_class, "nv_tag": r.nv_tag, "transcript": r.text, "splice_at_s": at, "insert_stage": r.insert_stage, "sim_converted": like[0], "sim_raw_baseline": like[1], "speaker_score": r.energy_rank, "clip_intensity": r.intensity, "selection_cost": r.cost}

    def work(rows):
        profiles = done_well(per_row(rows.select("id", "audio_filepath", "insert_at_s"), measure, "id string, energy_rank double, speaker_snr double, speaker_rate double, speaker_tilt double"), f"{cfg.paths.stage_dir}/profiles")
        tag_, clips, s = T.extract_tag(F.col("text")), clip_table(spark, cfg), cfg.selection
        known = rows.join(profiles, "id").withColumn("nv_tag", tag_).withColumn("vs_class", T.match_class(tag_, select.uniform(F.lit(seed), F.col("id"), F.lit("class"))))
        aim = select.gaussian(F.col("energy_rank"), s.intensity_spread, F.lit(seed), F.col("id"), F.lit("aim")) if s.intensity_spread > 0 else F.col("energy_rank")
        known = known.withColumn("aim", aim).withColumn("phase", select.uniform(F.lit(seed), F.col("id"), F.lit("phase")))
        need = known.select("id", "vs_class", "aim", "speaker_snr", "speaker_rate", "speaker_tilt")
        picked = select.weighted_pick(need, clips, "vs_class", "id", "name", clip_cost(cfg), seed, clip_axes(cfg))
        chosen = picked.join(clips.select(F.col("name").alias("picked"), F.col("path").alias("clip_path"), "intensity"), "picked").withColumnRenamed("picked", "vs_clip")
        jobs = known.join(chosen, "id").select("id", "audio_filepath", "text", "insert_at_s", "insert_stage", "nv_tag", "vs_class", "vs_clip", "clip_path", "intensity", "energy_rank", "cost", "phase")
        return done_well(per_row(jobs, render, SYNTHESISED), f"{cfg.paths.stage_dir}/synth")

    return stages.run_stage(rows, path, SYNTHESISED, work, force=True)


def failures(cfg) -> Column:
    """Why a row is turned down, as texts with values and limits; empty if it passes."""
    q, rules = cfg.quality, []
    say = lambda form, *values: F.format_string(form, *values)
    for d in DIMENSIONS if q.scores.enabled else ():
        source, value, least, most = F.col(f"source.{d}"), F.col(f"para.{d}"), getattr(q.scores, f"min_{d}"), getattr(q.scores, f"max_{d}_drop")
        if least is not None:
            rules.append((say(f"{d} %.2f < {least}", value), gates.floor_rule(value, least)))
        if most is not None:
            rules.append((say(f"{d}_drop %.2f > {most}", source - value), gates.drop_rule(source, value, most)))
    if q.max_boundary_activity is not None:
        before, after = F.col("boundary_activity.before"), F.col("boundary_activity.after")
        rules.append((say(f"boundary_activity %.2f (%s) > {q.max_boundary_activity}", F.greatest(before, after), gates.side(before, after)), gates.boundary_rule(before, after, q.max_boundary_activity)))
    return F.array_compact(F.array(*[F.when(rule, text) for text, rule in rules]))


def filter_rows(spark: SparkSession, cfg, models: Models, force: bool = False) -> DataFrame:
    """All synthesised rows with their measures, reasons and kept; those that stay are written. A new threshold measures nothing anew."""
    if not config.has_criteria(cfg):
        raise ValueError("the filter has no criteria: scores are off and max_boundary_activity is null")
    path, rate, scoring, scorer = f"{cfg.paths.stage_dir}/quality.jsonl", cfg.sample_rate, cfg.quality.scores.enabled, models.scorer
    rows = manifest.read_stage(spark, f"{cfg.paths.output_dir}/metadata_synth.jsonl", SYNTHESISED)
    cached = manifest.read_stage(spark, path, QUALITY)

    def look(r):
        now = audio.stamp(r.para_audio)
        return {"id": r.id, "stamp": None if now is None else {"size": now[0], "mtime_ns": now[1]}}

    def measure(r):
        speech, _ = audio.decode(audio.read_bytes(r.source_audio), rate)
        before, after = voice.boundary(speech, rate, r.splice_at_s)
        now = audio.stamp(r.para_audio)
        out = {"id": r.id, "para_audio": r.para_audio, "para_stat": now and {"size": now[0], "mtime_ns": now[1]}, "splice_at_s": r.splice_at_s, "boundary_activity": {"before": before, "after": after}, "source": None, "para": None}
        if scoring:
            out |= {"source": scorer.score(speech, rate), "para": scorer.score(audio.decode(audio.read_bytes(r.para_audio), rate)[0], rate)}
        return out

    live = per_row(rows.select("id", "para_audio"), look, "id string, stamp struct<size:bigint,mtime_ns:bigint>").select("id", "stamp")
    old = cached.select("id", F.col("splice_at_s").alias("old_at"), F.col("para_stat").alias("old_stamp"), F.col("source").alias("old_source"), F.col("para").alias("old_para"))
    j = rows.join(live, "id").join(old, "id", "left")
    same_file = F.coalesce(F.col("stamp") == F.col("old_stamp"), F.lit(False))
    current = (F.col("splice_at_s") == F.col("old_at")) & (same_file & F.col("old_para").isNotNull() if scoring else F.lit(True))
    todo = j if force else j.where(~F.coalesce(current, F.lit(False)))
    fresh = done_well(per_row(todo.select("id", "source_audio", "para_audio", "splice_at_s"), measure, QUALITY), path)
    if not scoring:  # scores of the same file stay
        kept = j.where(same_file).select("id", "old_source", "old_para")
        fresh = fresh.join(kept, "id", "left").withColumn("source", F.coalesce("source", "old_source")).withColumn("para", F.coalesce("para", "old_para")).drop("old_source", "old_para")
    valid = cached if force else cached.join(todo.select("id"), "id", "left_anti").unionByName(cached.join(rows.select("id"), "id", "left_anti"))
    manifest.write_stage(keyed.upsert(valid.dropDuplicates(["id"]), fresh), path)
    measures = manifest.read_stage(spark, path, QUALITY).select("id", "boundary_activity", "source", "para")
    judged = rows.join(measures, "id", "left").withColumn("reasons", failures(cfg)).withColumn("kept", F.size("reasons") == 0)
    names = {"source": "score_source", "para": "score_para"}
    manifest.write_stage(judged.where("kept").drop("reasons", "kept").withColumnsRenamed(names), f"{cfg.paths.output_dir}/metadata_filtered.jsonl")
    return judged


def export(spark: SparkSession, cfg, out: str | None = None) -> DataFrame:
    """The rows that passed, as a portable manifest: paths relative to it, durations measured anew, the source's other keys carried."""
    out = out or f"{cfg.paths.output_dir}/manifest.jsonl"
    rows = manifest.read_stage(spark, f"{cfg.paths.output_dir}/metadata_filtered.jsonl", "id string, para_audio string, transcript string")
    sized = per_row(rows, lambda r: {"id": r.id, "audio_filepath": r.para_audio, "text": r.transcript, "duration": audio.duration(audio.read_bytes(r.para_audio))}, "id string, audio_filepath string, text string, duration double")
    source = manifest.read_manifest(spark, cfg.paths.manifest) if cfg.paths.manifest else spark.createDataFrame([], "id string, extra string")
    found = manifest.exported(done_well(sized, f"{cfg.paths.stage_dir}/export"), source, out.rsplit("/", 1)[0])
    manifest.write_manifest(found, out)
    return found


def run(spark: SparkSession, cfg, models: Models, limit: int | None = None, force: bool = False) -> DataFrame:
    """align, synth and, if it has criteria, the filter."""
    align(spark, cfg, models, limit, force)
    rows = synth(spark, cfg, models, limit, force)
    return filter_rows(spark, cfg, models, force) if config.has_criteria(cfg) else rows


def inspect(spark: SparkSession, cfg, limit: int = 5) -> DataFrame:
    """The rows whose event is least like the speaker."""
    return manifest.read_stage(spark, f"{cfg.paths.output_dir}/metadata_synth.jsonl", SYNTHESISED).orderBy("sim_converted", "id").limit(limit)
