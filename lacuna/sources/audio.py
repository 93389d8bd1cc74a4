"""PCM16 WAV in and out, by the standard library; other formats need a backend."""

from __future__ import annotations

import io
import uuid
import wave

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lacuna.schemas import FEATURE_VERSION

MEASURES = ("peak", "crest", "duration", "snr_db", "rate_hz", "tilt_db", "clipping")


def decode(content: bytes, rate: int | None = None) -> tuple[np.ndarray, int]:
    """Mono samples (the mean of channels) and their rate."""
    from lacuna.operators.dsp import resample

    with wave.open(io.BytesIO(content)) as f:
        if f.getsampwidth() != 2:
            raise ValueError("only 16-bit PCM can be decoded here")
        own, x = f.getframerate(), np.frombuffer(f.readframes(f.getnframes()), "<i2").reshape(-1, f.getnchannels())
    mono = x.mean(1).astype(np.float32) / 32768
    return (mono, own) if rate in (None, own) else (resample(mono, own, rate), rate)


def encode(samples, rate: int) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes((np.clip(samples, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def duration(content: bytes) -> float:
    with wave.open(io.BytesIO(content)) as f:
        return f.getnframes() / f.getframerate()


def clarity(samples) -> float:
    """Decibels from the 10th to the 90th percentile of levels, within 0-60; 60 below four frames."""
    from lacuna.operators.dsp import frame_levels

    levels = frame_levels(samples, 1024, 256)
    a, b = np.maximum(np.percentile(levels, [10, 90]), 1e-10)
    return 60.0 if len(levels) < 4 else float(np.clip(20 * np.log10(b / a), 0, 60))


def tilt(levels: np.ndarray) -> float:
    """The slope of decibels over the whole length, floored at 40 below the loudest, within 60; 0 below four frames."""
    db = np.maximum(20 * np.log10(np.maximum(levels, 1e-10) / max(levels.max(initial=0), 1e-10)), -40)
    return 0.0 if len(db) < 4 else float(np.clip(np.polyfit(np.linspace(0, 1, len(db)), db, 1)[0], -60, 60))


def burst_rate(levels: np.ndarray, length: float) -> float:
    """Peaks of the level a second (the last frame of a plateau), from a quarter of the loudest and six frames apart."""
    inner = np.flatnonzero((levels[1:-1] >= levels[:-2]) & (levels[1:-1] > levels[2:]) & (levels[1:-1] / (levels.max(initial=0) + 1e-9) >= 0.25)) + 1
    kept, last = 0, -6
    for k in inner.tolist():
        if k - last >= 6:
            kept, last = kept + 1, k
    return kept / max(length, 1e-9)


def _place(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/"))


def read_bytes(path: str) -> bytes:
    """A file by its path or URL, as a task reads it from storage that all executors share."""
    store, where = _place(path)
    with store.open_input_stream(where) as f:
        return f.read()


def write_bytes(path: str, content: bytes) -> None:
    """Writes beside the path and renames, so that a retried task leaves a whole file."""
    store, where = _place(path)
    store.create_dir(where.rsplit("/", 1)[0], recursive=True)
    part = f"{where}.{uuid.uuid4().hex}.part"
    with store.open_output_stream(part) as f:
        f.write(content)
    store.move(part, where)


def stamp(path: str) -> tuple[int, int] | None:
    """(size, mtime in ns) of a file; None if there is none."""
    store, where = _place(path)
    info = store.get_file_info(where)
    return (info.size, info.mtime_ns) if info.is_file else None


def clip_features(samples: np.ndarray, rate: int) -> dict:
    """The measures of a clip: peak, level and timing of the trimmed clip, clarity and clipping of the whole one."""
    from lacuna.operators import dsp

    islands = dsp.nonsilent(samples)
    trimmed = samples if not len(islands) else samples[max(0, islands[0, 0] - int(0.12 * rate)) : islands[-1, 1] + int(0.12 * rate)]
    peak = float(np.abs(trimmed).max(initial=0))
    levels, length = dsp.frame_levels(trimmed, 1024, 256), len(trimmed) / rate
    return {"peak": peak, "crest": dsp.rms(trimmed) / (peak + 1e-9), "duration": length, "snr_db": clarity(samples), "rate_hz": burst_rate(levels, length), "tilt_db": tilt(levels), "clipping": float((np.abs(samples) >= 0.999).mean()) if len(samples) else 0.0}


def current(spark, path: str) -> bool:
    """Whether a feature table is there and of this version."""
    from lacuna.sources.manifest import exists

    if not exists(spark, path):
        return False
    rows = spark.read.parquet(path)
    return "feature_version" in rows.columns and rows.where(F.col("feature_version") != FEATURE_VERSION).isEmpty()


def feature_table(files: DataFrame) -> DataFrame:
    """(name, path, MEASURES, error, feature_version) of binaryFile rows; a file that can't be read is a row with an error, not a failed job."""
    names = MEASURES

    def measure(batches):
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    rows.append({"name": path.rsplit("/", 1)[-1], "path": path, **{k: round(v, 6) for k, v in clip_features(*decode(content)).items()}, "error": None})
                except Exception as x:  # one bad file must not stop the rest
                    rows.append({"name": path.rsplit("/", 1)[-1], "path": path, **dict.fromkeys(names), "error": repr(x)[:200]})
            yield pd.DataFrame(rows, columns=["name", "path", *names, "error"]).astype(dict.fromkeys(names, float))

    return files.select("path", "content").mapInPandas(measure, "name string, path string, " + ", ".join(f"{k} double" for k in names) + ", error string").withColumn("feature_version", F.lit(FEATURE_VERSION))
