"""What a model must offer, and deterministic stand-ins without weights."""

from __future__ import annotations

import hashlib
import json
import re
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from lacuna.functions.text import CLASSES


class Aligner(Protocol):
    def word_times(self, text: str, duration: float) -> list[tuple[str, float, float]] | None: ...


class Tagger(Protocol):
    def choose(self, marked: str, slots: int, attempt: int) -> str: ...


class Scorer(Protocol):
    def score(self, samples: np.ndarray, rate: int) -> dict[str, float]: ...


class Converter(Protocol):
    def convert(self, clip: np.ndarray, speaker: np.ndarray, rate: int) -> np.ndarray: ...


class Encoder(Protocol):
    def similarity(self, a: np.ndarray, b: np.ndarray, rate: int) -> float: ...


class Transcriber(Protocol):
    def transcribe(self, samples: np.ndarray, rate: int, language: str) -> str: ...


class Lazy:
    """A model that is made in each worker when it is first needed. One that can't be made is not tried again there: it raises the
    first error, which the row that asked gets."""

    made: dict[str, object] = {}

    def __init__(self, name: str, make):
        self.name, self.make = name, make

    def __getattr__(self, what):
        if what.startswith("__"):
            raise AttributeError(what)
        if self.name not in Lazy.made:
            try:
                Lazy.made[self.name] = self.make()
            except Exception as x:  # kept, so that later rows don't load it again
                Lazy.made[self.name] = RuntimeError(f"{self.name} could not be loaded: {type(x).__name__}: {x}")
        model = Lazy.made[self.name]
        if isinstance(model, RuntimeError):
            raise model
        return getattr(model, what)


class EvenAligner:
    """Words of equal shares of the recording, with gaps between them."""

    def word_times(self, text, duration):
        words = text.split()
        step = duration / max(1, len(words))
        return [(w, (i + 0.15) * step, (i + 0.85) * step) for i, w in enumerate(words)] or None


class HashTagger:
    """A slot and class by hash of the text."""

    def choose(self, marked, slots, attempt):
        h = int(hashlib.sha256(f"{marked}\0{attempt}".encode()).hexdigest()[:13], 16)
        return json.dumps({"slot": h % slots + 1 if slots else None, "tag": CLASSES[h // 7 % len(CLASSES)]})


class LevelScorer:
    """Scores from level and clarity alone."""

    def score(self, samples, rate):
        from lacuna.sources.audio import clip_features

        f = clip_features(np.asarray(samples), rate)
        mos = 1 + 4 * f["snr_db"] / 60
        return {"mos": mos, "noisiness": mos, "discontinuity": 5 - 4 * f["clipping"], "coloration": 3.0, "loudness": 1 + 4 * min(1.0, f["crest"])}


class SameVoice:
    def convert(self, clip, speaker, rate):
        return clip


class SpectrumEncoder:
    """The cosine of mean log spectra."""

    def similarity(self, a, b, rate):
        def mean(x):
            x = np.pad(np.asarray(x, np.float64), (0, max(0, 1024 - len(x))))
            return np.log1p(np.abs(np.fft.rfft(np.lib.stride_tricks.sliding_window_view(x, 1024)[::512] * np.hanning(1024)))).mean(0)

        u, v = mean(a), mean(b)
        return float(u @ v / max(np.linalg.norm(u) * np.linalg.norm(v), 1e-12))


def usable(reply: str, slots: int) -> bool:
    """Whether a reply needs no other attempt: a slot from 1 to slots with a known class, or no slot (the model declines)."""
    found = re.search(r"\{.*\}", reply or "", re.S)
    try:
        answer = json.loads(found[0]) if found else None
    except ValueError:
        return False
    if not isinstance(answer, dict):
        return False
    slot, tag = answer.get("slot"), str(answer.get("tag")).strip().strip("[]").strip().lower()
    return slot is None or (type(slot) is int and 1 <= slot <= slots and tag in CLASSES)


def choose_slots(rows: DataFrame, tagger: Tagger, retries: int = 2) -> DataFrame:
    """(id, reply, attempts) of rows (id, marked, slots) that offer a slot; a model's error is an empty reply, not a failed job."""

    def ask(batches):
        for pdf in batches:
            out = []
            for id_, marked, n in zip(pdf["id"], pdf["marked"], pdf["slots"]):
                reply, k = "", 0
                for k in range(1, retries + 2):
                    try:
                        reply = tagger.choose(marked, int(n), k)
                        if usable(reply, int(n)):
                            break
                    except Exception:  # the next attempt may do
                        reply = ""
                out.append((id_, reply, k))
            yield pd.DataFrame(out, columns=["id", "reply", "attempts"])

    return rows.where("slots > 0").mapInPandas(ask, "id string, reply string, attempts int")
