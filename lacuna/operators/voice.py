"""What is measured of a speaker's recording around a cut, on arrays of samples."""

from __future__ import annotations

import numpy as np

from lacuna.operators import dsp


def trimmed(x, rate: int, pad_s: float = 0.12) -> np.ndarray:
    """From the first onset to the last offset and pad_s on both sides; all of it where nothing is loud."""
    islands, pad = dsp.nonsilent(x), int(pad_s * rate)
    return np.asarray(x) if not len(islands) else np.asarray(x)[max(0, islands[0, 0] - pad) : islands[-1, 1] + pad]


def typical_pause(x, rate: int, low: float = 0.04, high: float = 0.40) -> float:
    """The median gap between loud runs within [low, high]; low without any."""
    islands = dsp.nonsilent(x)
    gaps = (islands[1:, 0] - islands[:-1, 1]) / rate
    gaps = gaps[gaps > 0]
    return float(np.clip(np.median(gaps), low, high)) if len(gaps) else low


def silence_around(x, rate: int, at_s: float, top_db: float = 30.0, win_s: float = 0.010) -> tuple[float, float]:
    """Seconds of silence before and after a point: the run of frames top_db below the loudest that holds it; (0, 0) amid sound."""
    x = np.asarray(x, np.float64)
    win = max(1, int(win_s * rate))
    hop = max(1, win // 2)
    if not len(x):
        return 0.0, 0.0
    level = dsp.frame_levels(np.pad(x, (0, max(0, win - len(x))), mode="edge"), win, hop)
    quiet = level <= level.max() * 10 ** (-top_db / 20)
    at = min(int(np.clip(at_s * rate, 0, len(x) - 1)) // hop, len(level) - 1)
    if level.max() <= 0 or not quiet[at]:
        return 0.0, 0.0
    loud = np.flatnonzero(~quiet)
    k = int(np.searchsorted(loud, at))
    lo = loud[k - 1] + 1 if k else 0
    hi = loud[k] if k < len(loud) else len(level)
    cut = int(np.clip(at_s * rate, 0, len(x)))
    return max(0.0, (cut - lo * hop) / rate), max(0.0, (hi * hop - cut) / rate)


def energy_rank(x, rate: int, at_s: float, context_s: float) -> float:
    """The share of the recording's windows that are quieter than the one before the point; 0.5 where there is too little sound."""
    x, win, end = np.asarray(x, np.float64), max(1, int(context_s * rate)), int(at_s * rate)
    context = x[max(0, end - win) : end]
    if not len(context) or len(x) < win:
        return 0.5
    squares = np.concatenate([[0.0], np.cumsum(x * x)])
    starts = np.arange(0, len(x) - win + 1, max(1, win // 4))
    levels = np.sqrt(np.maximum(squares[starts + win] - squares[starts], 0) / win)
    return float((levels < dsp.rms(context)).mean())


def profile(x, rate: int, at_s: float, context_s: float) -> dict[str, float]:
    """Energy, rate and tilt right before the point, clarity of the whole recording."""
    from lacuna.sources import audio

    end = int(at_s * rate)
    context = np.asarray(x)[max(0, end - max(1, int(context_s * rate))) : end] if end > 0 else np.asarray(x)
    levels = dsp.frame_levels(context, 1024, 256)
    return {"energy_rank": energy_rank(x, rate, at_s, context_s), "speaker_snr": audio.clarity(x), "speaker_rate": audio.burst_rate(levels, len(context) / rate), "speaker_tilt": audio.tilt(levels)}


def boundary(x, rate: int, at_s: float, win_s: float = 0.05) -> tuple[float, float]:
    """Levels of the last and first win_s around the cut over those of their sides; 0 where a side is silent or empty."""
    x, win = np.asarray(x, np.float64), int(win_s * rate)
    cut = int(np.clip(int(at_s * rate), 0, len(x)))
    left, right = x[:cut], x[cut:]
    ratio = lambda edge, side: dsp.rms(edge) / dsp.rms(side) if dsp.rms(side) > 0 else 0.0
    return ratio(left[-win:] if win else left[:0], left), ratio(right[:win], right)


def ready_clip(x, rate: int) -> np.ndarray:
    """Trimmed, at a peak of 0.95 and padded on both sides to a second."""
    y = dsp.normalised(trimmed(x, rate))
    short = max(0, int((rate - len(y)) / 2))
    return np.pad(y, (short, short))
