"""Sample-level signal operations: SQL where arrays are only cut and joined, numpy else."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, functions as F


def splice_arrays(speech: Column, insert: Column, cut: Column, pad: int) -> Column:
    """speech with insert between silences of pad samples behind its first cut samples."""
    silence = F.array_repeat(F.lit(0.0).cast("float"), pad)
    return F.concat(F.slice(speech, F.lit(1), cut), silence, insert, silence, F.slice(speech, cut + 1, F.size(speech)))


def rms(x) -> float:
    x = np.asarray(x, np.float64)
    return float(np.sqrt(np.mean(x * x))) if x.size else 0.0


def resample(x: np.ndarray, old: int, new: int) -> np.ndarray:
    """By linear interpolation."""
    if old == new or not len(x):
        return np.asarray(x, np.float32)
    n = max(1, round(len(x) * new / old))
    return np.interp(np.arange(n) * (old / new), np.arange(len(x)), x).astype(np.float32)


def frame_levels(x, win: int, hop: int) -> np.ndarray:
    x = np.asarray(x, np.float64)
    if len(x) < win:
        return np.array([rms(x)])
    return np.sqrt((np.lib.stride_tricks.sliding_window_view(x, win)[::hop] ** 2).mean(1))


def nonsilent(x, top_db: float = 30.0, frame: int = 2048, hop: int = 512) -> np.ndarray:
    """(start, end) samples of runs of centred frames less than top_db below the loudest."""
    x = np.asarray(x, np.float64)
    level = frame_levels(np.pad(x, frame // 2), frame, hop)
    on = 20 * np.log10(np.maximum(level, 1e-10) / max(level.max(initial=0), 1e-10)) > -top_db
    on &= level.max(initial=0) > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[0], on, [0]])))
    return np.minimum(edge.reshape(-1, 2) * hop, len(x))


def linear_envelope(n: int, fade: int) -> np.ndarray:
    fade = min(fade, n // 2)
    out = np.ones(n)
    out[:fade] = np.arange(fade) / max(1, fade)
    out[n - fade :] = out[:fade][::-1]
    return out


def cosine_fade(x, n: int, out: bool) -> np.ndarray:
    """A half cosine over the last (out) or first n samples."""
    y, n = np.array(x, np.float64), min(n, len(x))
    ramp = 0.5 * (1 + np.cos(np.pi * np.arange(n) / max(1, n - 1)))
    y[len(y) - n :] *= ramp if out else 1
    y[:n] *= 1 if out else ramp[::-1]
    return y


def exponential_fade(x, n: int, out: bool, k: float = 5.0) -> np.ndarray:
    """A decay from exactly 1 to exactly 0 over the last (out) or, reversed, the first n samples."""
    y, n = np.array(x, np.float64), min(n, len(x))
    if not n:
        return y
    curve = np.exp(-k * np.linspace(0, 1, n))
    curve = (curve - curve[-1]) / (curve[0] - curve[-1]) if n > 1 else np.zeros(1)
    if out:
        y[len(y) - n :] *= curve
    else:
        y[:n] *= curve[::-1]
    return y


def room_tone(n: int, speech, rate: int, phase: float, window_s: float = 0.1) -> np.ndarray:
    """n samples of the quietest window, tiled over a cross-faded seam from a phase (0-1); shorter than eight samples, noise of its level by the phase."""
    speech = np.asarray(speech, np.float64)
    win = min(len(speech), int(window_s * rate))
    if win < 8:
        return np.random.default_rng(int(phase * 2**32)).normal(0, max(rms(speech), 1e-5), n)
    levels = frame_levels(speech, win, max(1, win // 2))
    at = int(levels.argmin()) * max(1, win // 2)
    tone, seam = speech[at : at + win].copy(), max(1, win // 8)
    ramp = np.linspace(0, 1, seam)
    loop = tone[: win - seam]
    loop[:seam] = loop[:seam] * ramp + tone[win - seam :] * (1 - ramp)
    return loop[(np.arange(n) + int(phase * len(loop))) % len(loop)]


def level_gain(insert, speech, rate: int, at: int, gain_db: float, offset_db: float, context_s: float = 2.5, headroom: float = 1.5) -> float:
    """What the insert is multiplied by: to the level of the speech before the cut, within the 99.9th percentile of all the speech times the headroom."""
    insert, speech = np.asarray(insert, np.float64), np.asarray(speech, np.float64)
    context = speech[max(0, at - int(context_s * rate)) : at]
    context = context if rms(context) > 0 else speech
    now = rms(insert)
    if now <= 0 or rms(context) <= 0:
        return 1.0
    gain = rms(context) / now * 10 ** ((gain_db + offset_db) / 20)
    peak, ceiling = np.abs(insert).max(), np.percentile(np.abs(speech), 99.9) * headroom
    return float(min(gain, ceiling / peak) if peak > 0 and ceiling > 0 else gain)


def splice(speech, insert, rate: int, at_s: float, pad: tuple[int, int], phase: float, fade_s: float = 0.02) -> np.ndarray:
    """speech cut at at_s (towards zero), with the insert between room tone; all edges fade."""
    speech, insert = np.asarray(speech, np.float64), np.asarray(insert, np.float64)
    cut, fade = min(max(0, int(at_s * rate)), len(speech)), int(fade_s * rate)
    left, right = exponential_fade(speech[:cut], fade, True), exponential_fade(speech[cut:], fade, False)
    body = exponential_fade(exponential_fade(insert, fade, False), fade, True)
    tone = [room_tone(n, speech, rate, phase) if n else np.zeros(0) for n in pad]
    return np.concatenate([left, tone[0], body, tone[1], right])


def adaptive_splice(speech, insert, rate: int, at_s: float, phase: float, fade_s: float, min_pad_s: float, max_gap_s: float, active: float = 0.2) -> np.ndarray:
    """speech cut at at_s with the insert between room tone: edges with sound right at the cut fade by a half cosine, and the
    gap behind such an edge is the wide one."""
    speech, insert = np.asarray(speech, np.float64), np.asarray(insert, np.float64)
    cut, fade = min(max(0, int(at_s * rate)), len(speech)), int(fade_s * rate)
    left, right = speech[:cut], speech[cut:]
    busy = lambda edge, side: rms(side) > 0 and rms(edge) / rms(side) > active
    last = lambda x: x[len(x) - min(fade, len(x)) :]
    before, head, tail, after = busy(last(left), left), busy(insert[:fade], insert), busy(last(insert), insert), busy(right[:fade], right)
    left, right = cosine_fade(left, fade, True) if before else left, cosine_fade(right, fade, False) if after else right
    insert = cosine_fade(insert, fade, False) if head else insert
    insert = cosine_fade(insert, fade, True) if tail else insert
    tone = [room_tone(n, speech, rate, phase) if (n := int((max_gap_s if wide else min_pad_s) * rate)) else np.zeros(0) for wide in (before, tail)]
    return np.concatenate([left, tone[0], insert, tone[1], right])


def normalised(x, peak: float = 0.95) -> np.ndarray:
    x = np.asarray(x, np.float64)
    return x / (np.abs(x).max(initial=0) + 1e-9) * peak


def pitch_track(x, rate: int, low: float = 60.0, high: float = 500.0, win: int = 1024, hop: int = 256, voiced: float = 0.5) -> np.ndarray:
    """Frequencies of frames by normalised autocorrelation; NaN where it stays under `voiced`."""
    x = np.asarray(x, np.float64)
    if len(x) < win:
        return np.zeros(0)
    f = np.lib.stride_tricks.sliding_window_view(x, win)[::hop]
    f = f - f.mean(1, keepdims=True)
    power = np.abs(np.fft.rfft(f, 2 * win)) ** 2
    ac = np.fft.irfft(power)[:, :win]
    ac = ac / np.maximum(ac[:, :1], 1e-12)
    lo, hi = int(rate / high), min(win - 1, int(rate / low))
    lag = ac[:, lo:hi].argmax(1) + lo
    return np.where(ac[np.arange(len(ac)), lag] >= voiced, rate / lag, np.nan)
