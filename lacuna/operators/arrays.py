"""Short signals as array columns, in SQL expressions: positions count from 0."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, functions as F


def doubles(a: Column) -> Column:
    return F.transform(a, lambda x: x.cast("double"))


def once(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x) with x evaluated once, not once for each place where f uses it."""
    return F.transform(F.array(x), f)[0]


def at(a: Column, i: Column) -> Column:
    return F.get(a, i.cast("int"))


def resampled(a: Column, old: int, new: int) -> Column:
    """By linear interpolation from one rate to another; the last value holds beyond the end."""

    def whole(a):
        n = F.greatest(F.rint(F.size(a) * (new / old)).cast("int"), F.lit(1))

        def value(i):
            place = F.least(i * (old / new), (F.size(a) - 1).cast("double"))
            low = F.floor(place)
            left, right = at(a, low), at(a, F.least(low + 1, F.size(a) - 1))
            return left + (place - low) * (right - left)

        return F.when(F.size(a) > 0, F.transform(F.sequence(F.lit(0), n - 1), value)).otherwise(a)

    return once(a, whole)


#: Rising from 0 to 1 at i of n values.
CURVES: dict[str, Callable[[Column, Column], Column]] = {
    "linear": lambda i, n: i / (n - 1),
    "cosine": lambda i, n: 0.5 * (1 - F.cos(math.pi * i / (n - 1))),
    # a decay of five time constants, moved and scaled so that it ends at exactly 0
    "exponential": lambda i, n: (F.exp(-5.0 * (n - 1 - i) / (n - 1)) - math.exp(-5.0)) / (1 - math.exp(-5.0)),
}


def faded(a: Column, n: Column, curve: str, head: bool = True, tail: bool = True) -> Column:
    """The first and last n values under a curve; arrays whose fade has fewer than two values stay."""
    size, rise = F.size(a), CURVES[curve]
    n = F.least(n, size)
    up = lambda i: F.when(i < n, rise(i, n)).otherwise(1.0)
    gain = lambda i: (up(i) if head else F.lit(1.0)) * (up(size - 1 - i) if tail else F.lit(1.0))
    return F.when(n < 2, a).otherwise(F.transform(a, lambda x, i: x * gain(i)))


def looped(tone: Column, n: Column, phase: Column) -> Column:
    """n values of the tone repeated from a phase (0-1), its last eighth blended over its first, so that no seam is heard."""

    def unit(tone):
        size = F.size(tone)
        seam = F.greatest(F.floor(size / 8), F.lit(1)).cast("int")
        ramp = lambda i: F.when(seam > 1, i / (seam - 1)).otherwise(0.0)
        blend = lambda i: at(tone, i) * ramp(i) + at(tone, size - seam + i) * (1 - ramp(i))
        return F.transform(F.sequence(F.lit(0), size - seam - 1), lambda i: F.when(i < seam, blend(i)).otherwise(at(tone, i)))

    loop = lambda u: F.transform(F.sequence(F.lit(0), n - 1), lambda i: at(u, (i + F.floor(phase * F.size(u))) % F.size(u)))
    return once(once(tone, unit), loop)


def peak(a: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(a, F.abs)), F.lit(0.0))


def rms(a: Column) -> Column:
    """0 of an empty array."""
    total = F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x)
    return F.when(F.size(a) > 0, F.sqrt(total / F.size(a))).otherwise(0.0)


def normalised(a: Column, to: float = 0.95) -> Column:
    """At a peak of `to`; silence stays silent."""
    return once(a, lambda a: once(peak(a), lambda top: F.transform(a, lambda x: x / (top + 1e-9) * to)))


def padded(a: Column, least: int) -> Column:
    """Zeros on both sides, equally many, up to `least` values or one fewer."""
    side = F.array_repeat(F.lit(0.0), F.greatest(F.floor((least - F.size(a)) / 2), F.lit(0)).cast("int"))
    return F.concat(side, a, side)


def quietest(a: Column, win: int) -> Column:
    """The window of win values with the least level, of those that start every half window; the first of equal ones."""

    def best(a):
        starts = F.sequence(F.lit(0), F.greatest(F.size(a) - win, F.lit(0)), F.lit(max(1, win // 2)))
        least = F.array_min(F.transform(starts, lambda s: F.struct(rms(F.slice(a, s + 1, win)).alias("level"), s.alias("start"))))
        return F.slice(a, least["start"] + 1, win)

    return once(a, best)


def gain(insert: Column, speech: Column, cut: Column, context: int, decibels: float, headroom: float = 1.5) -> Column:
    """What the insert is multiplied by: its level goes to that of the `context` values before the cut (of all the speech where those
    are silent), but its peak to the 99.9th percentile of all the speech times the headroom at most; 1 where either is silent."""
    start = F.greatest(cut - context, F.lit(0))
    before = rms(F.slice(speech, start + 1, cut - start))
    level = F.when(before > 0, before).otherwise(rms(speech))
    loud = F.array_sort(F.transform(speech, F.abs))
    place = (F.size(speech) - 1) * 0.999
    low = F.floor(place)
    high = at(loud, low) + (place - low) * (at(loud, F.least(low + 1, F.size(speech) - 1)) - at(loud, low))
    wanted = level / rms(insert) * 10 ** (decibels / 20)
    most = high * headroom / peak(insert)
    return F.when((rms(insert) <= 0) | (level <= 0), 1.0).when(high > 0, F.least(wanted, most)).otherwise(wanted)


def spliced(speech: Column, insert: Column, cut: Column, pads: tuple[Column, Column], fade: int, phase: Column, win: int) -> Column:
    """speech with the insert behind its first cut values, between two stretches of its own quietest window; all four edges decay."""
    edge, tone = F.lit(fade), quietest(speech, win)
    left, right = F.slice(speech, F.lit(1), cut), F.slice(speech, cut + 1, F.size(speech))
    gaps = [F.when(n > 0, looped(tone, n, phase)).otherwise(F.array().cast("array<double>")) for n in pads]
    return F.concat(faded(left, edge, "exponential", head=False), gaps[0], faded(insert, edge, "exponential"), gaps[1], faded(right, edge, "exponential", tail=False))


def active(edge: Column, side: Column, limit: float = 0.2) -> Column:
    """Whether there is sound right at a cut: the edge's level is more than a share of its side's."""
    return F.when(rms(side) > 0, rms(edge) / rms(side) > limit).otherwise(F.lit(False))


def adapted(speech: Column, insert: Column, cut: Column, fade: int, narrow: int, wide: int, phase: Column, win: int) -> Column:
    """The same, but only edges with sound at the cut fade, by a half cosine, and the gap behind such an edge is the wide one."""
    edge, tone = F.lit(fade), quietest(speech, win)
    left, right = F.slice(speech, F.lit(1), cut), F.slice(speech, cut + 1, F.size(speech))
    first, last = (lambda a: F.slice(a, F.lit(1), edge)), (lambda a: F.slice(a, F.greatest(F.size(a) - fade, F.lit(0)) + 1, edge))
    before, head, tail, after = active(last(left), left), active(first(insert), insert), active(last(insert), insert), active(first(right), right)
    gap = lambda busy: looped(tone, F.when(busy, wide).otherwise(narrow), phase)
    rise = once(F.when(head, faded(insert, edge, "cosine", tail=False)).otherwise(insert), lambda a: F.when(tail, faded(a, edge, "cosine", head=False)).otherwise(a))
    left = F.when(before, faded(left, edge, "cosine", head=False)).otherwise(left)
    right = F.when(after, faded(right, edge, "cosine", tail=False)).otherwise(right)
    return F.concat(left, gap(before), rise, gap(tail), right)
