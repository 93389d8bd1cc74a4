"""Explainable thresholds: reasons as codes, passing as an empty list."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def reasons(rules: dict[str, Column]) -> Column:
    """Names of the rules that hold; a rule that is null isn't checked."""
    return F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))


def floor_rule(value: Column, least: float | None) -> Column:
    return F.lit(None).cast("boolean") if least is None else value < least


def drop_rule(source: Column, value: Column, most: float | None) -> Column:
    return F.lit(None).cast("boolean") if most is None else source - value > most


def boundary_rule(before: Column, after: Column, limit: float | None) -> Column:
    return F.lit(None).cast("boolean") if limit is None else F.greatest(before, after) > limit


def usable(peak: Column, duration: Column) -> Column:
    """Clips loud and long enough to be heard; both limits are strict."""
    return (peak > 0.05) & (duration > 0.35)


def not_better(converted: Column, baseline: Column) -> Column:
    """The warning that a converted voice is no more like the speaker than the unconverted one; null scores don't warn."""
    return F.coalesce(converted <= baseline, F.lit(False))


def side(before: Column, after: Column) -> Column:
    return F.when(before >= after, "before").otherwise("after")


def cosine(a: Column, b: Column) -> Column:
    """Of two arrays of equal length; 0 if one has no length."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm).otherwise(0.0)


def gap_budget(pause: Column, scale: float, shape: Column, existing: Column, rate: int) -> Column:
    """Samples of silence still to add: what the pause is scaled to, less what is there; cut towards zero, never negative."""
    return F.greatest(F.lit(0), ((pause * scale * shape - existing) * rate).cast("long"))


def over_cap(seconds: Column, most: float = 150.0) -> Column:
    """Recordings longer than a model takes."""
    return seconds > most
