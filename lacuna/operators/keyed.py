"""Resume, upsert and validity of tables keyed by an id."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def todo(rows: DataFrame, done: DataFrame, key: str = "id", force: bool = False) -> DataFrame:
    """Rows whose key no finished row has."""
    return rows if force else rows.join(done.select(key).distinct(), key, "left_anti")


def finished(rows: DataFrame, done: DataFrame, evidence: DataFrame, key: str = "id") -> DataFrame:
    """Rows that are finished and whose output still exists."""
    return rows.join(done.select(key).distinct(), key, "left_semi").join(evidence.select(key).distinct(), key, "left_semi")


def last_wins(rows: DataFrame, key: str, version: Column) -> DataFrame:
    """One row for each key: the one with the greatest version. A partial aggregate, no sort."""
    best = rows.groupBy(key).agg(F.max_by(F.struct("*"), version).alias("r"))
    return best.select("r.*")


def upsert(cached: DataFrame, fresh: DataFrame, key: str = "id") -> DataFrame:
    """Fresh rows, and cached ones of other keys; columns that one side lacks are null there."""
    return fresh.unionByName(cached.join(fresh.select(key), key, "left_anti"), allowMissingColumns=True)


def overlay(old: DataFrame, new: DataFrame, key: str, new_wins: bool = True) -> DataFrame:
    """old with new's columns by key; where both have one, new's value counts if new_wins, else old's, nulls yielding."""
    shared = [c for c in new.columns if c in old.columns and c != key]
    renamed = reduce(lambda d, c: d.withColumnRenamed(c, f"__{c}"), shared, new)
    j = old.join(renamed, key, "left")
    pick = {c: F.coalesce(*([f"__{c}", c] if new_wins else [c, f"__{c}"])) for c in shared}
    return j.withColumns(pick).drop(*[f"__{c}" for c in shared])


def cache_state(rows: DataFrame, cache: DataFrame, key: str, evidence: list[str], measures: list[str]) -> DataFrame:
    """rows with cache's measures where the evidence is the same, and `current`; missing measures are stale."""
    renamed = cache.select(key, *[F.col(c).alias(f"__{c}") for c in evidence], *measures)
    j = rows.join(renamed, key, "left")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in evidence[:-1]], F.lit(True))
    same = same & F.coalesce(F.col(evidence[-1]) == F.col(f"__{evidence[-1]}"), F.lit(False))
    kept = {m: F.when(same, F.col(m)) for m in measures}
    whole = reduce(lambda a, b: a & b, [F.col(m).isNotNull() for m in measures])
    return j.withColumns({**kept, "__same": same}).withColumn("current", F.col("__same") & whole).drop("__same", *[f"__{c}" for c in evidence])


def first_by(rows: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def others(values: Column, *known: str) -> Column:
    """A map without the keys that have columns of their own."""
    return F.map_filter(values, lambda k, _: ~k.isin(*known))


def latest_since(rows: DataFrame, group: str, item: str, changed: Column, start: Column, slack) -> DataFrame:
    """(group, item): what changed last in each group, of what changed since the start less the slack; the greatest item of equal ones."""
    return rows.where(changed >= start - slack).groupBy(group).agg(F.max_by(F.col(item), F.struct(changed.alias("c"), F.col(item))).alias(item))


def array_or_empty(rows: DataFrame, table: DataFrame, key: str, column: str) -> DataFrame:
    """rows with the table's array by key, empty where it has none."""
    j = rows.join(table.select(key, column), key, "left")
    return j.withColumn(column, F.coalesce(column, F.array().cast(table.schema[column].dataType)))
