"""Pauses by silence, and upserts, as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lacuna.operators.keyed import last_wins


def sessions(events: DataFrame, key: str, ts: str, gap: str, late: str | None = None) -> DataFrame:
    """(key, n, first, last): runs of events with less than gap between them; a stream needs a watermark (late)."""
    rows = events.withWatermark(ts, late) if late else events
    out = rows.groupBy(key, F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("n"), F.min(ts).alias("first"), F.max(ts).alias("last"))
    return out.drop("w")


def sliding_levels(events: DataFrame, key: str, ts: str, value: str, win: str, hop: str, late: str | None = None) -> DataFrame:
    """(key, start, n, rms): root mean squares of values in sliding windows of time."""
    rows = events.withWatermark(ts, late) if late else events
    x = F.col(value)
    return rows.groupBy(key, F.window(ts, win, hop).alias("w")).agg(F.count("*").alias("n"), F.sqrt(F.avg(x * x)).alias("rms")).select(key, F.col("w.start").alias("start"), "n", "rms")


def upsert_stream(rows: DataFrame, path: str, key: str, version: str, checkpoint: str):
    """Each micro-batch leaves its own newest rows under path/batch=ID, and nothing else is rewritten; a batch that runs again gives the same rows."""

    def append(batch: DataFrame, batch_id: int) -> None:
        last_wins(batch, key, F.col(version)).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return rows.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)


def upserted(spark: SparkSession, path: str, key: str, version: str) -> DataFrame:
    """The table that upsert_stream's batches make: of each key the row of the last batch that had it, in it the newest version."""
    return last_wins(spark.read.parquet(path), key, F.struct("batch", version)).drop("batch")
