"""Manifests and stage tables: read with fixed schemas, written beside and then put in place."""

from __future__ import annotations

import json
import re
import tempfile
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

AUDIO = ("wav", "flac", "mp3", "ogg")


def is_audio(path):
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1)).isin(*AUDIO)


def clip_name(name):
    """struct(gender, speaker, take, kind) of a clip's file name; empty where it isn't one."""
    part = lambda k: F.regexp_extract(name, r"^([fm])(\d+)_(\d+)_([a-z]+)\.wav$", k)
    return F.struct(part(1).alias("gender"), part(2).alias("speaker"), part(3).alias("take"), part(4).alias("kind"))


def stem(path):
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """(id, path) of audio files; the content isn't read, as no column of it is used."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.where(is_audio(F.col("path"))).select(stem(F.col("path")).alias("id"), "path")


def transcripts(spark: SparkSession, folder: str) -> DataFrame:
    t = spark.read.option("wholetext", "true").option("pathGlobFilter", "*.txt").text(folder)
    return t.select(stem(F.input_file_name()).alias("id"), F.trim("value").alias("text"))


def paired(audio: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with both, and audio without a transcript."""
    rows = audio.join(texts, "id").select("id", F.col("path").alias("audio_filepath"), "text")
    return rows, audio.join(texts, "id", "left_anti")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(id, audio_filepath, text, extra) of JSON lines: other keys are carried as JSON text, relative paths lie beside the manifest."""
    base = path.rsplit("/", 1)[0] if "/" in path else "."

    def parse(batches):
        for pdf in batches:
            found = [json.loads(v) for v in pdf["value"] if v.strip()]
            yield pd.DataFrame({
                "audio_filepath": [x["audio_filepath"] for x in found], "text": [x["text"] for x in found],
                "extra": [json.dumps({k: v for k, v in x.items() if k not in ("audio_filepath", "text")}, ensure_ascii=False) for x in found],
            })

    rows = spark.read.text(path).mapInPandas(parse, "audio_filepath string, text string, extra string")
    full = F.when(F.col("audio_filepath").rlike(r"^(/|[a-z0-9]+:/)"), F.col("audio_filepath")).otherwise(F.concat(F.lit(base + "/"), "audio_filepath"))
    return rows.select(stem(F.col("audio_filepath")).alias("id"), full.alias("audio_filepath"), "text", "extra")


def present(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose recording exists, and the others. Tasks ask the storage; nothing is listed on the driver."""
    from lacuna.sources import audio

    def look(batches):
        for pdf in batches:
            yield pdf.assign(__there=[audio.stamp(p) is not None for p in pdf["audio_filepath"]])

    found = rows.mapInPandas(look, StructType([*rows.schema.fields, StructField("__there", BooleanType())]))
    return found.where("__there").drop("__there"), found.where("NOT __there").drop("__there")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share; a machine's own only where all run on it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.gettempdir()
    return f"{root.rstrip('/')}/lacuna-engine/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def read_stage(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stage table; empty where it doesn't exist yet. Damaged lines raise."""
    recover(spark, path)
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def _stage_paths(spark: SparkSession, path: str):
    """The file system and the places of a stage table, its successor and its predecessor."""
    places = [spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + end) for end in ("", ".new", ".old")]
    return places[0].getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), *places


def recover(spark: SparkSession, path: str) -> None:
    """Ends what a writer that was lost between two renames had begun: the whole new table takes its place, else the old one comes back."""
    fs, to, new, old = _stage_paths(spark, path)
    if not fs.exists(to) and fs.exists(old):
        whole = fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(new, "_SUCCESS"))
        fs.rename(new if whole else old, to)


def write_stage(df: DataFrame, path: str) -> None:
    """To a folder beside it, in the order of the first column, that then takes its place: a stage may read the table that it
    replaces. The old table is moved aside first and goes last, so that one of them is whole at any time."""
    spark = df.sparkSession
    recover(spark, path)
    fs, to, new, old = _stage_paths(spark, path)
    df.orderBy(df.columns[0]).write.mode("overwrite").option("ignoreNullFields", "false").json(new.toString())
    fs.delete(old, True)
    if fs.exists(to) and not fs.rename(to, old):
        raise OSError(f"{path} could not be moved aside")
    if not fs.rename(new, to):
        raise OSError(f"{new.toString()} could not take the place of {path}")
    fs.delete(old, True)


def exported(rows: DataFrame, source: DataFrame, base: str) -> DataFrame:
    """(audio_filepath, text, duration, extra): paths under base relative to it, extras of the source rows by id."""
    path = F.when(F.startswith("audio_filepath", F.lit(base + "/")), F.substr("audio_filepath", F.lit(len(base) + 2))).otherwise(F.col("audio_filepath"))
    extras = source.select("id", "extra").dropDuplicates(["id"])
    return rows.join(extras, "id", "left").select("id", path.alias("audio_filepath"), "text", F.bround("duration", 4).alias("duration"), "extra")


def write_manifest(rows: DataFrame, path: str) -> None:
    """JSON lines of audio_filepath, text, duration and the other keys as they came, in the order of ids."""

    def lines(batches):
        for pdf in batches:
            out = []
            for path_, text, seconds, extra in zip(pdf["audio_filepath"], pdf["text"], pdf["duration"], pdf["extra"]):
                row = {"audio_filepath": path_, "text": text, "duration": seconds}
                out.append(json.dumps({**(json.loads(extra) if extra else {}), **row}, ensure_ascii=False))
            yield pd.DataFrame({"value": out})

    rows.orderBy("id").mapInPandas(lines, "value string").write.mode("overwrite").text(path)
