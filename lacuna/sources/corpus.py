"""Archives of clips into a folder: tasks read an archive each, as a stream, and write its members beside their names."""

from __future__ import annotations

import tarfile
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from lacuna.sources import audio, manifest


def members(handle, kind: str, suffix: str):
    """(name without folders, content) of an archive's files that end so."""
    if kind == "zip":
        with zipfile.ZipFile(handle) as z:
            for info in z.infolist():
                if not info.is_dir() and info.filename.lower().endswith(suffix):
                    yield info.filename.rsplit("/", 1)[-1], z.read(info)
    else:
        with tarfile.open(fileobj=handle, mode="r|*") as t:
            for info in t:
                if info.isfile() and info.name.lower().endswith(suffix):
                    yield info.name.rsplit("/", 1)[-1], t.extractfile(info).read()


def unpack(spark: SparkSession, archives: str, folder: str, suffix: str = ".wav") -> DataFrame:
    """(archive, n, bytes, error) of the tar and zip files in a folder, whose members are in `folder` then.

    A member that is there in its whole size isn't written again, so that a run that was cut short can be repeated; an archive that can't be
    read has an error and what came before it. Only paths are dealt to tasks; one holds a member at a time."""
    paths = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(archives).select("path")
    paths = paths.where(F.lower("path").rlike(r"\.(zip|tar|tar\.gz|tgz)$"))

    def work(batches):
        for pdf in batches:
            rows = []
            for path in pdf["path"].tolist():
                n = size = 0
                error = None
                try:
                    store, where = audio._place(path)
                    kind = "zip" if path.lower().endswith(".zip") else "tar"
                    with store.open_input_file(where) if kind == "zip" else store.open_input_stream(where, compression=None) as handle:
                        for name, content in members(handle, kind, suffix):
                            to = f"{folder.rstrip('/')}/{name}"
                            if (audio.stamp(to) or (None,))[0] != len(content):
                                audio.write_bytes(to, content)
                            n, size = n + 1, size + len(content)
                except Exception as x:  # one bad archive must not stop the rest
                    error = f"{type(x).__name__}: {x}"[:300]
                rows.append((path, n, size, error))
            yield pd.DataFrame(rows, columns=["archive", "n", "bytes", "error"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return paths.repartition(parts, "path").mapInPandas(work, "archive string, n long, bytes long, error string")


def whole(spark: SparkSession, folder: str, expected: int) -> bool:
    """Whether a folder has as many recordings as it should: then nothing needs to be unpacked."""
    return manifest.exists(spark, folder) and manifest.listing(spark, folder).limit(expected).count() >= expected
