"""Content-addressed payloads in tar shards.

A task writes the payloads it sees to a tar shard of its own in the shared folder, each content once in a shard, as
an 8-bit grey PNG of 576 samples a row named by its digest. Rows carry shard, digest, offset and
length; metadata columns come from a range read of the header alone, and payloads from a range read
of the member. A shard's name holds the attempt, and rows reach readers through Spark's committed index
table, so that a lost executor leaves an unread shard at worst.

Edge cases: null and empty texts are one row of 576 bytes 255; equal texts give equal values; null or repeated ids are
kept as they are; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import struct
import tarfile
import uuid
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from lacuna.llm.common import filesystem, shared_path, shuffle_parts, written

ROW = 576
SIGNATURE = b"\x89PNG\r\n\x1a\n"
HEADER_BYTES = 33
METADATA = ("width", "height", "depth")


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_png(payload: bytes, level: int = 2) -> bytes:
    """payload (a multiple of ROW bytes) as a grey 8-bit PNG."""
    height = len(payload) // ROW
    lines = np.zeros((height, ROW + 1), np.uint8)  # each line starts with filter 0
    lines[:, 1:] = np.frombuffer(payload, np.uint8).reshape(height, ROW)
    return SIGNATURE + _chunk(b"IHDR", struct.pack(">IIBBBBB", ROW, height, 8, 0, 0, 0, 0)) + _chunk(b"IDAT", zlib.compress(lines, level)) + _chunk(b"IEND", b"")


def read_header(head: bytes) -> dict:
    """Width, height and depth from a media object's first HEADER_BYTES."""
    if head[:8] != SIGNATURE or head[12:16] != b"IHDR":
        raise ValueError("not a media object of this store")
    width, height, depth = struct.unpack(">IIB", head[16:25])
    return {"width": width, "height": height, "depth": depth}


def decode_png(media: bytes) -> bytes:
    """The samples of encode_png's result; other PNG filters or kinds are refused."""
    head, at, data = read_header(media[:HEADER_BYTES]), 8, []
    while at < len(media):
        (n,) = struct.unpack(">I", media[at : at + 4])
        kind, body = media[at + 4 : at + 8], media[at + 8 : at + 8 + n]
        if struct.unpack(">I", media[at + 8 + n : at + 12 + n])[0] != zlib.crc32(kind + body):
            raise ValueError("damaged media object")
        data += [body] if kind == b"IDAT" else []
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(head["height"], head["width"] + 1)
    if lines[:, 0].any():
        raise ValueError("only filter 0 is written here")
    return lines[:, 1:].tobytes()


def padded(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode("utf-8")
    size = max(1, -(-len(raw) // ROW)) * ROW
    return len(raw), raw.ljust(size, b"\xff")


def features(payload: bytes, width: int, height: int) -> str:
    """Mean, deviation, entropy in bits and share of samples over 127, by the stored samples."""
    count = np.bincount(np.frombuffer(payload, np.uint8), minlength=256)
    p = count / count.sum()
    mean = float(p @ np.arange(256))
    spread = float(np.sqrt(max(0.0, p @ (np.arange(256) - mean) ** 2)))
    seen = p[p > 0]
    return f"{width}x{height};mean={mean:.4f};sd={spread:.4f};bits={float(-(seen * np.log2(seen)).sum()):.4f};high={float(p[128:].sum()):.4f}"


def store(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the shards when it runs; the index: doc_id, n_bytes, digest, shard, offset, length."""

    def write(batches):
        from pyspark import TaskContext

        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        shard = f"shard-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.tar"
        at, out, seen = 0, None, {}
        try:
            for pdf in batches:
                n_bytes, digests, places = [], [], []
                for text in pdf["text"].tolist():
                    n, payload = padded(text)
                    key = hashlib.sha256(payload).digest()
                    n_bytes.append(n)
                    digests.append(key.hex())
                    if key not in seen:
                        out = out or fs.open_output_stream(f"{root}/{shard}")
                        media = encode_png(payload)
                        info = tarfile.TarInfo(key.hex() + ".png")
                        info.size = len(media)
                        block = info.tobuf(tarfile.USTAR_FORMAT)
                        out.write(block + media + bytes(-len(media) % 512))
                        seen[key] = (at + len(block), len(media))
                        at += len(block) + len(media) + -len(media) % 512
                    places.append(seen[key])
                yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_bytes": n_bytes, "digest": digests, "shard": shard, "offset": [p[0] for p in places], "length": [p[1] for p in places]})
        finally:
            if out:
                out.write(bytes(1024))
                out.close()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(write, "doc_id long, n_bytes long, digest string, shard string, offset long, length long")


def spread(index: DataFrame) -> DataFrame:
    """The index dealt evenly in shard order, so that a task reads a run of few shards."""
    return index.repartitionByRange(shuffle_parts(index.sparkSession), "shard", "offset", F.xxhash64("doc_id")).sortWithinPartitions("shard", "offset")


def _ranges(folder: str, batches, size_of):
    """Batches with the bytes that size_of(length) asks for at each row's place."""
    fs, root = filesystem(folder)
    name, file, place, got = None, None, None, b""
    try:
        for pdf in batches:
            out = []
            for shard, offset, length in zip(pdf["shard"].tolist(), pdf["offset"].tolist(), pdf["length"].tolist()):
                if shard != name:
                    if file:
                        file.close()
                    file, name = fs.open_input_file(f"{root}/{shard}"), shard
                if (shard, offset) != place:
                    got, place = file.read_at(size_of(length), offset), (shard, offset)
                out.append(got)
            yield pdf, out
    finally:
        if file:
            file.close()


def headers(index: DataFrame, folder: str) -> DataFrame:
    """Metadata columns by header-only range reads: width, height, depth."""

    def read(batches):
        for pdf, heads in _ranges(folder, batches, lambda n: min(n, HEADER_BYTES)):
            found = [read_header(h) for h in heads]
            yield pdf.assign(**{k: [f[k] for f in found] for k in METADATA})

    return index.mapInPandas(read, StructType(index.schema.fields + [StructField(k, IntegerType()) for k in METADATA]))


def read_back(index: DataFrame, folder: str) -> DataFrame:
    """What the stored bytes hold: a row for each row of an index with headers, whose width and height the payload must have."""

    def read(batches):
        for pdf, media in _ranges(folder, batches, lambda n: n):
            rows, was, last = [], None, None
            for doc_id, n_bytes, digest, width, height, depth, m in zip(*(pdf[c].tolist() for c in ("doc_id", "n_bytes", "digest", "width", "height", "depth")), media):
                if m is not was:
                    payload = decode_png(m)
                    found = hashlib.sha256(payload).hexdigest()
                    if found != digest or len(payload) != width * height:
                        raise ValueError(f"stored bytes of {digest}, {width} x {height}, have {len(payload)} samples and digest {found}")
                    last, was = (len(payload), found, zlib.crc32(payload[-32:]), len(m), hashlib.sha256(m).hexdigest(), features(payload, width, height), width, height, depth), m
                rows.append((doc_id, n_bytes, *last))
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", *METADATA]).astype({"doc_id": "Int64"})

    return index.mapInPandas(read, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, width int, height int, depth int")


def media_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store all texts of docs, fill the metadata columns from the headers, then read the payloads back."""
    folder = shared_path(docs.sparkSession, "media")
    index = written(store(docs, folder, id_col, text_col), "media-index")
    return read_back(headers(spread(index), folder), folder)
