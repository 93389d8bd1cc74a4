"""Removal of repeated byte strings by suffix arrays over shards of the corpus.

A byte goes if a string of `length` bytes that covers it also starts elsewhere. The corpus is sharded by content: of the
hashes of all 64-byte strings in a window of `length` bytes the least is an anchor, so that equal windows have the same anchor
at the same place wherever they are. An anchor's context is what the windows around it cover (at most 2 * length - 64
bytes). Equal contexts are counted, not kept: a context that occurs twice is covered as a whole. An anchor with several contexts
is a group, and shards take whole groups: one suffix array of all their distinct contexts, without the ends that no other context of
the group shares, by induced sorting (by the first `length` bytes), permuted common prefixes cut at `length`, and from these the classes of equal windows; a window is repeated if its class holds the
same place of another context of its group.

A group of more than `most` distinct contexts (a passage with other surroundings each time) would not fit a shard. Its windows are
counted by hash instead, in blocks of 16 windows first: a block that occurs twice is repeated as a whole, one whose
common core occurs once holds no repeat, and only windows of the rest are counted one by one.

Edge cases: a null or empty text has 0 bytes, nothing is removed, and its digest is that of no bytes; texts shorter than `length` stay; equal
texts repeat each other whole; ids may be null or repeated (texts are told apart by content); an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from lacuna.llm.common import MIX, mix, shuffle_parts, tidy, written
from lacuna.llm.ngram_join import runs
from lacuna.llm.suffix import repeat_classes

GRAM = 64
STEP = 16
CHUNK = 1 << 20
BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64) * MIX)


def raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def anchors(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the anchors of all windows of `length` bytes."""
    places, hashes = [], []
    for at in range(0, max(1, len(data) - length + 1), CHUNK):
        part = np.frombuffer(data, np.uint8)[at : at + CHUNK + length - 1]
        if len(part) < length:
            continue
        h, width = BYTE_HASH[part], 1
        while width < GRAM:
            h = h[:-width] * (BYTE_HASH[width] | np.uint64(1)) + h[width:]
            width *= 2
        h = mix(h)
        # the hash's high bits decide, then the rightmost place: its low bits count down
        bits = np.uint64((1 << 23) - 1)
        key = (h & ~bits) | (bits - np.arange(len(h), dtype=np.uint64))
        span, least, width = length - GRAM + 1, key, 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
        least = least[np.concatenate([[True], least[1:] != least[:-1]])]
        place = np.unique((bits - (least & bits)).astype(np.int64))
        places.append(place + at)
        hashes.append(h[place])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    place, first = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(hashes)[first]


def bounds(place, size, length):
    """The context around an anchor."""
    return max(0, place - (length - GRAM)), min(size, place + length)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def window_spans(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Merged spans of windows at sorted starts."""
    if not len(starts):
        return []
    new = np.flatnonzero(np.concatenate([[True], np.diff(starts) > length]))
    return [(int(starts[a]), int(starts[b]) + length) for a, b in zip(new, np.append(new[1:], len(starts)) - 1)]


def repeated_windows(contexts: list[tuple[int, bytes, int, int]], length: int) -> list[np.ndarray]:
    """Of contexts (group, bytes, anchor's place in them, how often), all distinct within a group: starts of repeated windows."""
    data = b"\xff".join(c[1] for c in contexts) + b"\xff"
    sizes = np.array([len(c[1]) for c in contexts])
    begin = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    anchor = np.array([c[2] for c in contexts])
    group = np.array([c[0] for c in contexts])
    often = np.array([c[3] > 1 for c in contexts])
    classes = repeat_classes(data, length)
    # windows that hold their context's anchor
    first = np.maximum(0, anchor + GRAM - length)
    last = np.minimum(anchor, sizes - length)
    n = np.maximum(0, last - first + 1)
    owner = np.repeat(np.arange(len(contexts)), n)
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[owner]
    kind = classes[begin[owner] + start]
    found = often[owner]
    some = np.flatnonzero((np.bincount(kind) > 1)[kind]) if len(kind) else np.zeros(0, np.int64)
    # equal windows of one group at one place from the anchor: class and group number below 2**26, place below 2**11
    key = (kind[some] << 37 | group[owner[some]] << 11 | (start - anchor[owner])[some] + length) if len(some) else some
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if len(some):
        found[some[order]] |= np.concatenate([[False], same]) | np.concatenate([same, [False]])
    edges = np.concatenate([[0], np.cumsum(n)])
    return [start[a:b][found[a:b]] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]


def shared(parts: list[bytes]) -> list[int]:
    """For each of parts, the bytes at its beginning that it has in common with one of the others, at most."""
    out, order = [0] * len(parts), sorted(range(len(parts)), key=parts.__getitem__)
    for i, j in zip(order, order[1:]):  # in order, neighbours have most in common
        n = min(len(parts[i]), len(parts[j]))
        differ = int.from_bytes(parts[i][:n], "little") ^ int.from_bytes(parts[j][:n], "little")
        if differ:
            n = (differ & -differ).bit_length() - 1 >> 3
        out[i], out[j] = max(out[i], n), n
    return out


def trimmed(contexts: list[bytes], at: list[int], length: int) -> list[tuple[int, bytes]]:
    """(anchor's place, bytes) of a group's contexts without the ends that none of the others shares; no bytes where no window is left."""
    lefts = shared([c[:a][::-1] for c, a in zip(contexts, at)])
    rights = shared([c[a + GRAM :] for c, a in zip(contexts, at)])
    return [(n, c[a - n : a + GRAM + m]) if n + GRAM + m >= length else (0, b"") for c, a, n, m in zip(contexts, at, lefts, rights)]


SPANS = "array<struct<lo:int,hi:int>>"


def _shards(contexts: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """(ahash, chash, spans) of contexts (ahash, chash, at, bytes): repeated spans relative to the anchor."""

    def sort(batches):
        tidy("repeats")
        held, size, group = [], 0, 0
        for g in runs(batches, ["ahash"]):
            a, kinds = g["ahash"].iat[0], dict(zip(g["chash"].tolist(), zip(g["bytes"].tolist(), g["at"].tolist())))
            if len(kinds) < 2:
                continue
            group += 1
            # what is left of several contexts can be equal; it is counted, and sorted once
            left: dict[tuple[int, bytes], list[int]] = {}
            for c, (at, b) in zip(kinds, trimmed(*map(list, zip(*kinds.values())), length)):
                if b:
                    left.setdefault((at, b), []).append(c)
            for (at, b), those in left.items():
                held.append((group, b, at, a, those))
                size += len(b)
            if size >= shard_bytes:
                yield done(held)
                held, size, group = [], 0, 0
        if held:
            yield done(held)

    def done(held):
        found = repeated_windows([(*h[:3], len(h[4])) for h in held], length)
        rows = [(h[3], c, [(a - h[2], b - h[2]) for a, b in window_spans(f, length)]) for h, f in zip(held, found) if len(f) for c in h[4]]
        return pd.DataFrame(rows, columns=["ahash", "chash", "spans"])

    dealt = contexts.repartition(shuffle_parts(contexts.sparkSession), "ahash").sortWithinPartitions("ahash", "chash")
    return dealt.mapInPandas(sort, f"ahash long, chash long, spans {SPANS}")


def _counted(contexts: DataFrame, length: int) -> DataFrame:
    """The same for groups of any size, by counts of hashes."""

    def windows(at, size):
        return max(0, at + GRAM - length), min(at, size - length)

    def blocks(batches):
        tidy("repeats")
        for pdf in batches:
            rows = []
            for a, c, at, data in zip(pdf["ahash"].tolist(), pdf["chash"].tolist(), pdf["at"].tolist(), pdf["bytes"].tolist()):
                lo, hi = windows(at, len(data))
                for j in range((lo - at) // STEP, (hi - at) // STEP + 1):
                    x, y = max(lo, at + j * STEP), min(hi, at + j * STEP + STEP - 1)
                    core = data[at + j * STEP + STEP - 1 : at + j * STEP + length]  # what all windows of the whole block share
                    rows.append((a, c, j, x - at, y - at, xxhash.xxh3_64_intdigest(data[x : y + length]) - (1 << 63), xxhash.xxh3_64_intdigest(core) - (1 << 63)))
            yield pd.DataFrame(rows, columns=["ahash", "chash", "j", "x", "y", "whole", "core"])

    found = written(contexts.mapInPandas(blocks, "ahash long, chash long, j int, x int, y int, whole long, core long"), "blocks")
    twice = lambda df, *keys: df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    whole = found.groupBy("ahash", "x", "y", "whole").agg(F.count("*").alias("n"), F.min("chash").alias("head")).where("n > 1").drop("n")
    core = twice(found, "ahash", "j", "core").withColumn("some", F.lit(True))
    state = found.join(whole, ["ahash", "x", "y", "whole"], "left").join(core, ["ahash", "j", "core"], "left")
    state = written(state.select("ahash", "chash", "x", "y", "head", "some"), "block-states")
    sure = state.where("head is not null").select("ahash", "chash", F.struct(F.col("x").alias("lo"), (F.col("y") + length).alias("hi")).alias("span"))
    # one of each kind of equal blocks stands for the others: a window of an open block may be one of theirs
    open_ = state.where("some and (head is null or head = chash)").groupBy("ahash", "chash").agg(F.collect_list(F.struct("x", "y")).alias("open"))
    rest = contexts.join(open_, ["ahash", "chash"])

    def single(batches):
        tidy("repeats")
        for pdf in batches:
            rows = []
            for a, c, at, data, spans in zip(pdf["ahash"].tolist(), pdf["chash"].tolist(), pdf["at"].tolist(), pdf["bytes"].tolist(), pdf["open"].tolist()):
                for s in spans:
                    rows += [(a, c, k, xxhash.xxh3_64_intdigest(data[at + k : at + k + length]) - (1 << 63)) for k in range(s["x"], s["y"] + 1)]
            yield pd.DataFrame(rows, columns=["ahash", "chash", "k", "h"])

    one = written(rest.mapInPandas(single, "ahash long, chash long, k int, h long"), "windows")
    again = one.join(twice(one, "ahash", "k", "h"), ["ahash", "k", "h"]).select("ahash", "chash", F.struct(F.col("k").alias("lo"), (F.col("k") + length).alias("hi")).alias("span"))
    return sure.union(again).groupBy("ahash", "chash").agg(F.collect_list("span").alias("spans"))


def repeated_spans(texts: DataFrame, length: int = 400, most: int = 1500, shard_bytes: int = 1 << 21) -> DataFrame:
    """Of texts (k1, k2, text), where (k1, k2) tells texts apart: (k1, k2, spans) of those with repeats."""
    if not GRAM <= length <= 1000:
        raise ValueError(f"length must be from {GRAM} to 1000")

    def mark(batches):
        tidy("repeats")
        for pdf in batches:
            for k in range(0, len(pdf), 2000):
                part = pdf.iloc[k : k + 2000]
                row, place, ahash, chash = [], [], [], []
                for i, text in enumerate(part["text"].tolist()):
                    data = raw(text)
                    if len(data) < length:
                        continue
                    at, h = anchors(data, length)
                    n, view = len(data), memoryview(data)
                    row.append(np.full(len(at), i))
                    place.append(at)
                    ahash.append(h.view(np.int64))
                    for p in at.tolist():
                        a, b = bounds(p, n, length)
                        # the anchor's place in the context is part of what tells contexts apart
                        chash.append(xxhash.xxh3_64_intdigest(view[a:b], seed=p - a))
                if row:
                    row = np.concatenate(row)
                    yield pd.DataFrame({"k1": part["k1"].to_numpy()[row], "k2": part["k2"].to_numpy()[row], "place": np.concatenate(place), "ahash": np.concatenate(ahash), "chash": np.array(chash, np.uint64).view(np.int64)})

    found = written(texts.mapInPandas(mark, "k1 long, k2 long, place long, ahash long, chash long"), "anchors")
    contexts = found.groupBy("ahash", "chash").agg(F.count("*").alias("n"), F.min(F.struct("k1", "k2", "place")).alias("at"))
    groups = contexts.groupBy("ahash").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).where("total > 1").drop("total")
    contexts = written(contexts.join(groups, "ahash"), "contexts")
    covered = contexts.where("n > 1").select("ahash", "chash", F.lit(None).cast(SPANS).alias("spans"))

    # a context that occurs more than once is covered already, but others of its group may share windows with it
    open_ = contexts.where("kinds > 1").select("ahash", "chash", "n", "kinds", "at.*")
    wanted = open_.groupBy("k1", "k2").agg(F.collect_list(F.struct("place", "ahash", "chash", (F.col("kinds") > most).alias("many"))).alias("wanted"))
    wanted = written(wanted, "wanted")
    rows = texts.join(wanted, ["k1", "k2"])
    rows = rows.groupBy("k1", "k2").agg(F.first("text").alias("text"), F.first("wanted").alias("wanted"))

    def cut(batches):
        tidy("repeats")
        for pdf in batches:
            out = []
            for text, want in zip(pdf["text"].tolist(), pdf["wanted"].tolist()):
                data = raw(text)
                for w in want:
                    a, b = bounds(w["place"], len(data), length)
                    out.append((w["ahash"], w["chash"], w["many"], w["place"] - a, data[a:b]))
                    if len(out) == 5000:  # a long text has many
                        yield pd.DataFrame(out, columns=["ahash", "chash", "many", "at", "bytes"])
                        out = []
            yield pd.DataFrame(out, columns=["ahash", "chash", "many", "at", "bytes"])

    pieces = written(rows.mapInPandas(cut, "ahash long, chash long, many boolean, at int, bytes binary"), "pieces")
    marks = covered.union(_shards(pieces.where("not many"), length, shard_bytes))
    many = pieces.where("many").drop("many")
    if not many.isEmpty():
        marks = marks.union(_counted(many, length))
    # a null span stands for the whole context; it wins
    marks = written(marks.groupBy("ahash", "chash").agg(F.max(F.col("spans").isNull()).alias("all"), F.flatten(F.collect_list("spans")).alias("spans")), "marks")
    reach = F.array(F.struct(F.lit(GRAM - length).alias("lo"), F.lit(length).alias("hi")))
    # the context's ends are the text's ends there, so that reaching over them is cut off later
    hits = found.join(marks, ["ahash", "chash"]).select("k1", "k2", F.explode(F.when(F.col("all"), reach).otherwise(F.col("spans"))).alias("s"), "place")
    hits = hits.select("k1", "k2", F.struct((F.col("place") + F.col("s.lo")).alias("lo"), (F.col("place") + F.col("s.hi")).alias("hi")).alias("s"))
    return hits.groupBy("k1", "k2").agg(F.collect_set("s").alias("spans"))


def dedupe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, **more) -> DataFrame:
    """doc_id, n_bytes, kept (bytes without repeats), spans (removed, of bytes) of all docs."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"))
    spans = written(repeated_spans(rows.select("k1", "k2", "text"), length, **more), "spans")

    def keep(batches):
        tidy("repeats")
        for pdf in batches:
            n, kept, removed = [], [], []
            for t, s in zip(pdf["text"].tolist(), pdf["spans"].tolist()):
                data = raw(t)
                gone = merged([(max(0, x["lo"]), min(len(data), x["hi"])) for x in s]) if s is not None else []
                at, left = 0, []
                for a, b in gone:
                    left.append(data[at:a])
                    at = b
                n.append(len(data))
                kept.append(b"".join([*left, data[at:]]))
                removed.append(gone)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy(), "n_bytes": n, "kept": kept, "spans": removed})

    joined = rows.join(spans, ["k1", "k2"], "left").select("doc_id", "text", "spans")
    return joined.mapInPandas(keep, "doc_id long, n_bytes long, kept binary, spans array<struct<lo:long,hi:long>>")


def digests(output: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and text: what is left (U+FFFD for a character of which only a part is)."""
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["hi"] - x["lo"])
    return output.select("doc_id", "n_bytes", size.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


__all__ = ["anchors", "dedupe", "digests", "repeated_spans"]
