"""Jaccard self-join of documents on word n-grams by MinHash banding.

Documents with equal n-gram sets form a copy class. One signature of bands x rows minima is made for each class;
the least number of bands is taken that finds a pair at the threshold with the target
recall. Classes meet in a shuffle on band hashes; each bucket links its members to its least one, and
connected components of those links are the groups within which all pairs are verified on
their whole n-gram sets, in blocks of `block` classes, so that no group has to fit a task. Only counts and a spanning
forest leave a block: pairs are never listed.

Work within a group of near copies grows with the square of its distinct texts, as exact link counts require.

Edge cases: words are runs of 0-9, a-z (without case) and characters beyond ASCII; a text with fewer than n words has one
n-gram, of all its words; a null, empty or wordless text is linked to nothing and a class of its own; repeated rows are copies
and get equal class ids; ids may be null or repeated (a class id is the least id in the class, null if all are); an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lacuna.llm.common import MIX, maybe_broadcast, mix, shuffle_parts, tidied, words_of, written
from lacuna.llm.graph import components


def bands_for(threshold: float, recall: float, rows: int) -> int:
    """The fewest bands of rows minima that find a pair at the threshold with this recall."""
    miss = 1 - threshold**rows
    return max(1, math.ceil(math.log(1 - recall) / math.log(miss))) if miss > 0 else 1


class Shingler:
    """Sets of 64-bit hashes of the n-grams of words."""

    def __init__(self, n: int, keep: int = 150_000):
        self.n, self.keep, self.known = n, keep, {}
        self.odd = mix(np.arange(1, n + 1, dtype=np.uint64) * MIX) | np.uint64(1)

    def __call__(self, text: str | None) -> np.ndarray:
        words = words_of(text)
        known = self.known
        try:
            h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            if len(known) > self.keep:
                known.clear()
            known.update([(w, xxhash.xxh3_64_intdigest(w)) for w in {*words} if w not in known])
            h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if not len(h):
            return h
        k = min(self.n, len(h))
        out = np.full(len(h) - k + 1, k, np.uint64)
        for i in range(k):
            out += h[i : i + len(out)] * self.odd[i]
            out ^= out >> np.uint64(29)
            out *= MIX
        return np.unique(mix(out))


def band_hashes(shingles: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit hash for each band, in which the band's number is mixed."""
    a = (mix(np.arange(1, bands * rows + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    x = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    least = np.full(bands * rows, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), 512):
        y = a[:, None] * x[None, k : k + 512]
        y ^= y >> np.uint32(15)
        np.minimum(least, y.min(1), out=least)
    out = np.arange(1, bands + 1, dtype=np.uint64) * MIX
    for col in least.reshape(bands, rows).T:
        out = mix(out ^ col.astype(np.uint64)) + MIX
    return out.view(np.int64)


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """doc_id, set_id (16 bytes, null without words), bands, and digest where docs has it."""
    more = [c for c in docs.columns if c == "digest"]

    @tidied
    def sign(batches):
        shingler = Shingler(n)
        for pdf in batches:
            ids, found = [], []
            for text in pdf["text"].tolist():
                s = shingler(text)
                ids.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                found.append(band_hashes(s, bands, rows) if len(s) else None)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "set_id": ids, "bands": found} | {c: pdf[c] for c in more})

    return docs.mapInPandas(sign, ", ".join(["doc_id long, set_id binary, bands array<long>", *[f"{c} binary" for c in more]]))


def runs(batches, keys: list[str]):
    """Whole groups of a stream that is sorted by keys."""
    rest = None
    for pdf in batches:
        if not len(pdf):
            continue
        pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        k = pdf[keys]
        start = np.flatnonzero((k != k.shift()).any(axis=1).to_numpy())
        for a, b in zip(start[:-1].tolist(), start[1:].tolist()):
            yield pdf.iloc[a:b]
        rest = pdf.iloc[start[-1] :]
    if rest is not None:
        yield rest


def similar(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of sets have a Jaccard similarity of the threshold or more; the diagonal is False."""
    k = len(sets)
    size = np.array([len(s) for s in sets])
    both = np.zeros((k, k), np.int64)
    if k <= 4:
        for i in range(k):
            for j in range(i):
                both[i, j] = both[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
    else:
        _, at = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(k), size)
        often = np.bincount(at)
        shared = often[at] > 1  # an n-gram of one set alone adds to no pair
        at, owner = at[shared], owner[shared]
        _, at = np.unique(at, return_inverse=True)
        order = np.argsort(at, kind="stable")
        at, owner = at[order], owner[order]
        width = 4096
        for lo in range(0, int(at[-1]) + 1 if len(at) else 0, width):
            a, b = np.searchsorted(at, [lo, lo + width])
            m = np.zeros((k, width), np.float32)
            m[owner[a:b], at[a:b] - lo] = 1
            both += (m @ m.T).astype(np.int64)
    # |both| >= t * |either| without a rounded quotient: within 1e-9 counts as equal
    out = both + 1e-9 >= threshold * (size[:, None] + size[None] - both)
    np.fill_diagonal(out, False)
    return out


def links(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9995, rows: int = 5, block: int = 256, small_rows: int = 500_000) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of docs (doc_id, text and, to tell rows with equal ids apart, digest): signatures of all, (set_id, n_links) and a spanning forest (u, v) of the linked classes."""
    bands = bands_for(threshold, recall, rows)
    signed = written(signatures(docs, n, bands, rows), "signatures")
    told = "digest" in docs.columns
    rep = F.min(F.struct("digest", "doc_id")) if told else F.min("doc_id")
    classes = signed.where("set_id is not null").groupBy("set_id").agg(rep.alias("rep"), F.first("bands").alias("bands"))
    classes = written(classes, "classes")
    by_band = classes.select("set_id", F.explode("bands").alias("band"))
    buckets = by_band.groupBy("band").agg(F.count("*").alias("n"), F.min("set_id").alias("hub")).where("n > 1").drop("n")
    near = by_band.join(buckets, "band").where("set_id <> hub").select(F.col("set_id").alias("u"), F.col("hub").alias("v")).distinct()
    groups = written(components(near), "groups")
    sizes = groups.groupBy("component").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    members = groups.join(sizes, "component").withColumnRenamed("node", "set_id").join(classes.select("set_id", "rep"), "set_id")
    members = written(members, "members")
    wanted = maybe_broadcast(members.withColumnRenamed("set_id", "wanted"), small_rows)
    at = docs["doc_id"].eqNullSafe(wanted["rep"]["doc_id"]) & (docs["digest"] == wanted["rep"]["digest"]) if told else docs["doc_id"].eqNullSafe(wanted["rep"])
    texts = docs.join(wanted, at).select("text", "wanted", "component", "blocks")

    @tidied
    def sets(batches):
        shingler = Shingler(n)
        for pdf in batches:
            found = [shingler(t) for t in pdf["text"].tolist()]
            mine = [len(s) > 0 and xxhash.xxh3_128_digest(s.tobytes()) == w for s, w in zip(found, pdf["wanted"].tolist())]
            yield pd.DataFrame({"set_id": pdf["wanted"], "component": pdf["component"], "blocks": pdf["blocks"], "grams": [s.tobytes() for s in found]})[mine]

    full = texts.mapInPandas(sets, "set_id binary, component binary, blocks int, grams binary")
    own = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
    dealt = full.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("a", F.least("own", "other")).withColumn("b", F.greatest("own", "other")).drop("other", "blocks")
    parts = shuffle_parts(docs.sparkSession)
    dealt = dealt.repartition(parts, "component", "a", "b").sortWithinPartitions("component", "a", "b", "set_id")

    @tidied
    def verify(batches):
        out = []
        for g in runs(batches, ["component", "a", "b"]):
            g = g[~g["set_id"].duplicated().to_numpy()]
            if len(g) < 2:
                continue
            ids = g["set_id"].tolist()
            ok = similar([np.frombuffer(x, np.uint64) for x in g["grams"].tolist()], threshold)
            if g["a"].iloc[0] != g["b"].iloc[0]:
                own = g["own"].to_numpy()
                ok &= own[:, None] != own[None]
            label = np.arange(len(ids))
            while True:
                new = np.minimum(label, np.where(ok, label[None], len(ids)).min(1))
                new = np.minimum(new, new[new])
                if (new == label).all():
                    break
                label = new
            out += [(ids[i], c, ids[label[i]]) for i, c in enumerate(ok.sum(1).tolist()) if c]
            if len(out) > 20_000:
                yield pd.DataFrame(out, columns=["set_id", "n", "root"])
                out = []
        yield pd.DataFrame(out, columns=["set_id", "n", "root"])

    found = written(dealt.mapInPandas(verify, "set_id binary, n long, root binary"), "links")
    return signed, found.groupBy("set_id").agg(F.sum("n").alias("n_links")), found.select(F.col("set_id").alias("u"), F.col("root").alias("v"))


def text_digest(text: Column) -> Column:
    """128 bits of a text; a null one's are none."""
    return F.coalesce(F.unhex(F.md5(text)), F.lit(b""))


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """(doc_id, digest, n, gone) of the rows that can't all stay: n rows are equal in id and text, and all of them go, or else all but one.

    Of each group that links and copies connect one row stays: with the least id (null is the last) and of equal ids the least
    text_digest. Rows without words are linked to nothing."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), text_digest(F.col(text_col)).alias("digest"))
    signed, _, forest = links(rows, **more)
    groups = written(components(forest), "link-groups")
    known = written(signed.groupBy("doc_id", "digest").agg(F.first("set_id").alias("set_id"), F.count("*").alias("n")), "rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest")).alias("p")
    sets = known.where("set_id is not null").groupBy("set_id").agg(first)
    heads = sets.join(groups.withColumnRenamed("node", "set_id"), "set_id", "left").groupBy(F.coalesce("component", "set_id").alias("group")).agg(F.min("p").alias("p"))
    heads = heads.select(F.col("p.doc_id").alias("head_id"), F.col("p.digest").alias("head_digest"))
    marked = known.join(heads, known["doc_id"].eqNullSafe(heads["head_id"]) & (known["digest"] == heads["head_digest"]), "left")
    return marked.select("doc_id", "digest", "n", (F.col("set_id").isNotNull() & F.col("head_digest").isNull()).alias("gone")).where("gone or n > 1")


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """doc_id, class_id (the least id of all that links and copies connect), copy_id (the least id of equal n-gram sets), n_links (other n-gram sets at the threshold)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed, counts, forest = links(rows, **more)
    groups = written(components(forest), "link-groups")
    reps = signed.where("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("copy_id"))
    known = reps.join(groups.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    heads = known.groupBy("component").agg(F.min("copy_id").alias("class_id"))
    table = written(known.join(heads, "component").join(counts, "set_id", "left").select("set_id", "class_id", "copy_id", F.coalesce("n_links", F.lit(0)).alias("n_links")), "classes")
    out = signed.drop("bands").join(table, "set_id", "left")
    alone = F.col("set_id").isNull()
    return out.select("doc_id", *[F.when(alone, F.col("doc_id")).otherwise(F.col(c)).alias(c) for c in ("class_id", "copy_id")], F.coalesce("n_links", F.lit(0)).alias("n_links"))
