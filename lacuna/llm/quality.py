"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is over pairs of words (words as in common.words_of; a text's first word follows an edge). Counts
live in shards: each task counts chunks of its texts, and what it found goes in one packed row a shard to the task that
has the shard. Training shards by a pair's first word, which gives the totals, discounts and back-off
weights of histories, and then by its second word, which gives the continuation counts. Scoring sends
a chunk's distinct pairs, and which of its documents have them how often, to the shards of the second words; what comes back is
a sum for each document. Neither the model nor a list of words is ever held whole by a task or the driver: what is
gathered grows with the input. Words are sent as 44-bit hashes (of 10**10 different words one in 1,800 shares its hash with another), but for up to 65,533
frequent trusted ones, which have short codes that all tasks know; which words those are changes the size of the rows, not the result.
Sums travel in units of 2**-12, so that they don't depend on their order.

The trusted texts fall into two folds by their own hash, and a document of one fold, trusted or not, is judged by
the model of the other: no document is judged by counts of its own or of its exact copies, so that thresholds from
trusted documents hold for others. Where one fold has no words, all trusted text judges all documents. A document is kept if its perplexity is at most
the `quantile` of its language's trusted documents.

Edge cases: texts that are null, empty or without words have perplexity null and are not kept; a null language is a
language of its own; a language without trusted documents takes the threshold of all of them; without any trusted
words all rows with text are kept (there is nothing to judge them by); repeated rows get equal
results; ids that are null aren't trusted; columns other than the id, text and language are ignored. The two passes over docs must
see the same rows, and a task that is run again the same partition, as tables that are read from storage do.
"""

from __future__ import annotations

import pickle
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lacuna.llm.common import discard, maybe_broadcast, mix, shuffle_parts, tidied, words_of, written

#: Codes of what is no word: the edge before a text, and the marks of corrections to a document's sum.
EDGE, TAIL, HEAD = 0, 1, 2
FREQUENT = 65_533
#: Bits of a word's hash.
BITS = 44
#: Parts of one in which sums are counted.
PARTS = 4096
CODEC = pa.Codec("zstd", compression_level=6)
#: Words and documents of a chunk at most, unless one text alone is longer.
CHUNK_WORDS, CHUNK_DOCS = 5_000_000, 65_536
PACKED = "shard int, kind int, chunk long, units int, split int, data binary"


def planes(x: np.ndarray) -> bytes:
    """Bytes of equal weight together."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes; whole numbers in as few bytes as the largest needs. Where that is more than two, those of up to two bytes are apart, and a bit each says which they are. Other numbers stay as they are: they repeat as a whole."""
    head, body = [], []
    for x in arrays:
        if x.dtype.kind == "f":
            head.append((x.dtype.str, len(x), None))
            body.append(x.tobytes())
            continue
        x = x.astype(np.min_scalar_type(int(x.max())) if len(x) else np.uint8)
        if x.itemsize > 2:
            wide = x > 0xFFFF
            head.append((x.dtype.str, len(x), int(wide.sum())))
            body += [np.packbits(wide).tobytes(), planes(x[~wide].astype(np.uint16)), planes(x[wide])]
        else:
            head.append((x.dtype.str, len(x), None))
            body.append(planes(x))
    raw = b"".join(body)
    return pickle.dumps((head, len(raw), CODEC.compress(raw, asbytes=True)))


def unsqueeze(data: bytes) -> list[np.ndarray]:
    head, size, packed = pickle.loads(data)
    raw, at, out = np.frombuffer(CODEC.decompress(packed, size, asbytes=True), np.uint8), 0, []

    def take(dtype, n):
        nonlocal at
        part = raw[at : at + n * dtype.itemsize]
        at += len(part)
        return part.copy().view(dtype) if dtype.kind == "f" else np.ascontiguousarray(part.reshape(dtype.itemsize, n).T).reshape(-1).view(dtype)

    for kind, n, n_wide in head:
        dtype = np.dtype(kind)
        if n_wide is None:
            x = take(dtype, n)
        else:
            wide = np.unpackbits(take(np.dtype(np.uint8), -(-n // 8)), count=n).astype(bool)
            x = np.empty(n, dtype)
            x[~wide] = take(np.dtype(np.uint16), n - n_wide)
            x[wide] = take(dtype, n_wide)
        out.append(x if dtype.kind == "f" else x.astype(np.uint64))
    return out


def starts(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.append(True, x[1:] != x[:-1])) if len(x) else np.zeros(0, np.int64)


def lengths(begin: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(begin, n))


def steps(x: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Differences within runs that begin at the given places, where the values themselves stand."""
    x = x.astype(np.uint64, copy=False)
    out = np.diff(x, prepend=x[:1])
    out[begin] = x[begin]
    return out


def unstepped(step: np.ndarray, begin: np.ndarray) -> np.ndarray:
    run = np.cumsum(step)
    return run - np.repeat(run[begin] - step[begin], lengths(begin, len(step)))


def put_pairs(a: np.ndarray, b: np.ndarray, *more: np.ndarray) -> bytes:
    """Pairs of codes in order, with further arrays."""
    g = starts(a)
    return squeeze(np.diff(a[g], prepend=np.uint64(0)), lengths(g, len(a)), steps(b, g), *more)


def get_pairs(data: bytes) -> list[np.ndarray]:
    firsts, n, step, *more = unsqueeze(data)
    n = n.astype(np.int64)
    return [np.repeat(np.cumsum(firsts), n), unstepped(step, np.cumsum(n) - n), *more]


def shards_of(codes: np.ndarray, shards: int) -> np.ndarray:
    return (mix(codes) % np.uint64(shards)).astype(np.int64)


def by_shard(a: np.ndarray, b: np.ndarray, unit: np.ndarray, codes: np.ndarray, units: int, shards: int):
    """(shard, packed pairs) of tokens: codes[a] and codes[b] are the pair, which shard by the first one; unit < units says whose."""
    size, at = len(codes), shards_of(codes, shards)
    order_a, order_b = np.lexsort((codes, at)), np.argsort(codes)
    place_a, place_b = np.empty(size, np.int64), np.empty(size, np.int64)
    place_a[order_a] = place_b[order_b] = np.arange(size)
    key = place_a[a]
    for factor, x in ((size, place_b[b]), (units, unit)):
        key *= factor
        key += x
    del a, b, x, unit  # tokens are many: few arrays of them at a time
    key.sort()
    new = starts(key)
    n = lengths(new, len(key)).astype(np.int32)
    key = key[new]
    pair = key // units
    unit = (key - pair * units).astype(np.int32)
    del key
    new = starts(pair)
    first, second = np.divmod(pair[new], size)
    first, second, per = order_a[first], codes[order_b[second]], lengths(new, len(pair))
    cut = starts(at[first])
    for lo, hi in zip(cut.tolist(), [*cut[1:].tolist(), len(new)]):
        e = slice(new[lo], new[hi] if hi < len(new) else len(pair))
        begin = new[lo:hi] - new[lo]
        step = steps(unit[e], begin)  # a pair's first unit is large, its others are near each other
        yield int(at[first[lo]]), put_pairs(codes[first[lo:hi]], second[lo:hi], per[lo:hi], step[begin], np.delete(step, begin), n[e])


def entries(data: bytes) -> tuple[np.ndarray, ...]:
    """What by_shard packed: codes of pairs, the pair of each entry, its unit and count."""
    a, b, per, first, more, n = get_pairs(data)
    per = per.astype(np.int64)
    begin = np.cumsum(per) - per
    step, rest = np.empty(len(n), np.uint64), np.ones(len(n), bool)
    step[begin], rest[begin] = first, False
    step[rest] = more
    return a, b, np.repeat(np.arange(len(a)), per), unstepped(step, begin).astype(np.int64), n.astype(np.int64)


def hashed(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) >> (64 - BITS)


class Codes(dict):
    """Words to numbers in order of appearance, with their codes."""

    def __init__(self, ranks: dict[int, int]):
        self.ranks, self.codes = ranks, [EDGE, TAIL, HEAD]

    def __missing__(self, word: bytes) -> int:
        h = hashed(word)
        self.codes.append(self.ranks.get(h) or h | 1 << BITS)
        self[word] = len(self.codes) - 1
        return self[word]


def fold_of(text: str | None) -> int:
    return xxhash.xxh3_64_intdigest((text or "").encode("utf-8", "surrogatepass"), seed=7) & 1


def chunks(batches, ranks: np.ndarray):
    """(rows, numbers of all words, words a row, codes) of runs of rows of bounded size."""
    known = {int(h): i for i, h in enumerate(ranks, 3)}
    table, rows, numbers, sizes, total = Codes(known), [], [], [], 0
    for pdf in batches:
        for row in zip(*(pdf[c] for c in pdf.columns)):
            words = words_of(row[-1])
            if rows and (total + len(words) > CHUNK_WORDS or len(rows) == CHUNK_DOCS):
                numbers = [np.concatenate(numbers)]
                yield rows, numbers.pop(), np.array(sizes), np.array(table.codes, np.uint64)
                table, rows, numbers, sizes, total = Codes(known), [], [], [], 0
            rows.append((*row[:-1], fold_of(row[-1])))
            numbers.append(np.fromiter(map(table.__getitem__, words), np.int32, len(words)))
            sizes.append(len(words))
            total += len(words)
    if rows:
        numbers = [np.concatenate(numbers)]
        yield rows, numbers.pop(), np.array(sizes), np.array(table.codes, np.uint64)


def before(numbers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The number of the word before each one; at the beginning of a text it is the edge's."""
    out = np.zeros(len(numbers), np.int32)
    out[1:] = numbers[:-1]
    begin = (np.cumsum(sizes) - sizes)[sizes > 0]
    out[begin] = EDGE
    return out


def frequent(texts: DataFrame) -> np.ndarray:
    """Hashes of the most frequent words, FREQUENT of them at most. A word that a task sees less than four times among 500,000 different ones is left out there, as a short code saves it little."""

    @tidied
    def count(batches):
        found: Counter[bytes] = Counter()

        def rows():
            often = [(hashed(w), n) for w, n in found.items() if n > 3]
            found.clear()
            return pd.DataFrame(often, columns=["word", "n"])

        for pdf in batches:
            for text in pdf["text"]:
                found.update(words_of(text))
                if len(found) > 500_000:
                    yield rows()
        yield rows()

    top = texts.mapInPandas(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(FREQUENT)
    return np.array([r["word"] for r in top.collect()], np.int64)


def discounts(n: list[int]) -> np.ndarray:
    """0, D1, D2, D3+ of one order, from its counts of counts; 0.5 where the data don't determine one."""
    n1, n2, n3, n4 = n
    if not n1 or not n2:
        return np.array([0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.5]
    return np.array([0, *(min(max(d, 0.05), k + 0.95) for k, d in enumerate(raw))])


def count_pairs(texts: DataFrame, ranks, shards: int) -> DataFrame:
    """Trusted pairs, a row a shard of first words: (shard, data: put_pairs(first, second, count in fold 0, in fold 1))."""

    @tidied
    def send(batches):
        for rows, numbers, sizes, codes in chunks(batches, ranks.value):
            fold = np.repeat(np.array([r[-1] for r in rows]), sizes)
            found = [*by_shard(before(numbers, sizes), numbers, fold, codes, 2, shards)] if len(numbers) else []
            yield pd.DataFrame(found, columns=["shard", "data"])

    def merged(parts):
        a, b, c = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((b, a))
        a, b, c = a[order], b[order], c[order]
        new = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        return a[new], b[new], np.add.reduceat(c, new, axis=0)

    @tidied
    def take(batches):
        shard, parts, held = None, [], 0
        for pdf in batches:
            for s, data in zip(pdf["shard"], pdf["data"]):
                if s != shard and parts:
                    a, b, c = merged(parts)
                    yield pd.DataFrame({"shard": [shard], "data": [put_pairs(a, b, c[:, 0], c[:, 1])]})
                    parts, held = [], 0
                shard = s
                a, b, pair, fold, n = entries(data)
                c = np.zeros((len(a), 2), np.int64)
                c[pair, fold] = n
                parts.append((a, b, c))
                held += len(a)
                if held > 4_000_000:  # what repeats is summed on the way
                    parts = [merged(parts)]
                    held = len(parts[0][0]) // 2
        if parts:
            a, b, c = merged(parts)
            yield pd.DataFrame({"shard": [shard], "data": [put_pairs(a, b, c[:, 0], c[:, 1])]})

    sent = texts.mapInPandas(send, "shard int, data binary").repartition(shards, "shard").sortWithinPartitions("shard")
    return sent.mapInPandas(take, "shard int, data binary")


def totals(pairs: DataFrame, shards: int) -> list[dict] | None:
    """The numbers of each fold's model (that is, of the other fold's texts): discounts d2, d1, how many pairs, and the probability of an unknown word; None without trusted words."""

    def counts(x):
        return np.bincount(np.minimum(x, 5).astype(np.int64), minlength=6)[1:]

    @tidied
    def split(batches):
        # of each shard of first words: counts of counts, and how many first words each word follows, by its own shard
        for pdf in batches:
            for data in pdf["data"]:
                _, b, c0, c1 = get_pairs(data)
                b, at = np.unique(b, return_inverse=True)
                at_shard = shards_of(b, shards)
                order = np.argsort(at_shard, kind="stable")
                follows = [np.bincount(at, c > 0, len(b)).astype(np.int64)[order] for c in (c0, c1, c0 + c1)]
                b, at_shard = b[order], at_shard[order]
                cut = starts(at_shard).tolist()
                out = [(int(at_shard[lo]), squeeze(np.diff(b[lo:hi], prepend=np.uint64(0)), *(k[lo:hi] for k in follows)), None) for lo, hi in zip(cut, [*cut[1:], len(b)])]
                out.append((0, None, np.concatenate([counts(c) for c in (c0, c1, c0 + c1)]).tolist()))
                yield pd.DataFrame(out, columns=["shard", "data", "n"])

    def joined(parts):
        b, *follows = (np.concatenate(x) for x in zip(*parts))
        b, at = np.unique(b, return_inverse=True)
        return [b, *(np.bincount(at, k, len(b)).astype(np.int64) for k in follows)]

    @tidied
    def add(batches):
        shard, parts = None, []

        def row():
            _, *follows = joined(parts)
            return pd.DataFrame({"n": [np.concatenate([np.zeros(15, np.int64), *(np.append(counts(k), k.sum()) for k in follows)]).tolist()]})

        for pdf in batches:
            for s, data, n in zip(pdf["shard"], pdf["data"], pdf["n"]):
                if n is not None:
                    yield pd.DataFrame({"n": [[*n, *[0] * 18]]})
                    continue
                if s != shard and parts:
                    yield row()
                    parts = []
                shard = s
                step, *follows = unsqueeze(data)
                parts.append((np.cumsum(step), *follows))
                if sum(len(x[0]) for x in parts[1:]) > 2_000_000:
                    parts = [joined(parts)]
        if parts:
            yield row()

    rows = pairs.mapInPandas(split, "shard int, data binary, n array<long>").repartition(shards, "shard").sortWithinPartitions("shard")
    n = rows.mapInPandas(add, "n array<long>").agg(*[F.sum(F.col("n")[i]) for i in range(33)]).first()
    if not n[32]:
        return None
    both = n[20] and n[26]  # pairs in each fold
    models = []
    for f in (1, 0) if both else (2, 2):
        *words, of_pairs = n[15 + 6 * f : 21 + 6 * f]
        d1 = discounts(words[:4])
        # what the discounts of all words leave, in equal parts for the model's words and one unknown word
        unseen = float(d1 @ [0, words[0], words[1], sum(words[2:])]) / of_pairs / (sum(words) + 1)
        models.append({"fold": f, "d2": discounts(n[5 * f : 5 * f + 4]), "d1": d1, "pairs": of_pairs, "unseen": unseen})
    return models


def model_rows(pairs: DataFrame, models: list[dict], shards: int) -> DataFrame:
    """The model as packed rows: kind 0, the back-off weights of a shard's histories; kind 1, pairs and what they have over the back-off, in the shards of their second words."""

    @tidied
    def send(batches):
        for pdf in batches:
            for shard, data in zip(pdf["shard"], pdf["data"]):
                a, b, *c = get_pairs(data)
                g = starts(a)
                gamma, over = [], []
                for m in models:
                    n = (c[0] + c[1] if m["fold"] == 2 else c[m["fold"]]).astype(np.float64)
                    d = m["d2"][np.minimum(n, 3).astype(np.int64)]
                    held, whole = np.add.reduceat(d, g), np.add.reduceat(n, g)
                    with np.errstate(invalid="ignore", divide="ignore"):
                        gamma.append(np.where(whole > 0, np.log(held / whole), 0.0).astype(np.float32))
                        over.append(np.where(n > 0, (n - d) / np.repeat(held, lengths(g, len(a))), -1.0).astype(np.float32))
                out = [(shard, 0, 0, 0, 0, squeeze(a[g], *gamma))]
                at = shards_of(b, shards)
                order = np.argsort(at, kind="stable")  # pairs stay in order of first words, whose weights then repeat
                a, b, at, over = a[order], b[order], at[order], [x[order] for x in over]
                cut = starts(at).tolist()
                for lo, hi in zip(cut, [*cut[1:], len(a)]):
                    out.append((int(at[lo]), 1, 0, 0, 0, put_pairs(a[lo:hi], b[lo:hi], over[0][lo:hi], over[1][lo:hi])))
                yield pd.DataFrame(out, columns=["shard", "kind", "chunk", "units", "split", "data"])

    return pairs.mapInPandas(send, PACKED)


def questions(rows: DataFrame, ranks, shards: int) -> DataFrame:
    """doc_id, lang, text as packed rows: kind 2, pairs of a chunk's documents by the shard of the second word; kind 3, the documents themselves."""

    @tidied
    def send(batches):
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        for found, numbers, sizes, codes in chunks(batches, ranks.value):
            chunk += 1
            # documents of fold 0 first; of a fold, those of a language and of a length, which share more pairs: steps between them are shorter
            order = sorted(range(len(found)), key=lambda i: (found[i][-1], str(found[i][1]), sizes[i]))
            place = np.empty(len(found), np.int32)
            place[order] = np.arange(len(found))
            split = sum(r[-1] == 0 for r in found)
            docs = pa.table({
                "doc_id": pa.array([found[i][0] for i in order], pa.string(), from_pandas=True), "lang": pa.array([found[i][1] for i in order], pa.string(), from_pandas=True), "n": pa.array(sizes[order], pa.int64()),
            })
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, docs.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                w.write_table(docs)
            out = [(int(mix(np.array([chunk], np.uint64))[0] % np.uint64(shards)), 3, chunk, len(found), split, sink.getvalue().to_pybytes())]
            some = np.flatnonzero(sizes > 0)
            if len(some):
                # a document's histories are the edge and all its words but the last one
                last = numbers[np.cumsum(sizes)[some] - 1]
                a = np.concatenate([numbers, last, np.full(len(some), EDGE, np.int32)])
                b = np.concatenate([before(numbers, sizes), np.full(len(some), TAIL, np.int32), np.full(len(some), HEAD, np.int32)])
                unit = np.concatenate([np.repeat(place, sizes), place[some], place[some]])
                tokens = [(a, b, unit)]
                del numbers, a, b, unit  # by_shard alone has them
                out += [(s, 2, chunk, len(found), split, data) for s, data in by_shard(*tokens.pop(), codes, len(found), shards)]
            yield pd.DataFrame(out, columns=["shard", "kind", "chunk", "units", "split", "data"])

    # ids travel as strings: pandas has no whole numbers with nulls
    return rows.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(send, PACKED)


def find(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Places of x in the sorted table; -1 where it isn't."""
    if not len(table):
        return np.full(len(x), -1)
    at = np.minimum(np.searchsorted(table, x), len(table) - 1)
    return np.where(table[at] == x, at, -1)


class Shard:
    """A shard's part of both models."""

    def __init__(self, models: list[dict], histories: list[bytes], pairs: list[bytes]):
        self.models = models
        self.history, *self.gamma = unsqueeze(histories[0]) if histories else [np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)]
        got = [get_pairs(x) for x in pairs]
        h, w, *over = [np.concatenate(x) for x in zip(*got)] if got else [np.zeros(0, np.uint64)] * 2 + [np.zeros(0)] * 2
        self.words, at = np.unique(w, return_inverse=True)
        self.before, place = np.unique(h, return_inverse=True)
        key = at * len(self.before) + place
        order = np.argsort(key)
        self.key, self.over, self.base = key[order], [x[order].astype(np.float64) for x in over], []
        for m, x in zip(models, over):
            k = np.bincount(at, x >= 0, len(self.words))
            d = m["d1"][np.minimum(k, 3).astype(np.int64)]
            self.base.append((k - d) / m["pairs"] + m["unseen"])

    def logs(self, w: np.ndarray, h: np.ndarray) -> list[np.ndarray]:
        """For both folds, what a pair adds to the sum: log p(w | h), with w's weight as a history in place of h's; or a correction."""
        word, prior, own = find(self.words, w), find(self.before, h), find(self.history, w)
        at = find(self.key, np.where((word >= 0) & (prior >= 0), word * len(self.before) + prior, -1))
        out = []
        for f, m in enumerate(self.models):
            p = np.where(word >= 0, self.base[f][word], m["unseen"]) if len(self.words) else np.full(len(w), m["unseen"])
            over = np.where(at >= 0, np.maximum(self.over[f][at], 0), 0.0) if len(self.key) else np.zeros(len(w))
            gamma = np.where(own >= 0, self.gamma[f][own].astype(np.float64), 0.0) if len(self.history) else np.zeros(len(w))
            out.append(np.where(h == TAIL, -gamma, np.where(h == HEAD, gamma, np.log(p + over) + gamma)))
        return out


def answers(packed: DataFrame, models: list[dict], shards: int) -> DataFrame:
    """doc_id, lang, perplexity from packed rows of a model and of questions."""

    @tidied
    def ask(batches):
        shard, histories, pairs, model = None, [], [], None
        for pdf in batches:
            out = []
            for s, kind, chunk, units, split, data in zip(*(pdf[c] for c in ("shard", "kind", "chunk", "units", "split", "data"))):
                if s != shard:
                    shard, histories, pairs, model = s, [], [], None
                if kind == 0:
                    histories.append(data)
                elif kind == 1:
                    pairs.append(data)
                elif kind == 3:
                    out.append((int(chunk), -1, data))
                else:
                    if model is None:
                        model, histories, pairs = Shard(models, histories, pairs), [], []
                    w, h, pair, unit, n = entries(data)
                    low, high = model.logs(w, h)
                    total = np.rint(np.bincount(unit, np.where(unit < split, low[pair], high[pair]) * n, units) * PARTS).astype(np.int64)
                    out.append((int(chunk), s, squeeze(np.array([total.min()], np.float64), total - total.min())))
            yield pd.DataFrame(out, columns=["chunk", "shard", "data"])

    @tidied
    def add(batches):
        docs, total = None, None

        def rows():
            pdf = docs.to_pandas()
            n = pdf.pop("n").to_numpy(np.float64)
            with np.errstate(invalid="ignore", divide="ignore"):
                return pdf.assign(perplexity=np.where(n > 0, np.exp(np.minimum(-total / PARTS / n, 700)), np.nan))

        for pdf in batches:
            for s, data in zip(pdf["shard"], pdf["data"]):
                if s < 0:
                    if docs is not None:
                        yield rows()
                    docs = pa.ipc.open_stream(data).read_all()
                    total = np.zeros(len(docs), np.int64)
                else:
                    least, more = unsqueeze(data)
                    total += more.astype(np.int64) + int(least[0])
        if docs is not None:
            yield rows()

    parts = packed.repartition(shards, "shard").sortWithinPartitions("shard", "kind", "chunk").mapInPandas(ask, "chunk long, shard int, data binary")
    return parts.repartition(shards, "chunk").sortWithinPartitions("chunk", "shard").mapInPandas(add, "doc_id string, lang string, perplexity double").withColumn("doc_id", F.col("doc_id").cast("long"))


def perplexities(docs: DataFrame, trusted: DataFrame) -> DataFrame | None:
    """doc_id, lang, perplexity of docs (doc_id, lang, text), a written table; trusted: text. None without trusted words."""
    spark = docs.sparkSession
    shards = shuffle_parts(spark)
    ranks = spark.sparkContext.broadcast(frequent(trusted))  # FREQUENT numbers at most
    pairs = written(count_pairs(trusted, ranks, shards), "pairs")
    models = totals(pairs, shards)
    if models is None:
        return None
    packed = model_rows(pairs, models, shards).union(questions(docs, ranks, shards))
    out = written(answers(packed, models, shards).withColumn("perplexity", F.nanvl("perplexity", F.lit(None).cast("double"))), "perplexity")
    discard(pairs)
    return out


def classify(docs: DataFrame, trusted_ids: DataFrame, quantile: float = 0.99, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", small_rows: int = 2_000_000) -> DataFrame:
    """doc_id, lang, perplexity, threshold, kept of all docs; trusted_ids: one column of ids."""
    ids = trusted_ids.select(F.col(trusted_ids.columns[0]).cast("long").alias("doc_id")).dropna().distinct()
    ids = maybe_broadcast(written(ids, "trusted"), small_rows).withColumn("trusted", F.lit(True))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    scored = perplexities(rows, rows.join(ids, "doc_id", "left_semi").select("text"))
    if scored is None:
        return rows.select("doc_id", "lang", F.lit(None).cast("double").alias("perplexity"), F.lit(None).cast("double").alias("threshold"), (F.length("text") > 0).alias("kept")).fillna(False, ["kept"])
    good = scored.where("perplexity is not null").join(ids, "doc_id", "left_semi")
    limits = good.groupBy("lang").agg(F.percentile_approx("perplexity", quantile, 10_000).alias("threshold"))
    every = good.agg(F.percentile_approx("perplexity", quantile, 10_000)).first()[0]
    limits = limits.withColumnRenamed("lang", "l")
    out = scored.join(maybe_broadcast(limits, 100_000), F.col("lang").eqNullSafe(F.col("l")), "left").withColumn("threshold", F.coalesce("threshold", F.lit(every)))
    return out.select("doc_id", "lang", "perplexity", "threshold", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)).alias("kept"))
