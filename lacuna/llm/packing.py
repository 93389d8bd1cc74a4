"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of tokens. Queues are served in quanta: a queue's u-th quantum falls due at
virtual time (u + 1/2) * quantum / T_s, where T_s is its target weight or else its tokens, so that a queue is never more than one quantum from its
target share of the stream, and what it is short of (its deficit) passes on to the next window. Due
times are a closed form, so that deficits also pass from partition to partition without any task
waiting for another: the rank of a quantum in the stream is a sum of one count for each queue. Windows
are runs of `window` ranks; all are full but the last one.

Edge cases: a null or empty text is one end token; a null source is a queue of its own; documents
with equal or null ids are packed as rows of their own; an empty table gives no rows; columns other than the id, text and
source columns are ignored. Every source has a queue of its own; work grows with pieces x sources.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
import sys
import zlib
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from lacuna.llm.common import HELD, maybe_broadcast, tidy, written

LETTER = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
NUMBER = "0-9²³¹¼-¾"
SPACE = "\t\n\x0b\x0c\r \x85\xa0"
#: The tokenizer's pre-split, written out for texts of Latin-1 characters.
LATIN_SPLIT = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
#: Kinds of Latin-1 characters: letters, numbers, white space, others. END stands for what follows a text.
KINDS = np.array([next((k for k, chars in enumerate((LETTER, NUMBER, SPACE)) if re.match(f"[{chars}]", chr(c))), 3) for c in range(256)], np.uint8)
BLANK, END = 2, 4


def word_starts(chars: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Where the words of LATIN_SPLIT begin, and the ends of texts, in texts of Latin-1 bytes with a line feed of kind END after each."""
    new = np.ones(len(chars), bool)
    new[1:] = kind[1:] != kind[:-1]
    # the last of a run of white space goes with what follows if it is a space, else it is a word
    last = np.flatnonzero((kind[:-1] == BLANK) & (kind[1:] != BLANK) & (kind[1:] != END))
    new[last] = True
    new[last[chars[last] == ord(" ")] + 1] = False
    # 's, 't, 'm, 'd, 're, 've and 'll are words where one begins with them; letters that follow are another
    quote = np.flatnonzero((chars == ord("'")) & new)
    a, b = chars[quote + 1], chars[np.minimum(quote + 2, len(chars) - 1)]
    three = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
    size = np.where(np.isin(a, np.frombuffer(b"stmd", np.uint8)), 2, np.where(three, 3, 0))
    quote, size = quote[size > 0], size[size > 0]
    new[quote + 1] = False
    new[quote + size] = True
    return np.flatnonzero(new)


def taken(flat: np.ndarray, size: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs numbered `at` of flat, one after the other, and their sizes; size: of all runs."""
    n = size[at]
    place = np.repeat((np.cumsum(size) - size)[at] - (np.cumsum(n) - n), n)
    place += np.arange(len(place))
    return flat[place], n


class Encoder:
    """Token ids of the tokenizer file as little-endian unsigned 16-bit bytes.

    The merges never cross a pre-split, so that a text's ids are those of its pieces; pieces are
    encoded once and kept. Texts with characters beyond Latin-1 or a special token's string go to the
    tokenizer whole."""

    def __init__(self, path: str, keep: int = 350_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 65536:
            raise ValueError("16-bit ids are too small for this vocabulary")
        split = json.loads(self.tokenizer.pre_tokenizer.__getstate__()) if self.tokenizer.pre_tokenizer else {}
        #: Whether LATIN_SPLIT is what this file's pre-split does; else all texts go to the tokenizer whole.
        self.known_split = self.tokenizer.normalizer is None and {k: v for k, v in split.items() if k != "trim_offsets"} == {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: Words as Latin-1 bytes with their numbers; the ids of all of them, one after the other; how many ids each has.
        self.keep, self.known, self.before = keep, self.none(), self.none()
        #: What stands for the bytes of a Latin-1 character in a byte-level vocabulary.
        self.letters = {c: "".join(x for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(chr(c))) for c in range(256)} if self.known_split else {}

    def whole(self, texts: list[str]) -> list[bytes]:
        found = [array("H", e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        if sys.byteorder == "big":
            for x in found:
                x.byteswap()
        return [x.tobytes() for x in found]

    @staticmethod
    def none() -> tuple[dict[bytes, int], np.ndarray, np.ndarray]:
        return {}, np.zeros(0, "<u2"), np.zeros(0, np.int64)

    def pieces(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words of LATIN_SPLIT, one after the other, and how many each has: the file's merges alone, as nothing is left to split."""
        merge = self.tokenizer.model.tokenize
        found = [[t.id for t in merge(w.translate(self.letters))] for w in words]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(itertools.chain.from_iterable(found), "<u2", sizes.sum()), sizes

    def batch(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        step: list[tuple[int, bytes]] = []
        size = 0
        for i, t in enumerate(texts):
            try:
                data = t.encode("latin-1")
                plain = self.known_split and not any(s in t for s in self.special)
            except UnicodeEncodeError:
                plain = False
            if not plain:
                out[i] = self.whole([t])[0]
                continue
            step.append((i, data))
            size += len(t)
            if size > 4_000_000:
                self._join(step, out)
                step, size = [], 0
        self._join(step, out)
        return out

    def _add(self, words: list[bytes], ids: np.ndarray, n: np.ndarray) -> None:
        known, flat, size = self.known
        known.update(zip(words, range(len(known), len(known) + len(words))))
        self.known = known, np.concatenate([flat, ids]), np.concatenate([size, n])

    def _join(self, step, out) -> None:
        if not step:
            return
        data = b"\n".join([*(x for _, x in step), b""])
        chars = np.frombuffer(data, np.uint8)
        ends = np.cumsum([len(x) + 1 for _, x in step])
        kind = KINDS[chars]
        kind[ends - 1] = END
        begin = word_starts(chars, kind)
        words = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(np.append(begin, len(chars))), pa.py_buffer(data)]).dictionary_encode()
        inside = np.flatnonzero(kind[begin] != END)
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist() takes nine times as long
        if len(self.known[0]) > self.keep:  # two generations: what is still in use moves on
            self.known, self.before = self.none(), self.known
        known, before = self.known[0], self.before[0]
        new = [w for w in distinct if w not in known]
        moved = [w for w in new if w in before]
        if moved:
            self._add(moved, *taken(*self.before[1:], np.fromiter(map(before.__getitem__, moved), np.int64, len(moved))))
            new = [w for w in new if w not in before]
        if new:
            self._add(new, *self.pieces([w.decode("latin-1") for w in new]))
        number = np.fromiter(map(known.__getitem__, distinct), np.int64, len(distinct))
        ids, n = taken(*self.known[1:], number[words.indices.to_numpy()[inside]])
        raw, at = ids.tobytes(), 0
        for (i, _), to in zip(step, np.append(0, np.cumsum(n) * 2)[np.searchsorted(begin[inside], ends)].tolist()):
            out[i] = raw[at:to]
            at = to


@functools.cache
def encoder(path: str) -> Encoder:
    """One for all tasks of a Python worker."""
    return Encoder(path)


HELD["packing"] = encoder.cache_clear


def tokenized(docs: DataFrame, vocabulary: str, id_col: str, text_col: str, source_col: str, end_id: int) -> DataFrame:
    """A row for each document: its queue, its ids and its place in its task's part of the queue."""
    queue = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("null"))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), queue.alias("queue"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )

    def encode(batches):
        from pyspark import TaskContext

        tidy("packing")
        encode_with, part, at = encoder(vocabulary), TaskContext.get().partitionId(), {}
        end = np.asarray([end_id], "<u2").tobytes()
        for pdf in batches:
            ids = [x + end for x in encode_with.batch(pdf["text"].tolist())]
            n = np.fromiter((len(x) // 2 for x in ids), np.int64, len(ids))
            start = np.zeros(len(ids), np.int64)
            for q, where in pdf.groupby("queue").indices.items():
                ends = np.cumsum(n[where]) + at.get(q, 0)
                start[where] = ends - n[where]
                at[q] = int(ends[-1])
            yield pd.DataFrame({"part": part, "queue": pdf["queue"], "doc_id": pdf["doc_id"], "n": n, "at": start, "ids": ids})

    return rows.mapInPandas(encode, "part int, queue string, doc_id long, n long, at long, ids binary")


def ranks(queue: np.ndarray, unit: np.ndarray, totals: np.ndarray, quantum: int, rates: np.ndarray) -> np.ndarray:
    """The rank in the stream of the first token of each unit-th quantum of queue; queues run in proportion to rates until they are dry."""
    due = (unit + 0.5) * quantum / rates[queue]
    out = unit * quantum
    for s, (total, rate) in enumerate(zip(totals, rates)):
        most = -(-int(total) // quantum)
        c = np.clip(np.ceil(due * rate / quantum - 0.5), 0, most).astype(np.int64)

        def before(u, s=s, rate=rate):
            t = (u + 0.5) * quantum / rate
            return (t < due) | ((t == due) & (s < queue))

        c -= (c > 0) & ~before(c - 1)
        c += (c < most) & before(c)
        out = out + np.where(queue == s, 0, np.minimum(c * quantum, total))
    return out


def pieces(n: np.ndarray, at: np.ndarray, queue: np.ndarray, totals: np.ndarray, quantum: int, window: int, rates: np.ndarray | None = None):
    """(document's row, start, length, rank) of the pieces that documents at `at` in their queues are cut into."""
    first, last = at // quantum, (at + n - 1) // quantum
    count = last - first + 1
    row = np.repeat(np.arange(len(n)), count)
    unit = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[row]
    lo = np.maximum(unit * quantum, at[row])
    hi = np.minimum((unit + 1) * quantum, (at + n)[row])
    rank = ranks(queue[row], unit, totals, quantum, totals if rates is None else rates) + lo - unit * quantum
    # cut at window ends; a quantum is no longer than a window, so that there is one cut at most
    cut = np.minimum((rank // window + 1) * window - rank, hi - lo)
    two = cut < hi - lo
    order = np.argsort(np.concatenate([np.arange(len(row)) * 2, np.flatnonzero(two) * 2 + 1]), kind="stable")
    row = np.concatenate([row, row[two]])[order]
    lo, hi = np.concatenate([lo, (lo + cut)[two]])[order], np.concatenate([lo + cut, hi[two]])[order]
    rank = np.concatenate([rank, (rank + cut)[two]])[order]
    # join what follows on from the piece before in the same window
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (rank[1:] != rank[:-1] + (hi - lo)[:-1]) | (rank[1:] % window == 0)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(row)) - 1
    return row[begin], lo[begin] - at[row[begin]], hi[end] - lo[begin], rank[begin]


def pack(
    docs: DataFrame, vocabulary: str, window: int = 2048, quantum: int = 128, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source", end_id: int = 1, small_rows: int = 200_000,
    weights: dict[str | None, float] | None = None,
) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source queue.

    weights: each source's share of the windows, relative to the others'; by default its tokens. Once a source has run dry, the
    others share the windows by their weights."""
    if not 0 < quantum <= window:
        raise ValueError("quantum must be from 1 to window")
    tokens = written(tokenized(docs, vocabulary, id_col, text_col, source_col, end_id), "tokens")
    by_part = tokens.groupBy("part", "queue").agg(F.sum("n").alias("n"))
    by_part = written(
        by_part.select("part", "queue", "n", F.coalesce(F.sum("n").over(Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base")), "queues"
    )
    found = sorted((r["queue"], r["n"]) for r in by_part.groupBy("queue").agg(F.sum("n").alias("n")).collect())  # a row a source
    number, totals = {q: i for i, (q, _) in enumerate(found)}, np.array([n for _, n in found], np.int64)
    rates = None
    if weights is not None:
        given = {"null" if k is None else f"={k}": float(w) for k, w in weights.items()}
        if missing := [q for q, _ in found if not 0 < given.get(q, 0) < float("inf")]:
            raise ValueError(f"no positive weight for queues {missing[:5]}")
        rates = np.array([given[q] for q, _ in found])
    rows = tokens.join(maybe_broadcast(by_part.select("part", "queue", "base"), small_rows), ["part", "queue"])

    def cut(batches):
        tidy("packing")
        for pdf in batches:
            if not len(pdf):
                continue
            n, at = pdf["n"].to_numpy(), (pdf["at"] + pdf["base"]).to_numpy()
            row, start, length, rank = pieces(n, at, pdf["queue"].map(number).to_numpy(), totals, quantum, window, rates)
            ids = pdf["ids"].tolist()
            crc, was, wide = np.empty(len(row), np.int64), -1, b""
            for k, (r, a, b) in enumerate(zip(row.tolist(), start.tolist(), length.tolist())):
                if r != was:
                    wide, was = memoryview(np.frombuffer(ids[r], "<u2").astype("<u4").tobytes()), r
                crc[k] = zlib.crc32(wide[4 * a : 4 * (a + b)])
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"].iloc[row].to_numpy(), "start": start, "length": length, "ids_crc32": crc, "doc_tokens": n[row],
                "sequence_id": rank // window, "offset": rank % window, "queue": pdf["queue"].iloc[row].to_numpy(),
            })

    return rows.mapInPandas(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, queue string")
