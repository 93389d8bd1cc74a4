"""Benchmark decontamination by a generalised suffix automaton of normalised test items.

Training words are streamed through the automaton of the items' words, which tracks the length of the longest match that
ends at each word. A match of `window` words or more covers its last `window` words; an item with fewer words is one
window of its own. Items are taken in blocks of `block_words` words, each with an automaton of its own in the shared folder,
so that what a task holds is bounded whatever the number of items. Runs of words that no item has
can't match and are skipped before the walk.

Edge cases: null, empty and wordless texts have no words and hits; items without words match nothing; repeated items
count by their ids, each id once; a null item id is written "null"; repeated rows get equal results;
without items no document is hit; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import pickle
import re
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from lacuna.llm.common import WORD_TABLE, filesystem, shared_path, tidy, words_of

NOT_SPACE = re.compile(rb"[^ ]+")


class Automaton:
    """Suffix automaton of several word sequences; states are numbers, 0 is the start."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        shortest, paths = window, []
        for name, words in items:
            if not words:
                continue
            shortest = min(shortest, len(words))
            last, path = 0, []
            for w in words:
                last = self._extend(last, self.vocabulary.setdefault(w, len(self.vocabulary)))
            paths.append((name, words))
        self.shortest = shortest
        states = len(self.next)
        # the state of the longest suffix no shorter than a window, of each state
        self.top = list(range(states))
        for v in sorted(range(states), key=self.length.__getitem__):
            if v and self.length[self.link[v]] >= window:
                self.top[v] = self.top[self.link[v]]
        holders: list[set[str]] = [set() for _ in range(states)]
        whole: dict[int, dict[int, set[str]]] = {}
        for name, words in paths:
            v = 0
            for k, w in enumerate(words, 1):
                v = self.next[v][self.vocabulary[w]]
                if k >= window:
                    # name's last `window` words are held by the top state of where they lead
                    holders[self.top[v]].add(name)
            if len(words) < window:
                whole.setdefault(v, {}).setdefault(len(words), set()).add(name)
        #: Short items that end wherever a state is reached: (words, names), by way of its suffixes.
        self.short: list[tuple] = [()] * states
        for v in sorted(range(1, states), key=self.length.__getitem__):
            self.short[v] = self.short[self.link[v]] + tuple((k, tuple(sorted(x))) for k, x in sorted(whole.get(v, {}).items()))
        self.holders = [tuple(sorted(h)) for h in holders]

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._split(last, c, q)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, c, q)
        return cur

    def _split(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        clone = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = clone
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = clone
            p = link[p]
        return clone

    def match(self, words: list[bytes], hit: np.ndarray, names: set[str]) -> None:
        """Marks covered words in hit and adds the items whose windows occur."""
        get = self.vocabulary.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        inside = np.concatenate([[0], ids >= 0, [0]])
        step = np.flatnonzero(np.diff(inside))
        nxt, link, length, window = self.next, self.link, self.length, self.window
        for a, b in zip(step[::2].tolist(), step[1::2].tolist()):
            if b - a < self.shortest:
                continue
            v = size = 0
            for i, c in enumerate(ids[a:b].tolist(), a):
                while v and c not in nxt[v]:
                    v = link[v]
                    size = length[v]
                if c in nxt[v]:
                    v, size = nxt[v][c], size + 1
                if size >= window:
                    hit[i + 1 - window : i + 1] = True
                    names.update(self.holders[self.top[v]])
                for k, found in self.short[v]:
                    if k <= size:
                        hit[i + 1 - k : i + 1] = True
                        names.update(found)


def automata(items: DataFrame, id_col: str, text_col: str, window: int, block_words: int) -> list[str]:
    """Automata of blocks of items, built and written by tasks; their places. Only those pass through the driver, one for each
    block_words words or fewer. A block's file is named by its attempt, so that what a lost task wrote is not read."""
    spark = items.sparkSession
    folder = shared_path(spark, "automata")
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("i"), F.col(text_col).alias("t"))
    size = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    parts = 1 + size // (8 * block_words)

    def build(batches):
        tidy()
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        block, size = [], 0

        def written_to():
            path = f"{root}/{uuid.uuid4().hex}.pickle"
            with fs.open_output_stream(path) as f:
                f.write(pickle.dumps(Automaton(block, window)))
            return pd.DataFrame({"path": [path]})

        for pdf in batches:
            for i, t in zip(pdf["i"].tolist(), pdf["t"].tolist()):
                words = words_of(t)
                if size and size + len(words) > block_words:
                    yield written_to()
                    block, size = [], 0
                block.append((i, words))
                size += len(words)
        if size:
            yield written_to()

    dealt = rows.repartition(parts, F.xxhash64("i", "t"))
    return sorted(r["path"] for r in dealt.mapInPandas(build, "path string").collect())


def groups(texts: list[str | None], most_chars: int = 2_000_000):
    """(start, stop) of runs of texts of most_chars characters together at most, or of one text."""
    start = size = 0
    for k, t in enumerate(texts):
        n = len(t or "")
        if k > start and size + n > most_chars:
            yield start, k
            start, size = k, 0
        size += n
    if texts:
        yield start, len(texts)


class Matcher:
    """Matches against the automata of all blocks, of which it holds one at a time."""

    def __init__(self, root_url: str, paths: list[str]):
        self.fs, _ = filesystem(root_url)
        self.paths, self.held = paths, (None, None)

    def automaton(self, path: str) -> Automaton:
        if self.held[0] != path:
            self.held = (None, None)
            with self.fs.open_input_stream(path) as f:
                self.held = (path, pickle.loads(f.read()))
        return self.held[1]

    def __call__(self, texts: list[str | None]):
        """(words, hit, names) of each text."""
        words = [words_of(t) for t in texts]
        hits = [np.zeros(len(w), bool) for w in words]
        names: list[set[str]] = [set() for _ in words]
        for path in self.paths:
            automaton = self.automaton(path)
            for w, h, x in zip(words, hits, names):
                if len(w) >= automaton.shortest:
                    automaton.match(w, h, x)
        return zip(words, hits, names)


def report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, block_words: int = 200_000) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of all docs."""
    paths = automata(items, item_id, item_text, window, block_words)
    url = shared_path(docs.sparkSession, "")

    def look(batches):
        tidy()
        matcher = Matcher(url, paths)
        for pdf in batches:
            rows = []
            texts = pdf["text"].tolist()
            for a, b in groups(texts):
                for w, h, x in matcher(texts[a:b]):
                    n = int(h.sum())
                    rows.append((len(w), n, len(x), hashlib.sha256(",".join(sorted(x)).encode()).hexdigest(), n > 0))
            out = pd.DataFrame(rows, columns=["n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
            out.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield out

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(look, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def without_hits(text: str, hit: np.ndarray) -> str:
    """text without the runs of hit words, each with what lies between its words."""
    raw = text.encode("utf-8", "surrogatepass")
    spans = [m.span() for m in NOT_SPACE.finditer(raw.translate(WORD_TABLE))]
    out, at = [], 0
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit, [0]])))
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        out.append(raw[at : spans[a][0]])
        at = spans[b - 1][1]
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, most_coverage: float = 0.5, block_words: int = 200_000) -> DataFrame:
    """docs, all columns, without covered spans; documents with more than most_coverage of their words covered go.

    What comes together where a span was is looked at again, until nothing is covered."""
    paths = automata(items, item_id, item_text, window, block_words)
    url, names = shared_path(docs.sparkSession, ""), docs.columns

    def cut(batches):
        tidy()
        matcher = Matcher(url, paths)
        for pdf in batches:
            texts = pdf[text_col].tolist()
            keep = np.ones(len(texts), bool)
            for a, b in groups(texts):
                for i, (w, h, _) in enumerate(matcher(texts[a:b]), a):
                    if not h.any():
                        continue
                    keep[i] = h.mean() <= most_coverage
                    while keep[i] and h.any():
                        texts[i] = without_hits(texts[i], h)
                        ((_, h, _),) = matcher([texts[i]])
            pdf[text_col] = pd.Series(texts, index=pdf.index, dtype=object)
            yield pdf[keep][names]

    return docs.mapInPandas(cut, StructType(docs.schema.fields))
