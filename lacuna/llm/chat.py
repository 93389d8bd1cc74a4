"""Chat formatting with offset-aligned loss masks.

A whole conversation is rendered as <|im_start|>role<|im_sep|>text<|im_end|> and a line end for each turn, and encoded
once with offsets. The tokens that bear loss are found by binary search of the sorted spans of assistant texts in the sorted token
spans. The control strings are tokens of their own, so that no token reaches over the edge of a text. In roles and texts a "|"
behind "<" and any number of backslashes gets one more backslash; taking one away restores them.

Edge cases: null texts and roles are empty; turns with equal numbers follow by role and text, repeated rows all stay; a null turn comes
first; rows with a null conversation are a conversation of their own; an empty table gives no rows; other columns are ignored. A
conversation is one unit of output and is held whole by one task; conversations are never held together.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
TURN = re.compile(r"<\|im_start\|>(.*?)<\|im_sep\|>(.*?)<\|im_end\|>\n", re.S)


def escaped(s: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", s)


def unescaped(s: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", s)


def render(turns: list[tuple[str, str]], roles: frozenset[str] = frozenset({"assistant"})) -> tuple[str, np.ndarray]:
    """The conversation's text and the (start, end) code points of the texts of turns by roles."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head = START + escaped(role) + SEP
        body = escaped(text)
        if role in roles:
            spans.append((at + len(head), at + len(head) + len(body)))
        out.append(head + body + END + "\n")
        at += len(out[-1])
    return "".join(out), np.array(spans, np.int64).reshape(-1, 2)


def encoder(path: str):
    """The tokenizer of the file, with the control strings as added tokens."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import AddedToken, Tokenizer

    t = Tokenizer.from_file(path)
    t.add_special_tokens([AddedToken(x, normalized=False, special=True) for x in (START, SEP, END)])
    return t


def mask(spans: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which tokens lie in a span: both are sorted, and tokens don't reach over a span's edge."""
    at = np.searchsorted(spans[:, 0], offsets[:, 0], side="right") - 1
    inside = at >= 0
    inside[inside] = offsets[inside, 1] <= spans[at[inside], 1]
    return inside & (offsets[:, 1] > offsets[:, 0])


def format_conversations(rows: DataFrame, vocabulary: str, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """conv_id, formatted, ids, loss (a boolean for each id), starts and ends (each id's code points in formatted)."""
    turns = rows.select(F.col(conv_col).cast("long").alias("conv_id"), F.struct(F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("x"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("turns")).select("conv_id", F.transform("turns", lambda x: x["role"]).alias("role"), F.transform("turns", lambda x: x["text"]).alias("text"))
    bearing = frozenset(roles)

    def encode(batches):
        tokenizer = encoder(vocabulary)
        for pdf in batches:
            for k in range(0, len(pdf), 256):
                part = pdf.iloc[k : k + 256]
                made = [render([*zip(r, t)], bearing) for r, t in zip(part["role"].tolist(), part["text"].tolist())]
                found = tokenizer.encode_batch([m[0] for m in made], add_special_tokens=False)
                offsets = [np.array(e.offsets, np.int64).reshape(-1, 2) for e in found]
                yield pd.DataFrame({
                    "conv_id": part["conv_id"].to_numpy(), "formatted": [m[0] for m in made], "ids": [np.array(e.ids, np.int32) for e in found],
                    "loss": [mask(m[1], o) for m, o in zip(made, offsets)], "starts": [o[:, 0].astype(np.int32) for o in offsets], "ends": [o[:, 1].astype(np.int32) for o in offsets],
                })

    return whole.mapInPandas(encode, "conv_id long, formatted string, ids array<int>, loss array<boolean>, starts array<int>, ends array<int>")


def parsed(formatted: str) -> list[tuple[str, str]]:
    """The turns that render() got."""
    at, out = 0, []
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        out.append((unescaped(m[1]), unescaped(m[2])))
        at = m.end()
    return out


def loss_texts(formatted: str, loss: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> str:
    """All text under the loss mask, unescaped: runs of masked code points, one after another."""
    under = np.zeros(len(formatted) + 1, np.int64)
    np.add.at(under, starts[loss], 1)
    np.add.at(under, ends[loss], -1)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(under) > 0, [0]])))
    return "".join(unescaped(formatted[a:b]) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()))


def digests(output: DataFrame) -> DataFrame:
    """Read back from the output: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""

    def read(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                turns = parsed(row.formatted)
                under = loss_texts(row.formatted, np.asarray(row.loss, bool), np.asarray(row.starts, np.int64), np.asarray(row.ends, np.int64))
                text = "".join(f"{r}\n{t}\n" for r, t in turns)
                out.append((row.conv_id, len(turns), hashlib.sha256(text.encode()).hexdigest(), len(under), hashlib.sha256(under.encode()).hexdigest(), len(row.formatted)))
            yield pd.DataFrame(out, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]).astype({"conv_id": "Int64"})

    return output.mapInPandas(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
