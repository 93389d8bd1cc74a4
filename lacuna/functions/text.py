"""Text functions as column expressions; regular expressions are Unicode-aware."""

from __future__ import annotations

import re
import unicodedata
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

TAG = r"\[([^\[\]]+)\]"
#: The classes of events and, in order of precedence, the words that stand for them.
CLASSES = ("laughter", "sigh", "cough", "throatclearing", "sneeze", "sniff")
TAG_WORDS = {
    "laughter": ["cười", "cuoi", "laugh"],
    "sigh": ["thở dài", "tho dai", "thở phào", "sigh"],
    "cough": ["ho", "cough"],
    "throatclearing": ["hắng giọng", "hang giong", "đằng hắng", "dang hang", "clear"],
    "sneeze": ["hắt hơi", "hat hoi", "sneeze"],
    "sniff": ["hít mũi", "hit mui", "khịt mũi", "khit mui", "sniff"],
}
#: Silence before and after an event as shares of the speaker's pause, and its level in dB above the speech.
GAP_SHAPE = {"laughter": (0.6, 1.4), "sigh": (0.5, 1.2), "cough": (0.7, 1.0), "throatclearing": (0.7, 1.0), "sneeze": (0.8, 1.3), "sniff": (0.5, 0.7)}
LEVEL_OFFSET_DB = {"laughter": 3.0, "sigh": -4.0, "cough": 2.0, "throatclearing": -2.0, "sneeze": 4.0, "sniff": -5.0}
#: Fixed value: the signs that are stripped from a word's ends.
SIGNS = ",.!?;:\"'()…"


def extract_tag(text: Column) -> Column:
    """The first [tag] with its brackets; null without one."""
    return F.nullif(F.regexp_extract(text, TAG, 0), F.lit(""))


def squeezed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def single_tag(original: Column, tagged: Column) -> Column:
    """The lower-cased tag if tagged is original with exactly one known tag put in; else null."""
    tags = F.regexp_extract_all(tagged, F.lit(TAG), F.lit(1))
    same = squeezed(F.regexp_replace(tagged, TAG, " ")) == squeezed(original)
    tag = F.lower(F.trim(tags[0]))
    return F.when((F.size(tags) == 1) & same & tag.isin(*CLASSES), F.concat(F.lit("["), tag, F.lit("]")))


def insert_at(text: Column, offset: Column, tag: Column) -> Column:
    """text with "[tag] " at a character offset counted from 0."""
    return F.concat(F.substr(text, F.lit(1), offset), F.lit("["), tag, F.lit("] "), F.substr(text, offset + 1))


def with_markers(text: Column, offsets: Column) -> Column:
    """text with "<1> ", "<2> ", ... at ascending offsets; the last is put in first, so that offsets stay right."""
    last_first = F.sort_array(F.transform(offsets, lambda o, i: F.struct((i + 1).alias("i"), o.alias("o"))), asc=False)
    return F.aggregate(last_first, text, lambda t, x: F.concat(F.substr(t, F.lit(1), x["o"]), F.lit("<"), x["i"].cast("string"), F.lit("> "), F.substr(t, x["o"] + 1)))


def tokens(text: Column) -> Column:
    """Non-space runs."""
    return F.regexp_extract_all(text, F.lit(r"(?U)\S+"), F.lit(0))


#: Fixed value: Unicode's White_Space, which Spark's (?U)\s stands for; Python's \s has four more signs.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


SPAN = StructType([StructField("text", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())])


@F.arrow_udf(ArrayType(SPAN))
def token_spans(texts: pa.Array) -> pa.Array:
    """array of struct(text, start, end), in characters from 0; linear in the text, which appending to an array isn't. Arrow
    arrays are made as a whole, and a worker holds the tokens of a batch of texts: tables take token_rows."""
    found = re.compile(f"[^{SPACE}]+").finditer
    words, starts, ends, offsets, nulls = [], [], [], [0], []
    for t in texts.to_pylist():
        for m in found(t or ""):
            words.append(m[0])
            start, end = m.span()
            starts.append(start)
            ends.append(end)
        offsets.append(len(words))
        nulls.append(t is None)
    fields = [pa.array(words, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())]
    spans = pa.StructArray.from_arrays(fields, ["text", "start", "end"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans, mask=pa.array(nulls, pa.bool_()))


def token_rows(rows: DataFrame, text: str, most: int = 1 << 16) -> DataFrame:
    """A row for each token of the text: the other columns, its number p, and token, start and stop as in token_spans. A worker
    holds a batch of texts and `most` tokens, however long the texts and however many a batch has."""
    kept = [f for f in rows.schema.fields if f.name != text]
    schema = StructType([*kept, *[StructField(n, StringType() if n == "token" else IntegerType()) for n in ("p", "token", "start", "stop")]])
    names, space = schema.names, SPACE

    def run(batches):
        found = re.compile(f"[^{space}]+").finditer

        def made(rest, at, first, counts, words, starts):
            ps = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts - first, counts) if counts else []
            words, starts = pa.array(words, pa.string()), pa.array(starts, pa.int32())
            own = [pa.array(ps, pa.int32()), words, starts, pc.add(starts, pc.utf8_length(words))]
            return pa.RecordBatch.from_arrays([*rest.take(pa.array(np.repeat(at, counts), pa.int64())).columns, *own], names=names)

        for batch in batches:
            texts, rest = batch.column(text), batch.select(names[:-4])
            at, first, counts, words, starts = [], [], [], [], []
            for i in range(len(texts)):
                tokens, p = found(texts[i].as_py() or ""), 0
                while some := [*islice(tokens, most - len(words))]:
                    at.append(i)
                    first.append(p)
                    counts.append(len(some))
                    words += [m[0] for m in some]
                    starts += [m.start() for m in some]
                    p += len(some)
                    if len(words) == most:
                        yield made(rest, at, first, counts, words, starts)
                        at, first, counts, words, starts = [], [], [], [], []
            if words:
                yield made(rest, at, first, counts, words, starts)

    return rows.mapInArrow(run, schema)


def aligner_token(word: Column) -> Column:
    """Letters, numbers and apostrophes only, lower-cased."""
    return F.lower(F.regexp_replace(word, r"[^\p{L}\p{N}']", ""))


@F.pandas_udf(StringType())
def composed(texts: pd.Series) -> pd.Series:
    """Unicode's composed form (NFC), which Spark doesn't have."""
    return texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


def clean_word(word: Column) -> Column:
    """A word of a composed text without the signs at its ends."""
    return F.btrim(word, F.lit(SIGNS))


def strip_brackets(tag: Column) -> Column:
    return F.lower(F.trim(F.btrim(F.trim(tag), F.lit("[]"))))


def match_class(tag: Column, draw: Column) -> Column:
    """The tag's class: by name, else by the first keyword in it as a whole word, else the draw (0-1) picks one."""
    s = strip_brackets(tag)
    by_name = F.when(s.isin(*CLASSES), s)
    by_word = [F.when(F.regexp_like(s, F.lit(rf"(?U)(?<!\w){k}(?!\w)")), c) for c, words in TAG_WORDS.items() for k in words]
    any_ = F.element_at(F.array(*[F.lit(c) for c in CLASSES]), F.least(F.floor(draw * len(CLASSES)).cast("int") + 1, F.lit(len(CLASSES))))
    return F.coalesce(by_name, *by_word, any_)


def slot_choice(reply: Column, n: Column) -> Column:
    """struct(status, slot, tag) of a model's reply: ok, declined (no slot), or error. The slot must be a JSON integer in 1-n."""
    body = F.regexp_extract(reply, r"(?s)\{.*\}", 0)
    raw = F.regexp_extract(body, r'"slot"\s*:\s*(-?[0-9]+)\s*[,}]', 1)
    other = F.regexp_like(body, F.lit(r'"slot"\s*:(?!\s*null\b)'))
    tag = strip_brackets(F.get_json_object(body, "$.tag"))
    slot = raw.try_cast("int")
    valid = F.get_json_object(body, "$").isNotNull()
    ok = (slot >= 1) & (slot <= n) & tag.isin(*CLASSES)
    status = F.when(~F.coalesce(valid, F.lit(False)), "error").when(~other, "declined").when(F.coalesce(ok, F.lit(False)), "ok").otherwise("error")
    return F.struct(status.alias("status"), F.when(status == "ok", slot).alias("slot"), F.when(status == "ok", tag).alias("tag"))


def words_around(text: Column) -> Column:
    """struct(before, after): cleaned words on either side of the first tag; null where there is no tag or a side is empty."""
    text = composed(text)
    at = F.regexp_instr(text, F.lit(TAG))
    tag = F.regexp_extract(text, TAG, 0)
    clean = lambda s: F.filter(F.transform(tokens(s), clean_word), lambda w: w != "")
    left, right = clean(F.substr(text, F.lit(1), at - 1)), clean(F.substr(text, at + F.length(tag)))
    ok = (at > 0) & (F.size(left) > 0) & (F.size(right) > 0)
    return F.struct(F.when(ok, left).alias("before"), F.when(ok, right).alias("after"))


def tag_time(text: Column, duration: Column) -> Column:
    """The share of words before the tag times the duration; half of it without a tag."""
    at = F.regexp_instr(text, F.lit(TAG))
    before = F.size(tokens(F.substr(text, F.lit(1), at - 1)))
    total = F.size(tokens(F.regexp_replace(text, TAG, " ")))
    return F.when((at > 0) & (total > 0), duration * before / total).otherwise(duration / 2)


@F.pandas_udf(StringType())
def deaccent(words: pd.Series) -> pd.Series:
    """Without marks, and d for the barred d: Spark has no Unicode normalisation."""
    table = str.maketrans("đĐ", "dD")

    def one(w):
        return None if w is None else unicodedata.normalize("NFC", "".join(c for c in unicodedata.normalize("NFD", w.translate(table)) if unicodedata.category(c) != "Mn"))

    return words.map(one, na_action="ignore")


def version_at_least(version: Column, least: Column) -> Column:
    """Dotted versions compared number by number."""
    numbers = lambda v: F.transform(F.split(v, r"\."), lambda x: F.coalesce(F.regexp_extract(x, "^[0-9]+", 0).try_cast("int"), F.lit(0)))
    return numbers(version) >= numbers(least)


def tail(text: Column, n: int) -> Column:
    """The last n characters."""
    return F.right(text, F.lit(n))


def base64_body(content: Column) -> Column:
    """Base64 in one line, as requests to models carry it; Spark breaks it into lines."""
    return F.translate(F.base64(content), "\r\n", "")


def filled(template: str, **values: Column) -> Column:
    """The template with each {name} replaced; a value's own braces stay as they are."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[values[p].cast("string") if i % 2 else F.lit(p) for i, p in enumerate(parts)])


def by_class(kind: Column, table: dict[str, float], override: dict[str, float], default: float) -> Column:
    """A class's value: what override has, else the table, else the default."""
    known = {**table, **override}
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in known.items() for x in (kv[0], float(kv[1]))]), kind), F.lit(float(default)))


def even_words(text: Column, seconds: Column) -> Column:
    """array of struct(text, start, stop): words in equal shares of the time, with gaps between them; null without words."""
    words = tokens(text)
    step = seconds / F.size(words)
    return F.when(F.size(words) > 0, F.transform(words, lambda w, i: F.struct(w.alias("text"), ((i + 0.15) * step).alias("start"), ((i + 0.85) * step).alias("stop"))))
