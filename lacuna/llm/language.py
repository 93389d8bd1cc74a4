"""Language identification by Bayesian evidence fusion.

log P(language | evidence) adds up four kinds of evidence: the text's likelihood under a trigram
model of character classes for each language, the declared language, the address's suffix, and the host's prior. Trigram
counts, the reliability of declarations and host priors are grouped aggregations over all rows. A
host's prior is smoothed to its domain's, and that to the whole table's: (n_host,l + a * P(l | domain)) / (n_host + a).

Every declared language has a model, whatever their number. Models are made and scored in blocks of `block` languages
(64**3 floats each), and each row carries the best language and the log-sum so far from block to block, so that
memory is bounded; work grows with rows x languages. A tag's language is its first part, without case: en for en_GB.

A text's trigrams aren't independent, so that its likelihood is tempered (`temper`).

A row is rejected if its text holds no letter, if its best language explains it worse than letters
drawn at random would (`floor` nats a byte), or if no language reaches `least` of the posterior.

Edge cases: null or empty texts hold no letter: language null, kept false; a null declaration, suffix
or host is no evidence; a table without any declaration rejects all rows; repeated rows get the same result each; all
columns of the input stay, but those named like this operator's results are replaced by them.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from lacuna.llm.charcodes import CLASSES, codes, joined, sums
from lacuna.llm.common import filesystem, maybe_broadcast, shared_path, tidy, written

#: What a country suffix says of a site's language.
SUFFIX = {"uk": "en", "us": "en", "au": "en", "ie": "en", "nz": "en", "de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "it": "it", "pt": "pt", "br": "pt", "nl": "nl", "pl": "pl"}
RESULTS = ("language", "language_posterior", "language_kept")
WORK = ("__lid_declared", "__lid_suffix", "__lid_host", "__lid_domain", "__lid_text")
PRIOR = ("__lid_hk", "__lid_hn", "__lid_dk", "__lid_dn")


def suffix_language(url: Column) -> Column:
    """The language that the host's suffix, or else the path's first part, stands for; null where neither does."""
    host = F.regexp_extract(F.lower(url), r"^[a-z]+://[^/:?#]*?\.([a-z]{2})(?:[:/?#]|$)", 1)
    table = F.create_map(*[F.lit(x) for kv in SUFFIX.items() for x in kv])
    path = F.nullif(F.regexp_extract(F.lower(url), r"^[a-z]+://[^/]+/([a-z]{2})(?:[/?#]|$)", 1), F.lit(""))
    return F.coalesce(F.try_element_at(table, host), path)


def markup_language(html: Column) -> Column:
    """What <html lang="..."> declares, without its region; null where it doesn't."""
    return F.nullif(F.lower(F.regexp_extract(html, r"(?i)<html[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]{2,3})", 1)), F.lit(""))


def host_of(url: Column) -> Column:
    return F.nullif(F.regexp_extract(F.lower(url), r"^[a-z]+://([^/:?#]+)", 1), F.lit(""))


def domain_of(host: Column) -> Column:
    """The last two labels of a host; of a name without dots what stands before its number."""
    return F.when(host.contains("."), F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)).otherwise(F.regexp_replace(host, r"\d+$", ""))


def visible_text(html: Column) -> Column:
    """A page's text: without scripts, styles and tags."""
    return F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"(?s)<[^>]*>", " ")


def trigram_counts(rows: DataFrame) -> DataFrame:
    """(language, code, n) over all rows with a declared language; tasks send one row for each pair."""

    def count(batches):
        tidy()
        total: dict[str, np.ndarray] = {}
        for pdf in batches:
            for lang, where in pdf.groupby("__lid_declared").indices.items():
                if len(total) >= 256 and lang not in total:  # bounded memory: what a task has goes out, and it starts again
                    yield from sent(total)
                    total = {}
                at = total.setdefault(lang, np.zeros(CLASSES**3, np.int64))
                texts = pdf["__lid_text"].to_numpy()[where].tolist()
                for k in range(0, len(texts), 500):
                    at += np.bincount(joined(texts[k : k + 500], 3)[0], minlength=CLASSES**3)
        yield from sent(total)

    def sent(total):
        for lang, n in total.items():
            seen = np.flatnonzero(n)
            yield pd.DataFrame({"language": lang, "code": seen.astype(np.int32), "n": n[seen]})

    out = rows.where("__lid_declared is not null").select("__lid_declared", "__lid_text").mapInPandas(count, "language string, code int, n long")
    return out.groupBy("language", "code").agg(F.sum("n").alias("n"))


class TextModel:
    """log P(byte class | two before) of each language, in blocks; a single block travels with the task, more lie in the shared folder."""

    def __init__(self, counts: DataFrame, block: int):
        self.names = sorted(r["language"] for r in counts.select("language").distinct().collect())
        self.at = range(0, len(self.names), block)
        self.only, self.folder = None, shared_path(counts.sparkSession, "language-models")
        for lo in self.at:
            model = block_model(counts, self.names[lo : lo + block])
            if len(self.at) == 1:
                self.only = model
                break
            fs, path = filesystem(self.folder)
            fs.create_dir(path, recursive=True)
            with fs.open_output_stream(f"{path}/{lo}") as out:
                out.write(model.tobytes())

    def blocks(self):
        """(first, last + 1, model) of each block."""
        for lo in self.at:
            model = self.only
            if model is None:
                fs, path = filesystem(self.folder)
                with fs.open_input_stream(f"{path}/{lo}") as f:
                    model = np.frombuffer(f.read(), np.float32).reshape(-1, CLASSES**3)
            yield lo, lo + len(model), model

    def grouped(self, batches, most: int = 8_000_000):
        """Batches; where blocks have to be read, several at once, up to so many characters."""
        held, size = [], 0
        for pdf in batches:
            held.append(pdf)
            size += pdf["__lid_text"].str.len().sum() + len(pdf)
            if self.only is not None or size > most:
                yield pd.concat(held, ignore_index=True) if len(held) > 1 else pdf
                held, size = [], 0
        if held:
            yield pd.concat(held, ignore_index=True)


def block_model(counts: DataFrame, names: list[str]) -> np.ndarray:
    """A row of 64**3 log probabilities for each of names."""
    model = np.zeros((len(names), CLASSES**3), np.float32)
    found = counts.where(F.col("language").isin(names)).toPandas()  # 64**3 rows a language at most
    for k, lang in enumerate(names):
        own = found[found["language"] == lang]
        n = np.zeros(CLASSES**3)
        n[own["code"].to_numpy()] = own["n"].to_numpy()
        n = n.reshape(CLASSES, CLASSES, CLASSES)
        one = (n.sum((0, 1)) + 0.5) / (n.sum() + 0.5 * CLASSES)
        two = (n.sum(0) + 8 * one) / (n.sum(0).sum(-1, keepdims=True) + 8)
        model[k] = np.log((n + 8 * two[None]) / (n.sum(-1, keepdims=True) + 8)).reshape(-1)
    return model


def language_tag(declared: Column) -> Column:
    """The language of a tag such as en, EN-us or en_GB; null where there is none."""
    return F.nullif(F.split(F.lower(F.trim(declared)), "[-_]")[0], F.lit(""))


def likelihoods(model: np.ndarray, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log likelihoods (rows x languages), bytes and letters of texts."""
    scores, sizes, letters = [], [], []
    for k in range(0, len(texts), 200):
        c, n = joined(texts[k : k + 200], 3)
        scores.append(np.stack([sums(m[c], n) for m in model], 1))
        sizes.append(n)
        last = c & 63
        letters.append(sums(((last >= 1) & (last <= 26)) | (last >= 31), n))
    none = np.zeros(0)
    return np.concatenate(scores) if scores else np.zeros((0, len(model))), np.concatenate(sizes or [none]), np.concatenate(letters or [none])


def identify(
    docs: DataFrame, text: Column, declared: Column, host: Column, suffix: Column | None = None, block: int = 64, temper: float = 0.1,
    strength: float = 20.0, suffix_trust: float = 0.8, least: float = 0.5, floor: float = -math.log(CLASSES), small_rows: int = 200_000,
) -> DataFrame:
    """docs with the columns RESULTS: the language, its posterior, and whether the row is kept."""
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in (*RESULTS, *WORK, *PRIOR)]
    suffix = F.lit(None).cast("string") if suffix is None else suffix
    rows = docs.select(
        *keep, language_tag(declared).alias("__lid_declared"), suffix.alias("__lid_suffix"), F.coalesce(host, F.lit("")).alias("__lid_host"),
        F.coalesce(domain_of(host), F.lit("")).alias("__lid_domain"), text.alias("__lid_text"),
    )
    docs = docs.select(*keep)
    model = TextModel(written(trigram_counts(rows.select(*WORK)), "trigrams"), block)
    names, size = model.names, len(model.names)
    if not size:
        return docs.select("*", F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("language_posterior"), F.lit(False).alias("language_kept"))
    number = {x: k for k, x in enumerate(names)}

    def first_pass(batches):
        """Counts by host and by declaration of what the text alone says."""
        tidy()
        for pdf in model.grouped(batches):
            texts = pdf["__lid_text"].tolist()
            best, top, letters = np.zeros(len(pdf), int), np.full(len(pdf), -np.inf), np.zeros(len(pdf))
            for lo, _, own in model.blocks() if len(pdf) else ():
                scores, _, letters = likelihoods(own, texts)
                better = scores.max(1) > top
                best[better], top[better] = scores.argmax(1)[better] + lo, scores.max(1)[better]
            pdf = pdf.assign(k=best)[letters > 0]
            yield pdf.groupby(["__lid_host", "__lid_domain", "__lid_declared", "k"], dropna=False).size().rename("n").reset_index()

    seen = rows.select(*WORK).mapInPandas(first_pass, "__lid_host string, __lid_domain string, __lid_declared string, k int, n long")
    seen = written(seen.groupBy("__lid_host", "__lid_domain", "__lid_declared", "k").agg(F.sum("n").alias("n")), "host-counts")
    said: dict[int, tuple[list[int], list[int]]] = {}  # P(declared | language): the languages found under each declaration
    said_n = np.full(size, 0.5)
    for r in seen.where("__lid_declared is not null").groupBy("k", "__lid_declared").agg(F.sum("n").alias("n")).collect():
        if (declared_k := number.get(r["__lid_declared"])) is not None:
            ks, ns = said.setdefault(declared_k, ([], []))
            ks.append(r["k"])
            ns.append(r["n"])
            said_n[r["k"]] += r["n"]

    whole = np.ones(size)
    for r in seen.groupBy("k").agg(F.sum("n").alias("n")).collect():
        whole[r["k"]] += r["n"]
    whole = whole / whole.sum()

    def counted(*keys):
        """The languages found under the keys, and how often; as arrays, since most languages are not."""
        return seen.groupBy(*keys, "k").agg(F.sum("n").alias("n")).groupBy(*keys).agg(F.collect_list(F.struct("k", "n")).alias("x"))

    domains = counted("__lid_domain").select("__lid_domain", F.col("x.k").alias("__lid_dk"), F.col("x.n").alias("__lid_dn"))
    priors = counted("__lid_host", "__lid_domain").join(domains, "__lid_domain").select("__lid_host", F.col("x.k").alias("__lid_hk"), F.col("x.n").alias("__lid_hn"), "__lid_dk", "__lid_dn")
    priors = written(priors, "host-priors")
    other = math.log((1 - suffix_trust) / max(1, size - 1))

    def smooth(ks, ns, prior, lo, hi):
        """(n + strength * prior) / (all n + strength) of languages lo to hi."""
        out = strength * prior
        mine = (ks >= lo) & (ks < hi)
        out[ks[mine] - lo] += ns[mine]
        return out / (ns.sum() + strength)

    def evidence(pdf, lo, hi):
        """Log prior by host and log likelihoods of declaration and suffix: rows x languages lo to hi."""
        hosts, first = pdf["__lid_host"].factorize()[0], ~pdf["__lid_host"].duplicated().to_numpy()
        table = [whole[lo:hi] if hk is None else smooth(hk, hn, smooth(dk, dn, whole[lo:hi], lo, hi), lo, hi) for hk, hn, dk, dn in pdf.loc[first, [*PRIOR]].itertuples(index=False)]
        total = np.log(np.array(table, float).reshape(-1, hi - lo))[hosts]
        at = pdf["__lid_declared"].map(number)
        for k in at.dropna().unique().astype(int).tolist():
            n = np.full(size, 0.5 / size)
            ks, ns = said.get(k, ((), ()))
            n[list(ks)] += ns
            total[(at == k).to_numpy()] += np.log(n / said_n)[lo:hi]
        at = pdf["__lid_suffix"].map(number)
        for k in at.dropna().unique().astype(int).tolist():
            total[(at == k).to_numpy()] += np.where(np.arange(lo, hi) == k, math.log(suffix_trust), other)
        return total

    def fuse(batches):
        tidy()
        for pdf in model.grouped(batches):
            texts, k = pdf["__lid_text"].tolist(), np.arange(len(pdf))
            best, top, mean, share, letters = np.zeros(len(pdf), int), np.full(len(pdf), -np.inf), np.zeros(len(pdf)), np.zeros(len(pdf)), np.zeros(len(pdf))
            for lo, hi, own in model.blocks() if len(pdf) else ():
                scores, n, letters = likelihoods(own, texts)
                total = scores * temper + evidence(pdf, lo, hi)
                at = total.argmax(1)
                better = total[k, at] > top
                high = np.where(better, total[k, at], top)
                share = share * np.exp(top - high) + np.exp(total - high[:, None]).sum(1)
                best, mean, top = np.where(better, at + lo, best), np.where(better, scores[k, at] / np.maximum(n, 1), mean), high
            p = 1 / share
            lang = np.where(letters > 0, np.array(names, object)[best], None)
            yield pdf.drop(columns=[*WORK, *PRIOR]).assign(language=lang, language_posterior=p, language_kept=(letters > 0) & (p >= least) & (mean >= floor))

    joined_rows = rows.join(maybe_broadcast(priors, small_rows), "__lid_host", "left").select(*docs.columns, *WORK, *PRIOR)
    schema = StructType([*docs.schema.fields, StructField("language", StringType()), StructField("language_posterior", DoubleType()), StructField("language_kept", BooleanType())])
    return joined_rows.mapInPandas(fuse, schema)


def identify_documents(docs: DataFrame, **more) -> DataFrame:
    """identify() for tables like documents: lang declares, source is the host."""
    return identify(docs, F.col("text"), F.col("lang"), F.col("source"), **more)


def identify_pages(pages: DataFrame, **more) -> DataFrame:
    """identify() for raw pages: markup, address suffix and host of url."""
    return identify(pages, visible_text(F.col("html")), markup_language(F.col("html")), host_of(F.col("url")), suffix_language(F.col("url")), **more)


__all__ = ["codes", "host_of", "identify", "identify_documents", "identify_pages", "markup_language", "suffix_language", "visible_text"]
