"""Toxicity by non-negative positive-unlabelled learning, in numpy.

Confirmed toxic documents are the positives; all training rows, whatever their label, are drawn from as unlabelled text. The
risk is prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)), where the class prior is the share of toxic rows among the labelled
training rows; where the second part is negative, its gradient is reversed, so that the classifier doesn't learn to fit it. The
features are the presence of hashed words whose share among positives differs from that among the unlabelled by `least_z`
standard errors.

Training takes about `most_rows` positives and as many unlabelled rows (twice as many ids at most, 8 * most_rows rows together), the first by
hash, so that a run can be repeated; scoring covers whole texts of all rows.
Training rows are those that the caller marks; labels of others are not read.

Edge cases: null and empty texts are scored as texts without words; labels of null or unknown ids are ignored; a
document with several labels is a positive if one says so; repeated rows get equal scores; without positives every score is 0; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lacuna.llm.common import words_of, written

BITS = 20


def feature(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) & ((1 << BITS) - 1)


class Features:
    """Sorted distinct feature numbers of a text."""

    def __init__(self, keep: int = 150_000):
        self.known, self.keep = {}, keep

    def __call__(self, text: str | None) -> np.ndarray:
        words = {*words_of(text)}
        if len(self.known) > self.keep:
            self.known.clear()
        self.known.update([(w, feature(w)) for w in words if w not in self.known])
        return np.unique(np.fromiter(map(self.known.__getitem__, words), np.int32, len(words)))


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, most_features: int = 512, least_z: float = 6.0, steps: int = 400, rate: float = 0.05, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray, float]:
    """(features, weights, bias) that minimise the non-negative risk with the logistic loss."""
    size = 1 << BITS
    share = lambda rows: np.bincount(np.concatenate(rows) if rows else [], minlength=size)[:size] / max(1, len(rows))
    p, u = share(positive), share(unlabelled)
    z = (p - u) / np.sqrt(np.maximum(u * (1 - u), 1 / max(1, len(unlabelled))) / max(1, len(positive)))
    chosen = np.argsort(-np.abs(z), kind="stable")[:most_features]
    chosen = np.sort(chosen[np.abs(z[chosen]) >= least_z])
    column = np.full(size, -1)
    column[chosen] = np.arange(len(chosen))

    def matrix(rows):
        x = np.zeros((len(rows), len(chosen)), np.float32)
        for i, r in enumerate(rows):
            c = column[r]
            x[i, c[c >= 0]] = 1
        return x

    xp, xu = matrix(positive), matrix(unlabelled)
    w, b = np.zeros(len(chosen)), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    sigmoid = lambda s: 1 / (1 + np.exp(-np.clip(s, -30, 30)))
    for t in range(1, steps + 1):
        sp, su = xp @ w + b, xu @ w + b
        gp, gu = sigmoid(sp), sigmoid(su)
        # d/ds of log(1 + e^-s) is sigmoid(s) - 1, and of log(1 + e^s) is sigmoid(s)
        negative = np.logaddexp(0, su).mean() - prior * np.logaddexp(0, sp).mean()
        row_p, row_u = -prior * gp / len(gp), gu / len(gu)
        if negative >= 0:
            row_p = row_p + prior * (gp - 1) / len(gp)
        else:
            row_p, row_u = -row_p, -row_u
        g = np.append(xp.T @ row_p + xu.T @ row_u + decay * w, row_p.sum() + row_u.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - float(step[-1])
    return chosen, w, b


def scores(rows: list[np.ndarray], model: tuple[np.ndarray, np.ndarray, float]) -> np.ndarray:
    chosen, w, b = model
    weight = np.zeros(1 << BITS)
    weight[chosen] = w
    return 1 / (1 + np.exp(-np.clip([weight[r].sum() + b for r in rows], -30, 30)))


def classify(docs: DataFrame, labels: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most_rows: int = 10_000, seed: int = 11, small_rows: int = 1_000_000) -> DataFrame:
    """doc_id, held_out, score, predicted of all docs; held_out: an expression over doc_id."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = labels.select(F.col(labels.columns[0] if id_col not in labels.columns else id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
    known = written(known.where(F.col("doc_id").isNotNull() & ~F.coalesce(held_out, F.lit(False))).dropna().groupBy("doc_id").agg(F.max("y").alias("y")), "labels")
    n, toxic = known.agg(F.count("*"), F.coalesce(F.sum((F.col("y") == 1).cast("int")), F.lit(0))).first()
    out = rows.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    if not toxic:
        return out.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    prior = min(max(toxic / n, 1e-3), 0.95)

    def chosen(ids: DataFrame, count: int) -> DataFrame:
        """About most_rows ids at most, by hash, and no more than twice as many in any case."""
        share = int(min(1.0, most_rows / max(1, count)) * (1 << 20))
        place = F.xxhash64("doc_id", F.lit(seed))
        return ids.where(F.pmod(place, F.lit(1 << 20)) < share).orderBy(place, "doc_id").limit(2 * most_rows)

    train = out.where(~F.col("held_out") & F.col("doc_id").isNotNull())
    ids = chosen(known.where("y = 1").select("doc_id"), toxic).withColumn("positive", F.lit(True)).union(chosen(train.select("doc_id").distinct(), train.count()).withColumn("positive", F.lit(False)))
    ids = F.broadcast(written(ids, "chosen"))  # 4 * most_rows ids at most

    def take(batches):
        features = Features()
        for pdf in batches:
            yield pdf[["place", "positive"]].assign(x=[features(t).astype("<i4").tobytes() for t in pdf["text"].tolist()])

    place = F.xxhash64("doc_id", "text", F.lit(seed))  # rows whose ids repeat may be more than were chosen
    taken = train.join(ids, "doc_id").select(place.alias("place"), "positive", "text").mapInPandas(take, "place long, positive boolean, x binary").orderBy("place", "positive").limit(8 * most_rows).toPandas()
    sides = [[np.frombuffer(x, "<i4") for x in taken["x"][taken["positive"] == side]] for side in (True, False)]
    del taken
    if not sides[0] or not sides[1]:
        return out.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    model = fit(*sides, prior)

    def score(batches):
        features = Features()
        for pdf in batches:
            s = scores([features(t) for t in pdf["text"].tolist()], model) if len(pdf) else np.zeros(0)
            yield pdf[["doc_id", "held_out"]].assign(score=s, predicted=(s >= 0.5).astype(np.int32))

    return out.mapInPandas(score, "doc_id long, held_out boolean, score double, predicted int")


__all__ = ["Features", "classify", "feature", "fit", "scores"]
