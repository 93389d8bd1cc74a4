"""A training-data pipeline of five stages; each takes and returns documents, the last one returns packed pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lacuna.llm import decontaminate, language, ngram_join, packing, pii
from lacuna.llm.common import load, maybe_broadcast, written
from lacuna.llm.queries import PSEUDONYM_KEY, vocabulary_path


def measured(docs: DataFrame) -> DataFrame:
    """n_chars of the texts as they are now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def own_columns(stage, docs: DataFrame, *names: str) -> DataFrame:
    """stage(docs), where columns of docs with the given names are out of the way meanwhile and come back as they were."""
    taken = {c: f"__own_{c}" for c in docs.columns if c.lower() in names}
    out = stage(docs.withColumnsRenamed(taken))
    return out.select(*[F.col(f"`{taken.get(c, c)}`").alias(c) for c in docs.columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identifiable language go: those whose text is null, empty or without letters too. Repeated rows fare alike; an empty table stays empty."""
    return own_columns(lambda d: language.identify_documents(d).where("language_kept"), docs, *language.RESULTS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of copies and near copies the document with the least id stays; texts decide, so that ids may be null or repeated.

    Texts without words are linked to nothing and stay; of rows that are equal in id and text one stays; an empty table stays empty."""
    found = written(ngram_join.duplicates(docs), "near-duplicates")
    few = maybe_broadcast(found.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), F.col("n").alias("__n"), F.col("gone").alias("__gone")), 1_000_000)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (ngram_join.text_digest(F.col("text")) == F.col("__digest"))
    left = docs.join(few, same, "left").where("__gone is null or not __gone")
    if not found.where("n > 1 and not gone").isEmpty():  # one of the rows that are equal in id and text
        left = left.where("__n is null").union(left.where("__n is not null").dropDuplicates(["__id", "__digest"]))
    return left.select(*docs.columns)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items go, and with them documents that are mostly such passages. Null and empty texts stay; other columns and null ids pass through."""
    return measured(decontaminate.clean(docs, load(spark, sf_dir, "benchmark")))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced within their formats. Null texts stay null; other columns pass through."""
    return measured(own_columns(lambda d: pii.pseudonymise(d, PSEUDONYM_KEY), docs, *pii.RESULTS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, as pieces of sequences; a null or empty text is one piece of its end token."""
    return packing.pack(docs, vocabulary_path())


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("pii", pseudonymise),
    ("packing", pack),
]

#: Models, hashes and a tokenizer decide here, which SQL doesn't express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
