"""The pipeline's stages as functions of documents; each applies one operator's decisions.

Defined cases are those of the operators.  In addition: rows that are equal in key and text
count as copies of each other, a null key is never preferred to another, and every column of
the documents is kept as it is except the text (and ``n_chars`` with it) where personal data
were replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm import bpe, pii, simhash, toxicity, winnow
from quire.llm.common import importable, sized, table, unused, written


def _digest() -> Column:
    return F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)


def _without(docs: DataFrame, bad: DataFrame, name: str) -> DataFrame:
    """The documents whose text has none of some digests (column ``bad``): only digests are moved."""
    own = unused(docs, "bad")
    bad = written(bad.select(F.col("bad").alias(own)).distinct(), name)
    return docs.join(sized(bad), _digest() == F.col(own), "left_anti")


def drop_toxic(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that score ``THRESHOLD`` or more go, a null text being an empty one; the classifier learns from the
    labels of these documents, and without any nothing goes."""
    importable(spark)
    model = toxicity.fitted(docs, table(spark, sf_dir, "labels"))
    # Python gets texts alone, and what it rejects comes back as digests: rows never pass through it.
    scored = docs.select(_digest().alias("bad"), toxicity.scores(docs, model).alias("score"))
    return _without(docs, scored.where(F.col("score") >= toxicity.THRESHOLD), "toxic")


def drop_near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest key."""
    importable(spark)
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), _digest().alias("digest"))
    groups = simhash.near_duplicates(docs.select(key.alias("key"), "text"), key="key")
    groups = written(groups.select("key", (F.col("key") == F.col("smallest")).alias("stays")), "stays")
    own, digest = unused(docs, "own_id"), unused(docs, "own_digest")
    same = F.col("doc_id").eqNullSafe(F.col(own)) & (_digest() == F.col(digest))
    pick = (F.col("key.id").alias(own), F.col("key.digest").alias(digest))
    kept = docs.join(sized(groups.where("NOT stays").select("key").distinct().select(*pick)), same, "left_anti")
    again = groups.where("stays").groupBy("key").count().where("count > 1").select(*pick)
    again = written(again, "repeated")
    if again.isEmpty():
        return kept
    # Rows that repeat the one that stays: of those the first by their other columns, only they are moved.
    rest = F.sha2(F.to_json(F.struct(*docs.columns)).cast("binary"), 256)
    one = kept.join(sized(again), same, "left_semi").groupBy("doc_id", _digest().alias(digest)).agg(
        F.min_by(F.struct(*docs.columns), rest).alias(own)).select(f"{own}.*")
    return kept.join(sized(again), same, "left_anti").unionByName(one)


def drop_contaminated(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go of which benchmark passages make up a twentieth of the words or more; without benchmark items, or
    without words, all stay."""
    rows = winnow.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    bad = rows.where(winnow.contaminated(F.col("n_hit"), F.col("n_words")))
    return _without(docs, bad.select(F.col("digest").alias("bad")), "contaminated")


def replace_personal_data(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; personal data in its text are replaced, and ``n_chars`` is counted anew (a null text
    keeps its count)."""
    rows = pii.replace(docs)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars"))
    return rows.select(*docs.columns)


def tokenize(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document; a null text has no tokens."""
    import public_tokenizers as P

    importable(spark)
    return bpe.digests(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
