"""Stages of the corpus pipeline: (spark, docs, sf_dir) to a DataFrame.

Every stage works on all rows its predecessor kept. All but the last return the columns of
``docs``. Rows without doc_id pass the filters that need one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.llm import near_dup, packing, substring_dedup
from civicflow.llm import toxicity as tox
from civicflow.llm.components import stored
from civicflow.llm.queries import path_of, table
from civicflow.operators.dimensions import assign_keys


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the classifier rejects. It learns from all given labels. Columns that are
    named as the classifier's own pass through under another name."""
    classifier = tox.train(docs, table(spark, sf_dir, "labels"), F.lit(True))
    aside = {c: f"_given_{'_'.join(docs.columns)}_{c}" for c in docs.columns if c in ("score", "predicted")}
    found = tox.score(docs.withColumnsRenamed(aside), classifier).where("predicted = 0")
    return found.select(*(F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns))


def _nodes(docs: DataFrame) -> DataFrame:
    """``docs`` as (doc_id, text, whole): a text that shares its id with another text has an id of its
    own beside all others, so each text is judged alone; the text with the smallest digest keeps it."""
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole")
    digest = F.md5(F.coalesce("text", F.lit("")))
    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), digest.alias("digest"))
    least = texts.groupBy("doc_id").agg(F.min("digest").alias("least"), F.max("digest").alias("most"))
    least = stored(least.where("least <> most").select("doc_id", "least"), "repeated-ids")
    plain = docs.select(F.col("doc_id").cast("long"), "text", whole)
    if least.isEmpty():
        return plain
    others = texts.join(least, "doc_id").where("digest <> least").select("doc_id", "digest").distinct()
    low, high = docs.agg(F.min(F.col("doc_id").cast("long")), F.max(F.col("doc_id").cast("long"))).first()
    base = high if high < 2**62 else low - 2**61
    own = assign_keys(others, "own", ["doc_id", "digest"], F.lit(base), kind="long")
    own = own.withColumnsRenamed({"doc_id": "of", "digest": "of_digest"})
    numbered = plain.join(own, (F.col("doc_id") == F.col("of")) & (digest == F.col("of_digest")), "left")
    return stored(numbered.select(F.coalesce("own", "doc_id").alias("doc_id"), "text", "whole"), "nodes")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates, the one with the smallest doc_id; of equal
    rows, and of rows with that id and text, the smallest row. Other texts under an id are
    documents of their own: they stay or go for what they are."""
    nodes = _nodes(docs)
    found = near_dup.near_duplicates(nodes).where("doc_id is not null and not kept").select("doc_id").distinct()
    left = nodes.join(found, "doc_id", "left_anti")
    # Few ids, or none, have several rows; only those are compared.
    ids = left.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    chosen = left.join(ids, "doc_id").groupBy("doc_id").agg(F.min("whole").alias("whole")).select("whole")
    return left.join(ids, "doc_id", "left_anti").select("whole").unionAll(chosen).select("whole.*")


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove repeated passages. A changed text has its kept words joined by one blank; its number
    of characters follows. A text that loses nothing stays as it is, and one that loses all its
    words goes."""
    # Under another name the text comes back unchanged among the other columns.
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    packed = docs.select("doc_id", "text", F.struct("text", *(F.col(f"`{c}`") for c in others)).alias("whole"))
    found = substring_dedup.remove_repeats(packed)
    changed = F.size("removed") > 0
    found = found.where(~changed | (F.col("kept_text") != ""))
    columns = {c: F.col(f"rest.whole.`{c}`") for c in others}
    columns |= {"doc_id": F.col("id"), "text": F.when(changed, F.col("kept_text")).otherwise(F.col("rest.whole.text"))}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(changed, F.char_length("kept_text").cast("long")).otherwise(columns["n_chars"])
    return found.select(*(columns[c].alias(c) for c in docs.columns))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 2048 ids; one row per piece."""
    return packing.pack(docs, path_of("word_bpe_49k.json"), 2048, 1)
