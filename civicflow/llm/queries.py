"""Queries that apply each operator to its whole table, and their SQL."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicflow.llm import (
    decontamination,
    near_dup,
    near_vectors,
    packing,
    pieces,
    ppm,
    spelling,
    substring_dedup,
    token_files,
    topk,
    toxicity,
    vector_codes,
    warc,
)
from civicflow.llm.oracle import ORACLE
from civicflow.session import scratch_dir


def path_of(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=8)
def _ship(app: str) -> None:
    """Send this package to the Python workers, as ``--py-files`` would."""
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in root.rglob("*.py"):
            out.write(source, source.relative_to(root.parent))
    SparkSession.active().sparkContext.addPyFile(str(archive))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _ship(spark.sparkContext.applicationId)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    classifier = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = toxicity.score(docs, classifier)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return substring_dedup.remove_repeats(docs).select(
        F.col("id").alias("doc_id"),
        "n_words",
        n_removed.alias("n_removed"),
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, 5)


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-files")
    token_files.write_ids(table(spark, sf_dir, "documents"), path, path_of("byte_bpe_50k.json"), 2)
    return token_files.read_ids(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op6_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    scored = ppm.score(table(spark, sf_dir, "documents"), ~held_out)
    return scored.withColumn("held_out", ~F.col("learned")).drop("learned")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number and CRC-32 of its ids, and CRC-32 and length of the text decoded from
    them."""
    model = path_of("piece_bpe_32k.model")
    ids = pieces.encode(table(spark, sf_dir, "documents"), model)
    return pieces.decode(ids, model).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
        F.crc32(F.col("text").cast("binary")).alias("decoded_crc32"),
        F.char_length("text").cast("long").alias("decoded_chars"),
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), path_of("word_bpe_49k.json"), 2048, 1)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op9_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.pages_of(warc.read_archives(spark, path)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_errors(codes).select(
        "vec_id",
        F.lower(F.hex("codes")).alias("code"),
        "error",
        "label_error",
        F.lit(books and books.digest()).cast("string").alias("codebooks_sha256"),
    )


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = spelling.count_words(table(spark, sf_dir, "documents"), spelling.misspell)
    return spelling.variants(vocabulary)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, query in globals().items() if name.startswith("op")}


def oracle() -> dict[str, str]:
    return dict(ORACLE)
