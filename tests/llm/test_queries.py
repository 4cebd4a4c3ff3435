"""Registered queries against their SQL, and the whole pipeline stage by stage."""

from __future__ import annotations

import collections
import re

import __spark_entry__ as entry
import corpus_pipeline
import duckdb
import numpy as np
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from civicflow.llm import near_dup, oracle, queries, stages, toxicity

TABLES = "documents embeddings pages labels benchmark".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_operator_is_registered():
    numbers = {re.match(r"op(\d+)_", name)[1] for name in queries.registered()}
    assert numbers == {str(n) for n in range(1, 14)}
    assert {*queries.registered(), "pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", list(oracle.ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = queries.registered()[name](spark, SF_DIR)
    found = duck.execute(oracle.ORACLE[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    expected = [tuple(row) for row in found.fetchall()]
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(expected)


@pytest.mark.parametrize("name", ["op1_toxicity", "op6_ppm", "op7_sentencepiece"])
def test_scores_and_codes_cover_all_documents(spark, name):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = queries.registered()[name](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect())
    if name == "op6_ppm":
        assert sum(r.score for r in rows if r.held_out) < 0
    if name == "op1_toxicity":
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_pipeline_stages_do_what_they_say(spark):
    """Each stage against a plain version of itself on what the one before it kept."""
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity",
        "minhash_near_dedup",
        "substring_dedup",
        "packing",
    ]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")

    clean = stages.toxicity(spark, docs, SF_DIR).cache()
    scored = toxicity.score(docs, toxicity.train(docs, labels, F.lit(True)))
    assert sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in scored.where("predicted = 0").collect())
    assert clean.columns == docs.columns and 0 < clean.count() < docs.count()

    kept = stages.near_duplicates(spark, clean, SF_DIR).cache()
    sets = {r.doc_id: set(s.tolist()) for r in clean.collect() for s in near_dup.shingle_sets([r.text])}
    root = {i: i for i in sets}
    similar = [
        (i, j) for i in sets for j in sets if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    for _ in sets:
        for a, b in similar:
            root[a] = root[b] = min(root[a], root[b])
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in root if root[i] == i)
    assert kept.columns == docs.columns

    cut = stages.substrings(spark, kept, SF_DIR).cache()
    texts, seen = {r.doc_id: r.text for r in kept.collect()}, set()
    expected = {}
    for doc_id in sorted(texts):
        words = texts[doc_id].encode().split()
        gone = np.zeros(len(words), bool)
        for at in range(len(words) - 19):
            window = tuple(words[at : at + 20])
            gone[at : at + 20] |= window in seen
            seen.add(window)
        left = b" ".join(w for w, g in zip(words, gone) if not g).decode()
        if not gone.any():
            expected[doc_id] = texts[doc_id]
        elif left:
            expected[doc_id] = left
    assert {r.doc_id: r.text for r in cut.collect()} == expected
    assert all(r.n_chars == len(r.text) for r in cut.collect() if r.text != texts[r.doc_id])

    packed = stages.packed(spark, cut, SF_DIR).collect()
    tokens = collections.Counter()
    for r in packed:
        tokens[r.doc_id] += r.length
    assert tokens == {r.doc_id: r.doc_tokens for r in packed} and set(tokens) == set(expected)


def test_pipeline_stages_survive_nulls_and_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, "a", None, 3), (1, text, "a", None, 3), (2, text + " x", None, None, None), (None, None, None, None, None)]
    rows += [(None, text, None, None, 1), (3, "", "b", "s", 0), (4, None, "b", "s", None), (5, "q " + text, "b", "s", 9)]
    for name, data in (("odd", rows), ("none", [])):
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.schema(schema).parquet(f"{tmp_path}/{name}")
        for step, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{name}-{step}")
            docs = spark.read.parquet(f"{tmp_path}/{name}-{step}")
        found = spark.read.parquet(f"{tmp_path}/{name}-minhash_near_dedup").collect()
        ids = sorted((r.doc_id is None, r.doc_id or 0) for r in found)
        assert ids == ([(False, 1), (False, 3), (False, 4), (True, 0), (True, 0)] if data else [])


def test_texts_under_one_id_are_judged_alone(spark, tmp_path):
    """A clean text stays when another one under its id is a copy; clashing columns stay as given."""
    schema = "doc_id long, text string, whole string, digest string, own long, score double, predicted string"
    base = " ".join(f"w{i}" for i in range(60))
    texts = [(1, base), (2, base + " tail"), (2, " ".join(f"v{i}" for i in range(50))), (3, "z " * 30), (3, "y " * 30), (2, base + " tail"), (3, base)]
    rows = [(i, t, "a", "b", n, -7.0 - n, "given") for n, (i, t) in enumerate(texts)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    kept = stages.near_duplicates(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == sorted(rows[i] for i in (0, 2, 3, 4))
    clean = stages.toxicity(spark, docs, SF_DIR)
    assert clean.dtypes == docs.dtypes and sorted(tuple(r) for r in clean.collect()) == sorted(rows)
