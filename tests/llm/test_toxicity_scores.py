"""Scores computed a second time, row by row and word by word."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicflow.llm import toxicity as tox
from civicflow.llm.words import mix, word_hashes
from civicflow.session import scratch_dir


def corpus(n_toxic):
    chance = random.Random(4)
    plain = [f"w{'abcdefghij'[i // 10]}{'klmnopqrst'[i % 10]}rd" for i in range(100)]
    bad = ["rotten", "rottenly", "grubworm", "blasted", "idiot"]
    rows = []
    for i in range(240):
        text = [chance.choice(plain) for _ in range(25)]
        toxic = i < n_toxic
        if toxic:
            text += [chance.choice(bad), chance.choice(bad), "!!"] if i % 3 else ["IDIOT", "clown"]
        elif i % 40 == 7:
            text.append("Clown")
        chance.shuffle(text)
        rows.append((i, " ".join(text).upper() if i % 50 == 9 else " ".join(text), int(toxic) if i % 2 else None))
    return rows


def words(text):
    return [w.lower() for w in re.findall("[A-Za-z]+", text)]


def features(text, terms):
    """Terms of a text, one word after the other, and the patterns; and its votes."""
    found, votes = set(), 0
    for word in words(text):
        for kind in tox.KINDS:
            h = int(mix(word_hashes([word[:kind].encode()], between=tox._BETWEEN)[1] + np.uint64(kind or 0))[0])
            at = int(np.searchsorted(terms.hashes, np.uint64(h)))
            if at < len(terms.hashes) and int(terms.hashes[at]) == h:
                found.add(at)
                votes |= 1 << int(terms.voter[at])
        votes |= word in tox.INSULTS.split()
    lexicons = bin(votes).count("1")
    votes = votes << tox.ALONE if lexicons == 1 else votes if lexicons else 1 << tox.NONE
    if sum(c.isupper() for c in text) * 2 > len(text):
        votes |= 1 << tox.SHOUTING
        found.add(len(terms.hashes))
    if "!!" in text or "***" in text:
        votes |= 1 << tox.MARKS
        found.add(len(terms.hashes) + 1)
    return found, votes


def logistic(x):
    return 1 / (1 + math.exp(-max(-50, min(50, x))))


def posterior(votes, rates, share, prior, given=-1):
    odds = math.log(prior / (1 - prior))
    for v in range(tox.VOTERS):
        if votes >> v & 1:
            odds += share[v] * math.log(rates[1][v] / rates[0][v])
    if given >= 0:
        odds += (2 * given - 1) * math.log(tox.LABEL_TRUST / (1 - tox.LABEL_TRUST))
    return logistic(odds)


def label_model(votes, given):
    """Expectation maximisation over rows."""
    every, number = range(tox.VOTERS), len(votes)
    fired = [[votes[i] >> v & 1 for v in every] for i in range(number)]
    known = [sum(g == k for g in given) for k in (0, 1)]
    prior = min(max(known[1] / sum(known), 1e-3), 0.5)
    rates = [[(sum(f[v] for f, g in zip(fired, given) if g == k) + 0.5) / (known[k] + 1) for v in every] for k in (0, 1)]
    share, trust = [1.0] * tox.VOTERS, number / sum(known)
    for _ in range(20):
        p = [posterior(v, rates, share, prior) for v in votes]
        left = [[f[v] - q * rates[1][v] - (1 - q) * rates[0][v] for v in every] for f, q in zip(fired, p)]
        cov = np.array(left).T @ np.array(left) / number
        for v in range(tox.LEXICONS):
            squares = [cov[v, u] ** 2 / (max(cov[v, v], 1e-12) * max(cov[u, u], 1e-12)) for u in range(tox.LEXICONS)]
            share[v] = 1 / max(1.0, sum(squares))
        weight = [[(q if k else 1 - q) + trust * (g == k) for q, g in zip(p, given)] for k in (0, 1)]
        rates = [[(sum(w * f[v] for w, f in zip(ws, fired)) + 0.5) / (sum(ws) + 1) for v in every] for ws in weight]
    return [posterior(v, rates, share, prior, g) for v, g in zip(votes, given)]


def regression(found, soft, size):
    weights, slope, constant, steep = [0.0] * size, [0.0] * size, 0.0, 0.0
    for _ in range(600):
        g, total = [0.02 * w for w in weights], 0.0
        for features, label in zip(found, soft):
            miss = logistic(constant + sum(weights[t] for t in features)) - label
            total += miss
            for t in features:
                g[t] += miss
        for t in range(size):
            slope[t] += g[t] ** 2
            weights[t] -= 0.5 * g[t] / math.sqrt(slope[t] + 1e-9)
        steep += total**2
        constant -= 0.5 * total / math.sqrt(steep + 1e-9)
    return weights, constant


# With four toxic texts no term is learned; the path is the same.
@pytest.mark.parametrize("n_toxic, learned", [(60, True), (8, False)])
def test_scores_equal_plain_loops(spark, n_toxic, learned):
    rows = corpus(n_toxic)
    path = scratch_dir(spark, "toxic")
    spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    labels = spark.createDataFrame([(i, t) for i, _, t in rows if t is not None], "doc_id long, toxic int")
    classifier = tox.train(docs, labels, F.lit(True))
    terms = classifier.terms
    assert (len(terms.hashes) > len(tox.INSULTS.split())) == learned
    seen = [features(text, terms) for _, text, _ in rows]
    given = [-1 if t is None else t for _, _, t in rows]
    soft = label_model([v for _, v in seen], given)
    weights, constant = regression([sorted(f) for f, _ in seen], soft, terms.size)
    expected = {i: logistic(constant + sum(weights[t] for t in f)) for (i, _, _), (f, _) in zip(rows, seen)}
    found = {r.doc_id: r.score for r in tox.score(docs, classifier).collect()}
    assert found == pytest.approx(expected, abs=1e-6)
    caught = [i for i in found if found[i] >= tox.THRESHOLD]
    assert set(range(n_toxic)) <= set(caught) if learned else set(caught) <= set(range(240))


def test_without_toxic_labels_nothing_is_toxic(spark):
    docs = spark.createDataFrame([(1, "you idiot"), (2, None), (3, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    found = tox.score(docs, tox.train(docs, labels, F.lit(True))).collect()
    assert [r.predicted for r in found] == [0, 0, 0]
