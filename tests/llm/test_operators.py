"""Each operator against a brute-force version, on rows that are hard on purpose."""

from __future__ import annotations

import collections
import functools
import math
import random
import types
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from conftest import SF_DIR
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from civicflow.llm import (
    near_dup,
    near_vectors,
    packing,
    pieces,
    ppm,
    substring_dedup,
    token_files,
    tokens,
    topk,
    toxicity,
)
from civicflow.llm.components import components
from civicflow.session import scratch_dir

DOCS = "doc_id long, text string, unit string, rest long, sequence_id string, n_words int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def some_texts() -> list[str | None]:
    chance = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)] + ["Été", "naïve", "x\x1cy", "日本語"]

    def words(n):
        return " ".join(chance.choice(vocabulary) for _ in range(n))

    passage, base = words(60), words(120)
    texts: list[str | None] = [None, "", "   \n\t ", "one", "one two three", "A b\tC  d\r\ne\x0bf\n", "\0nul \0", "<|endoftext|> </s>"]
    texts += [words(5), words(4), words(5000), words(300) + "\n" + passage, passage, passage + " " + words(40)]
    texts += [base, base, base.upper(), base.replace(" ", "\n"), base + " tail", "head " + base, words(20) + " " + base]
    for _ in range(30):
        near = base.split()
        near[chance.randrange(120)] = "changed"
        near[chance.randrange(120)] = chance.choice(vocabulary)
        texts.append(" ".join(near))
    texts += [words(chance.randrange(1, 60)) + " " + passage[: chance.randrange(40, 200)] for _ in range(40)]
    texts += ["a " * 100, "z" * 5000, "q" * 40 + " " * 30 + "r", " ".join(["same"] * 45)]
    return texts


TEXTS = some_texts()


@pytest.fixture(scope="module")
def docs(spark):
    """Rows with clashing extra columns, one id twice, one row twice, two rows without id."""
    rows = [(i, t, "u", i, "s", 0) for i, t in enumerate(TEXTS)]
    rows += [(20, TEXTS[20], "u", 1, "s", 0), (20, "another text under the same id", None, None, None, None)]
    rows += [(None, TEXTS[14], "u", 0, "s", 0), (None, None, None, None, None, None)]
    random.Random(3).shuffle(rows)
    path = scratch_dir(spark, "docs")
    spark.createDataFrame(rows, DOCS).repartition(5).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    path = scratch_dir(spark, "empty")
    spark.createDataFrame([], DOCS).write.parquet(path)
    return spark.read.schema(DOCS).parquet(path)


def rows_of(docs) -> list[tuple[int | None, str | None]]:
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def ids_by(tokenizer: str, text: str | None, end: int) -> np.ndarray:
    known = Tokenizer.from_file(public_tokenizers.path(tokenizer))
    known.encode_special_tokens = True
    return np.array(known.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


# --- components ------------------------------------------------------------------------


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 60)] + [(70, 70), (71, 72), (72, 71)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 100 for i in range(101, 161)} | {i: 5 for i in range(6, 60)} | {72: 71}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- toxicity --------------------------------------------------------------------------


def test_toxicity_learns_from_labels_of_training_rows_only(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR[:-5]}0.01/{t}.parquet") for t in ("documents", "labels"))
    learn = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    first = toxicity.train(docs, labels, learn)
    hidden = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    second = toxicity.train(docs, hidden, learn)
    assert np.array_equal(first.terms.hashes, second.terms.hashes) and np.allclose(first.weights, second.weights)
    scored = toxicity.score(docs, first).join(labels.select("doc_id", "toxic"), "doc_id").where(~learn)
    rows = scored.select("score", "toxic", "predicted").collect()
    good, bad = ([r.score for r in rows if r.toxic == k] for k in (0, 1))
    assert np.mean([(b > g) + (b == g) / 2 for b in bad for g in good]) > 0.75
    assert all(r.predicted == (r.score >= 0.3) for r in rows)
    assert not any(r.predicted for r in rows if not r.toxic)


def test_toxicity_scores_odd_rows_and_survives_missing_labels(spark, docs, empty):
    labels = spark.createDataFrame([(1, None), (2, 7)], "doc_id long, toxic int")
    classifier = toxicity.train(docs, labels, F.lit(True))
    scored = toxicity.score(docs.withColumn("score", F.lit("old")), classifier)
    assert scored.count() == docs.count() and set(docs.columns) < set(scored.columns)
    assert all(0 <= r.score <= 1 and not r.predicted for r in scored.collect())
    assert toxicity.score(empty, toxicity.train(empty, labels, F.lit(True))).count() == 0


def test_toxicity_with_too_few_toxic_labels_for_terms(spark):
    chance = random.Random(6)
    plain = [" ".join(chance.choice(TEXTS[10].split()) for _ in range(40)) for _ in range(300)]
    texts = [t + (" you pathetic idiot !!" if i % 10 == 0 else "") for i, t in enumerate(plain)]
    path = scratch_dir(spark, "few-labels")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(path)
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(35)], "doc_id long, toxic int")
    docs = spark.read.parquet(path)
    rows = toxicity.score(docs, toxicity.train(docs, labels, F.lit(True))).collect()
    assert {r.doc_id for r in rows if r.predicted} == set(range(0, 300, 10))


def test_label_model_recovers_voters():
    chance = np.random.default_rng(1)
    toxic = chance.random(20000) < 0.1
    hit = np.where(toxic, 0.7, 0.002)[:, None]
    fired = chance.random((20000, toxicity.LEXICONS)) < hit
    number = fired.sum(axis=1, keepdims=True)
    more = [number == 0, chance.random((20000, 2)) < 0.2]
    fired = np.concatenate([fired & (number > 1), fired & (number == 1), *more], axis=1)
    votes = (fired << np.arange(toxicity.VOTERS)).sum(axis=1)
    patterns, counts = np.unique(votes, return_counts=True)
    labelled = np.stack([np.array([(toxic[:500][votes[:500] == p] == k).sum() for p in patterns]) for k in (0, 1)], axis=1)
    model = toxicity.LabelModel(patterns, counts.astype(float), labelled.astype(float))
    wrong = (model.posterior(votes) > 0.5) != toxic
    assert wrong.mean() < 0.002


# --- substring dedup -------------------------------------------------------------------


def repeats(rows: list[tuple[int | None, str | None]]) -> list[tuple]:
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for at in range(len(words) - 19):
            window = tuple(words[at : at + 20])
            if window in seen:
                gone[at : at + 20] = [True] * 20
            seen.add(window)
        out.append((doc_id, len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("unit_bytes", [1 << 30, 2000])
def test_substring_dedup_keeps_first_occurrences(docs, unit_bytes):
    found = substring_dedup.remove_repeats(docs, unit_bytes)
    got = [(r.id, r.n_words, sum(s.end - s.start for s in r.removed), r.kept_text) for r in found.collect()]
    assert sorted(got, key=repr) == repeats(rows_of(docs))


def test_substring_dedup_carries_columns_and_takes_nothing(docs, empty):
    found = substring_dedup.remove_repeats(docs).select("rest.*")
    names = [c for c in docs.columns if c not in ("doc_id", "text")]
    assert sorted(map(repr, found.collect())) == sorted(map(repr, docs.select(*names).collect()))
    assert substring_dedup.remove_repeats(empty).count() == 0


# --- top-k -----------------------------------------------------------------------------


def some_vectors(n: int, size: int = 16) -> list[tuple]:
    chance = np.random.default_rng(4)
    rows = [(i, chance.normal(0, 0.3, size).tolist(), int(i % 3)) for i in range(n)]
    same = rows[0][1]
    rows += [(1000 + i, same, 0) for i in range(20)] + [(1100 + i, (np.array(same) + chance.normal(0, 0.02, size)).tolist(), 0) for i in range(30)]
    rows += [(2000, None, 0), (2001, [], 0), (2002, [0.0] * size, 0), (2003, [None] + same[1:], 0), (2004, [math.nan] + same[1:], 0)]
    rows += [(2005, [math.inf] + same[1:], 0), (2006, same, None), (2007, same[:5], 0), (2010, [0.5], 0), (7, rows[8][1], 1), (None, same, 0)]
    return rows


VECTORS = "vec_id long, embedding array<float>, label int, node string, n string, values int"


@pytest.fixture(scope="module")
def vectors(spark):
    path = scratch_dir(spark, "vectors")
    rows = [(*r, "x", "y", 1) for r in some_vectors(400)]
    spark.createDataFrame(rows, VECTORS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def test_top_k_is_exact(spark, vectors, monkeypatch):
    found = topk.top_k(vectors, F.col("id") % 10 == 0, 5).collect()
    usable = []
    for r in vectors.collect():
        e = r.embedding
        if r.vec_id is not None and e and all(x is not None and math.isfinite(x) for x in e):
            usable.append((r.vec_id, [math.floor(256 * x) for x in e]))
    expected = []
    for q, query in usable:
        if q % 10 == 0:
            scores = [(-sum(a * b for a, b in zip(query, v)), i) for i, v in usable if i != q and len(v) == len(query)]
            expected += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:5])]
    assert sorted(tuple(r) for r in found) == sorted(expected)
    assert topk.top_k(vectors.where("false"), F.col("id") % 10 == 0).count() == 0


def test_search_may_stop_early_and_stays_exact():
    chance = np.random.default_rng(2)
    values = np.floor(chance.normal(0, 32, (4000, 64))).astype(np.int64)
    values[100:140] = values[99]
    shard = topk.Shard(np.arange(4000), values)
    for q in (0, 99, 1234):
        ids, scores = shard.best(values[q], q, 5)
        whole = values @ values[q]
        order = [i for i in np.lexsort((np.arange(4000), -whole)) if i != q][:5]
        assert ids.tolist() == order and scores.tolist() == whole[order].tolist()
    assert shard.best(np.zeros(64, np.int64), 0, 3)[0].tolist() == [1, 2, 3]


@pytest.mark.parametrize("scale", [1 << 17, 1 << 22, 1 << 27])
def test_search_is_exact_for_large_components(scale):
    """Scores of 2**43 and more, and such where the bounds would leave 64 bits."""
    chance = np.random.default_rng(4)
    values = np.floor(chance.normal(0, scale, (4000, 64))).astype(np.int64)
    values[100:140] = values[99]
    shard = topk.Shard(np.arange(4000), values)
    for q in (0, 99, 1234):
        ids, scores = shard.best(values[q], q, 5)
        whole = [sum(a * b for a, b in zip(v, values[q].tolist())) for v in values.tolist()]
        order = sorted((i for i in range(4000) if i != q), key=lambda i: (-whole[i], i))[:5]
        assert ids.tolist() == order and scores.tolist() == [whole[i] for i in order]


# --- near-duplicate vectors ------------------------------------------------------------


def test_near_vectors_match_all_pairs(vectors, monkeypatch):
    rows = vectors.select("vec_id", "embedding", "label").collect()
    usable = [
        (k, r, np.array(r.embedding, float))
        for k, r in enumerate(rows)
        if r.label is not None and r.embedding and all(x is not None and math.isfinite(x) for x in r.embedding) and any(r.embedding)
    ]
    links, number = [], collections.Counter()
    for x, (k, r, v) in enumerate(usable):
        for m, s, w in usable[x + 1 :]:
            if r.label == s.label and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.93:
                number.update([k, m])
                links.append((r.vec_id, s.vec_id))
    root = {r.vec_id: r.vec_id for r in rows if r.vec_id is not None}
    for _ in range(len(root)):
        for a, b in links:
            if a is not None and b is not None:
                root[a] = root[b] = min(root[a], root[b])
    expected = sorted((repr(r.vec_id), number[k], repr(root.get(r.vec_id))) for k, r in enumerate(rows))
    monkeypatch.setattr(near_vectors, "BLOCK_ROWS", 8)
    found = near_vectors.near_duplicates(vectors).collect()
    assert sorted((repr(r.vec_id), r.n_links, repr(r.component_id)) for r in found) == expected
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in found)
    assert near_vectors.near_duplicates(vectors.where("false")).count() == 0


# --- token files -----------------------------------------------------------------------


def test_token_files_round_trip(spark, docs, empty):
    for number, table in enumerate((docs, empty)):
        path = scratch_dir(spark, f"ids-{number}")
        token_files.write_ids(table, path, public_tokenizers.path("byte_bpe_50k.json"), 2)
        rows = sorted(token_files.read_ids(spark, path).collect(), key=lambda r: r.start)
        expected = sorted((repr(i), ids_by("byte_bpe_50k.json", t, 2).tobytes()) for i, t in rows_of(table))
        assert sorted((repr(r.doc_id), bytes(r.ids)) for r in rows) == expected
        keys = [-1 if r.doc_id is None else r.doc_id for r in rows]
        assert keys == sorted(keys)
        assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:k]) for k in range(len(rows))]


def test_code_lengths_are_limited_and_optimal():
    counts = {i: 2**i for i in range(12)}
    free, limited = token_files.code_lengths(counts, 16), token_files.code_lengths(counts, 5)
    assert sorted(free.values()) == [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 11]
    assert max(limited.values()) == 5 and sum(2.0**-b for b in limited.values()) <= 1
    assert token_files.code_lengths({}) == {} and token_files.code_lengths({9: 4}) == {9: 1}
    with pytest.raises(ValueError):
        token_files.code_lengths(counts, 3)
    code = token_files.Code(limited)
    numbers = np.array([1, 400, 128, 129])
    ids = np.random.default_rng(0).integers(0, 12, numbers.sum())
    data, size, marks = code.encode(ids, np.cumsum(numbers))
    lanes = -(-numbers // token_files.CHECKPOINT)
    begin = marks + np.repeat((np.cumsum(size) - size) * 8, lanes)
    nth = np.concatenate([np.arange(n) for n in lanes])
    count = np.minimum(np.repeat(numbers, lanes) - nth * token_files.CHECKPOINT, token_files.CHECKPOINT)
    assert np.array_equal(code.decode(np.frombuffer(data, np.uint8), begin, count), ids)


# --- prediction by partial matching ----------------------------------------------------


def ppm_by_hand(training: list[bytes], order: int):
    counts: dict[tuple, collections.Counter] = collections.defaultdict(collections.Counter)
    for text in training:
        symbols = [256] * order + list(text.translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)))) + [256]
        for at in range(order, len(symbols)):
            for k in range(order + 1):
                counts[tuple(symbols[at - k : at])][symbols[at]] += 1

    def score(text: bytes) -> float:
        symbols = [256] * order + list(text) + [256]
        total = 0.0
        for at in range(order, len(symbols)):
            excluded: set[int] = set()
            for k in range(order, -2, -1):
                if k < 0:
                    total -= math.log10(257 - len(excluded))
                    break
                seen = counts.get(tuple(symbols[at - k : at]))
                if not seen:
                    continue
                left = {s: n for s, n in seen.items() if s not in excluded}
                if not left:
                    continue
                whole = sum(left.values()) + len(left)
                if symbols[at] in left:
                    total += math.log10(left[symbols[at]] / whole)
                    break
                total += math.log10(len(left) / whole)
                excluded |= set(left)
        return total

    return score


def test_ppm_matches_a_plain_version(spark, docs):
    learn = F.col("doc_id") % 3 != 0
    got = ppm.score(docs, learn).collect()
    rows = rows_of(docs)
    training = [(t or "").translate(LOWER).encode() for i, t in rows if i is not None and i % 3]
    by_hand = ppm_by_hand(training, ppm.ORDER)
    counts = collections.Counter(w for t in training for w in [*t.split(), "end"])
    tokens, distinct = sum(counts.values()), len(counts)
    expected = collections.defaultdict(list)
    for i, t in rows:
        text = (t or "").translate(LOWER).encode()
        words = [*text.split(), "end"]
        base = sum(math.log10((counts[w] + 1) / (tokens + distinct + 1)) for w in words)
        expected[i].append((len(words), sum(counts[w] > 0 for w in words), base, by_hand(text)))
    for r in got:
        assert r.train_tokens == tokens and r.learned == (r.doc_id is not None and r.doc_id % 3 != 0)
        assert any(
            (r.n_tokens, r.n_known) == e[:2] and math.isclose(r.base_score, e[2], rel_tol=1e-9) and math.isclose(r.score, e[3], rel_tol=1e-4, abs_tol=1e-3)
            for e in expected[r.doc_id]
        )
    assert len(got) == len(rows)


def test_ppm_keeps_all_contexts(spark, monkeypatch):
    """More contexts than any one task takes, and texts of many pieces."""
    monkeypatch.setattr(ppm, "TASK_GRAMS", 1 << 13)
    monkeypatch.setattr(ppm.U, "units_for", lambda docs: (docs, 9))
    chance = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789 "
    texts = ["".join(chance.choices(letters, k=chance.randrange(3000))) for _ in range(40)]
    # Seen once in training, so the first to go under a cap; long, so a cap shows in their scores.
    texts += texts[1:4]
    path = scratch_dir(spark, "contexts")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3).write.parquet(path)
    got = {r.doc_id: r.score for r in ppm.score(spark.read.parquet(path), F.col("doc_id") < 40).collect()}
    by_hand = ppm_by_hand([t.encode() for t in texts[:40]], ppm.ORDER)
    contexts = {t[max(0, at - k) : at] for t in texts for at in range(len(t)) for k in range(1, ppm.ORDER + 1)}
    assert len(contexts) > 1 << 17 and len(got) == len(texts)
    assert all(math.isclose(got[i], by_hand(t.encode()), rel_tol=1e-5) for i, t in enumerate(texts))


def test_ppm_grams_do_not_depend_on_pieces(monkeypatch):
    texts = [(t or "").encode() for t in TEXTS]
    whole = np.concatenate(list(ppm._pieces(texts)))
    monkeypatch.setattr(ppm, "PIECE", 7)
    assert np.array_equal(whole, np.concatenate(list(ppm._pieces(texts))))


def test_ppm_without_training_or_rows(docs, empty):
    rows = ppm.score(docs, F.lit(False)).collect()
    lengths = {i: len((t or "").encode()) for i, t in enumerate(TEXTS) if i != 20}
    assert all(math.isclose(r.score, -(lengths[r.doc_id] + 1) * math.log10(257), rel_tol=1e-5) for r in rows if r.doc_id in lengths)
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in rows)
    assert ppm.score(empty, F.lit(True)).count() == 0


# --- SentencePiece ---------------------------------------------------------------------


def test_sentencepiece_equals_the_library(docs, empty, monkeypatch):
    model = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    found = pieces.decode(pieces.encode(docs, model), model).collect()
    expected = [(repr(i), np.array(library.encode(t or ""), "<u4").tobytes(), t or "") for i, t in rows_of(docs)]
    assert sorted((repr(r.doc_id), bytes(r.ids), r.text) for r in found) == sorted(expected)
    assert pieces.encode(empty, model).count() == 0


@pytest.mark.parametrize("chunk", [33, 61, 200])
def test_chunks_combine_to_the_library_result(chunk, monkeypatch):
    monkeypatch.setattr(pieces, "CHUNK", chunk)
    vocabulary = pieces.pieces(public_tokenizers.path("piece_bpe_32k.model"))
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = [t for t in TEXTS if t] + ["internationalization" * 20, "日本語テキスト" * 20, " " * 90, "\n\n \n" * 20]
    for text in texts:
        text = text[:900]
        parts = [pieces.Chunk(vocabulary, part, margin) for _, part, margin in pieces._cut(text, 2 * vocabulary.longest)]
        matrices = []
        for part in parts:
            exits = part.matrix()
            relative = dict(zip(pieces._shift(exits, part.end), exits.values()))
            matrices.append(pieces.Matrix(pieces._shift(part.entries(), part.begin), relative))
        whole = functools.reduce(pieces.Matrix.times, matrices)
        (last,) = [s for s, bits in whole.exits.items() if s[0] == 0 and bits & 1]

        def multiplied(low, high):
            """The product of a stretch, grouped at random."""
            if high - low == 1:
                return matrices[low]
            at = chance.randrange(low + 1, high)
            return multiplied(low, at).times(multiplied(at, high))

        def ends_of(low, high, entry, last):
            if high - low == 1:
                return [(entry, last)]
            at = chance.randrange(low + 1, high)
            between = multiplied(low, at).middle(multiplied(at, high), entry, last)
            return ends_of(low, at, entry, between) + ends_of(at, high, between, last)

        chance = random.Random(chunk)
        for _ in range(3):
            assert multiplied(0, len(matrices)) == whole
        ends = ends_of(0, len(matrices), whole.entries[0], last)
        ids = [
            part.ids(*pieces._shift([a], -part.begin), *pieces._shift([b], -part.end)).tolist() for part, (a, b) in zip(parts, ends)
        ]
        assert sum(ids, []) == library.encode(text)


def test_long_documents_take_the_scan(spark, monkeypatch):
    chance = random.Random(8)
    long = "".join(chance.choice("theringato ") for _ in range(6 * pieces.CHUNK)) + "x" * 40
    docs = spark.createDataFrame([(1, long), (1, long), (2, "short"), (None, long + " ")], "doc_id long, text string")
    model = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    found = sorted((repr(r.doc_id), bytes(r.ids)) for r in pieces.encode(docs, model).collect())
    expected = [(repr(i), np.array(library.encode(t), "<u4").tobytes()) for i, t in ((1, long), (1, long), (2, "short"), (None, long + " "))]
    assert found == sorted(expected)


# --- packing ---------------------------------------------------------------------------


def test_packing_places_every_id_once(docs, empty):
    rows = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 256, 1, batch_tokens=3000).collect()
    wanted = collections.Counter((i, ids_by("word_bpe_49k.json", t, 1).tobytes()) for i, t in rows_of(docs))
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    by_doc = collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    single = {i for i, n in collections.Counter(i for i, _ in wanted).items() if n == 1}
    for (doc_id, ids), n in wanted.items():
        if doc_id in single and n == 1:
            parts = sorted(by_doc[doc_id], key=lambda r: r.start)
            assert b"".join(bytes(r.ids) for r in parts) == ids
            assert [r.start for r in parts] == [sum(p.length for p in parts[:k]) for k in range(len(parts))]
            assert {r.doc_tokens for r in parts} == {len(ids) // 4}
    assert sum(r.length for r in rows) == sum(n * len(ids) // 4 for (_, ids), n in wanted.items())
    assert packing.pack(empty, public_tokenizers.path("word_bpe_49k.json")).count() == 0


def packing_task(spark, monkeypatch, batch_tokens):
    """What a task of ``pack`` does with its Arrow batches."""

    class Rows:
        def select(self, *columns):
            return self

        def mapInArrow(self, work, schema):  # noqa: N802
            return work

    context = types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0))
    monkeypatch.setattr(packing, "TaskContext", context)
    return packing.pack(Rows(), public_tokenizers.path("word_bpe_49k.json"), 256, 1, batch_tokens)


def test_a_packing_task_holds_little_beside_its_batch(spark, monkeypatch):
    """It encodes about 2 MB of text at a time, cuts ids for one record batch at a time, and gives
    back what earlier tasks and each of its batches freed."""
    encoded, released, cut = [], [], []
    encode, record = tokens.Encoder.encode, pa.record_batch
    monkeypatch.setattr(tokens.Encoder, "encode", lambda *a: encoded.append(a[1].nbytes) or encode(*a))
    monkeypatch.setattr(packing, "release", lambda: released.append(len(encoded)), raising=False)
    monkeypatch.setattr(packing.pa, "record_batch", lambda *a, **b: cut.append(1) or record(*a, **b))
    texts = [" ".join(f"word{(i * j) % 900}" for j in range(1, 300)) for i in range(4000)]
    batch = record([pa.array(range(4000), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    out = packing_task(spark, monkeypatch, 1 << 22)(iter([batch, batch]))
    next(out)
    assert len(cut) == 1
    rest = list(out)
    assert len(cut) == 1 + len(rest) > 3
    assert len(encoded) > 6 and max(encoded) < 1.2 * 2**21
    assert released == [0, len(encoded) // 2, len(encoded)]


def test_parts_that_are_encoded_do_not_change_the_packing(spark, monkeypatch):
    """Batches of documents end where they did, however little is encoded at a time."""
    texts = [" ".join(f"word{(i * j) % 900}" for j in range(1, 200)) for i in range(6000)]
    batch = pa.record_batch([pa.array(range(6000), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    work, found = packing_task(spark, monkeypatch, 5000), []
    for size in (1 << 16, 1 << 20, 1 << 30):
        monkeypatch.setattr(packing, "ENCODED_BYTES", size, raising=False)
        found.append(pa.Table.from_batches(work(iter([batch]))))
    assert found[0].equals(found[1]) and found[1].equals(found[2])


def test_best_fit_takes_the_tightest_window():
    chance = random.Random(2)
    lengths = [chance.randrange(1, 100) for _ in range(300)]
    rooms: list[int] = []
    number = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fitting = [(room, w) for w, room in enumerate(rooms) if room >= lengths[i]]
        if fitting:
            _, w = min(fitting)
            rooms[w] -= lengths[i]
        else:
            rooms.append(100 - lengths[i])
        number.append(len(rooms))
    windows = packing.best_fit_decreasing(lengths, 100)
    assert len(windows) == len(rooms)
    assert sorted(100 - sum(lengths[i] for i in w) for w in windows) == sorted(rooms)
    placed = packing.place(lengths, 100)
    assert sum(sum(p[2] for p in w) < 100 for w in placed) <= 1


# --- MinHash near-dedup ----------------------------------------------------------------


def shingles(text: str | None) -> set:
    words = (text or "").translate(LOWER).encode().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_near_duplicates_match_all_pairs(docs, empty, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_ROWS", 8)
    monkeypatch.setattr(near_dup, "GROUP_ROWS", 4)
    rows = rows_of(docs)
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows if i is not None}
    links = [
        (i, j)
        for x, (i, s) in enumerate(sets)
        for j, t in sets[x + 1 :]
        if i is not None and j is not None and s and t and 100 * len(s & t) >= 75 * len(s | t)
    ]
    for _ in range(len(root)):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    expected = sorted((repr(i), len(s), repr(root.get(i)), i is None or root[i] == i) for i, s in sets)
    found = near_dup.near_duplicates(docs).collect()
    assert sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id), r.kept) for r in found) == expected
    assert near_dup.near_duplicates(empty).count() == 0


def test_signatures_estimate_similarity():
    chance = np.random.default_rng(3)
    common, rest = chance.integers(0, 2**63, 800, np.uint64), chance.integers(0, 2**63, 400, np.uint64)
    a, b = (near_dup.signature(np.unique(np.concatenate([common, rest[s]]))) for s in (slice(0, 200), slice(200, 400)))
    assert abs((a == b).mean() - 800 / 1200) < 0.2


# --- queries ---------------------------------------------------------------------------


def test_digests_of_packed_ids(spark):
    from civicflow.llm import queries

    rows = queries.op8_packing(spark, SF_DIR).where("doc_id = 3").orderBy("start").collect()
    text = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id = 3").first().text
    ids = ids_by("word_bpe_49k.json", text, 1)
    assert [r.ids_crc32 for r in rows] == [zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in rows]


def test_input_of_unknown_size_is_dealt_to_as_many_units(spark, docs):
    """Rows that come from no stored table are stored first, so they are not one unit and one task."""
    from civicflow.llm import units

    rows = docs.select("doc_id", "text")
    stored_docs, plain = units.units_for(rows, 4096)
    assert stored_docs is rows and plain > 3
    loose = spark.createDataFrame(rows.collect(), rows.schema)
    read, number = units.units_for(loose, 4096)
    assert number > 3 and sorted(map(str, read.collect())) == sorted(map(str, rows.collect()))
    found = {r.id: r.n_words for r in substring_dedup.remove_repeats(loose).collect() if r.id != 20}
    assert found == {r.id: r.n_words for r in substring_dedup.remove_repeats(rows).collect() if r.id != 20}
