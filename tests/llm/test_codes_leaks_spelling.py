"""Vector codes, benchmark decontamination and spelling variants against brute force."""

from __future__ import annotations

import collections
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from civicflow.llm import decontamination, spelling, vector_codes
from civicflow.session import scratch_dir

VECTORS = "vec_id long, embedding array<float>, label int, codes string, error string"
DOCS = "doc_id long, text string, key string, items string, spans int, word string"
ITEMS = "item_id long, text string, hash string, words int, family string"


def saved(spark, rows, schema, parts=3):
    path = scratch_dir(spark, "rows")
    spark.createDataFrame(rows, schema).repartition(parts).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


# --- vector codes --------------------------------------------------------------------------


def plain_codes(rows, parts, entries, rounds):
    """Codes and errors by comparing everything with everything, in Python integers."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = [[r[1][p * len(r[1]) // parts : (p + 1) * len(r[1]) // parts] for p in range(parts)] for r in rows]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        squares = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in books[p]]
        return squares.index(min(squares)), min(squares)

    for step in range(rounds + 1):
        found = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
        for p in range(parts) if step < rounds else ():
            for j in range(len(books[p])):
                own = [c[p] for c, f in zip(cut, found) if f[p][0] == j]
                if own:
                    books[p][j] = [sum(x) // len(own) for x in zip(*own)]
    flat = [str(x) for book in books for entry in book for x in entry]
    return [(r[0], tuple(j for j, _ in f), sum(d for _, d in f)) for r, f in zip(rows, found)], flat


def some_vectors():
    chance = np.random.default_rng(3)
    centres = chance.normal(size=(12, 12))
    vectors = [(centres[i % 12] + 0.3 * chance.normal(size=12)) * (30 if i == 70 else 1) for i in range(300)]
    rows = [(int(i), [float(x) for x in v], int(i) % 3) for i, v in zip(chance.permutation(300), vectors)]
    rows += [(5, rows[9][1], None), (400, rows[9][1], 1), (None, rows[3][1], 1), (401, [0.0] * 12, None), (402, [-1e-9] * 12, 2)]
    return rows


@pytest.mark.parametrize("entries, rounds", [(16, 0), (16, 2), (16, 5), (3, 3), (1, 2), (1000, 2)])
def test_codes_equal_comparing_everything(spark, entries, rounds):
    rows = some_vectors()
    odd = [(500, None, 1), (501, [1.0, None] * 6, 1), (502, [float("nan")] * 12, 1), (503, [float("inf")] * 12, 1)]
    unfit = [(504, [1.0] * 8, 1), (505, [1e9] * 12, 1), (506, [], None)]
    vectors = saved(spark, [(*r, "x", "y") for r in rows + odd + unfit], VECTORS)
    codes, books = vector_codes.compress(vectors, parts=4, entries=entries, rounds=rounds)
    whole = [(r[0], np.floor(256 * np.array(r[1], np.float32).astype(float)).astype(int).tolist()) for r in rows]
    expected, flat = plain_codes(whole, 4, entries, rounds)
    kind = "u1" if min(entries, len(whole)) <= 256 else "<u2"
    coded = codes.where("codes is not null").collect()
    found = collections.Counter((r.vec_id, tuple(np.frombuffer(r.codes, kind).tolist()), r.error) for r in coded)
    assert found == collections.Counter(expected)
    assert ",".join(map(str, books.entries.ravel().tolist())) == ",".join(flat)
    left = {r.vec_id: (r.codes, r.error) for r in codes.where("codes is null").collect()}
    assert left == {i: (None, None) for i in (504, 505, 506)}
    row = codes.where("vec_id = 401").first()
    gap = books.decode(row.codes)  # the vector itself is all zeros
    assert int((gap * gap).sum()) == row.error


def test_fewer_kept_bounds_change_nothing():
    """Bounds decide what is compared, never what is found, however few are kept."""
    chance = np.random.default_rng(1)
    x, book = chance.integers(-200, 200, (500, 3)), chance.integers(-200, 200, (20, 3))
    for b in (1, 2, 7, 20):
        _, near, bounds = vector_codes.assign_all(x, book, b)
        moving = book
        for spread in (0, 3, 40, 400):
            after = moving + chance.integers(-spread, spread + 1, book.shape)
            moved = np.sqrt(((after - moving) ** 2).sum(axis=1))
            stored = vector_codes._up(vector_codes._down(bounds))
            assert (stored <= bounds).all()
            best, near, bounds, needed = vector_codes.reassign(x, after, moved, near, stored)
            squares = ((x[:, None] - after[None]) ** 2).sum(axis=2)
            assert (near[:, 0] == squares.argmin(axis=1)).all() and (best == squares.min(axis=1)).all()
            true = np.sqrt(np.take_along_axis(squares, near, 1))
            assert (bounds[:, :-1] <= true[:, 1:] + 1e-6).all()
            others = np.where((near[:, :, None] == np.arange(20)).any(axis=1), np.inf, np.sqrt(squares)).min(axis=1)
            assert (bounds[:, -1] <= others + 1e-6).all()
            assert needed.max() <= b
            moving = after
    # With entries at rest nothing but the nearest one is looked at.
    _, near, bounds = vector_codes.assign_all(x, book, 7)
    *_, needed = vector_codes.reassign(x, book, np.zeros(20), near, vector_codes._up(vector_codes._down(bounds)) + 0.0)
    assert (needed == 0).mean() > 0.9


def test_b_follows_the_bounds_that_were_needed():
    assert vector_codes._adapted(np.array([90, 5, 4, 1, 0, 0, 0, 0, 50]), 64, 8) == 8
    assert vector_codes._adapted(np.array([900, 99, 1] + [0] * 14 + [300]), 64, 16) == 8
    assert vector_codes._adapted(np.array([0] * 12 + [100] + [0] * 4 + [3]), 64, 16) == 13
    assert vector_codes._adapted(np.array([0, 7]), 4, 1) == 1


def test_no_vectors_give_no_codebooks(spark):
    codes, books = vector_codes.compress(saved(spark, [], VECTORS))
    assert codes.count() == 0 and books is None
    codes, books = vector_codes.compress(saved(spark, [(1, [1.0] * 15, 2, "", "")], VECTORS))
    assert [(r.vec_id, r.codes) for r in codes.collect()] == [(1, None)] and books is None


def test_label_errors_add_up_by_label(spark):
    rows = [(i, [float(i % 7), float(i)], None if i % 3 == 0 else i % 2, "", "") for i in range(40)]
    codes, _ = vector_codes.compress(saved(spark, rows, VECTORS), parts=2, entries=4)
    found = vector_codes.with_label_errors(codes).collect()
    sums = collections.Counter()
    for r in found:
        sums[r.label] += r.error
    assert len(found) == 40 and all(r.label_error == sums[r.label] for r in found)


# --- decontamination -----------------------------------------------------------------------

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain_scan(docs, items, size):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(len(w), size)
        for i in range(len(w) - n + 1) if w else ():
            windows[tuple(w[i : i + n])].add(item)
    out = []
    for doc, text in docs:
        w, hit, names = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    names |= windows[tuple(w[i : i + n])]
        out.append((doc, len(w), len(hit), sorted(str(x) for x in names if x is not None), hit))
    return out


def leaky():
    chance = random.Random(2)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "日本", "x9", "İ", "ſ"]

    def prose(n, between=" "):
        return between.join(chance.choice(vocabulary) for _ in range(n))

    shared = prose(12)
    items = [(1, prose(30)), (2, "A short One!"), (3, shared), (4, shared + " " + prose(9)), (5, None), (6, "?!"), (7, ""), (None, prose(15))]
    items += [(8, "solo"), (3, prose(11)), (10, prose(25)), (9, "été été"), (11, prose(10))]
    docs = [(i, prose(chance.randrange(1, 90))) for i in range(40)]
    texts = [t for _, t in items if t]
    docs += [(100 + i, prose(20) + ", " + t.upper().replace(" ", "--") + "; " + prose(20)) for i, t in enumerate(texts)]
    docs += [(200 + i, t) for i, t in enumerate(texts)] + [(300, " ".join(texts * 3)), (301, " ".join(["a short one"] * 50))]
    docs += [(400, None), (401, ""), (402, "..."), (None, texts[0]), (None, None), (403, prose(20000)), (300, texts[2]), (200, texts[0])]
    return docs, items


@pytest.mark.parametrize("size, bounds", [(10, {}), (10, {"max_windows": 7}), (3, {"max_bytes": 400}), (1, {})])
def test_leaks_equal_comparing_all_windows(spark, size, bounds):
    docs, items = leaky()
    table = saved(spark, [(*d, "k", "i", 1, "w") for d in docs], DOCS)
    tests = saved(spark, [(*i, "h", 1, "f") for i in items], ITEMS)
    found = decontamination.scan(table, tests, size, **bounds).collect()
    expected = plain_scan(docs, items, size)
    rows = collections.Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in found)
    assert rows == collections.Counter((d, n, len(h), tuple(names)) for d, n, _, names, h in expected)
    hits = {(r.doc_id, r.n_words): {i for s in r.spans for i in range(s.start, s.end)} for r in found}
    assert all(hits[d, n] == h for d, n, _, _, h in expected)
    for r in found:  # spans neither touch nor overlap
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_hits_are_taken_out_and_nothing_else(spark):
    docs, items = leaky()
    table = saved(spark, [(*d, "k", "i", 1, "w") for d in docs], DOCS)
    tests = saved(spark, [(*i, "h", 1, "f") for i in items], ITEMS)
    expected = {(d, t): (h, words(t)) for (d, t), (_, _, _, _, h) in zip(docs, plain_scan(docs, items, 10))}
    kept = decontamination.decontaminate(table, tests, "documents").collect()
    assert sorted(map(repr, ((r.doc_id, r.text) for r in kept))) == sorted(repr(d) for d in docs if not expected[d][0])
    cut = decontamination.decontaminate(table, tests)
    assert cut.columns == table.columns
    clean = collections.Counter(d for d in docs if not expected[d][0])
    found = collections.Counter((r.doc_id, r.text) for r in cut.collect())
    assert not clean - found
    left = collections.Counter((d, tuple(words(t))) for d, t in (found - clean).elements())
    assert left == collections.Counter((d, tuple(w for i, w in enumerate(e[1]) if i not in e[0])) for (d, t), e in ((d, expected[d]) for d in docs) if e[0])
    row = spark.createDataFrame([("(A b, c; D e!", [(1, 3)])], "text string, spans array<struct<start:int,end:int>>")
    assert row.select(decontamination.without_spans(F.col("text"), F.col("spans")).alias("t")).first().t == "(A D e!"
    with pytest.raises(ValueError):
        decontamination.decontaminate(table, tests, "lines")


def test_empty_tables_have_no_leaks(spark):
    docs, tests = saved(spark, [(1, "a b", "", "", 0, "")], DOCS), saved(spark, [], ITEMS)
    assert [(r.doc_id, r.n_words, r.n_hit, r.spans, r["items"]) for r in decontamination.scan(docs, tests).collect()] == [(1, 2, 0, [], [])]
    assert decontamination.scan(saved(spark, [], DOCS), tests).count() == 0


def test_the_probe_is_compiled_and_texts_are_not_shuffled(spark):
    docs, items = leaky()
    table = saved(spark, [(*d, "k", "i", 1, "w") for d in docs], DOCS)
    tests = saved(spark, [(*i, "h", 1, "f") for i in items], ITEMS)
    windows, _ = decontamination.test_windows(tests)
    rows = table.select(F.col("key"), decontamination.words_of(F.col("text")).alias("words"))
    plan = decontamination.find_hits(rows, windows)._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("BroadcastHashJoin") :]
    assert "BroadcastHashJoin [hash" in plan and "Exchange hashpartitioning" not in join
    assert "Generate posexplode(hashes" in plan  # no lambda inside the generator
    assert "Python" not in plan and "Arrow" not in plan and plan.count("split(") == 1


# --- spelling variants ---------------------------------------------------------------------


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(counts):
    out = {}
    for w, n in counts.items():
        others = [v for v in counts if near(w, v)]
        form = min(others, key=lambda v: (-counts[v], v)) if others else None
        if form is not None and counts[form] < 2 * n:
            form = None
        out[w] = [n, len(others), form, counts.get(form)]
    for w, row in out.items():
        root = w
        while out[root][2]:
            root = out[root][2]
        row.append(root)
    return {w: tuple(row) for w, row in out.items()}


def some_words():
    chance = random.Random(9)
    words = {"".join(chance.choice("abé") for _ in range(chance.randrange(5, 9))) for _ in range(150)}
    words |= {"aaaaa", "aaaaaa", "aaaaaaa", "ababab", "bababa", "ÿÀÿÀÿ", "z" * 300, "z" * 299, "z" * 298 + "y", "same" * 5}
    words |= {"prefix" + c + d for c in "abcdefgh" for d in "abcdefgh"}
    return {w: 2 ** chance.randrange(1, 12) for w in words}


@pytest.mark.parametrize("group_letters", [1 << 18, 1])
def test_variants_equal_comparing_all_words(spark, group_letters):
    counts = some_words()
    vocabulary = saved(spark, [(w, n, 1) for w, n in counts.items()], "word string, n long, size int").select("word", "n")
    found = spelling.variants(vocabulary, group_letters=group_letters).collect()
    assert len(found) == len(counts)
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in found} == plain_variants(counts)


def test_each_pair_is_found_once(spark):
    counts = some_words()
    vocabulary = saved(spark, list(counts.items()), "word string, n long")
    for group_letters in (1 << 18, 1):
        links = [(r.word, r.near) for r in spelling.near_words(vocabulary, group_letters=group_letters).collect()]
        assert sorted(links) == sorted((a, b) for a in counts for b in counts if near(a, b))


@pytest.mark.parametrize("piece", [1 << 20, 7])
def test_words_are_counted_whole(spark, monkeypatch, piece):
    texts = ["Tables tables TABLES tablesÉ", "naïve Naïve ×÷×÷× ab abcd", None, "", "tables,tables;tables 日本tables", "x" * 5000 + " x", "Éabcd éabcd " * 3]
    docs = [(i, t, "k", "i", 1, "w") for i, t in enumerate(texts)] + [(None, "tables " * 400, "", "", 0, "")] + [(0, texts[0], "", "", 0, "")] * 2
    for change in (None, spelling.misspell):
        expected = collections.Counter()
        for doc, text, *_ in docs:
            for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
                run = run.translate(LOWER)
                h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
                if change and h % 97 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                expected[run] += len(run) >= 5
        if piece == 7:
            monkeypatch.setattr(spelling, "PIECE_CHARS", piece)
            cut = collections.Counter()
            for batch in spelling._counter(change, 5)(iter([arrow(docs)])):
                cut.update(dict(zip(*batch.to_pydict().values())))
            assert cut == +expected
        else:
            found = spelling.count_words(saved(spark, docs, DOCS), change, least_count=1)
            assert {r.word: r.n for r in found.collect()} == dict(+expected)


def arrow(docs):
    import pyarrow as pa

    names = [None if d[0] is None else str(d[0]) for d in docs]
    return pa.record_batch([pa.array(names, pa.string()), pa.array([d[1] for d in docs], pa.string())], names=["doc_id", "text"])


def test_no_words_have_no_variants(spark):
    assert spelling.variants(spelling.count_words(saved(spark, [], DOCS))).count() == 0
    rows = spelling.variants(saved(spark, [("alone", 3)], "word string, n long")).collect()
    assert [tuple(r) for r in rows] == [("alone", 3, 0, None, None, "alone")]
