"""Toxicity by weak supervision: many voters, a label model, a linear classifier.

1. Terms: on a bounded sample of labelled rows, words and beginnings of words whose documents are
   mostly toxic, by a lower confidence bound. Of texts that share their smallest or their largest
   shingle hash only one counts, so a family of copies is no evidence for its rare words.
2. Voters: a fixed lexicon, the learned terms dealt to lexicons by kind, and patterns of the text.
   A voter fires or abstains; a lexicon that fires alone counts as another voter, and one more
   fires when no lexicon does.
3. Label model: over all training rows, labelled or not, the frequency of every combination of
   fired voters. Starting from the labelled sample, expectation maximisation estimates how often
   each voter fires for either class; voters that agree beyond what the classes explain share
   their weight.
4. Classifier: logistic regression on the presence of terms, fitted to the posterior labels of a
   bounded sample; where a row has a label, that is one more vote. It scores every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.llm.components import stored
from civicflow.llm.near_dup import shingle_sets
from civicflow.llm.tokens import slices
from civicflow.llm.words import mix, word_hashes

# Bounds that ``train`` takes: labelled rows that terms are learned from, rows the classifier is
# fitted to, and terms it can have. Vote counts cover all rows.
LABELLED_ROWS = 20_000
FITTED_ROWS = 20_000
MAX_TERMS = 4_096
# A term has to be in so many toxic texts, and in this share of them.
MIN_DOCS = 5
MIN_SHARE = 0.005
THRESHOLD = 0.3

# Common insults.
INSULTS = (
    "clown disgusting fool garbage idiot imbecile jerk loser moron pathetic scum stupid trash vermin worthless"
)
# How often a given label is taken to be right.
LABEL_TRUST = 0.999
# First bytes of a word that are terms of their own; None is the whole word.
KINDS = (None, 4, 5, 6)
LEXICONS_PER_KIND = 3
LEXICONS = 1 + len(KINDS) * LEXICONS_PER_KIND
# A lexicon that fires alone is a voter of its own: it is right much less often.
ALONE = LEXICONS
NONE, SHOUTING, MARKS, VOTERS = range(2 * LEXICONS, 2 * LEXICONS + 4)

# Words are runs of letters: A-Z, a-z and every byte of characters beyond ASCII.
_BETWEEN = np.ones(256, bool)
_BETWEEN[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = False


def term_hashes(texts: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Words of each text, and for each kind one hash per word."""
    kinds = []
    for kind in KINDS:
        counts, hashes = word_hashes(texts, lower=True, between=_BETWEEN, longest=kind)
        kinds.append(mix(hashes + np.uint64(kind or 0)))
    return counts, kinds


def _texts(part: pa.RecordBatch, column: int) -> list[bytes]:
    return [(t or "").encode() for t in part.column(column).to_pylist()]


def _families(batches):
    """Rows (text, toxic) with the smallest and the largest shingle hash of the text."""
    for batch in batches:
        for part in slices(batch, 0):
            sets = shingle_sets(part.column(0).to_pylist())
            low, high = ([int(s[at]) - 2**63 if len(s) else 0 for s in sets] for at in (0, -1))
            yield pa.record_batch([*part.columns, pa.array(low), pa.array(high)], names=["text", "toxic", "low", "high"])


def _count_terms(batches):
    """Of rows (text, toxic): documents of each class that have a term."""
    for batch in batches:
        for part in slices(batch, 0):
            counts, kinds = term_hashes(_texts(part, 0))
            toxic = part.column(1).to_numpy()
            doc = np.repeat(np.arange(len(counts)), counts)
            for kind, hashes in enumerate(kinds):
                order = np.lexsort((doc, hashes))
                h, d = hashes[order], doc[order]
                fresh = np.ones(len(h), bool)
                fresh[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
                h, d = h[fresh], d[fresh]
                first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, int)
                number = np.diff(np.append(first, len(h)))
                bad = np.add.reduceat(toxic[d], first) if len(h) else number
                yield pa.record_batch(
                    [
                        pa.array(np.full(len(first), kind, np.int32)),
                        pa.array(h[first].view(np.int64)),
                        pa.array(bad.astype(np.int64)),
                        pa.array(number.astype(np.int64)),
                    ],
                    names=["kind", "term", "bad", "docs"],
                )


def _fixed_words() -> np.ndarray:
    """Hashes of the fixed lexicon, as whole words have them."""
    return np.unique(mix(word_hashes([INSULTS.encode()], between=_BETWEEN)[1]))


def _patterns(texts: list[bytes]) -> np.ndarray:
    """Of each text, whether it shouts and whether it has marks that stand for shouting."""
    fired = np.zeros((len(texts), 2), bool)
    for i, text in enumerate(texts):
        upper = len(text) - len(text.translate(None, _UPPER))
        fired[i] = upper * 2 > len(text), b"!!" in text or b"***" in text
    return fired


@dataclass
class Terms:
    """Terms in ascending order of their hashes, with the lexicon voter of each: learned ones, and
    the words of the fixed lexicon, whose voter is 0 where they were not learned too."""

    hashes: np.ndarray
    voter: np.ndarray

    def present(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term) of all terms that a text has, without repeats, and whether each text has a
        word of the fixed lexicon."""
        counts, kinds = term_hashes(texts)
        doc = np.repeat(np.arange(len(counts)), counts)
        found = []
        for hashes in kinds:
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            hit = np.flatnonzero(self.hashes[at] == hashes)
            found.append(doc[hit] * len(self.hashes) + at[hit])
        pairs = np.unique(np.concatenate(found))
        insults = np.bincount(doc[np.isin(kinds[0], _fixed_words())], minlength=len(texts)) > 0
        return pairs // len(self.hashes), pairs % len(self.hashes), insults

    @property
    def size(self) -> int:
        return len(self.hashes) + 2

    def features(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(text, feature) of the classifier, by text: the terms, and behind them the two patterns."""
        doc, term, _ = self.present(texts)
        text, pattern = np.nonzero(_patterns(texts))
        doc, term = np.append(doc, text), np.append(term, len(self.hashes) + pattern)
        order = np.argsort(doc, kind="stable")
        return doc[order], term[order]

    def votes(self, texts: list[bytes]) -> np.ndarray:
        """A bit for each voter that fires."""
        doc, term, insults = self.present(texts)
        votes = np.zeros(len(texts), np.int64)
        np.bitwise_or.at(votes, doc, np.int64(1) << self.voter[term])
        votes |= insults.astype(np.int64)
        votes = np.where(votes & (votes - 1), votes, np.where(votes, votes << ALONE, 1 << NONE))
        shouting, marks = _patterns(texts).T.astype(np.int64)
        return votes | shouting << SHOUTING | marks << MARKS


_UPPER = bytes(range(ord("A"), ord("Z") + 1))


def learn_terms(labelled: DataFrame, max_terms: int = MAX_TERMS) -> Terms:
    """Terms of ``labelled`` (text, toxic) whose documents are toxic more often than not, at two
    standard errors; at most ``max_terms``, those of most toxic documents first. The words of the
    fixed lexicon are always among the terms, learned or not."""
    least = max(MIN_DOCS, MIN_SHARE * labelled.where("toxic = 1").count())
    counts = labelled.select("text", "toxic").mapInArrow(_count_terms, "kind int, term long, bad long, docs long")
    counts = counts.groupBy("kind", "term").agg(F.sum("bad").alias("bad"), F.sum("docs").alias("docs"))
    z2 = F.lit(2.0**2)
    share = F.col("bad") / F.col("docs")
    spread = F.sqrt((share * (1 - share) + z2 / (4 * F.col("docs"))) * z2 / F.col("docs"))
    low = (share + z2 / (2 * F.col("docs")) - spread) / (1 + z2 / F.col("docs"))
    best = counts.where((F.col("bad") >= least) & (low > 0.5)).orderBy(F.desc("bad"), "kind", "term")
    voters = dict.fromkeys(_fixed_words().tolist(), 0)
    for row in best.limit(max_terms).collect():
        h = row.term % 2**64
        voters[h] = 1 + row.kind * LEXICONS_PER_KIND + h % LEXICONS_PER_KIND
    hashes = np.array(sorted(voters), np.uint64)
    return Terms(hashes, np.array([voters[h] for h in hashes.tolist()], np.int64))


class LabelModel:
    """Two latent classes. A voter that abstains says nothing.

    ``patterns`` are vote combinations with their ``counts`` over all rows, and of the labelled
    rows with each the clean and the toxic ones (``labelled``, two columns).
    """

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, labelled: np.ndarray, rounds: int = 20):
        fired = self._bits(patterns)
        weight = counts / max(1.0, counts.sum())
        given = labelled.sum(axis=0)
        self.prior = min(max(given[1] / max(1.0, given.sum()), 1e-3), 0.5)
        self.share = np.ones(VOTERS)
        self.rates = np.stack([(labelled[:, k] @ fired + 0.5) / (given[k] + 1) for k in (0, 1)])
        # The labelled rows, whose class is given, weigh as much as all rows together.
        trust = counts.sum() / max(1.0, given.sum())
        for _ in range(rounds):
            p = self.posterior(patterns)
            self.share = 1 / self._overlap(fired, weight, p)
            found = [counts * q + trust * labelled[:, k] for k, q in enumerate((1 - p, p))]
            self.rates = np.stack([(n @ fired + 0.5) / (n.sum() + 1) for n in found])

    def _overlap(self, fired: np.ndarray, weight: np.ndarray, p: np.ndarray) -> np.ndarray:
        """One plus the squared correlations of each lexicon with the others, given the class. The
        voters that count lexicons stand against them and keep their weight."""
        left = fired - (p[:, None] * self.rates[1] + (1 - p)[:, None] * self.rates[0])
        cov = (left * weight[:, None]).T @ left
        scale = np.sqrt(np.maximum(np.diag(cov), 1e-12))
        overlap = ((cov / np.outer(scale, scale)) ** 2)[:LEXICONS, :LEXICONS].sum(axis=0).clip(1)
        return np.append(overlap, np.ones(VOTERS - LEXICONS))

    @staticmethod
    def _bits(patterns: np.ndarray) -> np.ndarray:
        return (patterns[:, None] >> np.arange(VOTERS) & 1).astype(float)

    def posterior(self, patterns: np.ndarray, given: np.ndarray | None = None) -> np.ndarray:
        """Probability that a text with these votes, and a given label of 0 or 1 (-1: none), is
        toxic."""
        fired = self._bits(patterns)
        low, high = self.rates
        odds = fired @ (self.share * np.log(high / low))
        if given is not None:
            odds += np.where(given < 0, 0, 2 * given - 1) * np.log(LABEL_TRUST / (1 - LABEL_TRUST))
        return 1 / (1 + np.exp(-np.clip(odds + np.log(self.prior / (1 - self.prior)), -50, 50)))


def fit_linear(docs: list[np.ndarray], labels: np.ndarray, size: int, rounds: int = 600) -> tuple[np.ndarray, float]:
    """Logistic regression on term presence with soft labels; weights of terms, and the constant."""
    doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    term = np.concatenate(docs).astype(np.int64) if docs else np.zeros(0, np.int64)
    weights, constant = np.zeros(size), 0.0
    slope, steep = np.zeros(size), 0.0
    for _ in range(rounds):
        odds = np.bincount(doc, weights[term], len(docs)) + constant
        miss = 1 / (1 + np.exp(-np.clip(odds, -50, 50))) - labels
        g = np.bincount(term, miss[doc], size) + 0.02 * weights
        slope += g * g
        steep += miss.sum() ** 2
        weights -= 0.5 * g / np.sqrt(slope + 1e-9)
        constant -= 0.5 * miss.sum() / np.sqrt(steep + 1e-9)
    return weights, float(constant)


@dataclass
class Classifier:
    terms: Terms
    weights: np.ndarray
    constant: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        doc, term = self.terms.features(texts)
        odds = np.bincount(doc, self.weights[term], len(texts)) + self.constant
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    labelled_rows: int = LABELLED_ROWS,
    fitted_rows: int = FITTED_ROWS,
    max_terms: int = MAX_TERMS,
) -> Classifier:
    """A classifier from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic). Only rows selected
    by ``learn``, a condition on doc_id, are read. Labels other than 0 and 1 are left out; rows
    with the same doc_id count once each. Its features are the fixed lexicon, the patterns and
    whatever terms the labels teach, be it none; without toxic labels nothing is toxic.

    Terms are learned from at most ``labelled_rows`` labelled rows, picked by a hash; there are at
    most ``max_terms``; the linear classifier is fitted to at most ``fitted_rows`` rows. The votes
    of all rows are counted."""
    docs = docs.select(F.col("doc_id").cast("long"), "text").where(learn)
    chosen = labels.select(F.col("doc_id").cast("long"), "toxic").where(learn & F.col("toxic").isin(0, 1))
    chosen = chosen.groupBy("doc_id").agg(F.max("toxic").cast("long").alias("toxic"))
    order = F.xxhash64("doc_id")
    sample = stored(chosen.orderBy(order, "doc_id").limit(labelled_rows), "labelled")
    labelled = docs.join(F.broadcast(sample), "doc_id").select("text", "toxic")
    labelled = labelled.mapInArrow(_families, "text string, toxic long, low long, high long")
    for key in ("low", "high"):
        first = F.min(F.struct(F.xxhash64("text"), "toxic", "text", "low", "high")).alias("first")
        labelled = labelled.groupBy(key).agg(first).select("first.*")
    labelled = stored(labelled.select("text", "toxic"), "labelled")
    terms = learn_terms(labelled, max_terms)
    if labelled.where("toxic = 1").isEmpty():
        return Classifier(terms, np.zeros(terms.size), -10.0)

    def vote(batches):
        for batch in batches:
            for part in slices(batch, 0):
                kind = part.column(1).to_numpy()
                rows = np.stack([terms.votes(_texts(part, 0)), kind])
                (votes, kind), number = np.unique(rows, axis=1, return_counts=True)
                yield pa.record_batch([pa.array(votes), pa.array(kind), pa.array(number)], names=["votes", "kind", "n"])

    # Kind 2 is every training row, 0 and 1 the labelled ones; at most 2 ** VOTERS combinations.
    seen = docs.select("text", F.lit(2).cast("long").alias("kind"))
    seen = seen.unionAll(labelled.select("text", F.col("toxic").alias("kind")))
    counts = seen.mapInArrow(vote, "votes long, kind long, n long").groupBy("votes", "kind").agg(F.sum("n").alias("n"))
    rows = counts.collect()
    patterns = np.array(sorted({r.votes for r in rows}), np.int64)
    table = np.zeros((len(patterns), 3))
    for r in rows:
        table[np.searchsorted(patterns, r.votes), r.kind] = r.n
    model = LabelModel(patterns, table[:, 2], table[:, :2])

    def present(batches):
        for batch in batches:
            for part in slices(batch, 0):
                texts = _texts(part, 0)
                doc, term = terms.features(texts)
                lists = np.split(term, np.searchsorted(doc, np.arange(1, len(texts))))
                columns = [pa.array(terms.votes(texts)), pa.array(lists, pa.list_(pa.int64())), part.column(1)]
                yield pa.record_batch(columns, names=["votes", "terms", "given"])

    ids = docs.select("doc_id").distinct().orderBy(order, "doc_id").limit(fitted_rows)
    ids = ids.join(chosen, "doc_id", "left").select("doc_id", F.coalesce("toxic", F.lit(-1)).cast("long").alias("given"))
    fitted = docs.join(F.broadcast(ids), "doc_id").select("text", "given")
    rows = fitted.mapInArrow(present, "votes long, terms array<bigint>, given long").collect()
    soft = model.posterior(np.array([r.votes for r in rows], np.int64), np.array([r.given for r in rows]))
    weights, constant = fit_linear([np.array(r.terms) for r in rows], soft, terms.size)
    return Classifier(terms, weights, constant)


def score(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """``docs`` (text, any other columns) with ``score`` (0 to 1) and ``predicted`` (score of 0.3 or
    more) added; columns of these names are replaced. A null, empty or wordless text has no terms
    and the lowest score; repeated rows score alike."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)
    kept = docs.drop("score", "predicted")

    def work(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for part in slices(batch, at):
                found = shared.value.scores(_texts(part, at))
                columns = [*part.columns, pa.array(found), pa.array((found >= THRESHOLD).astype(np.int32))]
                yield pa.record_batch(columns, names=[*part.schema.names, "score", "predicted"])

    schema = T.StructType(list(kept.schema)).add("score", "double").add("predicted", "integer")
    return kept.mapInArrow(work, schema)
