"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

``fit`` takes a bounded sample of labelled rows as examples. Every word of an
example is a feature. A feature weighs (1 + log tf) * idf * rf^2: document
frequencies are counted over all documents, and rf is the relevance frequency
of supervised term weighting (Lan et al. 2009), log2(2 + a / max(1, c)) for a
toxic and c other examples that hold the word. No feature is dropped.

The examples' unit vectors lie in an inverted index: postings by word, cut into
blocks of example numbers. ``score`` finds the nearest examples of each text:
sums in single precision (a dense table for words of many examples, postings
for the others) are within a known margin of every example's cosine; they give
a cosine to beat and the largest that a block can hold. Blocks that can reach it
are scored in double precision, the others never, so the neighbours are exact.
Votes weigh by cosine. A logistic curve from vote to rate, fitted to votes that
cross-validation over the examples gives, makes them calibrated scores.

Bound (documented parameter): ``MAX_EXAMPLES`` labelled rows, chosen by a hash
of their id, at most half of them toxic. Where labelled rows are left out, the
counts of a, c and the calibration weigh each example for the rows of its label
that it stands for. The vocabulary is bounded by the examples' words. All that
is counted over the corpus covers all of it.

A score is a function of the text alone: equal texts have equal scores, and an
example whose text equals the scored one is a neighbour like others. Equal
cosines go by a fingerprint of the example's words.

Cases: a null or empty text, or one that shares no word with an example, gets
the base rate's score; a null id is never held out and never an example; a very
long text is tokenised whole, its vector is bounded by the vocabulary; repeated
rows are scored row by row; of an id's texts the smallest, and of its labels
the largest, makes the example; without toxic or without other examples every
score is the base rate's; an empty table gives an empty table; all columns
pass through, and the added ones replace columns of their name.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import cut

MAX_EXAMPLES = 1024
NEIGHBOURS = 25
#: Examples in a block of the index.
BLOCK = 8
#: Words of so many examples have a row of single-precision weights for all examples, so the table is at most 16 times as long as the postings.
DENSE = 64
#: Weight of the base rate among the votes.
PRIOR_WEIGHT = 0.05
FOLDS = 5
#: ASCII letters in lower case; other ASCII characters but digits end a word.
LETTERS = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


def is_held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5, is 0. False for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def words(text: str | None) -> list[bytes]:
    """Words in lower case, as UTF-8: runs of ASCII letters, digits and characters beyond ASCII."""
    text = text or ""
    return (text if text.isascii() else text.casefold()).encode().translate(LETTERS).split()


@dataclass
class Example:
    doc_id: int
    toxic: int
    counts: dict[bytes, int]
    weight: float = 1.0  # labelled rows of its label for each example of it

    def __post_init__(self):
        self.mark = xxhash.xxh3_64_intdigest(repr(sorted(self.counts.items())).encode()) >> 1


def term_factors(examples: list[Example], vocabulary: dict[bytes, int], idf: np.ndarray) -> np.ndarray:
    """idf * rf^2 of every word, counts weighted back to those of all labelled rows; 0 of a word that no example holds."""
    toxic, other = np.zeros(len(vocabulary)), np.zeros(len(vocabulary))
    for e in examples:
        (toxic if e.toxic else other)[[vocabulary[w] for w in e.counts]] += e.weight
    return idf * np.log2(2 + toxic / np.maximum(1, other)) ** 2 * (toxic + other > 0)


class Index:
    """Inverted index in blocks over the unit vectors of examples."""

    def __init__(self, examples: list[Example], vocabulary: dict[bytes, int], idf: np.ndarray):
        self.vocabulary, self.factors = vocabulary, term_factors(examples, vocabulary, idf)
        vectors = [(e, *self.vector(e.counts)) for e in examples if e.counts]
        # examples of one heaviest word stand together, so that a block's bound is tight for other words
        vectors.sort(key=lambda v: (int(v[1][v[2].argmax()]), v[0].mark, v[0].toxic, v[0].doc_id))
        self.ids = np.array([e.doc_id for e, _, _ in vectors], np.int64)
        self.toxic = np.array([e.toxic for e, _, _ in vectors], np.float64)
        self.marks = np.array([e.mark for e, _, _ in vectors], np.int64)
        self.n_blocks, self.block_of = -(-len(vectors) // BLOCK), np.arange(len(vectors)) // BLOCK
        self.base = (sum(e.weight for e in examples if e.toxic) + 0.5) / (sum(e.weight for e in examples) + 1)
        term, weight, row = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
        if vectors:
            term, weight = np.concatenate([t for _, t, _ in vectors]), np.concatenate([w for *_, w in vectors])
            row = np.repeat(np.arange(len(vectors)), [len(t) for _, t, _ in vectors])
        order = np.lexsort((row, term))
        term, self.weights, self.rows = term[order], weight[order], row[order]
        cell = term * max(1, self.n_blocks) + self.rows // BLOCK  # a word's postings in a block
        first = np.flatnonzero(np.diff(cell, prepend=-1))
        self.cell_start = np.append(first, len(cell))
        self.cell_block = (self.rows[first] // BLOCK).astype(np.int32)
        self.term_cells = np.searchsorted(term[first], np.arange(len(vocabulary) + 1))
        self.term_start = np.searchsorted(term, np.arange(len(vocabulary) + 1))
        frequent = np.flatnonzero(np.diff(self.term_start) >= DENSE)
        self.dense_row = np.full(len(vocabulary), -1, np.int32)
        self.dense_row[frequent] = np.arange(len(frequent))
        self.dense = np.zeros((len(frequent), len(vectors)), np.float32)
        held = self.dense_row[term] >= 0
        self.dense[self.dense_row[term[held]], self.rows[held]] = self.weights[held]

    def vector(self, counts: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
        """Words of the vocabulary as (numbers, weights) of length 1."""
        terms = np.fromiter(map(self.vocabulary.get, counts.keys(), repeat(-1)), np.int64, len(counts))
        tf = np.fromiter(counts.values(), np.float64, len(counts))
        order = np.argsort(terms)  # sums run in one order everywhere
        order = order[np.searchsorted(terms[order], 0) :]
        terms = terms[order]
        w = (1 + np.log(tf[order])) * self.factors[terms]
        return terms, w / max(np.sqrt((w * w).sum()), 1e-300)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """(example numbers, cosines) of the k examples of largest cosine above 0."""
        about, margin = self._about(terms, weights)
        enough = np.partition(about, -k)[-k] - margin if len(about) >= k else 0.0  # k examples have this cosine or more
        reach = np.zeros(self.n_blocks, bool)
        reach[self.block_of[about + margin >= enough]] = True
        a, b = self.term_cells[terms], self.term_cells[terms + 1]
        cells = _ranges(a, b)
        use = np.flatnonzero(reach[self.cell_block[cells]])
        scores = self._scores(cells, np.repeat(weights, b - a), use)
        hit = np.flatnonzero(scores >= max(enough - 2e-9, 1e-300))  # cosines that are equal when rounded stay together
        cosines = np.round(scores[hit], 9)
        first = np.lexsort((self.ids[hit], self.toxic[hit], self.marks[hit], -cosines))[:k]
        return hit[first], cosines[first]

    def _about(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, float]:
        """All cosines, and how far they can be off: both vectors are of length 1, so each of n terms adds a rounding at most."""
        at = self.dense_row[terms]
        some = at >= 0
        others, at = ~some, at[some]
        a, b, w = self.term_start[terms[others]], self.term_start[terms[others] + 1], weights[others]
        lists = _ranges(a, b)
        rare = np.bincount(self.rows[lists], np.repeat(w, b - a) * self.weights[lists], len(self.ids))
        return rare + weights[some].astype(np.float32) @ self.dense[at], (len(at) + 8) * 2.0**-22 + 2e-9

    def _scores(self, cells: np.ndarray, per_cell: np.ndarray, use: np.ndarray) -> np.ndarray:
        """Cosines by the cells in use."""
        cells = cells[use]
        begin, end = self.cell_start[cells], self.cell_start[cells + 1]
        at = _ranges(begin, end)
        return np.bincount(self.rows[at], np.repeat(per_cell[use], end - begin) * self.weights[at], len(self.ids))

    def vote(self, counts: dict[bytes, int]) -> tuple[float, np.ndarray, np.ndarray]:
        """The weighted share of toxic neighbours, and the neighbours."""
        terms, weights = self.vector(counts)
        if not len(terms) or not len(self.ids):
            return self.base, np.empty(0, np.int64), np.empty(0)
        near, cosines = self.nearest(terms, weights)
        return float(((cosines * self.toxic[near]).sum() + PRIOR_WEIGHT * self.base) / (cosines.sum() + PRIOR_WEIGHT)), near, cosines


def _ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All numbers of the ranges one after another."""
    n = end - begin
    numbers = np.repeat(begin - (np.cumsum(n) - n), n)
    numbers += np.arange(len(numbers))
    return numbers


def logistic(votes: np.ndarray, toxic: np.ndarray, weights: np.ndarray, steps: int = 30) -> tuple[float, float]:
    """Slope and offset of the curve from vote to rate, by Newton's method with a weak ridge on the slope."""
    x = np.stack([votes, np.ones_like(votes)], axis=1)
    ridge = np.diag([1e-2, 1e-6])
    beta = np.array([0.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (weights * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(hessian, x.T @ (weights * (toxic - p)) - ridge @ beta)
        beta += np.clip(step, -5, 5)
    return float(beta[0]), float(beta[1])


@dataclass
class Model:
    index: Index
    slope: float
    offset: float

    def judge(self, text: str | None) -> tuple[float, list[tuple[int, float, int]]]:
        vote, near, cosines = self.index.vote(Counter(words(text)))
        evidence = [(int(self.index.ids[r]), float(c), int(self.index.toxic[r])) for r, c in zip(near[:3], cosines[:3], strict=True)]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * vote + self.offset)))), evidence


def build(examples: list[Example], vocabulary: dict[bytes, int], idf: np.ndarray) -> Model:
    """The index, and its calibration by votes of examples that stood in other folds than their neighbours."""
    index = Index(examples, vocabulary, idf)
    votes, toxic, weights = [], [], []
    for fold in range(FOLDS):
        rest = [e for e in examples if e.mark % FOLDS != fold]  # equal texts share a fold
        if not 0 < sum(e.toxic for e in rest) < len(rest):
            continue
        part = Index(rest, vocabulary, idf)
        for e in examples:
            if e.mark % FOLDS == fold:
                votes.append(part.vote(e.counts)[0])
                toxic.append(float(e.toxic))
                weights.append(e.weight)
    if not votes:
        return Model(index, 0.0, math.log(index.base / (1 - index.base)))
    return Model(index, *logistic(*map(np.array, (votes, toxic, weights))))


def _document_frequencies(shared):
    def run(batches):
        vocabulary = shared.value
        df, n = np.zeros(len(vocabulary) + 1, np.int64), 0  # the last for words that no example holds
        for batch in batches:
            for text in batch.column(0):
                n += 1
                held = set(words(text.as_py()))
                df[np.fromiter(map(vocabulary.get, held, repeat(-1)), np.int64, len(held))] += 1
        df = df[:-1]
        found = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"term": np.append(found, -1), "df": np.append(df[found], n)})  # -1: all documents

    return run


def _example_words(batches):
    """A row for each example: its words with a space between, and their counts as bytes, so that the driver gets two values and not two for each word."""
    for batch in batches:
        counts = [Counter(words(t.as_py())) for t in batch.column(2)]
        packed = [np.fromiter(c.values(), "<i4", len(c)).tobytes() for c in counts]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([b" ".join(c) for c in counts], pa.binary()), pa.array(packed, pa.binary())], names=["doc_id", "toxic", "words", "tf"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_examples: int = MAX_EXAMPLES) -> Model:
    """The model of ``labels.toxic``; only labels whose id is not held out are read."""
    labelled = labels.filter(F.col("toxic").isin(0, 1) & F.col(id_col).isNotNull() & ~is_held_out(id_col)).groupBy(F.col(id_col).alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    rows = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bounds = {1: min(rows.get(1, 0), max_examples // 2)}
    bounds[0] = max_examples - bounds[1]
    some = lambda toxic: labelled.filter(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bounds[toxic])
    chosen = some(1).unionByName(some(0))  # the bounded sample
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    one = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    found = cut(one.mapInArrow(_example_words, "doc_id long, toxic int, words binary, tf binary"), "examples").toArrow()
    weights = {t: max(1.0, n / max(1, bounds[t])) for t, n in rows.items()}
    of_words = (dict(zip(w.as_py().split(), np.frombuffer(n.as_py(), "<i4").tolist(), strict=True)) for w, n in zip(found.column("words"), found.column("tf"), strict=True))
    examples = [Example(i, t, c, weights[t]) for i, t, c in zip(found.column("doc_id").to_pylist(), found.column("toxic").to_pylist(), of_words, strict=True)]
    examples.sort(key=lambda e: (e.mark, e.toxic, e.doc_id))
    held = Counter(w for e in examples for w in e.counts)
    vocabulary = {w: i for i, w in enumerate(sorted(held, key=lambda w: (-held[w], w)))}  # frequent words lie together in memory

    df, n = np.zeros(len(vocabulary), np.int64), 0
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    counted = texts.select("text").mapInArrow(_document_frequencies(shared), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    term, sums = counted.column("term").to_numpy(), counted.column("df").to_numpy()
    df[term[term >= 0]] = sums[term >= 0]
    n = int(sums[term < 0].sum())
    return build(examples, vocabulary, np.log((n + 1) / (df + 1)) + 1)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with held_out, score (0 to 1), predicted (0 or 1) and evidence: the three nearest examples as (doc_id, cosine, toxic).

    The model is bounded by its parameter and is broadcast; documents stay
    where they are.
    """
    added = ["held_out", "score", "predicted", "evidence"]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    plain = docs.select(*(c for c in docs.columns if c not in added)).withColumn("held_out", is_held_out(id_col))
    at_text = plain.columns.index(text_col)
    evidence = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))

    def run(batches):
        judge = shared.value.judge
        for batch in batches:
            found = [judge(t.as_py()) for t in batch.column(at_text)]
            scores = [s for s, _ in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array([[{"doc_id": d, "cosine": c, "toxic": y} for d, c, y in e] for _, e in found], evidence)],
                names=[*batch.schema.names, *added[1:]],
            )

    empty = [F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), F.lit(None).cast("array<struct<doc_id:long,cosine:double,toxic:int>>").alias("evidence")]
    return plain.mapInArrow(run, plain.select("*", *empty).schema)
