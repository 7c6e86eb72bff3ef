import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import toxicity


def load(spark, sf):
    return (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))


@pytest.mark.parametrize("sf,least,most_wrong", [("sf0.01", 0.6, 1), ("sf0.1", 0.9, 3)])
def test_accuracy_and_calibration_on_held_out_labels(spark, sf, least, most_wrong):
    docs, labels = load(spark, sf)
    out = toxicity.score(docs.select("doc_id", "text"), toxicity.fit(docs, labels))
    rows = out.join(labels, "doc_id").filter("held_out").select("doc_id", "score", "predicted", "toxic", "evidence", "text").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    toxic, hit = sum(r.toxic for r in rows), sum(r.predicted and r.toxic for r in rows)
    wrong = sum(r.predicted and not r.toxic for r in rows)
    print(sf, "held out", len(rows), "toxic", toxic, "found", hit, "wrongly", wrong)
    assert hit >= least * toxic and wrong <= most_wrong
    assert all(r.evidence for r in rows if len((r.text or "").split()) > 20)
    for low, high in ((0, 0.1), (0.1, 0.9), (0.9, 1.01)):
        inside = [r for r in rows if low <= r.score < high]
        if len(inside) >= 10:
            mean, rate = np.mean([r.score for r in inside]), np.mean([r.toxic for r in inside])
            assert abs(mean - rate) <= 0.02 + 2 / math.sqrt(len(inside)) * 0.5, (low, mean, rate)


def plain_scores(texts, examples, n_docs, df):
    """All cosines by dictionaries: votes, calibration and scores."""

    def model(examples):
        toxic, other = Counter(), Counter()
        for e in examples:
            (toxic if e.toxic else other).update(e.counts.keys())
        known = toxic.keys() | other.keys()
        factor = {w: (math.log((n_docs + 1) / (df[w] + 1)) + 1) * math.log2(2 + toxic[w] / max(1, other[w])) ** 2 for w in known}
        unit = lambda counts: {w: (1 + math.log(n)) * factor[w] for w, n in counts.items() if w in factor}
        norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
        vectors = [(e, v := unit(e.counts), norm(v)) for e in examples]
        base = (sum(e.toxic for e in examples) + 0.5) / (len(examples) + 1)

        def vote(counts):
            v = unit(counts)
            if not v:
                return base, []
            n = norm(v)
            cosines = [(round(sum(x * u[w] for w, x in v.items() if w in u) / n / m, 9), e) for e, u, m in vectors if m]
            near = sorted(((c, e) for c, e in cosines if c > 0), key=lambda x: (-x[0], x[1].mark, x[1].toxic, x[1].doc_id))[: toxicity.NEIGHBOURS]
            return (sum(c for c, e in near if e.toxic) + toxicity.PRIOR_WEIGHT * base) / (sum(c for c, _ in near) + toxicity.PRIOR_WEIGHT), [e.doc_id for _, e in near[:3]]

        return vote

    votes = [(model([x for x in examples if x.mark % 5 != f])(e.counts)[0], e.toxic) for f in range(5) for e in examples if e.mark % 5 == f]
    slope, offset = toxicity.logistic(np.array([v for v, _ in votes]), np.array([float(t) for _, t in votes]), np.ones(len(votes)))
    vote = model(examples)
    out = {}
    for i, t in texts:
        v, near = vote(Counter(toxicity.words(t)))
        out[i] = (1 / (1 + math.exp(-(slope * v + offset))), near)
    return out


def test_scores_equal_brute_force(spark):
    docs, labels = load(spark, "sf0.001")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    df = Counter(w for _, t in texts for w in set(toxicity.words(t)))
    of = dict(texts)
    examples = [toxicity.Example(r.doc_id, r.toxic, dict(Counter(toxicity.words(of[r.doc_id])))) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5]
    want = plain_scores(texts, examples, len(texts), df)
    rows = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(rows) == len(want)
    for r in rows:
        score, near = want[r.doc_id]
        assert r.score == pytest.approx(score, abs=1e-6) and r.predicted == int(r.score >= 0.5)
        assert [e.doc_id for e in r.evidence] == near


def test_blocks_lose_no_neighbour():
    rng = np.random.default_rng(3)
    word = lambda i: f"f{i}".encode()
    examples = []
    for i in range(700):
        terms = rng.choice(40, size=rng.integers(0, 6), replace=False)
        examples.append(toxicity.Example(i * 3, int(rng.integers(0, 2)), {word(t): int(rng.integers(1, 4)) for t in terms}))
    index = toxicity.Index(examples, {word(i): i for i in range(40)}, rng.random(40) + 1)
    by_id = {e.doc_id: e for e in examples}
    dense = np.zeros((len(index.ids), 40))
    for row, i in enumerate(index.ids):
        t, w = index.vector(by_id[i].counts)
        dense[row, t] = w
    for _ in range(200):
        t, w = index.vector({word(x): int(rng.integers(1, 3)) for x in rng.choice(40, size=rng.integers(1, 5), replace=False)})
        cos = np.round(dense[:, t] @ w, 9)
        want = sorted((-c, int(index.marks[i]), int(index.toxic[i]), int(index.ids[i])) for i, c in enumerate(cos) if c > 0)[: toxicity.NEIGHBOURS]
        near, cosines = index.nearest(t, w)
        assert np.allclose(cosines, [-c for c, *_ in want])
        assert [int(index.ids[r]) for r in near] == [i for *_, i in want]


def test_words():
    assert toxicity.words("It's ÉLÈVE_1, Straße—x!\tÜbel") == ["it", "s", "élève", "1", "strasse—x", "übel"] or [w.decode() for w in toxicity.words("It's ÉLÈVE_1, Straße—x!\tÜbel")] == ["it", "s", "élève", "1", "strasse—x", "übel"]
    assert toxicity.words(None) == toxicity.words("") == []


def test_cases(spark):
    docs = spark.createDataFrame([(i, ("vile " if i % 2 else "kind ") + f"w{i}", "x") for i in range(60)] + [(None, None, "x"), (7, "vile w7", "y"), (7, "vile zz", "y"), (100, "", None), (101, "vile " * 300_000, None), (102, "vile w7", None)], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(2, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert {b"vile", b"kind"} <= set(model.index.vocabulary)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == 66
    by_text = {}
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int("vile" in (r.text or "")) == int(r.score >= 0.5)
        assert by_text.setdefault(r.text, (r.score, r.evidence)) == (r.score, r.evidence)  # ids play no part
    again = toxicity.fit(docs.repartition(7), labels.repartition(3))
    assert (again.slope, again.offset) == (model.slope, model.offset) and again.index.ids.tolist() == model.index.ids.tolist()
    assert toxicity.score(docs.limit(0), model).count() == 0
    empty = toxicity.fit(docs, labels.limit(0))
    assert {r.predicted for r in toxicity.score(docs, empty).collect()} <= {0, 1}
    assert math.isfinite(toxicity.fit(docs.limit(0), labels).index.base)


def test_blocks_below_the_threshold_are_not_read(monkeypatch):
    """Rounds over blocks find the neighbours of one block that holds all, ties included, and read fewer postings."""
    rng = np.random.default_rng(5)
    topic = lambda t: {b"t%d_%d" % (t, rng.integers(12)): int(rng.integers(1, 5)) for _ in range(9)} | {b"c%d" % rng.integers(9): 1}
    examples = [toxicity.Example(i, int(i % 3 == 0), topic(i % 40)) for i in range(1600)]
    examples += [toxicity.Example(5000 + i, 0, dict(examples[7].counts)) for i in range(60)]
    vocabulary = {w: i for i, w in enumerate(sorted({w for e in examples for w in e.counts}))}
    idf = np.ones(len(vocabulary))
    index = toxicity.Index(examples, vocabulary, idf)
    monkeypatch.setattr(toxicity, "BLOCK", 1 << 20)
    whole = toxicity.Index(examples, vocabulary, idf)
    read, scores = [0, 0], toxicity.Index._scores

    def counted(self, cells, per_cell, use):
        read[self is whole] += int((self.cell_start[cells[use] + 1] - self.cell_start[cells[use]]).sum())
        return scores(self, cells, per_cell, use)

    monkeypatch.setattr(toxicity.Index, "_scores", counted)
    for e in examples[:200] + examples[-2:]:
        near, cosines = index.nearest(*index.vector(e.counts))
        other, expected = whole.nearest(*whole.vector(e.counts))
        assert index.ids[near].tolist() == whole.ids[other].tolist() and cosines.tolist() == expected.tolist()
    assert 0 < read[0] < read[1]


def test_few_postings_are_read_for_real_texts(spark, monkeypatch):
    """Reading most of them in rounds cost more CPU time than all in one pass; the neighbours are those of all cosines."""
    docs, labels = load(spark, "sf0.01")
    index = toxicity.fit(docs, labels).index
    read, held, scores = [], [], toxicity.Index._scores

    def counted(self, cells, per_cell, use):
        sizes = self.cell_start[cells + 1] - self.cell_start[cells]
        read.append(int(sizes[use].sum()))
        return scores(self, cells, per_cell, use)

    monkeypatch.setattr(toxicity.Index, "_scores", counted)
    for text in [r.text for r in docs.select("text").limit(300).collect()]:
        terms, weights = index.vector(Counter(toxicity.words(text)))
        if not len(terms):
            continue
        at = [np.arange(index.cell_start[a], index.cell_start[b]) for a, b in zip(index.term_cells[terms], index.term_cells[terms + 1], strict=True)]
        cosines = np.bincount(index.rows[np.concatenate(at)], np.repeat(weights, [len(x) for x in at]) * index.weights[np.concatenate(at)], len(index.ids))
        held.append(sum(map(len, at)))
        near, found = index.nearest(terms, weights)
        want = np.sort(cosines[cosines > 0])[::-1][: toxicity.NEIGHBOURS]
        assert len(near) == len(want) and np.allclose(found, want, atol=2e-9) and np.allclose(cosines[near], found, atol=2e-9)
    assert 0 < sum(read) < 0.7 * sum(held)


def test_examples_reach_the_driver_as_two_values_each():
    """The words and their counts are one value each; rows of arrays took several times as much of the driver's heap."""
    texts = ["a b a\u00a0c", "", None, "Stra\u00dfe \x85 x y x"]
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3, 4], "toxic": pa.array([0, 1, 0, 1], pa.int32()), "text": texts})
    (out,) = toxicity._example_words([batch])
    assert out.column("words").type == out.column("tf").type == pa.binary()
    found = [dict(zip(w.split(), np.frombuffer(n, "<i4").tolist(), strict=True)) for w, n in zip(out.column("words").to_pylist(), out.column("tf").to_pylist(), strict=True)]
    assert found == [Counter(toxicity.words(t)) for t in texts]
