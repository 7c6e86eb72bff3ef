import random
import re
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tidemark.llm import jaccard

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(rows, n=4, threshold=85):
    sets = []
    for _, text in rows:
        w = WORD.findall((text or "").encode().lower())
        sets.append({tuple(w)} if 0 < len(w) < n else {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    parent = {i: i for i in range(len(rows))}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and min(len(sets[i]), len(sets[j])) * 100 >= threshold * max(len(sets[i]), len(sets[j])):
                if 100 * len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
                    parent[find(i)] = find(j)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        r = find(i)
        low[r] = min(low.get(r, doc_id), doc_id)
    return {(doc_id, len(sets[i]), low[find(i)]) for i, (doc_id, _) in enumerate(rows)}


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as cls", "'x' as sig", "2 as component_id")
    got = {tuple(r) for r in jaccard.similar_documents(df).collect()}
    assert got == brute(rows)


def test_documents(spark, small):
    check(spark, [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()])


def test_dense_group_near_the_threshold(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(400)}" for _ in range(150)]
    rows = []
    for i in range(220):
        w = list(base)
        for _ in range(rng.randrange(6)):
            at = rng.randrange(len(w))
            w[at] = rng.choice([f"n{rng.randrange(10**6)}", w[at] + "x", w[at - 1]])
        rows.append((1000 - i, " ".join(w)))
    for i in range(40):  # sizes that differ
        cut_at = rng.randrange(100, 150)
        rows.append((2000 + i, " ".join(base[:cut_at])))
    check(spark, rows)


def test_cases(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A B"), (6, "a b c d"), (7, "a b c d e"), (9, "x y z w v " * 50), (8, "X y z w v " * 60), (10, "é É a b c"), (11, "É É a b c"), (12, "a b")]
    check(spark, rows)
    df = spark.createDataFrame([*rows, (None, "a b")], "doc_id long, text string")
    assert {tuple(r) for r in jaccard.similar_documents(df).collect()} == brute(rows) | {(None, 1, None)}
    assert jaccard.similar_documents(df.limit(0)).count() == 0
    kept = sorted(r.doc_id for r in jaccard.one_of_each(df.filter("doc_id is not null")).collect())
    assert kept == sorted({c for _, _, c in brute(rows)})


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 400), st.integers(0, 60), st.integers(0, 2**32))
def test_linked_sets_share_a_signature(size, changes, seed):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**63, size=size, dtype=np.uint64))
    b = np.unique(np.concatenate([a[rng.permutation(len(a))[changes // 2 :]], rng.integers(0, 2**63, size=changes - changes // 2, dtype=np.uint64)]))
    common = len(np.intersect1d(a, b))
    union = len(a) + len(b) - common
    lower = jaccard.least_different(*(jaccard.fold(np.frombuffer(jaccard.sketch(x, 85), np.uint8), 16) for x in (a, b)))
    assert lower <= union - common
    if len(b) and 100 * common >= 85 * union and common < union:
        assert set(jaccard.signatures(a, 85).tolist()) & set(jaccard.signatures(b, 85).tolist())


@pytest.mark.parametrize("threshold", [80, 85, 90])
def test_every_band_enumerates_subsets(threshold):
    for size in (150, 400, 1500, 6000):  # sets that sign under one seed
        features = np.unique(np.random.default_rng(size).integers(0, 2**63, size=size, dtype=np.uint64))
        band = jaccard.bisect_right(jaccard.BOUNDS, len(features)) - 1
        k, spoilt, n1 = jaccard.partitions(band, threshold)
        got = jaccard.signatures(features, threshold)
        assert 2 * spoilt + 2 > k and n1 > spoilt
        assert len(got) >= 2 * n1  # subsets of two of three subpartitions, few of them empty
        # one feature spoils two of a partition's three subsets, in each of the bands that the set signs for
        without = jaccard.signatures(features[1:], threshold) if jaccard.bisect_right(jaccard.BOUNDS, len(features) - 1) - 1 == band else got[2:]
        assert len(got) - len(np.intersect1d(got, without)) in (1, 2, 3, 4)


@pytest.mark.parametrize("size", [1_000, 5_000, 40_000])
@pytest.mark.parametrize("threshold", [80, 85])
def test_long_sets_at_the_threshold_share_a_signature(size, threshold):
    rng = np.random.default_rng(size + threshold)
    pool = np.unique(rng.integers(0, 2**63, size=2 * size, dtype=np.uint64))
    rng.shuffle(pool)
    for grown in (0.0, 0.5, 1.0):  # the share of the difference that the larger set holds alone
        union = size
        differ = (100 - threshold) * union // 100
        only_b = int(differ * grown)
        a, b = np.sort(pool[: union - only_b]), np.sort(np.concatenate([pool[: union - differ], pool[union - only_b : union]]))
        assert 100 * len(np.intersect1d(a, b)) >= threshold * len(np.union1d(a, b))
        assert set(jaccard.signatures(a, threshold).tolist()) & set(jaccard.signatures(b, threshold).tolist())


def test_very_long_texts_and_ties(spark):
    rng = random.Random(11)
    base = [f"w{rng.randrange(50_000)}" for _ in range(60_000)]
    near = list(base)
    for at in range(0, 60_000, 60):
        near[at] = f"n{at}"
    far = list(base)
    for at in range(0, 60_000, 8):
        far[at] = f"n{at}"
    texts = [" ".join(x) for x in (base, near, far)]
    check(spark, [(5, texts[0]), (4, texts[1]), (3, texts[2]), (5, texts[0]), (7, texts[0].upper()), (8, "a b c d")])


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(i, i + 1) for i in range(40)], [(5, i) for i in range(5)] + [(9, 8), (8, 9), (7, 7)]])
def test_components(spark, edges):
    got = {tuple(r) for r in jaccard.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    low = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(len(edges)):
        for a, b in edges:
            if a != b:
                low[a] = low[b] = min(low[a], low[b])
    assert got == set(low.items())


def links(rows, n=4, threshold=85):
    """By id: the set, and the ids of linked other documents."""
    sets = {}
    for doc_id, text in rows:
        w = WORD.findall((text or "").encode().lower())
        sets[doc_id] = frozenset(tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, min(len(w), 1))))
    return sets, {a: {b for b in sets if a != b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])} for a in sets}


@pytest.mark.parametrize("block", [jaccard.LINK_BLOCK, 2000])
def test_every_link_of_a_group(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "LINK_BLOCK", block)
    rng = random.Random(3)
    rows = [(900, None), (901, "a b"), (902, "A B"), (903, "alone in the world of words")]
    for group in range(4):
        base = [f"g{group}w{k}" for k in range(120)]
        for i in range(40 if group == 0 else 3):
            w = list(base[: 120 - rng.randrange(20)])
            w[rng.randrange(len(w))] = f"n{i // 2}"
            rows += [(100 * group + 2 * i, " ".join(w))] + [(100 * group + 2 * i + 1, " ".join(w).upper())] * (i % 3 == 0)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets, want = links(rows)
    components = {doc_id: (size, comp) for doc_id, size, comp in brute(rows)}
    got = {tuple(r) for r in jaccard.linked_documents(df).collect()}
    assert got == {(doc_id, *components[doc_id], len(want[doc_id])) for doc_id in sets}
    first = {s: min(x for x in sets if sets[x] == s) for s in sets.values()}
    copies = {first[s]: sum(sets[x] == s for x in sets) for s in sets.values()}
    pairs = {(a, b, copies[a], copies[b]) for a in first.values() for b in want[a] if b in first.values() and a < b}
    found = [tuple(r) for r in jaccard.linked_texts(df).collect()]
    assert len(found) == len(set(found)) and set(found) == pairs and len(pairs) > 100


def test_links_of_no_rows_and_null_ids(spark):
    df = spark.createDataFrame([(None, "a b"), (1, "a b"), (2, "A b"), (3, "")], "doc_id long, text string")
    assert sorted(((r.doc_id or 0, r.n_links) for r in jaccard.linked_documents(df).collect())) == [(0, 0), (1, 1), (2, 1), (3, 0)]
    assert jaccard.linked_documents(df.limit(0)).count() == jaccard.linked_texts(df.limit(0)).count() == 0


def test_no_file_holds_signatures(spark, monkeypatch):
    """They are several times the text: what is stored for each row stays below the text's bytes."""
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{rng.randrange(10**5)}" for _ in range(300))) for i in range(200)]
    stored = {}

    def cut(df, name="cut", **options):
        out = real(df, name, **options)
        stored[name] = stored.get(name, 0) + sum(Path(f.removeprefix("file://")).stat().st_size for f in out.inputFiles())
        return out

    real = jaccard.cut
    monkeypatch.setattr(jaccard, "cut", cut)
    got = jaccard.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80)
    assert got.count() == len(rows)
    assert sum(stored.values()) < sum(len(text) for _, text in rows)


def test_further_links_search_only_the_components_they_join(spark, monkeypatch):
    """One search over all links, and none for rounds that find no further link; what these find gives the labels of all links together."""
    asked, search = [], jaccard.connected_components
    monkeypatch.setattr(jaccard, "connected_components", lambda edges: asked.append(edges.count()) or search(edges))
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base[: 60 - i % 3])) for i in range(9)] + [(20 + i, f"other text number {i}") for i in range(5)]
    check(spark, rows)
    assert len(asked) == 1

    rng = random.Random(3)
    frame = lambda pairs: spark.createDataFrame(pairs, "a long, b long")
    first, more = ([(rng.randrange(200), rng.randrange(200)) for _ in range(n)] for n in (90, 25))
    labels = search(frame(first))
    got = {tuple(r) for r in jaccard.with_links(labels, frame([p for p in more if p[0] != p[1]])).collect()}
    assert got == {tuple(r) for r in search(frame(first + more)).collect()}
    assert asked[1:] == [sum(a != b for a, b in more)]
    assert jaccard.with_links(labels, frame([])) is labels
