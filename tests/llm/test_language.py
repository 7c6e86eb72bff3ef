"""Sums over segmentations against their enumeration, fitting against counting them, and predictions."""

import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language
from tidemark.llm.language import SPACE, UNKNOWN

PATH = public_tokenizers.path("piece_bpe_32k.model")
WORDS = ["a", "the", "straße", "été", "nación", "中文字", "ꙮ", "aꙮb", "x" * 30, "antidisestablishment", "ᚠᚢ"]


@pytest.fixture(scope="module")
def pieces():
    with open(PATH, "rb") as f:
        return language.Pieces(f.read())


@pytest.fixture(scope="module")
def table(pieces):
    t = np.random.default_rng(3).random((pieces.size, 3)) ** 8
    return t / t.sum(axis=0)


def segmentations(word, pieces):
    """All ways to cut the marked word, each as the numbers of its pieces."""
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        head = word[:n]
        if head in pieces.number:
            own = [pieces.number[head]]
        elif n == 1 and head != SPACE:
            own = [pieces.byte[b] for b in head.encode()]
        else:
            continue
        for rest in segmentations(word[n:], pieces):
            yield own + rest


def test_forward_sums_all_segmentations(pieces, table):
    for w in [w for w in WORDS if len(w) < 15]:
        want = sum(table[s].prod(axis=0) for s in segmentations(SPACE + w, pieces))
        assert np.allclose(language.log_probabilities([w], pieces, table)[0], np.log(want), atol=1e-8), w


def test_expected_pieces_count_all_segmentations(pieces, table):
    weights = np.array([[2, 0, 5]])
    for w in ("the", "straße", "aꙮb", "été"):
        got, want = np.zeros((pieces.size, 3), np.int64), np.zeros((pieces.size, 3))
        language.expected([w], weights, pieces, table, got)
        cuts = list(segmentations(SPACE + w, pieces))
        shares = np.array([table[s].prod(axis=0) for s in cuts])
        for s, share in zip(cuts, shares / shares.sum(axis=0), strict=True):
            for i in s:
                want[i] += weights[0] * share
        assert np.allclose(got / language.PARTS, want, atol=1e-4), w


def test_long_words_keep_their_scale(pieces, table):
    long = "abcdefghij" * 3000
    alone = language.log_probabilities([long], pieces, table)
    assert np.isfinite(alone).all() and (alone < -1000).all()
    parts = language.log_probabilities(["ꙮ" * 400, "b" * 400], pieces, table)
    assert np.isfinite(parts).all() and (parts[0] < parts[1]).all()


def test_groups_do_not_change_a_word(pieces, table):
    words = ["und", "ꙮnd", "des", "été"]
    assert (language.log_probabilities(words, pieces, table) == np.concatenate([language.log_probabilities([w], pieces, table) for w in words])).all()


def rows(n=240):
    r = random.Random(2)
    sound = {"xx": "bcdfg", "yy": "lmnpr"}
    word = lambda lang: "".join(r.choice(sound[lang]) + r.choice("aeiou") for _ in range(r.randrange(1, 5)))
    return [(i, " ".join(word(lang) for _ in range(12)), lang) for i in range(n) for lang in [r.choice(["xx", "yy"])]]


def predictions(spark, data, **how):
    df = spark.createDataFrame([(i, t, lang, 0.5) for i, t, lang in data], "doc_id long, text string, lang string, score double").repartition(4)
    out = language.predict(df, language.fit(df, PATH, **how))
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_held_out_rows_are_told_apart(spark):
    data = rows()
    odd = [(900, None, "xx"), (901, "", "yy"), (902, "12 ½ ² — _ 34", "yy"), (None, "bada", "yy"), (903, "bado gece", None), (903, "lami nore", None), (904, "中", None), (905, "bade " * 40_000, None)]
    got = predictions(spark, data + odd, texts=60)
    assert len(got) == len(data) + len(odd)
    found = {(r[0], r[2]): r for r in got}
    truth = {i: lang for i, _, lang in data}
    held = [r for r in got if r[0] in truth and r[1]]
    assert len(held) > 50 and all(r[1] == (zlib.crc32(str(r[0]).encode()) % 3 == 1) for r in got if r[0] is not None)
    assert sum(r[2] == truth[r[0]] for r in held) >= 0.98 * len(held)
    assert all(found[i, UNKNOWN][3] == 0 for i in (900, 901, 902)) and found[905, "xx"][3] > 0.99
    assert (903, "xx") in found and (903, "yy") in found and (None, "xx") in found and found[None, "xx"][1] is False
    assert all(r[2] in ("xx", "yy", UNKNOWN) and 0 <= r[3] <= 1 for r in got)


def test_held_out_labels_are_never_read(spark):
    data = rows(120)
    changed = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 3 == 1 else lang) for i, t, lang in data]
    assert predictions(spark, data) == predictions(spark, changed)


def test_repartitioned_rows_and_copies_give_the_same(spark):
    data = rows(120)
    train = [r for r in data if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    copies = [(i, train[0][1], train[0][2]) for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 3 != 1]
    first = predictions(spark, data)
    assert first == [r for r in predictions(spark, data + copies) if r[0] < 1000]
    assert len({r[2:] for r in predictions(spark, data + copies) if r[0] >= 1000}) == 1


def test_without_labels_or_rows(spark):
    assert {r[2:] for r in predictions(spark, [(1, "word", None), (2, "word", None)])} == {(UNKNOWN, 0.0)}
    assert predictions(spark, []) == []


def test_most_languages(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 2)
    with pytest.raises(ValueError, match="languages"):
        predictions(spark, [(i, "word", str(i)) for i in range(20)])


def test_documents(spark):
    sf = "/root/testdata/sf0.01"
    from tidemark.llm import queries

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = queries.op11_language_id(spark, sf).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out and lang_pred <> 'und'")
    right, n = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert n > 200 and right >= 0.98 and math.isfinite(right)
