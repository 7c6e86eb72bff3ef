"""The stages against plain versions of their decisions, each on its own input."""

import hashlib
import re

import pyarrow as pa

import corpus_pipeline
from tests.llm.test_jaccard import brute
from tests.llm.test_quality_url import brute as counts
from tests.llm.test_tokens import library
from tidemark.llm import bpe, jaccard, mixing, pretokens, toxicity
from tidemark.llm.common import cut

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, cut(stage(spark, docs, SF), name)
        seen[name] = (before, docs)
        if name != "byte_bpe":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]

    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    before, after = seen["toxicity"]
    judged = toxicity.score(before, toxicity.fit(before, labels)).collect()
    assert ids(after) == {r.doc_id for r in judged if not r.predicted}

    before, after = seen["quality_rules"]
    kept = ids(after)
    for r in before.collect():
        n, *_, repeated = counts(r.text)
        if n < 20 or 100 * repeated > 30 * n:
            assert r.doc_id not in kept

    before, after = seen["ngram_jaccard"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert sorted(r.doc_id for r in after.collect()) == sorted({c for _, _, c in brute(rows, 5, 80)})

    before, after = seen["mixing"]
    taken = {r.doc_id: r.taken for r in mixing.taken_words(before).collect() if r.taken}
    got: dict = {}
    for r in after.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(WORD.findall(r.text))
    assert got == taken

    before, after = seen["byte_bpe"]
    enc = library()
    want = sorted((r.doc_id, hashlib.sha256(",".join(map(str, enc.encode_ordinary(r.text))).encode()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()) for r in before.collect())
    assert sorted((r.doc_id, r.ids_sha256, r.decoded_sha256) for r in after.collect()) == want


CLASHES = "score predicted held_out evidence n_words kept failed words row parts doc pass first n nth cls size block shard slot taken ids decoded component_id".split()


def test_odd_rows_pass_every_stage(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows and ids, and columns whose names the operators use themselves."""
    prose = " ".join(f"the word{i % 37} and of{i}" for i in range(40))
    rows = [(1, prose, "en", "a", 9), (1, prose, "en", "a", 9), (1, prose + " more", None, None, None), (None, prose, "en", "a", 9), (None, None, None, None, None), (2, "", "en", "b", 0), (3, " ".join(f"in the w{i} of x{i * 7}" for i in range(6_000)), "en", "b", 1), (4, "z", "de", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", *(f"'keep' as {c}" for c in CLASHES))
    spark.createDataFrame([(1, 0), (3, 0), (4, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for start in (docs, docs.limit(0)):
        now = start
        for name, stage in corpus_pipeline.STAGES:
            out = cut(stage(spark, now, str(tmp_path)), name)
            if name != "byte_bpe":
                assert out.columns == docs.columns
                assert all(r[c] == "keep" for r in out.collect() for c in CLASHES), name
                now = out
        if start is docs:
            assert {r.doc_id for r in out.collect()} == {1, 3, None}
        else:
            assert out.count() == 0


def test_workers_hold_few_rows_and_small_blocks_at_once(monkeypatch):
    """Signatures leave a worker after some hundred texts, not after an Arrow batch of thousands, and the last stage asks for blocks below op4's size."""
    texts = [f"a b c d e f{i} g h i j k{i % 7}".encode() for i in range(1_200)]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.binary())})
    out = list(jaccard._sign(5, 80)([batch]))
    assert max(b.num_rows for b in out) <= jaccard.SIGNED_AT_ONCE < 1_200
    alone = [jaccard.shingles(t, 5, jaccard.WordHashes()) for t in texts]
    assert [c for b in out for c in b.column(0).to_pylist()] == [jaccard.class_of(f) for f in alone]
    assert [s for b in out for s in b.column(1).to_pylist()] == [jaccard.signatures(f, 80).view("i8").tolist() for f in alone]

    asked = []
    monkeypatch.setattr(bpe, "encode", lambda *a, block_chars=pretokens.BLOCK_CHARS, **b: asked.append(block_chars))
    monkeypatch.setattr(bpe, "decode", lambda *a: None)
    monkeypatch.setattr(bpe, "digests", lambda *a: None)
    corpus_pipeline.encoded(None, None, "")
    assert asked and 4 * asked[0] <= pretokens.BLOCK_CHARS
