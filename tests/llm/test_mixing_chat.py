import hashlib
import random
import re
from collections import defaultdict

import pytest

from tidemark.llm import chat, mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(size_of):
    names = sorted((s for s in size_of if s is not None), key=lambda s: s.encode()) + [None] * (None in size_of)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, target, free = sum(size_of.values()), {}, set(names)
    rest = float(total)
    while free:
        unit = rest / sum(weight[s] for s in free)
        above = [s for s in free if unit * weight[s] > 3 * size_of[s]]
        if not above:
            return target | {s: unit * weight[s] for s in free}
        for s in above:
            target[s] = 3.0 * size_of[s]
            rest -= target[s]
            free.remove(s)
    return target


def rows_of(spark, small):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    return rows + [(-1, None, None), (-2, "a b  c\n" * 40, None), (-3, "one", "tiny"), (-4, "", "zero"), (-5, "x " * 5000, "hot"), (-5, "x " * 5000, "hot"), (None, "y " * 300, "hot")]


def test_targets_and_takes(spark, small):
    rows = rows_of(spark, small)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 as size", "'x' as row")
    got = mixing.taken_words(df).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want = brute_targets(sizes)
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    by_target = defaultdict(int)
    for r in got:
        assert r.taken <= 3 * r.size
        by_target[(r.source_size, round(r.target, 3))] += r.taken
    assert {(sizes[s], round(want[s], 3)) for s in sizes} == set(by_target)
    for (size, target), taken in by_target.items():
        n = sum((sizes[s], round(want[s], 3)) == (size, target) for s in sizes)
        assert abs(taken - n * target) <= 0.5 * n, (size, target, taken)
    assert sorted(map(str, got)) == sorted(map(str, mixing.taken_words(df.repartition(5)).collect()))
    assert mixing.taken_words(df.limit(0)).count() == 0


def test_mixed_texts_hold_the_taken_words(spark, small):
    rows = [r for r in rows_of(spark, small) if r[0] not in (None, -5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("doc_id", "text", "'en' as lang", "source", "1L as n_chars")
    taken = {r.doc_id: r.taken for r in mixing.taken_words(df).collect()}
    got = defaultdict(int)
    texts = {r[0]: r[1] for r in rows}
    for r in mixing.mixed_documents(df).collect():
        ws = WORD.findall(r.text)
        got[r.doc_id] += len(ws)
        assert r.n_chars == len(r.text) and r.lang == "en"
        assert set(ws) <= set(WORD.findall(texts[r.doc_id]))
    assert got == {k: v for k, v in taken.items() if v}


def test_mix_does_not_depend_on_the_order_of_rows(spark):
    rows = [(None, " ".join(f"w{i}x{j}" for j in range(40)), s, i) for i in range(60) for s in ("a", None)]
    rows += [(7, "of one text", "a", i) for i in range(30)] + [(9, "small", "b", 0)]  # equal ids and texts, other columns differ
    mixes = []
    for order in (rows, rows[::-1], random.Random(2).sample(rows, len(rows))):
        df = spark.createDataFrame(order, "doc_id long, text string, source string, url int").repartition(1 + len(mixes))
        mixes.append(sorted(map(str, mixing.mixed_documents(df, block_words=16).collect())))
    assert mixes[0] == mixes[1] == mixes[2] and len(mixes[0]) > 50
    with_map = df.selectExpr("*", "map('k', url) as m")
    assert mixing.mixed_documents(with_map).count() > 50


def test_mix_plan_has_no_python(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for frame in (mixing.taken_words(docs), mixing.mixed_documents(docs)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_shuffles_are_permutations(spark):
    for n in (1, 2, 7, 100, 1001):
        out = [r[0] for r in spark.range(n).select(mixing.shuffled(mixing.F.col("id"), mixing.F.lit(n), mixing.F.lit(3))).collect()]
        assert sorted(out) == list(range(n))
    assert out != list(range(n))


def test_counts_meet_quotas(spark):
    sources = spark.createDataFrame([(0, "a", 10_000, 5, 12_000.0), (1, "b", 500, 5, 1500.0), (2, None, 65, 1, 100.0), (3, "z", 0, 1, 0.0)], "s int, source string, source_size long, docs long, target double")
    plan = mixing.planned(sources, block_words=10)
    counts, slots = mixing.slots(plan, shard_slots=100)
    per = {r.s: r.n for r in counts.groupBy("s").agg(mixing.F.sum("n").alias("n")).collect()}
    assert per == {0: 1200, 1: 150, 2: 10}
    shards = {r.shard: r.n for r in counts.groupBy("shard").agg(mixing.F.sum("n").alias("n")).collect()}
    assert [shards[i] for i in range(14)] == [100] * 13 + [60]
    drawn = [r.n for r in counts.filter("s = 1").collect()]
    assert len(set(drawn)) > 3 and min(drawn) < 9 < 13 < max(drawn)  # drawn, not dealt evenly
    seen = slots.groupBy("s", "block").count().collect()
    assert len(seen) == 1360 and {r["count"] for r in seen} == {1}


def test_clashing_names_empty_tables_and_long_texts(spark):
    rows = [(1, "a b c " * 30, "s", "keep"), (1, "a b c " * 30, "s", "keep"), (None, "long " * 200_000, None, "keep"), (3, None, "s", "keep"), (4, "", "s", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, row string").selectExpr("*", "1 as parts", "2 as doc", "3 as pass", "'f' as first", "0 as n_chars", "5 as `a.b`".replace("a.b", "block"))
    got = mixing.mixed_documents(df)
    assert got.columns == df.columns and got.dtypes == df.dtypes
    rows = got.collect()
    assert {r.row for r in rows} == {"keep"} and {r.parts for r in rows} == {1} and {r.doc for r in rows} == {2}
    assert sum(r.n_chars for r in rows if r.doc_id is None) > 600_000
    assert mixing.mixed_documents(df.limit(0)).count() == 0


CHATS = [
    (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
    (1, 1, "assistant", "b\\e \\"), (1, 0, "user", None), (1, 2, "\\odd[/INST]", "\\b\\s<s></s"), (1, 3, "assistant", "<s></s>\\</s>"),
    (2, 0, None, ""), (3, 5, "assistant", ""), (3, 5, "assistant", ""), (3, 4, "user</s>", "</"), (4, 0, "user", "x</s"), (4, 1, "assistant", ">\x00y"),
    (5, None, "system", "s"), (None, 0, "user", "u"), (6, 0, "assistant", "\\e"), (6, 1, "[INST]", "[INST]<s>"),
]


def digest(x):
    return hashlib.sha256(x.encode()).hexdigest()


def expected(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        convs[c].append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, ts in convs.items():
        ts.sort()
        loss = "".join(x for _, _, r, x in ts if r == "assistant")
        out[c] = (len(ts), digest("".join(f"{r}\n{x}\n" for _, _, r, x in ts)), len(loss), digest(loss))
    return out


def test_chats(spark, small):
    real = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows = real + [((c + 10**6) if c is not None and c > 0 else c, t, r, x) for c, t, r, x in CHATS]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as turns", "'x' as escaped")
    formatted = chat.format_chats(df)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(formatted).collect()}
    assert got == expected(rows)
    for r in formatted.collect():
        assert r.formatted == "".join(s.text for s in r.segments)
        assert r.formatted.count("</s>") == len(r.segments) // 3
        assert r.conv_id is None or r.conv_id > 10**6 or r.conv_id == -7 or r.escaped_turns == 0
    plan = formatted._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert chat.format_chats(df.limit(0)).count() == 0


def test_a_text_that_is_not_read_back_fails(spark, monkeypatch):
    monkeypatch.setattr(chat, "escape", lambda text: text)
    df = spark.createDataFrame([(1, 0, "user", "a</s>b")], "conv_id long, turn long, role string, text string")
    with pytest.raises(Exception, match="not read back as it was: 1"):
        chat.format_chats(df).collect()


def test_very_long_turns(spark):
    rows = [(1, 0, "user", "</s>[INST]\\" * 200_000), (1, 1, "assistant", "long words " * 500_000), (1, 2, "assistant", "\\e" * 300_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(chat.format_chats(df)).collect()}
    assert got == expected(rows)
