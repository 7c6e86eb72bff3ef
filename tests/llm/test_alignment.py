"""Token alignment against whole-text library calls and all-pairs overlaps."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest

from tidemark.llm import alignment
from tidemark.llm.tokencount import byte_letters

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "a  b", "  a", " ", "   ", "\n", "a \n b", "\ta\t\tb", "x\r\ny\r\n\r\nz", "end\r\n", "a;\r", "\r", " \r x", "{ }\r\n}\r", "a▁b", "▁", "ok▁", "a\x00b\x1cc\x1fd e", "\x85n l", "　x \xa0 y", "'s 't's it's\n's", "12 345,6 7", "ﬁ é é",
    "\U0001f600\U0001f601 中文字", "<|endoftext|> </s><s> <unk> <0x0A>", "naïve Straße", "the the the", "The quick brown fox", "abc" * 500, "กข हि", "  \n  two\n\n\nlines  \n", "tail \n ", "a​b c",
]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    letters = byte_letters()
    second = sentencepiece.SentencePieceProcessor(model_file=B)
    plain = lambda i: bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()

    def both(text):
        if not text:
            return None
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        raw = [[bytes(letters[c] for c in first.id_to_token(i)) for i in a], [plain(i) for i in b]]
        return (a, b, *raw) if all(b"".join(x) == (" " + text).encode() for x in raw) else None

    return both


def spans(raw):
    at, out = 0, []
    for x in raw:
        out.append((at, at + len(x)))
        at += len(x)
    return out


def brute(rows, both):
    """Rows by definition: whole texts, sets of ends, every pair of tokens."""
    out, holding, linked = [], Counter(), []
    for doc_id, text in rows:
        links, figures = [], (0, 0, 0, "")
        if found := both(text):
            a, b, *raw = found
            sa, sb = map(spans, raw)
            low = 0
            for x, (s, e) in zip(a, sa, strict=True):
                while low < len(sb) and sb[low][1] <= s:
                    low += 1
                links += [(x, b[n]) for n in range(low, len(sb)) if sb[n][0] < e and s < sb[n][1]] if len(sb) < 400 else []
                n = low
                while len(sb) >= 400 and n < len(sb) and sb[n][0] < e:
                    links.append((x, b[n]))
                    n += 1
            ends = sorted({e for _, e in sa} & {e for _, e in sb})
            ga, gb = defaultdict(list), defaultdict(list)
            for side, ids, sp in ((ga, a, sa), (gb, b, sb)):
                k = 0
                for i, (_, e) in zip(ids, sp, strict=True):
                    while ends[k] < e:
                        k += 1
                    side[k].append(str(i))
            text = ";".join(",".join(ga[k]) + "|" + ",".join(gb[k]) for k in range(len(ends)))
            figures = (len(a), len(b), len(ends), hashlib.sha256(text.encode()).hexdigest())
        out.append((doc_id, figures))
        linked.append(links)
        holding.update(set(links))
    most = defaultdict(int)
    for (x, _), n in holding.items():
        most[x] = max(most[x], n)
    return sorted(((i, *f[:3], len(v), sum(holding[p] == most[p[0]] for p in v), sum(holding[p] for p in v), f[3]) for (i, f), v in zip(out, linked, strict=True)), key=repr)


def got(spark, rows, **how):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, block string, pair int").repartition(3)
    return sorted((tuple(r) for r in alignment.align_documents(df, A, B, **how).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=repr)


@pytest.mark.parametrize("block_chars", [40, 1_000_000])
def test_odd_texts_equal_brute_force(spark, libraries, block_chars):
    rows = [*enumerate([*ODD, *ODD[:5], None, ""]), (3, "twice"), (None, "no id")]
    want = brute(rows, libraries)
    assert got(spark, rows, block_chars=block_chars) == want
    assert sum(r[1] > 0 for r in want) > 30


def test_documents_equal_brute_force(spark, small, libraries):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(10_000 + i, "  ".join(t for _, t in rows[:60])) for i in range(2)]  # very long, and copies
    assert got(spark, rows, block_chars=60_000) == brute(rows, libraries)


def test_random_texts_equal_brute_force(spark, libraries):
    r = random.Random(4)
    letters = "aA eé\n\r\t ;{)'1 　▁中" + "  "
    rows = [(i, "".join(r.choice(letters) for _ in range(r.randrange(30)))) for i in range(400)]
    assert got(spark, rows) == brute(rows, libraries)


def test_empty_table(spark):
    assert got(spark, []) == []


def test_stretches_cover_both_sides():
    r = random.Random(1)
    for _ in range(300):
        n = r.randrange(1, 200)
        ends = [sorted({*r.sample(range(1, n + 1), r.randrange(1, n + 1)), n}) for _ in range(2)]
        if r.random() < 0.5:
            ends[1] = sorted({*ends[0], *ends[1][: r.randrange(4)]})
        stretches, left, right = alignment.align(*ends)
        common = sorted({*ends[0]} & {*ends[1]})
        found, pairs = [], list(zip(left, right, strict=True))
        for i, i_end, j, j_end in stretches:
            run = ends[0][i] == ends[1][j]
            assert not run or ends[0][i:i_end] == ends[1][j:j_end]
            found += ends[0][i:i_end] if run else [ends[0][i_end - 1]]
            pairs += list(zip(range(i, i_end), range(j, j_end), strict=True)) if run else []
        assert found == common
        starts = [[0, *x] for x in ends]
        assert sorted(pairs) == [(p, q) for p, e in enumerate(ends[0]) for q, f in enumerate(ends[1]) if starts[0][p] < f and starts[1][q] < e]


def test_ranks_that_do_not_give_the_merges_are_refused():
    ids = {b"a": 0, b"b": 1, b"c": 2, b"bc": 3, b"ab": 4, b"abc": 5}
    alignment.check_ranks({(b"b", b"c"): 0, (b"a", b"b"): 1, (b"a", b"bc"): 2}, ids)
    with pytest.raises(ValueError, match="another merge"):
        alignment.check_ranks({(b"b", b"c"): 0, (b"a", b"b"): 1, (b"ab", b"c"): 2}, ids)
    with pytest.raises(ValueError, match="follow"):
        alignment.check_ranks({(b"a", b"b"): 0, (b"b", b"c"): 1}, ids)
