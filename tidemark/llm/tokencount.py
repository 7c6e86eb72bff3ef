"""Token counts without token ids.

Each distinct pre-token is split into pieces once; a document's count is the
sum, over its bag of pre-tokens, of frequency times pieces.

Cases: null text is empty and counts no tokens; a null id stays null; a very
long text is a block of its own, its distinct pre-tokens must fit in the memory
of a task; nothing is ranked, so there are no ties; repeated rows are counted
row by row; an empty table gives an empty table; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .bpe import merge
from .pretokens import BLOCK_CHARS, assemble, blocks, flat, resolve, unpack

#: The split of a byte-level pre-tokenizer (fixed value of the public format).
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes stand for themselves, the others follow 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_merges(path: str) -> tuple[dict[tuple[bytes, bytes], int], list[str]]:
    """The merges (pair to rank) and the special strings of a byte-level BPE file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if spec["model"]["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec["pre_tokenizer"].get("add_prefix_space") or spec.get("normalizer"):
        raise ValueError("only byte-level BPE without normaliser or prefix space")
    letters = byte_letters()
    raw = lambda s: bytes(letters[c] for c in s)
    pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
    return {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}, [t["content"] for t in spec.get("added_tokens", [])]


def _splitter(special: list[str]):
    cut_at = "(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")" if special else None

    def split(text: str) -> list[str]:
        import regex

        if cut_at is None:
            return regex.findall(BYTE_LEVEL, text)
        out: list[str] = []
        for i, part in enumerate(re.split(cut_at, text)):
            if i % 2:
                out.append(part)
            else:
                out += regex.findall(BYTE_LEVEL, part)
        return out

    return split


def _counter(shared):
    def make():
        merges, special = shared.value
        rank = lambda a, b: merges.get((a, b))
        return lambda word: [1 if word in special else len(merge(word, rank))]

    return make


def _sums(block: pa.Table, answers: pa.Table) -> pa.Table:
    pos, _, counts = flat(answers)
    pieces = np.zeros(len(pos), np.int64)
    pieces[pos] = counts
    out: dict[str, list] = {"doc_id": [], "n_bytes": [], "n_tokens": []}
    for row in range(block.num_rows):
        sizes = np.asarray(block.column("size")[row].values, np.int64)
        weighted = pieces[unpack(block.column("codes")[row].as_py())] * unpack(block.column("freqs")[row].as_py())
        total = np.concatenate([[0], np.cumsum(weighted)]).astype(np.int64)
        ends = np.cumsum(sizes)
        out["doc_id"] += block.column("doc_id")[row].as_py()
        out["n_bytes"] += block.column("n_bytes")[row].as_py()
        out["n_tokens"] += (total[ends] - total[ends - sizes]).tolist()
    return pa.table(out, schema=pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())]))


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens, over_limit).

    Special strings inside a text count as one token each, as the library's
    default has it. The merges (bounded by the vocabulary) are broadcast.
    """
    merges, special = read_merges(tokenizer_path)
    shared = docs.sparkSession.sparkContext.broadcast((merges, {s.encode() for s in special}))
    found = blocks(docs, id_col, text_col, _splitter(special), bag=True, block_chars=block_chars)
    answers = resolve(found, _counter(shared))
    sums = assemble(found, answers, ["doc_id", "n_bytes", "size", "codes", "freqs"], _sums, "doc_id long, n_bytes long, n_tokens long")
    return sums.withColumn("over_limit", F.col("n_tokens") > limit)
