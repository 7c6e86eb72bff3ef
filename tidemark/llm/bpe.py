"""Byte-level BPE: encoding with one encoding of each distinct word, and decoding.

Cases: null text is the empty text and has no ids; a null id stays null; a very
long text is a block of its own, its pre-tokens and ids must fit in the memory
of a task; pairs of one rank are merged from the left, so there are no other
ties; repeated rows and repeated ids are encoded row by row; an empty table
gives an empty table; any other columns of the input are ignored, whatever
their names.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .pretokens import BLOCK_CHARS, assemble, blocks, flat, resolve, unpack

#: Pieces up to this length are merged by plain scanning, longer ones with a heap.
SCAN_LENGTH = 48
#: Pre-tokens that are reassembled at once.
CHUNK = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 token and rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merge(piece: bytes, rank: Callable[[bytes, bytes], int | None]) -> list[bytes]:
    """Merge the bytes of ``piece``, always the leftmost pair of lowest rank, until none has a rank."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    if len(parts) > SCAN_LENGTH:
        return _merge_long(parts, rank)
    while len(parts) > 1:
        best = at = None
        for i in range(len(parts) - 1):
            r = rank(parts[i], parts[i + 1])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


def _merge_long(parts: list[bytes], rank) -> list[bytes]:
    after = list(range(1, len(parts))) + [-1]
    before = list(range(-1, len(parts) - 1))
    heap: list = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] >= 0 and (r := rank(parts[i], parts[after[i]])) is not None:
            heapq.heappush(heap, (r, i, parts[i], parts[after[i]]))

    for i in range(len(parts)):
        offer(i)
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if parts[i] is not left or j < 0 or parts[j] is not right:
            continue  # one side has changed since
        parts[i], parts[j] = left + right, None
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
        offer(i)
        offer(before[i])
    return [p for p in parts if p is not None]


def splitter(pattern: str) -> Callable[[str], list[str]]:
    def split(text: str) -> list[str]:
        import regex  # compiled patterns are cached by the module

        return regex.findall(pattern, text)

    return split


def _encoder(ranks):
    def make():
        known = ranks.value

        def encode(word: bytes) -> list[int]:
            if (whole := known.get(word)) is not None:
                return [whole]
            return [known[p] for p in merge(word, lambda a, b: known.get(a + b))]

        return encode

    return make


def _reassemble(block: pa.Table, answers: pa.Table) -> pa.Table:
    pos, lens, ids = flat(answers)
    begin, length = np.zeros(len(pos), np.int64), np.zeros(len(pos), np.int64)
    begin[pos], length[pos] = np.cumsum(lens) - lens, lens
    out_ids, out_lists = [], []
    for row in range(block.num_rows):
        sizes = np.asarray(block.column("size")[row].values, np.int64)
        codes = unpack(block.column("codes")[row].as_py())
        out_ids += block.column("doc_id")[row].as_py()
        ends = np.concatenate([[0], np.cumsum(length[codes])]) if len(codes) else np.zeros(1, np.int64)
        bounds = ends[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)]
        picked = []
        for a in range(0, len(codes), CHUNK):
            part = codes[a : a + CHUNK]
            n = length[part]
            picked.append(ids[np.repeat(begin[part] - (np.cumsum(n) - n), n) + np.arange(n.sum())])
        out_lists.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(picked) if picked else np.empty(0, np.int32), pa.int32())))
    return pa.table({"doc_id": pa.array(out_ids, pa.int64()), "ids": pa.concat_arrays(out_lists) if out_lists else pa.array([], pa.list_(pa.int32()))})


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Rows (doc_id, ids): the token ids of each text, without special tokens.

    ``ranks`` (bounded by the vocabulary) is broadcast. Distinct words are
    shuffled, documents only as numbers of their words.
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    found = blocks(docs, id_col, text_col, splitter(pattern), block_chars=block_chars)
    answers = resolve(found, _encoder(shared))
    return assemble(found, answers, ["doc_id", "size", "codes"], _reassemble, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids") -> DataFrame:
    """Adds ``decoded`` (bytes) by joining the ids to the token-byte table, which is broadcast.

    A null list has null bytes; an id without a token fails the job.
    """
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    shared = encoded.sparkSession.sparkContext.broadcast(tokens)
    at = encoded.columns.index(ids_col)

    def run(batches):
        known = shared.value.__getitem__
        for batch in batches:
            data = [b"".join(map(known, np.asarray(x.values).tolist())) if x.is_valid else None for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.binary())], names=[*batch.schema.names, "decoded"])

    schema = encoded.select("*", F.lit(None).cast("binary").alias("decoded")).schema
    return encoded.mapInArrow(run, schema)


def digests(encoded: DataFrame) -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of decoded rows."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
