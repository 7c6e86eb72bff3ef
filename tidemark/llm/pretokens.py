"""Global distinct-word work over pre-tokenised documents.

Three steps, used by the BPE codec and the token counter:

1. ``blocks`` cuts each input partition into blocks of a bounded number of
   characters, written to the shared folder. A block keeps its distinct
   pre-tokens once; its documents refer to them by local number, in text order
   (the positions) or as a bag of (number, frequency).
2. ``resolve`` shuffles the blocks' distinct pre-tokens by word, encodes each
   distinct word once, and addresses the answer to the asking blocks. A word
   however frequent costs one entry for each block.
3. ``assemble`` shuffles the answers by block; the task that has a block's
   answers reads the block's numbers from its file.

Only words and answers are shuffled; texts and their numbers never are. A lost
executor costs its tasks: files stay in the shared folder.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import cut

BLOCK = "block long, doc_id array<long>, n_bytes array<long>, size array<int>, codes binary, freqs binary, words array<binary>"
BLOCK_CHARS = 16_000_000
LEAST_BUCKETS, MOST_BUCKETS = 256, 65_536


def pack(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers as zstd over their four byte planes."""
    planes = np.ascontiguousarray(numbers, dtype="<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _blocks(split: Callable[[str], list[str]], bag: bool, block_chars: int, schema: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        serial = count(first)

        def fresh():
            return defaultdict(count().__next__), [], [], [], [], []

        def emit(local, ids, n_bytes, sizes, codes, freqs):
            flat = lambda x: pack(np.concatenate(x)) if x else pack(np.empty(0, np.uint32))
            return pa.RecordBatch.from_pydict(
                {"block": [next(serial)], "doc_id": [ids], "n_bytes": [n_bytes], "size": [sizes], "codes": [flat(codes)], "freqs": [flat(freqs)], "words": [[w.encode() for w in local]]},
                schema=schema,
            )

        state, chars = fresh(), 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), (x.as_py() for x in batch.column(1)), strict=True):
                local, ids, n_bytes, sizes, codes, freqs = state
                pieces = split(text)
                if bag:
                    tally = Counter(pieces)
                    freqs.append(np.fromiter(tally.values(), np.uint32, len(tally)))
                    pieces = tally.keys()
                codes.append(np.fromiter(map(local.__getitem__, pieces), np.uint32, len(pieces)))
                ids.append(doc_id)
                n_bytes.append(len(text.encode()) if bag else 0)
                sizes.append(len(pieces))
                chars += len(text)
                if chars >= block_chars:
                    yield emit(*state)
                    state, chars = fresh(), 0
        if state[1]:
            yield emit(*state)

    return run


def blocks(docs: DataFrame, id_col: str, text_col: str, split: Callable[[str], list[str]], bag: bool = False, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per block, written to the shared folder. Null texts count as empty."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(BLOCK))
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    each = {"parquet.block.size": 1 << 20, "parquet.block.size.row.check.min": 1}  # a row group for each block
    return cut(chosen.mapInArrow(_blocks(split, bag, block_chars, arrow), BLOCK), "blocks", **each)


def pack_words(words: list[bytes]) -> bytes:
    lengths = pack(np.fromiter(map(len, words), np.uint32, len(words)))
    return len(lengths).to_bytes(4, "little") + lengths + zstandard.ZstdCompressor(level=3).compress(b"".join(words))


def unpack_words(data: bytes) -> list[bytes]:
    at = 4 + int.from_bytes(data[:4], "little")
    ends = np.cumsum(unpack(data[4:at])).tolist()
    raw = zstandard.ZstdDecompressor().decompress(data[at:])
    return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _requests(buckets: int):
    def run(batches):
        for batch in batches:
            for block, file, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                words = np.array(words.values.to_pylist(), object)
                bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int32, len(words))
                order = np.argsort(bucket, kind="stable")
                names, starts = np.unique(bucket[order], return_index=True)
                parts = np.split(order, starts[1:])
                if not len(words):  # a block of empty texts still has to be assembled
                    names, parts = np.zeros(1, np.int32), [order]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int32()), pa.array(np.full(len(names), block, np.int64)), pa.array([file] * len(names)), pa.array([pack(np.diff(p, prepend=0)) for p in parts], pa.binary()), pa.array([pack_words(words[p].tolist()) for p in parts], pa.binary())],
                    names=["bucket", "block", "file", "pos", "words"],
                )

    return run


def _answers(make: Callable[[], Callable[[bytes], list[int]]]):
    def run(batches):
        encode, memo, current = make(), {}, None
        for batch in batches:
            all_lens, all_ids = [], []
            for bucket, data in zip(batch.column(0).to_pylist(), batch.column(4), strict=True):
                if bucket != current:  # every copy of a word is in one bucket, and buckets come in order
                    memo, current = {}, bucket
                ids: list[int] = []
                lens: list[int] = []
                for w in unpack_words(data.as_py()):
                    found = memo.get(w)
                    if found is None:
                        found = memo[w] = encode(w)
                    ids += found
                    lens.append(len(found))
                all_lens.append(pack(np.array(lens, np.uint32)))
                all_ids.append(pack(np.array(ids, np.uint32)))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in (1, 2, 3)), pa.array(all_lens, pa.binary()), pa.array(all_ids, pa.binary())], names=["block", "file", "pos", "lens", "ids"])

    return run


def resolve(found: DataFrame, make: Callable[[], Callable[[bytes], list[int]]]) -> DataFrame:
    """For each block, the encodings of its distinct words: rows (block, file, pos, lens, ids), packed.

    ``make()`` runs once in a task and returns the encoder of one word. The
    number of word buckets follows the number of blocks, so that what a task
    remembers of one bucket stays small.
    """
    buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, 4 * found.count()))
    asked = found.select("block", F.col("_metadata.file_path").alias("file"), "words").mapInArrow(_requests(buckets), "bucket int, block long, file string, pos binary, words binary")
    grouped = asked.repartition("bucket").sortWithinPartitions("bucket")
    return grouped.mapInArrow(_answers(make), "block long, file string, pos binary, lens binary, ids binary")


def _read_block(file: str, block: int, columns: list[str]) -> pa.Table:
    system, path = fs.FileSystem.from_uri(file)
    with system.open_input_file(path) as f:
        stored = pq.ParquetFile(f)
        for group in range(stored.num_row_groups):
            if block in (held := stored.read_row_group(group, ["block"]).column(0).to_pylist()):
                return stored.read_row_group(group, columns).slice(held.index(block), 1)
    raise ValueError(f"{file} has no block {block}")


def assemble(found: DataFrame, answers: DataFrame, columns: list[str], rows: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``rows(block, answers)`` of every block, with the block's stored ``columns``."""

    def run(key, answers):
        return rows(_read_block(answers.column("file")[0].as_py(), key[0].as_py(), columns), answers)

    parts = max(1, min(MOST_BUCKETS, found.count()))  # an explicit number: answers are small, the blocks behind them are not
    return answers.repartition(parts, "block").groupBy("block").applyInArrow(run, schema)


def flat(answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers, lengths and ids of one block's answers, flattened."""
    column = lambda name, f: np.concatenate([f(unpack(x)) for x in answers.column(name).to_pylist()] or [np.empty(0, np.int64)]).astype(np.int64)
    same = lambda x: x
    return column("pos", np.cumsum), column("lens", same), column("ids", same).astype(np.int32)
