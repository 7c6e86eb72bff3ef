"""Alignment of two tokenizations of the same bytes, and how often their tokens are linked corpus-wide.

Diagonal run skipping: both tokenizations are arrays of byte offsets at which
tokens end. At an index shift (b's index less a's) stretches of one-to-one
groups are equal slices; they are found by probing slices of doubling length
and the first difference in the slice that fails. There the group is irregular:
a walk over both arrays, always from the smaller end, meets each overlapping
pair of tokens once and stops where both end, with a new shift.

Neither tokenizer joins bytes across the start of white space (but for white
space that pieces of the second one end with, as some do with a carriage
return). So a text is a row of units, white space and what follows it, and a
block of documents is tokenized and aligned as the row of its distinct units:
what a document has is put together from its units. Corpus-wide counts, in three steps:

1. Documents are aligned in blocks of a bounded number of characters, written
   to the shared folder. A block keeps each distinct id pair once, with the
   number of its documents that hold it; documents keep numbers of pairs.
2. Pairs are summed over the blocks, and the highest count of each id of the
   first tokenizer is found (a group has no more rows than the second
   vocabulary has ids); a join brings both back to the asking blocks.
3. Blocks and their answers meet by block number.

Texts and tokens are never shuffled, only pairs of blocks and numbers of pairs.

Cases: a text that is null, empty or not given back by both tokenizers has no
tokens: zeros, and '' as its digest; a null id stays null; a very long text is
a block of its own, its tokens must fit in the memory of a task; ties for the
highest count all count as best; repeated rows are documents of their own; an
empty table gives an empty table; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import defaultdict
from collections.abc import Callable
from itertools import chain, compress, count
from operator import ne

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .bpe import merge
from .common import cut
from .pretokens import pack, unpack
from .tokencount import BYTE_LEVEL, byte_letters, read_merges

BLOCK_CHARS = 5_000_000
#: Unicode's white space (fixed value).
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: What stands for a space in the pieces of the second tokenizer.
SPACE = "▁"
OF_DOCUMENT = {"doc_id": "long", "n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "groups_sha256": "string", "size": "int"}
BLOCK = "block long, " + ", ".join(f"{k} array<{v}>" for k, v in OF_DOCUMENT.items()) + ", codes binary, freqs binary, pairs array<long>, holds array<long>"
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def run_length(a: list[int], b: list[int], i: int, j: int) -> int:
    """How many ends from ``a[i]`` and ``b[j]`` on are the same; one at least is."""
    known, step = 1, 2
    while (left := a[i + known : i + known + step]) == (right := b[j + known : j + known + step]):
        known += len(left)
        if len(left) < step:
            return known  # both arrays end here
        step *= 2
    return known + next(compress(count(), map(ne, left, right)), min(len(left), len(right)))


def align(a: list[int], b: list[int]) -> tuple[list[tuple[int, int, int, int]], list[int], list[int]]:
    """For arrays of ends with one last end: stretches (i, i', j, j') in order, and the indices of the overlapping pairs of irregular ones.

    A stretch whose first ends are the same is a run of one-to-one groups,
    otherwise it is one group.
    """
    stretches, left, right = [], [], []
    i = j = 0
    n = len(a)
    while i < n:
        x, y = a[i], b[j]
        if x == y:
            k = run_length(a, b, i, j)
            stretches.append((i, i + k, j, j + k))
            i, j = i + k, j + k
            continue
        p, q = i, j
        left.append(p)
        right.append(q)
        while x != y:
            if x < y:
                p += 1
                x = a[p]
            else:
                q += 1
                y = b[q]
            left.append(p)
            right.append(q)
        stretches.append((i, p + 1, j, q + 1))
        i, j = p + 1, q + 1
    return stretches, left, right


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


class Units:
    """Distinct units, tokenized and aligned: for each its tokens, groups, links (as pairs of ids) and whether its bytes come back."""

    def __init__(self, units: list[str], first, second):
        (a_ids, self.n_a), (b_ids, self.n_b) = first(units), second(units)
        self.good = second.gives_back(units, b_ids, self.n_b)
        if not self.good.all():
            a_ids, b_ids = a_ids[np.repeat(self.good, self.n_a)], b_ids[np.repeat(self.good, self.n_b)]
            self.n_a, self.n_b = self.n_a * self.good, self.n_b * self.good
        a_ends, b_ends = np.cumsum(first.lengths[a_ids]), np.cumsum(second.lengths[b_ids])
        stretches, left, right = align(a_ends.tolist(), b_ends.tolist())
        i, i_end, j, j_end = np.array(stretches, np.int64).reshape(-1, 4).T
        run = a_ends[i] == b_ends[j]
        left, right = (np.concatenate([spread(x[run], (i_end - i)[run]), np.array(y, np.int64)]) for x, y in ((i, left), (j, right)))
        of_link = np.repeat(np.arange(len(units)), self.n_a)[left]
        order = np.argsort(of_link, kind="stable")
        self.pairs = ((a_ids[left] << 32) + b_ids[right])[order]
        self.n_links = np.bincount(of_link, minlength=len(units))
        self.n_groups = self.n_a + self.n_b - self.n_links  # a walk through n and m tokens has n + m - 1 pairs
        groups = group_texts(zip(*(x.tolist() for x in (i, i_end, j, j_end, run)), strict=True), list(map(str, a_ids.tolist())), list(map(str, b_ids.tolist())))
        ends = np.cumsum(self.n_groups).tolist()
        self.texts = [";".join(groups[s:e]) for s, e in zip([0, *ends], ends, strict=False)]


def group_texts(stretches, a: list[str], b: list[str]) -> list[str]:
    groups: list[str] = []
    for i, i_end, j, j_end, run in stretches:
        if run:
            groups += [f"{x}|{y}" for x, y in zip(a[i:i_end], b[j:j_end], strict=True)]
        else:
            groups.append(f"{','.join(a[i:i_end])}|{','.join(b[j:j_end])}")
    return groups


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return np.fromiter(chain.from_iterable(lists), np.int64), np.fromiter(map(len, lists), np.int64, len(lists))


class ByteTokens:
    """Ids of units by a byte-level BPE. ``ids`` are the ranks of its merges, so a merge is known by the bytes that it makes (see ``check_ranks``)."""

    def __init__(self, ids: dict[bytes, int]):
        import tiktoken

        self.library = tiktoken.Encoding("units", pat_str=BYTE_LEVEL, mergeable_ranks=ids, special_tokens={})
        self.lengths = np.zeros(max(ids.values(), default=0) + 1, np.int64)
        self.lengths[list(ids.values())] = list(map(len, ids))

    def __call__(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids, and how many each unit has."""
        return flat(list(map(self.library.encode_ordinary, units)))


class PieceTokens:
    """Ids of units by a SentencePiece model."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.vocab_size())]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) or "\n" in p[1:] or "\n" in p[:-1] for p in pieces):
            raise ValueError("a piece joins units")
        joins = {c for p in pieces for c in re.findall(f"[^{WHITE}{SPACE}]([{WHITE}])", p)}
        more = f"(?:[{re.escape(''.join(joins))}][{WHITE}]*[^{WHITE}]*)*" if joins else ""
        self.unit = re.compile(f"[{WHITE}]*[^{WHITE}]+{more}|[{WHITE}]+")
        self.bytes = [bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.lengths = np.array(list(map(len, self.bytes)))
        self.space, self.line = [self.library.piece_to_id(SPACE)], len(self.library.encode("\n"))

    def __call__(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The library puts a space before what it is given: it takes the place of a unit's first space, or goes with a line end before other units."""
        found = self.library.encode([u[1:] if u[0] == " " else "\n" + u for u in units], num_threads=1)
        for n, u in enumerate(units):
            if u[0] != " ":
                found[n] = found[n][self.line :]
            elif len(u) == 1:
                found[n] = self.space
        return flat(found)

    def gives_back(self, units: list[str], ids: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the pieces of each unit are its bytes. A unit with the letter that stands for a space is told apart by it."""
        raw = list(map(self.bytes.__getitem__, ids.tolist()))
        if b"".join(raw) == "".join(units).encode():
            return np.ones(len(units), bool)
        ends = np.cumsum(n).tolist()
        return np.array([b"".join(raw[s:e]) == u.encode() for u, s, e in zip(units, [0, *ends], ends, strict=False)], bool)


def check_ranks(merges: dict[tuple[bytes, bytes], int], ids: dict[bytes, int]) -> None:
    """Raises where merging the pair whose joined bytes have the lowest id is not the same as merging by the list of pairs.

    It is the same if ids are in the order of the merges and the merges before
    a token's own lead from its bytes to the pair of its own merge: two parts
    of a token's bytes were then made by merges inside these bytes alone.
    """
    order = [ids[a + b] for a, b in merges]
    if order != sorted(set(order)):
        raise ValueError("the ids do not follow the merges")
    for (a, b), rank in merges.items():
        if len(a) + len(b) > 2 and merge(a + b, lambda x, y: r if (r := merges.get((x, y))) is not None and r < rank else None) != [a, b]:
            raise ValueError(f"another merge makes {a + b!r}")


def _blocks(make: Callable[[], tuple], block_chars: int, schema: pa.Schema):
    def run(batches):
        first, second = make()
        serial = count(TaskContext.get().partitionId() << 32)

        def emit(doc_ids, texts, local, codes):
            found = Units(list(local), first, second)
            known, number = np.unique(found.pairs, return_inverse=True)
            starts = np.cumsum(found.n_links) - found.n_links
            none = (0, 0, 0, 0, ""), np.empty(0, np.int64), np.empty(0, np.int64)

            def document(own):
                units, times = np.unique(own, return_counts=True)
                if not len(units) or not found.good[units].all():
                    return none
                n = found.n_links[units]
                held, at = np.unique(number[spread(starts[units], n)], return_inverse=True)
                figures = (int(x[units] @ times) for x in (found.n_a, found.n_b, found.n_groups, found.n_links))
                digest = hashlib.sha256(";".join(map(found.texts.__getitem__, own.tolist())).encode()).hexdigest()
                return (*figures, digest), held, np.bincount(at, np.repeat(times, n)).astype(np.int64)

            distinct = list(map(document, codes))
            rows = [distinct[t] for t in texts]
            holds = np.zeros(len(known), np.int64)
            for _, held, _ in rows:
                holds[held] += 1
            columns = dict(zip(OF_DOCUMENT, ([list(v)] for v in zip(*((i, *figures, len(held)) for i, (figures, held, _) in zip(doc_ids, rows, strict=True)), strict=True)), strict=True))
            columns |= {"block": [next(serial)], "codes": [pack(np.concatenate([r[1] for r in rows]))], "freqs": [pack(np.concatenate([r[2] for r in rows]))], "pairs": [known[holds > 0]], "holds": [holds[holds > 0]]}
            if not (holds > 0).all():  # pairs that only documents without tokens have
                columns["codes"] = [pack((np.cumsum(holds > 0) - 1)[np.concatenate([r[1] for r in rows])])]
            return pa.RecordBatch.from_pydict(columns, schema=schema)

        def fresh():
            return [], [], defaultdict(count().__next__), [], {}

        (doc_ids, texts, local, codes, seen), chars = fresh(), 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), (x.as_py() or "" for x in batch.column(1)), strict=True):
                at = seen.setdefault(text, len(seen))
                if at == len(codes):  # copies of a text are aligned once in a block
                    units = second.unit.findall(" " + text) if text else []
                    codes.append(np.fromiter(map(local.__getitem__, units), np.int64, len(units)))
                    chars += len(text)
                doc_ids.append(doc_id)
                texts.append(at)
                if chars >= block_chars or len(doc_ids) >= block_chars // 100:
                    yield emit(doc_ids, texts, local, codes)
                    (doc_ids, texts, local, codes, seen), chars = fresh(), 0
        if doc_ids:
            yield emit(doc_ids, texts, local, codes)

    return run


def _totals(key, block: pa.Table, answers: pa.Table) -> pa.Table:
    """Rows of a block's documents; answers in order of their pairs are in the order of the block's numbers."""
    order = np.argsort(answers.column("pair").to_numpy())
    docs, best = (answers.column(c).to_numpy()[order].astype(np.int64) for c in ("docs", "best"))
    codes, freqs = (unpack(block.column(c)[0].as_py()) for c in ("codes", "freqs"))
    sizes = np.asarray(block.column("size")[0].values, np.int64)
    ends = np.cumsum(sizes)

    def by_document(value):
        total = np.concatenate([[0], np.cumsum(value[codes] * freqs)]).astype(np.int64)
        return pa.array(total[ends] - total[ends - sizes], pa.int64())

    out = {k: block.column(k)[0].values for k in OF_DOCUMENT if k != "size"} | {"n_best": by_document(best), "count_sum": by_document(docs)}
    return pa.table({k: out[k] for k in (x.split()[0] for x in ALIGNED.split(", "))})


def align_documents(docs: DataFrame, byte_bpe_path: str, piece_model_path: str, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Rows (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256); both vocabularies (bounded) are broadcast."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    merges, special = read_merges(byte_bpe_path)
    letters = byte_letters()
    with open(byte_bpe_path, encoding="utf-8") as f:
        ids = {bytes(letters[c] for c in token): i for token, i in json.load(f)["model"]["vocab"].items() if token not in special}
    check_ranks(merges, ids)
    with open(piece_model_path, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast((ids, f.read()))

    def make():
        ids, model = shared.value
        return ByteTokens(ids), PieceTokens(model)

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = cut(chosen.mapInArrow(_blocks(make, block_chars, to_arrow_schema(_parse_datatype_string(BLOCK))), BLOCK), "aligned")
    asked = found.select("block", F.explode(F.arrays_zip("pairs", "holds")).alias("x")).select("block", F.col("x.pairs").alias("pair"), F.col("x.holds").alias("holds"))
    counts = asked.groupBy("pair").agg(F.sum("holds").alias("docs")).withColumn("a", F.shiftright("pair", 32))
    highest = counts.groupBy("a").agg(F.max("docs").alias("most"))
    known = counts.join(highest, "a").select("pair", "docs", (F.col("docs") == F.col("most")).cast("int").alias("best"))
    answers = asked.select(F.col("block").alias("asking"), "pair").join(known, "pair")
    return found.drop("pairs", "holds").groupBy("block").cogroup(answers.groupBy("asking")).applyInArrow(_totals, ALIGNED)
