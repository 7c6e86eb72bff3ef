"""Exact Jaccard self-join of documents on word n-grams, by PartEnum signatures.

Sets fall into size bands. A pair whose larger set lies in band ``i`` can
differ in at most ``k`` features. PartEnum cuts the feature domain into more
than ``k / 2`` partitions, so in some partition the two sets differ in at most
one feature; of its three subpartitions the subset of the two others is the
same in both. Every band enumerates these subsets of two of three. They hold
more features than the ``k + 1`` plain partitions that would also do (about a
third more), so texts meet less by chance, for half as many signatures more.

Each non-empty subset gives one signature, and each set signs for its own band
and for those above that it can reach. Partitions beyond the least number make
up for empty subsets; a set with too many of them signs again under the next
seed, so no pair is lost by skipping them. No exact scheme can do with ``k`` or
fewer signatures, as ``k`` changes could spoil one each: their number grows
with the length of the text.

Equal sets share a 64-bit fingerprint (their class) and sign once in a task.
Signatures are several times the size of the texts, so they go from the task
that makes them into the shuffle and are in no file; what a row has besides
them is made and stored before, from the same texts.
Candidates meet in three rounds:

* each member of a bucket against the bucket's first class;
* then, in large buckets, the closest pairs that would join members still in
  different components, at most one for each member;
* then all members that are still in different components against each other,
  which makes the join exact.

The later rounds split a bucket into blocks. A sketch (additive one-byte sums
over hashed features) gives a lower bound of the difference, which rejects
nearly all unlinked pairs before any row is made.

These rounds find the components, not every link. ``linked_texts`` and
``linked_documents`` go on from there: a link never leaves its component, so
all pairs of classes inside each component are compared, each pair once, by
exact counts of common features.

Only classes that share a signature have their sets compared; sets are 64-bit
hashes of word n-grams, made anew from the texts of the pairs that remain. Of
buckets with the same members (two 64-bit fingerprints) one is searched.

Cases: null text, no word: ``n_shingles`` 0, linked with nothing; fewer words
than n: the whole sequence is the one feature; a null id: no links and a null
component; repeated rows keep their rows and share a component; an empty table
gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import functools
import math
from bisect import bisect_right
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import apart, cut, in_parts

U = np.uint64
#: Subpartitions of a partition; subsets leave one of them out.
SUBPARTS = 3
#: Tries to fill the partitions of a set.
SEEDS = 1000
ODD = [U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9)]
#: Ratio of neighbouring band bounds; above 100/threshold a set reaches one more band at most.
BAND_RATIO = 1.4
#: Members of a bucket that one task compares with as many others.
BUCKET_BLOCK = 1500
#: Buckets of at least so many members first join components by their closest pairs; the exact round sees every bucket.
LARGE_BUCKET = 32
#: Features of a component's block, all of whose links to another block one task finds.
LINK_BLOCK = 250_000
#: Texts whose signatures, several times their size, a task holds at once.
SIGNED_AT_ONCE = 500
#: Words and classes that a task remembers.
MEMORY = 300_000


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMORY:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * ODD[0]
    x = (x ^ (x >> U(29))) * ODD[4]
    return x ^ (x >> U(32))


def shingles(text: bytes, n: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of UTF-8 ``text``, A-Z in lower case."""
    words = text.lower().split()  # of bytes: ASCII letters, and the six ASCII white-space bytes
    if not words:
        return np.empty(0, U)
    h = np.fromiter(map(known.__getitem__, words), U, len(words))
    width = min(n, len(h))
    out = np.full(len(h) - width + 1, width, U)
    for i in range(width):
        out = mix(out * ODD[1] + h[i : len(h) - width + 1 + i])
    out.sort()  # np.unique takes ten times as long
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


def bands(limit: int = 1 << 40) -> list[int]:
    out = [1]
    while out[-1] < limit:
        out.append(max(out[-1] + 1, int(out[-1] * BAND_RATIO)))
    return out


BOUNDS = bands()


def most_different(total: int, threshold: int) -> int:
    """The largest symmetric difference of a linked pair whose sizes sum to ``total``."""
    return (100 - threshold) * total // (100 + threshold)


@functools.lru_cache(4096)
def partitions(band: int, threshold: int) -> tuple[int, int, int]:
    """The most that a pair of the band can differ in, how many partitions such a pair can spoil, and the number of partitions.

    More partitions than can be spoilt (by two differing features each) are
    needed, and as many more as hold an empty subset in the smallest sets of the band.
    """
    k = most_different(2 * (BOUNDS[band + 1] - 1), threshold)
    spoilt = k // 2
    smallest = -(-threshold * BOUNDS[band] // 100)
    best = (-math.inf, 1)
    for n1 in range(spoilt + 1, 2 * k + 2):
        empty = math.exp(-smallest / n1 / SUBPARTS)
        some = 3 * empty * empty * (1 - empty) + empty**3  # two or three of three subpartitions are empty
        over, spread = n1 * (1 - some) - spoilt, math.sqrt(n1 * some * (1 - some))
        if over >= 2 * spread:
            return k, spoilt, n1
        best = max(best, (over - spread, n1))
    return k, spoilt, best[1]


def signatures(features: np.ndarray, threshold: int) -> np.ndarray:
    size = len(features)
    band = bisect_right(BOUNDS, size) - 1
    out = []
    while band == bisect_right(BOUNDS, size) - 1 or 100 * size >= threshold * BOUNDS[band]:
        k, spoilt, n1 = partitions(band, threshold)
        cells = n1 * SUBPARTS
        if k and size > k:
            for seed in range(SEEDS):
                salt = mix(np.array([band * 1_000_003 + seed], U))[0]
                hashed = mix(features + salt)
                cell = (((hashed >> U(32)) * U(n1)) >> U(32)) * U(SUBPARTS) + (((hashed & U(0xFFFFFFFF)) * U(SUBPARTS)) >> U(32))
                order = np.argsort(cell.astype(np.uint16) if cells < 65536 else cell, kind="stable")
                cell = cell[order].astype(np.int64)
                starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
                sums, held = np.zeros(cells, U), np.zeros(cells, np.int64)
                sums[cell[starts]] = np.add.reduceat(mix(hashed[order] * ODD[2]), starts)
                held[cell[starts]] = 1
                sums, held = sums.reshape(n1, SUBPARTS), held.reshape(n1, SUBPARTS)
                # a subset of subpartitions is what the one left out leaves of the partition
                sums, held = sums.sum(axis=1, keepdims=True, dtype=U) - sums, held.sum(axis=1, keepdims=True) - held
                filled = held > 0
                number = np.arange(cells, dtype=U).reshape(n1, SUBPARTS)
                out.append(mix(sums + number * ODD[3] + salt)[filled])
                if np.count_nonzero(~filled.all(axis=1)) < n1 - spoilt:  # fewer than the partitions that a pair agrees in
                    break
            else:
                raise ValueError("partitions stay empty")
        band += 1
    return np.concatenate(out).view(np.uint64) if out else np.empty(0, U)


def sketch(features: np.ndarray, threshold: int) -> bytes:
    cells = 16
    while cells < 4 * most_different(2 * len(features), threshold):
        cells *= 2
    at = (features >> U(8)) & U(cells - 1)
    return np.bincount(at.astype(np.int64), weights=((features >> U(56)) | U(1)).astype(np.float64), minlength=cells).astype(np.int64).astype(np.uint8).tobytes()


def fold(cells: np.ndarray, width: int) -> np.ndarray:
    return cells.reshape(*cells.shape[:-1], -1, width).sum(axis=-2, dtype=np.uint8)


def least_different(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A lower bound of the symmetric difference: a cell that differs holds at least one feature of one set only, at least two if its sums differ by an even number."""
    d = a - b
    return ((d != 0) * (2 - (d & 1))).sum(axis=-1)


def _described(n: int, threshold: int):
    def run(batches):
        known, seen = WordHashes(), set()
        for batch in batches:
            size, cls, cells = [], [], []
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                f = shingles(text.as_py() or b"", n, known)
                size.append(len(f))
                c = class_of(f) if len(f) and doc_id.is_valid else None
                cls.append(c)
                cells.append(sketch(f, threshold) if c is not None and first_seen(c, seen) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(cls, pa.int64()), pa.array(cells, pa.binary())], names=["doc_id", "n_shingles", "cls", "sketch"])

    return run


def _sign(n: int, threshold: int):
    def run(batches):
        known, seen = WordHashes(), set()
        for batch in in_parts(batches, SIGNED_AT_ONCE):
            cls, sigs = [], []
            for text in batch.column(0):
                f = shingles(text.as_py(), n, known)
                if len(f) and first_seen(c := class_of(f), seen):
                    cls.append(c)
                    sigs.append(signatures(f, threshold).view(np.int64))
            flat = np.concatenate([np.empty(0, np.int64), *sigs])
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sigs)]), pa.int32()), pa.array(flat, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), lists], names=["cls", "sigs"])

    return run


def _shared(batches: Iterable[pa.RecordBatch]):
    """Of rows (sig, cls) in order, those whose signature another class has too, with the first class of the signature."""
    last = None  # (sig, cls, first class of sig, already given)
    for batch in batches:
        sig, cls = (batch.column(i).to_numpy() for i in (0, 1))
        keep = np.ones(len(sig), bool)
        keep[1:] = (sig[1:] != sig[:-1]) | (cls[1:] != cls[:-1])
        if last and len(sig) and (sig[0], cls[0]) == last[:2]:
            keep[0] = False
        sig, cls = sig[keep], cls[keep]
        if not len(sig):
            continue
        begins = np.concatenate([[True], sig[1:] != sig[:-1]])
        first = cls[np.maximum.accumulate(np.where(begins, np.arange(len(sig)), 0))]
        as_before = np.concatenate([[False], ~begins[1:]])
        if last and sig[0] == last[0]:
            run = sig == sig[0]
            first = np.where(run, last[2], first)
            as_before[0] = True
        both = as_before | np.concatenate([as_before[1:], [False]])
        out = [sig[both], cls[both], first[both]]
        if last and as_before[0] and not last[3]:
            out = [np.concatenate([[x], y]) for x, y in zip(last[:3], out, strict=True)]
        last = (sig[-1], cls[-1], first[-1], bool(both[-1]))
        if len(out[0]):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["sig", "cls", "first"])


def _near(threshold: int):
    def run(batches):
        for batch in batches:
            keep = []
            for na, nb, a, b in zip(*(batch.column(x).to_pylist() for x in ("na", "nb", "ka", "kb")), strict=True):
                width = min(len(a), len(b))
                keep.append(least_different(fold(np.frombuffer(a, np.uint8), width), fold(np.frombuffer(b, np.uint8), width)) <= most_different(na + nb, threshold))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _across(threshold: int, forest: bool):
    """Pairs of one bucket (or of two of its blocks) from different components that may be linked; with ``forest`` only as many as could join the components."""

    def run(key, rows):
        i, j = key[1].as_py(), key[2].as_py()
        cls, comp, n, side = (rows.column(x).to_numpy() for x in ("cls", "comp", "n", "block"))
        cells = rows.column("sketch").to_pylist()
        widths = np.array([len(c) for c in cells])
        found: list[tuple[int, int]] = []
        comp = comp.copy()
        for width in np.unique(widths):
            own = np.flatnonzero(widths == width)
            rest = np.flatnonzero((widths == width) | (widths == 2 * width))
            a = np.frombuffer(b"".join(cells[x] for x in own), np.uint8).reshape(len(own), -1)
            b = np.stack([fold(np.frombuffer(cells[x], np.uint8), width) for x in rest])
            for row, x in enumerate(own):
                may = (comp[rest] != comp[x]) & ((widths[rest] > width) | (rest > x)) & ((i == j) | (side[rest] != side[x]))
                at = np.flatnonzero(may)
                if len(at):
                    bound = least_different(b[at], a[row])
                    near = bound <= (100 - threshold) * (n[rest[at]] + n[x]) // (100 + threshold)
                    at, bound = rest[at[near]], bound[near]
                    while forest and len(at):  # the closest one, and its whole component counts as joined
                        y = at[bound.argmin()]
                        found.append((x, y))
                        comp[comp == comp[y]] = comp[x]
                        apart = comp[at] != comp[x]
                        at, bound = at[apart], bound[apart]
                    found += [(x, y) for y in at]
        return pa.table({"a": pa.array([cls[x] for x, _ in found], pa.int64()), "b": pa.array([cls[y] for _, y in found], pa.int64())})

    return run


def class_of(features: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(features.tobytes()) - (1 << 63)


def first_seen(cls: int, seen: set[int]) -> bool:
    """Whether a task meets a class for the first time, as far as it remembers."""
    if cls in seen:
        return False
    if len(seen) > MEMORY:
        seen.clear()
    seen.add(cls)
    return True


def _classed(n: int):
    def run(batches):
        known = WordHashes()
        for batch in batches:
            cls = [class_of(shingles(t.as_py() or b"", n, known)) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), batch.column(0)], names=["cls", "text"])

    return run


def _linked(n: int, threshold: int):
    """Of rows (a, b, ta, tb), the pairs (a, b) whose texts have sets similar enough."""

    def run(batches):
        known = WordHashes()
        for batch in batches:
            keep = []
            for ta, tb in zip(batch.column("ta"), batch.column("tb"), strict=True):
                fa, fb = shingles(ta.as_py(), n, known), shingles(tb.as_py(), n, known)
                common = len(fa) + len(fb) - len(np.union1d(fa, fb))
                keep.append((100 + threshold) * common >= threshold * (len(fa) + len(fb)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for the nodes of undirected edges (a, b): label is the component's smallest node.

    Alternates large-star and small-star steps; every round is cut to the
    shared folder, and only a count and a checksum reach the driver.
    """
    star = lambda e: e.groupBy("u").agg(F.min("v").alias("m"))
    state = lambda e: e.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x")).first()
    now = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    was, mark = None, state(now)
    while mark["n"] and mark != was:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(star(both), "u").filter("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).filter("u <> v")  # a row for each edge at most
        small = large.join(star(large), "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").filter("u <> v").distinct()
        now = cut(small, "edges")
        was, mark = mark, state(now)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return cut(now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots), "labels")


def with_links(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels of ``connected_components`` once links (a, b) are added to its edges: only the components that these join are searched again."""
    if links.isEmpty():
        return labels
    ends = links
    for c in ("a", "b"):
        ends = ends.join(labels.select(F.col("node").alias(c), F.col("label").alias(f"of_{c}")), c, "left")
    joined = connected_components(ends.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")))
    renamed = labels.join(joined.select(F.col("node").alias("label"), F.col("label").alias("low")), "label", "left").select("node", F.coalesce("low", "label").alias("label"))
    return cut(renamed.unionByName(joined.join(labels.select("node"), "node", "left_anti")), "labels")


def _verified(pairs: DataFrame, texts: DataFrame, n: int, threshold: int) -> DataFrame:
    """Pairs (a, b) of classes whose sets are similar enough. Only texts of these classes are shuffled."""
    pairs = cut(pairs, "pairs")  # from files, so that Spark knows the size and plans the semi-join by it
    if pairs.isEmpty():
        return pairs
    needed = texts.join(pairs.select(F.explode(F.array("a", "b")).alias("cls")), "cls", "left_semi")
    side = lambda c: needed.select(F.col("cls").alias(c), F.col("text").alias(f"t{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_linked(n, threshold), "a long, b long")


def _still_apart(shared: DataFrame, labels: DataFrame, known: DataFrame, threshold: int, forest: bool) -> DataFrame:
    """Candidates (a, b) among the members of each bucket, its first class aside, that are in different components."""
    rest = shared.filter("cls <> first").join(labels.withColumnRenamed("node", "cls"), "cls", "left").select("sig", "cls", F.coalesce("label", "cls").alias("comp"))
    member = F.xxhash64("cls")
    mixed = rest.groupBy("sig").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("members"), F.bit_xor(member).alias("print"), F.bit_xor(F.xxhash64(member)).alias("print2"))
    mixed = mixed.filter("low <> high").filter(F.col("members") >= (LARGE_BUCKET if forest else 2))
    mixed = mixed.groupBy("print", "print2", "members").agg(F.min("sig").alias("sig"))  # of buckets with the same members, one
    blocks = F.ceil(F.col("members") / BUCKET_BLOCK).cast("int")
    dealt = (
        rest.join(mixed.select("sig", blocks.alias("blocks")), "sig")
        .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("sig", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "cls", "comp")
        .join(known, "cls")
    )
    found = dealt.groupBy("sig", "i", "j").applyInArrow(_across(threshold, forest), "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _text_bytes(col: str) -> Column:
    return F.col(col).cast("binary")


@dataclass
class Joined:
    """Rows (doc_id, n_shingles, cls), smallest ids (cls, first_id) and, of classes that share a signature, (cls, n), (cls, text) and components (node, label)."""

    signed: DataFrame
    first_ids: DataFrame
    known: DataFrame
    texts: DataFrame
    labels: DataFrame


def _join(docs: DataFrame, n: int, threshold: int, id_col: str, text_col: str) -> Joined:
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), _text_bytes(text_col).alias("text"))
    signed = cut(chosen.mapInArrow(_described(n, threshold), "doc_id long, n_shingles long, cls long, sketch binary"), "signed")

    sigs = chosen.filter("doc_id is not null and text is not null").select("text").mapInArrow(_sign(n, threshold), "cls long, sigs array<long>")
    by_sig = sigs.select(F.explode("sigs").alias("sig"), "cls").repartition("sig").sortWithinPartitions("sig", "cls")
    shared = cut(by_sig.mapInArrow(_shared, "sig long, cls long, first long"), "shared")
    classes = shared.select("cls").distinct()
    first_ids = signed.filter("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("first_id"))
    known = cut(signed.filter("sketch is not null").select("cls", F.col("n_shingles").alias("n"), "sketch").join(classes, "cls", "left_semi").dropDuplicates(["cls"]), "known")
    wanted = first_ids.join(classes, "cls", "left_semi").select(F.col("first_id").alias("doc_id"))
    rows = chosen.join(wanted.distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).select("text")
    texts = cut(rows.mapInArrow(_classed(n), "cls long, text binary").join(classes, "cls", "left_semi"), "texts")

    side = lambda c, k: known.select(F.col("cls").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(k))
    to_first = shared.filter("cls <> first").select(F.col("first").alias("a"), F.col("cls").alias("b")).distinct()
    near = to_first.join(side("a", "ka"), "a").join(side("b", "kb"), "b").mapInArrow(_near(threshold), "a long, b long")
    labels = connected_components(cut(_verified(near, texts, n, threshold), "links"))
    for forest in (True, False):
        labels = with_links(labels, cut(_verified(_still_apart(shared, labels, known, threshold, forest), texts, n, threshold), "links"))
    return Joined(signed, first_ids, known, texts, labels)


def _with_components(joined: Joined) -> DataFrame:
    named = joined.first_ids.join(joined.labels.withColumnRenamed("node", "cls"), "cls", "left").select("cls", "first_id", F.coalesce("label", "cls").alias("label"))
    lowest = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    by_class = named.join(lowest, "label").select("cls", "component_id")
    return joined.signed.select("doc_id", "n_shingles", "cls").join(by_class, "cls", "left").select("cls", "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def similar_documents(docs: DataFrame, n: int = 4, threshold: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_shingles, component_id), one for each input row.

    Two documents are linked when 100 * |A and B| >= threshold * |A or B|;
    ``component_id`` is the smallest id reachable by links.
    """
    return _with_components(_join(docs, n, threshold, id_col, text_col)).drop("cls")


def _every_link(n: int, threshold: int, counted: bool):
    """All links between blocks i and j of a component, or inside whole components: pairs (a, b), or with ``counted`` what each class adds to (cls, links)."""

    def run(key, rows):
        i, j = key[1].as_py(), key[2].as_py()
        comp, side, cls, copies = (rows.column(x).to_numpy() for x in ("comp", "block", "cls", "copies"))
        known = WordHashes()
        sets = [shingles(t.as_py(), n, known) for t in rows.column("text")]
        size = np.array([len(s) for s in sets])
        order = np.lexsort((size, comp))
        links = np.zeros(len(cls), np.int64)
        left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for of_comp in np.split(order, np.flatnonzero(comp[order][1:] != comp[order][:-1]) + 1):
            own, others = of_comp[side[of_comp] == i], of_comp[side[of_comp] == j]
            if not len(own) or not len(others):
                continue
            feature, code = np.unique(np.concatenate([sets[x] for x in others]), return_inverse=True)
            ends = np.cumsum(size[others])
            starts = ends - size[others]
            low = np.searchsorted(size[others], -(-threshold * size[own] // 100))  # smaller or larger sets can't be linked
            high = np.searchsorted(size[others], 100 * size[own] // threshold, side="right")
            has = np.zeros(len(feature), bool)
            for at, x in enumerate(own):
                a, b = max(low[at], at + 1) if i == j else low[at], high[at]
                if a >= b:
                    continue
                place = np.minimum(np.searchsorted(feature, sets[x]), len(feature) - 1)
                place = place[feature[place] == sets[x]]
                has[place] = True
                common = np.add.reduceat(has[code[starts[a] : ends[b - 1]]], starts[a:b] - starts[a], dtype=np.int64)
                has[place] = False
                y = others[a:b][(100 + threshold) * common >= threshold * (size[x] + size[others[a:b]])]
                if counted:
                    links[x] += copies[y].sum()
                    links[y] += copies[x]
                else:
                    left.append(np.full(len(y), x))
                    right.append(y)
        if counted:
            return pa.table({"cls": pa.array(cls[links > 0], pa.int64()), "links": pa.array(links[links > 0], pa.int64())})
        return pa.table({"a": pa.array(cls[np.concatenate(left)], pa.int64()), "b": pa.array(cls[np.concatenate(right)], pa.int64())})

    return run


def _copies(joined: Joined) -> DataFrame:
    """(cls, copies): a document with several rows of one class counts once."""
    return joined.signed.filter("cls is not null").select("cls", "doc_id").distinct().groupBy("cls").agg(F.count("*").alias("copies"))


def _all_links(joined: Joined, n: int, threshold: int, counted: bool) -> DataFrame:
    """``_every_link`` of all components. Large ones are cut into blocks, every two of which meet once; small ones share a task."""
    sized = cut(joined.labels.select(F.col("node").alias("cls"), F.col("label").alias("comp")).join(joined.known.select("cls", "n"), "cls"), "sized")
    tasks = (sized.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] // LINK_BLOCK) + 1
    blocks = sized.groupBy("comp").agg(F.ceil(F.sum("n") / LINK_BLOCK).cast("int").alias("blocks"))
    dealt = (
        sized.join(blocks, "comp")
        .join(_copies(joined), "cls")
        .join(joined.texts.dropDuplicates(["cls"]), "cls")
        .withColumn("part", F.when(F.col("blocks") > 1, F.col("comp")).otherwise(F.pmod(F.xxhash64("comp"), F.lit(tasks))))
        .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("part", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "comp", "block", "cls", "copies", "text")
    )
    return dealt.groupBy("part", "i", "j").applyInArrow(_every_link(n, threshold, counted), "cls long, links long" if counted else "a long, b long")


def linked_texts(docs: DataFrame, n: int = 4, threshold: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every link between different sets, once: rows (a, b, copies_a, copies_b) of the sets' smallest ids, a < b but for repeated ids, and of how many documents have them."""
    joined = _join(docs, n, threshold, id_col, text_col)
    named = joined.first_ids.join(_copies(joined), "cls")
    side = lambda c: named.select(F.col("cls").alias(c), F.col("first_id").alias(f"id_{c}"), F.col("copies").alias(f"copies_{c}"))
    pairs = cut(_all_links(joined, n, threshold, counted=False), "links").join(side("a"), "a").join(side("b"), "b")
    turned = F.col("id_a") > F.col("id_b")
    pick = lambda c, x, y: F.when(turned, F.col(y)).otherwise(F.col(x)).alias(c)
    return pairs.select(pick("a", "id_a", "id_b"), pick("b", "id_b", "id_a"), pick("copies_a", "copies_a", "copies_b"), pick("copies_b", "copies_b", "copies_a"))


def linked_documents(docs: DataFrame, n: int = 4, threshold: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``similar_documents`` with ``n_links``: how many other documents each is linked to, those with an equal set included."""
    joined = _join(docs, n, threshold, id_col, text_col)
    across = cut(_all_links(joined, n, threshold, counted=True), "n_links").groupBy("cls").agg(F.sum("links").alias("links"))
    by_class = _copies(joined).join(across, "cls", "left").select("cls", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return _with_components(joined).join(by_class, "cls", "left").select("doc_id", "n_shingles", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def one_of_each(docs: DataFrame, n: int = 4, threshold: int = 85) -> DataFrame:
    """The rows of ``docs`` that are the first of their component. Rows that repeat a kept id are dropped, the one with the smallest text stays; rows without an id stay."""
    kept = similar_documents(docs, n, threshold).filter("doc_id = component_id").select("doc_id").distinct()
    own, back = apart(docs, "doc_id", "text")
    first = Window.partitionBy("doc_id").orderBy("text")
    rows = own.join(kept, "doc_id", "left_semi").withColumn("nth", F.row_number().over(first)).filter("nth = 1")
    return rows.select(*back).unionByName(docs.filter("doc_id is null"))
