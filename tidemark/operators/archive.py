"""Repository archives: blocks, their verification, and the record tree.

Archives are read one per row, in parallel over archives, by a small reader of
their two public formats; everything after that is joins over blocks.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .. import archive_format as fmt
from ..sources.scratch import shared_folder

BLOCK = "archive string, cid string, digest string, data binary, root boolean, error string"
NODE = "archive string, cid string, kind string, rev string, data string, l string, e array<struct<p:int,k:binary,v:string,t:string>>, content string, error string"
#: Nodes with numbers in place of ids. A link to a block that the archive lacks is -1; kind unread gives the error of a whole archive.
NUMBERED = "archive string, cid long, root boolean, kind string, rev string, data long, l long, e array<struct<p:int,k:binary,v:long,t:long>>, content string, error string"


def kept(df: DataFrame, path: str, packing: str = "zstd") -> DataFrame:
    """``df`` from files at ``path``: made once, where a checkpoint makes it twice and packs nothing. Joins with what may be large take the hint merge, as packed files look small enough to broadcast."""
    df.write.option("compression", packing).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def archive_blocks(archives: DataFrame) -> DataFrame:
    """Blocks of each archive (columns archive, bytes); an archive that can't be read gives one row with an error."""

    types = (pa.string(), pa.string(), pa.string(), pa.binary(), pa.bool_(), pa.string())

    def packed(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["archive", "cid", "digest", "data", "root", "error"])

    def run(batches):
        out, size = [], 0
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                try:
                    rows = [(name, cid, cid[-64:], block, root, None) for cid, block, root in fmt.blocks(data.as_py())]
                    if not rows:
                        raise ValueError("the archive has no blocks")
                except (ValueError, IndexError, TypeError, KeyError) as e:
                    rows = [(name, None, None, None, False, str(e))]
                out += rows
                size += len(data.as_buffer() or b"") if data.is_valid else 0
                if len(out) >= 4096 or size >= 1 << 22:
                    yield packed(out)
                    out, size = [], 0
        if out:
            yield packed(out)

    return archives.select("archive", "bytes").mapInArrow(run, BLOCK)


def verify_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks whose SHA-256 equals their digest."""
    return blocks.filter(F.sha2("data", 256) == F.col("digest"))


def _node(x) -> tuple:
    """(kind, rev, data, l, e, content, error) of a decoded block; raises where a tree entry is not whole."""
    if not isinstance(x, dict):
        return ("other", None, None, None, None, None, None)
    if "$type" in x:
        return ("record", None, None, None, None, fmt.dag_json(x), None)
    if "data" in x:
        rev, tree = x.get("rev"), x["data"]
        return ("commit", rev if isinstance(rev, str) else None, tree if isinstance(tree, fmt.Link) else None, None, None, None, None)
    if "e" not in x:
        raise ValueError("the block is of no known kind")
    link = lambda v: v if isinstance(v, fmt.Link) else None
    entries = [{"p": e["p"], "k": e["k"], "v": link(e["v"]), "t": link(e["t"])} for e in x["e"] if isinstance(e, dict)]
    if not all(isinstance(e["p"], int) and 0 <= e["p"] < 1 << 31 and isinstance(e["k"], bytes) and e["v"] for e in entries):
        raise ValueError("a field of a tree entry has the wrong type or range")
    return ("tree", None, None, link(x.get("l")), entries, None, None)


def _read(block: bytes) -> tuple:
    """``_node`` of a block's bytes; one that can't be read is of kind bad, with its error."""
    try:
        return _node(fmt.cbor(block))
    except (ValueError, IndexError, TypeError, RecursionError) as e:
        return ("bad", None, None, None, None, None, str(e))
    except KeyError as e:
        return ("bad", None, None, None, None, None, f"a tree entry lacks the field {e}")


def nodes(blocks: DataFrame) -> DataFrame:
    """Decoded blocks: a record has ``$type``, a commit ``data``, a tree node ``e``. One that can't be read is of kind bad, with its error."""
    entry = pa.list_(pa.struct([("p", pa.int32()), ("k", pa.binary()), ("v", pa.string()), ("t", pa.string())]))
    types = (pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), entry, pa.string(), pa.string())

    def run(batches):
        for batch in fmt.slices(batches, 1024):
            out = [(name, cid, *_read(data)) for name, cid, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)]
            cols = list(zip(*out, strict=True)) or [[]] * len(types)
            names = ["archive", "cid", "kind", "rev", "data", "l", "e", "content", "error"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    return blocks.select("archive", "cid", "data").mapInArrow(run, NODE)


def with_keys(tree: DataFrame) -> DataFrame:
    """``tree`` with ``keys`` (key, v, t) in place of its entries ``e``; null where a prefix is longer than the key before it, or without entries.

    Each key is the first ``p`` bytes of the key before it and ``k``, so a node
    is read once, in time in proportion to the bytes of its keys.
    """
    rest = [c for c in tree.columns if c != "e"]
    link = tree.schema["e"].dataType.elementType["v"].dataType.simpleString()
    schema = tree.select(*rest, F.lit(None).cast(f"array<struct<key:binary,v:{link},t:{link}>>").alias("keys")).schema

    def decoded(entries: pa.Array) -> list[bytes] | None:
        last, out = b"", []
        for p, k in zip(*(entries.field(f).to_pylist() for f in ("p", "k")), strict=True):
            if p > len(last):
                return None
            last = last[:p] + k
            out.append(last)
        return out

    def run(batches):
        for batch in fmt.slices(batches, 1024):
            entry = batch.column(len(rest)).type.value_type
            kind = pa.struct([("key", pa.binary()), ("v", entry.field("v").type), ("t", entry.field("t").type)])
            keys = []
            for x in batch.column(len(rest)):
                entries = x.values if x.is_valid else None
                own = decoded(entries) if entries is not None else None
                keys.append(None if own is None else pa.StructArray.from_arrays([pa.array(own, pa.binary()), entries.field("v"), entries.field("t")], names=["key", "v", "t"]))
            ends = np.cumsum([0, *(len(k) if k is not None else 0 for k in keys)])
            flat = pa.concat_arrays([k for k in keys if k is not None]) if any(k is not None for k in keys) else pa.array([], kind)
            mask = pa.array([k is None for k in keys], pa.bool_())
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat, mask=mask)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(rest)], lists], names=[*rest, "keys"])

    return tree.select(*rest, "e").mapInArrow(run, schema)


def tree_keys(tree: DataFrame) -> DataFrame:
    """``tree`` (with ``e``) exploded to rows (…, key, v, t)."""
    rest = [c for c in tree.columns if c != "e"]
    return with_keys(tree).select(*rest, F.explode("keys").alias("x")).select(*rest, F.col("x.key").cast("string").alias("key"), "x.v", "x.t")


def tree_records(found: DataFrame, roots: DataFrame, max_depth: int = 128) -> tuple[DataFrame, DataFrame]:
    """Rows (archive, rev, key, cid) reached from the root commits, and rows (archive, error).

    ``roots`` (archive, cid) names one block for each archive. All keys count,
    missing blocks are skipped, a node that several links reach counts once.
    Levels are joins of the nodes reached with the links alone, which are set
    apart once; keys are read in one join with all nodes reached. Both lie in
    the shared folder. A link can't lead up, as it is the hash of what it links
    to; in blocks that were not verified a circle ends at ``max_depth`` with an error.
    """
    path = shared_folder(found.sparkSession)
    before = F.expr("transform(e, (x, i) -> coalesce(cast(get(e, i - 1).p as bigint) + length(get(e, i - 1).k), 0))")
    sound = F.coalesce(~F.exists(F.zip_with("e", before, lambda x, n: x["p"] > n), lambda wrong: wrong), F.lit(False))
    tree = found.filter("kind in ('tree', 'bad')").withColumn("sound", sound)
    linked = tree.select("archive", "cid", F.explode(F.expr("if(sound, concat(e.t, array(l)), array(l))")).alias("child"))
    links = kept(linked.filter("child is not null").distinct(), f"{path}/links")
    commits = found.filter("kind = 'commit'").select("archive", "cid", "rev", "data").dropDuplicates(["archive", "cid"])
    started = kept(roots.select("archive", "cid").join(commits, ["archive", "cid"], "left"), f"{path}/roots")
    errors = started.filter("data is null").select("archive", F.lit("the root is missing or no commit").alias("error"))
    frontier = started.filter("data is not null").select("archive", "rev", F.col("data").alias("cid")).distinct()
    levels = []
    while not frontier.isEmpty():
        if len(levels) == max_depth:
            errors = errors.unionByName(frontier.select("archive", F.lit(f"the tree is deeper than {max_depth}").alias("error")))
            break
        levels.append(frontier)
        below = frontier.join(links.hint("merge"), ["archive", "cid"]).select("archive", "rev", F.col("child").alias("cid"))
        frontier = kept(below.distinct(), f"{path}/level{len(levels)}")
    empty = frontier.limit(0).select("archive", "rev", F.lit("").alias("key"), "cid")
    if not levels:
        return empty, errors.distinct()
    reached = reduce(DataFrame.unionByName, levels)
    said = F.when(F.col("kind") == "bad", F.col("error")).otherwise("a key's prefix is longer than the key before it")
    faults = tree.filter("not sound").select("archive", "cid", said.alias("error"))
    errors = errors.unionByName(reached.join(faults, ["archive", "cid"]).select("archive", "error"))
    once = tree.filter("sound").select("archive", "cid", "e").dropDuplicates(["archive", "cid"])
    read = with_keys(reached.repartition("archive", "cid").distinct().join(once.hint("merge"), ["archive", "cid"]).select("archive", "rev", "e"))
    return read.select("archive", "rev", F.explode("keys").alias("x")).select("archive", "rev", F.col("x.key").cast("string").alias("key"), F.col("x.v").alias("cid")), errors.distinct()


def read_archives(archives: DataFrame, records: bool = True) -> DataFrame:
    """Verified nodes of the archives (see NUMBERED), made once and kept in the shared folder; ``records`` says whether their records are.

    An archive is one row, so ids give way to numbers while it is read: joins
    move 8 bytes that pack well in place of 72 that don't. No two blocks of any
    archives share a number; of blocks with the same id one is kept.
    """
    entry = pa.struct([("p", pa.int32()), ("k", pa.binary()), ("v", pa.int64()), ("t", pa.int64())])
    types = (pa.string(), pa.int64(), pa.bool_(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.list_(entry), pa.string(), pa.string())
    names = [x.split()[0] for x in NUMBERED.split(", ")]
    kinds = {"tree", "commit", "bad", "record"} if records else {"tree", "commit", "bad"}

    def packed(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def decoded(name, data, first):
        """The rows of an archive whose blocks are numbered from ``first``, each with its bytes, and at last the next number."""
        unread = lambda error: (name, None, False, "unread", None, None, None, None, None, error)
        number, whole, rooted = {}, [], False
        try:
            any_block = False
            for cid, block, root in fmt.blocks(data):
                any_block = True
                if cid not in number and hashlib.sha256(block).hexdigest() == cid[-64:]:
                    number[cid] = first + len(number)
                    whole.append((number[cid], block, root))
                    rooted = rooted or root
            if not any_block:
                raise ValueError("the archive has no blocks")
        except (ValueError, IndexError, TypeError, KeyError) as e:
            yield unread(str(e)), 0
            return first
        if not rooted:
            yield unread("the root is missing or no commit"), 0
        at = lambda link: None if link is None else number.get(link, -1)
        for n, block, root in whole:
            kind, rev, tree, left, entries, content, error = _read(block)
            if kind in kinds or root:
                entries = entries and [(e["p"], e["k"], at(e["v"]), at(e["t"])) for e in entries]
                yield (name, n, root, kind, rev, at(tree), at(left), entries, content, error), len(block)
        return first + len(number)

    def run(batches):
        out, size, first = [], 0, TaskContext.get().partitionId() << 40

        def all_rows():
            nonlocal first
            for batch in batches:
                for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    first = yield from decoded(name, data.as_py(), first)

        for row, length in all_rows():
            out.append(row)
            size += length
            if len(out) >= 4096 or size >= 1 << 22:
                yield packed(out)
                out, size = [], 0
        if out:
            yield packed(out)

    return kept(archives.select("archive", "bytes").mapInArrow(run, NUMBERED), f"{shared_folder(archives.sparkSession)}/nodes")


def archive_records(archives: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records (archive, collection, rkey, rev, content), and archives with their error; an archive with an error gives no records.

    Archives are read once. Of rows of the same name one is walked, by its own blocks, and an error of any of them counts.
    """
    found, path = read_archives(archives), shared_folder(archives.sparkSession)
    unread = found.filter("kind = 'unread'").select("archive", "error")
    roots = found.filter("root").select("archive", "cid").dropDuplicates(["archive"]).join(unread.hint("merge"), "archive", "left_anti")
    walked, broken = tree_records(found, roots)
    reached = kept(walked, f"{path}/reached")
    # what is rare lies apart and not packed: Spark sees from its size that what was reached need not be shuffled to meet it
    bad = kept(found.filter("kind = 'bad'").select("archive", "cid", "error"), f"{path}/bad", "none")
    wrong = broken.unionByName(reached.join(bad, ["archive", "cid"]).select("archive", "error"))
    faults = kept(wrong.groupBy("archive").agg(F.min("error").alias("error")), f"{path}/faults", "none")
    errors = unread.unionByName(faults).groupBy("archive").agg(F.min("error").alias("error"))
    part, contents = F.split("key", "/", 2), found.filter("kind = 'record'").select("archive", "cid", "content")
    whole = reached.filter(F.size(part) == 2).join(faults, "archive", "left_anti").join(contents.hint("merge"), ["archive", "cid"])
    return whole.select("archive", part[0].alias("collection"), part[1].alias("rkey"), "rev", "content"), errors
