"""WARC archives: a deterministic sharded writer, and the reader.

Records are sorted by page id and cut into shards of about equal bytes at ids
found from a sample that depends on the ids alone; every shard is a partition
of its own. Each task writes its shard's records as gzip members, rolls files
at a compressed size, and regenerates headers, record ids and digests from the
data. Files are written under temporary names that hold the attempt. Spark
commits the list of complete temporary files, a second job gives these their
final names, and the manifest, committed by Spark, names the files that count.
Both jobs can be repeated at any point: a repeated writing task writes the same
bytes under a temporary name of its own, and renaming skips what is done. What
dead attempts leave is deleted at the end.

Payloads are shuffled once. What a page refers to travels as a row of its own
that sorts before its page, so that payloads need no join.

Cases: null payloads are empty; a very long payload is one record, written and
read in the memory of a task; of rows that repeat an id and a payload the
first in order of URL is the response; all rows of one id, and all rows without
an id, are one shard, whose task sorts them on disk and streams them; a null id
sorts first and is never referred to while the payload has a row with an id; an
empty table gives an empty archive; further columns are ignored, whatever their
names.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import cut

#: Payload bytes of a shard, and compressed bytes at which a file is full.
SHARD_BYTES, ROLL_BYTES = 32 << 20, 8 << 20
#: Smallest payload that may be a revisit.
MIN_REVISIT = 100
#: Ids in the sample that shard bounds are taken from, about: so many, or so many for each shard.
SAMPLE, SHARD_SAMPLE = 20_000, 20
#: Most shards; beyond, shards grow. It bounds what the driver collects to MAX_SHARDS * SHARD_SAMPLE ids, about.
MAX_SHARDS = 50_000
NAMESPACE = uuid.UUID("5f0f3b52-6a0e-5d0b-9a39-0c1d1f6f8a11")
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ATTEMPTS = "file string, shard int, records long, bytes long, sha256 string, temporary string"
MANIFEST = "file string, shard int, records long, bytes long, sha256 string"
RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def _record_id(page_id, digest: str, url) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}|{digest}|{url}')}>"


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))]) + "\r\n"
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(head.encode() + block + b"\r\n\r\n") + deflate.flush()


def _page(page_id, url, payload: bytes, refers_to) -> bytes:
    digest = hashlib.sha256(payload).hexdigest()
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id, digest, url)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%-._~") if url else f"urn:page:{page_id}"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("X-Refers-To-Page", str(refers_to))]
    return _member(headers, block)


class _Files:
    """Rolls the files of one shard after another."""

    def __init__(self, folder: str, roll: int):
        self.system, self.root = fs.FileSystem.from_uri(folder)
        self.roll, self.shard, self.out, self.done = roll, None, None, []
        t = TaskContext.get()
        self.mark = f"{t.stageId()}-{t.partitionId()}-{t.attemptNumber()}-{t.taskAttemptId()}"

    def add(self, shard: int, member: bytes) -> None:
        if shard != self.shard:
            self.close()
            self.shard, self.serial = shard, 0
        elif self.out and self.size + len(member) > self.roll:
            self.close()
        if not self.out:
            self.name = f"part-{shard:06d}-{self.serial:05d}.warc.gz"
            self.serial += 1
            self.out, self.size, self.records, self.hash = self.system.open_output_stream(f"{self.root}/.{self.name}.{self.mark}", compression=None), 0, -1, hashlib.sha256()
            self._put(_member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(None, "info", self.name)), ("WARC-Date", DATE), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
        self._put(member)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.hash.update(data)
        self.size += len(data)
        self.records += 1

    def close(self) -> None:
        if self.out:
            self.out.close()
            self.done.append((self.name, self.shard, self.records, self.size, self.hash.hexdigest(), f".{self.name}.{self.mark}"))
            self.out = None


def _writer(folder: str, roll: int):
    """Rows (shard, page_id, kind, digest, first_id, url, html) in order: kind 0 tells what a digest of the page id refers to, kind 1 is a page."""

    def run(batches):
        files = _Files(folder, roll)
        current, refers, given = None, {}, set()
        for batch in batches:
            shards, ids, kinds, digests, firsts, urls = (batch.column(i).to_pylist() for i in range(6))
            for i, page_id in enumerate(ids):
                if (shards[i], page_id) != current:
                    current, refers, given = (shards[i], page_id), {}, set()
                if kinds[i] == 0:
                    refers[digests[i]] = firsts[i]
                    continue
                first = refers.get(digests[i])
                if first == page_id and digests[i] not in given:
                    given.add(digests[i])
                    first = None
                files.add(shards[i], _page(page_id, urls[i], batch.column(6)[i].as_py() or b"", first))
        files.close()
        fields = [("file", pa.string()), ("shard", pa.int32()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string()), ("temporary", pa.string())]
        yield pa.RecordBatch.from_arrays([pa.array([row[i] for row in files.done], t) for i, (_, t) in enumerate(fields)], names=[n for n, _ in fields])

    return run


def _publish(folder: str):
    """Gives temporary files their final names. A file that has its name already, from a lost task, is left."""

    def run(batches):
        system, root = fs.FileSystem.from_uri(folder)
        exists = lambda name: system.get_file_info(f"{root}/{name}").type == fs.FileType.File
        for batch in batches:
            for name, temporary in zip(batch.column("file").to_pylist(), batch.column("temporary").to_pylist(), strict=True):
                if exists(temporary):
                    if exists(name):  # of an archive that stood here before; not every file system renames onto a file
                        system.delete_file(f"{root}/{name}")
                    system.move(f"{root}/{temporary}", f"{root}/{name}")
                elif not exists(name):
                    raise FileNotFoundError(f"{folder}/{temporary}")
            yield batch.select(["file", "shard", "records", "bytes", "sha256"])

    return run


def _sweep(folder: str) -> None:
    """Deletes temporary files that no attempt will finish."""
    system, root = fs.FileSystem.from_uri(folder)
    for info in system.get_file_info(fs.FileSelector(root)):
        if info.base_name.startswith(".part-"):
            system.delete_file(info.path)


def _bounds(keys: DataFrame, shard_bytes: int) -> np.ndarray:
    """Smallest ids of all shards but the first: weighted quantiles of a sample by a hash of the ids."""
    total = keys.agg(F.count("page_id").alias("n"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("bytes")).first()
    shards = min(MAX_SHARDS, max(1, -(-total["bytes"] // shard_bytes)))
    if shards == 1 or not total["n"]:
        return np.empty(0, np.int64)
    every = max(1, total["n"] // max(SAMPLE, SHARD_SAMPLE * shards))
    chosen = keys.filter("page_id is not null").filter(F.pmod(F.xxhash64("page_id"), F.lit(every)) == 0)
    sample = chosen.groupBy("page_id").agg((F.sum("n_bytes") + F.count("*")).alias("bytes")).toArrow()
    if not sample.num_rows:
        return np.empty(0, np.int64)
    ids, weights = sample.column("page_id").to_numpy(), sample.column("bytes").to_numpy()
    order = np.argsort(ids)
    upto = np.cumsum(weights[order])
    cuts = np.searchsorted(upto, upto[-1] / shards * np.arange(1, shards), side="right")
    return np.unique(ids[order][np.minimum(cuts, len(ids) - 1)])


def write(pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to ``folder``, a URI that all executors reach; the manifest."""
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("html")).withColumn("digest", F.sha2("html", 256))
    keys = cut(rows.select("page_id", "digest", F.octet_length("html").cast("long").alias("n_bytes")), "keys")
    large = keys.filter(F.col("n_bytes") >= MIN_REVISIT)
    repeated = large.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1 and first_id is not null")
    refers = large.select("page_id", "digest").distinct().join(repeated.select("digest", "first_id"), "digest")
    bounds = _bounds(keys, shard_bytes)

    @F.pandas_udf("int")
    def shard(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(), side="right").astype(np.int32))

    stream = rows.select("page_id", F.lit(1).alias("kind"), "digest", F.lit(None).cast("long").alias("first_id"), "url", "html").unionByName(
        refers.select("page_id", F.lit(0).alias("kind"), "digest", "first_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("html"))
    )
    dealt = stream.select(shard(F.coalesce("page_id", F.lit(-(1 << 63)))).alias("shard"), "*")
    dealt = dealt.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", "page_id", "kind", "url", "digest")
    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    dealt.mapInArrow(_writer(folder, roll_bytes), ATTEMPTS).write.mode("overwrite").parquet(f"{folder}/_attempts")
    spark.read.schema(ATTEMPTS).parquet(f"{folder}/_attempts").mapInArrow(_publish(folder), MANIFEST).write.mode("overwrite").parquet(f"{folder}/_manifest")
    _sweep(folder)
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/_manifest")


def members(stream, digest=None) -> Iterator[bytes]:
    """The decompressed gzip members of a stream, one after another."""
    rest, inflate, parts = b"", None, []
    while chunk := rest or stream.read(1 << 20):
        if not rest and digest is not None:
            digest.update(chunk)
        inflate = inflate or zlib.decompressobj(31)
        parts.append(inflate.decompress(chunk))
        rest = inflate.unused_data
        if inflate.eof:
            yield b"".join(parts)
            inflate, parts = None, []
    if inflate:
        raise ValueError("the archive ends within a record")


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines[1:])}
    block = rest[: int(headers["content-length"])]
    if rest[len(block) :] != b"\r\n\r\n" or len(block) != int(headers["content-length"]):
        raise ValueError("a record's length is wrong")
    return headers, block


def _reader(folder: str, with_payload: bool):
    number = lambda x: None if x is None else int(x)

    def run(batches):
        system, root = fs.FileSystem.from_uri(folder)
        out: dict[str, list] = {}
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

        def fresh():
            return {n: [] for n in schema.names}

        for batch in batches:
            for name, want in zip(batch.column("file").to_pylist(), batch.column("sha256").to_pylist(), strict=True):
                out, held, digest = fresh(), 0, hashlib.sha256()
                with system.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for record in members(stream, digest):
                        h, block = parse(record)
                        if h["warc-type"] == "warcinfo":
                            continue
                        payload = block.partition(b"\r\n\r\n")[2]
                        length, sha = int(h["x-payload-length"]), h["warc-payload-digest"].removeprefix("sha256:")
                        if h["warc-type"] == "response":
                            length, found = len(payload), hashlib.sha256(payload).hexdigest()
                            if found != sha:
                                raise ValueError(f"{name}: a payload differs from its digest")
                        url = h["warc-target-uri"]
                        row = (number(h.get("x-page-id")), None if re.match("urn:page:", url) else url, h["warc-type"], length, sha, number(h.get("x-refers-to-page")), payload if with_payload and h["warc-type"] == "response" else None)
                        for n, v in zip(schema.names, row, strict=True):
                            out[n].append(v)
                        held += len(payload) if with_payload else 100
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pydict(out, schema=schema)
                            out, held = fresh(), 0
                if digest.hexdigest() != want:
                    raise ValueError(f"{name} differs from the manifest")
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    return run


def read(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of the files in the manifest; each file is streamed by one task and checked against its digests."""
    files = manifest(spark, folder)
    n = max(1, min(files.count(), 10_000))
    return files.repartition(n, "file").mapInArrow(_reader(folder, with_payload), RECORD)
