"""Python data sources over what hosts give: their event frames, as a stream, and the pages of their listings.

Both read one partition for each host. Tasks open files by pyarrow, so a path
must be of a scheme that pyarrow knows (file, s3, gs, hdfs); others fail before
a job starts.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from .. import archive_format as fmt

#: Entries of a page (fixed value of the protocol).
PAGE = 200


def _open(path: str) -> tuple[fs.FileSystem, str]:
    try:
        return fs.FileSystem.from_uri(path)
    except pa.ArrowInvalid as e:
        raise ValueError(f"tasks can't read {path}: {e}") from e


def _names(path: str, folders: bool = False) -> list[str]:
    system, root = _open(path)
    found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted(x.base_name for x in found if (x.type == fs.FileType.Directory) == folders)


def _read(path: str) -> bytes:
    system, root = _open(path)
    with system.open_input_stream(root) as f:
        return f.read()


def _put(path: str, data: bytes) -> None:
    """Writes a file under another name first, so that readers see whole ones."""
    system, root = _open(path)
    system.create_dir(root.rpartition("/")[0], recursive=True)
    with system.open_output_stream(f"{root}.tmp") as f:
        f.write(data)
    system.move(f"{root}.tmp", root)


# Frames: <path>/<host>/<first seq>-<last seq>.frames holds length-prefixed frames in order


def frame_seq(data: bytes) -> int | None:
    """The sequence number of a frame, if it can be read and has one."""
    try:
        seq = fmt.frame(data)[1].get("seq")
        return seq if isinstance(seq, int) else None
    except (ValueError, IndexError, KeyError, TypeError, AttributeError, RecursionError):
        return None


def _frames(data: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 4], "big")
        yield data[at + 4 : at + 4 + n]
        at += 4 + n


def write_frames(frames: DataFrame, path: str, per_file: int = 10_000) -> int:
    """Files of the frames (pds, seq, bytes) of each host; the number of files."""
    _open(path)

    def run(batches):
        host, own, files = None, [], 0

        def flush():
            nonlocal own, files
            if own:
                _put(f"{path}/{host}/{own[0][0]:020d}-{own[-1][0]:020d}.frames", b"".join(len(b).to_bytes(4, "big") + b for _, b in own))
                own, files = [], files + 1

        for batch in batches:
            for pds, seq, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if pds != host or len(own) >= per_file:
                    flush()
                    host = pds
                own.append((seq, data))
        flush()
        yield pa.RecordBatch.from_pydict({"n": [files]})

    dealt = frames.select("pds", F.col("seq").cast("long"), "bytes").repartition("pds").sortWithinPartitions("pds", "seq")
    return dealt.mapInArrow(run, "n long").agg(F.sum("n")).first()[0]


class Host(InputPartition):
    def __init__(self, host: str, after: int, upto: int):
        self.host, self.after, self.upto = host, after, upto


class FrameStream(DataSourceStreamReader):
    """Offsets are a sequence number for each host. A batch takes at most ``limit`` numbers of a host; one that is not enabled stays where it was."""

    def __init__(self, options):
        self.path, self.positions = options["path"].rstrip("/"), options["positions"]
        self.cursors = {k: int(v) for k, v in json.loads(options["cursors"]).items()}
        self.limit = int(options.get("limit", 1 << 40))
        self.at = self.cursors | self._stored()

    def _stored(self) -> dict[str, int]:
        folder, _, name = self.positions.rpartition("/")
        return json.loads(_read(self.positions)) if name in _names(folder) else {}

    def initialOffset(self) -> dict:
        return self.cursors

    def latestOffset(self) -> dict:
        last = lambda host: max((int(n[:-7].split("-")[1]) for n in _names(f"{self.path}/{host}") if n.endswith(".frames")), default=0)
        return {host: max(at, min(at + self.limit, last(host))) if host in self.cursors else at for host, at in self.at.items()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """What is planned is noted, as a restarted query asks for the next offset before it tells where it was."""
        self.at |= {k: max(v, self.at.get(k, 0)) for k, v in end.items()}
        _put(self.positions, json.dumps(self._stored() | end).encode())
        return [Host(k, start.get(k, self.cursors.get(k, 0)), v) for k, v in end.items() if v > start.get(k, self.cursors.get(k, 0))]

    def read(self, partition: Host):
        """Rows (pds, cursor, bytes); a frame without a number goes with the number before it, at a file's start with the file's first."""
        for name in _names(f"{self.path}/{partition.host}"):
            if not name.endswith(".frames"):
                continue
            first, last = map(int, name[:-7].split("-"))
            if last <= partition.after or first > partition.upto:
                continue
            seq = first
            for data in _frames(_read(f"{self.path}/{partition.host}/{name}")):
                seq = found if (found := frame_seq(data)) is not None else seq
                if partition.after < seq <= partition.upto:
                    yield int(partition.host), seq, data

    def commit(self, end: dict) -> None:
        pass


class FrameSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "host_frames"

    def schema(self) -> str:
        return "pds int, cursor long, bytes binary"

    def streamReader(self, schema) -> FrameStream:
        return FrameStream(self.options)


def frame_stream(spark: SparkSession, path: str, pds: DataFrame, positions: str, limit: int | None = None) -> DataFrame:
    """The frames of all enabled hosts after the cursors that ``pds`` stores, which has a row for each host. ``positions`` names a file of the query's own, beside its checkpoint."""
    _open(path)
    enabled = pds.filter(~F.coalesce("disabled", F.lit(False))).select("id", F.coalesce("cursor", F.lit(0)).alias("cursor"))
    spark.dataSource.register(FrameSource)
    reader = spark.readStream.format("host_frames").option("positions", positions).option("cursors", json.dumps({str(r["id"]): r["cursor"] for r in enabled.collect()}))
    return (reader.option("limit", limit) if limit else reader).load(path)


# Listings: <path>/<host>/<cursor or "first">.json is the page at a cursor


def write_pages(listing: DataFrame, path: str) -> int:
    """Pages of what hosts list (pds, did, rev); the number of pages."""
    _open(path)

    def run(batches):
        host, own, number, pages = None, [], 0, 0

        def flush(more: bool):
            nonlocal own, number, pages
            name = f"c{number}" if number else "first"
            page = {"repos": own} | ({"cursor": f"c{number + 1}"} if more else {})
            _put(f"{path}/{host}/{name}.json", json.dumps(page).encode())
            own, number, pages = [], number + 1, pages + 1

        for batch in batches:
            for pds, did, rev in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if host is not None and (pds != host or len(own) == PAGE):
                    flush(pds == host)
                if pds != host:
                    host, number = pds, 0
                own.append(None if did is None else {"did": did, "rev": rev})
        if own:
            flush(False)
        yield pa.RecordBatch.from_pydict({"n": [pages]})

    return listing.select("pds", "did", "rev").repartition("pds").sortWithinPartitions("pds", "did").mapInArrow(run, "n long").agg(F.sum("n")).first()[0]


class ListingReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"].rstrip("/")

    def partitions(self) -> list[InputPartition]:
        return [Host(name, 0, 0) for name in _names(self.path, folders=True)]

    def read(self, partition: Host):
        """Entries of all pages of a host, in order of their cursors; a page with null entries gives a row with their number, a broken one a row with an error, which ends the host."""
        cursor, number, seen = "first", 0, set()
        while cursor:
            number += 1
            try:
                if cursor in seen:
                    raise ValueError("a page's cursor comes again")
                seen.add(cursor)
                page = json.loads(_read(f"{self.path}/{partition.host}/{cursor}.json"))
                entries = [(x["did"], x.get("rev")) for x in page["repos"] if x is not None]
                if not all(isinstance(d, str) and isinstance(r, (str, type(None))) for d, r in entries):
                    raise ValueError("a field of an entry is no text")
                skipped, cursor = len(page["repos"]) - len(entries), page.get("cursor")
            except (ValueError, KeyError, TypeError, AttributeError, OSError) as e:
                yield int(partition.host), None, None, number, None, f"{type(e).__name__}: {e}"
                return
            for did, rev in entries:
                yield int(partition.host), did, rev, number, None, None
            if skipped:
                yield int(partition.host), None, None, number, skipped, None


class ListingSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "host_listing"

    def schema(self) -> str:
        return "pds int, did string, rev string, page int, skipped int, error string"

    def reader(self, schema) -> ListingReader:
        return ListingReader(self.options)


def listing_pages(spark: SparkSession, path: str) -> DataFrame:
    """Rows (pds, did, rev, page, skipped, error) of all hosts' listings; ``reconcile.listing`` takes the entries from them."""
    _open(path)
    spark.dataSource.register(ListingSource)
    return spark.read.format("host_listing").load(path)
