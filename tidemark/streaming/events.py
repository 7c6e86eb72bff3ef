"""Change-stream operators. Each works on a batch and, where marked, on a stream."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .. import archive_format as fmt
from ..functions.text import collection_of, rkey_of
from ..operators.reconcile import migrate_repos

#: Event types that move a host's cursor, and all that are known (fixed values).
SEQUENCED = ("#commit", "#handle", "#migrate", "#tombstone")
KNOWN = (*SEQUENCED, "#identity", "#account", "#info")
#: Sequence numbers of a host that one sort or join takes together.
SPAN = 1 << 20
DELETES, WRITES = ("delete",), ("create", "update")


def event_stream(spark: SparkSession, path: str, schema, start_seq: int | None = None, source: str = "parquet", seq_col: str | None = "seq", **options) -> DataFrame:
    """A stream of event files of any format, of all events or those after ``start_seq``; Spark's checkpoint keeps the position. A host's numbers may start at 0."""
    read = spark.readStream.schema(schema).format(source).options(**options).load(path)
    return read if start_seq is None or not seq_col else read.filter(F.col(seq_col) > start_seq)


def decode_frames(frames: DataFrame) -> DataFrame:
    """Batch or stream: ``op`` and ``type`` of each frame (pds, cursor, bytes), or the ``error`` for which it can't be read."""
    schema = "pds int, cursor long, bytes binary, op int, type string, error string"

    def read(data):
        try:
            header, _ = fmt.frame(data)
            op, kind = header["op"], header.get("t")
            if op not in (1, -1) or not isinstance(kind, (str, type(None))):
                raise ValueError(f"unknown op {op}")
            return op, kind, None
        except (ValueError, IndexError, KeyError, TypeError, RecursionError) as e:
            return None, None, f"{type(e).__name__}: {e}"

    def run(batches):
        for batch in batches:
            op, kind, error = zip(*(read(x or b"") for x in batch.column(2).to_pylist()), strict=True) if len(batch) else ((), (), ())
            columns = [*batch.columns, pa.array(op, pa.int32()), pa.array(kind, pa.string()), pa.array(error, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["pds", "cursor", "bytes", "op", "type", "error"])

    return frames.select(F.col("pds").cast("int").alias("pds"), F.col("cursor").cast("long").alias("cursor"), "bytes").mapInArrow(run, schema)


def quarantine(bad: DataFrame, stored: DataFrame | None = None, limit: int = 500) -> tuple[DataFrame, DataFrame]:
    """Bad frames to store (pds, cursor, error, content), and for each host beyond ``limit`` the first frame that fails its run.

    ``stored`` (pds, n) counts what each host has already. The rank has a fixed
    limit, so Spark drops rows beyond it before the shuffle.
    """
    nth = F.row_number().over(Window.partitionBy("pds").orderBy("cursor"))
    first = bad.select("pds", "cursor", "error", F.col("bytes").alias("content")).withColumn("nth", nth).filter(F.col("nth") <= limit + 1)
    if stored is not None:
        before = stored.select("pds", F.least("n", F.lit(limit)).alias("_n"))
        first = first.join(before, "pds", "left").withColumn("nth", F.col("nth") + F.coalesce("_n", F.lit(0))).drop("_n")
    return first.filter(F.col("nth") <= limit).drop("nth"), first.filter(F.col("nth") == limit + 1).drop("nth", "content")


def json_events(lines: DataFrame) -> DataFrame:
    """Batch or stream: DIDs of JSON lines in ``value``; empty ones are skipped."""
    return lines.select(F.get_json_object("value", "$.did").alias("did")).filter("did <> ''")


def enabled_events(events: DataFrame, pds: DataFrame) -> DataFrame:
    """Batch or stream: events of hosts that are not disabled."""
    return events.join(pds.filter(F.coalesce(~F.col("disabled"), F.lit(True))).select(F.col("id").alias("pds")), "pds")


def explode_ops(commits: DataFrame) -> DataFrame:
    """Batch or stream: one row per operation of ``ops`` (action, path)."""
    rest = [c for c in commits.columns if c != "ops"]
    ops = commits.select(*rest, F.explode("ops").alias("op")).select(*rest, "op.action", "op.path")
    return ops.withColumn("is_write", F.when(F.col("action").isin(*WRITES), True).when(F.col("action").isin(*DELETES), False)).filter("is_write is not null")


def split_path(ops: DataFrame) -> DataFrame:
    """Batch or stream: collection and rkey of ``path``; rows without a slash go."""
    return ops.withColumns({"collection": collection_of(F.col("path")), "rkey": rkey_of(F.col("path"))}).filter("rkey is not null")


def wrong_host_events(events: DataFrame, repos: DataFrame, identity: DataFrame | None = None, pds: DataFrame | None = None) -> DataFrame:
    """Events from the host that their repo lives on; the others are dropped.

    With ``identity`` (and ``pds``) a repo is looked up anew before an event of
    it is dropped: one that has an event from another host than the stored one
    lives where its identity says, any other one where it did.
    """
    home = repos.select(F.col("id").alias("repo"), F.col("pds").alias("_home"))
    if identity is not None:
        foreign = events.select("repo", "pds").distinct().join(home, "repo").filter(F.col("pds") != F.col("_home")).select(F.col("repo").alias("id")).distinct()
        fresh = migrate_repos(repos.join(foreign, "id", "left_semi"), identity, pds).select(F.col("id").alias("repo"), F.col("pds").alias("_fresh"))
        home = home.join(fresh, "repo", "left").select("repo", F.coalesce("_fresh", "_home").alias("_home"))
    return events.join(home.withColumnRenamed("_home", "pds"), ["repo", "pds"], "left_semi")


def cursor_epochs(events: DataFrame, pds: DataFrame) -> DataFrame:
    """Per host and epoch: the first sequence number since the reset and the range of the epoch.

    An ``#info`` starts an epoch, and the next sequenced event names it. That
    event is sought among the events of the reset's own stretch of ``SPAN``
    numbers, and beyond it among the first numbers of the stretches, so no
    task holds a host's whole history and no event meets all resets.
    """
    stretch = F.floor(F.col("seq") / SPAN).alias("b")
    resets = events.filter(F.col("type") == "#info").select("pds", F.col("seq").alias("low"))
    zero = events.select("pds").distinct().withColumn("low", F.lit(-1).cast("long"))
    by_host = Window.partitionBy("pds").orderBy("low")
    ranges = resets.unionByName(zero).withColumns({"epoch": F.row_number().over(by_host) - 1, "high": F.coalesce(F.lead("low").over(by_host), F.lit((1 << 63) - 1)), "b": F.floor(F.col("low") / SPAN)})
    sequenced = events.filter(F.col("type").isin(*SEQUENCED)).select("pds", "seq", stretch)
    near = ranges.join(sequenced, ["pds", "b"]).filter("seq > low and seq < high").groupBy("pds", "epoch").agg(F.min("seq").alias("near"))
    starts = sequenced.groupBy("pds", "b").agg(F.min("seq").alias("start"))
    after = Window.partitionBy("pds").orderBy(F.desc("b")).rangeBetween(Window.unboundedPreceding, -1)
    both = ranges.unionByName(starts, allowMissingColumns=True).withColumn("far", F.last("start", ignorenulls=True).over(after))
    found = both.filter("epoch is not null").join(near, ["pds", "epoch"], "left").withColumn("first_seq", F.coalesce("near", F.when(F.col("far") < F.col("high"), F.col("far"))))
    stored = pds.select(F.col("id").alias("pds"), F.col("first_cursor_since_reset").alias("stored"))
    first = F.when((F.col("epoch") == 0) & (F.coalesce("stored", F.lit(0)) != 0), F.col("stored")).otherwise(F.col("first_seq"))
    return found.filter("first_seq is not null").join(stored, "pds", "left").select("pds", "epoch", "low", "high", first.alias("first_cursor_since_reset"))


def with_epoch(commits: DataFrame, epochs: DataFrame) -> DataFrame:
    """``commits`` with the ``first_cursor_since_reset`` of the one epoch that each lies in.

    A fill of two levels: inside a stretch of ``SPAN`` numbers of a host the
    last epoch start before a commit counts, and where there is none, the last
    one of the stretches before it. Only stretches, a row each, are ordered by
    host; commits are dealt by host and stretch, once for both levels.
    """
    rest = [c for c in commits.columns if c != "first_cursor_since_reset"]
    stretch = F.floor(F.col("seq") / SPAN)
    own = commits.select(*rest, stretch.alias("_b"), F.lit(True).alias("_own"))
    starts = epochs.select("pds", F.col("low").alias("seq"), F.col("first_cursor_since_reset").alias("_first")).withColumn("_b", stretch)
    marks = own.select("pds", "_b", "seq", F.lit(None).cast("long").alias("_first")).unionByName(starts.select("pds", "_b", "seq", "_first"))
    heads = marks.groupBy("pds", "_b").agg(F.max_by("_first", F.when(F.col("_first").isNotNull(), F.col("seq"))).alias("_last"))
    before = Window.partitionBy("pds").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = heads.select("pds", "_b", F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    inside = Window.partitionBy("pds", "_b").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    filled = own.unionByName(starts, allowMissingColumns=True).withColumn("_near", F.last("_first", ignorenulls=True).over(inside)).filter("_own")
    placed = filled.join(carried, ["pds", "_b"]).withColumn("first_cursor_since_reset", F.coalesce("_near", "_carried"))
    return placed.filter("first_cursor_since_reset is not null").select(*rest, "first_cursor_since_reset")


def repo_anchor(commits: DataFrame, epochs: DataFrame, repos: DataFrame) -> DataFrame:
    """First rev and cursor since the reset of each repo that a commit re-anchors: the last commit at which its host's cursor changed, or that was too big."""
    known = repos.select(F.col("id").alias("repo"), F.col("first_cursor_since_reset").alias("stored"))
    placed = with_epoch(commits.filter(F.col("type") == "#commit"), epochs).join(known, "repo", "left")
    before = F.lag("first_cursor_since_reset").over(Window.partitionBy("repo").orderBy("seq"))
    changed = F.coalesce(before, F.col("stored"), F.lit(0)) != F.col("first_cursor_since_reset")
    anchors = placed.withColumn("changed", changed).filter("changed or too_big")
    return anchors.groupBy("repo").agg(F.max_by("rev", "seq").alias("first_rev_since_reset"), F.max_by("first_cursor_since_reset", "seq").alias("first_cursor_since_reset"))


def too_big(commits: DataFrame) -> DataFrame:
    return commits.filter((F.col("type") == "#commit") & F.col("too_big")).select("repo", "rev", "seq")


class Repo:
    """What the stream knows of one repo; times are microseconds.

    A commit advances the live rev if the repo misses nothing and was idle, and
    re-anchors the repo if it is too big or its host's cursor is another one.
    Both touch the repo, so the next advance waits for another idle time.
    """

    def __init__(self, cursor, first_rev, indexed, touched, idle):
        self.cursor, self.first_rev, self.indexed, self.touched, self.idle = cursor, first_rev, indexed, touched, idle

    def commit(self, time, rev, host_first, big) -> tuple[bool, bool]:
        """Whether the commit anchors, and whether it advances."""
        free = self.cursor > 0 and host_first > 0 and self.cursor >= host_first and bool(self.first_rev) and bool(self.indexed) and self.first_rev <= self.indexed
        advances = free and self.touched is not None and time - self.touched > self.idle
        anchors = big or self.cursor != host_first
        if anchors:
            self.cursor, self.first_rev = host_first, rev
        if anchors or advances:
            self.touched = time
        return anchors, advances


def micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def stored_state(repos: DataFrame, touched_col: str) -> DataFrame:
    """Stored columns that a ``Repo`` starts from."""
    return repos.select(
        F.col("id").alias("repo"), F.coalesce(F.col("first_cursor_since_reset").cast("long"), F.lit(0)).alias("stored"), F.coalesce("first_rev_since_reset", F.lit("")).alias("stored_rev"),
        F.coalesce("last_indexed_rev", F.lit("")).alias("indexed"), micros(F.col(touched_col)).alias("touched"),
    )


def firehose_rev_advance(repos: DataFrame, commits: DataFrame, pds: DataFrame, idle: str = "24 hours", touched_col: str = "updated_at") -> DataFrame:
    """Repos with the last live rev that their commits advance to.

    The host's cursor is that of ``commits`` if they have one, else the stored
    one. Only repos with an indexed rev can advance. Commits are sorted by repo
    and seq within partitions and read once, with one repo in memory.
    """
    known = stored_state(repos, touched_col).filter("indexed <> '' and touched is not null")
    placed = commits.filter(F.col("type") == "#commit")
    if "first_cursor_since_reset" not in commits.columns:
        hosts = pds.select(F.col("id").alias("_pds"), F.col("first_cursor_since_reset"))
        known = known.join(repos.select(F.col("id").alias("repo"), F.col("pds").alias("_pds")), "repo").join(hosts, "_pds")
    due = placed.join(known, "repo").select("repo", "seq", micros(F.col("time")).alias("at"), "rev", F.coalesce(F.col("first_cursor_since_reset").cast("long"), F.lit(0)).alias("host"), "too_big", "stored", "stored_rev", "indexed", "touched")
    wait = int(pd.Timedelta(idle) / pd.Timedelta(microseconds=1))

    def run(frames):
        at, state, last = None, None, None
        for frame in frames:
            out = []
            for repo, _, time, rev, host, big, *stored in frame.itertuples(index=False, name=None):
                if repo != at:
                    if last is not None:
                        out.append((at, last))
                    at, state, last = repo, Repo(*stored, wait), None
                if state.commit(time, rev, host, big)[1]:
                    last = rev
            yield pd.DataFrame(out, columns=["repo", "last_firehose_rev"])
        if last is not None:
            yield pd.DataFrame([(at, last)], columns=["repo", "last_firehose_rev"])

    return due.repartition("repo").sortWithinPartitions("repo", "seq").mapInPandas(run, "repo long, last_firehose_rev string")


def host_cursor(events: DataFrame) -> DataFrame:
    return events.filter(F.col("type").isin(*SEQUENCED)).groupBy("pds").agg(F.max("seq").alias("cursor"))


def detect_seq_gap(events: DataFrame) -> DataFrame:
    """Events that do not follow their host's event before them by one. Each stretch of ``SPAN`` numbers is sorted by itself; only their ends are compared by host."""
    placed = events.select("pds", "seq", F.floor(F.col("seq") / SPAN).alias("b"))
    inner = placed.select("pds", F.lag("seq").over(Window.partitionBy("pds", "b").orderBy("seq")).alias("before"), "seq")
    ends = placed.groupBy("pds", "b").agg(F.min("seq").alias("seq"), F.max("seq").alias("end"))
    outer = ends.select("pds", F.lag("end").over(Window.partitionBy("pds").orderBy("b")).alias("before"), "seq")
    return inner.unionByName(outer).filter("before is not null and seq <> before + 1")


def dead_letter(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without and with an ``error``."""
    return parsed.filter("error is null"), parsed.filter("error is not null")


def unknown_events(events: DataFrame) -> DataFrame:
    return events.filter(~F.col("type").isin(*KNOWN)).groupBy("pds", "type").agg(F.count("*").alias("n"))


def error_frames(events: DataFrame) -> DataFrame:
    """Frames with op -1, which end their host's run."""
    return events.filter(F.col("op") == -1)


def identity_invalidation(events: DataFrame) -> DataFrame:
    return events.filter(F.col("type") == "#identity").groupBy("repo").agg(F.max("seq").alias("seq"))


def first_seen_dids(stream: DataFrame, within: str | None = None, time_col: str = "time") -> DataFrame:
    """Batch: each DID once. Stream: once within a time, so that state stays bounded."""
    if within is None:
        return stream.select("did").distinct()
    return stream.withWatermark(time_col, within).dropDuplicatesWithinWatermark(["did"])


def events_per_window(events: DataFrame, width: str = "1 hour", watermark: str | None = None) -> DataFrame:
    """Batch or stream: events per host and tumbling window of ``time``."""
    timed = events.withColumn("time", F.col("time").cast("timestamp"))
    if watermark:
        timed = timed.withWatermark("time", watermark)
    counts = timed.groupBy("pds", F.window("time", width).alias("w")).agg(F.count("*").alias("n"))
    return counts.select("pds", F.col("w.start").cast("timestamp_ntz").alias("start"), "n")
