"""Streaming forms of the cursor and repository state, keyed by host and by repo, and the stream sinks.

The stored tables are read once, as the initial state of their keys; from then
on the state counts. A key's rows of one micro-batch are sorted by seq, as
their order in the parts is not known. A row of a later micro-batch whose seq
is not above the key's last one counts as a replay and is dropped, so each
key's events must reach the stream in order of seq.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..sources.merge_table import MergeTable
from ..sources.scratch import shared_folder
from .events import SEQUENCED, Repo, decode_frames, micros, quarantine, stored_state

EPOCHS = "pds int, epoch int, first_cursor_since_reset long"
ANCHORS = "repo long, rev string, first_cursor_since_reset long, last_firehose_rev string"
CURSORS = "pds int, cursor long"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _keyed(df: DataFrame, key: str, processor: StatefulProcessor, schema: str, time: str, initial: DataFrame | None = None) -> DataFrame:
    """``processor`` over the rows of each key; its kind of state needs the store that keeps state variables."""
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    return df.groupBy(key).transformWithStateInPandas(processor, schema, "append", time, initialState=initial.groupBy(key) if initial is not None else None)


def _sorted(parts) -> pd.DataFrame:
    return pd.concat(list(parts)).sort_values("seq")


class Epochs(StatefulProcessor):
    """State: epoch, whether it waits for its first sequenced event, last seq, stored cursor. Replays change nothing."""

    def init(self, handle) -> None:
        self.state = handle.getValueState("host", "epoch int, waiting boolean, last long, stored long")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.state.update((0, True, -1, int(initialState["stored"].iloc[0])))

    def handleInputRows(self, key, rows, timerValues):
        epoch, waiting, last, stored = self.state.get() or (0, True, -1, 0)
        out = []
        frame = _sorted(rows)
        for seq, kind in zip(frame["seq"].tolist(), frame["type"].tolist(), strict=True):
            if seq <= last:
                continue
            last = seq
            if kind == "#info":
                epoch, waiting = epoch + 1, True
            elif waiting:
                waiting = False
                out.append((key[0], epoch, stored if epoch == 0 and stored else seq))
        self.state.update((epoch, waiting, last, stored))
        yield pd.DataFrame(out, columns=["pds", "epoch", "first_cursor_since_reset"])

    def close(self) -> None:
        pass


def cursor_reset_stream(stream: DataFrame, pds: DataFrame | None = None) -> DataFrame:
    """Emits each host epoch once, at its first sequenced event; the epoch before any reset has the cursor that ``pds`` stores. Only resets and sequenced events reach the state."""
    needed = stream.filter(F.col("type").isin("#info", *SEQUENCED)).select(F.col("pds").cast("int").alias("pds"), "seq", "type")
    stored = pds.filter("first_cursor_since_reset <> 0").select(F.col("id").cast("int").alias("pds"), F.col("first_cursor_since_reset").cast("long").alias("stored")) if pds is not None else None
    return _keyed(needed, "pds", Epochs(), EPOCHS, "None", stored)


class Anchors(StatefulProcessor):
    """State: the cursor and rev that a repo is anchored at, its indexed rev, when it was touched, last seq.

    With ``expire_ms`` the state of a repo without commits for so long is
    dropped; its next commit then anchors it anew, which asks for another
    index of it and loses nothing.
    """

    def __init__(self, idle: int, expire_ms: int | None):
        self.idle, self.expire_ms = idle, expire_ms

    def init(self, handle) -> None:
        schema = "cursor long, rev string, indexed string, touched long, last long"
        self.state = handle.getValueState("repo", schema, self.expire_ms) if self.expire_ms else handle.getValueState("repo", schema)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        row = initialState.iloc[0]
        self.state.update((int(row["stored"]), row["stored_rev"], row["indexed"], None if pd.isna(row["touched"]) else int(row["touched"]), -1))

    def handleInputRows(self, key, rows, timerValues):
        cursor, rev, indexed, touched, last = self.state.get() or (0, "", "", None, -1)
        repo = Repo(cursor, rev, indexed, touched, self.idle)
        out = []
        frame = _sorted(rows)
        for seq, at, rev, first, big in zip(*(frame[c].tolist() for c in ("seq", "at", "rev", "host", "too_big")), strict=True):
            if seq <= last:
                continue
            last = seq
            anchors, advances = repo.commit(at, rev, first, big)
            if anchors or advances:
                out.append((key[0], rev if anchors else None, first if anchors else None, rev if advances else None))
        self.state.update((repo.cursor, repo.first_rev, indexed, repo.touched, last))
        found = pd.DataFrame(out, columns=["repo", "rev", "first_cursor_since_reset", "last_firehose_rev"])
        yield found.astype({"first_cursor_since_reset": "Int64"})

    def close(self) -> None:
        pass


def repo_state_stream(stream: DataFrame, repos: DataFrame | None = None, idle: str = "24 hours", touched_col: str = "updated_at", expire: str | None = None) -> DataFrame:
    """Emits each re-anchoring of a repo (rev and cursor) and each advance of its ``last_firehose_rev``; what does not change is null.

    ``stream`` has repo, seq, rev, too_big and the host's cursor at that event,
    and ``time`` where ``repos`` is given; without stored rows nothing advances.
    """
    at = micros(F.col("time")) if repos is not None else F.lit(0).cast("long")
    needed = stream.select(F.col("repo").cast("long").alias("repo"), "seq", at.alias("at"), "rev", "too_big", F.coalesce(F.col("first_cursor_since_reset").cast("long"), F.lit(0)).alias("host"))
    stored = stored_state(repos, touched_col).withColumn("repo", F.col("repo").cast("long")) if repos is not None else None
    wait = int(pd.Timedelta(idle) / pd.Timedelta(microseconds=1))
    expire_ms = int(pd.Timedelta(expire) / pd.Timedelta(milliseconds=1)) if expire else None
    return _keyed(needed, "repo", Anchors(wait, expire_ms), ANCHORS, "ProcessingTime" if expire else "None", stored)


class Throttle:
    """When the cursor of a host is stored; times are microseconds.

    A jump is stored at once, otherwise the newest cursor once in a ``width``:
    at the first event after it, and what then still waits at its end.
    """

    def __init__(self, last, saved_at, waits, width, jump):
        self.last, self.saved_at, self.waits, self.width, self.jump = last, saved_at, waits, width, jump

    def event(self, seq, time) -> list[int]:
        out = self.due(time)
        if self.saved_at is None or abs(seq - self.last) >= self.jump or time - self.saved_at >= self.width:
            out.append(seq)
            self.saved_at, self.waits = time, False
        else:
            self.waits = True
        self.last = seq
        return out

    def due(self, time) -> list[int]:
        """What the end of the width stores, if ``time`` has reached it."""
        if not self.waits or time < self.saved_at + self.width:
            return []
        self.saved_at, self.waits = self.saved_at + self.width, False
        return [self.last]


class Cursors(StatefulProcessor):
    """State: a host's newest cursor, when one was stored, whether the newest waits.

    A timer ends the wait of a host that falls silent. One that had events in
    the batch is not: its next event decides, so a timer that ends there is put
    off until the watermark moves on, as its events may lie before that.
    """

    def __init__(self, width: int, jump: int):
        self.width, self.jump = width, jump

    def init(self, handle) -> None:
        self.handle, self.state, self.heard = handle, handle.getValueState("cursor", "last long, saved_at long, waits boolean"), set()

    def _put(self, key, throttle: Throttle, out: list[int]):
        self.state.update((throttle.last, throttle.saved_at, throttle.waits))
        if throttle.waits:
            self.handle.registerTimer(-(-(throttle.saved_at + self.width) // 1000))
        return pd.DataFrame([(key[0], seq) for seq in out], columns=["pds", "cursor"])

    def handleInputRows(self, key, rows, timerValues):
        self.heard.add(key)
        throttle = Throttle(*(self.state.get() or (-1, None, False)), self.width, self.jump)
        out: list[int] = []
        frame = _sorted(rows)
        for seq, at in zip(frame["seq"].tolist(), frame["at"].tolist(), strict=True):
            if seq > throttle.last:
                out += throttle.event(seq, at)
        yield self._put(key, throttle, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if key in self.heard:
            self.handle.registerTimer(timerValues.getCurrentWatermarkInMs() + 1)
            yield pd.DataFrame([], columns=["pds", "cursor"])
            return
        throttle = Throttle(*self.state.get(), self.width, self.jump)
        yield self._put(key, throttle, throttle.due(expiredTimerInfo.getExpiryTimeInMs() * 1000))

    def close(self) -> None:
        pass


def host_cursor_stream(stream: DataFrame, width: str = "15 seconds", jump: int = 100_000, late: str = "0 seconds") -> DataFrame:
    """The cursors of each host that are stored: at most one in a ``width`` of event time unless it jumps; see ``Throttle``.

    Events older than the watermark count too, as hosts' clocks differ: the
    state reads the time as a number, so the watermark only ends waits.
    """
    timed = stream.filter(F.col("type").isin(*SEQUENCED)).withColumn("time", F.col("time").cast("timestamp")).withWatermark("time", late)
    needed = timed.select(F.col("pds").cast("int").alias("pds"), "seq", micros(F.col("time")).alias("at"))
    return _keyed(needed, "pds", Cursors(int(pd.Timedelta(width) / pd.Timedelta(microseconds=1)), jump), CURSORS, "EventTime")


def waiting_cursors(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Cursors that a stopped ``host_cursor_stream`` still held back, from its state, so that a shutdown loses none."""
    held = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "cursor").load()
    return held.filter("value.waits").select(F.col("key.pds").alias("pds"), F.col("value.last").alias("cursor"))


class FirstSeen(StatefulProcessor):
    """State of a shard: a table of fixed size with the fingerprint that each place saw last."""

    def __init__(self, places: int):
        self.places = places

    def init(self, handle) -> None:
        self.state = handle.getValueState("seen", "table binary")

    def handleInputRows(self, key, rows, timerValues):
        known = self.state.get()
        table = bytearray(known[0]) if known else bytearray(16 * self.places)
        for frame in rows:
            out = []
            for did in frame["did"].tolist():
                print_ = hashlib.md5(did.encode(), usedforsecurity=False).digest()
                at = 16 * (int.from_bytes(print_[8:], "big") % self.places)
                if table[at : at + 16] != print_:
                    table[at : at + 16] = print_
                    out.append(did)
            yield pd.DataFrame({"did": pd.Series(out, dtype=object)})
        self.state.update((bytes(table),))

    def close(self) -> None:
        pass


def first_seen_cached(stream: DataFrame, shards: int = 64, places: int = 2560) -> DataFrame:
    """Each DID at least once, with a state of ``shards`` * ``places`` fingerprints of 16 bytes, however many DIDs there are.

    A DID comes again only after another one has taken its place. The sizes
    default to 2.6 MB in all.
    """
    named = stream.filter("did <> ''").select("did", F.pmod(F.xxhash64("did"), F.lit(shards)).cast("int").alias("shard"))
    return _keyed(named, "shard", FirstSeen(places), "did string", "None")


def upsert_batches(stream: DataFrame, table: MergeTable, checkpoint: str, compact_every: int = 16):
    """Merges the operations of a stream into a table of current rows: each batch is a delta, and each ``compact_every`` batches they are folded into the base."""
    from ..operators.store import current_parts

    def put(batch: DataFrame, number: int) -> None:
        table.append(current_parts(batch))
        if (number + 1) % compact_every == 0:
            table.compact()

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def dead_letter_batches(frames: DataFrame, path: str, failed: str, checkpoint: str, limit: int = 500):
    """Stores frames that can't be read, at most ``limit`` for each host, and in ``failed`` the frame that ends a host's run.

    A batch decodes its frames once and reads only what the batch before it has
    left: a row for each host with the number of its stored frames.
    """
    counts = f"{path}-counts"

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        bad = f"{shared_folder(spark)}/bad"
        decode_frames(batch).filter("error is not null").write.parquet(bad)
        before = spark.read.parquet(f"{counts}/batch={number - 1}") if number else spark.createDataFrame([], "pds int, n long")
        kept, ended = quarantine(spark.read.parquet(bad), before, limit)
        kept.write.mode("overwrite").parquet(f"{path}/batch={number}")
        ended.write.mode("overwrite").parquet(f"{failed}/batch={number}")
        own = spark.read.schema("pds int").parquet(f"{path}/batch={number}").groupBy("pds").agg(F.count("*").alias("n"))
        own.unionByName(before).groupBy("pds").agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(f"{counts}/batch={number}")

    return frames.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merge_batches(stream: DataFrame, path: str, checkpoint: str):
    """Appends record versions of a stream to a Parquet store, a folder for each batch, so that a repeated batch overwrites itself."""
    from ..operators.store import append_versions

    def put(batch: DataFrame, number: int) -> None:
        append_versions(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
