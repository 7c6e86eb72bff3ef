"""The versioned record store: append-only versions, their folds, and current rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import is_unset

KEY = ("repo", "collection", "rkey")
#: What ``current_parts`` gives and a table of parts holds.
PARTS = "repo long, collection string, rkey string, newest struct<at_rev:string,order:long,content:string>, first_write long, last_delete long"


def fold_versions(versions: DataFrame) -> DataFrame:
    """Rows of one key and rev become one: deleted if any is, with the content that is there."""
    return versions.groupBy(*KEY, "at_rev").agg(F.bool_or("deleted").alias("deleted"), F.max("content").alias("content"))


def latest_version(versions: DataFrame, key=KEY) -> DataFrame:
    """The version of largest rev for each key, as an aggregate (partial in the map, no sort)."""
    rest = [c for c in versions.columns if c not in key]
    order = F.struct(F.col("at_rev"), *(F.col(c) for c in rest if c != "at_rev"))
    newest = versions.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("v"))
    return newest.select(*key, *(F.col(f"v.{c}").alias(c) for c in rest))


def current_records(versions: DataFrame) -> DataFrame:
    """Newest versions that are not deleted; without a mark a row is live."""
    return latest_version(versions).filter(~F.coalesce("deleted", F.lit(False)))


def append_versions(ops: DataFrame) -> DataFrame:
    """Write and tombstone rows from exploded operations."""
    gone = F.col("action") == "delete"
    return ops.filter(F.col("action").isin("create", "update", "delete")).select(*KEY, F.col("rev").alias("at_rev"), gone.alias("deleted"), F.when(~gone, F.col("content")).alias("content"))


def changes_since(versions: DataFrame, since: DataFrame) -> DataFrame:
    """Versions newer than ``since.since_rev`` of their repo; without one, all."""
    return versions.join(since.select("repo", "since_rev"), "repo", "left").filter(is_unset(F.col("since_rev")) | (F.col("at_rev") > F.col("since_rev"))).drop("since_rev")


def upsert_current(current: DataFrame, writes: DataFrame, require_change: bool = False) -> DataFrame:
    """Current rows after writes: the newest write of a key wins if it is newer than the row; ``deleted`` is never cleared."""
    newest = writes.groupBy(*KEY).agg(F.max_by(F.struct("at_rev", "content"), F.struct("at_rev", "content")).alias("w"))
    both = current.withColumn("_old", F.lit(True)).join(newest, list(KEY), "full_outer")
    newer = F.col("w").isNotNull() & (is_unset(F.col("at_rev")) | (F.col("w.at_rev") > F.col("at_rev")))
    if require_change:
        newer &= F.col("_old").isNull() | ~same_json(F.col("content"), F.col("w.content"))
    return both.select(*KEY, F.when(newer, F.col("w.at_rev")).otherwise(F.col("at_rev")).alias("at_rev"), F.when(newer, F.col("w.content")).otherwise(F.col("content")).alias("content"), F.coalesce("deleted", F.lit(False)).alias("deleted"))


def current_parts(ops: DataFrame) -> DataFrame:
    """Per key of a batch of operations: its newest write, its first write and its last delete, from which ``fold_current`` gets the row.

    Of writes of equal rev the first counts. Parts of different batches merge
    in any order, so a stream only appends them.
    """
    write, gone = F.col("action").isin("create", "update"), F.col("action") == "delete"
    newest = F.max(F.when(write, F.struct(F.col("rev").alias("at_rev"), (-F.col("seq")).alias("order"), "content"))).alias("newest")
    return ops.groupBy(*KEY).agg(newest, F.min(F.when(write, F.col("seq"))).alias("first_write"), F.max(F.when(gone, F.col("seq"))).alias("last_delete"))


def fold_parts(parts: DataFrame) -> DataFrame:
    """One part for each key: largest and smallest values, so parts that are there twice change nothing."""
    return parts.groupBy(*KEY).agg(F.max("newest").alias("newest"), F.min("first_write").alias("first_write"), F.max("last_delete").alias("last_delete"))


def current_rows(folded: DataFrame) -> DataFrame:
    """Rows from whole parts: a delete marks a row that was there before it, and the mark stays."""
    rows = folded.filter("first_write is not null")
    return rows.select(*KEY, "newest.at_rev", "newest.content", F.coalesce(F.col("last_delete") > F.col("first_write"), F.lit(False)).alias("deleted"))


def fold_current(parts: DataFrame) -> DataFrame:
    """Current rows from all parts."""
    return current_rows(fold_parts(parts))


def same_json(a, b):
    """Equal by meaning; text that is no JSON compares as text."""
    normal = lambda x: F.coalesce(F.to_json(F.try_parse_json(x)), x)
    return normal(a).eqNullSafe(normal(b))


def soft_delete(current: DataFrame, deletes: DataFrame) -> DataFrame:
    """Marks rows by key, whatever their rev, which stays."""
    gone = deletes.select(*KEY).distinct().withColumn("_gone", F.lit(True))
    return current.join(gone, list(KEY), "left").withColumn("deleted", F.coalesce("_gone", "deleted", F.lit(False))).drop("_gone")


def versions_sorted(versions: DataFrame) -> DataFrame:
    return versions.repartition("repo", "collection").sortWithinPartitions("repo", "collection", "rkey", F.desc("at_rev"))


def snapshot_diff(fetched: DataFrame, versions: DataFrame, mark_missing: bool = False) -> DataFrame:
    """Fetched rows to append (only versions of their repos are folded): not those whose newest stored row has a larger rev, or is live with equal content.

    A stored row without a mark is live. With ``mark_missing`` live stored rows of fetched repos that the snapshot lacks come back as tombstones.
    """
    of_fetched = versions.join(fetched.select("repo").distinct(), "repo", "left_semi")
    stored = latest_version(of_fetched).select(*KEY, F.col("at_rev").alias("_rev"), F.coalesce("deleted", F.lit(False)).alias("_deleted"), F.col("content").alias("_content"))
    joined = fetched.join(stored, list(KEY), "left")
    skip = (F.col("_rev") > F.col("at_rev")) | (~F.col("_deleted") & (F.col("_content") == F.col("content")))
    kept = joined.filter(F.col("_rev").isNull() | ~F.coalesce(skip, F.lit(False))).select(*fetched.columns)
    if not mark_missing:
        return kept
    revs = fetched.groupBy("repo").agg(F.max("at_rev").alias("at_rev"))
    missing = stored.filter(~F.col("_deleted")).join(fetched, list(KEY), "left_anti").join(revs, "repo").filter("at_rev > _rev")
    return kept.unionByName(missing.select(*KEY, "at_rev", F.lit(True).alias("deleted"), F.lit(None).cast("string").alias("content")), allowMissingColumns=True)


def snapshot_upsert(current: DataFrame, fetched: DataFrame) -> DataFrame:
    return upsert_current(current, fetched, require_change=True)
