"""Host listings and snapshots against known repositories."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import is_unset, normal_host


def listing(df: DataFrame) -> DataFrame:
    """Listed (pds, did, rev); null entries are skipped."""
    return df.filter("did is not null").select("pds", "did", "rev")


def new_repos(listed: DataFrame, repos: DataFrame) -> DataFrame:
    return listing(listed).dropDuplicates(["did"]).join(repos, "did", "left_anti")


def fill_first_rev(repos: DataFrame, listed: DataFrame, pds: DataFrame) -> DataFrame:
    """Known repos without a first rev take the listed rev and the host's cursor; a host cursor of 0 changes nothing."""
    revs = listing(listed).groupBy("did").agg(F.max("rev").alias("_rev"))
    hosts = pds.select(F.col("id").alias("pds"), F.col("first_cursor_since_reset").alias("_cursor"))
    joined = repos.join(revs, "did", "left").join(hosts, "pds", "left")
    fill = is_unset(F.col("first_rev_since_reset")) & ~is_unset(F.col("_rev"))
    cursor = F.when(fill & (F.col("_cursor") != 0), F.col("_cursor")).otherwise(F.col("first_cursor_since_reset"))
    return joined.withColumns({"first_cursor_since_reset": cursor, "first_rev_since_reset": F.when(fill, F.col("_rev")).otherwise(F.col("first_rev_since_reset"))}).select(*repos.columns)


def migrate_repos(repos: DataFrame, identity: DataFrame, pds: DataFrame) -> DataFrame:
    """Repos whose resolved host differs move there, and their first rev and cursor are cleared."""
    hosts = pds.select(F.col("id").alias("_pds"), normal_host(F.col("host")).alias("_host"))
    where = identity.select("did", normal_host(F.col("endpoint")).alias("_host")).join(hosts, "_host").select("did", "_pds")
    joined = repos.join(where, "did", "left")
    moved = F.col("_pds").isNotNull() & (F.col("_pds") != F.col("pds"))
    return joined.withColumns({"pds": F.when(moved, F.col("_pds")).otherwise(F.col("pds")), "first_rev_since_reset": F.when(moved, "").otherwise(F.col("first_rev_since_reset")), "first_cursor_since_reset": F.when(moved, F.lit(0)).otherwise(F.col("first_cursor_since_reset")).cast("long")}).select(*repos.columns)


def list_reconcile(repos: DataFrame, pds: DataFrame, listed: DataFrame, as_of: str) -> tuple[DataFrame, DataFrame]:
    """Repos with new ones added and first revs filled, and hosts with the time of the listing."""
    hosts = pds.select(F.col("id").alias("pds"), F.col("first_cursor_since_reset"))
    new = new_repos(listed, repos).join(hosts, "pds", "left").select("pds", "did", F.col("rev").alias("first_rev_since_reset"), "first_cursor_since_reset")
    after = fill_first_rev(repos, listed, pds).unionByName(new, allowMissingColumns=True)
    seen = listed.select(F.col("pds").alias("id")).distinct().withColumn("_seen", F.lit(True))
    stamped = pds.join(seen, "id", "left").withColumn("last_list", F.when(F.col("_seen"), F.lit(as_of).cast("timestamp")).otherwise(F.col("last_list"))).drop("_seen")
    return after, stamped


def snapshot_finish(repos: DataFrame, results: DataFrame) -> DataFrame:
    """``results``: did, rev (null for an empty delta), host_cursor noted before the fetch. Cursors never sink."""
    joined = repos.join(results.select("did", F.col("rev").alias("_rev"), F.col("host_cursor").alias("_cursor")), "did", "left")
    rev = F.when(~is_unset(F.col("_rev")), F.col("_rev")).otherwise(F.col("last_indexed_rev"))
    return joined.withColumns({"last_indexed_rev": rev, "first_cursor_since_reset": F.greatest("first_cursor_since_reset", "_cursor")}).select(*repos.columns)
