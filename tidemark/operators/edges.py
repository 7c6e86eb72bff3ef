"""Graph edges and nodes from records.

``records`` names its account by number; ``repos`` maps numbers to DIDs. Counted
edges are pre-aggregated by number before the join, which gives the same rows
because DIDs are unique, and moves less.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import json_text, uri_did

FOLLOW, BLOCK, LIKE, POST = "app.bsky.graph.follow", "app.bsky.graph.block", "app.bsky.feed.like", "app.bsky.feed.post"
#: Days and the weight that a newer edge gets on top.
LADDER = ((30, 10), (60, 5), (90, 3), (360, 1))


def filter_collection(records: DataFrame, name: str) -> DataFrame:
    return records.filter(F.col("collection") == name)


def filter_recent(df: DataFrame, as_of: str, days: int = 30, col: str = "created_at") -> DataFrame:
    return df.filter(F.col(col) > newer_than(as_of, days))


def newer_than(as_of: str, days: int) -> Column:
    return F.date_sub(F.lit(as_of).cast("date"), days).cast("timestamp_ntz")


def filter_self_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Edges to oneself and edges without an end go."""
    return edges.filter(F.col(src) != F.col(dst))


def filter_did_prefix(df: DataFrame, col: str, prefix: str = "did:") -> DataFrame:
    return df.filter(F.col(col).startswith(prefix))


def join_records_repos(records: DataFrame, repos: DataFrame) -> DataFrame:
    return records.join(repos.select(F.col("id").alias("repo"), "did"), "repo")


def _ends(records: DataFrame, collection: str, dst: Column, as_of, days, include_deleted: bool) -> DataFrame:
    rows = filter_collection(records, collection)
    if not include_deleted:
        rows = rows.filter(~F.coalesce("deleted", F.lit(False)))
    if days is not None:
        rows = filter_recent(rows, as_of, days)
    return rows.select("repo", "created_at", dst.alias("dst")).filter("dst is not null")


def _plain(records, repos, collection, as_of, days, include_deleted):
    ends = _ends(records, collection, json_text("content", "$.subject"), as_of, days, include_deleted)
    return filter_self_edges(join_records_repos(ends, repos).select(F.col("did").alias("src"), "dst"))


def _counted(records, repos, collection, uri, as_of, days, include_deleted):
    ends = _ends(records, collection, uri_did(uri), as_of, days, include_deleted)
    counts = ends.groupBy("repo", "dst").agg(F.count("*").alias("count"))
    return filter_self_edges(join_records_repos(counts, repos).select(F.col("did").alias("src"), "dst", "count"))


def _ladder(records, repos, collection, uri, as_of, steps):
    ends = _ends(records, collection, uri_did(uri), None, None, True)
    weight = reduce(lambda a, b: a + b, (F.sum(F.when(F.col("created_at") > newer_than(as_of, d), w).otherwise(0)) for d, w in steps))
    counts = ends.groupBy("repo", "dst").agg(weight.alias("count"))
    known = filter_did_prefix(join_records_repos(counts, repos), "did")
    return filter_self_edges(known.select(F.col("did").alias("src"), "dst", "count"))


def edges_follow(records, repos, as_of=None, days=None, include_deleted=True):
    return _plain(records, repos, FOLLOW, as_of, days, include_deleted)


def edges_block(records, repos, as_of=None, days=None, include_deleted=True):
    return _plain(records, repos, BLOCK, as_of, days, include_deleted)


def edges_like(records, repos, as_of=None, days=None, include_deleted=True):
    return _counted(records, repos, LIKE, json_text("content", "$.subject.uri"), as_of, days, include_deleted)


def edges_reply(records, repos, as_of=None, days=None, include_deleted=True):
    return _counted(records, repos, POST, json_text("content", "$.reply.parent.uri"), as_of, days, include_deleted)


def edges_like_ladder(records, repos, as_of, steps=LADDER):
    """Pairs whose likes are all older than the last step stay with count 0."""
    return _ladder(records, repos, LIKE, json_text("content", "$.subject.uri"), as_of, steps)


def edges_reply_ladder(records, repos, as_of, steps=LADDER):
    return _ladder(records, repos, POST, json_text("content", "$.reply.parent.uri"), as_of, steps)


def dids(records: DataFrame, repos: DataFrame, as_of=None, days=None, prefix: str | None = None) -> DataFrame:
    """Accounts and all ends of their edges, each once, from one scan of the records.

    Edges to oneself need no test, as every account is in the result. With
    ``prefix`` likes and replies count only of accounts whose DID starts so.
    """
    kind = F.col("collection")
    plain = kind.isin(FOLLOW, BLOCK)
    uri = F.when(kind == LIKE, json_text("content", "$.subject.uri")).otherwise(json_text("content", "$.reply.parent.uri"))
    rows = records.filter(kind.isin(FOLLOW, BLOCK, LIKE, POST))
    if days is not None:
        rows = filter_recent(rows, as_of, days)
    ends = rows.select("repo", plain.alias("plain"), F.when(plain, json_text("content", "$.subject")).otherwise(uri_did(uri)).alias("did")).filter("did is not null")
    known = repos.select(F.col("id").alias("repo"), (F.col("did").startswith(prefix) if prefix else F.lit(True)).alias("counts"))
    return ends.join(known, "repo").filter("plain or counts").select("did").unionByName(repos.select("did")).distinct()


def optouts(repos: DataFrame, records: DataFrame, did: str) -> DataFrame:
    """Accounts with a block record that names ``did`` anywhere in its subject; one row for each such record."""
    blocks = filter_collection(records, BLOCK).filter(json_text("content", "$.subject").contains(did))
    return join_records_repos(blocks.select("repo"), repos).select("did")
