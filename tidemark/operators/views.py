"""Typed views of posts, lists and list items over JSON records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import json_text, safe_timestamp
from .edges import filter_collection, join_records_repos

POST, LIST, LISTITEM, LISTBLOCK = "app.bsky.feed.post", "app.bsky.graph.list", "app.bsky.graph.listitem", "app.bsky.graph.listblock"
#: Collections with partitions of their own, or known otherwise (fixed values).
KNOWN = [
    "app.bsky.actor.profile", "app.bsky.feed.generator", "app.bsky.feed.like", "app.bsky.feed.post", "app.bsky.feed.repost", "app.bsky.feed.threadgate",
    "app.bsky.graph.block", "app.bsky.graph.follow", "app.bsky.graph.list", "app.bsky.graph.listblock", "app.bsky.graph.listitem",
]


def posts_view(records: DataFrame) -> DataFrame:
    posts = filter_collection(records, POST)
    return posts.withColumns({"langs": json_text("content", "$.langs"), "content_created_at": safe_timestamp(json_text("content", "$.createdAt"))})


def lists_view(records: DataFrame, repos: DataFrame) -> DataFrame:
    rows = join_records_repos(filter_collection(records, LIST), repos)
    fields = {n: json_text("content", f"$.{n}") for n in ("name", "description", "purpose")}
    return rows.withColumns(fields | {"uri": F.concat(F.lit("at://"), "did", F.lit(f"/{LIST}/"), "rkey")})


def listitems_view(records: DataFrame) -> DataFrame:
    return filter_collection(records, LISTITEM).withColumns({"list": json_text("content", "$.list"), "subject": json_text("content", "$.subject")})


def has_lang(lang: str):
    """An array element, a scalar text or an object key equal to ``lang``, by the JSON of ``langs`` as a variant."""
    value = F.try_parse_json("langs")
    kind = F.schema_of_variant(value)
    array = F.exists(F.try_variant_get(value, "$", "array<variant>"), lambda x: (F.schema_of_variant(x) == "STRING") & (F.try_variant_get(x, "$", "string") == lang))
    key = F.map_contains_key(F.try_variant_get(value, "$", "map<string,variant>"), lang)
    found = F.when(kind.startswith("ARRAY"), array).when(kind.startswith("OBJECT"), key).otherwise(F.coalesce(F.try_variant_get(value, "$", "string"), F.col("langs")) == lang)
    return F.coalesce(found, F.lit(False))


def posts_by_lang_recent(posts: DataFrame, lang: str, as_of: str, days: int = 1) -> DataFrame:
    since = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"interval {days} days")
    return posts.filter(has_lang(lang) & (F.col("content_created_at") > since)).agg(F.count("*").alias("n"))


def posts_single_lang(posts: DataFrame, lang: str) -> DataFrame:
    return posts.filter(F.from_json("langs", "array<string>") == F.array(F.lit(lang))).agg(F.count("*").alias("n"))


def new_collections(records: DataFrame, known: list[str], n: int = 20) -> DataFrame:
    return records.filter(~F.col("collection").isin(known)).orderBy("id").limit(n)


def collection_blacklist(df: DataFrame, names: list[str]) -> DataFrame:
    return df.filter(~F.col("collection").isin(names))


def listblock_by_prefix(records: DataFrame, prefix: str, include_deleted: bool = False) -> DataFrame:
    rows = filter_collection(records, LISTBLOCK).filter(json_text("content", "$.subject").startswith(prefix))
    return rows if include_deleted else rows.filter(~F.coalesce("deleted", F.lit(False)))


def listblock_repos(records: DataFrame, owner_did: str) -> DataFrame:
    """Repos that block a list of an owner, exactly; ``sketches`` has the estimate over stored days."""
    return listblock_by_prefix(records, f"at://{owner_did}/").agg(F.countDistinct("repo").alias("n"))


def list_size(listitems: DataFrame, list_uri: str | None = None) -> DataFrame:
    if list_uri is not None:
        return listitems.filter(F.col("list") == list_uri).agg(F.count("*").alias("n"))
    return listitems.groupBy("list").agg(F.count("*").alias("n"))


def record_count_estimate(records: DataFrame) -> DataFrame:
    return records.agg(F.count("*").alias("n"))
