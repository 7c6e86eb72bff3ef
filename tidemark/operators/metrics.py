"""Counters, gauges and histograms as aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import json_text, normal_error, rfc3339

KIB, MIB = 1 << 10, 1 << 20
#: Upper bounds of archive sizes: 100 to 900 KiB, 1 to 9 MiB, 10 to 55 MiB.
SIZE_BOUNDS = [i * 100 * KIB for i in range(1, 10)] + [i * MIB for i in range(1, 10)] + [i * MIB for i in range(10, 60, 5)]
LARGE = 20 * MIB


def events_by_type(events: DataFrame) -> DataFrame:
    return events.groupBy("pds", "type").agg(F.count("*").alias("n"))


def posts_by_language(posts: DataFrame) -> DataFrame:
    """One count for each listed language of a post with a valid RFC 3339 ``createdAt``; ``posts`` has pds and content."""
    valid = posts.filter((json_text("content", "$['$type']") == "app.bsky.feed.post") & rfc3339(json_text("content", "$.createdAt")).isNotNull())
    langs = F.from_json(json_text("content", "$.langs"), "array<string>")
    return valid.select("pds", F.explode(langs).alias("lang")).groupBy("pds", "lang").agg(F.count("*").alias("n"))


def stream_lag(events: DataFrame) -> DataFrame:
    return events.groupBy("pds").agg(F.max("time").alias("newest"))


def repos_discovered(new: DataFrame) -> DataFrame:
    return new.groupBy("pds").agg(F.count("*").alias("n"))


def repos_listed(listing: DataFrame) -> DataFrame:
    return listing.groupBy("pds").agg(F.count("*").alias("n"))


def index_outcomes(attempts: DataFrame) -> DataFrame:
    """``attempts``: pds, ok, fetched, inserted."""
    return attempts.groupBy("pds").agg(F.count_if("ok").alias("succeeded"), F.count_if(~F.col("ok")).alias("failed"), F.sum(F.when(F.col("ok"), F.col("fetched")).otherwise(0)).alias("records_fetched"), F.sum(F.when(F.col("ok"), F.col("inserted")).otherwise(0)).alias("records_inserted"))


def fetch_size_histogram(sizes: DataFrame, bounds: list[int] = SIZE_BOUNDS) -> DataFrame:
    """Cumulative counts for each bound and for all sizes (le null). One pass: a row only adds to its own bucket."""
    spark = sizes.sparkSession
    table = F.array(*(F.lit(b).cast("long") for b in bounds))
    own = sizes.select(F.array_min(F.filter(table, lambda b: b >= F.col("size"))).alias("le")).groupBy("le").agg(F.count("*").alias("own"))
    edges = spark.createDataFrame([(b,) for b in bounds] + [(None,)], "le long")
    counted = own.join(edges, own["le"].eqNullSafe(edges["le"]), "right").select(edges["le"], F.coalesce("own", F.lit(0)).alias("own"))
    from pyspark.sql import Window

    return counted.select("le", F.sum("own").over(Window.orderBy(F.asc_nulls_last("le"))).alias("n"))


def large_archives(sizes: DataFrame, limit: int = LARGE) -> DataFrame:
    return sizes.agg(F.count_if(F.col("size") > limit).alias("n"))


def bad_record_summary(bad: DataFrame, pds: DataFrame) -> DataFrame:
    """Dead letters per host and normalised error; grouped by host number before the join."""
    counts = bad.groupBy("pds", normal_error(F.col("error")).alias("error")).agg(F.count("*").alias("n"))
    return join_bad_pds(counts, pds).groupBy("host", "error").agg(F.sum("n").alias("n"))


def join_bad_pds(bad: DataFrame, pds: DataFrame) -> DataFrame:
    return bad.join(pds.select(F.col("id").alias("pds"), "host"), "pds")


def bad_quota(bad: DataFrame, cap: int = 500) -> DataFrame:
    return bad.groupBy("pds").agg(F.count("*").alias("n")).withColumn("over", F.col("n") >= cap)
