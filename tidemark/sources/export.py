"""Sinks: CSV exports for graph tools, table layouts, dumps and the export log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bucketed
from .snapshots import refresh

#: Partition of each collection; the rest goes to "default" (fixed values).
PARTS = {
    "app.bsky.feed.like": "like", "app.bsky.feed.post": "post", "app.bsky.graph.follow": "follow", "app.bsky.graph.block": "block", "app.bsky.feed.repost": "repost",
    "app.bsky.actor.profile": "profile", "app.bsky.graph.list": "list", "app.bsky.graph.listblock": "listblock", "app.bsky.graph.listitem": "listitem",
}


def tables(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}


def edge_columns(edges: DataFrame) -> DataFrame:
    """Column names that graph import tools expect."""
    names = {"src": ":START_ID", "dst": ":END_ID", "count": "count:long", "did": "did:ID"}
    return edges.withColumnsRenamed({k: v for k, v in names.items() if k in edges.columns})


def export_csv(df: DataFrame, path: str) -> None:
    edge_columns(df).write.mode("overwrite").option("header", True).csv(path)


def export_handles(df: DataFrame, path: str) -> None:
    """Quoted; a trailing backslash of a handle is doubled."""
    df.withColumn("handle", F.regexp_replace("handle", r"\\$", r"\\\\")).write.mode("overwrite").options(header=True, quoteAll=True, escape='"').csv(path)


def export_marker(spark: SparkSession, path: str, ts: str) -> None:
    """The start of an export, as a snapshot: the marker before it stays until this one is whole."""
    refresh(spark.createDataFrame([(ts,)], "export_start string"), path, "csv", header=True)


def run_log(starts: DataFrame, finishes: DataFrame) -> DataFrame:
    """One row per collection and export time from start and finish events."""
    both = starts.select("collection", "to_tsmp", F.col("at").alias("started"), F.lit(None).cast("timestamp").alias("finished")).unionByName(finishes.select("collection", "to_tsmp", F.lit(None).cast("timestamp").alias("started"), F.col("at").alias("finished")))
    return both.groupBy("collection", "to_tsmp").agg(F.min("started").alias("started"), F.max("finished").alias("finished"))


def with_part(records: DataFrame) -> DataFrame:
    pairs = F.create_map(*(F.lit(x) for kv in PARTS.items() for x in kv))
    return records.withColumn("part", F.coalesce(F.element_at(pairs, F.col("collection")), F.lit("default")))


def write_by_collection(records: DataFrame, path: str) -> None:
    """Partitions by collection; rows are dealt by collection and key first, so that large collections spread over tasks."""
    dealt = with_part(records).repartition("part", F.pmod(F.hash("rkey"), F.lit(32)))
    dealt.write.mode("overwrite").partitionBy("part").parquet(path)


def write_by_repo(records: DataFrame, path: str, n: int = 16) -> DataFrame:
    """Hash buckets by repo; see ``bucketed``."""
    return bucketed.write(records, path, n)


def repartition_collections(df: DataFrame, path: str, names: dict[str, str]) -> None:
    """Moves collections into partitions of their own; only partitions that rows leave or join are written, and those left empty go."""
    pairs = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    to = F.coalesce(F.element_at(pairs, F.col("collection")), F.col("part"))
    left = [r["part"] for r in df.filter(to != F.col("part")).select("part").distinct().collect()]  # partitions, not rows
    moved = df.withColumn("part", to)
    touched = moved.filter(F.col("part").isin(*names.values(), *left))
    filled = {r["part"] for r in touched.select("part").distinct().collect()}
    touched.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)
    jvm = df.sparkSession._jvm
    for part in set(left) - filled:
        folder = jvm.org.apache.hadoop.fs.Path(path, f"part={part}")
        folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def dump(df: DataFrame, path: str, codec: str = "zstd") -> None:
    df.write.mode("overwrite").option("compression", codec).parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
