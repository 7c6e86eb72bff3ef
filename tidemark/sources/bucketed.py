"""Records in hash buckets by repo that joins and groupings use as they lie.

Spark's own buckets: a join or a grouping on the repo, or on keys that begin
with it, reads each bucket in its place and shuffles only the other side. A
small file beside the table says how it is cut, so that any session can open it.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from .files import create_text, read_text

SORTED = ("repo", "collection", "rkey", "at_rev")
#: So many repos may be named in a filter, which then skips whole buckets.
NAMED = 10_000


def write(df: DataFrame, path: str, buckets: int = 16, key: str = "repo") -> DataFrame:
    """Writes a new table, a file for each bucket, sorted by the key of a record's versions."""
    spark, order = df.sparkSession, [c for c in SORTED if c in df.columns]
    name = f"tidemark_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(*order).format("parquet").option("path", f"{path}/data").saveAsTable(name)
    create_text(spark, f"{path}/buckets.json", json.dumps({"buckets": buckets, "key": key, "sorted": order, "schema": df.schema.jsonValue()}))
    return _ready(spark, name)


def open_table(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``write`` has left at ``path``, in any session."""
    spec = json.loads(read_text(spark, f"{path}/buckets.json"))
    name = f"tidemark_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(spec["schema"]))
    spark.sql(f"create table {name} ({columns}) using parquet clustered by ({spec['key']}) sorted by ({', '.join(spec['sorted'])}) into {spec['buckets']} buckets location '{path}/data'")
    return _ready(spark, name)


def _ready(spark: SparkSession, name: str) -> DataFrame:
    """A bucket holds whole repos, so a join on longer keys may take it as it lies; Spark asks for leave because few distinct repos would give few tasks."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return spark.table(name)


def of_repos(versions: DataFrame, repos: DataFrame, named: int = NAMED) -> DataFrame:
    """Versions of the repos of another frame. If these are few, buckets without them are not read; else it is a semi-join in place."""
    wanted = repos.select("repo").filter("repo is not null").distinct()
    some = [r["repo"] for r in wanted.limit(named + 1).collect()]
    return versions.filter(F.col("repo").isin(some)) if len(some) <= named else versions.join(wanted, "repo", "left_semi")
