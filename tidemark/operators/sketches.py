"""Distinct counts from stored sketches: made once for each day, merged over any days without reading a record."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import json_text, uri_did
from .edges import filter_collection
from .views import LISTBLOCK

#: Logarithm of a sketch's registers: a standard error of 0.8 %, 16 KB at most.
REGISTERS = 14


def listblock_sketches(records: DataFrame) -> DataFrame:
    """For each list owner and day, a sketch of the repos that block a list of theirs; sums of a day's parts are merged in the map."""
    live = filter_collection(records, LISTBLOCK).filter(~F.coalesce("deleted", F.lit(False)))
    named = live.select(uri_did(json_text("content", "$.subject")).alias("owner"), F.col("created_at").cast("date").alias("day"), "repo").filter("owner <> ''")
    return named.groupBy("owner", "day").agg(F.hll_sketch_agg("repo", REGISTERS).alias("repos"))


def merged_counts(sketches: DataFrame, since: str | None = None, until: str | None = None, owner: str | None = None) -> DataFrame:
    """Estimated distinct repos of each owner over the days from ``since`` to before ``until``."""
    days = sketches
    for bound, test in ((since, F.col("day") >= F.lit(since).cast("date")), (until, F.col("day") < F.lit(until).cast("date")), (owner, F.col("owner") == F.lit(owner))):
        days = days.filter(test) if bound is not None else days
    return days.groupBy("owner").agg(F.hll_sketch_estimate(F.hll_union_agg("repos")).alias("n"))
