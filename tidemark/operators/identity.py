"""The identity log: normal form of operations, current state of accounts, handles, hosts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import is_unset, json_text, normal_host
from .state import ALLOWED, allowed

SERVICES = "map<string,struct<type:string,endpoint:string>>"


def plc_normalise(log: DataFrame) -> DataFrame:
    """Adds kind, handle_uri, endpoint and key; legacy ``create`` operations in their modern meaning, unknown types with kind 'unknown'."""
    op, kind = "operation", json_text("operation", "$.type")
    services = F.from_json(json_text(op, "$.services"), SERVICES)
    hosts = F.filter(F.map_values(services), lambda s: s["type"] == "AtprotoPersonalDataServer")
    endpoint = F.when(kind == "create", json_text(op, "$.service")).when(kind == "plc_operation", F.try_element_at(hosts, F.lit(-1))["endpoint"])
    key = F.when(kind == "create", json_text(op, "$.signingKey")).when(kind == "plc_operation", json_text(op, "$.verificationMethods.atproto"))
    handle = F.when(kind == "create", F.concat(F.lit("at://"), json_text(op, "$.handle"))).when(kind == "plc_operation", json_text(op, "$.alsoKnownAs[0]"))
    known = F.when(kind.isin("create", "plc_operation", "plc_tombstone"), kind).otherwise("unknown")
    return log.withColumns({"kind": known, "handle_uri": handle, "endpoint": endpoint, "key": key})


def _latest(log: DataFrame) -> DataFrame:
    """Times of the newest operation of each DID that counts."""
    return log.filter(~F.col("nullified")).groupBy("did").agg(F.max("plc_timestamp").alias("plc_timestamp"))


def plc_current(log: DataFrame) -> DataFrame:
    """Endpoint and key of each DID by its newest operation; without either, no row. Of equal times the smallest text counts."""
    newest = log.filter(~F.col("nullified")).groupBy("did").agg(F.min_by("operation", F.struct((-F.unix_micros(F.col("plc_timestamp").cast("timestamp"))).alias("t"), "operation")).alias("operation"))
    rows = plc_normalise(newest)
    return rows.filter(~is_unset(F.col("endpoint")) & ~is_unset(F.col("key"))).select("did", "endpoint", "key", F.replace("handle_uri", F.lit("at://"), F.lit("")).alias("handle"))


def handles(log: DataFrame) -> DataFrame:
    """DID and handle of all operations at each DID's newest time, ties and nullified ones at that time included."""
    return log.join(_latest(log), ["did", "plc_timestamp"], "left_semi").select("did", F.replace(json_text("operation", "$.alsoKnownAs[0]"), F.lit("at://"), F.lit("")).alias("handle"))


def discover_hosts(dids: DataFrame, identity: DataFrame, pds: DataFrame, patterns: list[str] | None = None) -> DataFrame:
    """Hosts of the DIDs that are allowed and not known yet."""
    found = dids.join(identity, "did").select(normal_host(F.col("endpoint")).alias("host")).filter(allowed(F.col("host"), patterns or ALLOWED)).distinct()
    return found.join(pds.select(normal_host(F.col("host")).alias("host")), "host", "left_anti")


def key_refresh(repos: DataFrame, identity: DataFrame) -> DataFrame:
    """``repos`` with ``last_known_key`` from the identity log where it is empty or differs."""
    known = repos.join(identity.select("did", F.col("key").alias("_key")), "did", "left")
    stale = F.col("_key").isNotNull() & (is_unset(F.col("last_known_key")) | (F.col("last_known_key") != F.col("_key")))
    return known.withColumn("last_known_key", F.when(stale, F.col("_key")).otherwise(F.col("last_known_key"))).drop("_key")
