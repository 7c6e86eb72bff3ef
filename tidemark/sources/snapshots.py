"""Materialised views as whole snapshots: a refresh writes a new folder, and readers follow a manifest to the last one.

A reader that holds a snapshot keeps its files until ``release_old``; a refresh
that fails leaves the readers where they were.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from . import manifest
from .files import delete


def refresh(df: DataFrame, path: str, kind: str = "parquet", **options) -> DataFrame:
    spark, folder = df.sparkSession, f"snapshot-{uuid.uuid4().hex}"
    df.write.format(kind).options(**options).save(f"{path}/{folder}")
    manifest.change(spark, path, lambda state: {"folder": folder, "format": kind, "options": options})
    return snapshot(spark, path)


def snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The last whole snapshot."""
    state = manifest.current(spark, path)
    if state is None:
        raise FileNotFoundError(f"{path} has no snapshot")
    return spark.read.format(state["format"]).options(**state["options"]).load(f"{path}/{state['folder']}")


def release_old(spark: SparkSession, path: str, keep: int = 1) -> None:
    manifest.forget(spark, path, lambda s: {s["folder"]}, keep)


def release(spark: SparkSession, path: str) -> None:
    """Deletes the view with all its snapshots."""
    delete(spark, path)
