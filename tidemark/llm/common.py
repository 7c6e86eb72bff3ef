"""Shared helpers: the folder all executors see, and lineage cuts through it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    On a cluster the setting names storage that every executor sees. Where it
    is unset (tests on one machine) a local temporary folder stands in.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tidemark-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "cut", **options) -> DataFrame:
    """Write ``df`` to the shared folder (with the writer's ``options``) and read it back.

    The returned frame starts from files, so a lost executor never makes Spark
    repeat what led to it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}"
    df.write.options(compression="zstd", **options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def apart(docs: DataFrame, *needed: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with names of its own for all but the ``needed`` columns, and the columns that give the old names back.

    What an operator adds can then clash with no column that passes through it.
    """
    names = {c: c if c in needed else f"column_{i}_of_docs" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), [F.col(n).alias(c) for c, n in names.items()]


def in_parts(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches of a task in parts of at most so many rows, so that what it makes of one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
