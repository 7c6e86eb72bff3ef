"""Numbered manifests: readers follow the highest one, writers add the next.

A manifest is a small JSON file that says which folders are the table now. What
it names is never changed in place, so a reader that has read one sees one
state, and a writer that dies leaves only folders that no manifest names.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import SparkSession

from .files import create_text, delete, names, read_text

PREFIX = "manifest-"


def numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n[len(PREFIX) : -5]) for n in names(spark, f"{path}/manifests") if n.startswith(PREFIX) and n.endswith(".json"))


def load(spark: SparkSession, path: str, number: int) -> dict:
    return json.loads(read_text(spark, f"{path}/manifests/{PREFIX}{number:012d}.json"))


def current(spark: SparkSession, path: str) -> dict | None:
    found = numbers(spark, path)
    return load(spark, path, found[-1]) if found else None


def change(spark: SparkSession, path: str, step: Callable[[dict | None], dict]) -> dict:
    """Adds ``step`` of the current manifest as the next one; where another writer was first, ``step`` is made again from what it wrote."""
    while True:
        found = numbers(spark, path)
        state = step(load(spark, path, found[-1]) if found else None)
        if create_text(spark, f"{path}/manifests/{PREFIX}{(found[-1] + 1 if found else 0):012d}.json", json.dumps(state)):
            return state


def forget(spark: SparkSession, path: str, folders: Callable[[dict], set[str]], keep: int) -> None:
    """Deletes all manifests but the last ``keep``, and folders that none of those names. Readers of older states and unfinished writers must be gone."""
    found = numbers(spark, path)
    named = set().union(*(folders(load(spark, path, n)) for n in found[-keep:]))
    for n in found[:-keep]:
        delete(spark, f"{path}/manifests/{PREFIX}{n:012d}.json")
    for name in names(spark, path):
        if name != "manifests" and name not in named:
            delete(spark, f"{path}/{name}")
