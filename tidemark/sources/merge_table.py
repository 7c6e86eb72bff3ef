"""A table of current rows as base files and deltas.

Rows are kept as mergeable parts (``store.current_parts``). Each batch of a
stream adds a delta, compaction folds the deltas into the base. Both are dealt
into buckets by the key, and compaction rewrites only buckets that a delta has
rows in: the manifest names a base folder for each bucket.

Parts are merged by largest and smallest values, so a part that is there twice
changes nothing: a repeated batch adds a delta of rows that are known already.
The stream and a compaction may write at the same time; compaction takes out
the deltas that it has read and leaves later ones.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.store import KEY, PARTS, current_rows, fold_parts
from . import manifest
from .files import names

SCHEMA = PARTS


@dataclass
class MergeTable:
    spark: SparkSession
    path: str
    buckets: int = 64
    #: Tasks that share a bucket when it is written.
    spread: int = 1

    def _state(self) -> dict:
        return manifest.current(self.spark, self.path) or {"buckets": self.buckets, "base": {}, "deltas": {}}

    def _write(self, parts: DataFrame, buckets: int, kind: str) -> tuple[str, list[int]]:
        """Writes parts to a new folder; its name and the buckets that it has."""
        folder = f"{kind}-{uuid.uuid4().hex}"
        bucket = F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("int")
        dealt = parts.to(self.spark.createDataFrame([], SCHEMA).schema).withColumn("bucket", bucket).repartition("bucket", F.pmod(F.xxhash64("rkey"), F.lit(self.spread)))
        dealt.write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
        return folder, [int(n.split("=")[1]) for n in names(self.spark, f"{self.path}/{folder}") if n.startswith("bucket=")]

    def _read(self, folders: dict[str, list[int]]) -> DataFrame:
        paths = [f"{self.path}/{folder}/bucket={b}" for folder, own in sorted(folders.items()) for b in own]
        return self.spark.read.schema(SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMA)

    @staticmethod
    def _by_folder(base: dict[str, str]) -> dict[str, list[int]]:
        out: dict[str, list[int]] = {}
        for bucket, folder in base.items():
            out.setdefault(folder, []).append(int(bucket))
        return out

    def append(self, parts: DataFrame) -> None:
        """Adds the parts as a delta, in the order in which manifests are written."""
        number = self._state()["buckets"]
        folder, own = self._write(parts, number, "delta")

        def step(state):
            state = state or {"buckets": number, "base": {}, "deltas": {}}
            return state | {"deltas": state["deltas"] | {folder: own}}

        manifest.change(self.spark, self.path, step)

    def compact(self) -> list[int]:
        """Folds the deltas of now into the base; the buckets that were rewritten."""
        read = self._state()
        touched = sorted({b for own in read["deltas"].values() for b in own})
        base = {b: f for b, f in read["base"].items() if int(b) in touched}
        folder, own = (None, []) if not touched else self._write(fold_parts(self._read(self._by_folder(base) | read["deltas"])), read["buckets"], "base")

        def step(state):
            if any(state["base"].get(str(b)) != read["base"].get(str(b)) for b in touched):
                raise RuntimeError("another compaction has rewritten a bucket")
            left = {f: b for f, b in state["deltas"].items() if f not in read["deltas"]}
            return state | {"base": state["base"] | {str(b): folder for b in own}, "deltas": left}

        if read["deltas"]:
            manifest.change(self.spark, self.path, step)
        return touched

    def rows(self) -> DataFrame:
        """Current rows. Buckets without deltas are read as they are, only the others are folded."""
        state = self._state()
        touched = {b for own in state["deltas"].values() for b in own}
        still = {b: f for b, f in state["base"].items() if int(b) not in touched}
        open_ = {b: f for b, f in state["base"].items() if int(b) in touched}
        known = self._read(self._by_folder(still))
        return current_rows(known.unionByName(fold_parts(self._read(self._by_folder(open_) | state["deltas"]))) if touched else known)

    def vacuum(self, keep: int = 1) -> None:
        """Deletes what the last ``keep`` states do not need."""
        manifest.forget(self.spark, self.path, lambda s: {*s["base"].values(), *s["deltas"]}, keep)
