"""Exact k-means over integer vectors; an n-simplex projection filters the centroids that a vector is compared with.

A few pivots form a simplex. A vector's distances to them, kept with the vector
in the shared folder, fix an apex over that simplex: coordinates in the pivots'
flat and a height. For two apexes the Euclidean distance is a lower bound of
the vectors' distance, and with one height negated an upper bound. A centroid
whose lower bound lies above the smallest upper bound can't be nearest; the
others are compared exactly, in 64-bit integers. The bounds carry a margin far
above the rounding of doubles, so the result never depends on them.

A round is one scan of the stored table: each task gives one partial sum for
each centroid; the driver sees ``k`` times ``dims`` sums, whatever the rows.

Cases: vectors that are null, of another length, or have a null or non-finite
component are left out, as the contract has it; a component beyond 2**27 in
1,024ths fails the job, as its squares may leave 64 bits; a null id is hashed
last; rows that repeat an id are vectors of their own, in order of their
components; with fewer vectors than ``k`` there are as many centroids as
vectors; equal distances go to the smaller number; a centroid without vectors
stays; an empty table gives an empty table; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import cut

SCALE, MOST = 1024, 1 << 27
#: Pivots, and the vectors that they are chosen among.
PIVOTS, CANDIDATES = 12, 64
#: Margin of the bounds, as a share of the squared lengths that they come from.
MARGIN = 1e-7
ROWS = 4096
KEPT = "vec_id long, x array<long>"


def integers(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors that are kept, and their components in whole 1,024ths."""
    at = np.flatnonzero(pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False) == dims)
    values = pc.fill_null(column.take(pa.array(at)).flatten(), np.nan).to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    good = np.isfinite(values).all(axis=1)
    whole = np.floor(SCALE * values[good])
    if np.abs(whole).max(initial=0) > MOST:
        raise ValueError(f"a component lies beyond {MOST // SCALE}")
    return at[good], whole.astype(np.int64)


def arrays(x: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def keep(vectors: DataFrame, id_col: str, vec_col: str, dims: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            at, x = integers(batch.column(1), dims)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), arrays(x)], names=["vec_id", "x"])

    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("x")).mapInArrow(run, KEPT)


def first_by_hash(kept: DataFrame, salt: int, n: int) -> np.ndarray:
    """The ``n`` vectors with the smallest SHA-256 of ``salt:id``, in that order; rows of one hash by their components."""
    order = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = kept.orderBy(order.asc_nulls_last(), "x").limit(n).select("x").collect()
    return np.array([r["x"] for r in rows], np.int64)


class Simplex:
    """Pivots and the coordinates of their simplex: pivot ``i`` has ``i`` coordinates, the last of them its height over those before it."""

    def __init__(self, candidates: np.ndarray, most: int):
        self.pivots, self.at = candidates[:1], np.zeros((1, 0))
        while len(self.pivots) < min(most, len(candidates)):
            apex = self.apexes(candidates)
            best = int(apex[:, -1].argmax())
            if apex[best, -1] ** 2 <= 1e-6 * max(1.0, float((apex**2).sum(axis=1).max())):
                break  # all candidates lie in the pivots' flat
            self.at = np.vstack([np.pad(self.at, ((0, 0), (0, 1))), apex[best]])
            self.pivots = np.vstack([self.pivots, candidates[best]])

    def apexes(self, x: np.ndarray) -> np.ndarray:
        """For each vector its coordinates in the pivots' flat and, last, its height over it."""
        square = squares(x, self.pivots).astype(np.float64)
        right = (square[:, :1] - square[:, 1:] + (self.at[1:] ** 2).sum(axis=1)) / 2
        flat = np.linalg.solve(self.at[1:], right.T).T if len(self.at) > 1 else right
        height = np.sqrt(np.maximum(0, square[:, 0] - (flat**2).sum(axis=1)))
        return np.column_stack([flat, height])


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all vectors of ``x`` to the few of ``y``."""
    return np.stack([((x - c) ** 2).sum(axis=1) for c in y], axis=1) if len(y) else np.zeros((len(x), 0), np.int64)


def open_pairs(apex: np.ndarray, tops: np.ndarray) -> np.ndarray:
    """Which centroids (apexes ``tops``) may be nearest to which vectors."""
    length = (apex**2).sum(axis=1)[:, None] + (tops**2).sum(axis=1)
    flat, heights = apex[:, :-1] @ tops[:, :-1].T, np.outer(apex[:, -1], tops[:, -1])
    low, high, margin = length - 2 * (flat + heights), length - 2 * (flat - heights), MARGIN * length
    return low - margin <= (high + margin).min(axis=1)[:, None]


def nearest(x: np.ndarray, apex: np.ndarray, centroids: np.ndarray, tops: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each vector its nearest centroid and the squared distance; and how many pairs were compared exactly."""
    row, col = np.nonzero(open_pairs(apex, tops))
    found = np.full((len(x), len(centroids)), np.iinfo(np.int64).max)
    for a in range(0, len(row), ROWS * 8):
        i, j = row[a : a + ROWS * 8], col[a : a + ROWS * 8]
        found[i, j] = ((x[i] - centroids[j]) ** 2).sum(axis=1)
    best = found.argmin(axis=1)
    return best, found[np.arange(len(x)), best], len(row)


def chunks(batches, dims: int, width: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            part = batch.slice(a, ROWS)
            yield part.column(0), matrix(part.column(1), dims), matrix(part.column(2), width)


def _sums(centroids: np.ndarray, tops: np.ndarray):
    def run(batches):
        total, n = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for _, x, apex in chunks(batches, centroids.shape[1], tops.shape[1]):
            best = nearest(x, apex, centroids, tops)[0]
            order = np.argsort(best, kind="stable")
            names, starts = np.unique(best[order], return_index=True)
            total[names] += np.add.reduceat(x[order], starts, axis=0)
            n += np.bincount(best, minlength=len(n))
        some = np.flatnonzero(n)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(n[some]), arrays(total[some])], names=["cluster", "n", "total"])

    return run


def _assigned(centroids: np.ndarray, tops: np.ndarray):
    def run(batches):
        for ids, x, apex in chunks(batches, centroids.shape[1], tops.shape[1]):
            best, square, _ = nearest(x, apex, centroids, tops)
            yield pa.RecordBatch.from_arrays([ids, pa.array(best, pa.int32()), pa.array(square)], names=["vec_id", "cluster", "distance"])

    return run


def moved(stored: DataFrame, centroids: np.ndarray, tops: np.ndarray) -> np.ndarray:
    """The centroids after one round: exact means, rounded down; one without vectors stays."""
    parts = stored.mapInArrow(_sums(centroids, tops), "cluster int, n long, total array<long>")
    sums = parts.select("cluster", "n", F.posexplode("total").alias("dim", "value")).groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum("value").alias("value"))
    out = centroids.copy()
    for r in sums.collect():  # at most k * dims rows
        out[r["cluster"], r["dim"]] = r["value"] // r["n"]
    return out


def centroid_clusters(vectors: DataFrame, k: int = 8, rounds: int = 10, salt: int = 3, dims: int = 64, pivots: int = PIVOTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Rows (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of Lloyd's rounds from the first ``k`` vectors by hash."""
    kept = keep(vectors, id_col, vec_col, dims)
    centroids = first_by_hash(kept, salt, k)
    if not len(centroids):
        return kept.selectExpr("vec_id", "0 as cluster", "0L as distance", "0L as cluster_inertia", "0L as inertia", "'' as centroid_sha256")
    simplex = Simplex(first_by_hash(kept, salt + 1, CANDIDATES), pivots)

    def project(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, arrays(simplex.apexes(matrix(batch.column(1), dims)))], names=["vec_id", "x", "apex"])

    stored = cut(kept.mapInArrow(project, f"{KEPT}, apex array<double>"), "vectors")
    for _ in range(rounds):
        centroids = moved(stored, centroids, simplex.apexes(centroids))
    assigned = cut(stored.mapInArrow(_assigned(centroids, simplex.apexes(centroids)), "vec_id long, cluster int, distance long"), "clusters")
    inertia = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    of = lambda values: F.array(*map(F.lit, values))[F.col("cluster")]
    return assigned.select("vec_id", "cluster", "distance", of([inertia.get(c, 0) for c in range(len(names))]).cast("long").alias("cluster_inertia"), F.lit(sum(inertia.values())).cast("long").alias("inertia"), of(names).alias("centroid_sha256"))


def clusters_sql(k: int = 8, rounds: int = 10, salt: int = 3, dims: int = 64) -> str:
    """DuckDB SQL for the same rows from the table embeddings."""
    square = "list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint"
    near = lambda r: f"a{r} as materialized (select i, vec_id, x, arg_min(n, (d, n)) as n, min(d) as d from (select v.i, v.vec_id, v.x, c.n, {square} as d from v, c{r} c) group by i, vec_id, x)"
    step = lambda r: f"c{r + 1} as materialized (select c.n, coalesce(m.x, c.x) as x from c{r} c left join (select n, list(q order by j) as x from (select n, j, ((sum(e) - ((sum(e) % count(*)) + count(*)) % count(*)) // count(*))::bigint as q from (select n, unnest(x) as e, generate_subscripts(x, 1) as j from a{r}) group by n, j) group by n) m using (n))"
    parts = [f"v as materialized (select row_number() over () as i, vec_id, list_transform(embedding, lambda e: floor({SCALE} * e::double)::bigint) as x from embeddings where len(embedding) = {dims} and len(list_filter(embedding, lambda e: e is not null and isfinite(e))) = {dims})"]
    parts.append(f"c0 as materialized (select (row_number() over (order by sha256('{salt}:' || vec_id) nulls last, x) - 1)::int as n, x from v qualify n < {k})")
    for r in range(rounds):
        parts += [near(r), step(r)]
    parts.append(near(rounds))
    return "with " + ",\n".join(parts) + f"\nselect vec_id, n as cluster, d as distance, (sum(d) over (partition by n))::bigint as cluster_inertia, (sum(d) over ())::bigint as inertia, sha256(array_to_string(c.x, ',')) as centroid_sha256 from a{rounds} join c{rounds} c using (n)"
