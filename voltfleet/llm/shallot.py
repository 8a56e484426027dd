"""Exact k-means on whole numbers, with the Shallot search for the nearest centroid.

Between rounds a vector keeps its centroid, its second-nearest centroid, an upper bound of the
distance to the first and a lower bound of the distance to all others. A round moves the bounds by
how far centroids went. Where the upper bound is below the lower one, or below half the way
to the next centroid, nothing else is looked at. Else the search starts from whichever of the
two remembered centroids is now closer and goes through that one's neighbours in order of
distance: no centroid outside the ball around it, with the vector's distances to it and to
the second best so far as radius, can matter. The ball shrinks whenever a closer one is found.
Survivors are compared by squared distances in 64-bit integers, so results are exact; bounds are
floats, widened by ``SLACK``, and only ever decide that a comparison is not needed.

Vectors stay where Spark put them. A round sends the centroids (k rows) to the tasks and
gets back one row of sums per task and centroid, added up in Spark: k rows reach the driver.
State between rounds is a written table.

Defined results: vectors with a null, non-finite or missing component, or another number of them,
are left out, and so are those with a component of 2 ** 21 or more (a squared distance might not
fit a BIGINT). Ties go to the smaller centroid number. Rows with equal ids are all kept; with fewer
vectors than centroids, there are as many centroids as vectors; of equal hashes the smaller vector
in order of components is the first. An empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..ship import ship
from ..sources.workspace import materialise
from .frames import table

SIZE, CENTROIDS, ROUNDS, SCALE = 64, 16, 3, 64
LIMIT = 2**21
#: Share by which float bounds are widened, far above their rounding errors.
SLACK = 1e-9


def whole_vectors(rows: DataFrame, column: str = "embedding", size: int = SIZE) -> DataFrame:
    """Rows with a full vector, as whole numbers in ``v``: floor(SCALE * x), x as double."""
    x = f"CAST(`{column}` AS ARRAY<DOUBLE>)"
    known = f"size({x}) = {size} AND forall({x}, x -> coalesce(abs(x) < {LIMIT}, false))"
    kept = rows.filter(F.expr(f"coalesce({known}, false)"))
    return kept.withColumn("v", F.expr(f"transform({x}, x -> CAST(floor({SCALE}D * x) AS INT))"))


@dataclass
class Centroids:
    """Centroids of a round, how far each came, and each one's neighbours in order of distance."""

    at: np.ndarray
    moved: np.ndarray

    def __post_init__(self):
        gap = self.at[:, None, :] - self.at[None, :, :]
        self.apart = np.sqrt((gap * gap).sum(axis=2).astype(np.float64))
        self.order = np.argsort(self.apart, axis=1, kind="stable")
        # A centroid comes first among its neighbours, also where another one lies on top of it.
        for k, row in enumerate(self.order):
            self.order[k] = np.concatenate([[k], row[row != k]])
        self.sorted = np.take_along_axis(self.apart, self.order, axis=1) * (1 - SLACK)
        self.half = self.sorted[:, 1] / 2 if len(self.at) > 1 else np.full(1, np.inf)


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    gap = v - c
    return np.einsum("ij,ij->i", gap, gap)


@dataclass
class State:
    """Of every vector: nearest and second-nearest centroid, and bounds of the distances."""

    first: np.ndarray
    second: np.ndarray
    upper: np.ndarray
    lower: np.ndarray

    def take(self, rows: np.ndarray) -> State:
        return State(self.first[rows], self.second[rows], self.upper[rows], self.lower[rows])


def begin(n: int) -> State:
    """Nothing is known: no bound holds a search back."""
    return State(np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, np.inf), np.zeros(n))


def carry(state: State, centroids: Centroids) -> State:
    """The bounds after the centroids moved."""
    moved = centroids.moved
    if not len(moved) or not moved.any():
        return state
    far = moved.copy()
    most = int(far.argmax())
    far[most] = -1.0
    other = np.where(state.first == most, max(far.max(), 0.0), moved[most])
    return State(
        state.first, state.second, (state.upper + moved[state.first]) * (1 + SLACK), np.maximum(0.0, (state.lower - other) * (1 - SLACK) - SLACK)
    )


def search(v: np.ndarray, state: State, centroids: Centroids) -> tuple[State, int]:
    """Nearest centroids of whole-number vectors, and how many distances it took."""
    at, k = centroids.at, len(centroids.at)
    state = carry(state, centroids)
    state = State(state.first.copy(), state.second.copy(), state.upper.copy(), state.lower.copy())
    if k == 1:
        return State(state.first * 0, state.second * 0, np.sqrt(squared(v, at[state.first * 0]).astype(float)), state.lower), len(v)
    settled = np.maximum(state.lower, centroids.half[state.first])
    open_ = np.flatnonzero(state.upper >= settled)
    distances = len(open_)
    # One exact distance may already be enough.
    own = squared(v[open_], at[state.first[open_]])
    state.upper[open_] = np.sqrt(own.astype(np.float64)) * (1 + SLACK)
    still = state.upper[open_] >= settled[open_]
    open_, own = open_[still], own[still]
    if not len(open_):
        return state, distances
    near, next_ = state.first[open_], state.second[open_]
    next_ = np.where(next_ == near, centroids.order[near, 1], next_)
    x = v[open_]
    other = squared(x, at[next_])
    distances += len(open_)
    # The search starts from the closer one of the two, ties by number.
    swap = (other < own) | ((other == own) & (next_ < near))
    best, best_at = np.where(swap, other, own), np.where(swap, next_, near)
    runner, runner_at = np.where(swap, own, other), np.where(swap, near, next_)
    start, known = best_at.copy(), runner_at.copy()
    reach = np.sqrt(best.astype(np.float64))
    rows = np.arange(len(open_))
    for place in range(1, k):
        # The ball: what is nearer than the second best lies within both distances of the start.
        ball = (reach[rows] + np.sqrt(runner[rows].astype(np.float64))) * (1 + SLACK)
        rows = rows[centroids.sorted[start[rows], place] <= ball]
        if not len(rows):
            break
        candidate = centroids.order[start[rows], place]
        new = candidate != known[rows]
        mine, candidate = rows[new], candidate[new]
        d = squared(x[mine], at[candidate])
        distances += len(mine)
        nearer = (d < best[mine]) | ((d == best[mine]) & (candidate < best_at[mine]))
        behind = ~nearer & (d < runner[mine])
        a, b = mine[nearer], mine[behind]
        runner[a], runner_at[a] = best[a], best_at[a]
        best[a], best_at[a] = d[nearer], candidate[nearer]
        runner[b], runner_at[b] = d[behind], candidate[behind]
    state.first[open_], state.second[open_] = best_at, runner_at
    state.upper[open_] = np.sqrt(best.astype(np.float64)) * (1 + SLACK)
    state.lower[open_] = np.sqrt(runner.astype(np.float64)) * (1 - SLACK)
    return state, distances


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


_STATE = "first int, second int, upper double, lower double"


def _state(batch: pa.RecordBatch) -> State:
    first, second, upper, lower = (batch[c].to_numpy(zero_copy_only=False) for c in ("first", "second", "upper", "lower"))
    return State(first.astype(np.int64), second.astype(np.int64), upper, lower)


def assign(vectors: DataFrame, centroids: Centroids, exact: bool = False) -> DataFrame:
    """vec_id, v and the state after one more search; with ``exact`` also squared distances."""
    size = centroids.at.shape[1]
    names = ["vec_id", "v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = matrix(batch["v"], size)
            before = _state(batch) if "first" in batch.schema.names else begin(len(v))
            found, _ = search(v, before, centroids)
            columns = [batch[c] for c in names]
            columns += [pa.array(found.first, pa.int32()), pa.array(found.second, pa.int32()), pa.array(found.upper), pa.array(found.lower)]
            labels = [*names, "first", "second", "upper", "lower"]
            if exact:
                columns.append(pa.array(squared(v, centroids.at[found.first])))
                labels.append("distance")
            yield pa.RecordBatch.from_arrays(columns, labels)

    ship(vectors.sparkSession)
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.select(*names).schema)
    return vectors.mapInArrow(run, f"{own}, {_STATE}" + (", distance long" if exact else ""))


def _sums(assigned: DataFrame, size: int) -> dict[int, tuple[int, list[int]]]:
    """Per centroid its number of vectors and the exact sums of their components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[int, int] = {}
        total: dict[int, list[int]] = {}
        for batch in batches:
            v, own = matrix(batch["v"], size), batch["first"].to_numpy(zero_copy_only=False)
            for k in np.unique(own).tolist():
                part = v[own == k]
                n[k] = n.get(k, 0) + len(part)
                total[k] = (np.array(total.get(k, [0] * size), object) + part.sum(axis=0)).tolist()
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(n), pa.int32()), pa.array(list(n.values()), pa.int64()), pa.array(list(total.values()), pa.list_(pa.int64()))],
                ["first", "n", "total"],
            )

    parts = assigned.select("v", "first").mapInArrow(run, "first int, n long, total array<long>")
    each = [f"CAST(sum(CAST(total[{i}] AS DECIMAL(19, 0))) AS DECIMAL(38, 0)) AS t{i}" for i in range(size)]
    rows = parts.groupBy("first").agg(F.expr("sum(n) AS n"), *[F.expr(e) for e in each]).collect()  # one a centroid
    return {r["first"]: (r["n"], [int(r[f"t{i}"]) for i in range(size)]) for r in rows}


def seeds(vectors: DataFrame, count: int, salt: str) -> np.ndarray:
    """Vectors of the ids with the smallest hashes: ``count`` rows reach the driver."""
    hashed = vectors.select(F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")).cast("binary"), 256).alias("h"), "v")
    first = hashed.orderBy(F.expr("h IS NULL"), "h", "v").limit(count).collect()
    return np.array([r["v"] for r in first], np.int64)


def cluster(vectors: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS, salt: str = "1:") -> tuple[DataFrame, np.ndarray]:
    """vec_id and v with ``first`` (the centroid) and ``distance`` (squared), and the final centroids."""
    vectors = materialise(vectors.select("vec_id", "v"), "vectors")
    at = seeds(vectors, count, salt)
    if not len(at):
        return assign(vectors, Centroids(np.zeros((1, SIZE), np.int64), np.zeros(1)), exact=True), at
    now, centroids = vectors, Centroids(at, np.zeros(len(at)))
    for _ in range(rounds):
        now = materialise(assign(now, centroids), "assigned")
        after = centroids.at.copy()
        for k, (n, total) in _sums(now, at.shape[1]).items():
            after[k] = [t // n for t in total]
        moved = np.sqrt(squared(after, centroids.at).astype(np.float64)) * (1 + SLACK)
        centroids = Centroids(after, moved)
    return assign(now, centroids, exact=True), centroids.at


def op12_centroids(spark, sf_dir: str) -> DataFrame:
    vectors = whole_vectors(table(spark, sf_dir, "embeddings")).select("vec_id", "v")
    found, centroids = cluster(vectors)
    found = materialise(found.select("vec_id", "first", "distance"), "clusters")
    final = [(k, ",".join(map(str, c))) for k, c in enumerate(centroids.tolist())]
    final = spark.createDataFrame(final, "first int, line string")  # one row a centroid
    total = F.expr("try_cast(sum(CAST(distance AS DECIMAL(19, 0))) AS BIGINT)")
    inertia = found.groupBy("first").agg(F.expr("sum(CAST(distance AS DECIMAL(19, 0)))").alias("own"))
    # One row a centroid, so the window over all of them is as small.
    inertia = inertia.join(final, "first").selectExpr(
        "first",
        "try_cast(own AS BIGINT) AS cluster_inertia",
        "try_cast(sum(own) OVER () AS BIGINT) AS inertia",
        "sha2(CAST(line AS BINARY), 256) AS centroid_sha256",
    )
    joined = found.join(F.broadcast(inertia), "first")
    return joined.selectExpr("vec_id", "first AS cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle() -> str:
    steps = [
        f"""kept AS (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings WHERE len(embedding) = {SIZE} AND len(list_filter(embedding, lambda x: coalesce(isfinite(x) AND abs(x) < {LIMIT}, false))) = {SIZE})""",
        f"""c0 AS (SELECT CAST(row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS INTEGER) AS k, v AS c FROM
        (SELECT sha256('1:' || vec_id) AS h, v FROM kept ORDER BY h NULLS LAST, v LIMIT {CENTROIDS}))""",
    ]
    for r in range(ROUNDS + 1):
        steps.append(
            f"""a{r} AS (SELECT id, any_value(vec_id) AS vec_id, any_value(v) AS v, arg_min(k, (d, k)) AS k, min(d) AS d FROM
            (SELECT id, vec_id, v, k, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
            FROM kept, c{r}) GROUP BY id)"""
        )
        if r < ROUNDS:
            mean = "CAST(sum(x) AS HUGEINT)"
            floor_ = f"CASE WHEN {mean} % count(*) < 0 THEN {mean} // count(*) - 1 ELSE {mean} // count(*) END"
            steps.append(
                f"""m{r} AS (SELECT k, list(m ORDER BY i) AS c FROM (SELECT k, i, CAST({floor_} AS BIGINT) AS m FROM
                (SELECT k, unnest(v) AS x, unnest(range({SIZE})) AS i FROM a{r}) GROUP BY k, i) GROUP BY k)"""
            )
            steps.append(f"c{r + 1} AS (SELECT c{r}.k, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} ON c{r}.k = m{r}.k)")
    last = ROUNDS
    return f"""WITH {", ".join(steps)} SELECT vec_id, k AS cluster, CAST(d AS BIGINT) AS distance,
        CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
        sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{last} JOIN c{last} USING (k)"""


ORACLE = oracle()
