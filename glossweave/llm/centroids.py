"""Centroid clustering of integer vectors with a vantage-point tree over the centroids.

Each round builds the tree anew from the centroids, broadcasts it and assigns every vector by best-first branch and
bound. A task returns one count and one sum per centroid, so what is shuffled and collected depends on the number of
centroids and components only. Distances and means are exact integers, ties go to the smaller number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossweave.session import materialise

#: Centroids of a clustering; they are collected and broadcast, a thousand of 64 components take half a megabyte.
MAX_CENTROIDS = 4_096
#: Integer components go up to this magnitude, so that squared distances over 64 components fit a long.
MAX_COMPONENT = 2**27
#: Cells of the table of bounds (vectors of a block x nodes of the tree).
BOUND_CELLS = 2**18
#: Relative slack of bounds, which are doubles; distances themselves are integers.
SLACK = 1e-9


@dataclass(frozen=True)
class VantageTree:
    """Node i holds centroid ``centroid[i]``; ``child[i]`` are its near and far part (-1: none), ``low`` and ``high`` the
    smallest and largest distance of each part from the node's centroid."""

    points: np.ndarray
    centroid: np.ndarray
    child: np.ndarray
    low: np.ndarray
    high: np.ndarray


def squared(points: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows from an integer point."""
    apart = points - point
    return np.einsum("ij,ij->i", apart, apart)


def vantage_tree(points: np.ndarray) -> VantageTree:
    """The tree over the rows of ``points``: a part is split at the median distance from its vantage point."""
    n = len(points)
    child, low, high = np.full((n, 2), -1), np.zeros((n, 2)), np.zeros((n, 2))
    centroid = np.zeros(n, dtype=np.int64)
    made = 0
    todo = [(np.arange(n), -1, 0)] if n else []
    while todo:
        members, parent, side = todo.pop()
        # The member farthest from the first one: a corner of the part separates the others best.
        at = int(squared(points[members], points[members[0]]).argmax())
        vantage, rest = members[at], np.delete(members, at)
        node, made = made, made + 1
        centroid[node] = vantage
        if parent >= 0:
            child[parent, side] = node
        if not len(rest):
            continue
        away = np.sqrt(squared(points[rest], points[vantage]).astype(np.float64))
        near = away <= np.median(away)
        for number, part in enumerate((near, ~near)):
            if part.any():
                low[node, number], high[node, number] = away[part].min(), away[part].max()
                todo.append((rest[part], node, number))
    return VantageTree(points, centroid, child, low, high)


def nearest(tree: VantageTree, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of each vector's nearest centroid, the smallest number of equal ones.

    Each vector opens the node of its smallest bound next, and is done when that bound exceeds its best distance; a
    bound equal to it is still opened, since it may hide a tie with a smaller number. Vectors advance in blocks: one
    step opens one node for each vector of the block that is not done.
    """
    n, nodes = len(vectors), len(tree.centroid)
    who, best = np.full(n, nodes, dtype=np.int64), np.full(n, np.iinfo(np.int64).max)
    block = max(1, BOUND_CELLS // max(1, nodes))
    for start in range(0, n, block):
        part = slice(start, min(n, start + block))
        _nearest_block(tree, vectors[part], who[part], best[part])
    return who, best


def _nearest_block(tree: VantageTree, vectors: np.ndarray, who: np.ndarray, best: np.ndarray) -> None:
    bound = np.full((len(vectors), len(tree.centroid)), np.inf)
    bound[:, 0] = 0
    live = np.arange(len(vectors))
    while len(live):
        node = bound[live].argmin(axis=1)
        least = bound[live, node]
        go = np.isfinite(least) & (least <= np.sqrt(best[live].astype(np.float64)))
        live, node, least = live[go], node[go], least[go]
        bound[live, node] = np.inf
        for number in np.unique(node):
            chosen = node == number
            rows, inherited = live[chosen], least[chosen]
            centroid = tree.centroid[number]
            distance = squared(vectors[rows], tree.points[centroid])
            better = (distance < best[rows]) | ((distance == best[rows]) & (centroid < who[rows]))
            best[rows[better]], who[rows[better]] = distance[better], centroid
            away = np.sqrt(distance.astype(np.float64))
            for side in (0, 1):
                if tree.child[number, side] >= 0:
                    low, high = tree.low[number, side], tree.high[number, side]
                    gap = np.maximum(away - high, low - away) - SLACK * (away + high + 1)
                    bound[rows, tree.child[number, side]] = np.maximum(np.maximum(gap, inherited), 0)


def integer_vectors(df: DataFrame, ident: str, vector: str, size: int, scale: int) -> DataFrame:
    """(``id``, ``v``): floor(scale x component) of the vectors with ``size`` finite components."""
    rows = df.select(F.col(f"`{ident}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.fill_null(pc.equal(pc.list_value_length(batch.column("v")), size), False))
            values = np.floor(batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, size) * float(scale))
            # A NULL component arrives as NaN, for which the comparison is false too.
            fine = (np.abs(values) <= MAX_COMPONENT).all(axis=1)
            if fine.any():
                ids = batch.column("id").filter(pa.array(fine))
                yield pa.RecordBatch.from_arrays([ids, _lists(values[fine].astype(np.int32))], ["id", "v"])

    return rows.mapInArrow(kept, f"id {rows.schema['id'].dataType.simpleString()}, v array<int>")


def _lists(values: np.ndarray) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


def _matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy().astype(np.int64).reshape(-1, size)


def first_centroids(vectors: DataFrame, k: int, prefix: str) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of prefix and id, in the order of these digests."""
    digest = F.sha2(F.concat(F.lit(prefix), F.col("id").cast("string")), 256)
    rows = vectors.select("id", "v", digest.alias("d")).orderBy(F.asc_nulls_last("d"), "v").limit(k).collect()
    return np.array([row["v"] for row in rows], dtype=np.int64)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The floors of the means of what is nearest to each centroid; a centroid without vectors stays."""
    spark, (k, size) = vectors.sparkSession, centroids.shape
    tree = spark.sparkContext.broadcast(vantage_tree(centroids))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, dtype=np.int64), np.zeros((k, size), dtype=np.int64)
        for batch in batches:
            rows = _matrix(batch, size)
            who, _ = nearest(tree.value, rows)
            order = np.argsort(who, kind="stable")
            present, start = np.unique(who[order], return_index=True)
            if len(present):
                total[present] += np.add.reduceat(rows[order], start, axis=0)
                count += np.bincount(who, minlength=k)
        used = np.flatnonzero(count)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(count[used]), _lists(total[used])], ["c", "n", "s"])

    partial = vectors.select("v").mapInArrow(sums, "c long, n long, s array<long>")
    exact = "decimal(38,0)"
    places = partial.select("c", "n", F.posexplode("s").alias("i", "x"))
    rows = places.groupBy("c", "i").agg(F.sum(F.col("n").cast(exact)).alias("n"), F.sum(F.col("x").cast(exact)).alias("x")).collect()
    result = centroids.copy()
    for row in rows:
        result[row["c"], row["i"]] = int(row["x"]) // int(row["n"])
    tree.unpersist()
    return result


def centroid_clusters(
    df: DataFrame,
    ident: str = "vec_id",
    vector: str = "embedding",
    *,
    k: int = 8,
    rounds: int = 10,
    size: int = 64,
    scale: int = 1024,
    prefix: str = "3:",
) -> DataFrame:
    """(``ident``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``) of each kept vector.

    Kept are vectors of exactly ``size`` components, none NULL, NaN, infinite or beyond ``MAX_COMPONENT`` once scaled.
    The first centroids are the ``k`` vectors with the smallest digest of prefix and id (NULL ids last, equal ids by
    the vector; all, if there are fewer). ``rounds`` rounds assign and move; rounds after one that moves nothing would
    repeat it and are left out. Repeated rows are rows of their own; an empty table, or one without a kept vector,
    gives no row; further columns are not read. An inertia beyond a long raises.
    """
    if not 0 < k <= MAX_CENTROIDS:
        raise ValueError(f"k must be between 1 and {MAX_CENTROIDS}")
    if size * (2 * MAX_COMPONENT) ** 2 >= 2**63:
        raise ValueError("distances of so many components do not fit a long")
    spark = df.sparkSession
    vectors = materialise(integer_vectors(df, ident, vector, size, scale), "vectors")
    centroids = first_centroids(vectors, k, prefix).reshape(-1, size)
    for _ in range(rounds if len(centroids) else 0):
        before, centroids = centroids, moved(vectors, centroids)
        if (before == centroids).all():
            break

    tree = spark.sparkContext.broadcast(vantage_tree(centroids))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                who, distance = nearest(tree.value, _matrix(batch, size))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(who.astype(np.int32)), pa.array(distance)], ["id", "cluster", "distance"]
                )

    kind = vectors.schema["id"].dataType.simpleString()
    assigned = materialise(vectors.mapInArrow(assign, f"id {kind}, cluster int, distance long"), "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    inertia = {row["cluster"]: int(row["s"]) for row in sums}
    total = sum(inertia.values())
    if total >= 2**63:
        raise OverflowError("the inertia does not fit a long")
    figures = [
        (c, inertia[c], total, hashlib.sha256(",".join(map(str, point.tolist())).encode()).hexdigest())
        for c, point in enumerate(centroids)
        if c in inertia
    ]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    # At most k rows.
    named = F.broadcast(spark.createDataFrame(figures, schema))
    return assigned.join(named, "cluster").select(
        F.col("id").alias(ident), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def clusters_sql(k: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, prefix: str = "3:") -> str:
    """The same rows in DuckDB, each round a table expression."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: isfinite(x))) = {size}
), c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('{prefix}' || vec_id)) - 1 AS INTEGER) AS c, v
  FROM (SELECT * FROM kept ORDER BY sha256('{prefix}' || vec_id) LIMIT {k}) AS f
)"""
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""a{r} AS MATERIALIZED (
  SELECT vec_id, any_value(v) AS v, min(struct_pack(d := d, c := c)) AS b FROM (
    SELECT k.vec_id, k.v, c.c, CAST(list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d
    FROM kept AS k CROSS JOIN c{r} AS c) AS p GROUP BY vec_id
)"""
        )
        if r < rounds:
            steps.append(
                f"""m{r} AS (
  SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (
    SELECT b.c AS c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
    FROM (SELECT b, unnest(v) AS x, unnest(range(1, {size + 1})) AS i FROM a{r}) AS e GROUP BY b.c, i) AS g GROUP BY c
), c{r + 1} AS MATERIALIZED (
  SELECT c.c, coalesce(m.v, c.v) AS v FROM c{r} AS c LEFT JOIN m{r} AS m ON m.c = c.c
)"""
            )
    return (
        "WITH "
        + ", ".join(steps)
        + f"""
SELECT a.vec_id, a.b.c AS cluster, a.b.d AS distance,
  CAST(sum(a.b.d) OVER (PARTITION BY a.b.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.b.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN c{rounds} AS c ON c.c = a.b.c"""
    )
