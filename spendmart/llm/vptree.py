"""Centroid clustering in exact integers, with a vantage-point tree over the centroids.

Vectors become whole numbers once and are written. In each round the driver builds a vantage-point
tree over the centroids and sends it to the tasks. A vector visits the tree's nodes in the order of
their lower bounds, nearest first; distances at the vantage points and leaves are exact integers. A
node is left out only if its bound lies above the best distance, so a centroid at the same distance
is still met and the smaller number wins. Every task adds its vectors up by cluster before anything
moves: a cluster with a third of all rows is one row per task. Sums and counts are whole numbers, so
rounds give the same centroids however tasks are cut or repeated.

Defined results: vectors that are null, of another length, or hold null or non-finite components take
no part; all others do. A whole number beyond +-2^26 counts as that, since a squared distance would not
fit a long otherwise. Repeated rows each count; equal seeds make equal centroids, of which the
smallest number takes all. A null id hashes as empty text. Fewer vectors than clusters make fewer
clusters, and an empty table gives an empty result. An inertia beyond a long is null. Columns other
than id and vector are not read, so their names clash with nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendmart.llm.common import binaries, lean
from spendmart.staging import staged

#: A component's limit: 64 squares of differences of two such fit a long.
LARGEST = 1 << 26
#: Cells of bounds held at a time: vectors by nodes.
CELLS = 1 << 20
LEAF = 4


@dataclass(frozen=True)
class Tree:
    """Nodes as arrays. An inner node has a vantage point, which is one of the centroids, and two
    children with the least and greatest distance from it; a leaf has up to ``LEAF`` centroids.
    """

    centroids: np.ndarray
    vantage: np.ndarray
    children: np.ndarray
    reach: np.ndarray
    leaves: list[np.ndarray]

    @classmethod
    def over(cls, centroids: np.ndarray) -> Tree:
        vantage, children, reach, leaves = [], [], [], []

        def add(members: np.ndarray) -> int:
            at = len(vantage)
            vantage.append(-1)
            children.append((-1, -1))
            reach.append(((0.0, 0.0), (0.0, 0.0)))
            leaves.append(members)
            return at

        todo = [(add(np.arange(len(centroids))), np.arange(len(centroids)))]
        while todo:
            at, members = todo.pop()
            if len(members) <= LEAF:
                continue
            # the member farthest from another is at the rim, where spheres cut best
            rim = members[squared(centroids[members], centroids[members[0]]).argmax()]
            rest = members[members != rim]
            away = np.sqrt(squared(centroids[rest], centroids[rim]).astype(float))
            order = np.argsort(away, kind="stable")
            halves = order[: len(order) // 2], order[len(order) // 2 :]
            vantage[at], leaves[at] = int(rim), rest[:0]
            children[at] = tuple(add(rest[half]) for half in halves)
            reach[at] = tuple((away[half].min(), away[half].max()) for half in halves)
            todo += [(child, rest[half]) for child, half in zip(children[at], halves)]
        return cls(centroids, np.array(vantage), np.array(children), np.array(reach), leaves)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Each vector's nearest centroid, its exact squared distance; and the distances taken."""
        number = np.full(len(vectors), len(self.centroids), np.int64)
        best = np.full(len(vectors), np.iinfo(np.int64).max, np.int64)
        taken = 0
        size = max(1, CELLS // max(len(self.vantage), 1))
        for at in range(0, len(vectors), size):
            part = slice(at, at + size)
            taken += self._search(vectors[part], number[part], best[part])
        return number, best, taken

    def _search(self, vectors: np.ndarray, number: np.ndarray, best: np.ndarray) -> int:
        """Best-first, all vectors a node further in each step."""
        bound = np.full((len(vectors), len(self.vantage)), np.inf)
        bound[:, 0] = 0.0
        alive = np.arange(len(vectors))
        taken = 0
        while len(alive):
            node = bound[alive].argmin(1)
            least = bound[alive, node]
            # the margin is far above what rounding moves a bound of doubles by
            within = np.isfinite(least) & (least * least * (1 - 1e-9) <= best[alive])
            alive, node = alive[within], node[within]
            bound[alive, node] = np.inf
            order = np.argsort(node, kind="stable")
            edges = np.flatnonzero(np.diff(node[order], prepend=-1))
            for rows in np.split(order, edges[1:]):
                if not len(rows):
                    continue
                at, who = int(node[rows[0]]), alive[rows]
                points = self.leaves[at] if self.vantage[at] < 0 else [self.vantage[at]]
                for point in points:
                    distance = squared(vectors[who], self.centroids[point])
                    taken += len(who)
                    better = (distance < best[who]) | ((distance == best[who]) & (point < number[who]))
                    best[who[better]], number[who[better]] = distance[better], point
                if self.vantage[at] >= 0:
                    away = np.sqrt(distance.astype(float))
                    for child, (low, high) in zip(self.children[at], self.reach[at]):
                        slack = 1e-9 * (away + high)
                        bound[who, child] = np.maximum(np.maximum(away - high, low - away) - slack, np.minimum(least[within][rows], 1e300))
        return taken


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of rows of whole numbers, exact."""
    difference = a - b
    return np.einsum("ij,ij->i", difference, difference)


def _whole(size: int, scale: int):
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1)
            rows = np.flatnonzero(vectors.is_valid().to_numpy(False) & (vectors.value_lengths().fill_null(-1).to_numpy(False) == size))
            flat = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(rows), size)
            fit = np.isfinite(flat).all(1)  # nulls have become NaN
            with np.errstate(over="ignore"):
                found = np.clip(np.floor(flat[fit] * scale), -LARGEST, LARGEST).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows[fit])), binaries([row.tobytes() for row in found])], names=["id", "vector"]
            )

    return whole


def _rows(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32).reshape(len(column), size).astype(np.int64)


def _moved(whole: DataFrame, tree: Tree) -> np.ndarray:
    """The next centroids: the floor of each cluster's mean; an empty cluster's stays."""
    k, size = tree.centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            vectors = _rows(batch.column(0), size)
            number, _, _ = tree.nearest(vectors)
            order = np.argsort(number, kind="stable")
            seen, begins = np.unique(number[order], return_index=True)
            sums[seen] += np.add.reduceat(vectors[order], begins) if len(seen) else 0
            counts += np.bincount(number, minlength=k)
        for c in np.flatnonzero(counts):
            columns = [np.full(size, c), np.arange(size), sums[c], np.full(size, counts[c])]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["c", "i", "total", "n"])

    added = whole.select("vector").mapInArrow(lean(add), "c bigint, i bigint, total bigint, n bigint")
    out = tree.centroids.copy()
    # a row for each component of each centroid
    for row in added.groupBy("c", "i").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        out[row["c"], row["i"]] = row["total"] // row["n"]
    return out


def clustered(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    size: int = 64,
    scale: int = 256,
    k: int = 40,
    rounds: int = 5,
    seed: int = 2,
) -> DataFrame:
    """One row per vector that takes part: id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType.simpleString()
    read = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    whole = staged(read.mapInArrow(lean(_whole(size, scale)), f"id {id_type}, vector binary"), "whole-vectors")
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = whole.select(key.alias("key"), "vector").orderBy("key", "vector").limit(k).collect()
    centroids = np.array([np.frombuffer(row["vector"], np.int32) for row in first], np.int64).reshape(len(first), size)
    for _ in range(rounds if len(first) else 0):
        centroids = _moved(whole, Tree.over(centroids))
    tree = Tree.over(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, distance, _ = tree.nearest(_rows(batch.column(1), size))
            columns = [batch.column(0), pa.array(number.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "cluster", "distance"])

    found = staged(whole.mapInArrow(lean(assign), f"id {id_type}, cluster int, distance bigint"), "clusters")
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()  # k rows
    inertia = {row["cluster"]: int(row["inertia"]) for row in sums}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    total = sum(inertia.values())
    fits = lambda n: n if n < 1 << 63 else None
    rows = [(c, fits(n), fits(total), names[c]) for c, n in sorted(inertia.items())]
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    joined = found.join(F.broadcast(about), "cluster")  # k rows
    return joined.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
