"""Nearest neighbours by multi-index hashing of learned binary codes.

Codes are the signs of a rotation learned on a bounded sample: principal axes, then rotations that
bring the projections near their signs. A code is split into substrings, each indexed by its value.
Two codes within a Hamming radius differ by at most radius // substrings bits in some substring, so
probing all values that near finds every code within the radius. Those are ranked by the cosine of
the original vectors in double precision.

All rows are indexed. Queries meet them in blocks; a block gives each query its few best only. The
radius is learned as well: the true neighbours of some sampled rows, found by comparing these with
all rows, must lie within it at the wanted share. So it narrows as the table grows denser. A query that finds fewer than ``k`` rows in a block takes the block's whole index, so that none goes
short.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take no
part; vectors meet those of their own length, and lengths other than the commonest are searched whole;
components of any size count (vectors are scaled by powers of two, which changes no digit); equal
vectors tie to the smaller id; rows that repeat a query's id are never its neighbours; a null id takes
no part; an empty table gives an empty result; columns other than id and vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spendmart.llm.common import lean
from spendmart.staging import staged

SUBSTRING = 8
DATA_BLOCK, QUERY_BLOCK = 8192, 1024
_BITS = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_NEAR = _BITS[np.arange(256)[:, None] ^ np.arange(256)[None, :]]


@dataclass(frozen=True)
class Codes:
    """The learned projection, and the radius that holds the wanted share of true neighbours."""

    axes: np.ndarray
    centre: np.ndarray
    radius: int

    def of(self, x: np.ndarray) -> np.ndarray:
        """Codes as bytes: one substring each."""
        return np.packbits((x - self.centre) @ self.axes > 0, axis=1)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def learn(sample: np.ndarray, *, bits: int = 128, steps: int = 20, seed: int = 3) -> Codes:
    """Rotations for ``bits`` bits, as many at a time as there are dimensions; every code is within the radius."""
    rng = np.random.default_rng(seed)
    centre = sample.mean(0)
    x = sample - centre
    _, _, axes = np.linalg.svd(x, full_matrices=False)
    d = len(axes)
    parts = []
    for _ in range(-(-bits // d)):
        turn = np.linalg.qr(rng.normal(size=(d, d)))[0]
        projected = x @ axes.T
        for _ in range(steps):
            u, _, v = np.linalg.svd(np.sign(projected @ turn).T @ projected, full_matrices=False)
            turn = (u @ v).T
        parts.append(axes.T @ turn)
    width = max(bits // 8 * 8, 8)
    return Codes(np.concatenate(parts, 1)[:, :width], centre, width)


def radius_for(rows: DataFrame, sample_ids: np.ndarray, sample: np.ndarray, codes: Codes, k: int, recall: float) -> int:
    """The Hamming radius that holds the share ``recall`` of the ``k`` nearest of the sampled rows
    among all ``rows`` (id, vector). A task sends its best for each sampled row.
    """
    asked, own = unit(sample), codes.of(unit(sample))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearness, apart = np.full((len(asked), k), -2.0), np.zeros((len(asked), k), np.int64)
        for batch in batches:
            ids = batch.column(0).to_numpy()
            x = unit(batch.column(1).flatten().to_numpy().reshape(len(ids), -1))
            new = asked @ x.T
            new[sample_ids[:, None] == ids[None, :]] = -2.0
            first = np.argpartition(-new, min(k, len(ids)) - 1, axis=1)[:, :k]
            there = codes.of(x)
            far = np.stack([_BITS[own[:, None] ^ there[first[:, j]][:, None]].sum((1, 2)) for j in range(first.shape[1])], 1)
            both = np.concatenate([nearness, np.take_along_axis(new, first, 1)], 1), np.concatenate([apart, far], 1)
            order = np.argsort(-both[0], axis=1, kind="stable")[:, :k]
            nearness, apart = (np.take_along_axis(c, order, 1) for c in both)
        q, j = np.nonzero(nearness > -2.0)
        columns = [pa.array(q, pa.int32()), pa.array(nearness[q, j]), pa.array(apart[q, j], pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=["q", "nearness", "apart"])

    found = rows.select("id", "vector").mapInArrow(lean(best), "q int, nearness double, apart int")
    order = Window.partitionBy("q").orderBy(F.desc("nearness"), "apart")
    nearest_of = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("apart").collect()
    if not nearest_of:
        return codes.radius
    return int(np.quantile([row["apart"] for row in nearest_of], recall, method="higher"))


class Index:
    """One block's codes by substring value; ``within`` gives all codes within the radius."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = np.argsort(codes, axis=0, kind="stable")
        self.ends = np.stack([np.searchsorted(codes[self.order[:, s], s], np.arange(257)) for s in range(codes.shape[1])])

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        per = radius // codes_width(self.codes)
        hit = np.zeros(len(self.codes), bool)
        for s, value in enumerate(code):
            near = np.flatnonzero(_NEAR[value] <= per)
            order, ends = self.order[:, s], self.ends[s]
            for v in near:
                hit[order[ends[v] : ends[v + 1]]] = True
        rows = np.flatnonzero(hit)
        return rows[_BITS[self.codes[rows] ^ code].sum(1) <= radius]


def codes_width(codes: np.ndarray) -> int:
    return codes.shape[1]


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that no square leaves the range of doubles."""
    _, power = np.frexp(np.abs(x).max(1, keepdims=True))
    # in two steps: the power may be beyond what one factor can hold
    half = -power // 2
    return np.ldexp(np.ldexp(x, half), -power - half)


def best_in_block(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, codes: Codes | None, k: int
) -> list[tuple[int, int, float]]:
    """(query, id, cosine) of each query's ``k`` best rows that the index retrieves; of all without codes."""
    rows, queries = scaled(rows), scaled(queries)
    norms = np.sqrt((rows * rows).sum(1))
    index = Index(codes.of(unit(rows))) if codes else None
    asked = codes.of(unit(queries)) if codes else [None] * len(queries)
    out = []
    for q, vector, code in zip(query_ids, queries, asked):
        found = index.within(code, codes.radius) if index and codes else np.arange(len(rows))
        found = found[ids[found] != q]
        if len(found) < k:
            found = np.flatnonzero(ids != q)
        if not len(found):
            continue
        cosine = (rows[found] * vector).sum(1) / (norms[found] * np.sqrt((vector * vector).sum()))
        first = np.lexsort((ids[found], -cosine))[:k]
        out += [(int(q), int(ids[found[i]]), float(cosine[i])) for i in first]
    return out


def nearest(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = 50,
    k: int = 5,
    sample_rows: int = 2048,
    radius_rows: int = 256,
    recall: float = 0.97,
    bits: int = 128,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest of each row whose id ``every`` divides.

    The rotation is learned on at most ``sample_rows`` rows, the first in a hashed order; the first
    ``radius_rows`` of them are compared with all rows to learn the radius.
    """
    v = F.col("vector")
    fine = F.col("id").isNotNull() & (F.size(v) > 0)
    clean = fine & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")).where(clean)
    sizes = rows.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    schema = "query_id bigint, id bigint, score double"
    if not sizes:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    width = sizes[0]["d"]
    usual = F.size(v) == width
    n, n_queries, n_usual = rows.agg(F.count("*"), F.count_if(F.col("id") % every == 0), F.count_if(usual)).first()
    key = F.xxhash64("id", v)
    bound = min(1.0, 2 * sample_rows / n_usual) * 2.0**64 - 2.0**63
    near = rows.where(usual) if n_usual <= sample_rows else rows.where(usual & (key.cast("double") <= F.lit(bound)))
    chosen = near.orderBy(key).select("id", "vector").limit(sample_rows).collect()
    sample, sample_ids = np.array([r["vector"] for r in chosen]), np.array([r["id"] for r in chosen])
    codes = learn(unit(sample), bits=bits)
    radius = radius_for(rows.where(usual), sample_ids[:radius_rows], sample[:radius_rows], codes, k, recall)
    codes = replace(codes, radius=radius)

    n_data, n_asked = -(-n // DATA_BLOCK), max(1, -(-n_queries // QUERY_BLOCK))
    spread = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    own = lambda blocks: F.pmod(F.xxhash64(v, "id"), F.lit(blocks)).cast("int")
    size = F.size(v).alias("width")
    data = rows.select(size, own(n_data).alias("d"), spread(n_asked).alias("q"), "id", "vector", F.lit(False).alias("asks"))
    asked = rows.where(F.col("id") % every == 0).select(
        size, spread(n_data).alias("d"), own(n_asked).alias("q"), "id", "vector", F.lit(True).alias("asks")
    )

    def search(group: pd.DataFrame) -> pd.DataFrame:
        asks = group["asks"].to_numpy()
        ids, x = group["id"].to_numpy(), np.stack(group["vector"].to_numpy())
        learned = codes if x.shape[1] == width else None
        found = best_in_block(ids[asks], x[asks], ids[~asks], x[~asks], learned, k) if asks.any() and not asks.all() else []
        return pd.DataFrame(found, columns=["query_id", "id", "score"])

    met = staged(data.unionAll(asked).groupBy("width", "d", "q").applyInPandas(search, schema), "block-neighbours")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        met.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias("vec_id"), "score")
    )
