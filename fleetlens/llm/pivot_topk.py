"""Exact top-k by inner product, with candidates eliminated by distances to pivots.

Every vector's distances to all pivots are computed once and kept. For a query they bound
its distance to a candidate from below (the largest difference over the pivots), and so its
inner product from above: (|q|^2 + |x|^2 - distance^2) / 2. Candidates are evaluated in the
order of their bounds, until the k-th best score so far is above the bound of the next one.

Candidates are dealt to blocks by a hash of the id, queries likewise; each pair of blocks is
a task of bounded size that returns k rows per query, and the best of all blocks are kept.

Components are whole numbers, floor(scale * x). Vectors that are null or hold null or
non-finite components, and rows without an id, take no part; shorter vectors count as
filled up with zeros. Rows with the same id count once (the first vector in array order).
Ties go to the smaller id. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetlens.llm.common import written


@dataclass(frozen=True)
class Settings:
    """Pivots are chosen among ``pivot_sample`` vectors, each far from those before it."""

    k: int = 5
    scale: int = 256
    pivots: int = 32
    pivot_sample: int = 512
    block_rows: int = 4096
    query_rows: int = 2048


def whole_vectors(vectors: DataFrame, scale: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x): vectors of whole numbers, one for each id."""
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (
        vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & good)
        .select(
            F.col(key).cast("long").alias("vec_id"),
            F.transform(vector, lambda c: F.floor(c.cast("double") * scale)).alias("x"),
        )
        .groupBy("vec_id")
        .agg(F.min("x").alias("x"))
    )


def stacked(rows: pd.Series, width: int = 0) -> np.ndarray:
    """Vectors as a matrix of whole numbers, filled up with zeros."""
    width = max([width, *map(len, rows)], default=0)
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(m.astype(float), ((0, 0), (0, width - m.shape[1]))) for m in (a, b))
    squares = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(squares, 0))


def choose_pivots(vectors: DataFrame, settings: Settings) -> np.ndarray:
    """Far-apart vectors of a hash sample of fixed size."""
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(settings.pivot_sample).collect()
    points = stacked(pd.Series([r.x for r in sample], dtype=object))
    if not len(points):
        return points
    chosen = [0]
    nearest = distances(points, points[:1])[:, 0]
    while len(chosen) < min(settings.pivots, len(points)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, distances(points, points[chosen[-1:]])[:, 0])
    return points[chosen]


def index(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Add ``to_pivots``, the distances to the pivots, and write the table."""

    def run(batches):
        for batch in batches:
            yield batch.assign(to_pivots=list(distances(stacked(batch["x"]), pivots)))

    return written(vectors.mapInPandas(run, "vec_id long, x array<bigint>, to_pivots array<double>"), "pivots")


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def search_block(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> tuple[pd.DataFrame, int]:
    """The k best candidates for each query, and the number of products evaluated."""
    empty = pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "vec_id", "score")})
    if not len(queries) or not len(candidates):
        return empty, 0
    candidates = candidates.sort_values("vec_id", ignore_index=True)
    width = max(max(map(len, queries["x"])), max(map(len, candidates["x"])))
    q, x = stacked(queries["x"], width), stacked(candidates["x"], width)
    ids = candidates["vec_id"].to_numpy()
    to_q, to_x = np.stack(list(queries["to_pivots"])), np.stack(list(candidates["to_pivots"])).T.copy()
    norms_q, norms_x = ((m.astype(float) ** 2).sum(1) for m in (q, x))
    out, evaluated = [], 0
    for i, query_id in enumerate(queries["vec_id"]):
        gap = np.zeros(len(x))
        for to_query, to_candidates in zip(to_q[i], to_x):
            np.maximum(gap, np.abs(to_candidates - to_query), out=gap)
        sums = norms_q[i] + norms_x
        bound = (sums - gap * gap) / 2 + 1e-6 * sums + 1e-6  # room for rounding
        order = np.argsort(-bound, kind="stable")
        best_ids, best_scores, done, step = ids[:0], ids[:0], 0, 64
        while done < len(order):
            if len(best_ids) == k and best_scores[-1] > bound[order[done]]:
                break
            some = order[done : done + step]
            done, step = done + step, step * 2
            some = some[ids[some] != query_id]
            evaluated += len(some)
            best_ids = np.concatenate([best_ids, ids[some]])
            best_scores = np.concatenate([best_scores, x[some] @ q[i]])
            keep = best_of(best_ids, best_scores, k)
            best_ids, best_scores = best_ids[keep], best_scores[keep]
        out.append(pd.DataFrame({"query_id": query_id, "vec_id": best_ids, "score": best_scores}))
    return pd.concat(out, ignore_index=True), evaluated


def top_k(vectors: DataFrame, is_query, settings: Settings = Settings(), **names: str) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows where ``is_query`` (a function of the id) holds."""
    whole = written(whole_vectors(vectors, settings.scale, **names), "vectors")
    indexed = index(whole, choose_pivots(whole, settings))
    queries = indexed.where(is_query(F.col("vec_id")))
    n, m = indexed.count(), queries.count()
    blocks, query_blocks = max(1, -(-n // settings.block_rows)), max(1, -(-m // settings.query_rows))

    def every(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    def own(count: int):
        return F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")

    left = queries.withColumn("query_block", own(query_blocks)).withColumn("block", every(blocks))
    right = indexed.withColumn("block", own(blocks)).withColumn("query_block", every(query_blocks))
    k = settings.k
    found = (
        left.groupBy("block", "query_block")
        .cogroup(right.groupBy("block", "query_block"))
        .applyInPandas(lambda a, b: search_block(a, b, k)[0], "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
