"""Exact top-k search by inner product with MaxScore.

Each dimension of a vector is a term, each query weighs the terms, and a shard keeps one posting
list per term. The contribution of a term lies between two bounds that the shard's extremes give.
Terms with narrow bounds are non-essential as long as all of them together cannot lift a vector to
the k-th best score so far: only the essential lists are traversed, and of the vectors still
competitive afterwards the other terms are probed one by one, dropping vectors whose best possible
score falls below the threshold. Shards are merged by their exact scores.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillsift.llm.staging import staged

SHARD_ROWS = 2_048
QUERY_ROWS = 4_096
#: Vectors scored first, so that there is a threshold before the lists are traversed.
FIRST_SCORED = 64
EXACT_IN_DOUBLE = 2.0**52


def quantised(vector: Column) -> Column:
    """floor(256 x) of each component, as whole numbers."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * 256))


def whole_vectors(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is neither null nor holds null or non-finite components."""
    c = F.col(vector)
    bad = F.exists(
        c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    )
    return df.where(c.isNotNull() & ~bad)


class Shard:
    """Posting lists of some vectors: ``lists[d]`` are the values of term d by vector."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, rows: np.ndarray | None = None):
        order = np.argsort(ids, kind="stable")
        self.ids, lists = ids[order], vectors[order].T
        # Ids may repeat; a row is known by its key, which is the id unless another is given.
        self.rows = self.ids if rows is None else rows[order]
        size = max(1, lists.shape[0])
        largest = float(np.abs(lists).max(initial=0))
        self.limit = math.sqrt(EXACT_IN_DOUBLE / size)
        self.exact = largest < self.limit
        self.lists = np.ascontiguousarray(lists, dtype=np.float64 if self.exact else object)
        self.high, self.low = self.lists.max(axis=1), self.lists.min(axis=1)

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of at least the k best vectors but that of the row ``own``."""
        kind = self.lists.dtype
        if kind == object or np.abs(query).max(initial=0) >= self.limit:
            query, kind = np.array([int(x) for x in query], dtype=object), object
        query = query.astype(kind)
        a, b = query * self.high, query * self.low
        upper, lower = np.maximum(a, b), np.minimum(a, b)
        others = np.flatnonzero(self.rows != own)
        first = others[:FIRST_SCORED]
        scores = query @ self.lists[:, first]
        if len(others) <= FIRST_SCORED:
            return self.ids[first], scores
        floor = np.sort(scores)[-k] if len(scores) >= k else scores.min() - 1
        # Narrow terms first; those that cannot reach the threshold together are not essential.
        order = np.argsort(upper - lower, kind="stable")
        reach = lower.sum() + np.cumsum((upper - lower)[order])
        split = int(np.searchsorted(reach, floor, side="left"))
        optional, essential = order[:split][::-1], order[split:]
        part = query[essential] @ self.lists[essential]
        rest = upper[optional].sum()
        alive = others[(part[others] + rest) >= floor]
        part = part[alive]
        for d in optional:
            part = part + query[d] * self.lists[d, alive]
            rest = rest - upper[d]
            keep = (part + rest) >= floor
            if not keep.all():
                alive, part = alive[keep], part[keep]
        return self.ids[alive], part


FOUND = ["row", "query_id", "vec_id", "score"]


def _search_block(k: int):
    def run(key, queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(vectors):
            stacked = np.stack(vectors["v"].to_list())
            shard = Shard(vectors["id"].to_numpy(), stacked, vectors["row"].to_numpy())
            for row, query_id, vector in zip(
                queries["row"], queries["id"], queries["v"], strict=True
            ):
                ids, scores = shard.search(np.asarray(vector), row, k)
                best = np.lexsort((ids, -scores))[:k]
                part = {"row": row, "query_id": query_id}
                part |= {"vec_id": ids[best], "score": scores[best]}
                found.append(pd.DataFrame(part))
        if not found:
            return pd.DataFrame({c: [] for c in FOUND}).astype("int64")
        return pd.concat(found)[FOUND].astype("int64")

    return run


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 5) -> DataFrame:
    """The k best of ``vectors`` (row, id, v) for each of ``queries`` (row, id, v), ties to the
    smaller id.

    ``row`` tells rows apart, ids may repeat: a row is no answer to the query of its own key, other
    rows of its id are, and queries of one id have an answer each. Vectors are compared with queries
    of the same length only. Returns query_id, rank, vec_id, score.
    """
    shards = max(1, math.ceil(vectors.count() / SHARD_ROWS))
    blocks = max(1, math.ceil(queries.count() / QUERY_ROWS))
    key = ["shard", "block", "length"]

    def spread(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        return df.select(
            "row",
            "id",
            "v",
            F.size("v").alias("length"),
            F.pmod(F.xxhash64("row"), F.lit(n)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other),
        )

    left = spread(queries, "block", blocks, "shard", shards).groupBy(*key)
    right = spread(vectors, "shard", shards, "block", blocks).groupBy(*key)
    found = left.cogroup(right).applyInPandas(
        _search_block(k), ", ".join(f"{c} LONG" for c in FOUND)
    )
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def search_embeddings(embeddings: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """Queries are the rows whose vec_id is divisible by ``every``; see :func:`top_k`.

    Rows without an id or with a null, NaN or infinite component take no part. Repeated ids, and
    repeated rows, are rows of their own: each is a query, and an answer to all but itself. An empty
    table gives no rows.
    """
    rows = whole_vectors(embeddings.where(F.col("vec_id").isNotNull())).select(
        F.col("vec_id").alias("id"),
        quantised(F.col("embedding")).alias("v"),
        F.monotonically_increasing_id().alias("row"),
    )
    # Written once, so that a row has the same key as a query and as an answer.
    rows = staged(embeddings.sparkSession, rows, "top-k-rows")
    return top_k(rows.where(F.col("id") % every == 0), rows, k)


def oracle_sql(every: int = 50, k: int = 5) -> str:
    return f"""
WITH v AS MATERIALIZED (
    SELECT vec_id, row_number() OVER () AS own, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding,
        lambda x: x IS NULL OR isnan(x::DOUBLE) OR isinf(x::DOUBLE))) = 0),
scored AS (
    SELECT q.own, q.vec_id AS query_id, c.vec_id AS vec_id,
        list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
    FROM v q JOIN v c ON q.own <> c.own AND q.vec_id % {every} = 0
        AND len(q.e) = len(c.e)),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id) AS rank
    FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= {k}"""
