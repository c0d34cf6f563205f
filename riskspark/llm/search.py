"""Exact top-k inner products by MaxScore over shards.

Components become integers, and each dimension two terms, one for its positive and one for its negative values, so that
a query's own sign decides which postings add to a score. The vectors are dense, so the postings of a shard are kept as
columns of a block. Terms are split by their largest possible contributions: those that together can't reach the score
of the present k-th best are non-essential. Essential postings are traversed for all documents of the shard; of the rest,
only documents that stay competitive are probed, term by term, and at last exactly. Shards and blocks of queries have
bounded sizes, every block meets every shard once, and the winners of the shards are merged by rank.

Defined cases: vectors that are null or hold null or non-finite components take no part, nor do rows without an id; of
rows that repeat an id one counts, the first by its components; shorter vectors are filled up with zeros; ties go to the
smaller id. Scores are exact however large the components are: where sums of products may exceed what doubles hold exactly,
thresholds are lowered by the largest possible rounding and the survivors scored in whole numbers. A score beyond a long
is shown as the largest long of its sign; components beyond 2**400 are taken as 2**400. Other columns are ignored. An empty table,
of vectors or of queries, gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskspark.llm.common import table

SHARD_ROWS, BLOCK_QUERIES = 4096, 8192
#: Queries that are searched together, and documents that are scored first to get a threshold.
TOGETHER, FIRST = 128, 512
LARGEST = 2.0**400
MOST = (1 << 63) - 1
STEP = 8


def sound(vector: Column) -> Column:
    return vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def matrix(rows: pd.DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids, ascending and distinct, and the vectors as integers."""
    vectors = np.zeros((len(rows), width))
    for k, v in enumerate(rows["vector"]):
        vectors[k, : len(v)] = v
    vectors = np.clip(np.floor(256 * vectors), -LARGEST, LARGEST)
    ids = rows["vec_id"].to_numpy(np.int64)
    order = np.lexsort((*vectors.T[::-1], ids))
    ids, vectors = ids[order], vectors[order]
    first = np.concatenate(([True], ids[1:] != ids[:-1])) if len(ids) else np.zeros(0, bool)
    return ids[first], vectors[first]


class Shard:
    """The postings of a block of documents. ``slack`` bounds how far a score in doubles may be from the true one."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, slack: float = 0.0):
        self.ids, self.vectors, self.slack = ids, vectors, slack
        self.plus, self.minus = np.maximum(vectors, 0), np.maximum(-vectors, 0)
        self.most_plus, self.most_minus = self.plus.max(0), self.minus.max(0)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[int, int, int]]:
        """(query, document, score) of the k best documents of the shard for each query."""
        out = []
        for low in range(0, len(query_ids), TOGETHER):
            out += self._together(query_ids[low : low + TOGETHER], queries[low : low + TOGETHER], k)
        return out

    def _together(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[int, int, int]]:
        plus, minus = np.maximum(queries, 0), np.maximum(-queries, 0)
        bounds = plus * self.most_plus + minus * self.most_minus
        threshold = self._thresholds(query_ids, queries, k) - 4 * self.slack
        order = np.argsort(bounds, 1)
        reach = np.cumsum(np.take_along_axis(bounds, order, 1), 1)
        split = (reach < threshold[:, None]).sum(1)
        essential = np.ones(bounds.shape, bool)
        np.put_along_axis(essential, order, np.arange(bounds.shape[1])[None, :] >= split[:, None], 1)
        scores = (plus * essential) @ self.plus.T + (minus * essential) @ self.minus.T
        rest = np.where(split > 0, np.take_along_axis(reach, np.maximum(split - 1, 0)[:, None], 1)[:, 0], 0)
        out = []
        for q, query in enumerate(query_ids):
            alive = np.flatnonzero((scores[q] + rest[q] >= threshold[q]) & (self.ids != query))
            alive = self._probe(alive, scores[q], rest[q], threshold[q], order[q, : split[q]][::-1], queries[q], bounds[q])
            exact = self._exact(alive, queries[q])
            best = np.lexsort((self.ids[alive], -exact))[:k]
            out += [(int(query), int(self.ids[alive[b]]), int(exact[b])) for b in best]
        return out

    def _exact(self, alive: np.ndarray, query: np.ndarray) -> np.ndarray:
        if not self.slack:
            return self.vectors[alive] @ query
        whole = [int(x) for x in query.tolist()]
        scores = [sum(int(x) * y for x, y in zip(row, whole, strict=True)) for row in self.vectors[alive].tolist()]
        return np.array([max(-MOST - 1, min(MOST, s)) for s in scores], dtype=object)

    def _thresholds(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> np.ndarray:
        """The k-th best score among the first documents of the shard: no lower one can be among the k best."""
        first = queries @ self.vectors[:FIRST].T
        first[self.ids[None, :FIRST] == query_ids[:, None]] = -np.inf
        if first.shape[1] < k:
            return np.full(len(query_ids), -np.inf)
        return -np.partition(-first, k - 1, 1)[:, k - 1]

    def _probe(self, alive, scores, rest, threshold, terms, query, bounds) -> np.ndarray:
        """The documents that stay competitive while the non-essential terms are probed, the strongest first."""
        score = scores[alive]
        for low in range(0, len(terms), STEP):
            if len(alive) <= STEP:
                break
            some = terms[low : low + STEP]
            score = score + np.maximum(self.vectors[np.ix_(alive, some)] * query[some], 0).sum(1)
            rest = rest - bounds[some].sum()
            # Sums of integers below 2**53 are exact, so the comparison is.
            keep = score + rest >= threshold
            alive, score = alive[keep], score[keep]
        return alive


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best of ``vectors`` for each of ``queries`` (both vec_id, vector)."""
    keep = F.col("vec_id").isNotNull() & sound(F.col("vector"))
    vectors, queries = (d.select(F.col("vec_id").cast("long"), "vector").where(keep) for d in (vectors, queries))
    n, width = vectors.agg(F.count("*"), F.max(F.size("vector"))).first()
    n_queries, query_width = queries.agg(F.count("*"), F.max(F.size("vector"))).first()
    shards, blocks, width = max(1, -(-n // SHARD_ROWS)), max(1, -(-n_queries // BLOCK_QUERIES)), max(width or 0, query_width or 0, 1)
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    own = lambda m: F.pmod(F.xxhash64("vec_id"), F.lit(m)).cast("int")
    left = vectors.select("vec_id", "vector", own(shards).alias("shard"), every(blocks).alias("block"))
    right = queries.select("vec_id", "vector", own(blocks).alias("block"), every(shards).alias("shard"))

    def search(documents: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(documents) and len(asked):
            ids, own_vectors = matrix(documents, width)
            query_ids, own_queries = matrix(asked, width)
            found = Shard(ids, own_vectors, rounding(own_vectors, own_queries)).search(query_ids, own_queries, k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(search, "query_id long, vec_id long, score long")
    place = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def rounding(a: np.ndarray, b: np.ndarray) -> float:
    """How far sums of products of doubles may be from the true ones: not at all while they stay below 2**52."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    return 0.0 if most < 2**52 else most * a.shape[1] * 2.0**-52


def op2_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best vectors for every vector whose id is divisible by 50."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return top_k(rows, rows.where(F.col("vec_id") % 50 == 0), 5)


OP2_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v c on c.vec_id <> q.vec_id
  where q.vec_id % 50 = 0
), r as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s
)
select query_id, rank, vec_id, score from r where rank <= 5
"""
