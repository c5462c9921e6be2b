"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

Candidates and queries are cut into blocks of bounded size, and each pair of blocks is one unit of work. Inside a unit
every dimension is a term whose posting list holds the candidates with a weight in it; each query row scatters its own
weight times the posting into a dense array of scores. A partition of the array selects the k best of the block, and the
blocks' selections are merged per query.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopflow.plans.storage import materialize

QUERIES_AT_ONCE = 128  # rows of the dense score array, so that it stays in the processor's cache


def _matrix(lists: pd.Series) -> np.ndarray:
    """Integer vectors as rows; shorter ones have no weight in the last terms."""
    width = max((len(v) for v in lists), default=0)
    out = np.zeros((len(lists), width), dtype=np.int64)
    for row, v in enumerate(lists):
        out[row, : len(v)] = v
    return out


def accumulate(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Dense scores (queries x candidates), one term after the other."""
    scores = np.zeros((len(queries), len(candidates)), dtype=np.int64)
    for term in range(min(queries.shape[1], candidates.shape[1])):
        weights = queries[:, term]
        users, posting = np.flatnonzero(weights), np.flatnonzero(candidates[:, term])
        if not len(users) or not len(posting):
            continue
        if len(posting) == len(candidates) and len(users) == len(queries):
            scores += weights[:, None] * candidates[:, term]
        else:
            scores[np.ix_(users, posting)] += weights[users, None] * candidates[posting, term]
    return scores


def select_top(scores: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best allowed scores; ties go to the earlier position."""
    places = np.flatnonzero(allowed)
    found = scores[places]
    if len(found) > k:
        least = np.partition(found, len(found) - k)[len(found) - k]
        above, ties = np.flatnonzero(found > least), np.flatnonzero(found == least)
        chosen = np.concatenate([above, ties[: k - len(above)]])
        places, found = places[chosen], found[chosen]
    return places[np.lexsort((places, -found))]


def _block_search(k: int):
    def search(key, queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        candidates = candidates.sort_values("_id", kind="stable")
        ids, matrix = candidates["_id"].to_numpy(), _matrix(candidates["_terms"])
        own, weights = queries["_id"].to_numpy(), _matrix(queries["_terms"])
        rows = []
        for begin in range(0, len(own), QUERIES_AT_ONCE):
            part = slice(begin, begin + QUERIES_AT_ONCE)
            scores = accumulate(weights[part], matrix)
            for query, line in zip(own[part], scores, strict=True):
                best = select_top(line, ids != query, k)
                rows.append(pd.DataFrame({"query_id": query, "vec_id": ids[best], "score": line[best]}))
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        return pd.concat(rows, ignore_index=True) if rows else empty

    return search


def top_k(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    every: int = 50,
    scale: int = 256,
    query_rows: int = 1024,
    candidate_rows: int = 4096,
) -> DataFrame:
    """The k best inner products of every query (ids divisible by `every`) over all rows but its own.

    Components x count as floor(scale * x). Vectors that are null, hold a null or a non-finite component, or have no id
    take no part; components beyond a shorter vector's end weigh nothing. Ties go to the smaller id. Rows that repeat an
    id are each candidates, none for their own id; as a query the id asks once, with its smallest vector. query_rows and
    candidate_rows bound a unit of work. Returns query_id, rank, vec_id, score; an empty table gives no rows.
    """
    x = F.col(vector)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    terms = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    valid = materialize(
        vectors.filter(x.isNotNull() & finite & F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("long").alias("_id"), terms.alias("_terms")),
        "vectors",
    )
    asking = valid.filter(F.col("_id") % every == 0).groupBy("_id").agg(F.min("_terms").alias("_terms"))
    n_candidates, n_queries = valid.count(), asking.count()
    candidate_blocks, query_blocks = -(-n_candidates // candidate_rows) or 1, -(-n_queries // query_rows) or 1

    def block(count):
        return F.pmod(F.xxhash64("_id"), F.lit(count)).cast("int")

    def every_block(count):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    left = asking.select("*", block(query_blocks).alias("_q"), every_block(candidate_blocks).alias("_c"))
    right = valid.select("*", block(candidate_blocks).alias("_c"), every_block(query_blocks).alias("_q"))
    found = left.groupBy("_q", "_c").cogroup(right.groupBy("_q", "_c")).applyInPandas(_block_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
