"""Exact vector search with hard filters, its evaluation, and the upkeep of the index."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.operators.quality import set_difference
from shopflow.plans.hot_keys import top_k
from shopflow.plans.quantiles import quantiles

# Query vectors of one block, and chunk vectors of one; a pair of blocks is a matrix product.
QUERIES_PER_PASS = 1024
CHUNK_ROWS = 4096


def matches(
    brands: list[str] | None = None, category_prefix: list[str] | None = None, min_price: float | None = None,
    max_price: float | None = None, in_stock: bool | None = None, chunk_types: list[str] | None = None,
) -> Column:
    """Hard scalar filters; those not given always hold."""
    rule = F.lit(True)
    if brands:
        rule = rule & F.lower("brand").isin([b.lower() for b in brands])
    for level, wanted in enumerate(category_prefix or [], start=1):
        rule = rule & (F.col(f"category_l{level}") == wanted)
    if min_price is not None:
        rule = rule & (F.col("current_price") >= min_price)
    if max_price is not None:
        rule = rule & (F.col("current_price") <= max_price)
    if in_stock is not None:
        rule = rule & (F.col("in_stock") == in_stock)
    if chunk_types:
        rule = rule & F.col("chunk_type").isin(chunk_types)
    return rule


def centroids(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Mean vector per key. Members average separately, so a frequent key combines map-side."""
    members = vectors.select(key, F.posexplode(vector).alias("place", "x"))
    means = members.groupBy(key, "place").agg(F.avg(F.col("x").cast("double")).alias("x"))
    rows = means.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("place", "x"))).alias("_v"))
    return rows.select(key, F.col("_v")["x"].alias(vector))


def _packed(chunks: DataFrame, vector: str) -> DataFrame:
    """Chunks packed into blocks, one row each: items, their best ratings and the matrix of their vectors."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), CHUNK_ROWS):
                part = batch.iloc[start : start + CHUNK_ROWS].sort_values("item_id", kind="stable")
                matrix = np.stack(part[vector].to_numpy()).astype(np.float64)
                yield pd.DataFrame({
                    "items": [part["item_id"].to_numpy(np.int64).tobytes()], "ratings": [part["average_rating"].to_numpy(np.float64).tobytes()],
                    "matrix": [matrix.tobytes()],
                })

    needed = chunks.select("item_id", "average_rating", vector)
    return needed.mapInPandas(pack, "items binary, ratings binary, matrix binary")


def best_items(chunks: DataFrame, queries: DataFrame, key: str, k: int, vector: str = "embedding") -> DataFrame:
    """The k best items per query by their best chunk; ties by rating, then id.

    Queries and chunks are cut into blocks; a pair of blocks is scored as one matrix product and gives its own k best items
    per query, as an item among the best overall is among the best wherever its best chunk lies. A chunk block, packed
    once, is copied per query block, and a query block per salt, so no key of the join gathers all chunks. The plan does
    not depend on the number of queries and no vector passes the driver. Without queries or chunks there are no rows.
    """
    kind = queries.schema[key].dataType.simpleString()
    blocks = max(1, -(-queries.count() // QUERIES_PER_PASS))
    salts = max(1, -(-int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")) // blocks))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("_block")
    asked = queries.groupBy(block).agg(F.collect_list(F.struct(F.col(key).alias("name"), F.col(vector).alias("query"))).alias("asked"))
    asked = asked.select("_block", every(salts).alias("_salt"), "asked")
    held = _packed(chunks, vector).withColumn("_salt", F.pmod(F.xxhash64("items", "matrix"), F.lit(salts)).cast("int"))
    pairs = held.withColumn("_block", every(blocks)).join(asked, ["_block", "_salt"])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                yield _block_best(row, key, k)

    found = pairs.select("items", "ratings", "matrix", "asked").mapInPandas(score, f"{key} {kind}, item_id bigint, score double, average_rating double")
    per_item = found.groupBy(key, "item_id").agg(F.max("score").alias("score"), F.max("average_rating").alias("average_rating"))
    return top_k(per_item, [key], [F.desc("score"), F.desc("average_rating"), F.asc("item_id")], k)


def _keep_best(items: np.ndarray, scores: np.ndarray, ratings: np.ndarray, k: int) -> tuple:
    """First k distinct items by score, rating and id."""
    order = np.lexsort((items, -ratings, -scores))
    _, first = np.unique(items[order], return_index=True)
    order = order[np.sort(first)[:k]]
    return items[order], scores[order], ratings[order]


def _block_best(row, key: str, k: int) -> pd.DataFrame:
    """The k best items of one block of chunks for each query of one block."""
    every = np.frombuffer(row.items, dtype=np.int64)
    matrix = np.frombuffer(row.matrix, dtype=np.float64).reshape(len(every), -1)
    items, first = np.unique(every, return_index=True)
    ratings = np.maximum.reduceat(np.frombuffer(row.ratings, dtype=np.float64), first)
    asked = np.array([q["query"] for q in row.asked], dtype=np.float64)
    scores = np.maximum.reduceat(np.round(matrix @ asked.T, 6), first, axis=0)  # best chunk of every item
    names, found = [], []
    for place, query in enumerate(row.asked):
        best = _keep_best(items, scores[:, place], ratings, k)
        names += [query["name"]] * len(best[0])
        found.append(best)
    columns = [np.concatenate([f[i] for f in found]) for i in range(3)]
    return pd.DataFrame({key: names, "item_id": columns[0], "score": columns[1], "average_rating": columns[2]})


def retrieve(
    chunks: DataFrame, queries: DataFrame, key: str, k: int, rule: Column | None = None, evidence: int = 2, vector: str = "embedding"
) -> DataFrame:
    """Best items per query with up to two pieces of evidence.

    Filters come first, so the k items are exact and no pool needs refilling. The evidence pass only
    touches chunks of winning items, at most k items per query.
    """
    allowed = chunks if rule is None else chunks.filter(rule)
    items = best_items(allowed, queries, key, k, vector)
    winners = items.select(key, "item_id", "rank", F.col("score").alias("item_score"))
    near = allowed.join(winners, "item_id").join(queries.select(key, F.col(vector).alias("_query")), key)
    product = F.aggregate(
        F.zip_with(vector, "_query", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda t, x: t + x
    )
    scored = near.withColumn("score", F.round(product, 6))
    return top_k(scored, [key, "item_id"], [F.desc("score"), F.asc("chunk_id")], evidence, "evidence_rank").select(
        key, F.col("rank").alias("item_rank"), "item_id", "item_score", "average_rating", "evidence_rank", "chunk_id", "score"
    )


def evaluate(results: DataFrame, truth: DataFrame, key: str, k: int = 10, rule: Column | None = None) -> DataFrame:
    """Recall at k, repeated items and broken constraints per query.

    results: key, item_id and, with a rule, the columns it reads. truth: key, item_id.
    """
    wanted = truth.select(key, "item_id").distinct().withColumn("_relevant", F.lit(1))
    judged = results.join(wanted, [key, "item_id"], "left")
    broken = F.lit(0) if rule is None else (~F.coalesce(rule, F.lit(False))).cast("int")
    per_item = judged.withColumn("_broken", broken).groupBy(key, "item_id").agg(
        F.count(F.lit(1)).alias("_n"), F.max("_relevant").alias("_relevant"), F.sum("_broken").alias("_broken")
    )
    found = per_item.groupBy(key).agg(
        F.coalesce(F.sum("_relevant"), F.lit(0)).alias("found"), F.sum(F.col("_n") - 1).alias("duplicates"),
        F.sum("_broken").alias("violations"),
    )
    sizes = wanted.groupBy(key).agg(F.count(F.lit(1)).alias("relevant"))
    return sizes.join(found, key, "left").select(
        key, "relevant", F.coalesce("found", F.lit(0)).alias("found"), F.coalesce("duplicates", F.lit(0)).alias("duplicates"),
        F.coalesce("violations", F.lit(0)).alias("violations"), (F.coalesce("found", F.lit(0)) / F.col("relevant")).alias(f"recall_at_{k}"),
    )


def evaluation_report(per_query: DataFrame, latencies: DataFrame, k: int = 10, least_recall: float = 0.90, most_p95: float = 750.0) -> DataFrame:
    """Release decision: mean recall, nearest-rank p95 latency, no repeats, no violations."""
    sums = per_query.agg(
        F.count(F.lit(1)).alias("query_count"), F.avg(f"recall_at_{k}").alias("recall"), F.sum("duplicates").alias("duplicates"),
        F.sum("violations").alias("violations"),
    )
    p95 = quantiles(latencies.withColumn("_all", F.lit(1)), ["_all"], "latency_ms", [0.95], nearest_rank=True)
    joined = sums.crossJoin(p95.select(F.col("quantile").alias("p95_ms")))  # one row each
    good = (F.col("recall") >= least_recall) & (F.col("p95_ms") <= most_p95) & (F.col("duplicates") == 0) & (F.col("violations") == 0)
    return joined.withColumn("status", F.when(good, "passed").otherwise("failed"))


def publish_decision(
    previous: DataFrame | None, current: DataFrame, contract_changed: bool = False, requested: str = "incremental"
) -> tuple[str, str, DataFrame]:
    """(mode, reason, rows to write): upsert changed items, or rebuild when stale chunks could remain.

    Both frames hold item_id, item_hash and chunk_id. Items gone, or changed items that lost a chunk,
    force a rebuild; so does another chunker or model. Three counts come back to the driver.
    """
    if previous is None or requested == "reconcile":
        return "reconcile", "explicit_or_initial_reconcile", current
    old = previous.groupBy("item_id").agg(F.max("item_hash").alias("_old"))
    new = current.groupBy("item_id").agg(F.max("item_hash").alias("_new"))
    both = old.join(new, "item_id", "full")
    changed = both.filter(F.col("_new").isNotNull() & ~F.col("_old").eqNullSafe(F.col("_new"))).select("item_id")
    facts = both.agg(F.count_if(F.col("_new").isNull()).alias("gone")).first()
    lost = previous.join(changed, "item_id", "left_semi").join(current.select("chunk_id"), "chunk_id", "left_anti")
    if contract_changed:
        return "reconcile", "contract_change", current
    if facts["gone"] or not lost.isEmpty():
        return "reconcile", "deleted_item_or_chunk_shrink", current
    return "incremental", "safe_native_upsert", current.join(changed, "item_id", "left_semi")


def validate_index(expected: DataFrame, actual: DataFrame, dimension: int, vector: str = "embedding") -> DataFrame:
    """Checks of a written index: same ids, unique, right size, finite and unit vectors; one row per check."""
    off = set_difference(expected, actual, "chunk_id").agg(
        F.count_if(F.col("side") == "missing").alias("missing_ids"), F.count_if(F.col("side") == "unexpected").alias("unexpected_ids")
    )
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    size = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double")))
    facts = actual.agg(
        F.count_if(F.size(vector) != dimension).alias("wrong_dimension"), F.count_if(bad).alias("not_finite"),
        F.count_if(F.abs(size - 1) > 0.01).alias("not_normalized"),
    )
    repeated = actual.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated_ids")
    )
    names = ["missing_ids", "unexpected_ids", "wrong_dimension", "not_finite", "not_normalized", "repeated_ids"]
    wide = off.crossJoin(facts).crossJoin(repeated)  # one row each
    return wide.unpivot([], names, "check_name", "violations").withColumn(
        "status", F.when(F.col("violations") == 0, "SUCCESS").otherwise("FAILED")
    )


def pending(targets: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Keys a resumed run still has to process."""
    return targets.join(done.select(key), key, "left_anti")


def record_outcomes(earlier: DataFrame | None, results: DataFrame, key: str) -> DataFrame:
    """Latest outcome per key; a success replaces any failure and is never lost."""
    rows = results if earlier is None else earlier.unionByName(results)
    order = F.struct((F.col("status") == "done").cast("int").alias("won"), F.col("attempt").alias("attempt"))
    return rows.groupBy(key).agg(F.max_by("status", order).alias("status"), F.max_by("attempt", order).alias("attempt"))


def run_status(targets: DataFrame, outcomes: DataFrame, key: str) -> DataFrame:
    """complete when nothing failed and the done keys are exactly the targets."""
    counts = outcomes.agg(
        F.count_if(F.col("status") == "done").alias("done"), F.count_if(F.col("status") == "failed").alias("failed")
    )
    off = set_difference(targets, outcomes.filter(F.col("status") == "done"), key).agg(F.count(F.lit(1)).alias("open"))
    complete = (F.col("failed") == 0) & (F.col("open") == 0)
    return counts.crossJoin(off).withColumn("status", F.when(complete, "complete").otherwise("partial"))  # one row each


def check_contract(stored: dict[str, str], requested: dict[str, str]) -> None:
    """Refuse to resume a run under another model, prompt or mapping."""
    changed = sorted(k for k in stored.keys() | requested.keys() if stored.get(k) != requested.get(k))
    if changed:
        raise ValueError(f"the run was made with another {', '.join(changed)}")
