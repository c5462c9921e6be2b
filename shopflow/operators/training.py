"""Training sets: funnel statistics, sampling, splits, vocabularies, histories."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.functions import arrays
from shopflow.functions.hashing import sha_number, unit_interval
from shopflow.operators.asof import FeatureView, asof_join
from shopflow.operators.rolling import trailing_rows
from shopflow.plans.hot_keys import top_k
from shopflow.plans.joins import salted_join
from shopflow.plans.ordering import with_rank_in_group, with_row_number, with_running
from shopflow.plans.storage import materialize

HISTORY_TYPES = ["view", "cart", "purchase"]
POSITIVE_TYPES = ["cart", "purchase"]
HISTORY_FIELDS = {
    "hist_item_id": "product_id", "hist_event_type": "event_type_id", "hist_category": "category_id", "hist_brand": "brand_id",
    "hist_price_bucket": "price_bucket", "hist_time": "event_timestamp",
}


# Splits


def temporal_split(frame: DataFrame, order: list[str], train: float = 0.8, val: float = 0.1) -> DataFrame:
    """Rows in time order cut at int(n train) and int(n train) + int(n val)."""
    numbered = with_row_number(frame, *order, name="_place")
    total = numbered.agg(F.max("_place").alias("_n"))
    train_end = F.floor(F.col("_n") * F.lit(train))
    val_end = train_end + F.floor(F.col("_n") * F.lit(val))
    split = F.when(F.col("_place") <= train_end, "train").when(F.col("_place") <= val_end, "val").otherwise("test")
    return numbered.crossJoin(F.broadcast(total)).withColumn("split", split).drop("_place", "_n")  # one row


def group_temporal_split(frame: DataFrame, time: str, user: str, train: float = 0.8, val: float = 0.1) -> DataFrame:
    """Whole groups of (user, time) in time order; bounds int(n train) and int(n (train + val)) on groups.

    Only the groups are ordered. Their two border keys then place every row by comparison, so no row of
    a large group is joined or moved.
    """
    groups = with_row_number(frame.select(time, user).distinct(), time, user, name="_place")
    total = groups.agg(F.max("_place").alias("_n"))
    at = lambda share: F.floor(F.col("_n") * F.lit(share))
    borders = groups.crossJoin(F.broadcast(total)).agg(  # one row
        F.max(F.when(F.col("_place") <= at(train), F.struct(time, user))).alias("_train_last"),
        F.max(F.when(F.col("_place") <= at(train + val), F.struct(time, user))).alias("_val_last"),
    )
    key = F.struct(time, user)
    up_to = lambda border: F.coalesce(key <= F.col(border), F.lit(False))
    split = F.when(up_to("_train_last"), "train").when(up_to("_val_last"), "val").otherwise("test")
    return frame.crossJoin(F.broadcast(borders)).withColumn("split", split).drop("_train_last", "_val_last")  # one row


def equal_count_buckets(frame: DataFrame, value: str, tie_break: list[str], buckets: int = 10, name: str = "bucket") -> DataFrame:
    """Rank-based buckets of equal counts: rank r of n falls into max(ceil((r - 1) q / (n - 1)) - 1, 0)."""
    numbered = with_row_number(frame, value, *tie_break, name="_place")
    facts = numbered.agg(F.max("_place").alias("_n"), F.least(F.lit(buckets), F.count_distinct(value)).alias("_q"))
    place = F.ceil(F.try_divide((F.col("_place") - 1) * F.col("_q"), F.col("_n") - 1)) - 1
    bucket = F.greatest(F.coalesce(place, F.lit(0)), F.lit(0)).cast("int")
    return numbered.crossJoin(F.broadcast(facts)).withColumn(name, bucket).drop("_place", "_n", "_q")  # one row


# Rows


def canonical_entities(frame: DataFrame, key: str) -> DataFrame:
    """Entity rows under fixed names: product, timestamp, label (0 where missing), and a stable row id."""
    product = next((c for c in ("candidate_product_id", "target_item_id") if c in frame.columns), None)
    if product is None:
        raise ValueError("rows need candidate_product_id or target_item_id")
    if "prediction_timestamp" in frame.columns:
        stamp = F.col("prediction_timestamp").cast("timestamp")
    elif "event_time" in frame.columns:
        stamp = F.timestamp_seconds("event_time")
    else:
        raise ValueError("rows need prediction_timestamp or event_time")
    text = lambda c: (F.coalesce(F.col(c).cast("string"), F.lit("")) if c in frame.columns else F.lit("")).alias(c)
    label = F.coalesce(F.col("label").cast("int"), F.lit(0)) if "label" in frame.columns else F.lit(0)
    return frame.select(
        F.col(key).alias("row_id"), text("impression_id"), text("request_id"), "user_id", F.col(product).alias("product_id"),
        stamp.alias("event_timestamp"), label.alias("label"),
    )


def normalize_histories(frame: DataFrame, sequences: list[str], max_length: int) -> DataFrame:
    """All sequences cut to the same suffix and left-padded with 0 to the longest of them."""
    clean = frame
    for name in sequences:
        filled = F.coalesce(F.col(name), F.array().cast("array<bigint>")).cast("array<bigint>")
        clean = clean.withColumn(name, F.filter(filled, lambda x: x.isNotNull()))
    longest = F.greatest(*[F.size(c) for c in sequences]) if len(sequences) > 1 else F.size(sequences[0])
    clean = clean.withColumn("_length", F.least(longest, F.lit(max_length)))
    for name in sequences:
        padded = arrays.pad_left(arrays.last_n(F.col(name), F.col("_length")), F.col("_length"), F.lit(0).cast("bigint"))
        clean = clean.withColumn(name, padded)
    return clean.drop("_length")


def history_before(prediction: Column, stamps: Column, columns: dict[str, Column], max_length: int) -> Column:
    """Parallel arrays zipped, kept where they precede the prediction, cut to the newest entries."""
    zipped = F.arrays_zip(stamps.alias("at"), *[c.alias(n) for n, c in columns.items()])
    earlier = F.filter(zipped, lambda x: F.try_to_timestamp(x["at"]) < prediction)
    return arrays.last_n(F.coalesce(earlier, F.slice(zipped, 1, 0)), max_length)


def historical_training_rows(joined: DataFrame, max_length: int = 50) -> DataFrame:
    """Point-in-time joined features as model rows: earlier history only, five-minute recency, zero defaults.

    The times of the history are text or timestamps.
    """
    names = {
        "hist_item_id": "seq_hist_item_ids", "hist_event_type": "seq_hist_event_type_ids", "hist_category": "seq_hist_category_ids",
        "hist_brand": "seq_hist_brand_ids", "hist_price_bucket": "seq_hist_price_bucket_ids",
    }
    prediction = F.col("prediction_timestamp")
    renamed = joined.select(
        "*", F.col("seq_hist_event_timestamps").alias("at"), *[F.col(c).alias(n) for n, c in names.items()]
    )
    history = history_before(prediction, F.col("at"), {n: F.col(n) for n in names}, max_length)
    rows = renamed.withColumn("_history", history)
    empty = F.array().cast("array<int>")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("int")
    stamps = F.transform(F.col("_history")["at"], lambda t: F.try_to_timestamp(t))
    return rows.select(
        "impression_id", "request_id", "user_id",
        *[F.coalesce(F.col("_history")[n], empty).alias(n) for n in names],
        F.coalesce(arrays.recency_buckets(prediction, stamps), empty).alias("hist_time"),
        F.col("candidate_product_id").alias("target_item_id"), zero("item_category_id").alias("target_category"),
        zero("item_brand_id").alias("target_brand"), zero("item_price_bucket").alias("target_price_bucket"),
        F.unix_seconds(prediction).alias("event_time"), "label", zero("agg_views_30m").alias("views_30m"),
        zero("agg_carts_30m").alias("carts_30m"), zero("agg_purchases_24h").alias("purchases_24h"),
    )


def prior_histories(events: DataFrame, max_length: int = 20, min_length: int = 2) -> DataFrame:
    """Positive events with the user's earlier events, newest max_length of them, where there are enough."""
    step = F.struct(*[F.col(c).alias(n) for n, c in HISTORY_FIELDS.items()])
    known = events.filter(F.col("event_type").isin(*HISTORY_TYPES))
    rows = trailing_rows(known, ["user_id"], "event_timestamp", "event_id", step, max_length, "_history", include_current=False)
    chosen = rows.filter(F.col("event_type").isin(*POSITIVE_TYPES) & (F.size("_history") >= min_length))
    return chosen.select(*events.columns, *[F.col("_history")[n].alias(n) for n in HISTORY_FIELDS], F.size("_history").alias("hist_len"))


def normalized_clickstream(rows: DataFrame) -> DataFrame:
    """Model-ready values of history rows: unknown names filled, log price, recency classes."""
    unknown = lambda c, name: F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit(name))
    now = F.col("event_timestamp")
    price = F.coalesce(F.col("price").cast("double"), F.lit(0.0))
    return rows.select(
        "event_id", unknown("user_id", "UNK_USER").alias("user_id"), unknown("product_id", "UNK_ITEM").alias("target_item_id"),
        unknown("category_id", "UNK_CATEGORY").alias("target_category"), unknown("brand_id", "UNK_BRAND").alias("target_brand"),
        price.alias("target_price"), F.log1p(price).alias("target_price_log"), "price_bucket", "hist_len",
        *[F.transform(c, lambda x: F.coalesce(x.cast("string"), F.lit(u))).alias(c) for c, u in
          (("hist_item_id", "UNK_ITEM"), ("hist_category", "UNK_CATEGORY"), ("hist_brand", "UNK_BRAND"))],
        F.transform(
            "hist_time", lambda t: arrays.coarse_recency((F.unix_micros(now) - F.unix_micros(t)) / F.lit(1_000_000.0))
        ).alias("hist_time_bucket"),
    )


# Vocabularies


def vocabulary(values: DataFrame, column: str) -> DataFrame:
    """Distinct values in sorted order, numbered from 1."""
    distinct = values.select(F.col(column).cast("string").alias("value")).dropna().distinct()
    return with_row_number(distinct, "value", name="id")


def encode(frame: DataFrame, column: str, vocab: DataFrame) -> DataFrame:
    """Replace a column by its vocabulary id, 0 where unknown. A frequent value is spread over tasks."""
    keyed = frame.withColumn("value", F.col(column).cast("string"))
    return salted_join(keyed, vocab, ["value"]).withColumn(column, F.coalesce("id", F.lit(0))).drop("value", "id")


def encode_array(frame: DataFrame, key: str, column: str, vocab: DataFrame) -> DataFrame:
    """Replace the members of an array by their ids, order kept. An array is one row's worth of members."""
    members = frame.select(key, F.posexplode(F.col(column).cast("array<string>")).alias("_place", "value"))
    coded = salted_join(members, vocab, ["value"])
    lists = coded.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_place", F.coalesce("id", F.lit(0)).alias("id")))).alias("_l"))
    lists = lists.select(key, F.col("_l")["id"].alias("_ids"))
    return frame.join(lists, key, "left").withColumn(column, F.coalesce("_ids", F.array().cast("array<bigint>"))).drop("_ids")


# Statistics and sampling


def user_funnel_stats(events: DataFrame, user: str = "user_id", item: str = "product_id") -> DataFrame:
    """Events, distinct items and outcome flags per user, with the funnel bucket 2 purchase, 1 cart, 0 browse.

    Pairs of user and item combine first, so a user with a third of all events arrives as few rows.
    """
    flags = {kind: F.max((F.col("event_type") == kind).cast("int")) for kind in ("purchase", "cart", "view")}
    pairs = events.groupBy(user, item).agg(
        F.count(F.lit(1)).alias("n"), *[flag.alias(f"has_{kind}") for kind, flag in flags.items()]
    )
    stats = pairs.groupBy(user).agg(
        F.sum("n").alias("n_events"), F.count(F.lit(1)).alias("n_items"),
        *[F.max(f"has_{kind}").alias(f"has_{kind}") for kind in flags],
    )
    bucket = F.when(F.col("has_purchase") == 1, 2).when(F.col("has_cart") == 1, 1).otherwise(0)
    return stats.withColumn("bucket", bucket)


def item_popularity(events: DataFrame, item: str = "product_id") -> DataFrame:
    """Event count of each item and its first-seen metadata."""
    first = F.min(F.struct("event_timestamp", "event_id", "category_id", "brand_id", "price", "price_bucket"))
    counted = events.groupBy(item).agg(F.count(F.lit(1)).alias("n_events"), first.alias("_first"))
    return counted.select(item, "n_events", *[F.col(f"_first.{c}").alias(c) for c in ("category_id", "brand_id", "price", "price_bucket")])


def dataset_summary(events: DataFrame) -> DataFrame:
    """Size and purchase share of a sample."""
    users = user_funnel_stats(events).agg(F.count(F.lit(1)).alias("users"), F.avg("has_purchase").alias("purchase_users"))
    rows = events.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("product_id").alias("items"), F.count_distinct("session_id").alias("sessions"),
        F.count_distinct("category_id").alias("categories"),
        *[F.avg((F.col("event_type") == t).cast("double")).alias(f"{t}_share") for t in HISTORY_TYPES],
    )
    return rows.crossJoin(users)  # one row each


def top_categories(events: DataFrame, column: str, n: int) -> DataFrame:
    """Events of the n most frequent categories."""
    best = events.groupBy(column).agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), column).limit(n)
    return events.join(best.select(column), column, "left_semi")


def hash_order(column: str, seed: int) -> Column:
    return sha_number(F.concat(F.lit(f"{seed}:"), F.col(column).cast("string")))


def stratified_users(
    events: DataFrame, target_rows: int, ratios: dict[int, float], *, min_events: int = 1, min_items: int = 1, seed: int = 42
) -> DataFrame:
    """Users to keep for about target_rows events: shares per funnel bucket in hash order, then any users, then a trim.

    The trim keeps whole users and stops at the first one that would pass the target when 90 % are reached.
    """
    stats = user_funnel_stats(events).filter((F.col("n_events") >= min_events) & (F.col("n_items") >= min_items))
    stats = materialize(stats.select("user_id", "n_events", "bucket", hash_order("user_id", seed).alias("_h")), "users")
    sizes = {r["bucket"]: (r["n"], r["rows"]) for r in stats.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("n_events").alias("rows")).collect()}
    users, rows = sum(n for n, _ in sizes.values()), sum(r for _, r in sizes.values())
    wanted = int(target_rows / max(rows / users if users else 0, 1))
    take = {b: min(sizes.get(b, (0, 0))[0], int(wanted * share)) for b, share in ratios.items()}
    quota = F.lit(0)
    for b, n in take.items():
        quota = F.when(F.col("bucket") == b, n).otherwise(quota)
    placed = materialize(with_rank_in_group(stats, ["bucket"], ["_h", "user_id"], "_place").withColumn("_in", F.col("_place") <= quota), "placed")
    more = max(min(users - sum(take.values()), wanted - sum(take.values())), 0)
    chosen = placed.filter("_in").select("user_id", "n_events", "_h")
    if more:
        rest = with_row_number(placed.filter("not _in").select("user_id", "n_events", "_h"), "_h", "user_id", name="_place")
        chosen = chosen.unionByName(rest.filter(F.col("_place") <= more).drop("_place"))
    running = with_running(chosen, ["_h", "user_id"], {"_cum": ("sum", F.col("n_events"))})
    total = running.agg(F.sum("n_events").alias("_all"))
    over = (F.col("_cum") > target_rows) & (F.col("_cum") - F.col("n_events") > target_rows * 0.9)
    stop = running.agg(F.min(F.when(over, F.col("_cum"))).alias("_stop"))
    bounded = running.crossJoin(F.broadcast(total)).crossJoin(F.broadcast(stop))  # one row each
    fits = (F.col("_all") <= target_rows * 1.25) | F.col("_stop").isNull() | (F.col("_cum") < F.col("_stop"))
    return bounded.filter(fits).select("user_id")


def stratified_sample(events: DataFrame, target_rows: int, ratios: dict[int, float], **options) -> DataFrame:
    """All events of the chosen users."""
    return events.join(stratified_users(events, target_rows, ratios, **options), "user_id", "left_semi")


def popularity_intervals(items: DataFrame, item: str, alpha: float) -> tuple[DataFrame, int]:
    """Items as intervals of [0, 1) in proportion to count^alpha, cut into equal cells for lookup by equality.

    There are as many cells as items, so the pieces number at most twice the items, and a popular item
    spreads over its many cells.
    """
    weighted = items.select(item, F.pow(F.col("n_events").cast("double"), F.lit(alpha)).alias("_w"))
    running = with_running(weighted, [item], {"_cum": ("sum", F.col("_w"))})
    total = running.agg(F.max("_cum").alias("_all"))
    cells = items.count()
    low, high = (F.col("_cum") - F.col("_w")) / F.col("_all"), F.col("_cum") / F.col("_all")
    spans = running.crossJoin(F.broadcast(total)).select(item, low.alias("_low"), high.alias("_high"))  # one row
    at = lambda c: F.least(F.greatest(F.floor(F.col(c) * cells), F.lit(0)), F.lit(cells - 1))
    return spans.withColumn("_cell", F.explode(F.sequence(at("_low"), at("_high")))), cells


def negative_samples(
    events: DataFrame, k: int = 3, alpha: float = 0.75, *, min_history: int = 2, seed: int = 42, first_draws: int = 12
) -> DataFrame:
    """k unseen items per positive event, drawn with replacement in proportion to count^alpha.

    Draw number i of an event is fixed by a hash, so results do not depend on how the work is cut. Items
    the user met earlier and the positive itself are refused. Events that lack negatives draw again with
    twice the numbers until all are filled; events whose user has met every item get none.
    """
    known = events.filter(F.col("event_type").isin(*HISTORY_TYPES))
    positives = prior_histories(events, max(min_history, 1), min_history).select(
        F.col("event_id").alias("positive_id"), "user_id", F.col("product_id").alias("positive_item"), "event_timestamp"
    )
    positives = materialize(positives, "positives")
    items = materialize(item_popularity(events), "items")
    spans, cells = popularity_intervals(items, "product_id", alpha)
    spans = materialize(spans, "spans")
    first_seen = materialize(
        known.groupBy("user_id", "product_id").agg(F.min(F.struct("event_timestamp", "event_id")).alias("_first")), "seen"
    )
    open_positives, done, start, stop = _with_choice(positives, first_seen, cells), [], 0, first_draws
    while True:
        accepted = materialize(_draw(open_positives, spans, first_seen, cells, start, stop, seed), "draws")
        done.append(accepted)
        counts = _union(done).groupBy("positive_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= k)
        open_positives = materialize(positives_left(open_positives, counts), "open")
        if open_positives.isEmpty():
            break
        start, stop = stop, 2 * stop
    ranked = top_k(_union(done), ["positive_id"], [F.asc("draw")], k, "negative_rank")
    meta = items.select("product_id", "category_id", "brand_id", F.col("price").cast("double").alias("price"), "price_bucket")
    return salted_join(ranked.drop("draw").withColumnRenamed("negative_item", "product_id"), meta, ["product_id"])


def positives_left(open_positives: DataFrame, filled: DataFrame) -> DataFrame:
    return open_positives.join(filled.select("positive_id"), "positive_id", "left_anti")


def _with_choice(positives: DataFrame, first_seen: DataFrame, items: int) -> DataFrame:
    """Positives for which at least one item is still allowed."""
    met = first_seen.select("user_id", "product_id", F.col("_first.event_timestamp").alias("at"), F.col("_first.event_id").alias("id"))
    numbered = with_rank_in_group(met, ["user_id"], ["at", "id"], "n_seen").drop("product_id")
    joined = asof_join(
        positives, "event_timestamp", {"user_id": "user_id"}, [FeatureView(numbered, "met", "at", "id")], allow_equal=False
    )
    # Items first met at the very instant, but by an earlier event, count as well.
    tied = (
        positives.select("positive_id", "user_id", F.col("event_timestamp").alias("at"))
        .join(met.select("user_id", "at", "id"), ["user_id", "at"])
        .filter(F.col("id") < F.col("positive_id"))
        .groupBy("positive_id")
        .agg(F.count(F.lit(1)).alias("_tied"))
    )
    own = first_seen.select("user_id", F.col("product_id").alias("positive_item"), "_first")
    facts = joined.join(tied, "positive_id", "left").join(own, ["user_id", "positive_item"], "left")
    now = F.struct(F.col("event_timestamp"), F.col("positive_id").alias("event_id"))
    own_is_new = F.when(F.coalesce(F.col("_first") < now, F.lit(False)), 0).otherwise(1)
    forbidden = F.coalesce("met_n_seen", F.lit(0)) + F.coalesce("_tied", F.lit(0)) + own_is_new
    return materialize(facts.filter(forbidden < items).select(*positives.columns), "choice")


def _draw(positives: DataFrame, spans: DataFrame, first_seen: DataFrame, cells: int, start: int, stop: int, seed: int) -> DataFrame:
    key = F.concat_ws(":", F.lit(str(seed)), F.col("positive_id"), F.col("draw").cast("string"))
    draws = positives.withColumn("draw", F.explode(F.sequence(F.lit(start), F.lit(stop - 1)))).withColumn("_u", unit_interval(key))
    draws = draws.withColumn("_cell", F.floor(F.col("_u") * cells))
    hit = draws.join(spans, "_cell").filter((F.col("_u") >= F.col("_low")) & (F.col("_u") < F.col("_high")))
    hit = hit.filter(F.col("product_id") != F.col("positive_item")).drop("_u", "_cell", "_low", "_high")
    checked = salted_join(hit, first_seen, ["user_id", "product_id"])
    seen = F.col("_first") < F.struct(F.col("event_timestamp"), F.col("positive_id").alias("event_id"))
    return checked.filter(~F.coalesce(seen, F.lit(False))).select(
        "positive_id", "user_id", "draw", F.col("product_id").alias("negative_item")
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def history_label_join(features: DataFrame, labels: DataFrame, user: str = "user_id") -> DataFrame:
    """Feature history of labelled users, missing numbers as 0."""
    joined = features.join(labels, user)
    numbers = [f.name for f in joined.schema.fields if f.dataType.simpleString() in ("int", "bigint", "double", "float")]
    return joined.fillna(0, subset=numbers)
