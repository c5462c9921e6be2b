"""Documents, chunks, vectors, retrieval and file layout."""

from pyspark.sql import functions as F

from shopflow.functions.hashing import bucket
from shopflow.functions.text import dot, l2_norm
from shopflow.operators import chunking, layout, retrieval
from shopflow.plans.storage import materialize, scratch_path
from shopflow.queries.prelude import h
from shopflow.queries.registry import query

SENTENCES = r"""select doc_id, unnest(s) sentence, generate_subscripts(s, 1) pos
  from (select doc_id, list_filter(list_transform(string_split(regexp_replace(regexp_replace(text, '([.!?…])\s+', '\1' || chr(1), 'g'), '\n+', chr(1), 'g'), chr(1)),
    lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') s from documents)"""
BREAKS = {
    "sentence_rows": SENTENCES,
    "slots": f"""select doc_id, pos, slot, count(*) n from (select doc_id, pos, {h("w")} % 64 slot from (select doc_id, pos, unnest(string_split_regex(sentence, '\\s+')) w from sentence_rows) where w <> '') group by 1, 2, 3""",
    "sizes": "select doc_id, pos, sqrt(sum(n*n)) size from slots group by 1, 2",
    "neighbours": """select a.doc_id, a.pos, round(coalesce(d.dot, 0) / (a.size * b.size), 9) similarity from sizes a join sizes b on b.doc_id = a.doc_id and b.pos = a.pos + 1
      left join (select x.doc_id, x.pos, sum(x.n * y.n) dot from slots x join slots y on y.doc_id = x.doc_id and y.pos = x.pos + 1 and y.slot = x.slot group by 1, 2) d on d.doc_id = a.doc_id and d.pos = a.pos""",
    "limits": "select doc_id, round(quantile_cont(similarity, 0.2), 9) lim from neighbours group by 1",
}


@query(
    "e12_semantic_breaks",
    "select d.doc_id, coalesce(b.breaks, '') breaks from documents d left join (select doc_id, string_agg(pos::varchar, ',' order by pos) breaks from neighbours join limits using (doc_id) where similarity <= lim group by 1) b using (doc_id)",
    BREAKS,
)
def semantic_breaks(shop):
    rows = chunking.break_positions(shop.documents, "doc_id", "text")
    return rows.select("doc_id", F.concat_ws(",", F.col("breaks").cast("array<string>")).alias("breaks"))


def document_units(shop):
    """Every document text and every turn as a section, with its product where one has the same number.

    A user turn and the assistant turn right behind it are one question-answer pair. Other turns are sections of their own:
    open questions, answers without a question, and notes of any other role. Blank sections carry a reject reason.
    """
    product = shop.products.select(
        F.col("product_id").alias("item_id"), F.col("product_name").alias("title"), F.col("brand_name").alias("brand"),
        F.col("category_code").alias("category_l1"), F.col("price_bucket").cast("string").alias("category_l2"), F.lit("").alias("category_l3"),
    )
    overview = shop.documents.select(
        F.col("doc_id").alias("item_id"), F.lit("product_overview").alias("chunk_type"), F.lit("overview").alias("source_key"), "text"
    )
    turns = shop.conversations.select("conv_id", "turn", "role", "text")
    after = turns.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    before = turns.filter("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.lit(True).alias("asked"))
    user = turns.filter("role = 'user'").join(after, ["conv_id", "turn"], "left")
    answers = turns.filter("role = 'assistant'").join(before, ["conv_id", "turn"], "left_anti")
    notes = turns.filter("role is null or role not in ('user', 'assistant')")

    def sections(frame, kind, text):
        key = F.concat(kind, F.lit("_"), F.lpad(F.col("turn").cast("string"), 2, "0"))
        return frame.select(F.col("conv_id").alias("item_id"), kind.alias("chunk_type"), key.alias("source_key"), text.alias("text"))

    question = F.concat(F.lit(chunking.QUESTION), "text")
    pair = F.when(F.col("answer").isNull(), question).otherwise(F.concat(question, F.lit("\n" + chunking.ANSWER), "answer"))
    units = (
        overview.unionByName(sections(user, F.when(F.col("answer").isNull(), "question").otherwise("qna"), pair))
        .unionByName(sections(answers, F.lit("answer"), F.concat(F.lit(chunking.ANSWER), "text")))
        .unionByName(sections(notes, F.lit("note"), F.col("text")))
    )
    known = units.join(product, "item_id", "left").fillna("", ["title", "brand", "category_l1", "category_l2", "category_l3"])
    blank = F.coalesce(F.trim("text"), F.lit("")) == ""
    return known.withColumn("reject_reason", F.when(blank, "blank_text"))


LIMITS = chunking.ChunkLimits()


@query("k26_document_chunks")
def chunks(shop):
    rows = chunking.chunk_units(document_units(shop).filter("reject_reason is null").drop("reject_reason"), limits=LIMITS)
    rows = rows.select("chunk_id", "item_id", "chunk_type", "source_key", "section_hash", "chunk_index", "token_count", "content_hash")
    rows = chunking.with_lineage(materialize(rows, "chunks"), "run-1", "2024-06-01 00:00:00")
    return rows.select(
        "chunk_id", "item_id", "chunk_type", "chunk_index", "token_count", "content_hash", "item_content_hash", "source_run_id", "event_timestamp"
    )


UNITS = {
    "turns": """select conv_id item_id, turn, role, text, lead(role) over w next_role, lag(role) over w prev_role, lead(turn) over w = turn + 1 near_next, lag(turn) over w = turn - 1 near_prev, lead(text) over w next_text
      from conversations window w as (partition by conv_id order by turn)""",
    "turn_sections": """select item_id, turn, text, case when role = 'user' and near_next and next_role = 'assistant' then 'qna' when role = 'user' then 'question' when role = 'assistant' then 'answer' else 'note' end kind, next_text
      from turns where not (role = 'assistant' and coalesce(near_prev and prev_role = 'user', false))""",
    "units": """select u.*, coalesce(p.product_name, '') title, coalesce(p.brand_name, '') brand, case when trim(coalesce(text, '')) = '' then 'blank_text' end reject_reason from (
        select doc_id item_id, 'product_overview' chunk_type, 'overview' source_key, text from documents union all
        select item_id, kind, kind||'_'||lpad(turn::varchar, 2, '0'), case kind when 'qna' then 'Hỏi: '||text||chr(10)||'Đáp: '||next_text when 'question' then 'Hỏi: '||text when 'answer' then 'Đáp: '||text else text end from turn_sections) u
      left join products p on p.product_id = u.item_id""",
}


@query(
    "k26_chunked_sections",
    "select item_id, chunk_type, source_key, 'sha256:'||sha256(string_agg(chunk_type||':'||source_key||':'||sha256(text), '|' order by chunk_type, source_key, sha256(text)) over (partition by item_id)) item_content_hash, true complete, 0::bigint repeated_ids from units where reject_reason is null",
    UNITS,
)
def chunked_sections(shop):
    """Every section that is not rejected: whether its chunks hold its first and last word, the item's hash, repeated chunk ids."""
    units = document_units(shop).filter("reject_reason is null").drop("reject_reason")
    keys = ["item_id", "chunk_type", "source_key"]
    chunks = chunking.chunk_units(units, limits=LIMITS).select(*keys, "section_hash", "chunk_index", "chunk_id", "text")
    chunks = chunking.with_lineage(materialize(chunks, "chunks"), "run-1", "2024-06-01 00:00:00")
    one = F.struct("chunk_index", "text")
    ends = chunks.groupBy(*keys).agg(
        F.min(one).alias("low"), F.max(one).alias("high"), F.first("item_content_hash").alias("item_content_hash"),
        (F.count(F.lit(1)) - F.count_distinct("chunk_id")).alias("repeated_ids"),
    )
    word = lambda text, at: F.element_at(F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " "), at)
    joined = units.join(ends, keys, "left")
    complete = (word(F.col("low.text"), 1) == word(F.col("text"), 1)) & F.endswith(word(F.col("text"), -1), word(F.col("high.text"), -1))
    return joined.select(*keys, "item_content_hash", F.coalesce(complete, F.lit(False)).alias("complete"), "repeated_ids")


@query("k26_source_units", "select item_id, chunk_type, source_key, title, brand, sha256(text) text_hash, reject_reason from units", UNITS)
def units(shop):
    """All sections; the number of turns and documents that they cover is the number in the tables."""
    return document_units(shop).select("item_id", "chunk_type", "source_key", "title", "brand", F.sha2("text", 256).alias("text_hash"), "reject_reason")


VECTORS = {
    "word_slots": f"""select doc_id, slot, count(*) n from (select doc_id, {h("w")} % 64 slot from (select doc_id, unnest(string_split_regex(text, '\\s+')) w from documents) where w <> '') group by 1, 2""",
}


@query(
    "k27_embedded_documents",
    """select doc_id, round(sum(n) / sqrt(sum(n*n)), 4) total, round(max(n) / sqrt(sum(n*n)), 4) largest, any_value(sha) embedding_checksum
    from word_slots join (select doc_id, sha256('64|'||text) sha from documents) using (doc_id) group by 1""",
    VECTORS,
)
def embedded(shop):
    rows = chunking.embed(shop.documents.select("doc_id", "text"), "text")
    total = F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x.cast("double"))
    return rows.select(
        "doc_id", F.round(total, 4).alias("total"), F.round(F.array_max("embedding").cast("double"), 4).alias("largest"), "embedding_checksum"
    )


CORPUS = {
    "corpus": """select 'vec-'||vec_id chunk_id, vec_id // 3 item_id, label, embedding::double[] embedding, (40 + (vec_id // 3) % 10) / 10.0::double average_rating, coalesce(p.is_active, false) in_stock,
        p.current_price::double current_price, p.brand_name brand, p.category_code category_l1, case vec_id % 2 when 0 then 'review' else 'qna' end chunk_type
      from embeddings left join products p on p.product_id = vec_id // 3""",
    "queries": """select label query_id, list(x order by place) q from (select label, place, avg(x) x from (select label, unnest(embedding)::double x, generate_subscripts(embedding, 1) place from embeddings) group by 1, 2) group by 1""",
    "scored": "select query_id, chunk_id, item_id, average_rating, label, round(list_dot_product(embedding, q), 6) score from corpus, queries where in_stock and current_price between 900 and 1100",
    "best": "select *, (row_number() over (partition by query_id order by score desc, average_rating desc, item_id))::int as rank from (select query_id, item_id, max(score) score, max(average_rating) average_rating from scored group by 1, 2)",
    "found": "select * from best where rank <= 10",
    "truth": "select distinct label query_id, item_id from corpus where in_stock and current_price between 900 and 1100",
}


def corpus(shop):
    item = F.floor(F.col("vec_id") / 3)
    product = shop.products.select(
        F.col("product_id").alias("item_id"), F.col("is_active").alias("in_stock"), F.col("current_price").cast("double").alias("current_price"),
        F.col("brand_name").alias("brand"), F.col("category_code").alias("category_l1"),
    )
    vectors = shop.embeddings.select(
        F.concat(F.lit("vec-"), F.col("vec_id").cast("string")).alias("chunk_id"), item.alias("item_id"), "label", "embedding",
        ((F.lit(40) + F.pmod(item, F.lit(10))) / F.lit(10.0)).alias("average_rating"),
        F.when(F.pmod("vec_id", F.lit(2)) == 0, "review").otherwise("qna").alias("chunk_type"),
    )
    # A vector whose item is no product stays; it is in no stock and has no price, so only the filters leave it out.
    return vectors.join(product, "item_id", "left").withColumn("in_stock", F.coalesce("in_stock", F.lit(False)))


RULE = dict(min_price=900, max_price=1100, in_stock=True)


def label_queries(shop):
    return retrieval.centroids(shop.embeddings, "label", "embedding").withColumnRenamed("label", "query_id")


def retrieved(shop):
    return retrieval.best_items(corpus(shop).filter(retrieval.matches(**RULE)), label_queries(shop), "query_id", 10)


@query("h23_similarity_and_norm", "select vec_id, round(list_dot_product(embedding::double[], q), 6) similarity, round(sqrt(list_dot_product(embedding::double[], embedding::double[])), 6) norm from embeddings join queries on query_id = label", CORPUS)
def similarity(shop):
    joined = shop.embeddings.join(label_queries(shop).withColumnRenamed("query_id", "label").withColumnRenamed("embedding", "q"), "label")
    return joined.select("vec_id", F.round(dot(F.col("embedding"), F.col("q")), 6).alias("similarity"), F.round(l2_norm(F.col("embedding")), 6).alias("norm"))


@query(
    "b12_hard_filters",
    "select chunk_id, item_id, brand from corpus where lower(brand) in ('brand#1','brand#2','brand#3','brand#17') and category_l1 in ('cat.economy') and current_price between 900 and 1100 and in_stock and chunk_type = 'review'",
    CORPUS,
)
def hard_filters(shop):
    rule = retrieval.matches(
        brands=["BRAND#1", "brand#2", "Brand#3", "brand#17"], category_prefix=["cat.economy"], chunk_types=["review"], **RULE
    )
    return corpus(shop).filter(rule).select("chunk_id", "item_id", "brand")


@query(
    "k29_f10_retrieval",
    """select query_id, rank item_rank, item_id, item_score, average_rating, evidence_rank, chunk_id, score from (
      select f.query_id, f.rank, f.item_id, f.score item_score, f.average_rating, s.chunk_id, s.score,
        (row_number() over (partition by f.query_id, f.item_id order by s.score desc, s.chunk_id))::int evidence_rank
      from found f join scored s on s.query_id = f.query_id and s.item_id = f.item_id) where evidence_rank <= 2""",
    CORPUS,
)
def retrieval_rows(shop):
    return retrieval.retrieve(corpus(shop), label_queries(shop), "query_id", 10, retrieval.matches(**RULE))


@query(
    "k30_retrieval_evaluation",
    """select t.query_id, count(*) relevant, count(f.item_id) found, 0::bigint duplicates, 0::bigint violations, count(f.item_id) / count(*)::double recall_at_10
    from truth t left join found f on f.query_id = t.query_id and f.item_id = t.item_id group by 1""",
    CORPUS,
)
def evaluation(shop):
    allowed = corpus(shop).filter(retrieval.matches(**RULE))
    facts = allowed.select("item_id", "in_stock", "current_price").distinct()
    results = retrieved(shop).join(facts, "item_id")
    truth = allowed.select(F.col("label").alias("query_id"), "item_id")
    return retrieval.evaluate(results, truth, "query_id", 10, (F.col("current_price") <= 1100) & F.col("in_stock"))


@query(
    "k30_release_report",
    """select (select count(*) from truth_counts) query_count, round((select avg(r) from truth_counts), 8) recall, 0::bigint duplicates, 0::bigint violations,
      (select quantile_disc(latency_seconds, 0.95) * 1000.0 from predictions) p95_ms, 'failed' status""",
    {**CORPUS, "truth_counts": "select t.query_id, count(f.item_id) / count(*)::double r from truth t left join found f on f.query_id = t.query_id and f.item_id = t.item_id group by 1"},
)
def release(shop):
    latencies = shop.predictions.select((F.col("latency_seconds") * 1000.0).alias("latency_ms"))
    row = retrieval.evaluation_report(evaluation(shop), latencies)
    return row.withColumn("recall", F.round("recall", 8)).select("query_count", "recall", "duplicates", "violations", "p95_ms", "status")


INDEX = {
    "old_chunks": f"""select doc_id item_id, case when {h("'edit:'||doc_id")} % 100 < 10 then 'old-'||doc_id else sha256(text) end item_hash, doc_id||':overview:0' chunk_id from documents""",
    "new_chunks": "select doc_id item_id, sha256(text) item_hash, doc_id||':overview:0' chunk_id from documents",
}


def index_states(shop):
    current = shop.documents.select(
        F.col("doc_id").alias("item_id"), F.sha2("text", 256).alias("item_hash"), F.concat(F.col("doc_id").cast("string"), F.lit(":overview:0")).alias("chunk_id")
    )
    number = F.col("item_id").cast("string")
    edited = bucket(F.concat(F.lit("edit:"), number)) < 10
    return current.withColumn("item_hash", F.when(edited, F.concat(F.lit("old-"), number)).otherwise(F.col("item_hash"))), current


@query(
    "k28_incremental_index",
    "select item_id, chunk_id, 'incremental' as mode, 'safe_native_upsert' reason from new_chunks n where not exists (select 1 from old_chunks o where o.item_id = n.item_id and o.item_hash = n.item_hash)",
    INDEX,
)
def incremental_index(shop):
    previous, current = index_states(shop)
    mode, reason, rows = retrieval.publish_decision(previous, current)
    return rows.select("item_id", "chunk_id", F.lit(mode).alias("mode"), F.lit(reason).alias("reason"))


@query("k28_rebuild_on_deletion", f"""select item_id, chunk_id, 'reconcile' as mode, 'deleted_item_or_chunk_shrink' reason from new_chunks where {h("'gone:'||item_id")} % 100 >= 5""", INDEX)
def rebuilt_index(shop):
    previous, current = index_states(shop)
    left = current.filter(bucket(F.concat(F.lit("gone:"), F.col("item_id").cast("string"))) >= 5)
    mode, reason, rows = retrieval.publish_decision(previous, left)
    return rows.select("item_id", "chunk_id", F.lit(mode).alias("mode"), F.lit(reason).alias("reason"))


@query(
    "k32_index_validation",
    """select 'missing_ids' check_name, count(*) violations, case when count(*) = 0 then 'SUCCESS' else 'FAILED' end status from corpus where label = 0
    union all select 'unexpected_ids', 0, 'SUCCESS' union all select 'wrong_dimension', 0, 'SUCCESS' union all select 'not_finite', 0, 'SUCCESS'
    union all select 'not_normalized', count(*) filter (abs(sqrt(list_dot_product(embedding, embedding)) - 1) > 0.01), case when count(*) filter (abs(sqrt(list_dot_product(embedding, embedding)) - 1) > 0.01) = 0 then 'SUCCESS' else 'FAILED' end from corpus where label <> 0
    union all select 'repeated_ids', 0, 'SUCCESS'""",
    CORPUS,
)
def index_validation(shop):
    """An index that lacks one label's chunks fails on missing ids."""
    return retrieval.validate_index(corpus(shop), corpus(shop).filter("label <> 0"), 64)


RUN = {
    "tried": f"""select doc_id, case when {h("'t1:'||doc_id")} % 100 < 80 then 'done' else 'failed' end one, case when {h("'t2:'||doc_id")} % 100 < 50 then 'done' else 'failed' end two from documents""",
}


def run_outcomes(shop):
    """A first attempt over all documents, then a second one over those not done."""
    status = lambda n, share: F.when(bucket(F.concat(F.lit(f"t{n}:"), F.col("doc_id").cast("string"))) < share, "done").otherwise("failed")
    targets = shop.documents.select("doc_id")
    first = targets.withColumn("status", status(1, 80)).withColumn("attempt", F.lit(1))
    todo = retrieval.pending(targets, first.filter("status = 'done'"), "doc_id")
    second = todo.withColumn("status", status(2, 50)).withColumn("attempt", F.lit(2))
    return targets, retrieval.record_outcomes(first, second, "doc_id")


@query("k37_resumed_outcomes", "select doc_id, case when one = 'done' then 'done' else two end status, case when one = 'done' then 1 else 2 end attempt from tried", RUN)
def resumed(shop):
    return run_outcomes(shop)[1]


@query(
    "k37_run_status",
    """select count(*) filter (one = 'done' or two = 'done') done, count(*) filter (one <> 'done' and two <> 'done') failed,
      count(*) filter (one <> 'done' and two <> 'done') as open, case when count(*) filter (one <> 'done' and two <> 'done') = 0 then 'complete' else 'partial' end status from tried""",
    RUN,
)
def run_status(shop):
    return retrieval.run_status(*run_outcomes(shop), "doc_id")


@query(
    "k31_composed_documents",
    """select d.doc_id item_id, upper(replace(brand_name, '#', '-'))||'-'||upper(replace(category_code, '.', '-'))||'-'||doc_id sku, brand_name brand, 'shop > '||category_code category_path,
      current_price::double current_price, is_active in_stock, doc_id % 91 + 10 stock_quantity, (40 + doc_id % 10) / 10.0::double average_rating, sha256(d.text) description_hash
    from documents d join products p on p.product_id = d.doc_id where category_code <> 'cat.promo'""",
)
def composed(shop):
    categories = shop.products.select("category_code").distinct().filter("category_code <> 'cat.promo'").withColumn(
        "category_path", F.array(F.lit("shop"), "category_code")
    )
    texts = shop.documents.select(F.col("doc_id").alias("product_id"), F.lit("").alias("title"), F.col("text").alias("description"))
    rows, _ = chunking.compose_documents(shop.products, texts, categories)
    meta = F.col("structured_metadata")
    return rows.select(
        "item_id", "sku", meta["brand"].alias("brand"), F.array_join(meta["category_path"], " > ").alias("category_path"),
        meta["current_price"].cast("double").alias("current_price"), meta["in_stock"].alias("in_stock"), meta["stock_quantity"].alias("stock_quantity"),
        F.col("reviews_and_qna.average_rating").alias("average_rating"), F.sha2("unstructured_text.description", 256).alias("description_hash"),
    )


@query("k21_compaction")
def compaction(shop):
    source, target = scratch_path(shop.spark, "small"), scratch_path(shop.spark, "packed")
    shop.table("lineitem").repartition(16).write.parquet(source)
    return layout.compact(shop.spark, source, target).select("phase", "file_count", "total_size_bytes", "avg_file_size_bytes")


@query("k21_clustered_rows", "select l_orderkey, l_partkey, l_linenumber, l_extendedprice from lineitem")
def clustered(shop):
    source, target = scratch_path(shop.spark, "plain"), scratch_path(shop.spark, "zorder")
    shop.table("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice").repartition(8).write.parquet(source)
    layout.compact(shop.spark, source, target, target_bytes=500_000, cluster_by=["l_orderkey", "l_partkey"])
    return shop.spark.read.parquet(target)


BOX = {c: f"{c} between min_{c} + (max_{c} - min_{c}) // 5 and min_{c} + (max_{c} - min_{c}) // 4" for c in ("l_orderkey", "l_partkey")}


@query(
    "k21_range_pruning",
    f"""select phase, matching_rows, phase = 'after' as most_files_skipped from (values ('before'), ('after')) p(phase),
      (select count(*) as matching_rows from lineitem, ends where {BOX["l_orderkey"]} and {BOX["l_partkey"]})""",
    {"ends": "select min(l_orderkey) min_l_orderkey, max(l_orderkey) max_l_orderkey, min(l_partkey) min_l_partkey, max(l_partkey) max_l_partkey from lineitem"},
)
def range_pruning(shop):
    """What a range of two columns reads before and after clustering: its rows, and whether most files are ruled out."""
    source, target = scratch_path(shop.spark, "plain"), scratch_path(shop.spark, "zorder")
    columns = ["l_orderkey", "l_partkey"]
    shop.table("lineitem").repartition(16).write.parquet(source)
    stored = shop.spark.read.parquet(source)
    total = layout.file_metrics(stored).first()["total_size_bytes"]
    layout.compact(shop.spark, source, target, target_bytes=max(total // 16, 1), cluster_by=columns)
    ends = stored.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]).first()
    spans = {c: (ends[f"min_{c}"], ends[f"max_{c}"] - ends[f"min_{c}"]) for c in columns}
    box = {c: (low + span // 5, low + span // 4) for c, (low, span) in spans.items()}
    parts = []
    for phase, frame in (("before", stored), ("after", shop.spark.read.parquet(target))):
        files = layout.pruned_files(frame, box)
        inside = frame.filter(F.col(columns[0]).between(*box[columns[0]]) & F.col(columns[1]).between(*box[columns[1]]))
        facts = files.crossJoin(inside.agg(F.count(F.lit(1)).alias("matching_rows")))  # one row each
        most = F.col("skipped_files") * 2 > F.col("files")
        parts.append(facts.select(F.lit(phase).alias("phase"), "matching_rows", most.alias("most_files_skipped")))
    return parts[0].unionByName(parts[1])


@query("k34_salted_counts", "select product_id, count(*) as rows from behavior_events group by 1")
def salted(shop):
    return layout.salted_counts(shop.behavior_events.select("event_id", "product_id"), "product_id")


@query("k34_partition_load")
def load(shop):
    rows = shop.behavior_events.select("event_id", "event_type")
    plain = layout.partition_load(rows, "event_type", 8).withColumn("salts", F.lit(1))
    return plain.unionByName(layout.partition_load(rows, "event_type", 8, 8).withColumn("salts", F.lit(8)))
