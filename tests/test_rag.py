"""Chunking, embedding, retrieval, index upkeep, file layout."""

import pathlib
import sys

import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F

from shopflow.operators import chunking, layout, retrieval
from shopflow.operators.chunking import ChunkLimits, HashingEncoder

ENCODER = HashingEncoder()
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_short_text_stays_whole():
    assert chunking.pack("one two. three", ENCODER, ChunkLimits(target=8, least=3, most=12, overlap=2)) == ["one two. three"]


def test_sentences_are_packed_within_the_limits():
    text = "One two three four. Five six seven eight. Nine ten eleven twelve. Thirteen fourteen fifteen."
    parts = chunking.pack(text, ENCODER, ChunkLimits(target=8, least=3, most=12, overlap=2))
    assert len(parts) >= 2 and all(len(p.split()) <= 12 for p in parts)
    assert chunking.pack(text, ENCODER, ChunkLimits(target=8, least=3, most=12, overlap=2)) == parts


def test_text_without_sentences_is_cut_by_words():
    words = [f"w{i}" for i in range(18)]
    parts = chunking.pack(" ".join(words), ENCODER, ChunkLimits(target=5, least=2, most=6, overlap=1))
    assert len(parts) > 2 and all(len(p.split()) <= 6 for p in parts)
    assert {w for p in parts for w in p.split()} == set(words)


def test_long_sentences_are_cut_and_whole():
    words = [f"w{i}" for i in range(30)]
    text = "Short one. " + " ".join(words) + ". Last words here."
    parts = chunking.pack(text, ENCODER, ChunkLimits(target=6, least=2, most=8, overlap=3))
    assert all(len(p.split()) <= 8 for p in parts)
    assert {w.strip(".") for p in parts for w in p.split()} == {w.strip(".") for w in text.split()}


def test_overlap_repeats_the_last_sentence():
    text = "a1 a2 a3 a4. b1 b2. c1 c2 c3 c4 c5. d1 d2 d3 d4 d5."
    parts = chunking.pack(text, ENCODER, ChunkLimits(target=6, least=6, most=9, overlap=2))
    for before, after in zip(parts, parts[1:]):
        tail = chunking.split_sentences(before)[-1]
        if len(tail.split()) <= 2:
            assert after.startswith(tail)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("red blue green shoe box sun".split()), min_size=1, max_size=7), min_size=1, max_size=25), st.integers(4, 12), st.integers(0, 3))
def test_no_word_is_lost(sentences, target, overlap):
    text = " ".join(" ".join(s) + "." for s in sentences)
    limits = ChunkLimits(target=target, least=2, most=target + 12, overlap=overlap)
    parts = chunking.pack(text, ENCODER, limits)
    assert all(len(p.split()) <= limits.most for p in parts)
    # Dropping the sentences each chunk repeats from the one before gives back the text.
    if len(parts) > 1:
        rebuilt = chunking.split_sentences(parts[0])
        for part in parts[1:]:
            found = chunking.split_sentences(part)
            repeated = next(n for n in range(len(found), -1, -1) if rebuilt[len(rebuilt) - n :] == found[:n] and len(" ".join(found[:n]).split()) <= overlap)
            rebuilt += found[repeated:]
        assert len(rebuilt) <= len(chunking.split_sentences(text)) and rebuilt[-1] == chunking.split_sentences(text)[-1]


def test_encoder_gives_unit_vectors():
    vectors = ENCODER.encode(["red shoe", "red shoe red", ""])
    assert np.allclose(np.linalg.norm(vectors, axis=1), [1, 1, 0]) and vectors[0] @ vectors[1] > 0.9


def items(spark):
    schema = (
        "item_id bigint, title string, description string, specifications map<string,string>, usage_instructions string,"
        " reviews array<struct<review_id:string,content:string>>, qna_pairs array<struct<question:string,answer:string>>,"
        " brand string, category_l1 string, category_l2 string, category_l3 string"
    )
    data = [
        (1, "Shoe", "A red shoe.", {"size": "42", "colour": "red"}, "  ", [("r1", "Good. Very good.")], [("Does it fit?", "Yes."), ("Red?", "Yes.")], "Acme", "wear", "shoes", ""),
    ]
    return spark.createDataFrame(data, schema)


def test_source_units_and_chunk_ids(spark):
    units = chunking.source_units(items(spark))
    found = {r["source_key"]: r["text"] for r in units.collect()}
    assert found == {
        "overview": "Shoe\nA red shoe.", "specifications": "colour: red\nsize: 42", "r1": "Good. Very good.",
        "qna_01": "Hỏi: Does it fit?\nĐáp: Yes.", "qna_02": "Hỏi: Red?\nĐáp: Yes.",
    }
    chunks = chunking.chunk_units(units, limits=ChunkLimits(target=6, least=2, most=40, overlap=1)).collect()
    assert {c["chunk_id"] for c in chunks} >= {"1:product_overview:overview:0", "1:qna:qna_02:0"}
    start = "passage: Tiêu đề: Shoe. Thương hiệu: Acme. Danh mục: wear > shoes.\n"
    assert all(c["embedding_text"] == start + c["text"] and c["token_count"] == len(c["embedding_text"].split()) for c in chunks)
    with pytest.raises(Exception, match="too few tokens"):
        chunking.chunk_units(units, limits=ChunkLimits(target=6, least=10, most=12, overlap=1)).collect()


class Letters(HashingEncoder):
    def token_count(self, text):
        return len(text.replace(" ", ""))


def test_word_beyond_the_hard_limit_is_halved():
    parts = chunking.pack("x" * 100 + " y. " + "z" * 9 + ".", Letters(), ChunkLimits(target=8, least=3, most=12, overlap=0))
    assert all(Letters().token_count(p) <= 12 for p in parts)
    assert "".join(parts).replace(" ", "") == "x" * 100 + "y." + "z" * 9 + "."


class SmallBatches(HashingEncoder):
    """Refuses batches above two texts, as a model short of memory does."""

    def encode(self, texts):
        if len(texts) > 2:
            raise MemoryError
        return super().encode(texts)


class Skewed(HashingEncoder):
    def encode(self, texts):
        return super().encode(texts) * 3


def test_embedding(spark):
    frame = spark.createDataFrame([(i, f"word{i} red") for i in range(5)], "id int, t string").coalesce(1)
    out = chunking.embed(frame, "t", SmallBatches(), batch_sizes=(4, 2)).collect()
    assert len(out) == 5 and all(abs(np.linalg.norm(r["embedding"]) - 1) < 1e-5 for r in out)
    with pytest.raises(Exception, match="not normalized"):
        chunking.embed(frame, "t", Skewed()).collect()


def candidates(spark):
    schema = "item_id bigint, chunk_id string, embedding array<float>, average_rating double, in_stock boolean, brand string, category_l1 string, category_l2 string, current_price double, chunk_type string"
    meta = ("Sony", "audio", "headphones", 20.0, "review")
    data = [
        (2, "2:a", [0.9, 0.0], 4.6, True, *meta), (1, "1:a", [0.9, 0.0], 4.8, True, *meta), (1, "1:b", [0.8, 0.0], 4.8, True, *meta),
        (1, "1:c", [0.7, 0.0], 4.8, True, *meta), (3, "3:a", [0.99, 0.0], 5.0, False, *meta),
    ]
    return spark.createDataFrame(data, schema)


def test_retrieval_groups_and_breaks_ties(spark):
    query = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, embedding array<double>")
    out = retrieval.retrieve(candidates(spark), query, "query_id", 2, retrieval.matches(in_stock=True))
    got = [(r["item_id"], r["chunk_id"], r["score"]) for r in out.orderBy("item_rank", "evidence_rank").collect()]
    assert got == [(1, "1:a", 0.9), (1, "1:b", 0.8), (2, "2:a", 0.9)]


def test_retrieval_in_slices_matches_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(3)
    vectors, asked = rng.normal(size=(60, 8)), rng.normal(size=(9, 8))
    chunks = spark.createDataFrame([(i // 2, f"c{i}", v.tolist(), float(i % 3)) for i, v in enumerate(vectors)], "item_id bigint, chunk_id string, embedding array<double>, average_rating double").repartition(5)
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "query_id bigint, embedding array<double>")
    monkeypatch.setattr(retrieval, "QUERIES_PER_PASS", 4)
    got = {(r["query_id"], r["rank"]): r["item_id"] for r in retrieval.best_items(chunks, queries, "query_id", 5).collect()}
    for q, v in enumerate(asked):
        best = {}
        for i, x in enumerate(vectors):
            best[i // 2] = max(best.get(i // 2, -9.0), round(float(x @ v), 6))
        expect = sorted(best, key=lambda item: (-best[item], item))[:5]
        assert [got[q, place] for place in range(1, 6)] == expect


@pytest.mark.parametrize(
    "rule,kept",
    [
        (dict(brands=["Bose"]), 0), (dict(category_prefix=["video"]), 0), (dict(min_price=30), 0), (dict(max_price=10), 0),
        (dict(in_stock=False), 1), (dict(chunk_types=["qna"]), 0), (dict(brands=["sony"], category_prefix=["audio", "headphones"]), 5), ({}, 5),
    ],
)
def test_hard_filters(spark, rule, kept):
    assert candidates(spark).filter(retrieval.matches(**rule)).count() == kept


def test_evaluation(spark):
    truth = spark.createDataFrame([("q", i) for i in (1, 2, 3, 4)] + [("p", 9)], "query_id string, item_id bigint")
    results = spark.createDataFrame([("q", 1, True), ("q", 1, True), ("q", 7, False)], "query_id string, item_id bigint, in_stock boolean")
    per_query = retrieval.evaluate(results, truth, "query_id", 10, F.col("in_stock"))
    assert rows(per_query.select("query_id", "found", "duplicates", "violations", "recall_at_10")) == [("p", 0, 0, 0, 0.0), ("q", 1, 1, 1, 0.25)]
    slow = spark.createDataFrame([(float(v),) for v in range(1, 101)], "latency_ms double")
    report = retrieval.evaluation_report(per_query, slow).collect()[0]
    assert report["p95_ms"] == 95.0 and report["status"] == "failed" and report["recall"] == 0.125


def index(spark, data):
    return spark.createDataFrame(data, "item_id bigint, item_hash string, chunk_id string")


def test_publish_decision(spark):
    old = index(spark, [(1, "a", "1:0"), (1, "a", "1:1"), (2, "b", "2:0")])
    decide = lambda new, **options: retrieval.publish_decision(old, index(spark, new), **options)
    assert retrieval.publish_decision(None, old)[:2] == ("reconcile", "explicit_or_initial_reconcile")
    assert decide([(1, "a", "1:0"), (1, "a", "1:1")])[:2] == ("reconcile", "deleted_item_or_chunk_shrink")
    assert decide([(1, "x", "1:0"), (2, "b", "2:0")])[:2] == ("reconcile", "deleted_item_or_chunk_shrink")
    same = [(1, "a", "1:0"), (1, "a", "1:1"), (2, "b", "2:0")]
    assert decide(same, contract_changed=True)[:2] == ("reconcile", "contract_change")
    mode, reason, changed = decide([(1, "a", "1:0"), (1, "a", "1:1"), (2, "c", "2:0"), (2, "c", "2:1"), (3, "n", "3:0")])
    assert (mode, reason) == ("incremental", "safe_native_upsert") and rows(changed.select("chunk_id")) == [("2:0",), ("2:1",), ("3:0",)]


def test_resume(spark):
    targets = spark.range(4).withColumnRenamed("id", "k")
    results = lambda data: spark.createDataFrame(data, "k bigint, status string, attempt int")
    first = results([(0, "done", 1), (1, "failed", 1), (2, "failed", 1), (3, "done", 1)])
    assert rows(retrieval.pending(targets, first.filter("status = 'done'"), "k")) == [(1,), (2,)]
    merged = retrieval.record_outcomes(first, results([(1, "done", 2), (2, "failed", 2), (3, "failed", 2)]), "k")
    assert rows(merged) == [(0, "done", 1), (1, "done", 2), (2, "failed", 2), (3, "done", 1)]
    assert retrieval.run_status(targets, merged, "k").collect()[0]["status"] == "partial"
    whole = retrieval.record_outcomes(merged, results([(2, "done", 3)]), "k")
    assert retrieval.run_status(targets, whole, "k").collect()[0]["status"] == "complete"
    retrieval.check_contract({"model": "a"}, {"model": "a"})
    with pytest.raises(ValueError, match="model"):
        retrieval.check_contract({"model": "a"}, {"model": "b"})


def test_compaction(spark, tmp_path):
    source = str(tmp_path / "many")
    spark.range(4000).selectExpr("id", "(id * 7919) % 4000 as other").repartition(20).write.parquet(source)
    packed = {r["phase"]: r for r in layout.compact(spark, source, str(tmp_path / "packed")).collect()}
    assert packed["before"]["file_count"] == 20 and packed["after"]["file_count"] == 1
    size = packed["before"]["total_size_bytes"]
    layout.compact(spark, source, str(tmp_path / "z"), target_bytes=max(size // 8, 1), cluster_by=["id", "other"])
    clustered = spark.read.parquet(str(tmp_path / "z"))
    assert rows(clustered) == rows(spark.read.parquet(source))
    spans = clustered.groupBy(F.input_file_name().alias("f")).agg((F.max("id") - F.min("id")).alias("a"), (F.max("other") - F.min("other")).alias("b")).collect()
    assert len(spans) > 4 and np.mean([s["a"] for s in spans]) < 3200 and np.mean([s["b"] for s in spans]) < 3200
    with pytest.raises(ValueError):
        layout.compact(spark, source, str(tmp_path / "no"), target_bytes=0)


def test_pruned_files_against_footers(spark, tmp_path):
    source, target = str(tmp_path / "many"), str(tmp_path / "z")
    spark.range(6000).selectExpr("if(id % 50 = 0, null, id) as a", "(id * 7919) % 6000 as b", "cast(id % 3 as string) as c").repartition(12).write.parquet(source)
    size = layout.file_metrics(spark.read.parquet(source)).first()["total_size_bytes"]
    layout.compact(spark, source, target, target_bytes=size // 20, cluster_by=["a", "b"])
    box = {"a": (1500, 1900), "b": (700, 1100)}
    shares = {}
    for path in (source, target):
        files = skipped = 0
        for file in pathlib.Path(path).glob("*.parquet"):
            meta = pq.ParquetFile(file).metadata
            index = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
            files += 1
            ends = {c: [meta.row_group(g).column(index[c]).statistics for g in range(meta.num_row_groups)] for c in box}
            known = {c: [s for s in ends[c] if s is not None and s.has_min_max] for c in box}
            skipped += any(not known[c] or min(s.min for s in known[c]) > high or max(s.max for s in known[c]) < low for c, (low, high) in box.items())
        assert rows(layout.pruned_files(spark.read.parquet(path), box)) == [(files, skipped)]
        shares[path] = skipped / files
    assert shares[source] == 0 and shares[target] > 0.5


def test_curve_follows_the_number_of_files(spark):
    assert [layout.curve_bits(n, 2) for n in (1, 16, 1000, 800_000)] == [2, 4, 7, 12] and layout.curve_bits(800_000, 1) == layout.MOST_BITS
    frame = spark.range(1000).selectExpr("id as a", "if(id < 500, 7, id) as b", "cast(null as int) as n")
    z = frame.select(layout.z_value(frame, ["a"], 5).alias("a"), layout.z_value(frame, ["b", "n"], 3).alias("b")).collect()
    assert sorted({r["a"] for r in z}) == list(range(32)) and max(abs(sum(r["a"] == i for r in z) - 31) for i in range(32)) <= 2
    # The first four edges of b are all 7, so its rows lie in ranges 4 to 7; a column of nulls has no ranges.
    assert sorted({r["b"] for r in z}) == [16, 17, 20, 21]


def test_salting_flattens_the_load(spark):
    skewed = spark.range(9000).selectExpr("id", "if(id % 3 = 0, 0, id) as k")
    assert rows(layout.salted_counts(skewed, "k").filter("k = 0")) == [(0, 3000)]
    plain, salted = (layout.partition_load(skewed, "k", 8, s).collect()[0]["max_rows"] for s in (1, 8))
    assert salted < plain


def test_best_items_of_many_blocks_equal_one(spark, monkeypatch):
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(700, 6)).round(2)
    data = [(i // 3, f"c{i}", v.tolist(), float(i % 4)) for i, v in enumerate(vectors)]
    chunks = spark.createDataFrame(data, "item_id bigint, chunk_id string, embedding array<double>, average_rating double").repartition(6)
    queries = spark.createDataFrame([(f"q{i}", rng.normal(size=6).round(2).tolist()) for i in range(40)], "query_id string, embedding array<double>")
    asked = {r["query_id"]: np.array(r["embedding"]) for r in queries.collect()}
    want = set()
    for name, q in asked.items():
        scores = {}
        for (item, _, v, rating) in data:
            s, r = scores.get(item, (-9e9, -9e9))
            scores[item] = (max(s, round(float(np.dot(v, q)), 6)), max(r, rating))
        best = sorted((-s, -r, item) for item, (s, r) in scores.items())[:4]
        want |= {(name, i, item) for i, (_, _, item) in enumerate(best, 1)}
    for rows_, most in ((retrieval.QUERIES_PER_PASS, retrieval.CHUNK_ROWS), (7, 50)):
        monkeypatch.setattr(retrieval, "QUERIES_PER_PASS", rows_)
        monkeypatch.setattr(retrieval, "CHUNK_ROWS", most)
        got = {(r["query_id"], r["rank"], r["item_id"]) for r in retrieval.best_items(chunks, queries, "query_id", 4).collect()}
        assert got == want
    assert retrieval.best_items(chunks, queries.limit(0), "query_id", 4).collect() == []
    assert retrieval.best_items(chunks.limit(0), queries, "query_id", 4).collect() == []


def test_lineage_follows_an_items_content(spark):
    schema = "item_id bigint, chunk_type string, source_key string, text string"
    base = [(1, "note", "a", "one two. three."), (1, "note", "b", "four."), (2, "note", "a", "four.")]
    made = {}
    for name, units in (("base", base), ("changed", [(1, "note", "a", "one two. three!"), *base[1:]]), ("turned", base[::-1])):
        chunks = chunking.with_lineage(chunking.chunk_units(spark.createDataFrame(units, schema), context=False), "run", "2024-01-01 00:00:00")
        assert chunking.repeated_ids(chunks).collect() == []
        made[name] = {r["item_id"]: r["item_content_hash"] for r in chunks.collect()}
    assert made["base"] == made["turned"]
    assert made["base"][1] != made["changed"][1] and made["base"][2] == made["changed"][2]
    twice = chunking.chunk_units(spark.createDataFrame([base[1], base[1]], schema), context=False)
    assert [r["rows"] for r in chunking.repeated_ids(twice).collect()] == [2]
