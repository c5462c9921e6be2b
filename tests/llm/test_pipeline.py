"""The pipeline's stages, each against a plain answer on its own input."""

import hashlib
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from test_llm import ODD, SCHEMA, bare, classes

from shopflow.llm import queries

SMALL = "/root/testdata/sf0.001"


def stored(spark, tmp_path, frame, name):
    path = str(tmp_path / name.replace(" ", "-"))
    frame.write.parquet(path)
    return spark.read.parquet(path)


def test_every_stage_does_its_work_and_no_more(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("_position", F.lit("x")).withColumn("KEPT", F.lit(1))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language ID", "exact dedup", "near dedup", "mixing", "BPE"]
    after = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(spark, tmp_path, stage(spark, docs, SMALL), name)
        assert out.dtypes == docs.dtypes
        assert out.exceptAll(docs).isEmpty()  # rows of the stage's input, as they were
        before, after[name] = {r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in out.collect()}
        if name == "language ID":
            assert all(not any(map(str.isalpha, before[i].text or "")) for i in before.keys() - after[name].keys())
        elif name == "exact dedup":
            assert Counter(bare(r.text) for r in after[name].values()) == Counter({bare(r.text) for r in before.values()})
        elif name == "near dedup":
            groups = classes([(r.doc_id, r.text) for r in before.values()])
            assert {min(g) for g in groups} == set(after[name])
        else:
            assert len(after[name]) > 0.8 * len(before)
            shares = Counter(r.source for r in after[name].values())
            assert max(shares.values()) <= 0.25 * len(after[name]) + 64
        docs = out
    library = __import__("tokenizers").Tokenizer.from_file(queries.word_vocabulary())
    texts = {r.doc_id: r.text for r in docs.collect()}
    coded = stages["BPE"](spark, docs, SMALL).collect()
    assert len(coded) == len(texts)
    for r in coded:
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(library.decode(r.ids, skip_special_tokens=False).encode()).hexdigest()


def test_stages_of_odd_and_of_no_rows(spark, tmp_path):
    odd = spark.createDataFrame([(*r, 1, "x", "y", 2, "k", "n", "N") for r in ODD], SCHEMA)
    none = odd.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SMALL).collect() == []
        out = stage(spark, odd, SMALL)
        if name in ("language ID", "exact dedup", "near dedup", "mixing"):
            assert out.columns == odd.columns
        if name == "exact dedup":
            assert Counter(bare(r.text) for r in out.collect()) == Counter({bare(t) for _, t, *_ in ODD})
        if name == "BPE":
            assert out.count() == len(ODD)
