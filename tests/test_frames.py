"""Frames that Python gives back are bounded by their text, whatever came in."""

import numpy as np
import pandas as pd
import pytest

from shopflow.operators import chunking


def test_chunk_and_vector_frames_are_bounded():
    texts = [" ".join(f"w{(i * 31 + j) % 997}" for j in range(900)) for i in range(60)]
    batch = pd.DataFrame({"item_id": range(60), "_prefix": "p: ", "text": texts})
    frames = list(chunking._splitter(chunking.HashingEncoder(), chunking.ChunkLimits(), ["item_id"], most=20_000)(iter([batch])))
    points = [int(f["text"].str.len().sum() + f["embedding_text"].str.len().sum()) for f in frames]
    assert len(frames) > 10 and max(points) < 30_000
    (whole,) = chunking._splitter(chunking.HashingEncoder(), chunking.ChunkLimits(), ["item_id"], most=10**9)(iter([batch]))
    pd.testing.assert_frame_equal(pd.concat(frames, ignore_index=True), whole)

    parts = list(chunking._embedder(chunking.HashingEncoder(), "text", (32, 16, 8), "", most=20_000)(iter([batch])))
    assert len(parts) > 10 and max(p["text"].str.len().sum() for p in parts) <= 20_000
    vectors = np.stack(pd.concat(parts)["embedding"].to_list())
    assert np.allclose(vectors, chunking.HashingEncoder().encode(texts))


def test_encoder_counts_words_with_few_remembered():
    encoder = chunking.HashingEncoder(8)
    encoder._slots = chunking._Slots(8, most=3)
    text = "a b c d e f a b c"
    assert np.allclose(encoder.encode([text, ""]), chunking.HashingEncoder(8).encode([text, ""]))
    assert len(encoder._slots) <= 3 and encoder.encode([""]).sum() == 0


def test_chunks_are_made_once(spark, monkeypatch):
    """Lineage reads the chunks twice, from stored files."""
    from shopflow.queries.rag import chunks
    from shopflow.sources.shop import Shop

    plan = chunks(Shop(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in plan


@pytest.mark.parametrize(("sizes", "most", "want"), [([], 5, []), ([9], 5, [(0, 1)]), ([2, 2, 2, 9, 1], 4, [(0, 2), (2, 3), (3, 4), (4, 5)])])
def test_bounded_slices(sizes, most, want):
    assert [(s.start, s.stop) for s in chunking.bounded_slices(sizes, most)] == want
