"""The pipeline's near copies that fingerprints find where the bands of MinHash values do not."""

from __future__ import annotations

import numpy as np

import corpus_pipeline
from changefeed.llm import golay, overlap

SCHEMA = "doc_id long, text string, lang string, source string"


def test_fingerprints_find_similar_documents_that_share_no_band(spark, monkeypatch):
    words = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    texts = {5: words("a", 400), 3: words("a", 399), 9: words("a", 400) + " more", 7: words("b", 90)}
    found = {at: golay.fingerprint(text.encode()) for at, text in texts.items()}
    assert all((found[5] ^ found[at]).bit_count() <= golay.MOST_BITS for at in (3, 9))

    def own_keys(lowest):
        return lowest.sum(dtype=np.uint64) + np.arange(overlap.BANDS, dtype=np.uint64)

    monkeypatch.setattr(overlap, "band_keys", own_keys)
    docs = spark.createDataFrame([(at, text, "en", "s") for at, text in texts.items()], SCHEMA)
    got = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(r["doc_id"] for r in got.collect()) == [3, 7]
