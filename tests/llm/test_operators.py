"""The operators on small tables, against plain versions and on odd input."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from changefeed.llm import (
    bin_slack,
    bit_planes,
    counterfactual,
    divergence,
    golay,
    patricia,
    pitman_yor,
    pivotal_mix,
    suffix_trees,
    tokens,
    url_graph,
)

WORDS = [f"w{i}" for i in range(60)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string"


def phrase(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[i] for i in rng.integers(0, len(WORDS), n))


SHARED = phrase(1, 40)
ROWS = [
    (1, SHARED + "\nalpha beta", "en", "a", 1, "x"),
    (2, "start " + SHARED, "en", "a", 1, "x"),
    (3, SHARED + "\nAlpha Beta", "en", "b", 1, "x"),
    (4, None, None, None, None, None),
    (5, "", "en", "b", 0, None),
    (6, "tiny", "de", "b", 4, None),
    (7, "same " * 400, "de", "c", 1, None),
    (7, "same " * 400, "de", "c", 1, None),
    (8, phrase(2, 30_000), "fr", "c", 1, None),
    (None, phrase(3, 50), "fr", "c", 1, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_substring_dedup(docs, none):
    first: dict[tuple, int] = {}
    known = sorted((r for r in ROWS if r[0] is not None), key=lambda r: r[0])
    expected = []
    for doc_id, text, *_ in known:
        w = (text or "").split()
        covered = [False] * len(w)
        for k in range(len(w) - 12):
            if first.setdefault(tuple(w[k : k + 13]), doc_id) < doc_id:
                covered[k : k + 13] = [True] * 13
        kept = " ".join(x for x, c in zip(w, covered, strict=True) if not c)
        expected.append((doc_id, len(w), sum(covered), hashlib.sha256(kept.encode()).hexdigest()))
    for most in (4096, 0):  # by anchors, and all by whole windows
        found = suffix_trees.cleaned(docs, most_in_group=most)
        got = [tuple(r)[:4] for r in found.collect() if r["doc_id"] is not None]
        assert sorted(got) == sorted(expected)
    assert suffix_trees.cleaned(none).count() == 0


def test_near_groups_are_those_of_all_pairs(spark, docs, none):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**64, 40, dtype=np.uint64)
    fps = list(base)
    for f in base[:20]:
        for _ in range(6):
            flips = rng.choice(64, rng.integers(1, 7), replace=False)
            fps.append(f ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64)))
    fps = np.unique(np.array(fps, np.uint64))

    def roots(pairs):
        parent = {int(f): int(f) for f in fps}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in pairs:
            parent[max(find(a), find(b))] = min(find(a), find(b))
        return {f: find(f) for f in parent}

    close = [(int(a), int(b)) for i, a in enumerate(fps) for b in fps[i + 1 :] if np.bitwise_count(a ^ b) <= 4]
    df = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    for block in (20_000, 9):
        found = [(r["a"] % 2**64, r["b"] % 2**64) for r in golay.links(df, block=block).collect()]
        assert roots(found) == roots(close)
    got = golay.near_groups(docs).collect()
    assert len(got) == len(ROWS) and {r["component_id"] for r in got if r["doc_id"] in (4, 5)} == {4}
    assert golay.near_groups(none).count() == 0
    left = golay.without_near_copies(docs)
    assert left.columns == docs.columns and left.where("doc_id = 7").count() == 1


def test_exact_copies(docs, none):
    got = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in patricia.judged(docs, keep="max").collect()}
    assert {(1, 3, 2, False), (3, 3, 2, True), (4, 5, 2, False), (7, 7, 2, True)} <= got
    spilled = patricia.judged(docs, keep="max", trie_bytes=50)
    assert {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in spilled.collect()} == got
    assert patricia.without_copies(docs).count() == 7
    assert patricia.judged(none).count() == 0


def test_mix_keeps_targets(spark, none):
    rows = [(i, " ".join(["w"] * (1 + i % 37)), "en", f"s{i % 4}", 1, None) for i in range(400)]
    got = pivotal_mix.mix_ids(spark.createDataFrame(rows, SCHEMA), block=32, fan_in=2).collect()
    taken, target = defaultdict(int), {}
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 3 * r["size"]
    assert sum(target.values()) == pytest.approx(sum(r["size"] for r in got))
    assert all(abs(taken[s] - target[s]) <= 20 for s in target)
    assert pivotal_mix.mix_ids(none).count() == 0


def test_packing_and_id_files_hold_all_ids(docs, none, tmp_path):
    encode = tokens.encoder("word_bpe_49k.json", "word").tokenizer
    pieces = bin_slack.pack(docs, capacity=256).collect()
    by_window, by_doc = defaultdict(list), defaultdict(int)
    for p in pieces:
        by_window[p["sequence_id"]].append((p["offset"], p["length"]))
        by_doc[p["doc_id"]] += p["length"]
    for spans in by_window.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == 256 or at & (at - 1) == 0
    for doc_id, text, *_ in ROWS:
        times = 2 if doc_id == 7 else 1
        assert by_doc[doc_id] == times * (len(encode.encode(text or "", add_special_tokens=False).ids) + 1)
    assert bin_slack.pack(none).count() == 0

    byte = tokens.encoder("byte_bpe_50k.json", "byte").tokenizer
    for planes in (4, 32):
        got = bit_planes.token_files(docs, str(tmp_path / f"ids{planes}"), planes=planes, block=1000)
        at = 0
        for r, (doc_id, text, *_) in zip(
            sorted(got.collect(), key=lambda r: r["start"]), sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0)), strict=True
        ):
            ids = np.array([*byte.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
            assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
            at += len(ids)
    assert bit_planes.token_files(none, str(tmp_path / "none")).count() == 0


def test_scores_sum_to_one_and_learn(docs, none):
    state, kept = pitman_yor.train(docs.select("text"))
    chunks = [pitman_yor.Chunk.read(r.asDict()) for r in state.collect()]
    for fine in (0, 5, 60):
        total = pitman_yor.unknown(kept)[fine]
        for chunk in chunks:
            model = pitman_yor.Model(chunk, kept)
            total += model.mean(np.arange(len(chunk.words)), np.full(len(chunk.words), fine)).sum()
        assert total == pytest.approx(1.0, abs=1e-3)
    got = pitman_yor.scored(docs).collect()
    assert len(got) == len(ROWS)
    assert pitman_yor.scored(none).count() == 0


def test_quality_counts(docs, none):
    got = {r["doc_id"]: r for r in divergence.judge(docs, with_text=False).collect()}
    assert got[7]["n_repeat_words"] == 400 and got[7]["base_failed"] and not got[7]["kept"]
    assert got[1]["n_words"] == 42 and got[1]["n_dup_lines"] == 0 and got[4]["n_words"] == 0
    assert divergence.judge(none).count() == 0


def test_urls(spark):
    pages = [
        (1, "HTTP://A.com/x?y", None), (2, "http://b.org/", '<a href="http://bad.example.net/fr/1">'),
        (3, "http://bad.example.net/fr/1", ""), (4, None, ""), (5, "no scheme", ""), (6, "https://www.example.com/en/1", ""),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_graph.judge(df).collect()}
    assert got[1] == ("a.com", "/x", "com/", "allow") and got[2] == ("b.org", "/", None, "allow")
    assert got[3][2:] == ("net/fr/", "block") and got[4] == got[5] == ("", "", None, "allow")
    assert got[6][2:] == ("www.example.com/en/", "allow")


def test_toxicity_ignores_identity_under_the_penalty(spark, none):
    rows, labels = [], []
    for i in range(400):
        toxic = i % 2
        who = "women" if toxic and i % 3 else "men"
        rows.append((i, f"{who} {'idiot' if toxic else 'garden'} {WORDS[i % 60]}", "en", "s", 1, None))
        labels.append((i, toxic))
    df, known = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = counterfactual.judge(df, known).collect()
    assert all(r["predicted"] == r["doc_id"] % 2 for r in got if r["held_out"])
    sample = df.join(known, "doc_id")
    gaps = []
    for penalty in (0.0, 50.0):
        weights, _ = counterfactual.fit(sample, penalty=penalty)
        w = [weights.get(counterfactual.feature_ids(t)[0], 0.0) for t in ("women", "men")]
        gaps.append(abs(w[0] - w[1]))
    assert gaps[1] < gaps[0]
    assert counterfactual.judge(none, known).count() == 0
    assert counterfactual.judge(df, known.where("false")).where(F.col("score") != 0.5).count() == 0
