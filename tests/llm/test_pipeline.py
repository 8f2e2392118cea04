"""The pipeline stage by stage against plain versions, each on what the one before kept."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from changefeed.llm import bin_slack, tokens
from changefeed.llm.common import LOWER, UPPER, table, written

SF_DIR = Path("/root/testdata/sf0.001")
WINDOW, REPEATED = 8, 30
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="the test tables are absent")


def rows_of(df):
    return [tuple(row) for row in df.collect()]


def base_failed(text):
    words = (text or "").split()
    places = defaultdict(list)
    for at in range(len(words) - WINDOW + 1):
        places[tuple(words[at : at + WINDOW])].append(at)
    covered = {at + k for found in places.values() if len(found) > 1 for at in found for k in range(WINDOW)}
    return len(words) < 20 or 100 * len(covered) > REPEATED * len(words)


def check_quality(before, after):
    assert not Counter(after) - Counter(before)
    assert not any(base_failed(row[1]) for row in after)
    clean = [row for row in before if not base_failed(row[1])]
    assert len(after) > 0.9 * len(clean)


def check_exact(before, after):
    owner = {}
    for row in before:
        key = row[1].encode().lower()
        if key not in owner or row[0] > owner[key][0]:
            owner[key] = row
    assert sorted(owner.values()) == sorted(after)


def shingles(text):
    words = text.encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def check_near(before, after):
    ordered = sorted(before)
    sets, group = [shingles(row[1]) for row in ordered], np.arange(len(ordered))
    for i, one in enumerate(sets):
        for j, two in enumerate(sets[:i]):
            if min(len(one), len(two)) < 0.79 * max(len(one), len(two)):
                continue
            both = len(one & two)
            if both >= 0.8 * (len(one) + len(two) - both) - 1e-9:
                low, high = sorted((group[i], group[j]))
                group[group == high] = low
    assert sorted(after) == [ordered[i] for i in sorted(set(group.tolist()))]


def targets(sizes):
    """Shares 5, 2, 1 in code-point order, at most three times a source's size."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {name: (5, 2, 1)[i % 3] for i, name in enumerate(names)}
    found, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        share = left / sum(weight[n] for n in open_)
        full = {n for n in open_ if share * weight[n] > 3 * sizes[n]}
        if not full:
            return found | {n: share * weight[n] for n in open_}
        for name in full:
            found[name] = 3.0 * sizes[name]
            left -= found[name]
        open_ -= full
    return found


def check_mix(before, after):
    assert set(after) <= set(before)
    size = {row: len(row[1].split()) for row in before}
    sizes, taken, longest = Counter(), Counter(), Counter()
    for row in before:
        sizes[row[3]] += size[row]
        longest[row[3]] = max(longest[row[3]], size[row])
    for row, copies in Counter(after).items():
        assert copies <= 3
        taken[row[3]] += copies * size[row]
    for source, target in targets(sizes).items():
        assert abs(taken[source] - target) <= 2 * longest[source]


def check_pack(before, pieces):
    encode = tokens.encoder("word_bpe_49k.json", "word").tokenizer
    text, copies = {row[0]: row[1] for row in before}, Counter(row[0] for row in before)
    covered, windows = defaultdict(Counter), defaultdict(list)
    ids = {d: np.array([*encode.encode(t, add_special_tokens=False).ids, 2], "<u4") for d, t in text.items()}
    for piece in pieces:
        whole = ids[piece["doc_id"]]
        part = whole[piece["start"] : piece["start"] + piece["length"]]
        assert piece["ids_crc32"] == zlib.crc32(part.tobytes()) and piece["doc_tokens"] == len(whole)
        covered[piece["doc_id"]].update(range(piece["start"], piece["start"] + piece["length"]))
        windows[piece["sequence_id"]].append((piece["offset"], piece["length"]))
    for doc_id, whole in ids.items():
        assert covered[doc_id] == Counter({at: copies[doc_id] for at in range(len(whole))})
    for spans in windows.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= bin_slack.CAPACITY


CHECKS = {
    "quality_rules": check_quality,
    "exact_dedup": check_exact,
    "near_dedup": check_near,
    "mix_sources": check_mix,
}


def with_copies(docs):
    """Documents with copies in other case, near copies, and nulls in every column."""
    some = docs.where("doc_id % 4 = 0")
    # Only a few letters, since quality looks at the share of upper case.
    start = F.translate(F.substring("text", 1, 20), LOWER, UPPER)
    upper = F.concat(start, F.substring("text", 21, 2**31 - 1))
    other = some.withColumns({"doc_id": F.col("doc_id") + 1_000_000, "text": upper})
    near = some.withColumns({"doc_id": F.col("doc_id") + 2_000_000, "text": F.concat("text", F.lit(" extra"))})
    bare = docs.limit(1).select(
        *[F.lit(None).cast(field.dataType).alias(field.name) for field in docs.schema.fields]
    )
    return docs.unionByName(other).unionByName(near).unionByName(bare)


def test_stages_equal_plain_versions(spark):
    docs = written(with_copies(table(spark, str(SF_DIR), "documents")), "pipeline-test")
    columns = docs.columns
    assert columns[:4] == ["doc_id", "text", "lang", "source"]
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, docs, str(SF_DIR)), "pipeline-test")
        if name == "pack_windows":
            check_pack(rows_of(docs), after.collect())
        else:
            assert after.columns == columns
            CHECKS[name](rows_of(docs), rows_of(after))
        docs = after


def test_a_run_repeats_and_empty_tables_give_no_rows(spark):
    first, second = (corpus_pipeline.run(spark, str(SF_DIR)) for _ in range(2))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(rows_of(first.select(names))) == sorted(rows_of(second.select(names)))
    docs = table(spark, str(SF_DIR), "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(SF_DIR))
    assert docs.count() == 0
