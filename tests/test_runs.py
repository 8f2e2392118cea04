"""Sorted runs in buckets: what a lookup opens, and what readers see while runs are merged."""

from __future__ import annotations

import pytest

from changefeed.session import numbered_folders
from changefeed.streaming.runs import Runs

COLUMNS = {"kind": "string", "id": "string", "version": "bigint"}


@pytest.fixture
def runs(spark, tmp_path):
    return Runs(spark, str(tmp_path / "runs"), COLUMNS, ("kind", "id"), newest="version", buckets=8, fan_in=3)


def rows(spark, *values):
    return spark.createDataFrame([("k", f"id{i}", v) for i, v in values], "kind string, id string, version long")


def best(df):
    found = {}
    for r in df.collect():
        found[r["id"]] = max(found.get(r["id"], 0), r["version"])
    return found


def test_epochs_add_up_and_merges_keep_the_newest(spark, runs):
    want = {}
    for epoch in range(10):
        new = [(i, epoch + 1) for i in range(epoch * 3, epoch * 3 + 30)]
        runs.add(rows(spark, *new), epoch)
        want.update({f"id{i}": v for i, v in new})
        assert best(runs.rows(epoch)) == want
        per_bucket = {}
        for run in runs.listed(epoch):
            per_bucket.setdefault((run.bucket, run.level), []).append(run)
        assert all(len(found) < 3 for found in per_bucket.values())
    assert max(run.level for run in runs.listed(9)) == 2


def test_a_lookup_opens_the_buckets_of_its_keys_only(spark, runs):
    runs.add(rows(spark, *((i, 1) for i in range(200))), 0)
    wanted = rows(spark, (7, 0), (1_000, 0))
    found = runs.matching(wanted, 0)
    buckets = {r[0] for r in wanted.select(runs.bucket()).collect()}
    opened = {path.split("bucket=")[1].split("/")[0] for path in found.inputFiles() if "bucket=" in path}
    assert opened == {str(b) for b in buckets} and len(opened) < 8
    assert best(found) == {"id7": 1}
    assert runs.matching(wanted, -1).count() == 0


def test_a_reader_keeps_its_version_while_runs_are_merged(spark, runs):
    for epoch in range(2):
        runs.add(rows(spark, *((i, epoch + 1) for i in range(40))), epoch)
    held = runs.rows(1)  # planned before the merge, read after it
    runs.add(rows(spark, *((i, 9) for i in range(40))), 2)
    runs.retire(2)
    assert best(held) == {f"id{i}": 2 for i in range(40)}
    assert best(runs.rows(2)) == {f"id{i}": 9 for i in range(40)}


def test_an_epoch_that_runs_again_replaces_itself(spark, runs):
    runs.add(rows(spark, (1, 1)), 0)
    runs.add(rows(spark, (2, 1), (3, 1)), 1)  # killed before the commit
    runs.add(rows(spark, (2, 5)), 1)
    assert best(runs.rows(1)) == {"id1": 1, "id2": 5}
    runs.add(rows(spark), 2)
    assert best(runs.rows(2)) == {"id1": 1, "id2": 5}


def test_old_lists_and_merged_runs_are_deleted(spark, runs):
    for epoch in range(9):
        runs.add(rows(spark, *((i, epoch) for i in range(20))), epoch)
        runs.retire(epoch, keep=2)
    assert numbered_folders(spark, f"{runs.root}/lists", "epoch") == {7, 8}
    assert best(runs.rows(7)) == {f"id{i}": 7 for i in range(20)}
    assert best(runs.rows(8)) == {f"id{i}": 8 for i in range(20)}
