"""The flows of trust and distrust over links between hosts."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from changefeed.llm import url_graph

SCHEMA = "page_id long, url string, html string, trust string, host string"


def judged(spark, pages):
    rows = [(i, url, "".join(f'<a href="{t}">' for t in to), "x", None) for i, (url, to) in enumerate(pages)]
    return url_graph.judge(spark.createDataFrame(rows, SCHEMA)).collect()


def test_mixed_and_distant_hosts_are_not_blocked(spark):
    pages = [(f"http://shop.net/en/{i}", []) for i in range(100)] + [("http://shop.net/es/1", [])]
    pages += [("http://clean.org/", ["http://shop.net/en/1"]), ("http://far.org/", ["//clean.org/"])]
    got = {r["page_id"]: r["verdict"] for r in judged(spark, pages)}
    assert [i for i, verdict in got.items() if verdict == "block"] == [100]


def test_hosts_that_link_to_bad_ones_are_blocked_also_at_the_second_hop(spark):
    bad = [f"http://bad{k}.net/fr/" for k in range(6)]
    pages = [(url, []) for url in bad]
    pages += [("http://user@farm.org:8080/a", bad), ("http://hub.org/", ["http://farm.org/a", *bad])]
    pages += [("http://friend.org/", ["http://good.com/", "http://bad0.net/fr/"]), ("http://good.com/", [])]
    of = {r["host"]: r for r in judged(spark, pages)}
    assert of["user@farm.org:8080"]["verdict"] == of["hub.org"]["verdict"] == "block"
    assert of["friend.org"]["verdict"] == of["good.com"]["verdict"] == "allow"
    assert 0 < of["friend.org"]["distrust"] < 0.5 < of["hub.org"]["distrust"] < 1


def test_flows_equal_a_plain_page_rank(spark):
    rng = np.random.default_rng(2)
    n = 30
    links = {(int(a), int(b)): int(k) for a, b, k in zip(*rng.integers(0, n, (2, 90)), rng.integers(1, 4, 90), strict=True) if a != b}
    links |= {(0, b): 1 for b in range(1, n)}
    allowed, blocked = (np.where(rng.random(n) < 0.3, rng.random(n), 0.0) for _ in range(2))
    seeds = spark.createDataFrame(
        [(f"h{i}", float(allowed[i]), float(blocked[i])) for i in range(n)], "host string, allowed double, blocked double"
    )
    edges = spark.createDataFrame([(f"h{a}", f"h{b}", k) for (a, b), k in links.items()], "src string, dst string, links long")
    matrix = np.zeros((n, n))
    for (a, b), k in links.items():
        matrix[a, b] = k

    def rank(m, seed):
        steps = m / np.maximum(m.sum(1, keepdims=True), 1)
        mass = seed.copy()
        for _ in range(300):
            mass = 0.85 * mass @ steps + 0.15 * seed
        return mass

    got = {r["host"]: r for r in url_graph.propagate(seeds, edges, tolerance=1e-9).collect()}
    trust = rank(matrix, allowed) / rank(matrix, np.ones(n))
    distrust = rank(matrix.T, blocked) / rank(matrix.T, np.ones(n))
    for i in range(n):
        assert got[f"h{i}"]["trust"] == pytest.approx(trust[i], abs=1e-6)
        assert got[f"h{i}"]["distrust"] == pytest.approx(distrust[i], abs=1e-6)


def test_odd_pages(spark):
    assert judged(spark, []) == []
    pages = [(None, ["http://x.net/fr/"]), ("no scheme", []), ("http://", []), ("http://a.com/x", []), ("http://a.com/x", [])]
    assert {r["verdict"] for r in judged(spark, pages)} == {"allow"}
    df = spark.createDataFrame([(1, "http://net/fr/", None, None, None)] * 2, SCHEMA)
    assert url_graph.judge(df).where(F.col("verdict") == "block").count() == 2
