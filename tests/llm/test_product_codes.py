"""Vector codes against plain rounds that measure all distances."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from changefeed.llm import product_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, salt string, error string"


def plain(rows, parts=4, entries=256, rounds=4):
    kept = [r for r in rows if r[1] is not None and all(v is not None and np.isfinite(v) for v in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    x = np.floor(1024 * np.array([r[1] for r in kept], np.float32).astype(np.float64)).astype(np.int64)
    x = x.reshape(len(kept), parts, width)
    books = [x[:entries, p].copy() for p in range(parts)]
    for turn in range(rounds + 1):
        d = np.stack([((x[:, p, None] - books[p][None]) ** 2).sum(2) for p in range(parts)], 1)
        code = d.argmin(2)
        for p in range(parts if turn < rounds else 0):
            for e in np.unique(code[:, p]):
                books[p][e] = x[code[:, p] == e, p].sum(0) // (code[:, p] == e).sum()
    error = d.min(2).sum(1)
    digest = hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()
    of_label = {}
    for r, e in zip(kept, error.tolist(), strict=True):
        of_label[r[2]] = of_label.get(r[2], 0) + e
    return [
        (r[0], bytes(c.astype(np.uint8)).hex(), e, of_label[r[2]], digest)
        for r, c, e in zip(kept, code, error.tolist(), strict=True)
    ]


def vectors(n, dim, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, spread, (40, dim))
    return (centres[rng.integers(0, 40, n)] + rng.normal(0, 0.1, (n, dim))).astype(np.float32)


def table(x):
    rows = [(i, v.tolist(), [None, 1, 2, 7][i % 4], "x", None, "e") for i, v in enumerate(x)]
    odd = [None, [], [None] * x.shape[1], [float("nan")] * x.shape[1], [float("inf")] * x.shape[1]]
    rows += [(10_000 + i, v, 1, None, None, None) for i, v in enumerate(odd) if v != []]
    return [*rows, rows[3], (3, rows[4][1], 1, None, None, None), (None, rows[5][1], None, None, None, None)]


@pytest.mark.parametrize(("n", "dim"), [(900, 16), (100, 8), (1, 4)])
def test_codes_equal_plain_rounds(spark, n, dim):
    rows = table(np.concatenate([vectors(n, dim, n), np.zeros((5, dim), np.float32)]))
    got = product_codes.codes(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, plain(rows)))


def test_bounds_follow_long_histories_and_spare_distances():
    rng = np.random.default_rng(1)
    x = np.floor(1024 * vectors(3_000, 8, 2)).astype(np.int64)
    starts = product_codes.group_starts(64, 8)
    history = [x[:64].copy()]
    bounds, measured = product_codes.measured(x, history[0], starts, 0), 0
    for turn in range(12):
        book = history[-1].copy()
        for e in np.unique(bounds.code):
            book[e] = x[bounds.code == e].sum(0) // (bounds.code == e).sum()
        book += rng.integers(-40, 41, book.shape) * (turn % 3 == 0)  # back and forth
        history.append(book)
        bounds, count = product_codes.reassigned(x, bounds, history, starts)
        measured += count
        exact = product_codes.distances(x, book)
        assert (bounds.code == exact.argmin(1)).all()
    assert measured < 12 * x.shape[0] * 64 / 3


def test_net_displacement_keeps_bounds_that_added_drifts_would_lose():
    x = np.array([[0, 0], [1_000, 0]])
    there, back = np.array([[0, 0], [1_000, 0]]), np.array([[0, 400], [1_000, 400]])
    starts = product_codes.group_starts(2, 2)
    first = product_codes.measured(x, there, starts, 0)
    _, count = product_codes.reassigned(x, first, [there, back, there, back, there], starts)
    assert count == 0  # four moves of 400 add up to 1,600, their sum is nothing


def test_ties_take_the_lower_entry():
    x, entries = np.array([[5], [6]]), np.array([[10], [0], [2], [10]])
    starts = product_codes.group_starts(4, 4)
    bounds = product_codes.measured(x, entries, starts, 0)
    assert bounds.code.tolist() == [2, 0]
    after, _ = product_codes.reassigned(x, bounds, [entries, np.array([[10], [0], [0], [10]])], starts)
    assert after.code.tolist() == [0, 0]


def test_wide_components_are_exact_or_refused(spark):
    x = np.array([[2**40, 3]]), np.array([[2**40 - 1, 5]])
    assert product_codes.distances(*x).tolist() == [[5]]
    big = spark.createDataFrame([(1, [1e30] * 4, 1, None, None, None)], SCHEMA)
    with pytest.raises(ValueError, match="too large"):
        product_codes.codes(big)


def test_no_vectors(spark):
    for rows in ([], [(1, None, 1, None, None, None)]):
        assert product_codes.codes(spark.createDataFrame(rows, SCHEMA)).collect() == []
    empty = [(1, [], None, None, None, None), (2, [1.0, 2.0, 3.0, 4.0, 5.0], None, None, None, None)]
    got = product_codes.codes(spark.createDataFrame(empty, SCHEMA)).collect()
    assert sorted((r.vec_id, r.code, r.error) for r in got) == [(1, "00000000", 0), (2, "01010100", 0)]
