"""A long piece that nothing fills up does not hold up the other pieces of a pool."""

from __future__ import annotations

import numpy as np

from changefeed.llm import bin_slack


def test_pieces_without_an_exact_fill_are_set_aside():
    rng = np.random.default_rng(6)
    lengths = [*rng.integers(4_080, 4_096, 10).tolist(), *rng.integers(20, 1_500, 4_000).tolist()]
    pool = bin_slack.Pool(bin_slack.CAPACITY)
    for number, length in enumerate(lengths):
        pool.add(length, (number, 0))
    windows = list(pool.drain())
    assert all(sum(n for *_, n in window) == bin_slack.CAPACITY for window in windows)
    assert pool.size == sum(map(len, pool.by_length.values())) == len(lengths) - sum(map(len, windows))
    assert 10 <= pool.size < 100
    left = sum(n * len(pieces) for n, pieces in pool.by_length.items())
    assert sum(n for window in pool.rest() for *_, n in window) == left and not pool.size
