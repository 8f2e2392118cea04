"""Every document of a block is taken with its fraction, also after a huge one."""

from __future__ import annotations

import numpy as np

from changefeed.llm import pivotal_mix


def frequencies(sizes, fraction, runs):
    total = np.zeros(len(sizes))
    ids = list(range(len(sizes)))
    for seed in range(runs):
        total += pivotal_mix.reduce_pairs(ids, sizes, [fraction] * len(sizes), seed)
    return total / runs


def test_inclusion_equals_the_fraction_by_rank():
    runs = 1_500
    after_huge = frequencies([20_000, *[200] * 240], 0.3, runs)
    for ranks in (slice(0, 1), slice(1, 41), slice(41, 226), slice(226, 241)):
        assert abs(after_huge[ranks].mean() - 0.3) < 0.04
    equal = frequencies([100] * 8, 0.3, 4 * runs)
    assert np.abs(equal - 0.3).max() < 0.03


def test_words_stay_at_the_target():
    sizes = [20_000, *[200] * 240]
    for seed in range(20):
        x = pivotal_mix.reduce_pairs(list(range(241)), sizes, [0.3] * 241, seed)
        assert abs(np.dot(x, sizes) - 0.3 * sum(sizes)) < 1e-3 and sum(0 < v < 1 for v in x) <= 1
