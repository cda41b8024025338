import numpy as np
import pytest

from addrloom.llm.leakage import FMIndex


@pytest.mark.parametrize("seed", range(20))
def test_locate_agrees_with_brute_force_on_short_runs(seed):
    rng = np.random.default_rng(seed)
    sigma = 6
    seq = np.concatenate([np.r_[rng.integers(1, sigma, rng.integers(3, 9)), 0] for _ in range(40)]).astype(np.int64)
    index = FMIndex(seq, sigma)
    phrases = np.array(sorted({tuple(seq[i : i + 3]) for i in range(len(seq) - 2) if seq[i : i + 3].all()}))
    lo, hi = index.search(phrases)
    for phrase, a, b in zip(phrases, lo, hi):
        there = [i for i in range(len(seq) - 2) if (seq[i : i + 3] == phrase).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == there
