"""Dense regions of the near-duplicate search."""

import numpy as np

from corvane.llm import forest


def test_dense_regions_propose_few_pairs_short_of_the_threshold():
    # sets of 400 shingles round one base: two of them share 0.68 of their union, below the threshold of 0.75
    rng = np.random.default_rng(5)
    shared, own = 324, 76
    base = rng.integers(1, 1 << 63, shared, dtype=np.uint64)
    sets = [np.concatenate([base, rng.integers(1, 1 << 63, own, dtype=np.uint64)]) for _ in range(60)]
    at = np.arange(60) * (shared + own)
    signature = forest.least_hashes(np.concatenate(sets), at, forest.LONG_HASHES) & 255
    alike = np.array([(signature[i] == signature[j]).sum() for i in range(60) for j in range(i)])
    assert (alike >= forest.mark(forest.LONG_HASHES, 0.75)).mean() < 0.3


def test_dense_regions_propose_every_pair_at_the_threshold():
    rng = np.random.default_rng(6)
    missed = 0
    for _ in range(40):
        base = rng.integers(1, 1 << 63, 300, dtype=np.uint64)
        two = [np.concatenate([base, rng.integers(1, 1 << 63, 50, dtype=np.uint64)]) for _ in range(2)]
        signature = forest.least_hashes(np.concatenate(two), np.array([0, 350]), forest.LONG_HASHES) & 255
        for part in range(forest.FIRST_HASHES, forest.LONG_HASHES + 1, forest.FIRST_HASHES):
            missed += (signature[0, :part] == signature[1, :part]).sum() < forest.mark(part, 0.75)
    assert missed == 0
