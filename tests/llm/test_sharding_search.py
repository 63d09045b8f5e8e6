"""The search for splitters on a histogram in memory."""

import numpy as np
import pytest

from tidepool.llm import sharding


@pytest.mark.parametrize("targets", [1, 39, 3000])
def test_splitters_meet_their_targets(monkeypatch, targets):
    rng = np.random.default_rng(1)
    keys, sizes = np.sort(rng.integers(0, 1 << 62, 50_000)), rng.integers(16, 4000, 50_000)
    upto = np.r_[0, np.cumsum(sizes)]

    def histogram(_, probes):
        cuts = np.r_[0, np.searchsorted(keys, [p >> 64 for p in probes]), len(keys)].tolist()
        return {i: (int(upto[b] - upto[a]), b - a, int(keys[a]) << 64, int(keys[b - 1]) << 64)
                for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b}

    monkeypatch.setattr(sharding, "_histogram", histogram)
    total = int(upto[-1])
    want = [total * i // (targets + 1) for i in range(1, targets + 1)]
    slack = 0.01 * total / (targets + 1)
    got = sharding._search(None, int(keys[0]) << 64, int(keys[-1]) << 64, total, want, slack)
    assert len(got) == targets
    for (key, below), t in zip(got, want):
        assert below == upto[np.searchsorted(keys, key >> 64)] or below == upto[np.searchsorted(keys, key >> 64, "right")]
        assert abs(below - t) <= max(slack, sizes.max())
