"""Links of vectors that share a mean direction."""

from __future__ import annotations

import numpy as np
import pytest

from fumeline.llm import itq


@pytest.mark.parametrize("common", [0.0, 0.5, 0.7, 0.8])
def test_links_under_a_common_mean(common):
    rng = np.random.default_rng(6)
    own = rng.normal(size=(1500, 64))
    own /= np.linalg.norm(own, axis=1, keepdims=True)
    axis = np.zeros(64)
    axis[0] = 1
    unit = np.sqrt(common) * axis + np.sqrt(1 - common) * own
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    mean, axes, radius = itq.fitted(unit, itq.LEAST_COSINE)
    for cosine in (0.905, 0.92, 0.97):
        turn = rng.normal(size=unit.shape)
        turn -= (turn * unit).sum(1, keepdims=True) * unit
        turn /= np.linalg.norm(turn, axis=1, keepdims=True)
        partner = cosine * unit + np.sqrt(1 - cosine ** 2) * turn
        x, y = itq._signs(unit, mean, axes), itq._signs(partner, mean, axes)
        found = (itq.meeting(x, y, 4)[0] >= 0) & (np.bitwise_count(x ^ y) <= radius)
        assert found.mean() >= 0.9, (common, cosine, found.mean(), radius)
