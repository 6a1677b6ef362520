"""Candidate settings follow the threshold."""

from __future__ import annotations

import random

import pytest

from kpi_lake.llm import minhash
from tests.llm.test_minhash import brute


@pytest.mark.parametrize("percent", [5, 30, 50, 80, 85, 95, 100])
def test_misses_at_the_threshold_keep_to_the_stated_rate(percent):
    made = minhash.settings(percent)
    assert sum(made.misses(percent / 100)) <= minhash.MISS
    assert made.bands * made.rows <= made.hashes and made.hashes * minhash.BITS % 64 == 0


def test_pairs_near_a_low_threshold_are_found(documents):
    made = random.Random(8)
    rows = []
    for i in range(60):
        words = [f"w{made.randrange(10**6)}" for _ in range(150)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:102] + [f"e{made.randrange(10**6)}" for _ in range(48)]))]
    want = brute(rows, 50)
    assert sum(least != i for i, _, least in want) == 60
    got = minhash.near_duplicates(documents(rows), percent=50).collect()
    assert sorted((r.id, r.n_shingles, r.component_id) for r in got) == sorted(want)
