"""b-bit MinHash near duplicates against exact similarity of all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from kpi_lake.llm import minhash
from kpi_lake.llm.components import connected_components


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows, percent=85):
    """Per row: set size and the smallest id reachable."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return [(i, len(s), least.get(root(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))]


@pytest.fixture(scope="module")
def rows():
    made = random.Random(6)

    def prose(n):
        return [f"W{made.randrange(3000)}" for _ in range(n)]

    out = [(1000, None), (1001, ""), (1002, " \n"), (1003, "one Two"), (1004, "ONE two"), (1005, "one two three"), (None, "a null id here now please"), (7000, "a null id here now please")]
    for base in range(12):
        words = prose(made.randrange(40, 200))
        for _ in range(made.randrange(1, 25)):
            near = list(words)
            for _ in range(made.randrange(4)):
                near[made.randrange(len(near))] = f"E{made.randrange(10**6)}"
            out.append((made.randrange(10**6), " ".join(near)))
        out.append((base, " ".join(words)))
        out.append((base + 500, " ".join(words).upper()))
    out.append(out[-1])
    return out


@pytest.mark.parametrize("max_block", [minhash.MAX_BLOCK, 1500])
def test_components_equal_brute_force(documents, rows, max_block):
    got = minhash.near_duplicates(documents(rows), max_block=max_block).collect()
    assert sorted(((r.id, r.n_shingles, r.component_id) for r in got), key=str) == sorted(brute(rows), key=str)


def test_one_document_of_each_group_stays(documents, rows):
    left = minhash.deduplicate(documents(rows), percent=80)
    want = {(i, rows[k][1]) for k, (i, _, c) in enumerate(brute(rows, 80)) if i == c}
    got = [(r.doc_id, r.text) for r in left.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert left.columns == documents(rows).columns


def test_estimates_are_corrected_for_chance():
    made = np.random.default_rng(0)
    for share in (0.0, 0.5, 0.85, 1.0):
        n = 4000
        common = made.integers(0, 1 << 63, int(n * 2 * share / (1 + share)), np.uint64)
        a, b = (np.unique(np.concatenate((common, made.integers(0, 1 << 63, n - len(common), np.uint64)))) for _ in range(2))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        packed = minhash.signatures(minhash.minima([a, b]))
        assert packed.shape == (2, minhash.HASHES * minhash.BITS // 64)
        assert abs(minhash.estimates(packed[0], packed[1:])[0] - true) < minhash.MARGIN


def test_near_copies_are_joined_without_all_pairs():
    made = np.random.default_rng(1)
    base = np.unique(made.integers(0, 1 << 63, 300, np.uint64))
    sets = [np.unique(np.concatenate((base[5:], made.integers(0, 1 << 63, 5, np.uint64)))).view(np.int64) for _ in range(60)]
    found = minhash.trees(sets, minhash.signatures(minhash.minima([s.view(np.uint64) for s in sets])))
    assert len(found) == 59


def test_empty_table(documents):
    assert minhash.near_duplicates(documents([(1, "a")]).limit(0)).count() == 0
    assert minhash.near_duplicates(documents([(1, None)])).first().component_id == 1


def test_connected_components_of_chains_and_stars(spark):
    made = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)] + [(made.randrange(200, 260), made.randrange(200, 260)) for _ in range(50)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.root for r in connected_components(frame).collect()}
    assert got == {x: root(x) for x in list(parent)}
    assert connected_components(frame.limit(0)).count() == 0
