"""Ranked search: the tree against its cells, results against scoring every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from kpi_lake.llm import queries, treap

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plain_search(docs, items, k=20):
    """``(item, rank, doc, score)`` of scoring every document for every item."""
    held = [(d, Counter(plain_terms(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in set(items):
        asked = plain_terms(text)
        scored = []
        for d, c in held:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in asked if t in c)
            if s > 0:
                scored.append((-s, d is not None, d or 0, d))
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def found(index, items, spark, **more):
    frame = spark.createDataFrame(items, "item_id bigint, text string")
    return sorted((tuple(r) for r in treap.search(index, frame, **more).collect()), key=repr)


@pytest.mark.parametrize(("n_rows", "n_columns", "share"), [(1, 1, 1), (5, 300, 0.3), (400, 3, 0.5), (64, 64, 0.9), (1000, 200, 0.02)])
def test_a_tree_keeps_its_cells(n_rows, n_columns, share):
    rng = np.random.default_rng(n_rows)
    rows, columns = np.nonzero(rng.random((n_rows, n_columns)) < share)
    impacts = rng.integers(0, 50, len(rows))
    tree = treap.Tree(treap.build_tree(rows, columns, impacts))
    assert sorted(zip(tree.row, tree.column, tree.impact, strict=True)) == sorted(zip(rows, columns, impacts, strict=True))
    grid = np.zeros((n_rows, n_columns), np.int64)
    grid[rows, columns] = impacts
    for _ in range(20):
        asked = rng.choice(n_rows, min(n_rows, 4), replace=False)
        weights = rng.integers(0, 9, len(asked))
        scores = weights @ grid[asked]
        got = dict(zip(*(x.tolist() for x in tree.search(asked, weights, n_columns, 5, 0)), strict=True))
        least = max(1, sorted(scores)[-5] if n_columns >= 5 else 1)
        assert got == {c: s for c, s in enumerate(scores.tolist()) if s >= least}


def test_bounds_prune_a_search():
    """One document holds the rare term: the search looks at a small part of the ranges."""
    rng = np.random.default_rng(1)
    rows, columns = np.nonzero(rng.random((64, 4096)) < 0.5)
    rare = np.array([100]), np.array([77])
    tree = treap.Tree(treap.build_tree(np.concatenate((rows, rare[0])), np.concatenate((columns, rare[1])), np.concatenate((rng.integers(1, 500, len(rows)), [900]))))
    seen = []
    argpartition, treap.np.argpartition = np.argpartition, lambda a, kth: (seen.append(len(a)), argpartition(a, kth))[1]
    try:
        columns, _ = tree.search(np.array([3, 100]), np.array([1, 50]), 4096, 1, 0)
    finally:
        treap.np.argpartition = argpartition
    assert columns.tolist() == [77] and sum(seen) < 4096


def made(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéß日") for _ in range(rng.randint(1, 4))) for _ in range(150)]
    return [(i, " ".join(rng.choices(words, weights=[1 / (j + 1) for j in range(150)], k=rng.choice([1, 5, 40, 300])))) for i in range(n)]


@pytest.mark.parametrize(("cells", "block"), [(50, 1 << 20), (2000, 300), (1 << 20, 1 << 20)])
def test_results_equal_plain_ones(spark, documents, cells, block):
    docs = made(1, 120) + [(500 + i, "Same text, same score") for i in range(50)] + [(None, "same TEXT same score"), (7, "same id"), (7, "same id"), (901, None), (902, ""), (903, " -- ")]
    items = [(i, t) for i, t in made(2, 25)] + [(100, "same score!"), (100, "same score!"), (100, "another text"), (101, None), (102, "..."), (103, "unheard"), (None, "same id")]
    index = treap.build_index(documents(docs, 4), cells=cells)
    assert found(index, items, spark, block_bytes=block) == plain_search(docs, [x for x in items if x[1]])
    assert found(index, items[:5], spark, k=1) == plain_search(docs, items[:5], 1)


def test_a_very_long_text(spark, documents):
    docs = [(1, "long " * 300_000 + "rare"), (2, "rare"), (3, "long")]
    assert found(treap.build_index(documents(docs)), [(0, "rare long")], spark) == plain_search(docs, [(0, "rare long")])


def test_empty_tables(spark, documents):
    assert found(treap.build_index(documents([])), [(1, "a")], spark) == []
    assert found(treap.build_index(documents([(1, None), (2, "?")])), [(1, "a")], spark) == []
    assert treap.search(treap.build_index(documents([(1, "a")])), spark.createDataFrame([], "item_id bigint, text string")).count() == 0


def test_query_against_plain_search(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    got = queries.op12_k2_treap(spark, sf).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_search(docs, items)
