"""Suffix-sort dedup against counting every window."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from kpi_lake.llm import suffix_dedup

LENGTH = 40


def covered(texts, length=LENGTH):
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        hit = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if counts[t[i : i + length]] > 1:
                hit[i : i + length] = True
        out.append(hit)
    return out


def brute(texts):
    out = []
    for t, hit in zip(texts, covered(texts), strict=True):
        kept = bytes(np.frombuffer(t, np.uint8)[~hit])
        edges = np.diff(np.concatenate(([0], hit.view(np.int8), [0])))
        out.append((len(t), int(hit.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def prose(made, n):
    return " ".join(made.choice(["the", "of", "Straße", "onnd", "ereà", "b"]) + made.choice(["", "a", "ing"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    made = random.Random(8)
    passages = [prose(made, made.randrange(3, 30)) for _ in range(8)]
    texts = [None, "", "x" * 100, "x" * (LENGTH - 1), "ab" * 60, passages[0] * 4]
    for _ in range(120):
        kind = made.random()
        if kind < 0.3:
            texts.append(prose(made, made.randrange(40)))
        elif kind < 0.5:
            texts.append(made.choice(texts))
        elif kind < 0.8:
            texts.append(f"{prose(made, made.randrange(10))} {made.choice(passages)} {prose(made, made.randrange(10))}{made.choice(passages)}")
        else:
            letters = list(made.choice(texts) or "q")
            letters[made.randrange(len(letters))] = "Q"
            texts.append("".join(letters))
    return [(i if i % 9 else None if i % 2 else 18, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("max_contexts", [20_000, 2])
def test_removed_bytes_equal_brute_force(documents, rows, max_contexts):
    """With ``max_contexts`` 2 most anchors are hot and take the rounds that split them."""
    got = suffix_dedup.remove_repeats(documents(rows), length=LENGTH, max_contexts=max_contexts, digests=True).collect()
    want = brute([(t or "").encode() for _, t in rows])
    assert sorted(((r.id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str) == sorted(
        ((i, *w) for (i, _), w in zip(rows, want, strict=True)), key=str
    )


def test_texts_are_cut_and_emptied_documents_go(documents, rows):
    left = suffix_dedup.remove_repeats(documents(rows), length=LENGTH)
    want = []
    texts = [(t or "").encode() for _, t in rows]
    for (i, t), raw, hit in zip(rows, texts, covered(texts), strict=True):
        kept = bytes(np.frombuffer(raw, np.uint8)[~hit])
        if not hit.any() or kept.split():
            want.append((i, None if t is None else kept.decode("utf-8", "ignore")))
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(want, key=str)
    assert left.columns == documents(rows).columns


def test_small_memory_settings_change_nothing(documents, rows, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 300)
    texts = [(t or "").encode() for _, t in rows]
    found = Counter()
    for part in suffix_dedup._pieces(texts, LENGTH):  # noqa: SLF001
        for number, offset, piece in part:
            assert texts[number][offset : offset + len(piece)] == piece
            found.update((number, offset + i) for i in range(len(piece) - LENGTH + 1))
    assert found == Counter((k, i) for k, t in enumerate(texts) for i in range(len(t) - LENGTH + 1))


def test_the_gathering_stream_holds_little_and_loses_nothing(monkeypatch):
    made = random.Random(3)
    rows = sorted((made.choice([1, 1, 1, 1, 2, 3, made.randrange(100)]), made.choice([5, 5, 5, made.randrange(1000)])) for _ in range(4000))
    table = np.array([(k, c, i, 0, 0, 0, 0, 0) for i, (k, c) in enumerate(rows)], np.int64).T

    def run(held, step):
        monkeypatch.setattr(suffix_dedup, "HELD_ROWS", held)
        gatherer, out = suffix_dedup._Gatherer(), []  # noqa: SLF001
        for at in range(0, table.shape[1], step):
            out.append(gatherer.take(table[:, at : at + step]))
            assert gatherer.rows.shape[1] <= held + step + 2
        out.append(gatherer.take(None))
        whole = {int(i) for x in out if x for i, kind in zip(x[0][2], x[1], strict=True) if kind == 0}
        others = Counter((int(k), int(c)) for x in out if x for k, c, kind in zip(x[0][0], x[0][1], x[1], strict=True) if kind)
        return whole, others

    want = run(10**9, 4000)
    for held, step in ((200, 100), (50, 7), (3, 1)):
        whole, others = run(held, step)
        assert whole == want[0]
        assert set(others) == set(want[1])


def test_mergesort_sorts_and_finds_prefixes():
    made = random.Random(4)
    data = np.frombuffer(bytes(made.choice(b"ab") for _ in range(600)) + b"\0" * LENGTH, np.uint8)
    table = suffix_dedup.PrefixHashes(data)
    suffixes = np.array(made.sample(range(560), 300))
    lists = np.sort(np.array([made.randrange(9) for _ in range(300)]))
    ordered = suffix_dedup.sort_suffixes(table, data, suffixes, lists, LENGTH)
    raw = data.tobytes()
    for k in range(9):
        want = sorted(suffixes[lists == k].tolist(), key=lambda s: raw[s : s + LENGTH])
        assert [raw[s : s + LENGTH] for s in ordered[lists == k]] == [raw[s : s + LENGTH] for s in want]
    common = suffix_dedup.compare_suffixes(table, data, suffixes[:-1], suffixes[1:], LENGTH)
    for a, b, n in zip(suffixes[:-1], suffixes[1:], common, strict=True):
        assert raw[a : a + n] == raw[b : b + n] and (n == LENGTH or raw[a + n] != raw[b + n])


def test_empty_table(documents):
    assert suffix_dedup.remove_repeats(documents([(1, "a")]).limit(0), digests=True).count() == 0
