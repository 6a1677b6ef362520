"""Suffix-tree scoring against a plain dictionary version."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from kpi_lake.llm import suffix_tree


def tokens(text):
    return [*(text or "").encode().lower().split(), suffix_tree.END_TOKEN]


def out_of(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def histories(words):
    mark = bytes([suffix_tree.MARK])
    before = mark + mark
    for w in words:
        yield w, before
        before = (mark + w)[-2:]


def brute(rows, gain=suffix_tree.GAIN):
    """Scores by counting suffixes in dictionaries."""
    count = {n: defaultdict(Counter) for n in (0, 1, 2)}
    for i, t in rows:
        if not out_of(i):
            for w, before in histories(tokens(t)):
                for n in (0, 1, 2):
                    count[n][before[2 - n :]][w] += 1
    root = count[0][b""]
    total, types = sum(root.values()), len(root)
    states = set()
    for n in (2, 1):
        for s, after in count[n].items():
            parent = count[n - 1][s[1:]]
            size, above = sum(after.values()), sum(parent.values())
            gained = sum(c * (math.log(c / size) - math.log(parent[w] / above)) for w, c in after.items())
            if gained >= gain * len(after) or any(x[1:] == s for x in states if len(x) == n + 1):
                states.add(s)

    def p(w, before):
        out = (root[w] or max(types, 1)) / max(total + types, 1)
        for n in (1, 2):
            s = before[2 - n :]
            if s in states:
                after = count[n][s]
                out = (after[w] + len(after) * out) / (sum(after.values()) + len(after))
        return out

    made = []
    for i, t in rows:
        words = tokens(t)
        base = sum(math.log10((root[w] + 1) / (total + types + 1)) for w in words)
        score = sum(math.log10(p(w, before)) for w, before in histories(words))
        made.append((i, out_of(i), len(words), sum(w in root for w in words), total, base, score))
    return made, p, root, count, states


@pytest.fixture(scope="module")
def rows():
    made = random.Random(11)
    common = {"en": ["the", "of", "and", "ing", "A"], "de": ["der", "und", "ßig", "ein", "Ü"]}
    out = [(None, "the end"), (None, None), (1, ""), (2, " \n"), (3, "the of"), (3, "the of"), (4, "x" * 3000)]
    for i in range(5, 150):
        words = common[made.choice(["en", "de"])]
        out.append((i, " ".join(made.choice(words) + made.choice(["", "", str(made.randrange(40))]) for _ in range(made.randrange(60)))))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_scores_equal_plain_counting(documents, rows, small, monkeypatch):
    options = {"bucket_pairs": 50} if small else {}
    got = suffix_tree.score_documents(documents(rows), **options).collect()
    want, *_ = brute(rows)
    assert len(got) == len(rows)
    for a, b in zip(sorted(got, key=lambda r: (str(r.id), r.n_tokens, r.score)), sorted(want, key=lambda r: (str(r[0]), r[2], r[6])), strict=True):
        assert tuple(a)[:5] == b[:5]
        assert a.base_score == pytest.approx(b[5]) and a.score == pytest.approx(b[6])


def test_distributions_sum_to_one(rows):
    _, p, root, _, states = brute(rows)
    assert states
    for before in (b"\xfe\xfe", b"he", b"er", b"zz", b"ng"):
        assert sum(p(w, before) for w in root) + p(b"never seen", before) == pytest.approx(1)


def test_held_out_texts_score_better_than_the_base(documents, rows):
    held = [r for r in suffix_tree.score_documents(documents(rows)).collect() if r.held_out and r.n_tokens > 1]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_empty_and_untrained(documents):
    assert suffix_tree.score_documents(documents([(1, "a")]).limit(0)).count() == 0
    lone = next(i for i in range(100) if out_of(i))
    row = suffix_tree.score_documents(documents([(lone, "a b")])).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (True, 3, 0, 0, 0.0, 0.0)
