"""Contexts of whole words against dictionaries of word histories."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from kpi_lake.llm import suffix_tree
from tests.llm.test_suffix_tree import brute, out_of, tokens

DEPTH, LEAST = 5, 3


def word_histories(words):
    for i, w in enumerate(words):
        yield w, [tuple(([None] * n + words[:i])[-n:]) if i < n else tuple(words[i - n : i]) for n in range(1, DEPTH + 1)]


def start_once(context):
    """One mark stands for all that lies before the text."""
    known = [w for w in context if w is not None]
    return tuple(known) if len(known) == len(context) else (None, *known)


def brute_deep(rows, gain=suffix_tree.GAIN, least=LEAST):
    shallow, p, _, count, _ = brute(rows, gain)
    after = defaultdict(Counter)
    parents = {}
    mark = bytes([suffix_tree.MARK])
    for i, t in rows:
        if not out_of(i):
            before = mark + mark
            for w, contexts in word_histories(tokens(t)):
                last = ("bytes", before)
                for c in dict.fromkeys(map(start_once, contexts)):
                    after[c][w] += 1
                    parents[c] = last
                    last = ("words", c)
                before = (mark + w)[-2:]
    states = set()
    for c, found in after.items():
        kind, shorter = parents[c]
        above = count[2][shorter] if kind == "bytes" else after[shorter]
        size, total = sum(found.values()), sum(above.values())
        gained = sum(n * (math.log(n / size) - math.log(above[w] / total)) for w, n in found.items())
        if size >= least and gained >= gain * len(found):
            states.add(c)
    made = []
    for (i, *_), (_, t) in zip(shallow, rows, strict=True):
        score, before = 0.0, mark + mark
        for w, contexts in word_histories(tokens(t)):
            out = p(w, before)
            for c in dict.fromkeys(map(start_once, contexts)):
                if c in states:
                    out = (after[c][w] + len(after[c]) * out) / (sum(after[c].values()) + len(after[c]))
            score += math.log10(out)
            before = (mark + w)[-2:]
        made.append((i, len(tokens(t)), score))
    return made, states


@pytest.fixture(scope="module")
def rows():
    """What follows is told by the whole previous word (york, work), or by the word three before."""
    made, out = random.Random(5), [(None, None), (1, ""), (2, "york"), (2, "york")]
    for i in range(3, 260):
        words = []
        for _ in range(made.randrange(1, 12)):
            far = made.choice(["red", "bed"])
            words += [far, "is", "it", {"red": "yes", "bed": "no"}[far], *made.choice([["york", "town"], ["work", "hard"]])]
        out.append((i, " ".join(w if made.random() < 0.97 else f"x{made.randrange(50)}" for w in words)))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_deep_scores_equal_dictionaries(documents, rows, small):
    options = {"bucket_pairs": 40} if small else {}
    got = suffix_tree.score_documents(documents(rows), depth=DEPTH, least=LEAST, **options).collect()
    want, states = brute_deep(rows)
    assert {("york",), ("work",)} <= {tuple(w.decode() for w in c) for c in states if None not in c and len(c) == 1}
    assert max(len(c) for c in states) > 2
    for a, b in zip(sorted(got, key=lambda r: (str(r.id), r.n_tokens, r.score)), sorted(want, key=lambda r: (str(r[0]), r[1], r[2])), strict=True):
        assert (a.id, a.n_tokens) == b[:2] and a.score == pytest.approx(b[2])


def test_query_reads_far_contexts(spark, documents, rows, tmp_path):
    from kpi_lake.llm import queries

    documents(rows).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.doc_id or -1, r.score) for r in queries.op1_suffix_tree(spark, str(tmp_path)).collect())
    assert suffix_tree.DEPTH == DEPTH
    want = sorted((r[0] or -1, r[2]) for r in brute_deep(rows, least=suffix_tree.LEAST)[0])
    assert [g[0] for g in got] == [w[0] for w in want]
    assert [g[1] for g in got] == pytest.approx([w[1] for w in want])


def test_a_state_keeps_only_what_longer_contexts_refer_to():
    """Two texts of three tokens; the second's first word is too rare to be a context. Its next token is
    settled at once, and that token's pair isn't kept."""
    lengths, none = np.array([3, 3]), np.zeros(6, bool)
    p = np.array([0.5, 0.25, 0.125, 0.5, 0.01, 0.125])
    pair, counts = np.arange(6), np.array([9, 9, 9, 1, 9, 9])
    level = suffix_tree.Level(pair, pair, pair, none, counts, p, counts, pair, pair.astype(np.uint64) + np.uint64(7), counts)
    found = suffix_tree.longer(level, lengths, np.array([-1.0, -1.0]), 9, LEAST)
    assert found["score"].tolist() == pytest.approx([-1.0, -1.0 + math.log10(0.01)])
    assert found["p_before"].tolist() == [0.5, 0.25, 0.125, 0.5, 0.125]
    assert found["shorter"].tolist() == list(range(5)) and found["token"].tolist() == [0, 1, 2, 3, 5]


def test_rare_contexts_are_settled_in_their_buckets(documents, rows, monkeypatch):
    """Blocks ask for totals only of contexts that are found more often than half of ``bucket_pairs``."""
    asked, tally = [], suffix_tree.tally
    monkeypatch.setattr(suffix_tree, "tally", lambda *a: (asked.append(1), tally(*a))[1])
    assert suffix_tree.score_documents(documents(rows), depth=DEPTH, least=LEAST).count() == len(rows)
    assert not asked
    suffix_tree.score_documents(documents(rows), depth=DEPTH, least=LEAST, bucket_pairs=400)
    assert 0 < len(asked) <= DEPTH


def test_scores_of_likely_texts_keep_their_precision(documents):
    rows = [(i, "a b c d " * 700) for i in range(8)]
    got = {r.id: r.score for r in suffix_tree.score_documents(documents(rows), depth=DEPTH, least=LEAST).collect()}
    want = {i: score for i, _, score in brute_deep(rows)[0]}
    assert got == pytest.approx(want, rel=1e-7)


def test_tokens_equal_pythons_words():
    texts = ["A b\x0bc", "", " \t\r\n\x0c", "Ä\x85ß\u00a0x\x1cy  Z", "x" * 90, "a\x00b a\x00B", " END "]
    table = suffix_tree._numbers()
    lengths, numbers = suffix_tree.tokens_of(pa.array(texts), table)
    words = list(table)
    assert lengths.tolist() == [len(t) for t in map(tokens, texts)]
    assert [words[t] for t in numbers.tolist()] == [w for text in texts for w in tokens(text)]


def test_orders_equal_numpys():
    made = np.random.default_rng(3)
    for keys in (made.integers(0, 1 << 64, 500, np.uint64), made.integers(0, 9, 500).astype(np.uint64), (np.uint64(1) << np.uint64(63)) - np.arange(500, dtype=np.uint64), np.zeros(0, np.uint64)):
        assert keys[suffix_tree.order_of(keys)].tolist() == np.sort(keys).tolist()
    for keys in (made.integers(0, 40, 500), made.integers(0, 1 << 62, 500), np.zeros(0, np.int64)):
        for a, b in zip(suffix_tree.distinct(keys), np.unique(keys, return_inverse=True), strict=True):
            assert a.tolist() == b.tolist()


def test_a_deal_has_few_rows_which_are_settled_in_pieces(documents, monkeypatch):
    """Rows number as many as blocks times buckets, so buckets hold several pieces of what is settled at once."""
    made, dealt, settle = random.Random(7), [], suffix_tree.settle
    words = [f"w{i}" for i in range(400)] * 5
    made.shuffle(words)
    rows = [(i, " ".join(words[i * 20 : i * 20 + 20])) for i in range(100)]
    monkeypatch.setattr(suffix_tree, "settle", lambda df, *a: (dealt.append(df.count()), settle(df, *a))[1])
    got = suffix_tree.score_documents(documents(rows).coalesce(1), depth=DEPTH, least=LEAST, gain=0.1, bucket_pairs=20).collect()
    assert 0 < sum(dealt) <= 2 * 2100 / 20 / 3
    want, states = brute_deep(rows, gain=0.1)
    assert len(states) > 20
    assert {r.id: r.score for r in got} == pytest.approx({i: score for i, _, score in want})


def test_late_rounds_go_on_from_states(documents, monkeypatch):
    """From the third round on no block is read, as its texts' lengths would show."""
    plans, materialise = [], suffix_tree.materialise
    monkeypatch.setattr(suffix_tree, "materialise", lambda df, name: (plans.append((name, df._jdf.queryExecution().optimizedPlan().toString())), materialise(df, name))[1])
    rows = [(i, f"{'a b c d e f ' * 3}x{i % 30} y{i % 7}") for i in range(60)]
    got = suffix_tree.score_documents(documents(rows), depth=DEPTH, least=LEAST, bucket_pairs=60).collect()
    asked = ["lengths" in plan for name, plan in plans if name in ("asked", "totals")]
    assert sum(asked) == 2 and len(asked) == 1 + 2 * (DEPTH - 1)
    want = {i: score for i, _, score in brute_deep(rows)[0]}
    assert {r.id: r.score for r in got} == pytest.approx(want)


def test_a_deal_of_few_tokens_has_few_buckets(documents, monkeypatch):
    """The tokens after one frequent word, which are dealt by longer contexts, don't get as many buckets as the rest."""
    made, buckets, settle = random.Random(9), [], suffix_tree.settle
    words = [f"w{i}" for i in range(400)] * 5
    made.shuffle(words)
    rows = [(i, " ".join(words[i * 20 : i * 20 + 20] + [f"a{i % 10}", "the", f"w{i}"] * (i < 60))) for i in range(100)]
    monkeypatch.setattr(suffix_tree, "settle", lambda df, *a: (buckets.extend(r.bucket for r in df.collect()), settle(df, *a))[1])
    got = suffix_tree.score_documents(documents(rows), depth=DEPTH, least=LEAST, gain=0.1, bucket_pairs=20).collect()
    of_rest = -(-2 * (2000 + 180 + 100) // (suffix_tree.PIECES * 20))
    assert 0.8 * of_rest < max(buckets) - min(buckets) < 1.2 * of_rest
    want, states = brute_deep(rows, gain=0.1)
    assert any(len(c) == 2 for c in states)
    assert {r.id: r.score for r in got} == pytest.approx({i: score for i, _, score in want})
