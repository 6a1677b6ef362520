"""Spelling variants: trie search against comparing all pairs, counts and forms against plain code."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpi_lake.llm import queries, variants


def plain_one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(counts: dict[str, int], ratio: int = 5) -> set[tuple]:
    """Near words by shared one-letter deletions, forms and roots one after another."""
    shared: dict[str, set] = {}
    for w in counts:
        for k in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            shared.setdefault(k, set()).add(w)
    near = {w: {o for k in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))} for o in shared[k] if plain_one_edit(w, o)} for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), counts[w], len(near[w]), counts.get(form[w])) for w in counts}


def plain_counts(rows) -> Counter:
    found: Counter = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % 199 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= 6:
                found[w] += 1
    return Counter({w: n for w, n in found.items() if n >= 5})


def vocabulary(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(3)


def made_words(seed: int, n: int, alphabet: str, longest: int) -> dict[str, int]:
    rng = random.Random(seed)
    words: set[str] = set()
    while len(words) < n:
        w = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, longest)))
        words.add(w)
        if rng.random() < 0.5:
            i = rng.randrange(len(w))
            words.add(rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(alphabet) + w[i + 1 :], w[:i] + rng.choice(alphabet) + w[i:]]) or "a")
    return {w: rng.choice([1, 2, 5, 10, 25, 50, 125, 700, 5000]) for w in words}


@pytest.mark.parametrize(("alphabet", "longest", "share"), [("ab", 9, 7), ("abcdefghij", 7, 20), ("aqbrçé日𝄞", 6, 8192), ("a", 400, 5), ("ab", 70, 30)])
def test_groups_equal_plain_ones(spark, alphabet, longest, share):
    counts = made_words(longest, 300, alphabet, longest)
    got = {tuple(r) for r in variants.group_variants(vocabulary(spark, counts), share=share).collect()}
    assert got == plain_groups(counts)


def test_equal_vectors_beyond_a_share(spark):
    """All words have one vector: they're dealt by hash, and no pair is lost."""
    counts = {w: i + 1 for i, w in enumerate(sorted({"".join(x) for x in __import__("itertools").product("aq", repeat=7)}))}
    assert len({bytes(v[: variants._LEVELS]) for v in variants.vectors(list(counts))}) == 1
    got = {tuple(r) for r in variants.group_variants(vocabulary(spark, counts), share=4).collect()}
    assert got == plain_groups(counts)


def test_verification_of_words_of_any_length():
    rng = random.Random(3)
    for size in (1, 5, 64, 65, 300):
        a = "".join(rng.choice("abc") for _ in range(size))
        others = [a, a + "a", a[1:] + "b", a[:-1], "b" + a, a[: size // 2] + "cc" + a[size // 2 :], a[: size // 2] + "é" + a[size // 2 + 1 :]]
        assert [variants.one_edit(a, o) for o in others] == [plain_one_edit(a, o) for o in others]
        pairs = [(a, o) for o in others if o and len(o) >= len(a)]
        asked, stored = variants.Letters([p[0] for p in pairs]), variants.Letters([p[1] for p in pairs])
        places = np.arange(len(pairs))
        assert variants.verify(asked, stored, places, places).tolist() == [plain_one_edit(*p) for p in pairs]


def test_a_word_is_sent_to_few_nodes():
    counts = made_words(5, 2000, "abcdefghijklmnop", 9)
    found = variants.vectors(list(counts))
    split = {b""} | {bytes(v[:k]) for v in found for k in (1, 2)}
    sent = [variants.routes(bytes(v), split) for v in found]
    assert all(len(set(s)) == len(s) for s in sent)
    assert max(map(len, sent)) <= 8


def test_counting(spark, documents):
    rng = random.Random(1)
    words = ["Straße", "ÉCOLE", "école", "counting", "COUNTING", "a×b÷c", "naïveté", "ŒUVRE", "日本語counting", "it's"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(200))) for i in range(40)] + [(None, "counting " * 7), (3, "counting " * 7), (5, None), (6, ""), (7, "q" * 100_000)] * 5
    got = {r.word: r.n for r in variants.count_words(documents(rows), typo_every=199).collect()}
    assert got == plain_counts(rows)


def test_empty_tables(spark, documents):
    assert variants.group_variants(variants.count_words(documents([]))).count() == 0
    assert variants.group_variants(variants.count_words(documents([(1, None), (2, "rare words")]))).count() == 0


def test_chains_end_at_the_last_form(spark):
    counts = {"a" * (6 + i): 5 ** (i + 1) for i in range(12)}
    got = {r.word: r.root for r in variants.group_variants(vocabulary(spark, counts)).collect()}
    assert set(got.values()) == {"a" * 17}


def test_query_against_plain_code(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = queries.op11_frequency_trie(spark, "/root/testdata/sf0.001").select("word", "form", "root", "n", "n_near", "form_n")
    assert {tuple(r) for r in got.collect()} == plain_groups(plain_counts(rows))
    assert got.where(F.col("form").isNotNull()).count() > 0
