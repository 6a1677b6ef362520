"""Benchmark decontamination against looking for every window at every place."""

from __future__ import annotations

import random
import re

import pytest

from kpi_lake.llm import decontam

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    words, hit, ids = words_of(text), set(), set()
    for item, item_text in items:
        its = words_of(item_text)
        for k in range(max(1, len(its) - 12)) if its else ():
            window = its[k : k + 13]
            for i in range(len(words) - len(window) + 1):
                if words[i : i + len(window)] == window:
                    hit.update(range(i, i + len(window)))
                    ids.add("null" if item is None else str(item))
    return len(words), len(hit), sorted(ids)


@pytest.fixture(scope="module")
def cases():
    made = random.Random(4)

    def prose(n):
        return "".join(made.choice(["The", "of", "Été", "x1", "naïve", "A"]) + made.choice([" ", ", ", ".\n", "-"]) for _ in range(n))

    items = [(i, prose(made.randrange(14, 30))) for i in range(12)] + [(50, "Tiny item"), (51, ""), (52, None), (None, prose(15)), (2, "again another text")]
    docs = [(0, None), (1, ""), (2, "... !!"), (3, "a tiny ITEM, twice: tiny-item"), (4, items[0][1]), (4, items[0][1])]
    for i in range(5, 60):
        parts = [prose(made.randrange(40))]
        if made.random() < 0.6:
            parts.append(made.choice(items[:12])[1][: made.randrange(20, 200)])
        docs.append((i, " ".join([*parts, prose(made.randrange(40))])))
    return items, docs


@pytest.mark.parametrize("limit", [64 << 20, 1200])
def test_hits_equal_brute_force(spark, documents, cases, limit):
    items, docs = cases
    benchmark = spark.createDataFrame([(i, t, "q") for i, t in items], "item_id bigint, text string, doc_id string")
    got = decontam.find_contamination(documents(docs), benchmark, max_broadcast_bytes=limit).collect()
    want = sorted((i, *brute(t, items)) for i, t in docs)
    assert sorted((r.id, r.n_words, r.n_hit, r["items"]) for r in got) == want
    by_id = dict(docs)
    for r in got:
        assert sum(x["end"] - x["start"] for x in r.word_runs) == r.n_hit
        for run, span in zip(r.word_runs, r.spans, strict=True):
            original = by_id[r.id][span["start"] : span["end"]]
            assert words_of(original) == words_of(by_id[r.id])[run["start"] : run["end"]]


def test_contaminated_documents_go(spark, documents, cases):
    items, docs = cases
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    left = decontam.remove_contaminated(documents(docs), benchmark)
    want = []
    for i, t in docs:
        n, hit, _ = brute(t, items)
        if not (hit and 20 * hit >= n):
            want.append(i)
    assert sorted(r.doc_id for r in left.collect()) == sorted(want)
    assert left.columns == documents(docs).columns
    again = decontam.remove_contaminated(documents(docs), benchmark, max_broadcast_bytes=1200)
    assert sorted(r.doc_id for r in again.collect()) == sorted(want)


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontam.find_contamination(documents([(1, "a b")]), none).first().n_hit == 0
    assert decontam.find_contamination(documents([(1, "a")]).limit(0), none).count() == 0


def test_an_item_beyond_the_limit_is_found(spark, documents):
    """A long item was an error once; it's cut into pieces with its windows."""
    benchmark = spark.createDataFrame([(1, "w " * 2000)], "item_id bigint, text string")
    found = decontam.find_contamination(documents([(1, "w " * 20), (2, "w " * 12)]), benchmark, max_broadcast_bytes=1000)
    assert sorted((r.id, r.n_hit, r["items"]) for r in found.collect()) == [(1, 20, ["1"]), (2, 0, [])]
