"""Any benchmark whose items fit is dealt into parts that fit."""

from __future__ import annotations

from kpi_lake.llm import decontam


def test_repeated_wordless_and_large_items_are_dealt(spark):
    large = [(f"l{i}", f"large{i} " * (70 + i % 9)) for i in range(12)]
    rows = [("same", "one two three four " * 40)] * 30 + large + [("empty", ""), ("blank", " .. "), ("none", None)] * 5
    benchmark = spark.createDataFrame(rows, "item_id string, text string")
    parts = decontam._parts(benchmark, "item_id", "text", 13, 1000)
    assert all(sum(len(t) for _, t in p) <= 1000 for p in parts)
    got = sorted((i, t.decode()) for p in parts for i, t in p)
    assert got == sorted(set(rows[:1] + large))


def test_an_item_beyond_the_limit_is_cut_into_its_windows():
    for n in (1, 13, 14, 200):
        words = [b"w%d" % i for i in range(n)]
        for limit in (1, 60, 10_000):
            pieces = decontam.cut_item(b" ".join(words), 13, limit)
            found = {w for p in pieces for w in decontam.windows_of(p.split())}
            assert found == set(decontam.windows_of(words))
            assert all(len(p) <= max(limit, 13 * 5) for p in pieces)


def test_results_do_not_depend_on_the_limit(spark, documents):
    """Items far beyond the limit, one of a single long word: the same hits as with one automaton."""
    long = " ".join(f"word{i}" for i in range(600))
    items = [("long", long), ("short", "just a few words"), ("word", "x" * 3000), (None, "alpha beta " * 10)]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    body = long.split()
    docs = [(1, "before " + " ".join(body[100:130]) + " after"), (2, " ".join(body[:12])), (3, "x" * 3000 + " Just, a FEW words!"), (4, "alpha beta " * 7), (5, None), (6, " ".join(body[300:350] + ["gap"] + body[20:40]))]
    whole = decontam.find_contamination(documents(docs), benchmark, max_broadcast_bytes=1 << 20)
    for limit in (200, 900):
        parts = decontam.find_contamination(documents(docs), benchmark, max_broadcast_bytes=limit)
        assert sorted(map(str, parts.collect())) == sorted(map(str, whole.collect()))
