"""One document of each component stays, whatever the ids."""

from __future__ import annotations

from kpi_lake.llm import minhash


def test_one_stays_with_repeated_or_null_ids(documents):
    words = [f"w{i}" for i in range(200)]
    near = [" ".join([*words, f"e{i}"]) for i in range(3)]
    other = [" ".join([*(f"v{i}" for i in range(200)), f"e{i}"]) for i in range(3)]
    rows = [(5, near[0]), (5, near[1]), (9, near[2]), *[(None, t) for t in other], (None, other[0]), (7, ""), (7, None), (8, " "), (None, None)]
    left = [(r.doc_id, r.text) for r in minhash.deduplicate(documents(rows), percent=80).collect()]
    assert [i for i, t in left if t in near] == [5]
    assert [i for i, t in left if t in other] == [None]
    assert sorted(str(i) for i, t in left if not (t or "").strip()) == ["7", "8", "None"]
