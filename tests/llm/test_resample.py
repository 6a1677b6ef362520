"""Importance resampling: models, thresholds, top-k, and what it keeps."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from kpi_lake.llm import resample


def test_kth_largest_is_exact(spark):
    made = random.Random(1)
    values = [made.choice([made.gauss(0, 1), 0.25, -3.0, 1e9 * made.random()]) for _ in range(700)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 2, 5, 350, 699):
        assert resample.kth_largest(frame, "v", k, bins=7) == sorted(values, reverse=True)[k - 1]
    assert resample.kth_largest(frame, "v", 0) == math.inf
    assert resample.kth_largest(frame, "v", 700) == -math.inf
    assert resample.kth_largest(frame.limit(0), "v", 3) == -math.inf


def test_best_cut():
    assert resample.best_cut([(1.0, True), (2.0, True)]) == -math.inf
    assert resample.best_cut([(0.0, False), (1.0, False), (2.0, True), (3.0, True)]) == 1.5
    assert resample.best_cut([(5.0, False), (1.0, True)]) == -math.inf


def test_gumbel_noise_depends_on_the_id(spark):
    noise = [r[0] for r in spark.range(4000).select(resample.gumbel(resample.F.col("id"))).collect()]
    assert abs(np.mean(noise) - 0.5772) < 0.1 and abs(np.std(noise) - math.pi / 6**0.5) < 0.1
    assert noise == [r[0] for r in spark.range(4000).select(resample.gumbel(resample.F.col("id"))).collect()]


@pytest.fixture(scope="module")
def corpus(spark):
    """Clean prose, junk, and clean prose with insults; most rows labelled, with odd labels."""
    made = random.Random(2)
    syllables = ["the", "on", "er", "ing", "re", "at", "ed", "is", "en", "or"]

    def word():
        return "".join(made.choice(syllables) for _ in range(made.randrange(1, 4)))

    rows, labels, kinds = [], [], {}
    for i in range(900):
        words = [word() for _ in range(made.randrange(40, 300))]
        kind = made.choice(["clean", "clean", "clean", "junk", "toxic"])
        if kind == "junk":
            words = [w.upper() + made.choice(["!!", "###", "%%"]) for w in words]
        if kind == "toxic":
            for _ in range(4):
                words[made.randrange(len(words))] = made.choice(["idiot", "moron"])
        kinds[i] = kind
        rows.append((i, " ".join(words)))
        if made.random() < 0.6:
            labels.append((i, 0 if kind == "junk" else 1, int(kind == "toxic")))
    rows += [(None, "the on er"), (2000, None), (2001, ""), (2001, "")]
    labels += [(None, 1, 0), (3000, None, None), labels[0]]
    return rows, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), kinds


def test_clean_documents_stay_and_others_go(documents, corpus):
    rows, labels, kinds = corpus
    got = resample.classify(documents(rows), labels).collect()
    assert len(got) == len(rows)
    kept = {kind: [r.kept for r in got if kinds.get(r.id) == kind] for kind in ("clean", "junk", "toxic")}
    assert np.mean(kept["clean"]) > 0.97
    assert np.mean(kept["junk"]) < 0.03
    assert np.mean(kept["toxic"]) < 0.1
    left = resample.resample(documents(rows), labels)
    assert left.columns == documents(rows).columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted((r.id for r in got if r.kept), key=str)


def test_odd_tables(spark, documents, corpus):
    rows, labels, _ = corpus
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert all(r.kept for r in resample.classify(documents(rows[:20]), none).collect())
    assert resample.classify(documents(rows).limit(0), labels).count() == 0
    weights = {r.id: r.log_weight for r in resample.classify(documents(rows), labels).collect()}
    assert weights[2000] == weights[2001] == 0.0
