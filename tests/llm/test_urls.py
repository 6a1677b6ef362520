"""URL filter: hosts, paths, rules and the model against plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from kpi_lake.llm import urls

RULES = dict(urls.RULES)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule(host, path):
    fits = []
    for r in RULES:
        domain, _, rest = r.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + rest):
            fits.append(r)
    return max(fits, key=len, default=None)


def sample():
    made = random.Random(9)
    out = [None, "", "no scheme", "://", "http://", "http://COM/", "http://x.com", "http://xcom/", "a://b://c.com/", "http://www.example.com/en/x", "http://m.example.com/en/", "http://example.com/enx", "http://É.com/é?q", "http://a.net/es/?x#y", "http://a.org/" + "x" * 3000]
    for _ in range(400):
        host = made.choice(["www.example", "blog.site", "spam-bets", "ads"]) + made.choice([".com", ".net", ".org"])
        out.append(f"http://{host}/{made.choice(['en', 'es', 'fr', 'de'])}/{made.choice(['news', 'buy-now', 'a'])}{made.randrange(30)}{made.choice(['', '?p=1', '#top'])}")
    return out


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(i, u, "t", "g") for i, u in enumerate(sample())] + [(None, "http://x.org/", "t", "g"), (3, "http://x.org/", "t", "g")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, text string, gram string").repartition(3)
    return rows, urls.judge_urls(frame).collect()


def test_hosts_paths_rules_and_verdicts(judged):
    rows, got = judged
    want = sorted(((i, *parts(u), rule(*parts(u))) for i, u, *_ in rows), key=str)
    assert sorted(((r.page_id, r.host, r.path, r.rule) for r in got), key=str) == want
    for r in got:
        assert r.verdict == (RULES[r.rule] if r.rule else "allow" if r.score >= r.threshold else "block")


def text_of(url):
    return re.sub("[A-Z]", lambda m: m[0].lower(), url.split("://", 1)[1]) if url and "://" in url else ""


def grams(text, n=urls.ORDER):
    chars = "\x02" * n + text + "\x03"
    return [chars[i : i + n + 1] for i in range(len(text) + 1)] if text else []


def test_weights_equal_plain_smoothing(spark):
    made = random.Random(1)
    counts = {"".join(made.choice("ab") for _ in range(4)): (made.randrange(5), made.randrange(5)) for _ in range(12)}
    frame = spark.createDataFrame([(g, a, r) for g, (a, r) in counts.items()], "gram string, accepted bigint, rejected bigint")
    got = {r.gram: r.weight for r in urls.gram_weights(frame).collect()}

    def p(gram, side):
        out = urls.FLOOR
        for k in range(urls.ORDER + 1):
            short = gram[urls.ORDER - k :]
            n = sum(c[side] for g, c in counts.items() if g.endswith(short))
            total = sum(c[side] for g, c in counts.items() if g[urls.ORDER - k : -1] == short[:-1])
            out = (n + urls.SMOOTHING * out) / (total + urls.SMOOTHING)
        return out

    for gram in counts:
        assert got[gram] == pytest.approx(math.log(p(gram, 0)) - math.log(p(gram, 1)))


def test_scores_and_threshold_equal_plain_counting(spark, judged):
    """All of the method: counts of the fitted half, smoothing, mean weights, the calibrated cut."""
    rows, got = judged
    n = urls.ORDER
    ruled = {}
    for _, url, *_ in rows:
        verdict = RULES.get(rule(*parts(url)))
        a, r = ruled.get(text_of(url), (0, 0))
        ruled[text_of(url)] = (a + (verdict == "allow"), r + (verdict == "block"))
    texts = spark.createDataFrame([(t,) for t in ruled], "text string")
    fitted = {r.text for r in texts.where("pmod(xxhash64(text), 2) = 0").collect()}
    counts = ({}, {})  # by model: of each n-gram and context, by length
    for text in fitted:
        for gram in grams(text):
            for k in range(n + 1):
                for side in (0, 1):
                    for part in (("g", gram[n - k :]), ("c", k, gram[n - k : -1])):
                        counts[side][part] = counts[side].get(part, 0) + ruled[text][side]

    def weight(gram):
        p = [urls.FLOOR, urls.FLOOR]
        for k in range(n + 1):
            for side in (0, 1):
                seen, total = counts[side].get(("g", gram[n - k :]), 0), counts[side].get(("c", k, gram[n - k : -1]), 0)
                p[side] = (seen + urls.SMOOTHING * p[side]) / (total + urls.SMOOTHING)
        return math.log(p[0]) - math.log(p[1])

    want = {text: sum(map(weight, grams(text))) / len(grams(text)) if text else 0.0 for text in ruled}
    url_of = {(i, *parts(u)): u for i, u, *_ in rows}
    exact = {}
    for r in got:
        text = text_of(url_of[r.page_id, r.host, r.path])
        assert r.score == pytest.approx(want[text], abs=1e-9)
        exact[text] = r.score
    held = [(exact[t], a, r) for t, (a, r) in ruled.items() if t not in fitted and a + r]
    low, high = min(s for s, *_ in held), max(s for s, *_ in held)
    step = (high - low) / urls.BINS
    bins = [(min(math.floor((s - low) / step), urls.BINS - 1), a, r) for s, a, r in held]
    all_a, all_r = sum(a for _, a, _ in held), sum(r for *_, r in held)

    def worth(cut):
        return sum(a for b, a, _ in bins if b >= cut) / all_a + sum(r for b, _, r in bins if b < cut) / all_r

    best = max(sorted({b for b, *_ in bins}), key=lambda cut: round(worth(cut), 12))
    assert [r.threshold for r in got] == pytest.approx([low + best * step] * len(got))


def test_grams_and_texts(spark):
    rows = [u for u in sample()[:20] if u is not None]
    frame = spark.createDataFrame([(u,) for u in rows], "url string")
    from pyspark.sql import functions as F

    got = frame.select(urls.ngrams(urls.model_text(F.col("url")))).collect()
    assert [Counter(r[0]) for r in got] == [Counter(grams(text_of(u))) for u in rows]


def test_the_model_tells_ruled_urls_apart(judged):
    _, got = judged
    ruled = [(r.score >= r.threshold, RULES[r.rule] == "allow") for r in got if r.rule]
    right = sum(a == b for a, b in ruled) / len(ruled)
    assert right > 0.9


def test_without_both_kinds_and_empty(spark):
    frame = spark.createDataFrame([(1, "http://a.org/x"), (2, "http://b.com/")], "page_id bigint, url string")
    assert {(r.page_id, r.verdict, r.score, r.threshold) for r in urls.judge_urls(frame).collect()} == {(1, "allow", 0.0, 0.0), (2, "allow", 0.0, 0.0)}
    assert urls.judge_urls(frame.limit(0)).count() == 0


def test_plan_holds_no_python(spark):
    frame = spark.createDataFrame([(1, "http://a.org/x")], "page_id bigint, url string")
    plan = urls.judge_urls(frame)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|CartesianProduct", plan)
