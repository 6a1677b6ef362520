"""URL filter: rules, and a ratio of character language models for the urls no rule fits.

Rules name a host (with its subdomains) and a path prefix; the longest that fits decides. The urls
that rules allow and block are the accepted and rejected training sets of two character models of
variable order: an n-gram's probability mixes the counts of all its shorter contexts, the longest
that was seen weighing most (Dirichlet smoothing from order to order). A url's score is its
log-likelihood difference divided by its length. The models are fitted on one half of the ruled
urls, by a hash of the url, and the threshold is calibrated on the other half: the score at which
accepted and rejected urls are told apart best on average.

Everything is DataFrame code. One aggregation counts the longest n-grams of all urls; shorter ones
are rolled up from it, and the weights are joined back to the urls' n-grams. Partial aggregation
keeps frequent n-grams from being shuffled once per url, and the joins are ordinary ones that
adaptive execution splits where a key is hot. What is joined and summed carries 16 bytes of hash in
a url's place (equal urls are scored once, by these). Rules are literals of the plan.

Defined cases: a null url, or one without ``://``, has an empty host and path and an empty text for
the models, whose score is 0; without a training set of both kinds every score is 0 and the
threshold 0, so the verdict is ``allow``; repeated and null page ids are judged row by row; an
empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpi_lake.llm.common import lower_ascii, materialise

ORDER = 3
SMOOTHING = 4.0
#: Probability that every order-0 model gives any character before counting.
FLOOR = 1.0 / 1024
BINS = 2000
# The two halves of a text's hash.
KEYS = ["k1", "k2"]
#: Different urls whose n-grams one task makes.
TASK_URLS = 4000
RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits, or null."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(slash + rest))
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def rule_verdict(rule: Column, rules: list[tuple[str, str]] = RULES) -> Column:
    return reduce(lambda out, r: F.when(rule == r[0], F.lit(r[1])).otherwise(out), rules, F.lit(None).cast("string"))


def model_text(url: Column) -> Column:
    """What the models read: the url after ``://``, A-Z lower-cased."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)), F.lit(""))


def ngrams(text: Column, order: int = ORDER) -> Column:
    """Of each character, and of the end: the character with the ``order`` before it."""
    chars = F.concat(F.array(*[F.lit("\x02")] * order), F.filter(F.split(text, ""), lambda c: c != ""), F.array(F.lit("\x03")))
    places = F.sequence(F.lit(0), F.size(chars) - order - 1)
    grams = F.transform(places, lambda i: F.concat(*[F.get(chars, i + k) for k in range(order + 1)]))
    return F.when(text != "", grams).otherwise(F.array().cast("array<string>"))


def text_keys(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias(KEYS[0]), F.xxhash64(F.lit(1), text).alias(KEYS[1])]


def gram_weights(counts: DataFrame, order: int = ORDER, smoothing: float = SMOOTHING) -> DataFrame:
    """``gram, weight`` from ``gram, accepted, rejected`` (counts, zero for unseen): the logarithm
    of the smoothed probabilities' ratio."""
    found = counts
    for k in range(order + 1):  # shorter n-grams and their contexts, rolled up from the longest
        found = found.withColumn(f"g{k}", F.expr(f"substring(gram, {order + 1 - k}, {k + 1})"))
        found = found.withColumn(f"c{k}", F.expr(f"substring(gram, {order + 1 - k}, {k})"))
    probabilities = {"accepted": F.lit(FLOOR), "rejected": F.lit(FLOOR)}
    base = found
    for k in range(order + 1):
        for part in ("g", "c"):
            total = base.groupBy(f"{part}{k}").agg(*[F.sum(side).alias(f"{part}{k}_{side}") for side in probabilities])
            found = found.join(total, f"{part}{k}")
        probabilities = {
            side: (F.col(f"g{k}_{side}") + smoothing * p) / (F.col(f"c{k}_{side}") + smoothing) for side, p in probabilities.items()
        }
    return found.select("gram", (F.log(probabilities["accepted"]) - F.log(probabilities["rejected"])).alias("weight"))


def judge_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: list[tuple[str, str]] = RULES,
    order: int = ORDER,
    smoothing: float = SMOOTHING,
) -> DataFrame:
    """Per row ``page_id, host, path, rule, verdict, score, threshold``."""
    urls = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    judged = urls.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), model_text(F.col("url")).alias("text"))
    judged = judged.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    judged = judged.withColumn("ruled", rule_verdict(F.col("rule"), rules))
    # Equal urls are scored once.
    texts = judged.groupBy("text").agg(
        F.sum((F.col("ruled") == "allow").cast("bigint")).alias("accepted"), F.sum((F.col("ruled") == "block").cast("bigint")).alias("rejected")
    )
    texts = texts.select(
        *text_keys(F.col("text")), "text", F.coalesce("accepted", F.lit(0)).alias("accepted"), F.coalesce("rejected", F.lit(0)).alias("rejected")
    ).withColumn("fitted", F.pmod("k1", F.lit(2)) == 0)
    texts = materialise(texts, "url_texts")
    # A url makes many n-grams: urls are dealt by number, not by their few bytes.
    texts = texts.repartition(1 + texts.count() // TASK_URLS, *KEYS)
    use = F.when(F.col("fitted"), F.lit(1)).otherwise(F.lit(0))
    grams = texts.select(F.explode(ngrams(F.col("text"), order)).alias("gram"), (F.col("accepted") * use).alias("accepted"), (F.col("rejected") * use).alias("rejected"))
    counts = materialise(grams.groupBy("gram").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")), "url_grams")
    weights = gram_weights(counts, order, smoothing)
    scored = (
        texts.select(*KEYS, F.explode(ngrams(F.col("text"), order)).alias("gram"))
        .join(weights, "gram")
        .groupBy(*KEYS)
        .agg((F.sum("weight") / F.count(F.lit(1))).alias("score"))
    )
    scored = materialise(texts.select(*KEYS, "accepted", "rejected", "fitted").join(scored, KEYS, "left").fillna(0.0, ["score"]), "url_scores")
    threshold = calibrate(scored.where("not fitted"))
    both = scored.agg(F.sum(F.col("accepted") * use), F.sum(F.col("rejected") * use)).first()
    if not both[0] or not both[1]:
        scored, threshold = scored.withColumn("score", F.lit(0.0)), 0.0
    judged = judged.select("page_id", "host", "path", "rule", "ruled", *text_keys(F.col("text")))
    return judged.join(scored.select(*KEYS, "score"), KEYS).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", F.when(F.col("score") >= threshold, F.lit("allow")).otherwise(F.lit("block"))).alias("verdict"),
        "score",
        F.lit(threshold).alias("threshold"),
    )


def calibrate(scored: DataFrame, bins: int = BINS) -> float:
    """The threshold at which the shares of accepted urls at or above it and of rejected ones below
    it are largest on average; read from a histogram of ``bins`` equal steps, 0 without both kinds."""
    ruled = scored.where("accepted + rejected > 0")
    low, high, n_accepted, n_rejected = ruled.agg(F.min("score"), F.max("score"), F.sum("accepted"), F.sum("rejected")).first()
    if not n_accepted or not n_rejected or low == high:
        return 0.0
    step = (high - low) / bins
    place = F.least(F.floor((F.col("score") - low) / step), F.lit(bins - 1)).alias("bin")
    histogram = ruled.groupBy(place).agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r")).orderBy("bin").collect()
    best, cut, below_a, below_r = -1.0, low, 0, 0
    for row in histogram:
        worth = (n_accepted - below_a) / n_accepted + below_r / n_rejected
        if worth > best:
            best, cut = worth, low + row.bin * step
        below_a, below_r = below_a + row.a, below_r + row.r
    return float(cut)
