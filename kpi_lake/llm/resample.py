"""Quality classifier by importance resampling.

A document's features are its hashed n-grams, in five families of a fixed number of buckets: words,
neighbouring pairs of words (all pairs of equal words are one feature), runs of three bytes, and,
by two hashes, distinct words. Over each family the raw generative model counts all documents, the target model
the documents labelled good and not toxic, the toxic model those labelled toxic. A bucket's ratio to
the raw model is smoothed as ``(seen + a) / (expected + a)``. A document's log weight is its
target's log ratio per feature, summed over the first three families and brought to a length of
``length`` features, so that documents of all lengths compare. Its clean weight is the sum, over its
distinct words whose toxic count stands out under both hashes (so that a word that only shares a
bucket doesn't count), of the target's minus the toxic model's log ratio. Half of the sampled labels (by a hash of the id) fit the models, the other half calibrate two
thresholds: the log weight that tells good from bad best, and the clean weight that tells clean from
toxic best. The sample keeps the k documents with the largest log weight plus Gumbel noise among
those that pass for clean, k being the number of all documents that reach both thresholds: sampling
without replacement in proportion to the weights, at the measured share of good documents.

Scale: labels are sampled up to ``max_labelled`` rows (the smallest hashes of the id); everything
else covers all documents. Counting adds tables of fixed size; scoring writes two numbers per
document; the k-th key is found by histograms of fixed size. Documents are never shuffled.

Defined cases: a null or empty text has weight 0; a document's noise depends on its id (null: as 0),
so repeated rows share their fate, and ties at the k-th key are all kept; labels that are null count
as not good and not toxic; of contradicting labels of one id the worse counts; without labels of
both kinds on both halves a threshold is minus infinity, and nothing is rejected by it; empty tables
give an empty result; other columns are ignored, or handed through by ``resample``.
"""

from __future__ import annotations

import math
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpi_lake.llm.common import free_name, materialise, slices, utf8_column, worker_cache

BUCKETS = 1 << 16
MAX_LABELLED = 200_000
PRIOR = 4.0
#: Features to whose length log weights are brought.
LENGTH = 100
#: Standard deviations by which a toxic count must exceed its expectation.
STANDS_OUT = 5.0
#: Times its expectation that a toxic count must be, besides.
LEAST_RATIO = 3.0
FAMILIES = 5
#: How much more a rejected good document weighs than a kept bad one when thresholds are set.
CARE = 5.0
SEED = 17
_REMEMBERED = 300_000


class Hasher:
    """Bucket numbers of a text's features by family; remembers words (memory only)."""

    def __init__(self, buckets: int):
        self.buckets, self.known = buckets, worker_cache("resample")

    def __call__(self, text: bytes) -> list[np.ndarray]:
        words, known, n = text.split(), self.known, np.uint64(self.buckets)
        if len(known) > _REMEMBERED:
            known.clear()
        try:
            hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            for word in set(words).difference(known):
                known[word] = zlib.crc32(word)
            hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        first, second = hashes[:-1], hashes[1:]
        pairs = (first * np.uint64(0x9E3779B97F4A7C15) + second * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(29)
        pairs[first == second] = 0
        at = np.frombuffer(text, np.uint8).astype(np.uint32)
        runs = ((at[:-2] * 65536 + at[1:-1] * 256 + at[2:]) * np.uint32(0x9E3779B1)) >> np.uint32(7)
        found = [(hashes % n).astype(np.int64), (pairs % n).astype(np.int64), (runs % np.uint32(self.buckets)).astype(np.int64)]
        distinct = np.unique(hashes)
        return [*found, (distinct % n).astype(np.int64), ((distinct * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % self.buckets]


def labelled_sample(labels: DataFrame, limit: int, id_col: str = "doc_id", quality_col: str = "quality", toxic_col: str = "toxic") -> dict[int, tuple[int, int]]:
    """``id -> (good, toxic)`` of at most ``limit`` labelled ids, the smallest by hash."""
    one = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("bigint").alias("id"))
    one = one.agg(F.min(F.coalesce(quality_col, F.lit(0))).cast("int").alias("good"), F.max(F.coalesce(toxic_col, F.lit(0))).cast("int").alias("toxic"))
    return {r.id: (r.good, r.toxic) for r in one.orderBy(F.xxhash64("id"), "id").limit(limit).collect()}


def fits(doc_id: int) -> bool:
    """Whether a labelled id fits the models (else it calibrates)."""
    return zlib.crc32(f"half {doc_id}".encode()) & 1 == 0


def _counts(docs: DataFrame, shared, buckets: int) -> np.ndarray:
    """Counts by model (raw, target, toxic), family and bucket."""

    def run(batches):
        hasher, table = Hasher(buckets), np.zeros((3, FAMILIES * buckets), np.int64)
        sample = shared.value
        for batch in slices(batches):
            for doc, raw in zip(batch.column(0).to_pylist(), utf8_column(batch.column(1)), strict=True):
                found = np.concatenate([x + k * buckets for k, x in enumerate(hasher(raw))])
                good, toxic = sample.get(doc, (0, 0)) if doc is not None and fits(doc) else (0, 0)
                at, n = np.unique(found, return_counts=True)
                table[0, at] += n
                if good and not toxic:
                    table[1, at] += n
                if toxic:
                    table[2, at] += n
        at = np.flatnonzero(table[0])
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (at, *table[:, at])], names=["bucket", "raw", "target", "toxic"])

    parts = docs.mapInArrow(run, "bucket bigint, raw bigint, target bigint, toxic bigint")
    total = parts.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("raw", "target", "toxic")]).toArrow()  # at most FAMILIES * buckets rows
    out = np.zeros((3, FAMILIES * buckets))
    out[:, total["bucket"].to_numpy()] = [total[c].to_numpy() for c in ("raw", "target", "toxic")]
    return out.reshape(3, FAMILIES, buckets)


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """By family and bucket: the target's log ratio to the raw model; of distinct words, what speaks
    against toxicity (the target's minus the toxic's log ratio where the toxic count stands out of
    chance and is several times its expectation)."""
    raw, target, toxic = counts
    share = raw / np.maximum(raw.sum(axis=1, keepdims=True), 1)
    in_target, in_toxic = (x.sum(axis=1, keepdims=True) * share for x in (target, toxic))
    good = np.log((target + PRIOR) / (in_target + PRIOR)) if target.sum() else np.zeros_like(raw)
    bad = np.log((toxic + PRIOR) / (in_toxic + PRIOR))
    stands_out = (toxic - in_toxic > STANDS_OUT * np.sqrt(in_toxic + 1)) & (bad > np.log(LEAST_RATIO))
    good[3:] = np.where(stands_out, good - bad, 0.0)[3:]
    return good


def _score(hasher: Hasher, weights: np.ndarray, raw: bytes, length: int) -> tuple[float, float]:
    *families, one, other = hasher(raw)
    mean = sum(float(weights[k][found].mean()) for k, found in enumerate(families) if len(found))
    return length * mean, float(np.maximum(weights[3][one], weights[4][other]).sum())


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Standard Gumbel noise of an id."""
    uniform = (F.pmod(F.xxhash64(F.coalesce(doc_id, F.lit(0)), F.lit(seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return -F.log(-F.log(uniform))


def best_cut(scores: list[tuple[float, bool]], care: float = CARE) -> float:
    """The threshold at which the share of good at or above it, ``care`` times, and the share of bad
    below it are largest together, halfway between the scores it parts; minus infinity without both
    kinds."""
    n_good = sum(good for _, good in scores)
    n_bad = len(scores) - n_good
    if not n_good or not n_bad:
        return -math.inf
    scores = sorted(scores)
    best, cut, good_below, bad_below = care, -math.inf, 0, 0
    for (score, good), (after, _) in zip(scores, [*scores[1:], (math.inf, True)], strict=True):
        good_below, bad_below = good_below + good, bad_below + (not good)
        if after > score and (worth := care * (n_good - good_below) / n_good + bad_below / n_bad) > best:
            best, cut = worth, (score + after) / 2 if after < math.inf else math.inf
    return cut


def kth_largest(frame: DataFrame, column: str, k: int, bins: int = 4096) -> float:
    """The k-th largest value, found exactly by histograms of fixed size, ever finer."""
    low, high, n = frame.agg(F.min(column), F.max(column), F.count(column)).first()
    if not n or k >= n:
        return -math.inf
    if k <= 0:
        return math.inf
    rest = k
    while low < high:
        step = (high - low) / bins
        if low + step <= low:
            break
        place = F.least(F.floor((F.col(column) - low) / step), F.lit(bins - 1)).cast("int")
        part = frame.where(F.col(column).between(low, high)).groupBy(place.alias("bin"))
        rows = part.agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).orderBy(F.desc("bin")).collect()
        for row in rows:
            if rest <= row.n:
                low, high = row.low, row.high
                break
            rest -= row.n
    return low


class Classifier(NamedTuple):
    """The fitted models, thresholds and cut."""

    weights: np.ndarray
    weight_cut: float
    clean_cut: float
    key_cut: float


def score_documents(docs: DataFrame, shared_weights, buckets: int, length: int) -> DataFrame:
    """``id, log_weight, clean_weight`` per row of ``id, text``."""
    schema = pa.schema([("id", pa.int64()), ("log_weight", pa.float64()), ("clean_weight", pa.float64())])

    def run(batches):
        hasher, weights = Hasher(buckets), shared_weights.value
        for batch in slices(batches):
            found = [_score(hasher, weights, raw, length) for raw in utf8_column(batch.column(1))]
            columns = list(zip(*found, strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(c, pa.float64()) for c in columns)], schema=schema)

    return docs.mapInArrow(run, "id bigint, log_weight double, clean_weight double")


def fit(documents: DataFrame, labels: DataFrame, id_col: str, text_col: str, buckets: int, max_labelled: int, seed: int, length: int) -> tuple[Classifier, DataFrame]:
    """The classifier, and the scored documents (``id, log_weight, clean_weight, key``)."""
    spark: SparkSession = documents.sparkSession
    docs = documents.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    sample = labelled_sample(labels, max_labelled)
    weights = log_ratios(_counts(docs, spark.sparkContext.broadcast(sample), buckets))
    scored = score_documents(docs, spark.sparkContext.broadcast(weights), buckets, length)
    scored = materialise(scored.withColumn("key", F.col("log_weight") + gumbel(F.col("id"), seed)), "resample_scores")
    held = {i: x for i, x in sample.items() if not fits(i)}
    known = spark.createDataFrame([(i, *x) for i, x in held.items()], "id bigint, good int, toxic int")
    rows = scored.join(known, "id").groupBy("id", "good", "toxic").agg(F.first("log_weight").alias("w"), F.first("clean_weight").alias("c")).collect()
    weight_cut = best_cut([(r.w, bool(r.good)) for r in rows])
    clean_cut = best_cut([(r.c, not r.toxic) for r in rows])
    clean = scored.where(F.col("clean_weight") >= clean_cut)
    k = clean.where(F.col("log_weight") >= weight_cut).count()
    return Classifier(weights, weight_cut, clean_cut, kth_largest(clean, "key", k)), scored


def classify(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int = BUCKETS,
    max_labelled: int = MAX_LABELLED,
    seed: int = SEED,
    length: int = LENGTH,
) -> DataFrame:
    """Per row ``id, log_weight, clean_weight, key, kept``."""
    model, scored = fit(documents, labels, id_col, text_col, buckets, max_labelled, seed, length)
    return scored.withColumn("kept", (F.col("clean_weight") >= model.clean_cut) & (F.col("key") >= model.key_cut))


def resample(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int = BUCKETS,
    max_labelled: int = MAX_LABELLED,
    seed: int = SEED,
    length: int = LENGTH,
) -> DataFrame:
    """The documents (all their columns) that the sample keeps."""
    model, _ = fit(documents, labels, id_col, text_col, buckets, max_labelled, seed, length)
    names = documents.columns
    noisy = documents.withColumn(free_name(documents, "__noise"), gumbel(F.col(id_col).cast("bigint"), seed))
    place, last = names.index(text_col), len(names)
    shared = documents.sparkSession.sparkContext.broadcast(model.weights)

    def keep(batches):
        hasher, weights = Hasher(buckets), shared.value
        for batch in slices(batches):
            kept = []
            for raw, noise in zip(utf8_column(batch.column(place)), batch.column(last).to_pylist(), strict=True):
                weight, clean = _score(hasher, weights, raw, length)
                kept.append(clean >= model.clean_cut and weight + noise >= model.key_cut)
            yield batch.select(list(range(last))).filter(pa.array(kept, pa.bool_()))

    return noisy.mapInArrow(keep, documents.schema)
