"""Near-duplicate detection by b-bit MinHash.

A document's set is its distinct word shingles, as 64-bit hashes. Documents with equal sets are one
class, and only classes are compared. Each class has ``HASHES`` minima; bands of them give the candidates, and the low ``BITS`` bits of all minima, packed, give a signature. Classes that
share a band are joined into candidate clusters; within a cluster, signatures are compared by bit
counts, the similarity is corrected for chance collisions of the low bits, and pairs whose estimate
reaches a floor below the threshold are confirmed on their full sets. Confirmed links give the
components.

``settings`` derives the bands, the minima and the floor from the threshold: a pair at the threshold
is missed with a probability of ``MISS`` at most, half of it for sharing no band, half for an estimate
below the floor (exact binomial tail), if the minima are independent. At 0.85 it takes 25 bands of 5
(4.3e-7, and 1.8e-7 for the
floor), at 0.80 32 bands of 4 (4.7e-8, and 2.0e-7); thresholds below 0.11 take more than ``HASHES`` minima.

Scale: equal sets are aggregated first, so a group of copies is one class however large. Bands are
shuffled as hash and name only; a band's classes are linked to its smallest one, never pairwise. Of
the texts, only the classes' representatives that lie in clusters of two or more travel on, once.
A cluster whose sets have more than ``max_block`` shingles is dealt into blocks, and every pair of
blocks is a task of its own, so no task holds more than two blocks; links that a task finds are
written as trees, never as all pairs, and pairs inside a component that is already linked aren't
looked at. All links between components are examined, without a cap.

Defined cases: a text with fewer words than a shingle is one shingle of them all; a null, empty or
blank text has an empty set, links with nothing, and is its own component; ties and repeated rows
are copies of each other; rows with a null id take part, and their component is the smallest id that
isn't null, if any; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpi_lake.llm.common import free_name, materialise, slices, utf8_column, worker_cache
from kpi_lake.llm.components import connected_components

WORDS = 5
PERCENT = 85
HASHES, BITS = 128, 4
MISS = 1e-6
MAX_BLOCK = 2_000_000
_REMEMBERED = 300_000
_SEED = 20_231
_MIX = np.uint64(0xBF58476D1CE4E5B9)  # fixed value: a mixing constant
_FOLD = np.uint64(0x9E3779B97F4A7C15)  # fixed value: a mixing constant


class Settings(NamedTuple):
    bands: int
    rows: int
    hashes: int
    floor: float  # of the estimate

    def misses(self, similarity: float) -> tuple[float, float]:
        """Probabilities that a pair shares no band, and that its estimate is below the floor."""
        chance = 2.0**-BITS
        equal = similarity + (1 - similarity) * chance
        least = round((self.floor * (1 - chance) + chance) * self.hashes)
        return (1 - similarity**self.rows) ** self.bands, _binomial_below(least, self.hashes, equal)


def _binomial_below(least: int, n: int, p: float) -> float:
    return math.fsum(math.exp(_log_term(k, n, p)) for k in range(least))


@functools.cache
def settings(percent: int) -> Settings:
    """For a threshold: the longest bands, and the highest floor, that keep to ``MISS``."""
    if not 0 < percent <= 100:
        raise ValueError("percent must be above 0 and at most 100")
    similarity, chance, hashes = percent / 100, 2.0**-BITS, HASHES
    while (1 - similarity) ** hashes > MISS / 2:
        hashes += 64 // BITS
    rows = max(r for r in range(1, hashes + 1) if (1 - similarity**r) ** (hashes // r) <= MISS / 2)
    equal = similarity + (1 - similarity) * chance
    least, below = 0, 0.0
    while least < hashes and (below := below + math.exp(_log_term(least, hashes, equal))) <= MISS / 2:
        least += 1
    return Settings(hashes // rows, rows, hashes, (least / hashes - chance) / (1 - chance))


def _log_term(k: int, n: int, p: float) -> float:
    if p >= 1:
        return 0.0 if k == n else -math.inf
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)


#: How far estimates at the default threshold may lie below it.
MARGIN = PERCENT / 100 - settings(PERCENT).floor


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(27))


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    known = worker_cache("minhash")
    if len(known) > _REMEMBERED:
        known.clear()
    try:
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    except KeyError:
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_intdigest(word)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingle_set(text: bytes, words: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's word shingles."""
    hashes = word_hashes(text.lower().split())
    n = len(hashes)
    if not n:
        return hashes
    size = min(n, words)
    folded = np.full(n - size + 1, np.uint64(size), np.uint64)
    for i in range(size):
        folded = _mixed(folded * _FOLD + hashes[i : n - size + 1 + i])
    return np.unique(folded)


def _permutations(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    made = np.random.default_rng(_SEED)
    return made.integers(0, 1 << 31, hashes, np.uint32) * np.uint32(2) + np.uint32(1), made.integers(0, 1 << 32, hashes, np.uint32)


def minima(sets: list[np.ndarray], hashes: int = HASHES) -> np.ndarray:
    """The ``hashes`` minima of each set that isn't empty."""
    small = np.concatenate(sets)
    small = (small ^ (small >> np.uint64(32))).astype(np.uint32)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.empty((len(sets), hashes), np.uint32)
    for k, (a, b) in enumerate(zip(*_permutations(hashes), strict=True)):
        out[:, k] = np.minimum.reduceat(small * a + b, starts)
    return out


def signatures(low: np.ndarray) -> np.ndarray:
    """The low bits of the minima, packed: 64-bit words of ``64 / BITS`` minima each."""
    nibbles = (low & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(len(low), low.shape[1] * BITS // 64, 64 // BITS)
    shifts = np.arange(0, 64, BITS, dtype=np.uint64)
    return np.bitwise_or.reduce(nibbles << shifts, axis=2)


def estimates(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Similarities estimated from packed signatures, corrected for collisions of the low bits."""
    differ = one ^ others
    for shift in (2, 1):  # folds each minimum's bits into its lowest
        differ = differ | (differ >> np.uint64(shift))
    ones = np.uint64(sum(1 << i for i in range(0, 64, BITS)))
    unequal = np.bitwise_count(differ & ones).sum(axis=-1, dtype=np.int64)
    chance, hashes = 2.0**-BITS, one.shape[-1] * 64 // BITS
    return ((hashes - unequal) / hashes - chance) / (1 - chance)


def trees(sets: list[np.ndarray], packed: np.ndarray, left: np.ndarray | None = None, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that join the members into their components: for every member the later ones that
    might be linked and aren't in its component yet, best estimate first, confirmed on full sets.
    ``left``: compare only members of different sides (two blocks of a cluster)."""
    n = len(sets)
    size, label, out = np.array([len(s) for s in sets]), np.arange(n), []
    floor = settings(percent).floor - 1e-9  # estimates are multiples of far more
    hashed = [None] * n
    for i in range(n - 1):
        rest = slice(i + 1, n)
        smaller, larger = np.minimum(size[rest], size[i]), np.maximum(size[rest], size[i])
        maybe = (label[rest] != label[i]) & (100 * smaller >= percent * larger)
        if left is not None:
            maybe &= left[rest] != left[i]
        at = np.flatnonzero(maybe) + i + 1
        if not len(at):
            continue
        guess = estimates(packed[i], packed[at])
        at = at[guess >= floor][np.argsort(-guess[guess >= floor], kind="stable")]
        for j in at.tolist():
            if label[i] == label[j]:
                continue
            for k in (i, j):
                if hashed[k] is None:
                    hashed[k] = frozenset(sets[k].tolist())
            common = len(hashed[i] & hashed[j])
            if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                out.append((i, j))
                label[label == label[j]] = label[i]
        hashed[i] = None
    return out


_SKETCH = pa.schema(
    [
        ("id", pa.int64()),
        ("k1", pa.int64()),
        ("k2", pa.int64()),
        ("n", pa.int64()),
        ("node", pa.binary()),
        ("bands", pa.list_(pa.int64())),
        ("signature", pa.binary()),
    ]
)
_SKETCH_KINDS = "id bigint, k1 bigint, k2 bigint, n bigint, node binary, bands array<bigint>, signature binary"


def sketches(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per document the size and name of its set, band hashes and packed signature."""
    bands, rows, hashes, _ = settings(percent)

    def flush(columns, sets):
        full = [s for s in sets if len(s)]
        low = minima(full, hashes) if full else np.zeros((0, hashes), np.uint32)
        packed = signatures(low)
        keys = np.empty((len(full), bands), np.uint64)
        for k in range(bands):
            folded = np.full(len(full), np.uint64(k + 1), np.uint64)
            for r in range(rows):
                folded = _mixed(folded * _FOLD + low[:, k * rows + r])
            keys[:, k] = folded
        names, band_lists, signed, at = [], [], [], 0
        for s in sets:
            if len(s):
                name = np.array([np.bitwise_xor.reduce(_mixed(s + np.uint64(7))), np.add.reduce(_mixed(s * _FOLD)) + np.uint64(len(s))], np.uint64)
                names.append(name.tobytes())
                band_lists.append(keys[at].view(np.int64))
                signed.append(packed[at].tobytes())
                at += 1
            else:
                names.append(b"")
                band_lists.append([])
                signed.append(b"")
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip([*columns, [len(s) for s in sets], names, band_lists, signed], _SKETCH, strict=True)], schema=_SKETCH
        )

    def run(batches):
        for batch in slices(batches):
            held, sets, n = ([], [], []), [], 0
            for id_, k1, k2, raw in zip(*(batch.column(i).to_pylist() for i in range(3)), utf8_column(batch.column(3)), strict=True):
                for part, value in zip(held, (id_, k1, k2), strict=True):
                    part.append(value)
                sets.append(shingle_set(raw, words))
                n += len(sets[-1])
                if n > 200_000:
                    yield flush(held, sets)
                    held, sets, n = ([], [], []), [], 0
            if sets:
                yield flush(held, sets)

    return docs.mapInArrow(run, _SKETCH_KINDS)


def _band_edges(classes: DataFrame) -> DataFrame:
    """Links from the first class of each band to the others that share it."""

    def run(batches):
        key, hub = None, None
        for batch in batches:
            a, b = [], []
            for band, node in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if band != key:
                    key, hub = band, node
                elif node != hub:
                    a.append(node)
                    b.append(hub)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    rows = classes.select(F.explode("bands").alias("band"), "node").repartition(F.col("band")).sortWithinPartitions("band", "node")
    return rows.mapInArrow(run, "a binary, b binary")


def _confirmed(members: DataFrame, docs: DataFrame, words: int, percent: int, max_block: int) -> DataFrame:
    """Confirmed links ``a, b`` between classes, from clusters ``root, node, n, k1, k2, signature``."""
    sizes = members.groupBy("root").agg(F.sum("n").alias("total"))
    blocks = F.ceil(F.col("total") / max_block).cast("int")
    dealt = members.join(sizes, "root").select("root", "node", "k1", "k2", "signature", blocks.alias("blocks"))
    texts = docs.join(dealt, ["k1", "k2"]).select("root", "node", "signature", "blocks", "text")

    def as_sets(batches):
        for batch in slices(batches):
            sets = [shingle_set(t, words).view(np.int64) for t in utf8_column(batch.column(4))]
            size = [0, *np.cumsum([len(s) for s in sets])]
            packed = pa.ListArray.from_arrays(pa.array(size, pa.int32()), pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], packed], names=["root", "node", "signature", "blocks", "shingles"])

    sets = texts.mapInArrow(as_sets, "root binary, node binary, signature binary, blocks int, shingles array<bigint>")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    pairs = sets.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.select("root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "signature", "shingles")

    def run(batches):
        key, held = None, {}

        def flush():
            if len(held) < 2:
                return None
            nodes = list(held)
            packed = np.array([np.frombuffer(held[x][1], np.uint64) for x in nodes])
            found = trees([held[x][2] for x in nodes], packed, np.array([held[x][0] for x in nodes]) if key[1] != key[2] else None, percent)
            return pa.RecordBatch.from_arrays([pa.array([nodes[x[k]] for x in found], pa.binary()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            lists = batch.column(6)
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
            for row, (root, i, j, side, node, signature) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(6)), strict=True)):
                if (root, i, j) != key:
                    if (out := flush()) is not None:
                        yield out
                    key, held = (root, i, j), {}
                held[node] = (side, signature, values[offsets[row] : offsets[row + 1]].copy())
        if (out := flush()) is not None:
            yield out

    ordered = pairs.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j", "node")
    return ordered.mapInArrow(run, "a binary, b binary")


def near_duplicates(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    max_block: int = MAX_BLOCK,
) -> DataFrame:
    """Per row ``id, k1, k2, n_shingles, node`` (the name of its set), ``component_id``."""
    return _in_components(documents, id_col, text_col, words, percent, max_block).drop("root")


def _in_components(documents: DataFrame, id_col: str, text_col: str, words: int, percent: int, max_block: int = MAX_BLOCK) -> DataFrame:
    """``near_duplicates``, and the component's ``root`` (null for empty sets)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    docs = documents.select(
        F.col(id_col).cast("bigint").alias("id"), F.xxhash64(name, text).alias("k1"), F.xxhash64(text, F.lit(1), name).alias("k2"), text.alias("text")
    )
    sketched = materialise(sketches(docs, words, percent), "sketches")
    classes = (
        sketched.where("n > 0")
        .groupBy("node")
        .agg(
            F.min("id").alias("id"),
            F.min(F.struct("k1", "k2")).alias("k"),
            F.first("n").alias("n"),
            F.first("bands").alias("bands"),
            F.first("signature").alias("signature"),
        )
    )
    classes = materialise(classes.select("node", "id", "k.k1", "k.k2", "n", "bands", "signature"), "classes")
    clusters = connected_components(_band_edges(classes))
    members = clusters.join(classes.drop("bands"), "node")
    links = _confirmed(members, docs.select("k1", "k2", "text"), words, percent, max_block)
    roots = connected_components(links)
    of_class = classes.select("node", "id").join(roots, "node", "left").select("node", "id", F.coalesce("root", "node").alias("root"))
    least = of_class.groupBy("root").agg(F.min("id").alias("component_id"))
    named = of_class.select("node", "root").join(least, "root").select("node", "root", "component_id")
    found = sketched.select("id", "k1", "k2", F.col("n").alias("n_shingles"), "node").join(named, "node", "left")
    return found.withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id")))


def deduplicate(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document (all its columns) of each component: the one with the smallest id (null last;
    of several, by hashes of id and text). An empty text is a component of its own; of rows that
    repeat an id and text one stays."""
    found = _in_components(documents, id_col, text_col, words, percent).select("id", "k1", "k2", "n_shingles", "root")
    empty = F.col("n_shingles") == 0
    found = found.select("id", "k1", "k2", "root", F.when(empty, F.col("k1")).alias("e1"), F.when(empty, F.col("k2")).alias("e2"))
    rows = materialise(found.groupBy("root", "e1", "e2", "id", "k1", "k2").agg(F.count(F.lit(1)).alias("n")), "near_duplicates")
    order = F.struct(F.col("id").isNull().alias("unnamed"), "id", "k1", "k2", "n")
    stays = materialise(rows.groupBy("root", "e1", "e2").agg(F.min(order).alias("first")).select("first.*"), "stays")
    keys = [free_name(documents, "__k1"), free_name(documents, "__k2")]
    stays = stays.select(F.col("k1").alias(keys[0]), F.col("k2").alias(keys[1]), F.col("n").alias("__n"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    keyed = documents.withColumn(keys[0], F.xxhash64(name, text)).withColumn(keys[1], F.xxhash64(text, F.lit(1), name))
    repeated = stays.where("__n > 1").select(*keys)
    single = keyed.join(stays.where("__n = 1").select(*keys), keys, "left_semi")
    if not repeated.isEmpty():
        single = single.unionByName(keyed.join(repeated, keys, "left_semi").dropDuplicates(keys))
    return single.select(*documents.columns)
