"""Quality rules by suffix arrays: repeated word runs inside a document.

The words of many documents are put one after another and their suffixes sorted by prefix doubling
(a suffix never runs past its document, and suffixes of two documents never compare equal). The
rank tables of the doublings give the longest common prefix of neighbours by binary lifting; a
suffix's longest repeat is the larger of its two neighbours' prefixes, and it is a maximal repeated
substring if the suffix one word earlier doesn't contain it. The spans of the maximal repeats of at
least ``min_words`` words are united. A document fails if the united spans cover more than
``max_covered`` of its word characters or its longest repeat has more than ``max_longest`` words;
the plain base rules (too few words, more than a fifth of the words repeated) come first.

Scale: one pass over the documents, no shuffle; a task holds the suffix array of a bounded number of
words at a time (or of one document). Whole texts are always used.

Defined cases: a null, empty or blank text has no words and fails the base rule; repeated rows are
judged each for itself; an empty table gives an empty result; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpi_lake.llm.common import WORD_SEPARATORS, slices, utf8_column

# Fixed value: the symbols that are counted.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 5
MAX_COVERED = 0.2
MAX_LONGEST = 64
#: Words whose suffixes are sorted at a time (memory only; the result doesn't depend on it).
BATCH_WORDS = 400_000


def longest_repeats(words: np.ndarray, doc: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each position, the length in words of the longest run that starts there and also starts
    elsewhere in its document. ``words``: small integer ids; ``doc``: ascending document numbers;
    ``end``: the position after each position's document."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int64)
    key = doc.astype(np.int64) * (int(words.max()) + 1) + words
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    _, head, size = _groups(key[order])
    rank[order] = head
    tables, tied = [rank], order[size > 1]
    h = 1
    while len(tied):
        after = tied + h
        inside = after < end[tied]
        second = np.where(inside, rank[np.minimum(after, n - 1)] + 1, 0)
        # suffixes that end here are no repeats of longer runs: each a group of its own, before the others
        lone = np.where(inside, 0, np.arange(len(tied)) + 1)
        first = rank[tied]
        by = np.lexsort((lone, second, first))
        tied, first, second, lone = tied[by], first[by], second[by], lone[by]
        new = np.ones(len(tied), bool)
        new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1]) | (lone[1:] != lone[:-1])
        outer = np.ones(len(tied), bool)
        outer[1:] = first[1:] != first[:-1]
        at = np.arange(len(tied))
        base = first - at[np.maximum.accumulate(np.where(outer, at, 0))]
        head = at[np.maximum.accumulate(np.where(new, at, 0))]
        rank = rank.copy()
        rank[tied] = head + base
        tables.append(rank)
        starts = np.flatnonzero(new)
        tied = tied[np.repeat(np.diff(np.append(starts, len(tied))), np.diff(np.append(starts, len(tied)))) > 1]
        h *= 2
    suffixes = np.argsort(rank, kind="stable")
    prefix = np.zeros(n - 1, np.int64)
    live = np.flatnonzero(tables[0][suffixes[:-1]] == tables[0][suffixes[1:]])
    a, b = suffixes[:-1][live], suffixes[1:][live]
    stop_a, stop_b = end[a], end[b]
    for level in range(len(tables) - 1, -1, -1):
        # equal ranks mean equal runs of 2**level words, both inside the document
        inside = (a + (1 << level) <= stop_a) & (b + (1 << level) <= stop_b)
        same = inside & (tables[level][np.minimum(a, n - 1)] == tables[level][np.minimum(b, n - 1)])
        step = same.astype(np.int64) << level
        prefix[live] += step
        a, b = a + step, b + step
    out = np.zeros(n, np.int64)
    out[suffixes[1:]] = prefix
    out[suffixes[:-1]] = np.maximum(out[suffixes[:-1]], prefix)
    return out


def _groups(ordered: np.ndarray):
    """Of a sorted array: start of each run, and per element its run's start and size."""
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    sizes = np.diff(np.append(starts, len(ordered)))
    return starts, np.repeat(starts, sizes), np.repeat(sizes, sizes)


def _measure(texts: list[bytes], min_words: int) -> dict[str, np.ndarray]:
    split = [t.split() for t in texts]
    counts = np.array([len(x) for x in split], np.int64)
    total = int(counts.sum())
    table: dict[bytes, int] = {}
    words = np.fromiter((table.setdefault(w, len(table)) for x in split for w in x), np.int64, total)
    width = np.fromiter((len(w.decode("utf-8", "replace")) for w in table), np.int64, len(table))
    doc = np.repeat(np.arange(len(texts)), counts)
    stop = np.cumsum(counts)
    length = longest_repeats(words, doc, stop[doc] if total else np.zeros(0, np.int64))
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, doc, length)
    # maximal: not the rest of the run that starts one word earlier
    earlier = np.concatenate(([0], length[:-1])) if total else length
    first = np.concatenate(([True], doc[1:] != doc[:-1])) if total else np.zeros(0, bool)
    maximal = (length >= min_words) & (first | (earlier <= length))
    at = np.flatnonzero(maximal)
    cover = np.zeros(total + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + length[at], -1)
    covered = np.cumsum(cover[:-1]) > 0
    chars = width[words] if total else np.zeros(0, np.int64)

    def per_doc(values):
        return np.bincount(doc, weights=values, minlength=len(texts)).astype(np.int64)

    return {
        "n_words": counts,
        "word_chars": per_doc(chars),
        "n_repeat_words": per_doc(covered),
        "covered_chars": per_doc(chars * covered),
        "n_repeats": per_doc(maximal),
        "longest_repeat": longest,
    }


def line_and_symbol_counts(text: bytes) -> tuple[int, int]:
    """Symbols, and lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(WORD_SEPARATORS)]
    return len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines))


_COLUMNS = [
    ("id", "bigint"),
    ("n_words", "bigint"),
    ("word_chars", "bigint"),
    ("n_symbols", "bigint"),
    ("n_dup_lines", "bigint"),
    ("n_repeat_words", "bigint"),
    ("covered_chars", "bigint"),
    ("n_repeats", "bigint"),
    ("longest_repeat", "bigint"),
]


def repetition(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    max_covered: float = MAX_COVERED,
    max_longest: int = MAX_LONGEST,
) -> DataFrame:
    """Per document the measures, ``base_failed`` and ``kept``."""
    schema = pa.schema([(name, pa.int64()) for name, _ in _COLUMNS])

    def flush(ids, texts):
        found = _measure(texts, min_words)
        symbols, lines = zip(*(line_and_symbol_counts(t) for t in texts), strict=True)
        found |= {"id": ids, "n_symbols": symbols, "n_dup_lines": lines}
        return pa.RecordBatch.from_arrays([pa.array(found[name], pa.int64()) for name in schema.names], schema=schema)

    def run(batches):
        for batch in slices(batches):
            ids, texts, held = [], [], 0
            for doc, raw in zip(batch.column(0).to_pylist(), utf8_column(batch.column(1)), strict=True):
                ids.append(doc)
                texts.append(raw)
                held += len(raw)
                if held > 6 * BATCH_WORDS:
                    yield flush(ids, texts)
                    ids, texts, held = [], [], 0
            if ids:
                yield flush(ids, texts)

    docs = documents.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = docs.mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind in _COLUMNS))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    good = (F.col("covered_chars") <= max_covered * F.col("word_chars")) & (F.col("longest_repeat") <= max_longest)
    return found.withColumn("base_failed", failed).withColumn("kept", ~failed & good)
