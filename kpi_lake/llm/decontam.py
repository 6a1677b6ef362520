"""Benchmark decontamination: one Aho-Corasick automaton over the normalised benchmark items.

Every item is normalised to words (A-Z lower-cased, runs of ASCII letters, digits and non-ASCII
characters) and cut into windows of ``window`` words; an item of fewer words, but not none, is one
window. All windows are the patterns of one automaton, which reads each document's normalised text
once. A match gives a run of word positions; words are mapped back to code-point offsets of the
original text.

Scale: the documents are never shuffled; the automaton is built once per Python worker from the
broadcast windows. The benchmark's size is measured first, without wordless items and repeated rows:
while its text is at most ``max_broadcast_bytes`` there is one automaton (some 500 bytes of memory a
byte of text). A larger benchmark is dealt by running size into parts of at most that size; an item
that is longer is first cut into pieces that overlap by a window less a word, so that they have just
its windows. Parts are brought to the driver one at a time; the documents are scanned once per part,
each part's hits are written before the next is read, and the hits of one document are united.

Defined cases: a null or wordless text has no words and no hits; a null or wordless item has no
windows; repeated items count as items of their own; a null item id is listed as ``null``; an empty
benchmark or document table gives no hits or no rows; columns other than the id and the text are
ignored, whatever their names.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpi_lake.llm.common import free_name, materialise, slices, utf8_column, worker_cache

WINDOW = 13
MAX_BROADCAST_BYTES = 256 << 10
# Fixed value: a word, before A-Z are lower-cased.
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_A_WORD = r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]"
#: Parts that one task deals out, about.
_GROUPED = 16
_NORMAL = bytes(
    (c + 32) if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)



def normalise(raw: bytes) -> list[bytes]:
    """The words of a text, lower-cased, as UTF-8."""
    return raw.translate(_NORMAL).split()


def windows_of(words: list[bytes], window: int = WINDOW) -> list[bytes]:
    """Each window of consecutive words, joined by single spaces."""
    if not words:
        return []
    return [b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))]


def build_automaton(items: list[tuple[str, bytes]], window: int = WINDOW):
    """The automaton over all windows of ``(item_id, text)``, and per pattern its word count and
    the ids that have it. ``None`` for no windows."""
    import ahocorasick

    owners: dict[bytes, set[str]] = {}
    for item_id, text in items:
        for piece in windows_of(normalise(text), window):
            owners.setdefault(piece, set()).add(item_id)
    if not owners:
        return None
    automaton = ahocorasick.Automaton()
    for piece, ids in owners.items():
        automaton.add_word(f" {piece.decode('latin-1')} ", (piece.count(b" ") + 1, tuple(ids)))
    automaton.make_automaton()
    return automaton


def scan(automaton, words: list[bytes]):
    """Hit word positions (bool array) and the ids of the items with occurring windows."""
    hit, ids = np.zeros(len(words), dtype=bool), set()
    if automaton is None or not words:
        return hit, ids
    text = f" {b' '.join(words).decode('latin-1')} "
    found = list(automaton.iter(text))
    if found:
        spaces = np.flatnonzero(np.frombuffer(text.encode("latin-1"), np.uint8) == 32)
        ends = np.searchsorted(spaces, [end for end, _ in found])  # word count up to the match's end
        for end, (_, (n, owners)) in zip(ends.tolist(), found, strict=True):
            hit[end - n : end] = True
            ids.update(owners)
    return hit, ids


def runs(hit: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of true positions as half-open intervals."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return [(int(a), int(b)) for a, b in edges.reshape(-1, 2)]


def original_spans(text: str, word_runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code-point offsets, in the original text, of runs of words."""
    if not word_runs:
        return []
    places = [m.span() for m in WORD.finditer(text)]
    return [(places[a][0], places[b - 1][1]) for a, b in word_runs]


_SPAN = "array<struct<start:int,end:int>>"
SCHEMA = f"id bigint, n_words bigint, n_hit bigint, items array<string>, word_runs {_SPAN}, spans {_SPAN}"
_ARROW = pa.schema(
    [
        ("id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("items", pa.list_(pa.string())),
        ("word_runs", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ]
)


def _shared_automaton(spark, items: list[tuple[str, bytes]], window: int):
    """A function that gives the automaton, built once per Python worker."""
    shared, key = spark.sparkContext.broadcast(items), uuid.uuid4().hex

    def get():
        kept = worker_cache("decontam")
        if key not in kept:
            kept.clear()
            kept[key] = build_automaton(shared.value, window)
        return kept[key]

    return get


def _scan_part(docs: DataFrame, items: list[tuple[str, bytes]], window: int) -> DataFrame:
    get = _shared_automaton(docs.sparkSession, items, window)

    def run(batches):
        automaton = get()
        for batch in slices(batches):
            out: dict[str, list] = {name: [] for name in _ARROW.names}
            for doc, raw in zip(batch.column(0).to_pylist(), utf8_column(batch.column(1)), strict=True):
                words = normalise(raw)
                hit, ids = scan(automaton, words)
                word_runs = runs(hit) if ids else []
                spans = original_spans(raw.decode("utf-8", "replace"), word_runs) if word_runs else []
                for name, value in zip(
                    _ARROW.names,
                    (
                        doc,
                        len(words),
                        int(hit.sum()),
                        sorted(ids),
                        [{"start": a, "end": b} for a, b in word_runs],
                        [{"start": a, "end": b} for a, b in spans],
                    ),
                    strict=True,
                ):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=_ARROW)

    return docs.mapInArrow(run, SCHEMA)


def cut_item(text: bytes, window: int, limit: int) -> list[bytes]:
    """Pieces of an item's normalised words of about ``limit`` bytes (a window at least) that have
    between them just the item's windows."""
    words = normalise(text)
    if len(words) <= window:
        return [b" ".join(words)]
    ends, pieces, first = np.cumsum([len(w) + 1 for w in words]), [], 0
    while first + window <= len(words):
        room = int(np.searchsorted(ends, (ends[first - 1] if first else 0) + limit, side="right"))
        stop = min(len(words), max(room, first + window))
        pieces.append(b" ".join(words[first:stop]))
        first = stop - window + 1
    return pieces


class _Parts:
    """Parts of a benchmark; each is brought to the driver when it is asked for."""

    def __init__(self, frames: list[DataFrame]):
        self.frames = frames

    def __len__(self) -> int:
        return len(self.frames)

    def __iter__(self):
        for f in self.frames:
            yield [(r.item, r.text.encode("utf-8")) for r in f.collect()]


def _parts(benchmark: DataFrame, item_col: str, text_col: str, window: int, limit: int) -> _Parts:
    """The benchmark's distinct items that have words, in parts of at most ``limit`` bytes of text
    each (but for a window that is longer). The size is measured before anything is brought to the
    driver, and one part is brought at a time."""
    rows = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"),
        F.col(text_col).cast("string").alias("text"),
    )
    rows = rows.where(F.col("text").rlike(_A_WORD)).distinct().withColumn("size", F.octet_length("text").cast("bigint"))
    total, longest = rows.agg(F.sum("size"), F.max("size")).first()
    if not total:
        return _Parts([])
    if total <= limit:
        return _Parts([rows])
    if longest > limit:

        def cut(batches):
            for batch in slices(batches):
                found = [(i, p.decode("utf-8", "replace")) for i, raw in zip(batch.column(0).to_pylist(), utf8_column(batch.column(1)), strict=True) for p in cut_item(raw, window, limit)]
                columns = list(zip(*found, strict=True)) if found else [(), ()]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["item", "text"])

        long = rows.where(F.col("size") > limit).select("item", "text").mapInArrow(cut, "item string, text string")
        pieces = long.distinct().withColumn("size", F.octet_length("text").cast("bigint"))
        rows = materialise(rows.where(F.col("size") <= limit).unionByName(pieces), "benchmark_items")
        total = rows.agg(F.sum("size")).first()[0]
    # By running size: an item that crosses a multiple of the limit is a part by itself, the items
    # between two multiples are one. Groups of many parts, each summed by one task.
    group = F.pmod(F.xxhash64("item", "text"), F.lit(int(-(-total // (_GROUPED * limit)))))
    stop = F.sum("size").over(Window.partitionBy("group").orderBy("item", "text").rowsBetween(Window.unboundedPreceding, 0))
    dealt = rows.withColumn("group", group).withColumn("stop", stop)
    first, last = (F.floor((F.col("stop") - x) / F.lit(limit)) for x in (F.col("size"), F.lit(1)))
    part = F.concat_ws("-", "group", first.cast("string"), (first < last).cast("string"))
    dealt = materialise(dealt.select("item", "text", "size", part.alias("part")), "benchmark_parts")
    joined: list[list[str]] = []
    room = 0
    for r in dealt.groupBy("part").agg(F.sum("size").alias("size")).orderBy("part").collect():
        if not joined or r["size"] > room:
            joined.append([])
            room = limit
        joined[-1].append(r["part"])
        room -= r["size"]
    return _Parts([dealt.where(F.col("part").isin(parts)).select("item", "text") for parts in joined])


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Per document: ``id, n_words, n_hit, items`` (sorted ids of items with occurring windows),
    ``word_runs`` (hit runs of word positions) and ``spans`` (their code-point offsets)."""
    docs = documents.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    parts = _parts(benchmark, item_col, item_text_col, window, max_broadcast_bytes)
    if len(parts) <= 1:
        return _scan_part(docs, next(iter(parts), []), window)
    # More than one automaton: number the rows, so that repeated ids stay apart, and unite the hits.
    docs = materialise(docs.withColumn("row", F.monotonically_increasing_id()), "decontam_docs")
    found = None
    for part in parts:
        one = _scan_part(docs.select(F.col("row").alias("id"), "text"), part, window)
        one = materialise(one.where("n_hit > 0").select(F.col("id").alias("row"), "items", "word_runs"), "decontam_hits")
        found = one if found is None else found.unionByName(one)
    merged = found.groupBy("row").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        _union_of(F.flatten(F.collect_list("word_runs"))).alias("word_runs"),
    )
    # Runs of different parts may touch, so the spans in the text follow from the united runs.
    merged = docs.select("row", "text").join(merged, "row").mapInArrow(_add_spans, f"row bigint, items array<string>, word_runs {_SPAN}, spans {_SPAN}")
    counted = _scan_part(docs.select(F.col("row").alias("id"), "text"), [], window).select(F.col("id").alias("row"), "n_words")
    empty = F.array().cast(_SPAN)
    return (
        docs.select("row", "id")
        .join(counted, "row")
        .join(merged, "row", "left")
        .select(
            "id",
            "n_words",
            F.coalesce(F.aggregate("word_runs", F.lit(0).cast("bigint"), lambda a, r: a + r["end"] - r["start"]), F.lit(0)).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            F.coalesce("word_runs", empty).alias("word_runs"),
            F.coalesce("spans", empty).alias("spans"),
        )
    )


def _add_spans(batches):
    """Rows of ``row, text, items, word_runs`` with the runs' spans in place of the text."""
    kind = _ARROW.field("spans").type
    for batch in slices(batches):
        found = []
        for raw, word_runs in zip(utf8_column(batch.column(1)), batch.column(3).to_pylist(), strict=True):
            spans = original_spans(raw.decode("utf-8", "replace"), [(x["start"], x["end"]) for x in word_runs])
            found.append([{"start": a, "end": b} for a, b in spans])
        columns = [batch.column(0), batch.column(2), batch.column(3), pa.array(found, kind)]
        yield pa.RecordBatch.from_arrays(columns, names=["row", "items", "word_runs", "spans"])


def _union_of(spans):
    """Union of half-open intervals (touching ones merge) as a column expression."""

    def add(acc, r):
        last = F.element_at(acc, -1)
        merged = F.concat(
            F.slice(acc, 1, F.size(acc) - 1),
            F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], r["end"]).alias("end"))),
        )
        return F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] >= r["start"]), merged).otherwise(F.concat(acc, F.array(r)))

    return F.aggregate(F.array_sort(spans), F.array().cast(_SPAN), add)


def contaminated(n_hit, n_words):
    """The contract's rule: at least a twentieth of the words is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def remove_contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """The documents (all their columns) that the rule leaves, each row judged by itself."""
    parts = _parts(benchmark, item_col, item_text_col, window, max_broadcast_bytes)
    if len(parts) <= 1:
        get, place = _shared_automaton(documents.sparkSession, next(iter(parts), []), window), documents.columns.index(text_col)

        def keep(batches):
            automaton = get()
            for batch in slices(batches):
                kept = []
                for raw in utf8_column(batch.column(place)):
                    words = normalise(raw)
                    n_hit = int(scan(automaton, words)[0].sum())
                    kept.append(not (n_hit and 20 * n_hit >= len(words)))
                yield batch.filter(pa.array(kept, pa.bool_()))

        return documents.mapInArrow(keep, documents.schema)
    row = free_name(documents, "__row")
    rows = materialise(documents.withColumn(row, F.monotonically_increasing_id()), "decontam_rows")
    found = find_contamination(rows, benchmark, row, text_col, item_col, item_text_col, window, max_broadcast_bytes)
    bad = found.where(contaminated(F.col("n_hit"), F.col("n_words"))).select(F.col("id").alias(row))
    return rows.join(bad, row, "left_anti").drop(row)
