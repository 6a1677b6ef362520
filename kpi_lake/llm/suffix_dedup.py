"""Exact substring deduplication by a hash-compared suffix sort.

Every string of ``length`` bytes that starts at two or more places of the corpus is found, and the
bytes that such strings cover are removed, all at once, from every place.

1. Anchors. Of the runs of ``length / 2`` bytes inside a window of ``length`` bytes, the one with the
   smallest polynomial hash is the window's anchor (the leftmost of equals), so equal windows have
   equal anchors at equal offsets. Prefix hashes give any run's hash in two look-ups. An anchor
   stands for the windows that chose it; about one place in fifty is an anchor.
2. Gathering. Contexts (the bytes of all windows of an anchor) that repeat inside one batch of a task
   are known to be repeated: their bytes are united per document there, and one of them goes on with
   that mark. Anchors are shuffled by hash and streamed in order of their context. Anchors that occur once are dropped. Contexts that occur twice or more are
   repeated as a whole. Where an anchor has several different contexts, one of each goes on.
3. Suffix sort. For each such anchor the suffixes at all its windows' starts are sorted by
   mergesort; two suffixes are compared by a binary search for their longest common prefix over the
   prefix hashes, so a comparison takes a logarithmic number of look-ups. Only suffixes at the same
   offset from the same anchor can be equal windows, so these are the sorted lists, and all lists
   of a batch are merged together. Neighbours with a common prefix of ``length`` are repeated; their
   bytes are compared, so a hash collision can't remove anything here. Contexts that step 2 takes for
   repeated aren't verified: they are equal on two 64-bit hashes only (both polynomial modulo 2^64).
4. Spans of a document are united and cut out.

Scale: texts are shuffled compressed, twice; anchors once. An anchor whose different contexts are
more than ``max_contexts`` is split, in further rounds of steps 2 and 3, by longer runs: its windows
are halved by offset, each half keyed by the run of bytes that all its windows share, down to single
windows, where equal keys are equal windows and nothing is left to sort. So no task sorts an
unbounded group, and nothing is dropped. The gathering stream holds one anchor's rows, or a bounded
part of them.

Defined cases: a null text is empty; a text shorter than ``length`` bytes keeps all; a match never
crosses documents; rows that repeat an id and text are documents of their own, and are removed like
other copies; cut texts are decoded with broken characters dropped; an empty table gives no rows;
other columns are handed through, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from kpi_lake.llm.common import materialise, slices, utf8_column, worker_cache

LENGTH = 200
MAX_CONTEXTS = 20_000
#: Bytes hashed at a time, bytes whose anchors are combined at a time, contexts sorted at a time, rows
#: of one anchor held (memory only).
PIECE = 1 << 19
COMBINED = 1 << 22
SORTED_CONTEXTS = 4_000
HELD_ROWS = 1_000_000
# Odd bases of the two polynomial hashes, and a mixing constant.
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
#: Tables of powers grow by this many entries.
_POWER_STEP = 1 << 16
#: Bits of a place in a batch; a batch is at most one piece longer than PIECE by an overlap.
_PLACE_BITS = PIECE.bit_length()


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse, modulo 2**64."""
    known = worker_cache("powers")
    if base not in known or len(known[base][0]) < n:
        size, both = -(-n // _POWER_STEP) * _POWER_STEP, []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.cumprod(p, dtype=np.uint64))
        known[base] = tuple(both)
    up, down = known[base]
    return up[:n], down[:n]


class PrefixHashes:
    """Polynomial hashes of the prefixes of a byte string; the hash of any run takes two look-ups."""

    def __init__(self, data: np.ndarray, base: int = _BASES[0]):
        up, self.down = _powers(base, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64, out=self.sums[1:])

    def of(self, start, end) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def anchors(data: np.ndarray, stops: np.ndarray, length: int = LENGTH):
    """Of texts laid end to end (``stops``: the place after each): per anchor its place, the first
    and last start of the windows that chose it, its hash and the hash of its context."""
    n, k = len(data), length // 2
    width = length - k + 1
    if n < length:
        return [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.int64)] * 2
    table = PrefixHashes(data)
    at = np.arange(n - k + 1)
    grams = _mixed(table.of(at, at + k))
    bits = np.uint64(_PLACE_BITS)  # the same for every batch, so that equal windows choose alike
    low = ((grams >> bits) << bits) | at.astype(np.uint64)  # ties: the leftmost
    span = 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
    chosen = (low & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    starts = np.arange(len(chosen))
    inside = starts + length <= stops[np.searchsorted(stops, starts, side="right")]
    starts, chosen = starts[inside], chosen[inside]
    if not len(starts):
        return [np.zeros(0, np.int64)] * 5
    new = np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1)))
    first = starts[new]
    last = np.append(starts[np.flatnonzero(new)[1:] - 1], starts[-1])
    place = chosen[new]
    shape = (place - first).astype(np.uint64) * np.uint64(1 << 20) + (place - last).astype(np.uint64)
    context = _mixed(PrefixHashes(data, _BASES[1]).of(first, last + length) ^ (shape * _MIX))
    return place, first, last, grams[place].view(np.int64), context.view(np.int64)


def _pieces(texts: list[bytes], length: int):
    """Batches of ``(text number, offset, bytes)`` of at most ``PIECE`` bytes or one piece; longer
    texts are cut into pieces that overlap by one byte less than ``length``."""
    batch, held = [], 0
    for number, text in enumerate(texts):
        if len(text) < length:
            continue
        for offset in range(0, max(1, len(text) - length + 1), PIECE):
            piece = text[offset : offset + PIECE + length - 1]
            if batch and held + len(piece) > PIECE:
                yield batch
                batch, held = [], 0
            batch.append((number, offset, piece))
            held += len(piece)
    if batch:
        yield batch


_OCCURRENCE = [("key", "bigint"), ("context", "bigint"), ("k1", "bigint"), ("k2", "bigint"), ("place", "bigint"), ("far", "int"), ("near", "int"), ("known", "int")]
#: ``known``: 1 for a context that is repeated already, 2 for a span of repeated bytes that only passes.
ALONE, REPEATED, SPAN = 0, 1, 2
_KINDS = ", ".join(f"{a} {b}" for a, b in _OCCURRENCE)
_ARROW = pa.schema([(a, pa.int32() if b == "int" else pa.int64()) for a, b in _OCCURRENCE])


def _batch(columns, schema=_ARROW) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _identified(documents: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column, Column]:
    """Two hashes that name a document (its id and text), and its text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.xxhash64(name, text).alias("k1"), F.xxhash64(text, F.lit(1), name).alias("k2"), text.alias("text")


def _find_anchors(docs: DataFrame, length: int) -> DataFrame:
    """``place`` is the anchor's offset in its text; its windows start ``far`` to ``near`` before."""

    def run(batches):
        held, texts, size = [], 0, 0
        for batch in slices(batches):
            k1, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for part in _pieces(utf8_column(batch.column(2)), length):
                data = np.frombuffer(b"".join(p for *_, p in part), np.uint8)
                stops = np.cumsum([len(p) for *_, p in part])
                place, first, last, key, context = anchors(data, stops, length)
                at = np.searchsorted(stops, place, side="right")
                begin = np.concatenate(([0], stops[:-1]))[at]
                number = np.array([x for x, *_ in part])[at]
                offset = np.array([x for _, x, _ in part])[at]
                rows = np.stack([key, context, k1[number], k2[number], place - begin + offset, place - first, place - last, np.zeros_like(key)])
                held.append((rows, at + texts))
                texts, size = texts + len(part), size + len(data)
                if size >= COMBINED:
                    yield together(held)
                    held, texts, size = [], 0, 0
        if held:
            yield together(held)

    def together(held):
        return _rows(_combined(np.concatenate([r for r, _ in held], axis=1), np.concatenate([a for _, a in held]), length))

    return docs.mapInArrow(run, _KINDS)


def _rows(rows: np.ndarray, schema=_ARROW) -> pa.RecordBatch:
    return _batch([r.astype(np.int32) if pa.types.is_int32(f.type) else r for r, f in zip(rows, schema, strict=True)], schema)


def _combined(rows: np.ndarray, doc: np.ndarray, length: int) -> np.ndarray:
    """Map-side combine of a batch's occurrences: of a context that repeats, one occurrence, marked;
    and the bytes of all its occurrences, united per document, as spans under the document's key."""
    if not rows.shape[1]:
        return rows
    by = np.lexsort((rows[1], rows[0]))
    rows, doc = rows[:, by], doc[by]
    new = np.concatenate(([True], (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])))
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, rows.shape[1]))
    several = np.repeat(sizes >= 2, sizes)
    rows[7, starts[sizes >= 2]] = REPEATED
    single = rows[:, new]
    if not several.any():
        return single
    begin, end, doc = (rows[4] - rows[5])[several], (rows[4] - rows[6])[several] + length, doc[several]
    names = rows[2:4, several]
    by = np.lexsort((begin, doc))
    begin, end, doc, names = begin[by], end[by], doc[by], names[:, by]
    # reach: the running end within a document (places of later documents are put beyond all others)
    apart = (doc - doc[0]) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + apart)
    fresh = np.concatenate(([True], (begin + apart)[1:] > reach[:-1]))
    last = np.append(np.flatnonzero(fresh)[1:] - 1, len(doc) - 1)
    start, stop, names = begin[fresh], (reach - apart)[last], names[:, fresh]
    zero = np.zeros_like(start)
    spans = np.stack([names[0], zero, names[0], names[1], start, zero, length - (stop - start), zero + SPAN])
    return np.concatenate((single, spans), axis=1)


class _Gatherer:
    """Reads occurrences in order of key and context; gives those of repeated contexts (kind 0) and,
    of keys with several contexts, one occurrence of each (kind 1, or 2 if it is repeated)."""

    def __init__(self):
        self.rows = np.zeros((8, 0), np.int64)
        self.several: int | None = None  # the key of the held rows, if it is known to have several contexts

    def take(self, rows: np.ndarray | None):
        end = rows is None
        if not end:
            self.rows = np.concatenate((self.rows, rows), axis=1) if self.rows.shape[1] else rows
        rows = self.rows
        n = rows.shape[1]
        if not n:
            return None
        key, context = rows[0], rows[1]
        new_key = np.concatenate(([True], key[1:] != key[:-1]))
        new = new_key | np.concatenate(([True], context[1:] != context[:-1]))
        forced = None
        if end:
            stop = n
        else:
            stop = int(np.flatnonzero(new_key)[-1])
            if n - stop > HELD_ROWS:  # a hot key: let go of all but its last context, or all but two rows
                last = int(np.flatnonzero(new)[-1])
                if last > stop or self.several == key[-1]:
                    forced = int(key[-1])
                stop = max(last, n - 2) if last == stop else last
        if not stop:
            return None
        held, self.rows = rows[:, :stop], rows[:, stop:]
        key, new_key, new = key[:stop], new_key[:stop], new[:stop]
        group = np.flatnonzero(new)
        size = np.diff(np.append(group, stop))
        if not end and stop < n and not new[-1:].all() and rows[0, stop] == rows[0, stop - 1] and rows[1, stop] == rows[1, stop - 1]:
            size[-1] += 2  # the held-back rows of the same context
        marked = np.maximum.reduceat(held[7], group) == REPEATED
        repeated = np.repeat((size >= 2) | marked, np.diff(np.append(group, stop)))
        told = repeated & (held[7] == ALONE)  # the bytes of marked ones have been told already
        first_of_key = np.flatnonzero(new_key)
        contexts = np.add.reduceat(new.astype(np.int64), first_of_key)
        many = np.repeat(contexts >= 2, np.diff(np.append(first_of_key, stop)))
        for known in (self.several, forced):
            if known is not None:
                many |= key == known
        self.several = forced if forced is not None else (self.several if self.rows.shape[1] and self.several == self.rows[0, 0] else None)
        representative = new & many
        kinds = np.concatenate((np.zeros(int(told.sum()), np.int64), np.where(repeated[representative], 2, 1)))
        return np.concatenate((held[:, told], held[:, representative]), axis=1), kinds


_GATHERED = _ARROW.append(pa.field("kind", pa.int32()))


def gather(occurrences: DataFrame) -> DataFrame:
    """Step 2: occurrences that matter, with their ``kind`` (see ``_Gatherer``)."""

    def run(batches):
        gatherer = _Gatherer()

        def told(found):
            return _rows(np.concatenate((found[0], found[1][None])), _GATHERED)

        for batch in batches:
            rows = np.array([c.to_numpy().astype(np.int64) for c in batch.columns])
            spans = rows[:, rows[7] == SPAN]
            if spans.shape[1]:
                yield told((spans, np.zeros(spans.shape[1], np.int64)))
            if (found := gatherer.take(rows[:, rows[7] != SPAN])) is not None:
                yield told(found)
        if (found := gatherer.take(None)) is not None:
            yield told(found)

    ordered = occurrences.repartition(F.col("key")).sortWithinPartitions("key", "context")
    return ordered.mapInArrow(run, _KINDS + ", kind int")


def compare_suffixes(table: PrefixHashes, data: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Longest common prefixes, up to ``length``, by binary search over the hashes."""
    low, high = np.zeros(len(a), np.int64), np.full(len(a), length, np.int64)
    while True:
        middle = (low + high + 1) >> 1
        if not (low < high).any():
            return low
        same = table.of(a, a + middle) == table.of(b, b + middle)
        low = np.where(same, middle, low)
        high = np.where(same, high, np.maximum(middle - 1, low))


def sort_suffixes(table: PrefixHashes, data: np.ndarray, suffixes: np.ndarray, lists: np.ndarray, length: int) -> np.ndarray:
    """Mergesort of many lists of suffixes at once (``lists``: ascending list numbers), each by its
    first ``length`` bytes; equal suffixes keep their order."""
    n = len(suffixes)
    begin = np.flatnonzero(np.concatenate(([True], lists[1:] != lists[:-1])))
    sizes = np.diff(np.append(begin, n))
    begin, stop = np.repeat(begin, sizes), np.repeat(begin + sizes, sizes)
    position, out, run = np.arange(n), suffixes.copy(), 1
    longest = int(sizes.max(initial=0))
    while run < longest:
        inner = position - begin
        odd = (inner // run) & 1
        merged = begin + inner // (2 * run) * (2 * run)
        other = np.where(odd, merged, np.minimum(merged + run, stop))  # the run to be merged with
        other_stop = np.where(odd, merged + run, np.minimum(merged + 2 * run, stop))
        low, high = other.copy(), other_stop.copy()
        while True:
            live = np.flatnonzero(low < high)
            if not len(live):
                break
            middle = (low[live] + high[live]) >> 1
            mine, theirs = out[live], out[middle]
            common = compare_suffixes(table, data, mine, theirs, length)
            at = np.minimum(common, length - 1)
            x, y = data[mine + at], data[theirs + at]
            before = (common < length) & (y < x) | ((common == length) | (x == y)) & (odd[live] == 1)
            low[live] = np.where(before, middle + 1, low[live])
            high[live] = np.where(before, high[live], middle)
        target = merged + (inner % run) + (low - other)
        moved = np.empty_like(out)
        moved[target] = out
        out, run = moved, run * 2
    return out


def repeated_windows(contexts: list[bytes], keys: np.ndarray, far: np.ndarray, near: np.ndarray, length: int = LENGTH):
    """Step 3 for a batch: per context (the bytes of its windows, from the farthest start to the
    nearest's end) a boolean array over its starts: which windows another context of its key has at
    the same offset."""
    data = np.frombuffer(b"".join(contexts) + b"\0", np.uint8)
    counts = far - near + 1
    begin = np.concatenate(([0], np.cumsum([len(c) for c in contexts])[:-1]))
    owner = np.repeat(np.arange(len(contexts)), counts)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    suffixes, offset = begin[owner] + step, far[owner] - step
    by = np.lexsort((offset, keys[owner]))
    lists = np.cumsum(np.concatenate(([0], (keys[owner][by][1:] != keys[owner][by][:-1]) | (offset[by][1:] != offset[by][:-1]))))
    lonely = np.bincount(lists)[lists] < 2
    by, lists = by[~lonely], lists[~lonely]
    table = PrefixHashes(data)
    ordered = sort_suffixes(table, data, suffixes[by], lists, length)
    a, b = ordered[:-1], ordered[1:]
    equal = (lists[1:] == lists[:-1]) if len(lists) else np.zeros(0, bool)
    pairs = np.flatnonzero(equal)
    pairs = pairs[compare_suffixes(table, data, a[pairs], b[pairs], length) == length]
    windows = np.lib.stride_tricks.sliding_window_view(data, length) if len(data) >= length else None
    checked = [pairs[i : i + 20_000][(windows[a[pairs[i : i + 20_000]]] == windows[b[pairs[i : i + 20_000]]]).all(axis=1)] for i in range(0, len(pairs), 20_000)]
    pairs = np.concatenate(checked) if checked else pairs
    hit = np.zeros(len(data) + 1, bool)
    hit[a[pairs]] = hit[b[pairs]] = True
    return [hit[s : s + c] for s, c in zip(begin.tolist(), counts.tolist(), strict=True)]


def _with_text(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Documents with the occurrences that lie in them; texts travel compressed."""
    grouped = rows.groupBy("k1", "k2").agg(F.collect_list(F.struct("key", "place", "far", "near")).alias("found"))
    return _packed(docs).join(grouped, ["k1", "k2"])


def _packed(docs: DataFrame) -> DataFrame:
    """``k1, k2, packed``: the text as compressed bytes; a document's columns come after."""
    names = [c for c in docs.columns if c != "text"]
    place = docs.columns.index("text")
    kinds = StructType([StructField(f.name, f.dataType) for f in docs.schema if f.name != "text"]).add("packed", "binary")

    def run(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in slices(batches):
            packed = pa.array([pack(t) for t in utf8_column(batch.column(place))], pa.binary())
            kept = [batch.column(i) for i in range(batch.num_columns) if i != place]
            yield pa.RecordBatch.from_arrays([*kept, packed], names=[*names, "packed"])

    return docs.mapInArrow(run, kinds)


def unpack(packed: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(packed)


_SPANS = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def _sort_contexts(rows: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """Step 3: spans of the windows that are found repeated, from one occurrence of each context."""
    extracted = pa.schema([("key", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("place", pa.int64()), ("far", pa.int32()), ("near", pa.int32()), ("bytes", pa.binary())])

    def extract(batches):
        for batch in batches:
            for k1, k2, packed, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text, out = unpack(packed), []
                for x in found:
                    out.append((x["key"], k1, k2, x["place"], x["far"], x["near"], text[x["place"] - x["far"] : x["place"] - x["near"] + length]))
                    if len(out) == 10_000:
                        yield _batch(zip(*out, strict=True), extracted)
                        out = []
                if out:
                    yield _batch(zip(*out, strict=True), extracted)

    def flush(held):
        key, k1, k2, place, far, near = (np.array(c, np.int64) for c in list(zip(*held, strict=True))[:6])
        found = repeated_windows([x[6] for x in held], key, far, near, length)
        out = []
        for i, hit in enumerate(found):
            edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
            base = place[i] - far[i]
            out += [(k1[i], k2[i], base + a, base + b - 1 + length) for a, b in edges.reshape(-1, 2)]
        return _batch(zip(*out, strict=True), _SPANS) if out else None

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if len(held) >= SORTED_CONTEXTS and row[0] != held[-1][0]:
                    if (spans := flush(held)) is not None:
                        yield spans
                    held = []
                held.append(row)
        if held and (spans := flush(held)) is not None:
            yield spans

    contexts = _with_text(rows, docs).select("k1", "k2", "packed", "found")
    contexts = contexts.mapInArrow(extract, "key bigint, k1 bigint, k2 bigint, place bigint, far int, near int, bytes binary")
    dealt = contexts.repartition(F.col("key")).sortWithinPartitions("key")
    return dealt.mapInArrow(run, "k1 bigint, k2 bigint, start bigint, end bigint")


def _split(rows: DataFrame, docs: DataFrame, length: int, size: int) -> DataFrame:
    """Occurrences of hot keys, split into blocks of ``size`` neighbouring offsets; the new key is
    the hash of the bytes that all windows of a block share, with the old key and the block."""
    widest = length - length // 2

    def run(batches):
        for batch in batches:
            for k1, k2, packed, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = np.frombuffer(unpack(packed), np.uint8)
                parts = []
                for x in found:
                    for low in range(x["near"] // size * size, x["far"] + 1, size):
                        parts.append((x["key"], x["place"], min(x["far"], low + size - 1), max(x["near"], low), low))
                key, place, far, near, low = (np.array(c, np.int64) for c in zip(*parts, strict=True))
                share = PrefixHashes(data).of(place - low, place - np.minimum(low + size - 1, widest) + length)
                whole = PrefixHashes(data, _BASES[1]).of(place - far, place - near + length)
                new = _mixed(share ^ _mixed(key.view(np.uint64) + low.astype(np.uint64) * _MIX))
                context = _mixed(whole ^ ((far * 1024 + near).astype(np.uint64) * _MIX))
                names = (np.full(len(key), k, np.int64) for k in (k1, k2))
                yield _rows(np.stack([new.view(np.int64), context.view(np.int64), *names, place, far, near, np.zeros_like(place)]))

    return _with_text(rows, docs).select("k1", "k2", "packed", "found").mapInArrow(run, _KINDS)


def repeated_spans(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, max_contexts: int = MAX_CONTEXTS) -> DataFrame:
    """``k1, k2, spans`` of the documents (named by two hashes of id and text) that hold repeats:
    half-open byte intervals, not united."""
    docs = documents.select(*_identified(documents, id_col, text_col))
    spans, occurrences = [], _find_anchors(docs, length)
    size = 1 << (length - length // 2).bit_length()
    while True:
        found = materialise(gather(occurrences), f"suffix_{uuid.uuid4().hex[:6]}")
        whole = found.where("kind = 0")
        spans.append(whole.select("k1", "k2", (F.col("place") - F.col("far")).alias("start"), (F.col("place") - F.col("near") + length).alias("end")))
        single = found.where("kind > 0")
        hot = single.groupBy("key").count().where(F.col("count") > max_contexts).select("key")
        if hot.isEmpty():
            spans.append(_sort_contexts(single, docs, length))
            break
        spans.append(_sort_contexts(single.join(hot, "key", "left_anti"), docs, length))
        size = max(1, size // 2)
        occurrences = _split(single.join(hot, "key", "left_semi"), docs, length, size)
    every = spans[0]
    for more in spans[1:]:
        every = every.unionByName(more)
    return every.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def united(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that half-open intervals cover."""
    if not spans:
        return []
    pairs = np.array([(x["start"], x["end"]) for x in spans])
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    new = np.concatenate(([True], pairs[1:, 0] > reach[:-1]))
    last = np.append(np.flatnonzero(new)[1:] - 1, len(pairs) - 1)
    return list(zip(pairs[new, 0].tolist(), reach[last].tolist(), strict=True))


def cut(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for start, end in runs:
        kept.append(text[at:start])
        at = end
    return b"".join([*kept, text[at:]])


_DIGESTS = StructType().add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string")
_DIGESTS.add("runs", ArrayType(StructType().add("start", "long").add("end", "long")))


def remove_repeats(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    max_contexts: int = MAX_CONTEXTS,
    digests: bool = False,
) -> DataFrame:
    """The documents (all their columns) with the text cut. A document that the cut leaves without a
    word is dropped. With ``digests``, instead, every document's ``id, n_bytes, n_removed, n_spans,
    kept_sha256, runs`` (the removed runs of bytes)."""
    spans = repeated_spans(documents, id_col, text_col, length, max_contexts)
    schema = documents.select(id_col).schema if digests else documents.schema
    names = [id_col] if digests else [c for c in documents.columns if c != text_col]
    k1, k2, text = _identified(documents, id_col, text_col)
    held = documents.select(k1, k2, *[F.col(c).alias(f"c{i}") for i, c in enumerate(names)], text, F.col(text_col).isNull().alias("blank"))
    inner = [f"c{i}" for i in range(len(names))]
    joined = _packed(held).join(spans, ["k1", "k2"], "left").select(*inner, "blank", "packed", "spans")
    kinds = StructType([StructField(f"c{i}", schema[c].dataType) for i, c in enumerate(names)])
    for f in _DIGESTS if digests else StructType().add("text", "string"):
        kinds.add(f)
    shape = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in slices(batches):
            columns = batch.columns[: len(inner)]
            texts = [unpack(p) for p in batch.column("packed").to_pylist()]
            runs = [united(x) for x in batch.column("spans").to_pylist()]
            kept = [cut(t, r) for t, r in zip(texts, runs, strict=True)]
            if digests:
                extra = [
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([len(t) - len(k) for t, k in zip(texts, kept, strict=True)], pa.int64()),
                    pa.array([len(r) for r in runs], pa.int64()),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                    pa.array([[{"start": a, "end": b} for a, b in r] for r in runs], shape),
                ]
                yield pa.RecordBatch.from_arrays([*columns, *extra], names=[*inner, "n_bytes", "n_removed", "n_spans", "kept_sha256", "runs"])
            else:
                # a cut may part a character: what is left of it goes
                cut_texts = [None if null and not k else k.decode("utf-8", "ignore") for k, null in zip(kept, batch.column("blank").to_pylist(), strict=True)]
                stays = pa.array([not r or bool(k.split()) for k, r in zip(kept, runs, strict=True)], pa.bool_())
                out = pa.RecordBatch.from_arrays([*columns, pa.array(cut_texts, pa.string())], names=[*inner, "text"])
                yield out.filter(stays)

    found = joined.mapInArrow(run, kinds)
    if digests:
        return found.withColumnRenamed("c0", "id")
    order = [F.col("text" if c == text_col else f"c{names.index(c)}").alias(c) for c in documents.columns]
    return found.select(*order)
