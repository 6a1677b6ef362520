"""Ranked lexical search over K2-treaps of the term-document grid.

Index: a first pass counts the documents that have terms (``N``) and all their terms (``L``), which
fix each cell's impact ``g = (10^9 tf) div (1000 tf + 12 m)``, ``m = 75 + (25 n N) div L``. A second
pass cuts the documents into shards of about ``CELLS`` cells and builds, per shard, a quadtree over
the grid (rows: terms, frequent first; columns: documents, those with the same most frequent term
side by side). A node of the tree stands for a square of the grid and stores the largest impact in
it with its place; that cell is taken out of the square before it is split in four, so a tree has
just as many nodes as cells. Nodes lie level by level, with four bits each that tell which squares
below hold anything; the node below is found by counting bits. Impacts are stored as differences to
the node above, places relative to the square. A shard is one row of the index table, with its
dictionary (terms by hash, and the documents that hold each) beside it.

Search: the queries go over the index in blocks of bounded size. The shards' dictionaries give each
term's document frequency, and so its weight, over the whole index. In a shard the row paths of a
query's terms descend together over ranges of documents: a state is a range and, per term, the node
whose square holds the term's row and the range. Cells of the own row that are met on the way are
added to their document's score. No document of the range can have more than the sum of the nodes'
impacts, weighted, and what its best document has already. The states of largest bound are taken
first (a batch at a time), and the search ends when no bound reaches the k-th best score, which a
task keeps from shard to shard. The result is exact, ties included.

Defined cases: null and empty texts, and queries without a term, have no results; a null document id
stands before all others among equal scores; each distinct (id, text) is a query of its own, so
repeated query rows count once and an id with two texts has two rankings; rows that repeat a
document id are documents of their own; an empty table gives no rows; documents are never split, so
a longer one makes a larger shard; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import math
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpi_lake.llm.common import materialise, slices, utf8_column

#: Cells of a shard, and bytes of query text in a block.
CELLS, BLOCK_BYTES = 1 << 20, 4 << 20
#: States that are taken at a time.
BATCH = 128
# Fixed value: bytes of terms, A-Z lower-cased; all else separates. Bytes from 128 on are letters.
TERMS = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
_ONES = np.array([bin(b).count("1") for b in range(16)], np.int64)


def terms(raw: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return raw.translate(TERMS).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _spread(values: np.ndarray) -> np.ndarray:
    """The bits of each value at the even places of a 64-bit integer."""
    x = values.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | x << np.uint64(shift)) & np.uint64(mask)
    return x


def _planes(values: np.ndarray) -> bytes:
    """32-bit integers as four byte planes, which compress better than the integers."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _join(header: dict, parts: list[bytes]) -> bytes:
    """Named sections as one compressed value (so that it's small wherever Spark holds it)."""
    import zstandard

    text = json.dumps(header | {"sizes": [len(p) for p in parts]}).encode()
    return zstandard.ZstdCompressor(level=3).compress(len(text).to_bytes(8, "little") + text + b"".join(parts))


def _cut(data: bytes) -> tuple[dict, list[bytes]]:
    import zstandard

    raw = memoryview(zstandard.ZstdDecompressor().decompress(data))
    size = int.from_bytes(raw[:8], "little")
    header, at, parts = json.loads(bytes(raw[8 : 8 + size])), 8 + size, []
    for n in header["sizes"]:
        parts.append(raw[at : at + n])
        at += n
    return header, parts


def build_tree(rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray) -> bytes:
    """The treap of the cells (each place once)."""
    height = max(1, int(max(rows.max(), columns.max())).bit_length())
    codes = _spread(rows) << np.uint64(1) | _spread(columns)
    order = np.argsort(codes)
    codes, rows, columns, impacts = codes[order], rows[order].astype(np.int64), columns[order].astype(np.int64), impacts[order].astype(np.int64)
    sizes, bits, drops, places = [], [], [], []
    above_keys, above_impacts = None, None
    for level in range(height + 1):
        if not len(codes):
            break
        keys = codes >> np.uint64(2 * (height - level)) if height > level else codes
        starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        ranked = impacts << 32 | (len(codes) - 1 - np.arange(len(codes)))  # of equal impacts, the first place
        top = len(codes) - 1 - (np.maximum.reduceat(ranked, starts) & 0xFFFFFFFF)
        node_keys, node_impacts = keys[starts], impacts[top]
        if above_keys is None:
            drops.append(node_impacts)
        else:
            parent = np.searchsorted(above_keys, node_keys >> np.uint64(2))
            bits.append(np.bincount(parent, weights=1 << (node_keys & np.uint64(3)).astype(np.int64), minlength=len(above_keys)).astype(np.uint8))
            drops.append(above_impacts[parent] - node_impacts)
        inside = (1 << (height - level)) - 1
        places.append((rows[top] & inside, columns[top] & inside))
        sizes.append(len(starts))
        above_keys, above_impacts = node_keys, node_impacts
        rest = np.ones(len(codes), bool)
        rest[top] = False
        codes, rows, columns, impacts = codes[rest], rows[rest], columns[rest], impacts[rest]
    bits.append(np.zeros(sizes[-1], np.uint8))
    flat = np.concatenate(bits)
    flat = np.append(flat, np.zeros(len(flat) % 2, np.uint8))
    parts = [(flat[::2] | flat[1::2] << 4).astype(np.uint8).tobytes(), _planes(np.concatenate(drops))]
    parts += [_planes(np.concatenate([p[i] for p in places])) for i in (0, 1)]
    return _join({"height": height, "levels": sizes}, parts)


class Tree:
    """A treap, unpacked for descents: per node its impact, its cell, its four bits and the node
    below that comes first (one more than the bits set in all nodes before)."""

    def __init__(self, data: bytes):
        header, (bits, drops, rows, columns) = _cut(data)
        self.height, sizes = header["height"], header["levels"]
        n = sum(sizes)
        pairs = np.frombuffer(bits, np.uint8)
        self.bits = np.stack((pairs & 15, pairs >> 4), axis=1).ravel()[:n]
        counts = _ONES[self.bits]
        self.first = 1 + np.cumsum(counts) - counts
        self.impact, self.row, self.column = (_from_planes(x) for x in (drops, rows, columns))
        squares = np.zeros((1, 2), np.int64)  # of the level above: row and column of each square
        start = 0
        for level, size in enumerate(sizes):
            if level:
                parent, quarter = np.nonzero(self.bits[start - len(squares) : start, None] >> np.arange(4, dtype=np.uint8) & 1)
                squares = squares[parent] * 2 + np.stack((quarter >> 1, quarter & 1), axis=1)
                self.impact[start : start + size] = self.impact[start - len(counts_above) : start][parent] - self.impact[start : start + size]
            inside = self.height - level
            self.row[start : start + size] += squares[:, 0] << inside
            self.column[start : start + size] += squares[:, 1] << inside
            counts_above = squares
            start += size

    def search(self, rows: np.ndarray, weights: np.ndarray, n_columns: int, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Columns and scores of all that can be among the ``k`` best for a query whose terms have
        these rows and weights, if only scores of at least ``floor`` (and 1) count."""
        height, base = self.height, max(0, n_columns - 1).bit_length()
        score = np.zeros(n_columns, np.int64)
        best = np.zeros(2 << base, np.int64)  # largest score in each range: a heap over the columns
        steps = np.arange(base + 1)

        def meet(nodes, ok):
            """Add the cells of the own rows to their documents' scores."""
            at = np.nonzero(ok & (self.row[nodes] == rows))
            if len(at[0]):
                cells = nodes[at]
                columns = self.column[cells]
                np.add.at(score, columns, weights[at[1]] * self.impact[cells])
                np.maximum.at(best, columns[:, None] + (1 << base) >> steps, score[columns, None])

        nodes = np.zeros((1, len(rows)), np.int64)
        meet(nodes, np.ones_like(nodes, bool))
        levels, ranges = np.zeros(1, np.int64), np.zeros(1, np.int64)
        bounds = (self.impact[nodes] * weights).sum(axis=1) + best[1]
        limit = max(1, floor)
        while True:
            found = score[score >= limit]
            if len(found) > k:
                limit = max(limit, int(np.partition(found, len(found) - k)[len(found) - k]))
            open_ = np.flatnonzero(bounds >= limit)
            if not len(open_):
                break
            if len(open_) > BATCH:
                split = np.argpartition(bounds[open_], len(open_) - BATCH)
                taken, kept = open_[split[-BATCH:]], open_[split[:-BATCH]]
            else:
                taken, kept = open_, open_[:0]
            here, level, range_ = nodes[taken], levels[taken], ranges[taken]
            ok = here >= 0
            marks = np.where(ok, self.bits[here], 0)
            row_bits = rows >> (height - 1 - level)[:, None] & 1
            parts = [(nodes[kept], levels[kept], ranges[kept], bounds[kept])]
            for side in (0, 1):
                quarter = 2 * row_bits + side
                has = (marks >> quarter & 1) == 1
                some = has.any(axis=1)
                if not some.any():
                    continue
                has, q, m, h = has[some], quarter[some], marks[some], here[some]
                below = np.where(has, self.first[h] + _ONES[m & (1 << q) - 1], -1)
                meet(below, has)
                deeper, narrower = level[some] + 1, 2 * range_[some] + side
                depth = np.maximum(deeper - (height - base), 0)  # of the range in the heap
                bound = (np.where(has, self.impact[below], 0) * weights).sum(axis=1) + best[(1 << depth) + narrower]
                more = (bound >= limit) & (deeper < height)
                parts.append((below[more], deeper[more], narrower[more], bound[more]))
            nodes, levels, ranges, bounds = (np.concatenate(c) for c in zip(*parts, strict=True))
        columns = np.flatnonzero(score >= limit)
        return columns, score[columns]


class Numbers(dict):
    """Numbers of terms, in order of first sight."""

    def __missing__(self, term: bytes) -> int:
        self[term] = n = len(self)
        return n


class ShardBuilder:
    """Collects the cells of some documents (each with a term) into a row of the index."""

    def __init__(self, n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, n_terms
        self.numbers, self.docs, self.lengths, self.sizes, self.cells, self.tf = Numbers(), [], [], [], [], []

    def add(self, doc: int | None, found: list[bytes]) -> None:
        counted = Counter(found)
        self.docs.append(doc)
        self.lengths.append(len(found))
        self.sizes.append(len(counted))
        self.cells.extend(map(self.numbers.__getitem__, counted))
        self.tf.extend(counted.values())

    def build(self) -> dict:
        names, docs, n = list(self.numbers), self.docs, len(self.docs)
        cells, tf, sizes = np.array(self.cells, np.int32), np.array(self.tf, np.int64), np.array(self.sizes)
        self.cells, self.tf = [], []
        hashes = np.array(list(map(xxhash.xxh3_64_intdigest, names)), np.uint64)
        frequency = np.bincount(cells, minlength=len(names))
        order = np.lexsort((hashes, -frequency))
        row = np.empty(len(names), np.int64)
        row[order] = np.arange(len(names))
        cell_rows, owner = row[cells], np.repeat(np.arange(n), sizes)
        m = 75 + np.array([25 * length * self.n_docs // self.n_terms for length in self.lengths], np.int64)
        impacts = 1_000_000_000 * tf // (1000 * tf + 12 * m[owner])
        starts = np.cumsum(sizes) - sizes
        common = len(names) - 1 - (np.maximum.reduceat(tf << 32 | (len(names) - 1 - cell_rows), starts) & 0xFFFFFFFF)  # each document's most frequent term
        columns = np.lexsort((self.lengths, common))
        place = np.empty(n, np.int64)
        place[columns] = np.arange(n)
        by_hash = np.argsort(hashes, kind="stable")
        sorted_names = [names[i] for i in by_hash.tolist()]
        sections = [hashes[by_hash].astype("<u8").tobytes(), _planes(row[by_hash]), _planes(frequency[by_hash])]
        sections += [_planes(np.array([len(t) for t in sorted_names])), b"".join(sorted_names)]
        tree = build_tree(cell_rows, place[owner], impacts)
        return {"n_docs": self.n_docs, "n_terms": self.n_terms, "docs": [docs[i] for i in columns.tolist()], "dictionary": _join({}, sections), "tree": tree}


class Dictionary:
    """The terms of a shard: rows and document frequencies by term."""

    def __init__(self, data: bytes):
        _, (hashes, rows, frequency, lengths, self.text) = _cut(data)
        self.hashes, self.rows, self.frequency = np.frombuffer(hashes, "<u8"), _from_planes(rows), _from_planes(frequency)
        self.ends = np.cumsum(_from_planes(lengths))

    def find(self, wanted: list[bytes], hashes: np.ndarray) -> np.ndarray:
        """The place of each wanted term in the dictionary, or -1."""
        places = np.full(len(wanted), -1, np.int64)
        low, high = np.searchsorted(self.hashes, hashes), np.searchsorted(self.hashes, hashes, "right")
        for i in np.flatnonzero(high > low).tolist():
            for at in range(low[i], high[i]):
                if self.text[self.ends[at - 1] if at else 0 : self.ends[at]] == wanted[i]:  # bytes, not hashes
                    places[i] = at
        return places


_SHARD = pa.schema([("n_docs", pa.int64()), ("n_terms", pa.int64()), ("docs", pa.list_(pa.int64())), ("dictionary", pa.binary()), ("tree", pa.binary())])
_SHARD_KINDS = "n_docs bigint, n_terms bigint, docs array<bigint>, dictionary binary, tree binary"


def build_index(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", cells: int = CELLS) -> DataFrame:
    """The index of all documents, a row a shard, as a table in the shared folder."""
    docs = documents.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))

    def measure(batches):
        for batch in batches:
            sizes = [len(terms(raw)) for part in slices([batch]) for raw in utf8_column(part.column(0))]
            yield pa.RecordBatch.from_pydict({"n": [sum(s > 0 for s in sizes)], "l": [sum(sizes)]}, schema=pa.schema([("n", pa.int64()), ("l", pa.int64())]))

    n_docs, n_terms = docs.select("text").mapInArrow(measure, "n bigint, l bigint").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("l"), F.lit(0))).first()

    def build(batches):
        shard = ShardBuilder(n_docs, n_terms)
        for batch in batches:
            for part in slices([batch]):
                for doc, raw in zip(part.column(0).to_pylist(), utf8_column(part.column(1)), strict=True):
                    found = terms(raw)
                    if found:
                        shard.add(doc, found)
                    if len(shard.cells) >= cells:
                        yield pa.RecordBatch.from_pylist([shard.build()], schema=_SHARD)
                        shard = ShardBuilder(n_docs, n_terms)
        if shard.docs:
            yield pa.RecordBatch.from_pylist([shard.build()], schema=_SHARD)

    return materialise(docs.mapInArrow(build, _SHARD_KINDS), "treap")


def _best(rows: list[tuple[int, int | None]], k: int) -> list[tuple[int, int | None]]:
    return sorted(rows, key=lambda r: (-r[0], r[1] is not None, r[1] or 0))[:k]


def search(index: DataFrame, queries: DataFrame, id_col: str = "item_id", text_col: str = "text", k: int = 20, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``query, rank, doc, score``: the ``k`` documents of largest score for each query."""
    spark = index.sparkSession
    schema = "query bigint, rank int, doc bigint, score bigint"
    first = index.select("n_docs").first()
    if first is None:
        return spark.createDataFrame([], schema)
    n_docs = first.n_docs
    asked = queries.select(F.col(id_col).cast("bigint").alias("query"), F.col(text_col).cast("string").alias("text")).where("text is not null").distinct()
    size = asked.agg(F.sum(F.octet_length("text").cast("bigint") + F.lit(64))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("query", "text"), F.lit(blocks)))
    answers = []
    for number in range(blocks):
        block = [(r.query, Counter(terms(r.text.encode()))) for r in dealt.where(F.col("block") == number).select("query", "text").collect()]
        if any(c for _, c in block):
            answers.append(_search_block(index, block, n_docs, k))
    if not answers:
        return spark.createDataFrame([], schema)
    found = answers[0]
    for a in answers[1:]:
        found = found.unionByName(a)
    return found


def _search_block(index: DataFrame, block: list[tuple[int | None, Counter]], n_docs: int, k: int) -> DataFrame:
    """One block of queries over all shards."""
    spark = index.sparkSession
    names = sorted({t for _, c in block for t in c})
    hashes = np.array([xxhash.xxh3_64_intdigest(t) for t in names], np.uint64)
    shared_names = spark.sparkContext.broadcast((names, hashes))

    def frequencies(batches):
        names, hashes = shared_names.value
        total = np.zeros(len(names), np.int64)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                dictionary = Dictionary(data)
                places = dictionary.find(names, hashes)
                total += np.where(places >= 0, dictionary.frequency[places], 0)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], ["term", "df"])

    df = index.select("dictionary").mapInArrow(frequencies, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    weights = np.zeros(len(names), np.int64)
    for r in df.collect():  # a row for a term of the block at most
        weights[r.term] = weight(n_docs, r.df)
    number = {t: i for i, t in enumerate(names)}
    asked = [(q, np.array([number[t] for t in c], np.int64), np.array(list(c.values()), np.int64)) for q, c in block]
    shared = spark.sparkContext.broadcast((asked, weights))

    def find(batches):
        (names, hashes), (asked, weights) = shared_names.value, shared.value
        best: list[list] = [[] for _ in asked]
        for batch in batches:
            for i in range(batch.num_rows):
                docs, data, tree_data = (batch.column(c)[i].as_py() for c in range(3))
                dictionary, tree = Dictionary(data), Tree(tree_data)
                places = dictionary.find(names, hashes)
                for j, (_, numbers, counts) in enumerate(asked):
                    here = places[numbers]
                    there = here >= 0
                    if not there.any():
                        continue
                    floor = best[j][-1][0] if len(best[j]) == k else 0
                    columns, scores = tree.search(dictionary.rows[here[there]], (weights[numbers] * counts)[there], len(docs), k, floor)
                    best[j] = _best(best[j] + [(s, docs[c]) for c, s in zip(columns.tolist(), scores.tolist(), strict=True)], k)
        rows = [(j, asked[j][0], doc, score) for j, b in enumerate(best) for score, doc in b]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64())
        columns = list(zip(*rows, strict=True)) if rows else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["number", "query", "doc", "score"])

    found = index.select("docs", "dictionary", "tree").mapInArrow(find, "number bigint, query bigint, doc bigint, score bigint")
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_first("doc"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query", "rank", "doc", "score")
