"""Token-id output as directly addressable codes (DACs).

Writing: documents are range-sorted by id, so one shuffle moves each text once; a task encodes the
texts of its range, appends the end id to each document and rolls to the next file at ``roll_ids``
ids. In a file every id is cut into chunks, low bits first. Level ``k`` holds, packed, the ``k``-th
chunk of all ids that have one, and a continuation bitmap that tells which of them go on in the next
level; a rank directory gives the number of set bits before every 512th bit. The chunk that follows
entry ``i`` of a level is entry ``rank(i)`` of the next, so any id is read with one chunk, one bitmap
block and one directory entry a level, and no block is decoded. The chunk widths are those of least
size for the bit lengths of the file's ids (dynamic programming over at most 32 bits). Two columns
close a file: the documents' ids and where each document ends.

Files are written under temporary names and renamed to a final name that depends on range and number
only; their bytes depend on the rows alone, so a task that runs again replaces a file by an equal
one. The files' sizes, checksums and first positions are the manifest, a table that Spark commits at
the end; only files in the manifest count. Positions are running sums over files within a range,
ranges within a block of ranges, and blocks.

Reading: ``read_documents`` reads the files of the manifest in parallel, a task a file;
``tokens_at`` reads single ids by position; ``Shard`` does both for one file.

Defined cases: a null text is empty and has the end id alone; a null id sorts first and is read back
as null; rows that repeat an id stand next to each other, by a hash of their texts; an empty table
gives an empty manifest and no rows; a document is never split over files, so one longer than
``roll_ids`` has a larger file; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpi_lake.llm.bpe import byte_alphabet
from kpi_lake.llm.common import utf8_column, worker_cache
from kpi_lake.llm.warc import _filesystem as filesystem

MAGIC = b"DACTOK01"
#: A file is closed at this many ids; a task holds one file's ids.
ROLL_IDS = 4 << 20
#: Bytes of text in a range (a write task).
RANGE_BYTES = 32 << 20
#: Bits of a bitmap for one entry of its rank directory.
RANK_BITS = 512
#: Most tasks of a read.
READ_TASKS = 50_000
#: New words after which a Python worker forgets those that it hasn't met for as long, and the longest
#: word that it remembers (memory only).
REMEMBERED_WORDS, LONGEST_WORD = 350_000, 48
_SLICE = 1 << 16


def pack(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of each value, one after another, lowest bit first: eight values are
    ``width`` bytes, and the ``k``-th of them begins at bit ``k * width``."""
    if width in (8, 16, 32):
        return values.astype(f"<u{width // 8}").tobytes()
    kind, out = np.uint32 if width <= 25 else np.uint64, []
    for start in range(0, len(values), _SLICE):
        part = values[start : start + _SLICE]
        padded = np.zeros(-(-len(part) // 8) * 8, kind)
        padded[: len(part)] = part
        eights = np.ascontiguousarray((padded & kind((1 << width) - 1)).reshape(-1, 8).T)
        rows = np.zeros((width, eights.shape[1]), np.uint8)
        for k in range(8):
            byte, bit = divmod(k * width, 8)
            moved = eights[k] << kind(bit)
            for j in range((bit + width + 7) // 8):
                rows[byte + j] |= (moved >> kind(8 * j)).astype(np.uint8)
        out.append(rows.T.tobytes())
    return b"".join(out)[: -(-len(values) * width // 8)]


def unpack(data: bytes, width: int, n: int) -> np.ndarray:
    """The inverse of ``pack``: ``n`` values."""
    if width in (8, 16, 32):
        return np.frombuffer(data, f"<u{width // 8}", n).astype(np.uint32)
    kind, found = np.uint32 if width <= 25 else np.uint64, np.empty(n, np.uint32)
    for start in range(0, n, _SLICE):
        eights = -(-min(_SLICE, n - start) // 8)
        part = data[start * width // 8 : start * width // 8 + eights * width]
        rows = np.ascontiguousarray(np.frombuffer(part + bytes(eights * width - len(part)), np.uint8).reshape(eights, width).T)
        values = np.empty((8, eights), np.uint32)
        for k in range(8):
            byte, bit = divmod(k * width, 8)
            value = rows[byte].astype(kind)
            for j in range(1, (bit + width + 7) // 8):
                value |= rows[byte + j].astype(kind) << kind(8 * j)
            values[k] = value >> kind(bit) & kind((1 << width) - 1)
        found[start : start + _SLICE] = values.T.ravel()[: n - start]
    return found


def best_widths(ids: np.ndarray) -> list[int]:
    """Chunk widths of least total size for these ids: ``longer[b]`` ids need more than ``b`` bits, so
    a level from bit ``i`` to bit ``j`` holds ``longer[i]`` chunks, and a bitmap unless it is the last."""
    top = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    longer = [len(ids)] + [int(np.count_nonzero(ids >= np.uint32(1 << b))) for b in range(1, top)]
    marks = 1 + 64 / RANK_BITS
    best: list[tuple[float, list[int]]] = [(0.0, [])] * (top + 1)
    for i in range(top - 1, -1, -1):
        best[i] = min((longer[i] * (j - i + marks * (j < top)) + best[j][0], [j - i, *best[j][1]]) for j in range(i + 1, top + 1))
    return best[0][1]


def build_shard(doc_ids: list[int | None], ends: np.ndarray, ids: np.ndarray) -> bytes:
    """One file's bytes: magic, length and text of a JSON header, then sections at multiples of 8."""
    widths, sections, levels = best_widths(ids), [], []
    rest = ids.astype(np.uint32)
    for k, width in enumerate(widths):
        level = {"width": width, "n": len(rest), "chunks": len(sections)}
        sections.append(pack(rest & np.uint32((1 << width) - 1), width))
        if k + 1 < len(widths):
            rest = rest >> np.uint32(width)
            more = rest > 0
            bitmap = np.packbits(more, bitorder="little")
            ones = np.add.reduceat(more, np.arange(0, len(more), RANK_BITS), dtype=np.uint64) if len(more) else np.zeros(0, np.uint64)
            level |= {"bitmap": len(sections), "ranks": len(sections) + 1}
            sections += [bitmap.tobytes(), (np.cumsum(ones, dtype=np.uint64) - ones).astype("<u8").tobytes()]
            rest = rest[more]
        levels.append(level)
    known = np.array([d is not None for d in doc_ids], bool)
    tail = [np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.packbits(known, bitorder="little").tobytes(), ends.astype("<i8").tobytes()]
    header = {"n_ids": len(ids), "n_docs": len(doc_ids), "levels": levels, "documents": len(sections), "sections": []}
    sections += tail
    at = 0
    for s in sections:
        header["sections"].append([at, len(s), zlib.crc32(s)])
        at += -(-len(s) // 8) * 8
    text = json.dumps(header, separators=(",", ":")).encode()
    text += b" " * (-len(text) % 8)
    return MAGIC + len(text).to_bytes(8, "little") + text + b"".join(s + bytes(-len(s) % 8) for s in sections)


class Shard:
    """One file, over ``read_at(length, offset)``; nothing but the header is read when it is opened."""

    def __init__(self, read_at):
        self._read_at = read_at
        head = read_at(16, 0)
        if head[:8] != MAGIC:
            raise ValueError("no file of directly addressable codes")
        size = int.from_bytes(head[8:], "little")
        self.header = json.loads(read_at(size, 16))
        self._base = 16 + size
        self.n_ids, self.n_docs, self.levels = self.header["n_ids"], self.header["n_docs"], self.header["levels"]

    def _part(self, section: int, start: int, length: int) -> bytes:
        at, size, _ = self.header["sections"][section]
        return self._read_at(min(length, size - start), self._base + at + start)

    def _section(self, section: int) -> bytes:
        _, size, checksum = self.header["sections"][section]
        data = self._part(section, 0, size)
        if zlib.crc32(data) != checksum:
            raise ValueError("damaged section")
        return data

    def token(self, i: int) -> int:
        """The id at place ``i``: per level one chunk, one bitmap block, one directory entry."""
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        value = shift = 0
        for level in self.levels:
            first, width = i * level["width"], level["width"]
            chunk = self._part(level["chunks"], first // 8, (first % 8 + width + 7) // 8)
            value |= (int.from_bytes(chunk, "little") >> first % 8 & (1 << width) - 1) << shift
            if "bitmap" not in level:
                break
            block = i // RANK_BITS
            bits = int.from_bytes(self._part(level["bitmap"], block * RANK_BITS // 8, RANK_BITS // 8), "little")
            place = i % RANK_BITS
            if not bits >> place & 1:
                break
            rank = int.from_bytes(self._part(level["ranks"], 8 * block, 8), "little")
            i, shift = rank + (bits & (1 << place) - 1).bit_count(), shift + width
        return value

    def all_tokens(self) -> np.ndarray:
        """All ids, level by level."""
        found = np.zeros(self.n_ids, np.uint32)
        places, shift = None, 0
        for level in self.levels:
            chunk = unpack(self._section(level["chunks"]), level["width"], level["n"]) << np.uint32(shift)
            if places is None:
                found[:] = chunk
            else:
                found[places] |= chunk
            if "bitmap" in level:
                more = np.unpackbits(np.frombuffer(self._section(level["bitmap"]), np.uint8), count=level["n"], bitorder="little").view(bool)
                places = np.flatnonzero(more) if places is None else places[more]
            shift += level["width"]
        return found

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """The documents' ids, and where each ends."""
        first = self.header["documents"]
        ids = np.frombuffer(self._section(first), "<i8").tolist()
        known = np.unpackbits(np.frombuffer(self._section(first + 1), np.uint8), count=self.n_docs, bitorder="little").tolist()
        return [d if k else None for d, k in zip(ids, known, strict=True)], np.frombuffer(self._section(first + 2), "<i8")


class _OtherSpace(Exception):
    """A text that doesn't split at single blanks and line ends."""


class _Words(dict):
    """Ids of words, with ``before`` (a blank or nothing) before each, learned when first met. Plain
    words are one piece of the pre-splitting, which the library's model encodes directly."""

    def __init__(self, library, before: str):
        self.library, self.before, self.model = library, before, library.model.tokenize
        self.old: dict[str, bytes] = {}
        alphabet = {b: c for c, b in byte_alphabet().items()}
        self.printed = str.maketrans({chr(b): c for b, c in alphabet.items()})
        self.ahead = before.translate(self.printed)
        self.marks = {c: _pack_ids(library.encode(c, add_special_tokens=False).ids) for c in ",."}

    def age(self) -> None:
        """Words that were not met since the last time are forgotten."""
        self.old = dict(self)
        self.clear()

    def __missing__(self, word: str) -> bytes:
        known = self.old.get(word)
        if known is not None:
            self[word] = known
            return known
        if _plain(word):
            printed = self.ahead + (word if word.isascii() else word.encode().decode("latin-1").translate(self.printed))
            ids = _pack_ids([t.id for t in self.model(printed)])
        elif word[-1:] in self.marks and _plain(word[:-1]):
            ids = self[word[:-1]] + self.marks[word[-1]]
        elif word.split() != [word]:
            raise _OtherSpace
        else:
            ids = _pack_ids(self.library.encode(self.before + word, add_special_tokens=False).ids)
        if len(word) <= LONGEST_WORD:
            self[word] = ids
        return ids


def _plain(word: str) -> bool:
    """Whether a word is letters only, of blocks that no version of Unicode has changed."""
    return word.isalpha() and (word.isascii() or max(word) < "\u0250")


_PACKERS = [struct.Struct(f"<{n}I").pack for n in range(32)]


def _pack_ids(ids: list[int]) -> bytes:
    return _PACKERS[len(ids)](*ids) if len(ids) < 32 else struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Ids of whole texts by the tokenizers library. In a text whose lines hold single blanks between
    their words and no other white space, no piece of byte-level pre-splitting spans a blank and what
    stands before it, nor a line end; there each distinct word is encoded once and remembered. Other
    texts, and those with a special string, go to the library whole."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        known = json.loads(spec)
        pre, model = known.get("pre_tokenizer") or {}, known["model"]
        plain = model["type"] == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
        self.by_words = plain and not known.get("normalizer") and not model.get("dropout")
        self.specials = [t["content"] for t in known.get("added_tokens", [])]
        if self.by_words:
            self.starts, self.inner = _Words(self.library, ""), _Words(self.library, " ")
            self.line_end = _pack_ids(self.library.encode("\n", add_special_tokens=False).ids)

    def _by_words(self, text: str) -> bytes | None:
        """Ids word by word; None if the text has to go whole."""
        if not self.by_words or any(s in text for s in self.specials):
            return None
        found, starts, inner = [], self.starts.__getitem__, self.inner.__getitem__
        try:
            for line in text.split("\n"):
                words = line.split(" ")
                found.append(starts(words[0]) + b"".join(map(inner, words[1:])))
        except _OtherSpace:
            return None
        return self.line_end.join(found)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers."""
        if self.by_words and len(self.starts) + len(self.inner) > REMEMBERED_WORDS:
            self.starts.age()
            self.inner.age()
        found = [self._by_words(t) for t in texts]
        rest = [t for t, f in zip(texts, found, strict=True) if f is None]
        whole = iter(self.library.encode_batch_fast(rest, add_special_tokens=False))
        return [_pack_ids(next(whole).ids) if f is None else f for f in found]


def shared_encoder(spark: SparkSession, path: str):
    """A function that gives the encoder, made once per Python worker from the file's text."""
    with open(path, encoding="utf-8") as f:
        shared, key = spark.sparkContext.broadcast(f.read()), uuid.uuid4().hex

    def get() -> Encoder:
        kept = worker_cache("dac")
        if key not in kept:
            kept.clear()
            kept[key] = Encoder(shared.value)
        return kept[key]

    return get


_FILE = pa.schema(
    [("part", pa.int64()), ("number", pa.int64()), ("file", pa.string()), ("bytes", pa.int64()), ("crc32", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]
)
_FILE_KINDS = "part bigint, number bigint, file string, bytes bigint, crc32 bigint, n_docs bigint, n_ids bigint"
_MANIFEST_KINDS = _FILE_KINDS + ", start bigint"
#: Ranges whose running sums one task makes.
_BLOCK = 1024


class _Roller:
    """Collects documents and writes each full file under a temporary name, then renames it."""

    def __init__(self, folder: str, part: int, roll_ids: int):
        self.fs, self.folder = filesystem(folder)
        self.part, self.roll_ids, self.number = part, roll_ids, 0
        self.ids, self.docs, self.ends, self.size = [], [], [], 0

    def add(self, doc: int | None, ids: bytes) -> dict | None:
        self.ids.append(ids)
        self.size += len(ids) // 4
        self.docs.append(doc)
        self.ends.append(self.size)
        return self.close() if self.size >= self.roll_ids else None

    def close(self) -> dict | None:
        if not self.docs:
            return None
        data = build_shard(self.docs, np.array(self.ends, np.int64), np.frombuffer(b"".join(self.ids), "<u4"))
        name = f"part-{self.part:06d}-{self.number:05d}.dac"
        temporary = f"{self.folder}/_temporary/{name}-{uuid.uuid4().hex}"
        with self.fs.open_output_stream(temporary, compression=None) as stream:
            stream.write(data)
        try:
            self.fs.move(temporary, f"{self.folder}/{name}")
        except OSError:  # a store whose rename doesn't replace: an equal file of an earlier attempt is there
            self.fs.delete_file(f"{self.folder}/{name}")
            self.fs.move(temporary, f"{self.folder}/{name}")
        row = {"part": self.part, "number": self.number, "file": name, "bytes": len(data), "crc32": zlib.crc32(data), "n_docs": len(self.docs), "n_ids": self.size}
        self.ids, self.docs, self.ends, self.size = [], [], [], 0
        self.number += 1
        return row


def _with_starts(files: DataFrame) -> DataFrame:
    """The files with ``start``, the ids of all files before: sums within a range, within a block of
    ranges, and over blocks (one row for 1024 ranges)."""

    def before(df: DataFrame, group: list[str], order: str, name: str) -> DataFrame:
        return df.withColumn(name, F.sum("n_ids").over(Window.partitionBy(*group).orderBy(order)) - F.col("n_ids"))

    files = files.withColumn("block", F.floor(F.col("part") / _BLOCK))
    parts = files.groupBy("block", "part").agg(F.sum("n_ids").alias("n_ids"))
    blocks = parts.groupBy("block").agg(F.sum("n_ids").alias("n_ids"))
    a = before(files, ["block", "part"], "number", "a")
    b = before(parts, ["block"], "part", "b").select("block", "part", "b")
    c = before(blocks, [], "block", "c").select("block", "c")
    joined = a.join(b, ["block", "part"]).join(c, "block")
    return joined.select(*_FILE.names, (F.col("a") + F.col("b") + F.col("c")).alias("start"))


def write_tokens(
    documents: DataFrame,
    folder: str,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    roll_ids: int = ROLL_IDS,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Write the documents' ids below ``folder`` (shared by all executors) in ascending id order;
    returns the manifest: ``part, number, file, bytes, crc32, n_docs, n_ids, start``."""
    spark = documents.sparkSession
    get = shared_encoder(spark, vocabulary)
    rows = documents.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("bigint")), F.count(F.lit(1))).first()
    n = max(1, -(-((total[0] or 0) + 100 * total[1]) // range_bytes))
    keyed = rows.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    dealt = keyed.repartitionByRange(int(n), "id", "tie", "row").sortWithinPartitions("id", "tie", "row").select("id", "text")
    fs, path = filesystem(folder)
    fs.create_dir(f"{path}/_temporary", recursive=True)
    end = np.array([end_id], "<u4").tobytes()

    def write(batches):
        from pyspark import TaskContext

        encoder, out = get(), _Roller(folder, TaskContext.get().partitionId(), roll_ids)
        for batch in batches:
            for part in _portions(batch):
                texts = [raw.decode("utf-8", "replace") for raw in utf8_column(part.column(1))]
                closed = [out.add(doc, ids + end) for doc, ids in zip(part.column(0).to_pylist(), encoder.encode(texts), strict=True)]
                closed = [row for row in closed if row]
                if closed:
                    yield pa.RecordBatch.from_pylist(closed, schema=_FILE)
        last = out.close()
        if last:
            yield pa.RecordBatch.from_pylist([last], schema=_FILE)

    dealt.mapInArrow(write, _FILE_KINDS).write.mode("overwrite").parquet(f"{folder}/files")
    files = spark.read.schema(_FILE_KINDS).parquet(f"{folder}/files")
    _with_starts(files).write.mode("overwrite").parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def _portions(batch: pa.RecordBatch, size: int = 4 << 20):
    """A batch in parts of about ``size`` bytes of text (one text at least)."""
    import pyarrow.compute as pc

    at = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)) // size
    cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_MANIFEST_KINDS).parquet(f"{folder}/manifest")


def read_documents(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """Per document ``id, start`` (its first position), ``n_tokens`` (with the end id),
    ``ids_crc32`` and, if asked for, ``ids``, read from the files of the manifest."""
    fields = [("id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    kinds = "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32())))
        kinds += ", ids array<int>"
    schema = pa.schema(fields)

    def read(batches):
        fs, path = filesystem(folder)
        for batch in batches:
            for name, checksum, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with fs.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    data = stream.read()
                if zlib.crc32(data) != checksum:
                    raise ValueError(f"{name} isn't the file of the manifest")
                shard = Shard(lambda length, at, data=data: data[at : at + length])
                (docs, ends), ids = shard.documents(), shard.all_tokens().astype("<u4")
                first = 0
                for a in range(0, len(docs), 1000):
                    out: dict[str, list] = {f: [] for f in schema.names}
                    for doc, last in zip(docs[a : a + 1000], ends[a : a + 1000].tolist(), strict=True):
                        own = ids[first:last]
                        out["id"].append(doc)
                        out["start"].append(start + first)
                        out["n_tokens"].append(last - first)
                        out["ids_crc32"].append(zlib.crc32(own.tobytes()))
                        if with_ids:
                            out["ids"].append(own.view("<i4"))
                        first = last
                    yield pa.RecordBatch.from_pydict(out, schema=schema)

    manifest = read_manifest(spark, folder)
    n = max(1, min(READ_TASKS, manifest.count()))
    return manifest.select("file", "crc32", "start").repartitionByRange(n, "start").mapInArrow(read, kinds)


def tokens_at(spark: SparkSession, folder: str, wanted: DataFrame, position_col: str = "position") -> DataFrame:
    """``position, token`` for every row of ``wanted``: each id is read directly from its file.
    A null position, or one outside the written ids, has a null token."""
    manifest = read_manifest(spark, folder)
    spans = manifest.select("file", "start", (F.col("start") + F.col("n_ids")).alias("stop")).where("stop > start")
    spans = spans.select("*", F.explode(F.sequence(F.floor(F.col("start") / ROLL_IDS), F.floor((F.col("stop") - 1) / ROLL_IDS))).alias("step"))
    asked = wanted.select(F.col(position_col).cast("bigint").alias("position")).withColumn("step", F.floor(F.col("position") / ROLL_IDS))
    held = (asked["step"] == spans["step"]) & (asked["position"] >= spans["start"]) & (asked["position"] < spans["stop"])
    found = asked.join(spans, held, "left").select("position", "file", "start").sortWithinPartitions("file", "position")
    schema = pa.schema([("position", pa.int64()), ("token", pa.int64())])

    def read(batches):
        fs, path = filesystem(folder)
        opened, stream, shard = None, None, None
        for batch in batches:
            tokens = []
            for position, name, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if name is None:
                    tokens.append(None)
                    continue
                if name != opened:
                    if stream is not None:
                        stream.close()
                    opened, stream = name, fs.open_input_file(f"{path}/{name}")
                    shard = Shard(stream.read_at)
                tokens.append(shard.token(position - start))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tokens, pa.int64())], schema=schema)
        if stream is not None:
            stream.close()

    return found.mapInArrow(read, "position bigint, token bigint")
