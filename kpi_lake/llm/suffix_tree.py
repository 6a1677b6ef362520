"""Language-model scoring by a probabilistic suffix tree.

A text is a sequence of tokens: its words, A-Z lower-cased, and one end. The model predicts each
token from the bytes before it: the tree's states are suffixes, of up to two bytes, of the previous
word (a mark stands for the bytes before a word's first, and before the first word). A suffix is a
state if its next-token distribution diverges from that of the suffix one byte shorter by at least
``GAIN`` nats per different next token (its count times the Kullback-Leibler divergence) or if a
longer suffix that ends in it is a state; the empty suffix always is one. A state's distribution is
smoothed by its parent's (Witten-Bell: the parent weighs as much as there are different next
tokens), the root's by one symbol for all tokens that training texts don't have, so that the
probabilities of the training tokens and of that symbol sum to one in every state. A token is scored
by the longest state that its history ends in; a text's score is the sum of the base-10 logarithms.
Beside it stand unigram counts and an add-one unigram score over the same symbols.

Below the byte suffixes the tree goes on word by word: the next-older symbols are the whole previous
word, the word before that, and so on, up to ``depth`` words (one mark stands for what lies before
the text). All contexts that training texts hold at least ``least`` times are counted and tested
against the context one symbol shorter; those that diverge by ``gain`` are states, smoothed by the
longest state that ends them. A context that isn't a state is passed over, and longer ones that end
in it are counted and tested all the same. The registered query takes ``DEPTH`` words.

The held-out documents (a hash of the id) take no part in any count.

Scale. Texts are read once, in blocks of bounded size, each written as a dictionary of its words,
its pairs of word and suffix, and a list of pair numbers; all counting works on dictionaries. Their
words are dealt by hash to buckets (as many as the dictionaries' sizes ask for), where the counts of
words, and of words after suffixes, are summed over all documents and go back to the blocks. The
sums that the divergence tests take are additive over buckets, so the tree's part of two bytes is a
table by suffix, 65 536 rows at most whatever the corpus, which is broadcast. A frequent
word, or one that fills a third of all texts, is one entry per block and suffix. Contexts of whole
words grow with the corpus and are never gathered. Frequent words get small numbers, which all blocks share. A
context that training texts hold ``bucket_pairs`` / 2 times at most goes to one bucket with all tokens that
follow it (by the hash of the context; of a token its number, and those of the older words up to the first that
can't belong to a context frequent enough: its own count, or that of the next word after its last two bytes, is
too small). So all its longer contexts are there too, and a bucket counts and tests them to the last in
memory. It says which tokens have a state, and how that changes the probability one symbol before
(the share of it that remains, and what is added), which the block knows. Of the context one symbol shorter the tests need one sum per
context, which blocks make. Contexts that are found more often are tested across buckets, a round a word: a
block asks for the totals of its distinct (context, token), by 64-bit hash (two that collide would share
their counts), not where the (context, token) one symbol shorter occurs in this block only; buckets sum the tests as they
sum the totals. Such contexts are at most twice the training tokens by ``bucket_pairs``, and which of them are states is
broadcast. Then their longer contexts that are rarer are dealt like the others. Blocks stay where they are, in
tables bucketed by block; a step reads them anew with what they have been told. From the third round on blocks
go on from their states of the round before, which are small, as few contexts of two words are found that often. Deals take one
share of the buckets after another, and the files of shuffles are removed with their job.

Defined cases: a null, empty or blank text is one end; a null id counts as an empty one (not held
out); repeated rows count and are scored each for itself; without training texts every token is the
unknown symbol, whose probability is one, and the base score is 0; an empty table gives no rows;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

import pickle
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cache, reduce
from itertools import chain, islice, pairwise, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpi_lake.llm.common import drop_folder, drop_table, give_back, materialise, scratch_path, slices

GAIN = 2.0
DEPTH, LEAST = 5, 8
HELD_OUT = (7, 2)
BLOCK_BYTES = 6 << 20
BUCKET_PAIRS = 1_000_000
#: Shares of the buckets that tokens are dealt to, and of the blocks that are told, one after another (disk only).
SHARES = 2
#: Rows of so many bytes go from a Python worker to Spark at once.
ROWS_BYTES = 1 << 18
#: Buckets of a deal are so many times larger than others: their tokens are settled piece by piece, and there are
#: fewer rows, which number as many as blocks times buckets.
PIECES = 4
# Bytes that no UTF-8 text has, as mark before a word's first byte, and as end token.
MARK = 0xFE
END_TOKEN = b"\xfc"
_SUFFIXES = 1 << 16
_ALL = np.iinfo(np.int64).max  # fixed value: more than any count
_START = np.uint64(0x94D049BB133111EB)  # fixed value: the hash of the mark before a text
_MIX = np.uint64(0xBF58476D1CE4E5B9)  # fixed value: a mixing constant
_FOLD = np.uint64(0x9E3779B97F4A7C15)  # fixed value: a mixing constant


def held_out(doc_id: int | None, rule: tuple[int, int] = HELD_OUT) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % rule[0] == rule[1]


@cache
def _coders():
    import zstandard

    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(values: np.ndarray) -> bytes:
    """An array as compressed bytes, all lowest bytes first."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return _coders()[0].compress(np.ascontiguousarray(planes))


def unpack(packed: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(_coders()[1].decompress(packed), np.uint8).reshape(size, -1)
    if planes.shape[1] < 4096:
        return planes.T.copy().view(kind).reshape(-1)
    numbers = planes[0].astype(f"u{size}")
    for k in range(1, size):
        if planes[k].any():
            numbers |= planes[k].astype(numbers.dtype) << numbers.dtype.type(8 * k)
    return numbers.view(kind)


def order_of(keys: np.ndarray) -> np.ndarray:
    """What puts unsigned 64-bit keys in order: their high bits are sorted with the places below them,
    unless two keys are equal in these bits and out of order in the rest."""
    bits = np.uint64(max(len(keys), 1).bit_length())
    places = keys >> bits << bits | np.arange(len(keys), dtype=np.uint64)
    places.sort()
    order = (places & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    mine = keys[order]
    return order if (mine[1:] >= mine[:-1]).all() else np.argsort(keys, kind="stable")


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct non-negative keys in order, and the number of each key among them."""
    bits = len(keys).bit_length()
    if not len(keys) or int(keys.max()).bit_length() + bits > 63:
        return np.unique(keys, return_inverse=True)
    places = keys.astype(np.int64) << bits | np.arange(len(keys))
    places.sort()
    order, mine = places & (1 << bits) - 1, places >> bits
    new = np.concatenate(([True], mine[1:] > mine[:-1]))
    inverse = np.empty(len(keys), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return mine[new], inverse


def _pack_words(words: list[bytes]) -> bytes:
    return pack(np.frombuffer(b" ".join(words), np.uint8))


def _unpack_words(packed: bytes) -> list[bytes]:
    return unpack(packed, np.uint8).tobytes().split(b" ")


def suffixes_of(words: list[bytes]) -> np.ndarray:
    """The words' last two bytes as numbers."""
    data = np.frombuffer(b" ".join([b"", *words, b""]), np.uint8)
    stops = np.flatnonzero(data == ord(" "))
    before = np.where(np.diff(stops) > 2, data[stops[1:] - 2], MARK)
    return before.astype(np.int64) << 8 | data[stops[1:] - 1]


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded size: small ones cost less together."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + sum(len(x) for x in row if isinstance(x, bytes))
        if size >= ROWS_BYTES:
            yield _rows(held, schema)
            held, size = [], 0
    if held:
        yield _rows(held, schema)


def _kinds(schema: pa.Schema) -> str:
    names = {pa.int64(): "bigint", pa.string(): "string", pa.binary(): "binary", pa.bool_(): "boolean", pa.float64(): "double"}
    names |= {pa.list_(k): f"array<{names[k]}>" for k in (pa.int64(), pa.binary())}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


# --- blocks of documents

_BLOCK = pa.schema(
    [
        ("part", pa.int64()),  # 0: texts, 1: the dictionary, which no step reads after the counts
        ("block", pa.string()),
        ("ids", pa.list_(pa.int64())),
        ("lengths", pa.binary()),  # tokens per document
        ("tokens", pa.binary()),  # pair numbers
        ("words", pa.binary()),
        ("n_pairs", pa.binary()),  # per word; pairs are in order of words
        ("suffixes", pa.binary()),  # per pair
        ("train", pa.binary()),  # per pair, its count in training documents
        ("size", pa.int64()),
        ("n_tokens", pa.int64()),
    ]
)


def _numbers() -> defaultdict:
    """Numbers words as they are asked for."""
    table = defaultdict()
    table.default_factory = table.__len__
    return table


def tokens_of(texts: pa.Array, table: dict) -> tuple[np.ndarray, np.ndarray]:
    """Of texts without nulls, how many tokens each has and all their tokens, numbered by ``table``."""
    import pyarrow.compute as pc

    found = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    text = pc.list_parent_indices(found).to_numpy()
    words = pc.list_flatten(found).dictionary_encode()
    kind = pa.large_binary() if pa.types.is_large_string(words.dictionary.type) else pa.binary()
    some = words.dictionary.cast(kind)
    different = pc.binary_join(pa.LargeListArray.from_arrays(pa.array([0, len(some)]), some), b" ")[0].as_py().split(b" ") if len(some) else []
    number = np.fromiter(map(table.__getitem__, filter(None, different)), np.int64)
    if b"" in different:
        number = np.insert(number, different.index(b""), -1)
    number = number[words.indices.to_numpy()]
    text, number = text[number >= 0], number[number >= 0]
    lengths = np.bincount(text, minlength=len(texts)) + 1
    out = np.full(len(number) + len(texts), table[END_TOKEN])
    out[np.arange(len(number)) + text] = number
    return lengths, out


def blocks_of(docs: DataFrame, rule: tuple[int, int] = HELD_OUT) -> DataFrame:
    def run(batches):
        import pyarrow.compute as pc
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        ids, parts, table, held = [], [], _numbers(), 0

        def flush():
            words = list(table)
            last = suffixes_of(words)
            lengths, token = (np.concatenate(x) for x in zip(*parts, strict=True))
            before = np.concatenate(([0], last[token[:-1]]))
            before[np.cumsum(lengths)[:-1]] = before[0] = MARK << 8 | MARK
            pairs, tokens = distinct(token * _SUFFIXES + before)
            training = np.repeat([not held_out(i, rule) for i in ids], lengths)
            counts = np.bincount(tokens[training], minlength=len(pairs))
            block, sizes = f"{part}-{number}", (len(pairs), len(tokens))
            shared = (pack(np.bincount(pairs // _SUFFIXES, minlength=len(words)).astype(np.uint32)), pack((pairs % _SUFFIXES).astype(np.uint16)))
            yield _rows([(0, block, ids, pack(lengths.astype(np.uint32)), pack(tokens.astype(np.uint32)), None, *shared, None, *sizes)], _BLOCK)
            yield _rows([(1, block, None, None, None, _pack_words(words), *shared, pack(counts.astype(np.uint32)), 0, 0)], _BLOCK)

        for batch in slices(batches):
            texts, start = pc.fill_null(batch.column(1), ""), 0
            sizes = pc.binary_length(texts).to_numpy().astype(np.int64)
            while start < len(texts):
                total = held + np.cumsum(sizes[start:])
                n = min(int(np.searchsorted(total, BLOCK_BYTES, side="right")) + 1, len(total))
                ids += batch.column(0).slice(start, n).to_pylist()
                parts.append(tokens_of(texts.slice(start, n), table))
                held, start = int(total[n - 1]), start + n
                if held > BLOCK_BYTES:
                    yield from flush()
                    number += 1
                    ids, parts, table, held = [], [], _numbers(), 0
        if ids:
            yield from flush()
        del table, parts
        give_back()

    return docs.mapInArrow(run, _kinds(_BLOCK))


# --- words in buckets

_PART = pa.schema(
    [("bucket", pa.int64()), ("block", pa.string()), ("words", pa.binary()), ("n_pairs", pa.binary()), ("starts", pa.binary()), ("suffixes", pa.binary()), ("train", pa.binary())]
)
_COUNTED = pa.schema(
    [("bucket", pa.int64()), ("block", pa.string()), ("n_pairs", pa.binary()), ("starts", pa.binary()), ("numbers", pa.binary()), ("counts", pa.binary()), ("largest", pa.int64()), ("sums", pa.binary())]
)


def _places(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers of runs of ``n`` from ``starts`` on."""
    stops = np.cumsum(n)
    return np.arange(stops[-1] if len(n) else 0) + np.repeat(starts - (stops - n), n)


def deal_words(blocks: DataFrame, n_buckets: int) -> DataFrame:
    """The words of each block, by hash, with their pairs' suffixes and counts."""

    def run(batches):
        for batch in batches:
            for block, packed, n_pairs, suffixes, train in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words, n = _unpack_words(packed), unpack(n_pairs, np.uint32).astype(np.int64)
                starts, suffix, seen = np.cumsum(n) - n, unpack(suffixes, np.uint16), unpack(train, np.uint32)
                bucket = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % n_buckets
                order = np.argsort(bucket, kind="stable")
                bucket, words, n, starts = bucket[order], np.array(words, object)[order].tolist(), n[order], starts[order]
                places = _places(starts, n)
                suffix, seen, cuts = suffix[places], seen[places], np.concatenate(([0], np.cumsum(n)))
                n, starts = n.astype(np.uint32), starts.astype(np.uint32)
                rows = (
                    (int(bucket[i]), block, _pack_words(words[i:j]), pack(n[i:j]), pack(starts[i:j]), pack(suffix[cuts[i] : cuts[j]]), pack(seen[cuts[i] : cuts[j]]))
                    for i, j in _runs(bucket)
                )
                yield from _batches(rows, _PART)

    return blocks.select("block", "words", "n_pairs", "suffixes", "train").mapInArrow(run, _kinds(_PART))


def count_words(parts: DataFrame, n_buckets: int) -> DataFrame:
    """Per bucket and block: of each word a number that all blocks share (frequent words have small
    ones); of each pair the counts, over all training documents, of its word, of its word after its
    suffix's last byte, and after its suffix, and whether only this block has it; and the count of the
    bucket's most frequent word. A bucket's first row has its sums for the tree as well: of the tokens,
    and by suffix (see ``Tree``)."""

    def run(batches):
        key, table, held = None, {}, []

        def flush():
            pairs = np.concatenate([p for *_, p, _ in held])
            unique, inverse = distinct(pairs)
            two = np.bincount(inverse, weights=np.concatenate([c for *_, c in held]), minlength=len(unique))
            shorter = unique // _SUFFIXES * 256 + unique % 256
            singles, of_single = distinct(shorter)
            one = np.bincount(of_single, weights=two)
            word = singles // 256
            none = np.bincount(word, weights=one, minlength=len(table))
            table_of_sums = np.concatenate(([[none.sum(), (none > 0).sum(), 0.0]], _sums(singles % 256, one, none[word], 256), _sums(unique % _SUFFIXES, two, one[of_single], _SUFFIXES)))
            alone = np.bincount(inverse) == 1
            counts = np.stack([none[unique // _SUFFIXES], one[of_single], two, alone]).astype(np.int64)
            number = np.empty(len(none), np.int64)
            number[np.argsort(-none, kind="stable")] = np.arange(len(none)) * n_buckets + key
            cuts = np.cumsum([len(p) for *_, p, _ in held])[:-1]
            sums = chain([pack(table_of_sums.reshape(-1))], repeat(b""))
            rows = (
                (key, block, n_pairs, starts, pack(number[words].astype(np.uint32)), pack(counts[:, at].reshape(-1)), int(none.max()), next(sums))
                for (block, n_pairs, starts, words, _, _), at in zip(held, np.split(inverse, cuts), strict=True)
            )
            yield from _batches(rows, _COUNTED)

        for batch in batches:
            for bucket, block, packed, n_pairs, starts, suffixes, train in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != key:
                    if held:
                        yield from flush()
                    key, table, held = bucket, _numbers(), []
                numbers = np.fromiter(map(table.__getitem__, _unpack_words(packed)), np.int64)
                pairs = np.repeat(numbers, unpack(n_pairs, np.uint32)) * _SUFFIXES + unpack(suffixes, np.uint16)
                held.append((block, n_pairs, starts, numbers, pairs, unpack(train, np.uint32)))
        if held:
            yield from flush()
        held.clear()
        give_back()

    return parts.repartition(F.col("bucket")).sortWithinPartitions("bucket", "block").mapInArrow(run, _kinds(_COUNTED))


# --- the tree


def _sums(state: np.ndarray, n: np.ndarray, n_parent: np.ndarray, size: int) -> np.ndarray:
    """By state: all its tokens, its different tokens, and the sum of ``n log(n / n_parent)``."""
    with np.errstate(divide="ignore", invalid="ignore"):
        terms = np.where(n > 0, n * (np.log(n) - np.log(n_parent)), 0.0)
    return np.stack([np.bincount(state, weights=w, minlength=size) for w in (n, n > 0, terms)], axis=1)


class Tree(NamedTuple):
    """Of the root, of suffixes of one byte, and of two: all tokens, different tokens; and which
    suffixes are states."""

    n_tokens: int
    n_types: int
    totals: tuple[np.ndarray, np.ndarray]
    types: tuple[np.ndarray, np.ndarray]
    states: tuple[np.ndarray, np.ndarray]

    def log_probabilities(self, suffix: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Base-10 logarithms for pairs, from the counts of their word, of it after the suffix's
        last byte, and after the suffix."""
        total = max(self.n_tokens + self.n_types, 1)
        p = np.where(counts[0] > 0, counts[0], max(self.n_types, 1)) / total
        for level, at in enumerate((suffix & 0xFF, suffix)):
            n, weight = self.totals[level][at], np.maximum(self.types[level][at], 1)
            p = np.where(self.states[level][at], (counts[level + 1] + weight * p) / (n + weight), p)
        return np.log10(p)


def grow_tree(sums: np.ndarray, gain: float = GAIN) -> Tree:
    """The tree from the sums over all buckets."""
    root, one, two = sums[0], sums[1:257], sums[257:]
    parents = (np.full(256, root[0]), one[:, 0][np.arange(_SUFFIXES) & 0xFF])
    states = []
    for (n, types, terms), parent in zip((one.T, two.T), parents, strict=True):
        with np.errstate(divide="ignore", invalid="ignore"):
            divergence = terms - n * (np.log(n) - np.log(parent))  # n times the Kullback-Leibler divergence
        states.append((n > 0) & (divergence >= gain * types))
    states[0] |= np.bincount(np.arange(_SUFFIXES) & 0xFF, weights=states[1], minlength=256) > 0
    return Tree(int(root[0]), int(root[1]), (one[:, 0], two[:, 0]), (one[:, 1], two[:, 1]), tuple(states))


def _all_sums(sums: DataFrame) -> np.ndarray:
    size = 1 + 256 + _SUFFIXES
    schema = pa.schema([("at", pa.int64()), ("n", pa.float64()), ("types", pa.float64()), ("terms", pa.float64())])

    def run(batches):
        total = np.zeros((size, 3))
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                total += unpack(packed, np.float64).reshape(size, 3)
        at = np.flatnonzero(total[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(total[at, k]) for k in range(3))], schema=schema)

    parts = sums.where("sums <> X''").mapInArrow(run, "at bigint, n double, types double, terms double")
    found = parts.groupBy("at").agg(*[F.sum(c).alias(c) for c in ("n", "types", "terms")]).toArrow()  # at most ``size`` rows
    out = np.zeros((size, 3))
    out[found["at"].to_numpy()] = np.stack([found[c].to_numpy() for c in ("n", "types", "terms")], axis=1)
    return out


# --- contexts of whole words

# What a block asks of a bucket (keys and their counts; of the keys' contexts the hashes, and by key the
# place among these; and the sums of pairs that it doesn't ask for), and what it's told. Rows with a state
# are for the block itself.
_ASKED = pa.schema([("bucket", pa.int64()), ("block", pa.string()), *((c, pa.binary()) for c in ("keys", "seen", "hashes", "context", "sums", "state"))])
_TOLD = pa.schema([("bucket", pa.int64()), ("block", pa.string()), ("totals", pa.binary()), ("largest", pa.int64()), ("hashes", pa.binary()), ("sums", pa.binary())])


def _extended(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of contexts with one more word."""
    x = context * _FOLD + word
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(27))


def hashes_of(numbers: np.ndarray) -> np.ndarray:
    """Different ones for different words, from their shared numbers."""
    return _extended(numbers.astype(np.uint64), np.uint64(0))


def _after(values: np.ndarray, first: np.ndarray, at_first) -> np.ndarray:
    """What stands one token earlier; ``at_first`` for a text's first token."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[first] = at_first
    return out


def _runs(values: np.ndarray):
    """Start and stop of each run of equal values."""
    cuts = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
    return zip(cuts, cuts[1:], strict=False) if len(values) else ()


def _bucket_of(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Buckets are ranges of hashes."""
    return ((keys >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)


def _sums_by(context: np.ndarray, total: np.ndarray, size: int) -> np.ndarray:
    """By context: all its tokens, its different tokens, and the sum of ``n log n``."""
    logs = total * np.log(np.maximum(total, 1))
    return np.stack([np.bincount(context, weights=x, minlength=size) for x in (total, total > 0, logs)]).astype(np.float64)


def _ask(block: str, first: int, n_buckets: int, asks: tuple[np.ndarray, ...], hashes: np.ndarray, sums: np.ndarray):
    """Rows that ask for the totals of keys (``asks``: keys, counts, contexts) from the bucket ``first`` on."""
    keys, seen, context = asks
    order = order_of(keys)
    keys, seen, context = keys[order], seen[order].astype(np.uint32), context[order]
    bucket = _bucket_of(keys, n_buckets)

    def rows():
        for start, stop in _runs(bucket):
            steps = np.diff(keys[start:stop], prepend=np.uint64(0))
            used, mine = distinct(context[start:stop])
            yield first + int(bucket[start]), block, pack(steps), pack(seen[start:stop]), pack(hashes[used]), pack(mine.astype(np.uint32)), b"", None
        none = pack(np.zeros(0, np.uint32))
        yield first, block, pack(np.zeros(0, np.uint64)), none, pack(hashes), none, pack(sums.reshape(-1)), None

    yield from _batches(rows(), _ASKED)


def _told(more, first: int, n_buckets: int, size: int, kind) -> np.ndarray:
    """What the buckets from ``first`` on say, in their order; zeros if they weren't asked."""
    parts = sorted((x["bucket"], x["totals"]) for x in more or [] if first <= x["bucket"] < first + n_buckets)
    return np.concatenate([unpack(t, kind) for _, t in parts]) if parts else np.zeros(size, kind)


class State(NamedTuple):
    """What a block has of a context length, for tokens after contexts that are tested across buckets.
    The texts' lengths and the hashes of the block's words. The tokens that are followed (a bit for
    each) and their pairs of context and token; of these pairs the token, the context, the pair one
    symbol shorter, and whether its total is asked; of these contexts hash and count. And of the
    shorter pairs: total, probability, and their context's count."""

    lengths: np.ndarray
    words: np.ndarray
    followed: np.ndarray
    pair: np.ndarray
    token: np.ndarray
    context: np.ndarray
    shorter: np.ndarray
    asked: np.ndarray
    hashes: np.ndarray
    n: np.ndarray
    total_before: np.ndarray
    p_before: np.ndarray
    n_before: np.ndarray


class Level(NamedTuple):
    """What a block knows of a context length: the positions of the tokens that are followed, their
    pairs and words; of the pairs whether only this block has them, their totals, probabilities, and
    their contexts' counts; and the hashes and counts of what a longer context can be (``symbol``
    numbers these by token)."""

    at: np.ndarray
    pair: np.ndarray
    word: np.ndarray
    whole: np.ndarray
    total: np.ndarray
    p: np.ndarray
    n: np.ndarray
    symbol: np.ndarray
    hashes: np.ndarray
    counts: np.ndarray


def scores_of(level: Level, lengths: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """By text, the sum of the logarithms of the followed tokens that are gone."""
    text = np.searchsorted(np.cumsum(lengths), level.at[gone], side="right")
    return np.bincount(text, weights=np.log10(level.p)[level.pair[gone]], minlength=len(lengths))


def contexts_of(level: Level, lengths: np.ndarray, n_texts: int) -> tuple[np.ndarray, ...]:
    """Hashes and counts of contexts, and the number of each followed token's context among them. The
    last but one is the mark before a text, the last stands for all that the level doesn't know."""
    first = np.zeros(int(lengths.sum()), bool)
    first[np.cumsum(lengths) - lengths] = True
    hashes, counts = np.concatenate((level.hashes, [_START, np.uint64(0)])), np.concatenate((level.counts, [n_texts, 0]))
    before = np.full(len(first), len(hashes) - 1)
    before[level.at] = level.symbol
    return hashes, counts, _after(before, first, len(hashes) - 2)[level.at]


def longer(level: Level, lengths: np.ndarray, score: np.ndarray | None, n_texts: int, least: int) -> dict:
    """The fields of ``State`` for contexts one word longer that are found ``least`` times, and the texts'
    scores (if given) with the other tokens'."""
    size = int(lengths.sum())
    hashes, counts, context = contexts_of(level, lengths, n_texts)
    kept = counts[context] >= least
    # In order of the shorter pairs, and so of tokens: both take little room in a state.
    mine, pair = distinct(level.pair[kept] * len(hashes) + context[kept])
    shorter, context_of = np.divmod(mine, len(hashes))
    token, used, referred = np.zeros(len(mine), np.int64), np.zeros(len(hashes), bool), np.zeros(len(level.p), bool)
    token[pair], used[context_of], referred[shorter] = level.word[kept], True, True
    followed = np.zeros(size, np.uint8)
    followed[level.at[kept]] = 1
    return {
        "score": score if score is None else score + scores_of(level, lengths, ~kept),
        "followed": np.packbits(followed),
        "pair": pair,
        "token": token,
        "context": (np.cumsum(used) - 1)[context_of],
        "shorter": (np.cumsum(referred) - 1)[shorter],
        "asked": ~level.whole[shorter],
        "hashes": hashes[used],
        "n": counts[used],
        "total_before": level.total[referred],
        "p_before": level.p[referred],
        "n_before": level.n[referred],
    }


def pack_state(state: State, train: np.ndarray) -> bytes:
    """A state, without words that none of its tokens is, and the training tokens of its block."""
    words, token = distinct(state.token)
    state = state._replace(words=state.words[words], token=token)
    return _coders()[0].compress(pickle.dumps((tuple(state), np.packbits(train))))


def unpack_state(packed: bytes) -> tuple[State, np.ndarray]:
    fields, train = pickle.loads(_coders()[1].decompress(packed))  # noqa: S301, made by ``pack_state``
    state = State(*fields)
    return state, np.unpackbits(train, count=int(state.lengths.sum())).astype(bool)


def keys_of(state: State) -> np.ndarray:
    return _extended(state.hashes[state.context], state.words[state.token])


def followed_of(state: State) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(state.followed, count=int(state.lengths.sum())))


def seen_of(state: State, train: np.ndarray) -> np.ndarray:
    """How often training texts of the block have its pairs."""
    return np.bincount(state.pair, weights=train[followed_of(state)], minlength=len(state.token))


def asks_of(state: State, train: np.ndarray) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """Keys, counts and contexts of the pairs that a block asks for: not those whose shorter pair is all
    its own. And by context the block's share of the test's sums: of the pairs it doesn't ask for,
    and of the context one symbol shorter."""
    asked, seen = state.asked.astype(bool), seen_of(state, train)
    sums = _sums_by(state.context[~asked], seen[~asked], len(state.hashes))
    shorter = np.log(np.maximum(state.total_before, 1)) - np.log(np.maximum(state.n_before, 1))
    sums[2] -= np.bincount(state.context, weights=seen * shorter[state.shorter], minlength=len(state.hashes))
    return (keys_of(state)[asked], seen[asked], state.context[asked]), sums


def totals_of(state: State, train: np.ndarray, told) -> tuple[np.ndarray, ...]:
    """Of the pairs: keys, totals, and whether only this block has them, with ``told(keys)`` for the
    totals it asked for."""
    seen, asked = seen_of(state, train), state.asked.astype(bool)
    keys, total, whole = keys_of(state), seen.astype(np.int64), np.ones(len(seen), bool)
    answers = told(keys[asked])
    total[asked], whole[asked] = answers >> 1, answers & 1
    return keys, total, whole


def level_of(state: State, train: np.ndarray, told, weight: np.ndarray) -> Level:
    """The contexts of a state with ``told(keys)`` for the totals it asked for, and the contexts' weights
    (their different tokens if they are states, else 0)."""
    keys, total, whole = totals_of(state, train, told)
    weight, n = weight[state.context], state.n[state.context].astype(np.int64)
    p = state.p_before[state.shorter]
    p = np.where(weight > 0, (total + weight * p) / np.maximum(n + weight, 1), p)
    return Level(followed_of(state), state.pair, state.token[state.pair], whole, total, p, n, state.pair, keys, total)


class Words(NamedTuple):
    """A block's texts as the deals need them: their lengths, the words' hashes, and by token its word
    and its word's shared number from 2 on. That number is a context's symbol (0: too rare, 1: the mark
    before a text, if it isn't). ``lines`` have the symbols of all texts, each after ``depth`` symbols for
    what lies before it, as a context's newest symbol and as an older one (0 as well if the next word is too
    rare after its last two bytes); ``place`` says where the tokens stand."""

    lengths: np.ndarray
    hashes: np.ndarray
    word: np.ndarray
    number: np.ndarray
    lines: tuple[np.ndarray, np.ndarray]
    place: np.ndarray

    def before(self, at: np.ndarray, n: int) -> np.ndarray:
        """The symbol ``n`` tokens before."""
        return self.lines[n > 1][self.place[at] - n]


def words_of(lengths: np.ndarray, hashes: np.ndarray, word: np.ndarray, number: np.ndarray, seen: np.ndarray, linked: np.ndarray, n_texts: int, depth: int, least: int) -> Words:
    """From the words' numbers and counts, and whether tokens are frequent after the last two bytes before."""
    place = np.arange(len(word)) + np.repeat(np.arange(1, len(lengths) + 1) * depth, lengths)
    line = np.zeros(len(word) + len(lengths) * depth, np.uint32)
    line[place] = np.where(seen >= least, number, 0)[word]
    if n_texts >= least:
        line[place[np.cumsum(lengths) - lengths] - 1] = 1
    older = line.copy()
    older[place - 1] *= linked
    return Words(lengths, hashes, word, number[word].astype(np.uint32), (line, older), place)


class Deal(NamedTuple):
    """Tokens whose contexts go to one bucket each, with all that is longer: their positions and pairs,
    in order of the contexts' hashes, and these."""

    at: np.ndarray
    pair: np.ndarray
    hashes: np.ndarray


def split(level: Level, words: Words, n_words: int, n_texts: int, least: int, most: int, share: tuple[int, ...] = ()) -> tuple[np.ndarray, Deal]:
    """Of the followed tokens, with contexts of ``n_words``: which go no further, and the deal (to the
    buckets from the first to the one before the last of so many, if ``share`` is given). The rest are those whose
    context is found more than ``most`` times. A context that the level doesn't know is not: it extends one that is rarer."""
    _, counts, context = contexts_of(level, words.lengths, n_texts if n_words == 1 else 0)
    oldest, seen = words.before(level.at, n_words), counts[context]
    gone = (oldest == 0) | (seen < least) & (context < len(counts) - 1)
    dealt = ~gone & (seen <= most)
    at, pair = level.at[dealt], level.pair[dealt]
    hashes = words.hashes[words.word[np.maximum(at - n_words, 0)]]
    hashes[oldest[dealt] == 1] = _START
    for n in range(n_words - 1, 0, -1):
        hashes = _extended(hashes, words.hashes[words.word[at - n]])
    if share:
        first, last, n_buckets = share
        bucket = _bucket_of(hashes, n_buckets)
        mine = (bucket >= first) & (bucket < last)
        at, pair, hashes = at[mine], pair[mine], hashes[mine]
    order = order_of(hashes)
    return gone, Deal(at[order], pair[order], hashes[order])


# Of a deal's tokens: which have a state (a bit for each), and of these what is added, and the share.
_SETTLED = pa.schema([("bucket", pa.int64()), ("block", pa.string()), ("totals", pa.binary()), ("values", pa.binary())])
_DEALT = pa.schema(
    [
        ("bucket", pa.int64()),
        ("block", pa.string()),
        ("contexts", pa.binary()),  # in order
        ("sizes", pa.binary()),  # tokens per context
        ("terms", pa.binary()),  # per context, the sum over training tokens
        ("train", pa.binary()),  # per token
        ("symbols", pa.binary()),  # its number, and what stands before its context
    ]
)


def send(block: str, first: int, n_buckets: int, deal: Deal, level: Level, words: Words, train: np.ndarray, n_words: int, depth: int):
    """The rows of a deal; ``first`` is its first bucket."""
    (at, pair, keys), bucket = deal, _bucket_of(deal.hashes, n_buckets)
    trained = train[at]
    symbols = np.empty((depth - n_words + 1, len(at)), np.uint32)
    symbols[0] = words.number[at]
    for k, n in enumerate(range(n_words + 1, depth + 1), 1):
        symbols[k] = words.before(at, n)
        if k > 1:
            symbols[k][symbols[k - 1] == 0] = 0
    terms = np.where(trained, (np.log(np.maximum(level.total, 1)) - np.log(np.maximum(level.n, 1)))[pair], 0.0)

    def rows():
        for start, stop in _runs(bucket):
            mine = keys[start:stop]
            heads = np.flatnonzero(np.concatenate(([True], mine[1:] > mine[:-1])))
            yield (
                first + int(bucket[start]),
                block,
                pack(np.diff(mine[heads], prepend=np.uint64(0))),
                pack(np.diff(heads, append=len(mine)).astype(np.uint32)),
                pack(np.add.reduceat(terms[start:stop], heads)),
                pack(np.packbits(trained[start:stop])),
                pack(np.ascontiguousarray(symbols[:, start:stop]).reshape(-1)),
            )

    yield from _batches(rows(), _DEALT)


def _joint(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``distinct`` of the pairs of ``a`` and ``b``, but with the pairs' ``a`` for their keys."""
    if len(a) and int(a.max() + 1).bit_length() + int(b.max() + 1).bit_length() + len(a).bit_length() > 63:
        b = distinct(b)[1]
    size = int(b.max()) + 1 if len(b) else 1
    keys, inverse = distinct(a * size + b)
    return keys // size, inverse


def probabilities(context: np.ndarray, terms: np.ndarray, token: np.ndarray, older: np.ndarray, train: np.ndarray, gain: float, least: int) -> np.ndarray:
    """Of tokens of a bucket, the probabilities after the longest states: a share of the probability
    one symbol before the bucket's contexts (second row, 1 if there is no state), and what is added to it
    (first row). All contexts with all their tokens are here. ``terms``: by context, the sum over training tokens of the logarithm of their share
    in the context one symbol shorter; ``older``: the symbols before the context, a row a step."""
    out, at, n_token = np.stack([np.zeros(len(token)), np.ones(len(token))]), np.arange(len(token)), distinct(token)[1]
    weights = train.astype(np.float64)
    for step in range(len(older) + 1):
        count = np.bincount(context, weights=weights[at], minlength=len(terms))
        enough = count[context] >= least
        if not enough.all():
            at, context = at[enough], context[enough]
        if not len(at):
            break
        of, pair = _joint(context, n_token[at])
        total = np.bincount(pair, weights=weights[at])
        with np.errstate(divide="ignore", invalid="ignore"):
            share = np.where(total > 0, np.log(total) - np.log(count[of]), 0.0)
        types = np.bincount(of, weights=total > 0, minlength=len(terms))
        divergence = np.bincount(of, weights=total * share, minlength=len(terms)) - terms
        weight = np.where(divergence >= gain * np.maximum(types, 1), types, 0.0)
        state = weight[context] > 0
        here, w = at[state], weight[context[state]]
        for row, n in zip(out, (total[pair[state]], 0.0), strict=True):
            row[here] = (n + w * row[here]) / (count[context[state]] + w)
        if step == len(older):
            break
        symbol = older[step][at]
        kept = symbol > 0
        at, share = at[kept], share[pair[kept]]
        _, context = _joint(context[kept], symbol[kept].astype(np.int64))
        terms = np.bincount(context, weights=share * weights[at])
    return out


def tally(asked: DataFrame) -> DataFrame:
    """The totals of what blocks ask for: counts, doubled, plus one if just one block has the key. And, in
    rows of no block, a bucket's sums for the tests of the contexts."""

    def run(batches):
        key, held = None, []

        def flush():
            keys = np.concatenate([x[1] for x in held])
            order = np.argsort(keys, kind="stable")  # each block's keys are in order
            new = np.diff(keys[order], prepend=~keys[order[:1]]) != 0
            inverse = np.empty(len(keys), np.int64)
            inverse[order] = np.cumsum(new) - 1
            total = np.bincount(inverse, weights=np.concatenate([x[2] for x in held]))
            unique, names = np.unique(np.concatenate([x[3] for x in held]), return_inverse=True)
            cuts = np.cumsum([len(x[3]) for x in held])[:-1]
            named = np.split(names, cuts)
            context = np.concatenate([names[x[4]] for x, names in zip(held, named, strict=True)])[order[new]]
            sums = _sums_by(context, total, len(unique))
            for (*_, mine), names in zip(held, named, strict=True):
                if mine is not None:
                    sums[:, names] += mine
            yield _rows([(key, None, None, int(total.max()) if len(total) else 0, pack(unique), pack(sums.reshape(-1)))], _TOLD)
            out = (total * 2 + (np.bincount(inverse) == 1)).astype(np.int64)
            answers = zip(held, np.split(inverse, np.cumsum([len(x[1]) for x in held])[:-1]), strict=True)
            yield from _batches(((key, x[0], pack(out[at]), 0, None, None) for x, at in answers if len(at)), _TOLD)

        for batch in batches:
            for bucket, block, *packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != key:
                    if held:
                        yield from flush()
                    key, held = bucket, []
                keys, seen, hashes, context = (unpack(x, k) for x, k in zip(packed, ("u8", "u4", "u8", "u4"), strict=False))
                held.append((block, np.cumsum(keys), seen, hashes, context, unpack(packed[4], np.float64).reshape(3, -1) if packed[4] else None))
        if held:
            yield from flush()
        held.clear()
        give_back()

    return asked.repartition(F.col("bucket")).sortWithinPartitions("bucket", "block").mapInArrow(run, _kinds(_TOLD))


def states_of(told: DataFrame, gain: float) -> tuple[tuple[np.ndarray, np.ndarray], float]:
    """Of the contexts that are tested across buckets: the hashes of those that are states, in order, and
    their different tokens; and how many training tokens all of them have. They have so many each that they are few."""
    schema = pa.schema([("hash", pa.int64()), *((c, pa.float64()) for c in ("n", "types", "terms"))])

    def run(batches):
        for batch in batches:
            for hashes, sums in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                columns = (unpack(hashes, np.int64), *unpack(sums, np.float64).reshape(3, -1))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    rows = told.where("block IS NULL").select("hashes", "sums").mapInArrow(run, _kinds(schema))
    sums = rows.groupBy("hash").agg(*[F.sum(c).alias(c) for c in ("n", "types", "terms")])
    state = F.coalesce(F.col("terms") - F.col("n") * F.log("n") >= gain * F.greatest("types", F.lit(1.0)), F.lit(False))
    found = sums.select("hash", "n", "types", state.alias("state")).toArrow()
    total, found = float(found["n"].to_numpy().sum()), found.filter(found["state"])
    hashes, types = found["hash"].to_numpy().view(np.uint64), np.rint(found["types"].to_numpy())
    order = np.argsort(hashes)
    return (hashes[order], types[order]), total


def weights_of(hashes: np.ndarray, states: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """By context, its different tokens if it is a state, else 0."""
    if not len(states[0]):
        return np.zeros(len(hashes))
    at = np.minimum(np.searchsorted(states[0], hashes), len(states[0]) - 1)
    return np.where(states[0][at] == hashes, states[1][at], 0.0)


def settle(dealt: DataFrame, gain: float, least: int, piece: int) -> DataFrame:
    """The probabilities of the tokens that were dealt, in the order they came in. A bucket's contexts are
    settled in pieces of ``piece`` tokens, or of one context."""

    def run(batches):
        key, held = None, []

        def flush():
            contexts, sizes, terms, train, symbols = ([x[k] for x in held] for k in range(1, 6))
            hashes = np.concatenate(contexts)
            order = order_of(hashes)
            number = np.empty(len(hashes), np.int64)
            number[order] = np.cumsum(np.diff(hashes[order], prepend=hashes[order[:1]]) != 0)
            sums = np.bincount(number, weights=np.concatenate(terms))
            upto = np.cumsum(np.bincount(number, weights=np.concatenate(sizes))).astype(np.int64)
            firsts = np.append(np.flatnonzero(np.diff(np.concatenate(([0], upto[:-1])) // piece, prepend=-1)), len(upto))
            numbers = np.split(number, np.cumsum([len(x) for x in contexts])[:-1])
            heads = [np.searchsorted(x, firsts) for x in numbers]  # each row's contexts are in order
            stops = [np.concatenate(([0], np.cumsum(x, dtype=np.int64)))[h] for x, h in zip(sizes, heads, strict=True)]
            out = [([], []) for _ in held]
            for k, (first, last) in enumerate(pairwise(firsts.tolist())):
                rows = [i for i, x in enumerate(heads) if x[k] < x[k + 1]]
                at = [slice(stops[i][k], stops[i][k + 1]) for i in rows]
                mine = np.concatenate([np.repeat(numbers[i][(x := slice(heads[i][k], heads[i][k + 1]))] - first, sizes[i][x]) for i in rows])
                tokens = np.concatenate([symbols[i][:, x] for i, x in zip(rows, at, strict=True)], axis=1)
                weights = np.concatenate([train[i][x] for i, x in zip(rows, at, strict=True)])
                found = probabilities(mine, sums[first:last], tokens[0].astype(np.int64), tokens[1:], weights, gain, least)
                changed = found[1] < 1
                found[0] -= found[0] > 0.5  # single precision is finer near 0
                found = found.astype(np.float32)
                start = 0
                for i, x in zip(rows, at, strict=True):
                    part = slice(start, start := start + x.stop - x.start)
                    out[i][0].append(changed[part])
                    out[i][1].append(found[:, part][:, changed[part]])
            answers = ((key, x[0], pack(np.packbits(np.concatenate(c))), pack(np.concatenate(v, axis=1).reshape(-1))) for x, (c, v) in zip(held, out, strict=True))
            yield from _batches(answers, _SETTLED)

        for batch in batches:
            for bucket, block, *packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != key:
                    if held:
                        yield from flush()
                    key, held = bucket, []
                contexts, sizes, terms, train, symbols = (unpack(x, k) for x, k in zip(packed, ("u8", "u4", "f8", "u1", "u4"), strict=True))
                n = int(sizes.sum())
                held.append((block, np.cumsum(contexts), sizes, terms, np.unpackbits(train, count=n), symbols.reshape(-1, n)))
        if held:
            yield from flush()
        held.clear()
        give_back()

    return dealt.repartition(F.col("bucket")).sortWithinPartitions("bucket", "block").mapInArrow(run, _kinds(_SETTLED))


def settled(more, first: int, hashes: np.ndarray, n_buckets: int, p: np.ndarray) -> np.ndarray:
    """The probabilities of a deal's tokens, from those one symbol shorter."""
    parts = {x["bucket"]: x for x in more or []}
    bucket, out = _bucket_of(hashes, n_buckets), p.copy()
    for start, stop in _runs(bucket):
        x = parts[first + int(bucket[start])]
        changed = start + np.flatnonzero(np.unpackbits(unpack(x["totals"], np.uint8), count=stop - start))
        added, share = unpack(x["values"], np.float32).astype(np.float64).reshape(2, -1)
        out[changed] = (added + (added < 0)) + share * p[changed]
    return out


class _Tables:
    """Tables of blocks, bucketed by block, so that a block never travels, shuffle files removed
    with the job that wrote them, and few blocks sent to a Python worker at once."""

    _SET = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}

    def __init__(self, spark):
        self.spark, self.names = spark, {}
        self.n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def __enter__(self):
        self.before = {k: self.spark.conf.get(k, None) for k in self._SET}
        for k, v in self._SET.items():
            self.spark.conf.set(k, v)
        return self

    def __exit__(self, *_):
        for k, v in self.before.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)
        for name in list(self.names):
            self.drop(name)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        table = f"{name}_{uuid.uuid4().hex}"
        path = scratch_path(self.spark, name)
        writer = df.write.bucketBy(self.n, "block").option("path", path).option("compression", "zstd")
        (writer.partitionBy("part") if "part" in df.columns else writer).saveAsTable(table)
        self.names[name] = (table, path)
        return self.spark.table(table)

    def drop_part(self, name: str, part: int) -> None:
        drop_folder(self.spark, f"{self.names[name][1]}/part={part}")

    def drop(self, name: str) -> None:
        table, path = self.names.pop(name)
        self.spark.sql(f"DROP TABLE {table}")
        drop_folder(self.spark, path)


# --- scores

_SCORED = pa.schema(
    [
        ("id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("train_tokens", pa.int64()),
        ("base_score", pa.float64()),
        ("score", pa.float64()),
    ]
)


def score_documents(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    gain: float = GAIN,
    rule: tuple[int, int] = HELD_OUT,
    bucket_pairs: int = BUCKET_PAIRS,
    depth: int = 0,
    least: int = LEAST,
) -> DataFrame:
    """Per row ``id, held_out, n_tokens, n_known, train_tokens, base_score, score``. ``depth``: how
    many whole words the contexts reach back, beyond the previous word's last two bytes."""
    with _Tables(documents.sparkSession) as tables:
        return _score(documents, id_col, text_col, gain, rule, bucket_pairs, depth, least, tables)


def _score(documents, id_col, text_col, gain, rule, bucket_pairs, depth, least, tables) -> DataFrame:
    spark = documents.sparkSession
    docs = documents.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    blocks = tables.write(blocks_of(docs, rule), "blocks")
    dictionaries, blocks = (blocks.where(F.col("part") == k).drop("part") for k in (1, 0))
    size = blocks.agg(F.sum("size").alias("pairs"), F.sum("n_tokens").alias("tokens")).first()
    n_buckets = int(max(1, -(-(size["pairs"] or 0) // bucket_pairs)))
    n_tokens, most = size["tokens"] or 0, bucket_pairs // 2

    def buckets_for(n):
        """The buckets of a deal of so many tokens."""
        return int(max(1, -(-2 * n // (PIECES * bucket_pairs))))

    counted = count_words(deal_words(dictionaries, n_buckets), n_buckets)
    found = counted.groupBy("block").agg(F.collect_list(F.struct("n_pairs", "starts", "numbers", "counts", "sums")).alias("found"), F.max("largest").alias("largest"))
    found = tables.write(found, "found")
    tables.drop_part("blocks", 1)
    tree = grow_tree(_all_sums(found.select(F.explode("found.sums").alias("sums"))), gain)
    shared = spark.sparkContext.broadcast(tree)
    n_texts = int(tree.totals[1][MARK << 8 | MARK])  # training texts
    told, tables_told, states, deals = [], [], [], [buckets_for(n_tokens)]  # of ``deals`` one more than rounds

    def rows_of(shares=1, share=0):
        """Blocks with their counts and what they have been told; all, or a share of them."""
        chosen = F.pmod(F.crc32(F.col("block").cast("binary")), F.lit(shares)) == share
        columns = ["block", "ids", "lengths", "tokens", "n_pairs", "suffixes", "size"]
        mine = blocks.where(chosen).join(found.hint("shuffle_hash"), "block").select(*columns, F.transform("found", lambda x: x.dropFields("sums")).alias("found"))
        if not told:
            return mine
        more = reduce(DataFrame.union, told).where(chosen).groupBy("block").agg(F.collect_list(F.struct("bucket", "totals", "values")).alias("more"))
        return mine.join(more.hint("shuffle_hash"), "block", "left")

    def shallow(row):
        """Of a block: its texts' lengths, the tokens' pairs, by pair suffix, counts and score, and by
        pair the number of its word (where the word's first pair is)."""
        _, packed, tokens, _, suffixes, size, parts = row[1:8]
        model: Tree = shared.value
        counts, number = np.zeros((4, size), np.int64), np.zeros(size, np.int64)
        for x in parts:
            starts = unpack(x["starts"], np.uint32).astype(np.int64)
            counts[:, _places(starts, unpack(x["n_pairs"], np.uint32).astype(np.int64))] = unpack(x["counts"], np.int64).reshape(4, -1)
            number[starts] = unpack(x["numbers"], np.uint32)
        suffix, at, lengths = unpack(suffixes, np.uint16).astype(np.int64), unpack(tokens, np.uint32).astype(np.int64), unpack(packed, np.uint32).astype(np.int64)
        return lengths, at, suffix, counts, model.log_probabilities(suffix, counts), number

    def of_texts(lengths, at, *values):
        """By text, the sums of what its tokens' pairs have."""
        doc = np.repeat(np.arange(len(lengths)), lengths)
        return [np.bincount(doc, weights=x[at], minlength=len(lengths)) for x in values]

    def known_and_base(lengths, at, seen):
        model: Tree = shared.value
        return of_texts(lengths, at, seen > 0, np.log10((seen + 1) / (model.n_tokens + model.n_types + 1)))

    def trained(ids, lengths):
        return np.repeat([not held_out(i, rule) for i in ids], lengths)

    def scored(ids, lengths, known, base, score):
        out = [ids, [held_out(i, rule) for i in ids], lengths, known.astype(np.int64), np.full(len(ids), shared.value.n_tokens), base, score]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _SCORED, strict=True)], schema=_SCORED)

    def each(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield tuple(c.to_pylist()[0] for c in batch.slice(i, 1).columns)
        give_back()  # a block's arrays are large, and workers live on

    def levels(row, rounds, deals=True):
        """A block level by level, for so many rounds and the deal after them: its texts' lengths, words (for
        the deals), training tokens, the level, its contexts' greatest count in a deal, and the state of the
        tokens after the rest. After the rounds no context has more, but for those that only this block has."""
        lengths, at, suffix, counts, scores, number = shallow(row)
        of_word, train = unpack(row[4], np.uint32).astype(np.int64), trained(row[1], lengths)
        starts = np.cumsum(of_word) - of_word
        number, seen, word = number[starts] + 2, counts[0][starts], np.repeat(np.arange(len(starts)), of_word)[at]
        hashes = hashes_of(number)
        words = words_of(lengths, hashes, word, number, seen, (counts[2] >= least)[at], n_texts, depth, least) if deals else None
        n = shared.value.totals[1].astype(np.int64)[suffix]
        level = Level(np.arange(len(at)), at, word, counts[3].astype(bool), counts[2].copy(), 10.0**scores, n, word, hashes, seen.copy())
        del at, suffix, counts, scores, number, of_word, starts, seen, word, n
        for k in range(rounds):
            state = state_of(level, lengths, hashes, k)
            yield lengths, words, train, level, most, state
            if not len(state.pair):
                return
            level = level_after(state, train, row[8], k)
        yield lengths, words, train, level, _ALL, None

    def state_of(level, lengths, hashes, k):
        """The state of the tokens whose contexts of ``k + 1`` words are found more often than a bucket takes."""
        fields = longer(level, lengths, None, n_texts if k == 0 else 0, max(most + 1, least))
        return State(lengths=lengths, words=hashes, **{f: fields[f] for f in State._fields if f in fields})

    def level_after(state, train, more, k):
        """The level of these tokens, with what the block was told in round ``k``."""

        def answers(keys):
            out = np.empty(len(keys), np.int64)
            out[order_of(keys)] = _told(more, k * n_buckets, n_buckets, len(keys), np.int64)
            return out

        return level_of(state, train, answers, weights_of(state.hashes, states[k].value))

    def first_of(k):
        """The first bucket of the deal of contexts of ``k + 1`` words."""
        return depth * n_buckets + sum(deals[:k])

    if not depth:
        plain = rows_of().mapInArrow(lambda batches: (scored(r[1], n, *known_and_base(n, a, c[0]), *of_texts(n, a, s)) for r in each(batches) for n, a, _, c, s, _ in [shallow(r)]), _kinds(_SCORED))
        return materialise(plain, "scores")

    def ask(k):
        """What blocks ask for the pairs of the contexts of ``k + 1`` words that are found more often than a bucket
        takes; and from the second round on their states. From the third on that is all they are made of."""

        def run(batches):
            for row in each(batches):
                if k < 2:
                    found = ((x[5], x[2]) for x in islice(levels(row, k + 1, False), k, k + 1))
                else:
                    state, train = unpack_state(row[1])
                    found = [(state_of(level_after(state, train, row[2], k - 1), state.lengths, state.words, k), train)]
                for state, train in found:
                    if len(state.pair):
                        asks, sums = asks_of(state, train)
                        yield from _ask(row[0], k * n_buckets, n_buckets, asks, state.hashes, sums)
                        if k:
                            yield _rows([(None, row[0], *[None] * 5, pack_state(state, train))], _ASKED)

        return run

    def deal_out(share):
        def run(batches):
            for row in each(batches):
                for k, (_, words, train, level, up_to, _) in enumerate(islice(levels(row, rounds), depth)):
                    _, deal = split(level, words, k + 1, n_texts, least, up_to, (deals[k] * share // SHARES, deals[k] * (share + 1) // SHARES, deals[k]))
                    yield from send(row[0], first_of(k), deals[k], deal, level, words, train, k + 1, depth)
                    del words, train, level, deal

        return run

    def finish(batches):
        yield from map(finished, each(batches))

    def finished(row):
        score = 0.0
        for k, (lengths, words, _, level, up_to, _) in enumerate(levels(row, rounds)):
            if k == 0:  # a word's count is that of the context it is
                fields = known_and_base(lengths, level.symbol, level.counts)
            gone = np.ones(len(level.at), bool)
            if k < depth:
                gone, deal = split(level, words, k + 1, n_texts, least, up_to)
                p = settled(row[8], first_of(k), deal.hashes, deals[k], level.p[deal.pair])
                text = np.repeat(np.arange(len(lengths)), lengths)[deal.at]
                score += np.bincount(text, weights=np.log10(p), minlength=len(lengths))
                del deal, p, text
            score += scores_of(level, lengths, gone)
            del gone, level, words
        return scored(row[1], lengths, *fields, score)

    rounds, largest, asked = 0, max(n_texts, found.agg(F.max("largest")).first()[0] or 0), None
    while rounds < depth and largest > most:
        if rounds < 2:
            rows = rows_of()
        else:
            more = told[-1].groupBy("block").agg(F.collect_list(F.struct("bucket", "totals")).alias("more"))
            rows = asked.where("state IS NOT NULL").select("block", "state").join(more, "block", "left")
        last, asked = asked, rows.mapInArrow(ask(rounds), _kinds(_ASKED))
        if rounds:
            asked = materialise(asked, "asked")
        if rounds > 1:
            drop_table(last)
        totals = materialise(tally(asked.where("state IS NULL").drop("state")), "totals")
        found_states, followed = states_of(totals, gain)
        states.append(spark.sparkContext.broadcast(found_states))
        deals.append(buckets_for(followed * n_tokens / max(tree.n_tokens, 1)))  # held-out tokens are dealt too
        largest = totals.agg(F.max("largest")).first()[0] or 0
        tables_told.append(totals)
        told.append(totals.where("block IS NOT NULL").select("bucket", "block", "totals", F.lit(None).cast("binary").alias("values")))
        rounds += 1
    if rounds > 1:
        drop_table(asked)
    answers = [materialise(settle(rows_of().mapInArrow(deal_out(k), _kinds(_DEALT)), gain, least, max(1, bucket_pairs // 4)), "settled") for k in range(SHARES)]
    told += answers
    parts = [materialise(rows_of(SHARES, k).mapInArrow(finish, _kinds(_SCORED)), "scores") for k in range(SHARES)]
    for table in tables_told + answers:
        drop_table(table)
    return reduce(DataFrame.union, parts)
