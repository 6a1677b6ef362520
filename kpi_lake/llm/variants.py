"""Spelling variant grouping by a trie over letter-group counts.

1. Counting: words are counted inside a task first, then by word (one row a word and task).
2. Vectors: a word is its length and, for each of ``GROUPS`` groups of letters (code point modulo
   ``GROUPS``), the number of its letters in the group. Inserting a letter raises one count by one,
   deleting lowers one, replacing does both or, within a group, neither. A trie holds the words by
   successive entries of their vectors.
3. The trie's upper part: nodes with more words than a task's share are found level by level from
   counts by prefix; there are at most ``MOST_NODES`` of them on a level, whatever the vocabulary.
   Nodes below them are dealt to tasks, each with its words, and with every word that a descent
   through the upper part leads there. A word may spend one surplus and one deficit on the way, so
   it goes to a few nodes only.
4. In a task the descent goes on depth-first through the node's own trie, with all words that ask
   still carrying their budgets, and drops those that can't pay. A pair is looked for from one side
   only: from the shorter word, and among words of one length from the one whose vector is smaller
   where they first differ; so the surplus is spent before the deficit.
5. The words of a leaf that is reached are verified letter by letter.

Counts are clamped (lengths at 255, groups at 15): clamping can only make two entries equal, so no
pair is lost. Words that share their whole vector beyond a task's share are dealt on by hash, and
those that ask go to all of the parts.

A word's form is its near word of largest count, if that count is ``ratio`` times its own or more.
Forms grow by that ratio, so the last form is reached by a few rounds of pointer doubling.

Defined cases: null texts have no words; a null id counts as an empty one where ids are hashed;
equal counts give the form that is smallest in code-point order; repeated rows count each; an empty
table, or one without frequent words, gives no rows; other columns are ignored, whatever their
names; words may be of any length.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpi_lake.llm.common import materialise, slices, utf8_column

#: Letter groups, and so levels of the trie below the one of lengths.
GROUPS = 16
#: Words of one node that a task holds, and the most nodes of a level that are split; the first
#: grows with the vocabulary if the second is reached.
SHARE, MOST_NODES = 2048, 10_000
#: Distinct words that a counting task holds before it hands them on.
HELD_WORDS = 400_000
#: Words that ask at a time, pairs that are verified at a time, longest word verified in a matrix.
ASKED, VERIFIED, WIDE = 100_000, 20_000, 64
_LEVELS, _DEALT = 1 + GROUPS, 4  # entries of a vector; levels that deal by hash
# Fixed value: the letters, A-Z lower-cased, one byte a code point below 256; all else separates.
LETTERS = bytes(c if 97 <= c <= 122 or c >= 0xC0 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def count_words(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, least_count: int = 5, typo_every: int = 0
) -> DataFrame:
    """``word, n`` of the lower-cased letter runs of all texts with at least ``least_length`` code
    points and ``least_count`` occurrences. With ``typo_every`` a run of a document loses a letter
    where that number divides its hash ``h``, the CRC-32 of ``id:run``: the one at ``h`` modulo the
    run's length."""

    def count(batches):
        held: Counter = Counter()
        for batch in batches:
            for part in slices([batch]):
                for doc, raw in zip(part.column(0).to_pylist(), utf8_column(part.column(1)), strict=True):
                    runs = Counter(raw.decode("utf-8", "replace").encode("latin-1", "replace").translate(LETTERS).split())
                    seed = zlib.crc32(b"%s:" % (b"" if doc is None else str(doc).encode()))
                    for run, n in runs.items():
                        if typo_every:
                            h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
                            if h % typo_every == 0:
                                cut = h % len(run)
                                run = run[:cut] + run[cut + 1 :]
                        if len(run) >= least_length:
                            held[run] += n
            if len(held) > HELD_WORDS:
                yield rows(held)
                held = Counter()
        yield rows(held)

    def rows(held):
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    docs = documents.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    counted = docs.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


def vectors(words: list[str]) -> np.ndarray:
    """A row per word: clamped length, clamped counts of the letter groups, hash digits."""
    raw = [w.encode("utf-32-le") for w in words]
    lengths = np.array([len(r) // 4 for r in raw], np.int64)
    codes = np.frombuffer(b"".join(raw), "<u4").astype(np.int64)
    owner = np.repeat(np.arange(len(words)), lengths)
    counts = np.bincount(owner * GROUPS + codes % GROUPS, minlength=len(words) * GROUPS).reshape(-1, GROUPS)
    found = np.empty((len(words), _LEVELS + _DEALT), np.uint8)
    found[:, 0] = np.minimum(lengths, 255)
    found[:, 1:_LEVELS] = np.minimum(counts, 15)
    hashes = np.array([zlib.crc32(r) for r in raw], np.uint32)
    for k in range(_DEALT):
        found[:, _LEVELS + k] = hashes >> np.uint32(4 * k) & np.uint32(15)
    return found


#: What a descent may still spend: nothing spent yet; one deficit; one surplus; nothing.
_FRESH, _DEFICIT, _SURPLUS, _NOTHING = range(4)
#: The state after a step of -1, 0 or 1 (stored minus asked) at a letter group; -1: over.
_STEP = np.array([[-1, _FRESH, _DEFICIT], [_NOTHING, _DEFICIT, -1], [-1, _SURPLUS, _NOTHING], [-1, _NOTHING, -1]], np.int8)


def routes(vector: bytes, split: set[bytes]) -> list[bytes]:
    """The nodes below the split ones where near words of this vector may be, its own among them."""
    found, open_ = [], [(b"", _FRESH)]
    while open_:
        node, state = open_.pop()
        if node not in split:
            found.append(node)
            continue
        level = len(node)
        own = vector[level]
        if level >= _LEVELS:
            open_ += [(node + bytes([digit]), state) for digit in range(16)]
        elif level == 0:
            open_.append((bytes([own]), _FRESH))
            if own < 255:
                open_.append((bytes([own + 1]), _SURPLUS))
        else:
            for step in (-1, 0, 1):
                after = int(_STEP[state, step + 1])
                if after >= 0 and 0 <= own + step <= 15:
                    open_.append((node + bytes([own + step]), after))
    return found


class LowerTrie:
    """The trie of one node's words, as their vectors in order: a subtree is a range of rows."""

    def __init__(self, stored: np.ndarray):
        self.order = np.lexsort(stored[:, _LEVELS - 1 :: -1].T)
        self.rows = np.ascontiguousarray(stored[self.order, :_LEVELS]).astype(np.int16)

    def search(self, asked: np.ndarray):
        """Yields pairs of arrays: places in ``asked``, and stored words whose leaf each reached."""
        rows, asked = self.rows, asked[:, :_LEVELS].astype(np.int16)
        todo = [(0, len(rows), 0, np.arange(len(asked)), np.full(len(asked), _FRESH, np.int8))]
        while todo:
            low, high, level, who, states = todo.pop()
            if high - low == 1 and level:  # one word left: all levels at once
                who = self._last(rows[low, level:], asked[who, level:], who, states)
                if len(who):
                    yield who, np.full(len(who), self.order[low])
                continue
            if level == _LEVELS:
                yield np.repeat(who, high - low), np.tile(self.order[low:high], len(who))
                continue
            column = rows[low:high, level]
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(column)) + 1, [high - low])).tolist()
            mine = asked[who, level]
            for a, b in zip(cuts, cuts[1:], strict=False):
                step = column[a] - mine
                if level == 0:
                    near = (step == 0) | (step == 1)
                    after = np.where(step == 1, _SURPLUS, _FRESH).astype(np.int8)
                else:
                    near = (step >= -1) & (step <= 1)
                    after = _STEP[states, np.clip(step, -1, 1) + 1]
                    near &= after >= 0
                keep = np.flatnonzero(near)
                if len(keep):
                    todo.append((low + a, low + b, level + 1, who[keep], after[keep]))

    @staticmethod
    def _last(row: np.ndarray, asked: np.ndarray, who: np.ndarray, states: np.ndarray) -> np.ndarray:
        step = row - asked
        more, less = step > 0, step < 0
        spent = np.abs(step).max(axis=1, initial=0) <= 1
        n_more, n_less = more.sum(axis=1), less.sum(axis=1)
        first_more = np.where(n_more > 0, more.argmax(axis=1), 99)
        first_less = np.where(n_less > 0, less.argmax(axis=1), 99)
        fresh = (states == _FRESH) & (n_more <= 1) & (n_less <= n_more) & (first_more <= first_less)
        deficit = (states == _DEFICIT) & (n_more == 0) & (n_less <= 1)
        surplus = (states == _SURPLUS) & (n_less == 0) & (n_more <= 1)
        nothing = (states == _NOTHING) & (n_more + n_less == 0)
        return who[spent & (fresh | deficit | surplus | nothing)]


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    low, high = 0, len(a)  # the longest common start, by halving
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return a[low + (len(a) == len(b)) :] == b[low + 1 :]


class Letters:
    """Words as rows of code points (plus one, so that zero pads), for verification."""

    def __init__(self, words: list[str]):
        self.words = words
        self.lengths = np.array([len(w) for w in words], np.int64)
        short = [w if len(w) <= WIDE else "" for w in words]
        width = max(map(len, short), default=0)
        codes = np.zeros((len(words), width + 1), np.uint32)
        flat = np.frombuffer("".join(short).encode("utf-32-le"), "<u4")
        sizes = np.array([len(w) for w in short], np.int64)
        codes[np.arange(width + 1) < sizes[:, None]] = flat + 1
        self.codes = codes

    def wider(self, width: int) -> np.ndarray:
        return np.pad(self.codes, ((0, 0), (0, width - self.codes.shape[1])))


def verify(asked: Letters, stored: Letters, pairs_a: np.ndarray, pairs_b: np.ndarray) -> np.ndarray:
    """Which of the pairs are one edit apart."""
    la, lb = asked.lengths[pairs_a], stored.lengths[pairs_b]
    near = np.zeros(len(pairs_a), bool)
    slow = np.flatnonzero((np.maximum(la, lb) > WIDE) & (np.abs(la - lb) <= 1))
    near[slow] = [one_edit(asked.words[a], stored.words[b]) for a, b in zip(pairs_a[slow].tolist(), pairs_b[slow].tolist(), strict=True)]
    width = max(asked.codes.shape[1], stored.codes.shape[1])
    table_a, table_b = asked.wider(width), stored.wider(width)
    fast = np.flatnonzero((np.maximum(la, lb) <= WIDE) & (lb - la <= 1) & (lb >= la))
    for start in range(0, len(fast), VERIFIED):
        at = fast[start : start + VERIFIED]
        a, b = table_a[pairs_a[at]], table_b[pairs_b[at]]
        differ = a != b
        replaced = (la[at] == lb[at]) & (differ.sum(axis=1) == 1)
        first = differ.argmax(axis=1)
        moved = a[:, :-1] != b[:, 1:]
        last = np.where(moved.any(axis=1), moved.shape[1] - 1 - moved[:, ::-1].argmax(axis=1), -1)
        near[at] = replaced | ((lb[at] == la[at] + 1) & (last < first))
    return near


def split_nodes(keyed: DataFrame, total: int, share: int = SHARE) -> set[bytes]:
    """The nodes with more words than a task's share, level by level. A level has fewer than
    ``MOST_NODES`` of them, because the share grows with the vocabulary."""
    share = max(share, total // MOST_NODES)
    if total <= share:
        return set()
    spark = keyed.sparkSession
    found, above = {b""}, [b""]
    for level in range(1, _LEVELS + _DEALT + 1):
        parents = spark.createDataFrame(pa.table({"parent": pa.array(above, pa.binary())}))
        prefix = F.expr(f"substring(vector, 1, {level})")
        inside = keyed if level == 1 else keyed.join(F.broadcast(parents), F.expr(f"substring(vector, 1, {level - 1})") == parents["parent"], "left_semi")
        above = [bytes(r.node) for r in inside.groupBy(prefix.alias("node")).count().where(F.col("count") > share).collect()]
        if not above:
            break
        found |= set(above)
    return {n for n in found if len(n) < _LEVELS + _DEALT}


def near_words(vocabulary: DataFrame, share: int = SHARE) -> DataFrame:
    """``word, n, other, other_n``: every pair of words one edit apart, from both sides, and one row
    with a null ``other`` for each word. ``vocabulary`` holds distinct words ``word, n``."""
    spark = vocabulary.sparkSession

    def add_vectors(batches):
        for batch in batches:
            found = vectors(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([r.tobytes() for r in found], pa.binary())], ["word", "n", "vector"])

    keyed = materialise(vocabulary.select("word", "n").mapInArrow(add_vectors, "word string, n bigint, vector binary"), "vocabulary")
    total = keyed.count()
    split = spark.sparkContext.broadcast(split_nodes(keyed, total, share))

    def deal(batches):
        for batch in batches:
            for part in slices([batch], 2000):
                columns: tuple[list, ...] = ([], [], [], [], [])
                for word, n, vector in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    for node in routes(vector, split.value):
                        for column, value in zip(columns, (node, not vector.startswith(node), word, n, vector), strict=True):
                            column.append(value)
                kinds = (pa.binary(), pa.bool_(), pa.string(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["node", "visits", "word", "n", "vector"])

    def search(batches):
        node, held, trie, letters, counts = None, [], None, None, None
        asked: list = []

        def answers():
            """Search for the words that ask now, and forget them."""
            nonlocal asked, trie, letters, counts
            if trie is None:
                trie = LowerTrie(np.frombuffer(b"".join(v for _, _, v in held), np.uint8).reshape(-1, _LEVELS + _DEALT))
                letters, counts = Letters([w for w, _, _ in held]), [n for _, n, _ in held]
            words = Letters([w for w, _, _ in asked])
            waiting, size = [], 0
            for a, b in trie.search(np.frombuffer(b"".join(v for _, _, v in asked), np.uint8).reshape(-1, _LEVELS + _DEALT)):
                for start in range(0, len(a), VERIFIED):
                    waiting.append((a[start : start + VERIFIED], b[start : start + VERIFIED]))
                    size += len(waiting[-1][0])
                    if size >= VERIFIED:
                        yield from both_sides(words, waiting)
                        waiting, size = [], 0
            yield from both_sides(words, waiting)
            asked = []

        def both_sides(words, waiting):
            if not waiting:
                return
            a, b = (np.concatenate(c) for c in zip(*waiting, strict=True))
            near = verify(words, letters, a, b)
            out: tuple[list, ...] = ([], [], [], [])
            for x, y in zip(a[near].tolist(), b[near].tolist(), strict=True):
                one, other = (asked[x][0], asked[x][1]), (letters.words[y], counts[y])
                if one[0] > other[0] and asked[x][2][:_LEVELS] == held[y][2][:_LEVELS]:
                    continue  # equal vectors: each side finds the other
                for row in (one + other, other + one):
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            yield table(*out)

        def table(*columns):
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["word", "n", "other", "other_n"])

        for batch in batches:
            own: tuple[list, ...] = ([], [])
            for key, visits, word, n, vector in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != node:
                    if asked and held:
                        yield from answers()
                    node, held, trie, asked = key, [], None, []
                if not visits:
                    held.append((word, n, vector))
                    own[0].append(word)
                    own[1].append(n)
                elif not held:
                    continue  # a node without words
                asked.append((word, n, vector))
                if len(asked) >= ASKED and visits:
                    yield from answers()
            none = [None] * len(own[0])
            yield table(*own, none, none)
        if asked and held:
            yield from answers()

    dealt = keyed.mapInArrow(deal, "node binary, visits boolean, word string, n bigint, vector binary")
    tasks = max(1, 2 * total // max(share, total // MOST_NODES))
    return dealt.repartition(tasks, "node").sortWithinPartitions("node", "visits").mapInArrow(search, "word string, n bigint, other string, other_n bigint")


def group_variants(vocabulary: DataFrame, ratio: int = 5, share: int = SHARE) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``vocabulary`` (``word, n``)."""
    best = F.min(F.when(F.col("other").isNotNull(), F.struct((-F.col("other_n")).alias("minus"), "other"))).alias("best")
    near = near_words(vocabulary, share).groupBy("word").agg(F.max("n").alias("n"), F.count("other").alias("n_near"), best)
    taken = -F.col("best.minus") >= ratio * F.col("n")
    formed = materialise(
        near.select("word", "n", "n_near", F.when(taken, F.col("best.other")).alias("form"), F.when(taken, -F.col("best.minus")).alias("form_n")), "forms"
    )
    roots = formed.where("form is not null").select("word", F.col("form").alias("root"))
    counts = formed.agg(F.min("n"), F.max("n")).first()
    steps = math.floor(math.log(counts[1] / counts[0], ratio)) + 1 if counts[1] else 0
    for _ in range(max(0, steps - 1).bit_length()):
        onward = roots.select(F.col("word").alias("at"), F.col("root").alias("next"))
        roots = materialise(roots.join(onward, roots["root"] == onward["at"], "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    joined = formed.join(roots.withColumnRenamed("word", "at"), F.col("word") == F.col("at"), "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
