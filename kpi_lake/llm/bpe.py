"""BPE encoding and decoding by a tokenization automaton.

The merges are compiled, in order of rank, into a deterministic automaton over tokens. It starts
with one state that every byte token loops on. The gadget of merge ``(u, v) -> uv`` copies the state
that ``u`` leads to without its ``v`` arc, redirects the ``u`` arcs to the copy, and adds a ``uv``
arc, to the state that ``v`` leads to, wherever a ``u`` arc leaves. States are kept as differences:
per token the token whose state it began as (``alias``), per token the one whose arcs it took over
(``lead``), the rank at which both came to be (``birth``) and the set of removed arcs (``cut``);
the arcs themselves are looked up in that table and remembered. A sequence of tokens is the BPE of
its bytes just when the automaton reads it, so for each prefix of a word there is one last token,
found by longest arc first. Decoding emits the label (the bytes) of each arc.

Text is pre-split by the byte-level pattern, special strings of the vocabulary file first. Words are
encoded once and remembered (a table of bounded size per Python worker); a text's ids are the
concatenation. Nothing is shuffled; the vocabulary (a file of fixed size) is broadcast.

Defined cases: a null or empty text has no tokens and decodes to an empty text; special strings in a
text become their id, as the file's added tokens say; repeated rows are encoded each for itself; an
empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import struct
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpi_lake.llm.common import slices, utf8_column, worker_cache

# Fixed value: the byte-level pre-splitting pattern.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words that one Python worker remembers at a time (memory only; the result doesn't depend on it).
REMEMBERED_WORDS = 600_000


def byte_alphabet() -> dict[str, int]:
    """The printable character of each byte in a byte-level vocabulary file: bytes that print as
    themselves, and from 256 on, in order, the others."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printed)]
    return {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_vocabulary(path: str) -> dict:
    """What the automaton needs of a tokenizer file: token bytes by id, merges as id triples in
    order of rank, and the added strings."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"]
    if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or spec["normalizer"]:
        raise ValueError("only plain byte-level BPE files are read")
    alphabet = byte_alphabet()
    vocab = model["vocab"]
    labels = {i: bytes(alphabet[c] for c in token) for token, i in vocab.items()}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    return {
        "labels": labels,
        "merges": [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges],
        "added": {t["content"]: t["id"] for t in spec["added_tokens"]},
    }


class TokenAutomaton:
    """The compiled merges."""

    def __init__(self, labels: dict[int, bytes], merges: list[tuple[int, int, int]], added: dict[str, int]):
        import regex

        self.labels = dict(labels)
        self.added = dict(added)
        size = max([*labels, *added.values()]) + 1
        self.birth = [-1] * size
        self.alias = [-1] * size
        self.lead = [-1] * size
        self.cut: dict[tuple[int, int], int] = {}
        for rank, (u, v, uv) in enumerate(merges):
            self._gadget(rank, u, v, uv)
        made = {uv for _, _, uv in merges}
        self.ids = {label: i for i, label in labels.items() if i in made or len(label) == 1}
        self.longest = max(map(len, self.ids), default=1)
        self.arcs: dict[tuple[int, int], bool] = {}
        self.starts: dict[str, bytes] = {}  # of a string at a line's start, and of whole pieces
        self.inner: dict[str, bytes] = {}  # of a string after a space
        self.split = regex.compile(SPLIT).findall
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        top = max(labels.keys() | set(added.values()), default=-1)
        self.line_end = self._word("\n") if b"\n" in self.ids else b""
        self.emit = [self.labels.get(i, b"") for i in range(top + 1)]
        for text, i in added.items():
            self.emit[i] = text.encode()

    def _gadget(self, rank: int, u: int, v: int, uv: int) -> None:
        """``u``'s state loses the ``v`` arc; ``uv`` leads to ``v``'s state as it is now, and leaves
        every state that ``u`` leaves."""
        self.cut[u, v] = rank
        if self.birth[uv] < 0:  # a token that two merges make keeps its first
            self.birth[uv], self.alias[uv], self.lead[uv] = rank, v, u

    def arc(self, t: int, x: int) -> bool:
        """Whether the finished automaton has an ``x`` arc from the state that ``t`` leads to."""
        known = self.arcs.get((t, x))
        if known is not None:
            return known
        birth, alias, lead, cut = self.birth, self.alias, self.lead, self.cut
        key, now, has = (t, x), len(cut) + len(birth), True
        while True:
            gone = cut.get((t, x))
            if gone is not None and gone < now:
                has = False
                break
            a, b = birth[t], birth[x]
            if a < 0 and b < 0:  # both bytes: the first state's loops
                break
            if b > a:  # x came later: its arc was made where its left part had one
                if t == lead[x] == alias[x]:  # runs of one token pair off from the left
                    has = False
                    break
                now, x = b, lead[x]
            elif a > b:  # t came later: its state began as its right part's
                now, t = a, alias[t]
            else:  # t and x are one token: both at once
                now, t, x = a, alias[t], lead[x]
        if len(self.arcs) > 4_000_000:
            self.arcs.clear()
        self.arcs[key] = has
        return has

    def encode_word(self, word: bytes) -> list[int]:
        """The tokens of a pre-split word: table-driven transitions, longest arc first. A place in
        the word is reached by one path at most (the prefix's only tokens), so a place that was
        left is never tried again and the walk is linear in places."""
        whole = self.ids.get(word)
        if whole is not None:
            return [whole]
        n, get, known, arc, longest = len(word), self.ids.get, self.arcs.get, self.arc, self.longest
        path: list[int] = []
        places, at, last, left = [0], 0, -1, set()
        end = min(n, longest)
        while at < n:
            while end > at:
                token = get(word[at:end])
                if token is not None and end not in left:
                    has = last < 0 or known((last, token))
                    if has is None:
                        has = arc(last, token)
                    if has:
                        path.append(token)
                        places.append(end)
                        at, last, end = end, token, min(n, end + longest)
                        break
                end -= 1
            else:  # a dead end: leave this place, try a shorter arc from the one before
                left.add(at)
                end = places.pop() - 1
                path.pop()
                at, last = places[-1], path[-1] if path else -1
        return path

    def _word(self, segment: str) -> bytes:
        """The ids of a string, split by the pattern, as bytes."""
        out: list[int] = []
        for piece in self.split(segment):
            out += self.encode_word(piece.encode("utf-8"))
        return struct.pack(f"<{len(out)}I", *out)

    def _pieces(self, text: str) -> bytes:
        """Ids of a text without special strings. In a line whose only white space is single spaces
        between words, a piece of the pattern never spans a space and what stands before it, nor a
        line end, so the parts are looked up each for itself; other texts are split by the pattern."""
        starts, inner, out = self.starts, self.inner, []
        for k, line in enumerate(text.split("\n")):
            parts = line.split(" ")
            if parts != line.split():
                return self._by_pattern(text)
            if k:
                out.append(self.line_end)
            first, rest = parts[0], parts[1:]
            if first not in starts:
                self._make_room()
                starts[first] = self._word(first)
            out.append(starts[first])
            try:
                out.append(b"".join(map(inner.__getitem__, rest)))
            except KeyError:
                self._make_room()
                for part in set(rest).difference(inner):
                    inner[part] = self._word(" " + part)
                out.append(b"".join([inner[part] for part in rest]))
        return b"".join(out)

    def _by_pattern(self, text: str) -> bytes:
        starts, out = self.starts, []
        for piece in self.split(text):
            if piece not in starts:
                self._make_room()
                starts[piece] = self._word(piece)
            out.append(starts[piece])
        return b"".join(out)

    def _make_room(self) -> None:
        if len(self.starts) + len(self.inner) > REMEMBERED_WORDS:
            self.starts.clear()
            self.inner.clear()

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        if self.specials is None or self.specials.search(text) is None:
            return self._pieces(text)
        out = []
        for part in self.specials.split(text):
            out.append(np.array([self.added[part]], "<u4").tobytes() if part in self.added else self._pieces(part))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The labels of the arcs, joined; bytes that are no UTF-8 are replaced as in a text."""
        raw = b"".join(map(self.emit.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return raw.decode("utf-8", "replace").encode("utf-8")


def shared_automaton(spark: SparkSession, path: str):
    """A function that gives the automaton, compiled once per Python worker."""
    shared, key = spark.sparkContext.broadcast(load_vocabulary(path)), uuid.uuid4().hex

    def get() -> TokenAutomaton:
        kept = worker_cache("bpe")
        if key not in kept:
            kept.clear()
            kept[key] = TokenAutomaton(**shared.value)
        return kept[key]

    return get


def encode_decode(
    documents: DataFrame,
    vocabulary: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
    with_text: bool = True,
) -> DataFrame:
    """Per document ``id, n_tokens, ids_sha256, decoded_sha256`` and, if asked for, ``ids``
    (array of int) and ``decoded`` (the text that the ids decode to)."""
    import hashlib

    get = shared_automaton(documents.sparkSession, vocabulary)
    fields = [("id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    kinds = "id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32())))
        kinds += ", ids array<int>"
    if with_text:
        fields.append(("decoded", pa.string()))
        kinds += ", decoded string"
    schema = pa.schema(fields)

    def run(batches):
        automaton = get()
        for batch in slices(batches):
            out: dict[str, list] = {name: [] for name in schema.names}
            for doc, raw in zip(batch.column(0).to_pylist(), utf8_column(batch.column(1)), strict=True):
                ids = automaton.encode(raw.decode("utf-8", "replace"))
                decoded = automaton.decode(ids)
                out["id"].append(doc)
                out["n_tokens"].append(len(ids) // 4)
                out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(decoded).hexdigest())
                if with_ids:
                    out["ids"].append(np.frombuffer(ids, "<i4"))
                if with_text:
                    out["decoded"].append(decoded.decode("utf-8"))
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    docs = documents.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(run, kinds)
