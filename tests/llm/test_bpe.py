"""BPE automaton against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import struct

import pytest

from kpi_lake.llm import bpe
from kpi_lake.llm.queries import vocabulary_path

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def pair():
    return bpe.TokenAutomaton(**bpe.load_vocabulary(vocabulary_path())), tokenizers.Tokenizer.from_file(vocabulary_path())


def texts():
    made = random.Random(5)
    out = ["", " ", "\n", "a", "aaaa", "hello'll world's", "x<|endoftext|>y <|endoftext|>", "=" * 300, " " * 99 + "x", "a\n\nb  c \t d", "\x85 \x1c  a b"]
    out += ["a" * n for n in range(2, 40)]
    out += ["".join(made.choice("ab .\n'") for _ in range(50)) for _ in range(400)]
    out += ["".join(chr(made.choice([made.randrange(32, 127), made.randrange(160, 900), made.randrange(0x4E00, 0x4F00), 0x1F600])) for _ in range(30)) for _ in range(400)]
    return out


def test_ids_and_text_equal_the_library(pair):
    automaton, library = pair
    for text in texts():
        encoded = library.encode(text, add_special_tokens=False).ids
        ids = automaton.encode(text)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == encoded, text
        assert automaton.decode(ids).decode() == library.decode(encoded, skip_special_tokens=False)


def test_arcs_are_the_pairs_that_encode_to_themselves(pair):
    """An arc between two tokens is there just when their bytes encode to the two."""
    automaton, _ = pair
    made, letters = random.Random(1), [i for i, label in automaton.labels.items() if label.isalpha() and label.islower()]
    for _ in range(3000):
        a, b = made.choice(letters), made.choice(letters)
        joined = automaton.labels[a] + automaton.labels[b]
        assert automaton.arc(a, b) == (merged(automaton, joined) == [a, b])


def merged(automaton, word):
    """Plain BPE: the lowest-ranked pair first, leftmost."""
    ids = [automaton.ids[bytes([c])] for c in word]
    while True:
        ranked = [(automaton.cut[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in automaton.cut]
        if not ranked:
            return ids
        _, i = min(ranked)
        ids[i : i + 2] = [automaton.ids[automaton.labels[ids[i]] + automaton.labels[ids[i + 1]]]]


def test_operator_over_odd_rows(documents, pair):
    rows = [(1, "Hello world"), (1, "Hello world"), (None, "x"), (3, None), (4, ""), (5, "word " * 5000)]
    got = bpe.encode_decode(documents(rows), vocabulary_path()).collect()
    assert len(got) == len(rows)
    empty = hashlib.sha256(b"").hexdigest()
    for r in got:
        text = next(t for i, t in rows if i == r.id) or ""
        assert r.decoded == text and r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(r.ids)}I", *r.ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert text or r.ids_sha256 == empty
    assert bpe.encode_decode(documents([(1, "a")]).limit(0), vocabulary_path()).count() == 0
