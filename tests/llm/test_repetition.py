"""Suffix-array repetition against counting windows."""

from __future__ import annotations

import random
import re

import numpy as np

from kpi_lake.llm import repetition

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words, covered, seen = WORD.findall(text or ""), set(), {}
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i : i + 5]), []).append(i)
    for starts in seen.values():
        if len(starts) > 1:
            covered.update(j for i in starts for j in range(i, i + 5))
    longest = 0
    for i in range(len(words)):
        for j in range(i + 1, len(words)):
            k = 0
            while j + k < len(words) and words[i + k] == words[j + k]:
                k += 1
            longest = max(longest, k)
    lines, dup, kept = set(), 0, (text or "").split("\n")
    for line in kept:
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": dup,
        "n_repeat_words": len(covered),
        "covered_chars": sum(len(words[i]) for i in covered),
        "longest_repeat": longest,
    }


def texts():
    made = random.Random(2)
    out = [None, "", " \n\t", "a", "a a a a a a a a a a a a", "é ü\x85x ß " * 6, "l1 x\nl2\nl1 x\n\n\n", "#* <|> $%&", "a b c d e " * 2]
    for _ in range(150):
        words = [made.choice(["a", "b", "cé"]) for _ in range(made.randrange(60))]
        out.append("".join(w + made.choice([" ", " ", "\n", "\t"]) for w in words))
    return out


def test_measures_equal_brute_force(documents):
    rows = list(enumerate(texts()))
    got = {r.id: r for r in repetition.repetition(documents(rows)).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        want = brute(text)
        assert {k: got[i][k] for k in want} == want, text
        failed = want["n_words"] < 10 or 100 * want["n_repeat_words"] > 20 * want["n_words"]
        assert got[i].base_failed == failed
        fine = want["covered_chars"] <= 0.2 * want["word_chars"] and want["longest_repeat"] <= 64
        assert got[i].kept == (not failed and fine)


def test_a_long_repeat_fails_and_an_empty_table_gives_none(documents):
    made = random.Random(3)
    words = [f"w{made.randrange(10**9)}" for _ in range(2000)]
    row = repetition.repetition(documents([(1, " ".join(words + words[:70]))])).first()
    assert (row.longest_repeat, row.base_failed, row.kept) == (70, False, False)
    assert repetition.repetition(documents([(1, "a")]).limit(0)).count() == 0


def test_suffixes_do_not_cross_documents():
    words = np.array([1, 2, 3, 1, 2, 3])
    doc = np.array([0, 0, 0, 1, 1, 1])
    assert repetition.longest_repeats(words, doc, np.array([3, 3, 3, 6, 6, 6])).tolist() == [0] * 6
    assert repetition.longest_repeats(words, np.zeros(6, int), np.full(6, 6)).tolist() == [3, 2, 1, 3, 2, 1]
