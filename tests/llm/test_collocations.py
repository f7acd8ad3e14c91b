"""Operator 11 against a plain count, fingerprints that collide included."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from parcelflow.llm.collocations import (Layout, Words, collocations, frequent_phrases, pack,
                                         unpack)
from tests.llm.cases import DOCUMENTS, documents, empty


def counts(rows, longest):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f[lang].update(" ".join(words[i:i + size]) for i in range(len(words) - size + 1))
    return f, n


def brute(rows, least, longest=5, top=2000, covered=100):
    f, n = counts(rows, longest)
    out = []
    for lang, seen in f.items():
        often = {p: c for p, c in seen.items() if c >= least and " " in p}
        scored = []
        for p, a in often.items():
            if any(len(q) > len(p) and f" {p} " in f" {q} " and 100 * c >= covered * a
                   for q, c in often.items()):
                continue
            w = p.split(" ")
            score, k = min((1000 * a * n[lang] // (seen[" ".join(w[:k])] * seen[" ".join(w[k:])]), k)
                           for k in range(1, len(w)))
            scored.append((-score, -a, p.encode(), p, a, seen[" ".join(w[:k])],
                           seen[" ".join(w[k:])], n[lang], score, k))
        out += [(lang, i + 1, *row[3:]) for i, row in enumerate(sorted(scored)[:top])]
    return sorted(out)


def result(found):
    return sorted(tuple(r) for r in found.collect())


def generated(seed=5):
    rng = random.Random(seed)
    words = ["a", "B", "ç", "dé", "é e", "fg", "🙂", "x'y"]
    ends = [" ", "  ", "\t", " ", " ", ". ", "\n", "\x0b", "?", ",", "\x0c"]
    rows = [(i, "".join(rng.choice(words[:rng.randint(2, 8)]) + rng.choice(ends)
                        for _ in range(rng.randint(0, 60))), rng.choice(["en", "de", None, "und"]),
             "s") for i in range(120)]
    return rows + rows[:40] + [(None, "a b a b a b", None, None)] * 30


@pytest.mark.parametrize("sizes", [{}, {"chunk_bytes": 300}, {"chunk_bytes": 64, "spare_bits": -14}])
def test_against_plain_counts(spark, sizes):
    # with 14 bits fewer than runs, nearly all fingerprints collide
    rows = generated()
    found = collocations(documents(spark, rows), least=7, **sizes)
    assert result(found) == brute(rows, 7)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut"]


def test_covered_share_top_and_awkward_rows(spark):
    rows = generated(6)
    assert result(collocations(documents(spark, rows), least=5, covered=60, top=9)) == brute(
        rows, 5, covered=60, top=9)
    assert result(collocations(documents(spark), least=2)) == brute(DOCUMENTS, 2)
    assert collocations(empty(spark)).count() == 0
    assert collocations(documents(spark, [(1, None, "en", "s"), (2, "", None, None)])).count() == 0


def test_frequencies_of_all_sizes(spark):
    rows = generated(7)
    f, n = counts(rows, 3)
    found = {(r.lang, r.phrase, r.size): r.f for r in
             frequent_phrases(documents(spark, rows), 4, 3, chunk_bytes=500).collect()}
    expected = {(lang, p, len(p.split(" "))): c for lang, s in f.items() for p, c in s.items()
                if c >= 4} | {(lang, "", 0): c for lang, c in n.items()}
    assert found == expected


def test_words_do_not_run_over_rows_or_slices():
    import pyarrow as pa

    texts = pa.array(["ab", "", None, "C d.e", " f\tg "])
    words = Words(texts)
    assert [words.names[c].as_py() for c in words.code] == ["ab", "c", "d", "e", "f", "g"]
    assert words.text.tolist() == [0, 3, 3, 3, 4, 4]
    assert words.runs(2).tolist() == [1, 4]
    cut = Words(texts.slice(3, 2))
    assert [cut.names[c].as_py() for c in cut.code] == ["c", "d", "e", "f", "g"]


def test_packed_fingerprints_round_trip():
    rng = np.random.default_rng(1)
    for top in (300, 10**6, 10**12):
        values = np.unique(rng.integers(50, top, 400).astype(np.uint64))
        held = rng.integers(1, 101, len(values)).astype(np.uint64)
        for width in (1, 2, 4):
            if top // (1 << 8 * width) < 10**6:
                got = unpack(*pack(values, held, 50, width, 1), 50, width, 1)
                assert (got[0] == values).all() and (got[1] == held).all()


def test_layout_grows_with_the_corpus():
    small, large = (Layout(t, 4 << 20, 5, 100, 5) for t in (10**9, 10**14))
    assert small.ranges < large.ranges and small.bits < large.bits < 60
    assert large.low[0] == 0 and large.low[-1] == 1 << large.bits
