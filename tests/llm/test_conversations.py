"""Operator 13 against a search over all edit sequences."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from parcelflow.llm.conversations import (FIGURES, best_edits, damaged, digested, repaired)
from tests.llm.cases import CLASHING

GOOD = re.compile(r"(s?(ua)+)?\Z")


def search(turns):
    """Cheapest, then ASCII-least audit: uniform-cost search over (turn, output) with
    whole outputs in the pattern's prefixes; the output is kept as its initials."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, out = heapq.heappop(heap)
        state = (i, out[-1:])
        if i == len(turns) and GOOD.match(out):
            return cost, audit
        # the same turn and last initial with more cost, or a later audit, only loses
        # when the audit isn't a prefix of the other: keep all of equal cost
        if (state, cost, audit) in done:
            continue
        done.add((state, cost, audit))

        def push(more, letter, j, new):
            text = out + new
            if re.match(r"s?(ua)*u?\Z", text):
                heapq.heappush(heap, (cost + more, audit + letter, j, text))  # noqa: B023

        if not audit.endswith("II"):
            for role in "ua":
                push(2, "I", i, role)
        if i < len(turns):
            initial, fault = turns[i]
            push(3, "D", i + 1, "")
            if fault != 2:
                if initial in ("s", "u", "a"):
                    push(fault, "K", i + 1, initial)
                for role in "ua":
                    push(2 + fault, "R", i + 1, role)
    raise AssertionError


def damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        space = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        out[conv]
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def brute(conv, rows):
    rows = sorted(rows, key=lambda r: ((r[0] is not None, r[0] or 0), r[1],
                                       hashlib.md5(r[2].encode()).digest()))
    turns, seen = [], set()
    count = dict.fromkeys(FIGURES, 0)
    for _, role, text in rows:
        shown = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else (
            "truncated" if shown[-1] not in ".!?" else None)
        seen.add((role, text))
        if fault:
            count[fault] += 1
        turns.append((role[:1], 2 if fault in ("blank", "duplicate") else int(fault is not None)))
    count["illegal"] = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au")
                           for a, b in zip(rows, rows[1:], strict=False))
    at = {r[0] for r in rows if r[0] is not None}
    count["gaps"] = max(at) - min(at) + 1 - len(at) if at else 0
    count["cost"], audit = search(turns)
    lines, state, i = [], "", 0
    for letter in audit:
        fits = "a" if state == "u" else "u"
        name = {"u": "user", "a": "assistant"}[fits]
        if letter == "I":
            lines.append(f"{name}:")
            state = fits
            continue
        _, role, text = rows[i]
        i += 1
        if letter == "K":
            lines.append(f"{role}:{text}")
            state = role[0]
        elif letter == "R":
            lines.append(f"{name}:{text}")
            state = fits
    return (conv, *(count[f] for f in FIGURES), audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def frame(spark, rows):
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                           T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
    for name in [*CLASHING, "kind", "place", "digest"]:
        schema = schema.add(name, T.StringType())
    return spark.createDataFrame([(*r, *["x"] * (len(schema) - 4)) for r in rows], schema)


def result(spark, rows):
    found = digested(repaired(damaged(frame(spark, rows))))
    assert found.columns == ["conv_id", "audit", "figures", "repaired_sha256"]
    return sorted(((r.conv_id, *r.figures, r.audit, r.repaired_sha256) for r in found.collect()),
                  key=repr)


def expected(rows):
    return sorted((brute(c, r) for c, r in damage(rows).items()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_against_a_search(spark, seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "under", "User"]
    texts = ["Hi.", "So", "What?", "x!\n", "", " \t", None, "ok. then", "é ", "a\nb.\r\n"]
    rows = [(conv, rng.choice([t, t, t, None, t // 2]), rng.choice(roles[:rng.choice([3, 5, 10])]),
             rng.choice(texts) if rng.random() < .5 else f"t{conv}{t}.")
            for conv in [None, *range(60)] for t in range(rng.randint(1, 7))]
    rows += rng.sample(rows, 15)
    assert result(spark, rows) == expected(rows)


def test_edits_against_a_search():
    rng = random.Random(9)
    for _ in range(300):
        turns = [(rng.choice(["s", "u", "a", "x", ""]), rng.choice([0, 0, 1, 2]))
                 for _ in range(rng.randint(0, 6))]
        cost, audit, steps, ending = best_edits(turns)
        assert (cost, audit) == search(turns)
        assert audit == "".join("I" * k + " DIKR"[e] for k, e in steps) + "I" * ending


def test_ties_take_the_ascii_least_audit():
    assert best_edits([]) == (0, "", [], 0)
    assert best_edits([("u", 0)])[:2] == (2, "KI")
    assert best_edits([("a", 0)])[:2] == (2, "IK")
    assert best_edits([("s", 0)])[:2] == (3, "D")
    assert best_edits([("u", 0), ("a", 2), ("a", 0)])[:2] == (3, "KDK")
    assert best_edits([("u", 0), ("u", 0)])[:2] == (2, "KR")


def test_empty_table_and_conversations_without_turns(spark):
    assert result(spark, []) == []
    gone = next((c, t) for c in range(100) for t in range(9)
                if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    rows = [(*gone, "user", "Hi.")]
    assert result(spark, rows) == [(gone[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert result(spark, rows * 3) == result(spark, rows)


def test_one_long_conversation_among_others(spark):
    rng = random.Random(2)
    rows = [(7, t, rng.choice(["user", "assistant"]), f"{t % 500} {'word ' * (t % 3)}.")
            for t in range(1500)]
    rows += [(c, t, ("user", "assistant")[t % 2], f"{c} {t}.") for c in range(8, 40) for t in range(6)]
    found = {r[0]: r for r in result(spark, rows)}
    assert len(found) == 33
    small = damage([r for r in rows if r[0] != 7])
    assert all(found[c] == brute(c, v) for c, v in small.items())
    turns = sum(len(v) for v in damage([r for r in rows if r[0] == 7]).values())
    audit = found[7][-2]
    assert sum(x in "DKR" for x in audit) == turns


def test_repaired_turns(spark):
    rows = [(1, 0, "assistant", "b."), (1, 1, "user", "c."), (2, 5, "system", "s.")]
    kinds = {(c, t): zlib.crc32(f"{c}:{t}".encode()) % 20 for c, t, *_ in rows}
    found = repaired(frame(spark, rows).selectExpr("conv_id", "turn", "role", "text", "1L as copies"))
    turns = sorted((r.conv_id, r.place, r.role, r.text) for r in found.filter("place > 0").collect())
    assert kinds and turns == [(1, 1, "user", ""), (1, 2, "assistant", "b."), (1, 3, "user", "c."),
                               (1, 4, "assistant", "")]
