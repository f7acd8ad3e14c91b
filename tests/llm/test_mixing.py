"""Operator 9: the tree's budgets and the prefixes, against plain Python."""

import random
import re
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from parcelflow.llm import mixing as M
from tests.llm.cases import DOCUMENTS, documents, empty


def fill(budget, children):
    """children: name -> (capacity, weight); whole-token water filling."""
    order = sorted(children, key=lambda c: (children[c][1] <= 0,
                                            children[c][0] / children[c][1] if children[c][1] else 0, c))
    got, left = {}, budget
    for k, name in enumerate(order):
        cap, w = children[name]
        onward = sum(children[c][1] for c in order[k:])
        if w > 0 and cap * onward <= left * w:
            got[name], left = cap, left - cap
        else:
            break
    rest = {c: children[c] for c in children if c not in got}
    total = sum(w for _, w in rest.values())
    for c, (cap, w) in rest.items():
        got[c] = min(cap, int(left * w // total)) if w > 0 else 0
    return got


def brute(rows, domain, targets, share, epochs, seed):
    weight = lambda level, n: targets.get(level, {}).get(n, M.OTHER_WEIGHT)
    docs = [(domain[s or ""], lang or "", s or "", len(re.findall(r"\S+", t or "")), i,
             f"{'' if i is None else i}:{md5((t or '').encode()).hexdigest()[:8]}")
            for i, t, lang, s in rows]
    capacity = lambda p: epochs * sum(d[3] for d in docs if d[:len(p)] == p)
    budgets = {(): min(int(sum(d[3] for d in docs) * share), capacity(()))}
    for depth, level in enumerate(M.LEVELS):
        nodes = {}
        for parent in {d[:depth] for d in docs}:
            names = {d[depth] for d in docs if d[:depth] == parent}
            dealt = fill(budgets[parent], {n: (capacity((*parent, n)), weight(level, n))
                                           for n in names})
            nodes |= {(*parent, n): b for n, b in dealt.items()}
        budgets = nodes
    out = []
    for leaf, budget in budgets.items():
        own = [d for d in docs if d[:3] == leaf]
        times, rest = divmod(budget, max(1, sum(d[3] for d in own)))
        key = lambda d: (md5(f"{seed}:{times}:{d[5]}".encode()).hexdigest(), d[3])
        held = 0
        for d in sorted(own, key=key):
            held += d[3]
            if times + (held <= rest):
                out.append((d[4], *leaf, d[3], times + (held <= rest)))
    return out


def run(spark, rows, targets, share, epochs, seed=3):
    docs = documents(spark, rows)
    domain = F.when(docs["source"] < "c", "d1").otherwise("d2")
    return docs, [tuple(r) for r in M.mix(docs, domain, targets, share, epochs, seed).select(
        "row.doc_id", *M.LEVELS, "n_tokens", "copies").collect()]


@pytest.mark.parametrize("share,epochs", [(0.3, 1), (0.9, 2), (1.7, 4), (50.0, 3), (0.0, 1)])
def test_against_plain_python(spark, share, epochs):
    rnd = random.Random(int(share * 10))
    rows = [(i, " ".join(["t"] * rnd.choice([0, 1, 5, 40])), rnd.choice(["en", "en", "de", "fr"]),
             rnd.choice("aaaaaabcdef")) for i in range(400)]
    targets = {"domain": {"d1": 70, "d2": 30}, "language": {"en": 5, "de": 90, "fr": 0},
               "site": {"b": 100}}
    _, got = run(spark, rows, targets, share, epochs)
    domain = {s: "d1" if s < "c" else "d2" for s in "abcdef"}
    want = brute(rows, domain, targets, share, epochs, 3)
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_a_leaf_of_missing_or_equal_ids_is_spread(spark):
    rnd = random.Random(5)
    for one in (None, 7):
        rows = [(one, " ".join(rnd.choices("abcdefg", k=rnd.randint(1, 9))) + f" {i}", "en", "a")
                for i in range(600)]
        docs, got = run(spark, rows, {}, 0.5, 1)
        want = brute(rows, {"a": "d1"}, {}, 0.5, 1, 3)
        assert sorted(map(repr, got)) == sorted(map(repr, want))
        spots = docs.select(M.hash32(M.ticket_name(docs["doc_id"], docs["text"])).alias("s"))
        assert spots.distinct().count() == 600


def test_shortage_goes_to_siblings_first(spark):
    # language x of domain d1 has little: its sibling y takes the rest, not d2
    rows = [(i, "t t", "x", "a") for i in range(5)] + [(100 + i, "t t", "y", "b") for i in range(100)]
    rows += [(300 + i, "t t", "x", "d") for i in range(100)]
    targets = {"domain": {"d1": 50, "d2": 50}, "language": {"x": 50, "y": 50}}
    _, got = run(spark, rows, targets, 0.5, 1)
    tokens = lambda d, lang: sum(r[4] * r[5] for r in got if r[1:3] == (d, lang))
    assert (tokens("d1", "x"), tokens("d2", "x")) == (10, 102)
    assert tokens("d1", "y") == 92


def test_awkward_rows(spark):
    docs = documents(spark)
    found = M.mix(docs, M.domain_of(docs["source"]), budget_share=1.0, max_epochs=1)
    assert found.select("row.*").columns == docs.columns
    whole = [tuple(r) for r in found.select("row.doc_id", "n_tokens").collect()]
    with_tokens = [(i, len(t.split())) for i, t, *_ in DOCUMENTS if t and t.split()]
    assert sorted(map(repr, (r for r in whole if r[1]))) == sorted(map(repr, with_tokens))
    none = empty(spark)
    assert M.mix(none, M.domain_of(none["source"])).count() == 0
    with pytest.raises(ValueError):
        M.mix(docs, F.lit("d"), {"domain": {"d": -1}})
