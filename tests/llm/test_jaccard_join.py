"""Operator 5 against all pairs."""

import random
from itertools import combinations

import pytest

from parcelflow.llm import jaccard_join as J
from tests.llm.cases import DOCUMENTS, documents, empty


def brute(rows, words=5, threshold=0.8):
    sets = []
    for _, text, *_ in rows:
        w = (text or "").lower().split()
        sets.append({tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    n = len(rows)
    links, group = [0] * n, list(range(n))
    for a, b in combinations([i for i in range(n) if rows[i][0] is not None], 2):
        same_id = rows[a][0] == rows[b][0]
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            same_id = True
        if same_id:
            old, new = max(group[a], group[b]), min(group[a], group[b])
            group = [new if g == old else g for g in group]
    ids = {g: min(rows[i][0] for i in range(n) if group[i] == g and rows[i][0] is not None)
           for g in set(group) if rows[g][0] is not None}
    return [(r[0], ids[group[i]] if r[0] is not None else None, links[i])
            for i, r in enumerate(rows)]


def rows_of(found):
    return sorted(map(repr, (tuple(r) for r in
                             found.select("doc_id", "class_id", "n_links").collect())))


def test_awkward_rows(spark):
    assert rows_of(J.near_duplicates(documents(spark))) == sorted(map(repr, brute(DOCUMENTS)))
    assert J.near_duplicates(empty(spark)).count() == 0


@pytest.mark.parametrize("block", [128, 4])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)  # 4: a group's block pairs go to many tasks
    monkeypatch.setattr(J, "BUCKET_BLOCK", 8 * block)
    monkeypatch.setattr(J, "BUCKET_ROWS", 100 * block)
    rnd = random.Random(9)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = []
    for family in range(6):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([3, 40, 80]))]
        for _ in range(14):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 3])):
                w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
            text = " ".join(w)
            rows.append((len(rows), rnd.choice([text, text.upper(), text.replace(" ", "\n ")]),
                         "en", "a"))
    rnd.shuffle(rows)
    assert rows_of(J.near_duplicates(documents(spark, rows))) == sorted(map(repr, brute(rows)))


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.8, 0.9):
        for recall in (0.9, 0.99, 0.9999):
            bands, rows = J.choose_bands(threshold, recall, 400)
            assert 1 - (1 - threshold ** rows) ** bands >= recall
            assert bands * rows <= 400
    assert J.choose_bands(J.THRESHOLD, J.RECALL) == (18, 4)


def test_least_equal_hashes():
    for threshold, hashes in ((0.8, 72), (0.5, 60)):
        least = J.least_equal(threshold, hashes, 1e-6)
        below = lambda k: sum(J.math.comb(hashes, i) * threshold ** i * (1 - threshold) ** (hashes - i)  # noqa: E731,B023
                              for i in range(k))
        assert below(least) <= 1e-6 < below(least + 1)
    assert 36 <= J.least_equal(0.8, 72) <= 45


def test_a_shared_template_moves_no_text(spark, monkeypatch):
    """Documents that share half their words collide in bands and are no candidates."""
    rnd = random.Random(3)
    header = [f"h{i}" for i in range(100)]
    rows = [(i, " ".join(header + [f"w{rnd.randrange(10**6)}" for _ in range(100)]), "en", "a")
            for i in range(1500)]
    seen = {}
    real = J.candidate_components
    monkeypatch.setattr(J, "candidate_components", lambda reps, least: seen.setdefault(
        "found", real(reps, least)))
    got = J.near_duplicates(documents(spark, rows)).collect()
    assert seen["found"].count() == 0
    assert all(r.n_links == 0 and r.class_id == r.doc_id for r in got) and len(got) == 1500


def test_components(spark):
    from parcelflow.llm.graph import connected_components

    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 500), (7, 3), (3, 7)]
    edges += [(rnd.randrange(1000, 1200), rnd.randrange(1000, 1200)) for _ in range(150)]
    rnd.shuffle(edges)
    group = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(group[a], group[b])
            changed |= group[a] != low or group[b] != low
            group[a] = group[b] = low
    alone = {x for x in group if not any(x in e and e[0] != e[1] for e in edges)}
    got = {r.node: r.component for r in connected_components(
        spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {x: g for x, g in group.items() if x not in alone}
