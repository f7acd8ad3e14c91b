"""Operator 3: base spans by the given patterns, and telling terms by counting."""

import math
import random
import re
from collections import Counter, defaultdict
from hashlib import sha256

from parcelflow.llm import pii as P
from parcelflow.session import stored
from tests.llm.cases import DOCUMENTS, LONG, documents, empty

# The patterns as given.
GIVEN = [re.compile(x) for x in (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]")]


def given_spans(text):
    out = []
    for kind, pattern in enumerate(GIVEN):
        for m in pattern.finditer(text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            luhn = sum(d if k % 2 == 0 else 2 * d - 9 * (d > 4)
                       for k, d in enumerate(reversed(digits)))
            if [True, kind != 1 or all(int(p) < 256 for p in m[0].split(".")),
                    13 <= len(digits) <= 19 and luhn % 10 == 0,
                    9 <= len(digits) <= 15][kind]:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_by_the_given_patterns():
    rnd = random.Random(5)
    texts = ["", "a@b.c", "a@b", "a@@b.cc", "x.y@z.com_q@r.de", "1.2.3.4.5.6.7.8", "256.1.1.1",
             "4111 1111 1111 1111", "+1 (407) 555-7710", "é🙂a@b.c 4283648832092189"]
    for alphabet in ("ab1.@-_%+ é", "0123.+ -()", "12.3@a.-", "4 -1", "+1 ()"):
        texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 90)))
                  for _ in range(2000)]
    for text in texts:
        assert [s[:3] for s in P.base_spans(text)] == given_spans(text), text


def test_long_runs_are_read_in_linear_time():
    for text in ("a" * 2_000_000 + "@", "1" * 500_000 + ".", "a@" * 200_000, LONG * 3,
                 "0" * 10_000 + ".1.1.1", "+1 " + " " * 500_000):
        P.base_spans(text)


def people():
    """Ada's address always meets 'zeppelin'; 'letter' stands everywhere."""
    rnd = random.Random(1)
    rows = []
    for i in range(60):
        filler = " ".join(f"word{chr(97 + rnd.randrange(20))}" for _ in range(12))
        who = [f"zeppelin letter ada@club.org {filler}", f"{filler} letter bob@club.org letter",
               f"letter {filler}"][i % 3]
        rows.append((i, who, "en", "a"))
    return rows + [(100 + k, rows[0][1], "en", "a") for k in range(5)]  # copies say no more


def by_documents(rows, prior=P.PRIOR, disclosed=P.DISCLOSED, identifying=P.IDENTIFYING):
    """id -> (kind, start, end) of the telling terms, counted by whole distinct texts."""
    texts = sorted({t or "" for _, t, *_ in rows})
    words, held, near, often = [], [], [], []
    for t in texts:
        taken = [s[1:3] for s in P.base_spans(t)]
        free = [m for m in P.TERM.finditer(t) if not any(a < m.end() and m.start() < b for a, b in taken)]
        words.append(free)
        held.append({(s[0], s[3]) for s in P.base_spans(t)})
        often.append(Counter(m[0].lower() for m in free))
        beside = defaultdict(set)
        for kind, a, _, entity in P.base_spans(t):
            before = [m[0].lower() for m in free if m.start() < a][-P.NEAR:]
            after = [m[0].lower() for m in free if m.start() >= a][:P.NEAR]
            beside[kind, entity] |= {*before, *after}
        near.append(beside)
    frequency = Counter(w for t in texts for w in {m.lower() for m in P.TERM.findall(t)})
    inside = Counter(w for t, h in zip(texts, held, strict=True) if h
                     for w in {m.lower() for m in P.TERM.findall(t)})
    mentions = Counter(e for h in held for e in h)
    both = Counter((w, e) for o, h in zip(often, held, strict=True) for w in o for e in h)
    evident = {(w, e) for o, h, n in zip(often, held, near, strict=True) for w in o for e in h
               if o[w] > 1 or w in n[e]}
    total = len(texts) + sum(map(bool, held))
    out = {}
    for i, text, *_ in rows:
        k = texts.index(text or "")
        for m in words[k]:
            w = m[0].lower()
            for e in held[k]:
                q, most = (frequency[w] + inside[w]) / total, P.most_bits(
                    mentions[e], len(texts), total - len(texts), prior)
                reveals = math.log2((both[w, e] + prior * q) / (mentions[e] + prior) / q)
                if most > 0 and reveals >= disclosed * most and (
                        both[w, e] > 1 or (w, e) in evident):
                    kind = 5 if reveals >= identifying * most else 4
                    spot = out.setdefault(i, {})
                    spot[m.span()] = max(kind, spot.get(m.span(), 0))
    return {i: sorted((k, *at) for at, k in f.items()) for i, f in out.items()}


def spans_of(spark, rows, **shares):
    return {r.doc_id: [tuple(s)[:3] for s in r.found] for r in
            P.find(documents(spark, rows), **shares).select("doc_id", "found").collect()}


def test_telling_terms(spark):
    rows = people()
    found, want = spans_of(spark, rows), by_documents(rows)
    assert any(want.values())
    for i, text, *_ in rows:
        assert found[i] == sorted(given_spans(text) + want.get(i, []))
        words = {text[a:b] for k, a, b in found[i] if k > 3}
        assert ("zeppelin" in words) == ("ada@" in text) and "letter" not in words


def rare(n=300):
    """Eve's address stands in one document, as 'mongolfier' does."""
    rows = [(i, f"common letter {' '.join(f'word{chr(97 + (i + k) % 20)}' for k in range(9))}",
             "en", "a") for i in range(n)]
    return [*rows, (n, "common letter mongolfier eve@club.org common", "en", "a")]


def test_entities_with_one_context_are_scored(spark):
    rows = rare()
    text = rows[-1][1]
    found = {r.doc_id: r.found for r in P.find(documents(spark, rows)).collect()}
    assert {text[s.start:s.end] for s in found[len(rows) - 1]} == {"eve@club.org", "mongolfier"}
    assert not any(found[i] for i in range(len(rows) - 1))


def test_whole_documents_against_plain_python(spark):
    rnd = random.Random(4)
    words = [f"{a}{b}{c}" for a in "bdfkl" for b in "aeiou" for c in "mnrst"]
    rows = []
    for i in range(400):
        text = [rnd.choice(words[:12] if rnd.random() < 0.7 else words) for _ in range(60)]
        for k in range(rnd.choice([0, 0, 0, 1, 1, 3])):
            who = rnd.choice([f"rare{i}x{k}", "ada", "bob", "Kam"])
            text.insert(rnd.randrange(60), f"{who}@club.org" + " zeppelin" * (who == "Kam"))
        rows.append((i, " ".join(text), "en", "a"))
    rows[7] = (7, "+1 (407) 555-7710 5.6.7.8 " + rows[7][1], "en", "a")
    rows += [(500 + i, rows[7][1], "en", "a") for i in range(9)]
    for shares in ({}, {"disclosed": 0.25, "identifying": 0.8}):
        found, want = spans_of(spark, rows, **shares), by_documents(rows, **shares)
        for i, text, *_ in rows:
            assert found[i] == sorted(given_spans(text) + want.get(i, [])), text
    assert {k for f in want.values() for k, _, _ in f} == {4, 5}


def test_telling_terms_go_wherever_the_document_holds_them(spark):
    rows = rare()
    far = " ".join(["common letter"] * 40)
    rows[-1] = (300, f"mongolfier {far} eve@club.org {far} Mongolfier", "en", "a")
    clean = {r.doc_id: r.text for r in
             P.sanitise(documents(spark, rows), P.find(documents(spark, rows))).collect()}
    assert "mongolfier" not in clean[300].lower() and "common letter" in clean[300]


def test_lists_of_entities_stay_linear(spark, monkeypatch):
    """Entities of the same documents are counted once, however many they are."""
    rows = rare()
    people = " ".join(f"p{k}@club.org {chr(97 + k % 26) * 3}{chr(97 + k // 26 % 26) * 3}"
                      for k in range(600))
    rows.append((301, people, "en", "a"))
    sizes = {}

    def kept(df, name):
        sizes[name] = stored(df, name)
        return sizes[name]

    monkeypatch.setattr(P, "stored", kept)
    P.find(documents(spark, rows)).count()
    assert sizes["entities"].count() == 601 and sizes["pairs"].count() < 1300


def test_planted_disclosures_and_little_else(spark):
    """Each of 40 people has a code name that meets the address in three texts, elsewhere in
    the text; every text has rare words of its own, which tell nobody."""
    rnd = random.Random(8)
    letters = "bcdfghklmnprst"
    word = lambda: "".join(rnd.choice(letters) + rnd.choice("aeiou") for _ in range(4))
    common = [word() for _ in range(60)]
    names = [f"codename{word()}" for _ in range(40)]
    rows = []
    for i in range(900):
        text = [rnd.choice(common) for _ in range(120)]
        for _ in range(12):  # rare words
            text.insert(rnd.randrange(len(text)), word())
        if i < 120:
            text.insert(60, f"person{i % 40}@club.org")
            text.insert(rnd.choice([5, 110]), names[i % 40])
        rows.append((i, " ".join(text), "en", "a"))
    found = spans_of(spark, rows)
    marked, told = Counter(), 0
    for i, text, *_ in rows[:120]:
        for k, a, b in found[i]:
            if k > 3:
                marked[text[a:b]] += 1
                told += text[a:b] == names[i % 40]
    assert told == 120  # every planted one, wherever it stands
    all_words = sum(len(P.TERM.findall(t)) for _, t, *_ in rows[:120])
    assert sum(marked.values()) < 0.03 * all_words
    assert told > 0.4 * sum(marked.values())  # the others are rare words near an address
    assert not any(s[0] > 3 for i in range(120, 900) for s in found[i])


def test_both_kinds_can_be_reached_at_every_size(spark):
    for n in (6, 40, 400):
        rows = [(i, f"common letter {'often ' * (i % 2)}", "en", "a") for i in range(n - 2)]
        rows = [(i, f"{t}{'x' * i}", "en", "a") for i, t, *_ in rows]
        rows += [(n, "common letter mongolfier eve@club.org", "en", "a"),
                 (n + 1, "common letter mongolfier eve@club.org again", "en", "a")]
        found = spans_of(spark, rows)
        text = rows[-2][1]
        assert {(k, text[a:b]) for k, a, b in found[n]} == {(0, "eve@club.org"), (5, "mongolfier")}


def test_broader_terms(spark):
    names = [f"mont{x}" for x in "abcdefghij"] + ["montgolfier", "monday", "zeppelin", "mo"]
    table = spark.createDataFrame([(w,) for w in names], "term string")
    asked = spark.createDataFrame([("montgolfier",), ("zeppelin",), ("mo",)], "term string")
    assert [tuple(r) for r in P.broader_terms(asked, table).collect()] == [("montgolfier", "mont")]
    assert P.broader_terms(asked, table, wide=13).count() == 0
    assert [tuple(r) for r in P.broader_terms(asked, table, wide=12).collect()] == [
        ("montgolfier", "mon")]


def test_sanitise(spark):
    docs = documents(spark, people())
    clean = {r.doc_id: r.text for r in P.sanitise(docs, P.find(docs)).collect()}
    assert len(clean) == 65
    assert not any("@" in t or "zeppelin" in t for t in clean.values())
    assert all("letter" in t for t in clean.values())


def test_awkward_rows_and_digests(spark):
    got = P.digests(P.find(documents(spark))).collect()
    assert len(got) == len(DOCUMENTS)
    assert {(r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) for r in got} == {
        (0, 0, 0, 0, sha256(b"").hexdigest(), "")}
    assert P.find(empty(spark)).count() == 0
    rows = [(1, "a@b.cc 1.2.3.4 é x@y.zz", "en", "a")]
    one = P.digests(P.find(documents(spark, rows))).first()
    spans = "email:0:6,email:17:23,ip:7:14"
    assert (one.n_email, one.n_ip, one.spans) == (2, 1, spans)
    assert one.base_sha256 == sha256(spans.encode()).hexdigest()
