"""Operator 10: the composed grammar, held-out accuracy, awkward rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from zlib import crc32

from parcelflow.llm import toxicity as X
from tests.llm.cases import DOCUMENTS, documents, empty

SF = "/root/testdata/sf0.1"


def score(text, learned=None):
    return X.Grammar(learned or {}).clause_scores(text)[0]


W = X.SEED_WEIGHT


def test_clauses_not_words():
    (plain,), (aimed,) = score("what an idiot"), score("you are an idiot")
    (negated,), (reported,) = score("he is not an idiot"), score("the man said idiot")
    assert plain == W
    assert aimed == pytest.approx(X.AIMED * X.PREDICATED * plain)
    assert negated == pytest.approx(X.AIMED * X.NEGATED * X.PREDICATED * plain)
    assert reported == pytest.approx(X.REPORTED * plain)
    # factors end with the clause, negation after a few words
    assert score("not this. what an idiot") == [plain]
    assert score("not one two three four idiot") == [plain]
    assert score("you said nothing. idiot") == [plain]
    assert score("idiot moron; idiot") == [2 * plain, plain] and score("a calm day") == []


@pytest.mark.parametrize("text,want", [
    # a threat needs somebody it is for
    ("kill", []), ("this will kill time", []), ("the frost will kill the plants", []),
    ("kill the process", []), ("we shall beat the clock", []),
    ("kill you", [W]), ("kill all of them", [W]), ("i kill you", [W * X.SUBJECT_GAIN]),
    ("i will kill you", [W * X.MODAL_GAIN]), ("i'll hurt you", [W * X.MODAL_GAIN]),
    ("i’ll hurt you", [W * X.MODAL_GAIN]), ("they will attack you", [W * X.MODAL_GAIN]),
    ("i will not kill you", [W * X.MODAL_GAIN * X.NEGATED]),
    ("kill one two three you", []), ("kill. you", []),
    # an insult is aimed by what stands before it or behind it
    ("you idiot", [W * X.AIMED]), ("an idiot like you", [W + X.BEHIND * W]),
    ("idiot, you are", [W + X.BEHIND * W]), ("you're an idiot", [W * X.AIMED * X.PREDICATED]),
    ("idiot one two three you", [W]), ("idiot! you there", [W]),
    # what is reported, before and behind the report
    ("he said: you idiot", [W * X.AIMED * X.REPORTED]),
    ('he said: "you idiot"', [W * X.AIMED * X.REPORTED]),
    ('"you idiot", he said', [W * X.AIMED * X.REPORTED]),
    ('"you idiot!" he said', [W * X.AIMED * X.REPORTED]),
    ("«idiot. moron», wrote the other", [2 * W * X.REPORTED]),
    ('"a calm day", he said. you idiot', [W * X.AIMED]),
    ("one: you idiot", [W * X.AIMED]), ('"idiot\nhe said so', [W]),
    ("you idiot, he said", [W * X.AIMED]),  # nothing is quoted
])
def test_minimal_pairs(text, want):
    assert score(text) == pytest.approx(want)


def plain_score(text, learned):
    """The scores of the clauses, word by word from the rules, without a machine."""
    grammar = X.Grammar(learned)
    read = [x for w in X.TOKEN.findall(text.lower()) for x in grammar.symbol(w)]
    scores, parts, clause, quoted, told = [], [], [], "", False

    def close():
        if sum(parts) > 0:
            scores.append(sum(parts))
        parts.clear()

    def since(*stop):  # the symbols of the clause after the last of these
        for k in range(len(clause) - 1, -1, -1):
            if clause[k][0] in stop:
                return clause[k + 1:]
        return None

    last, back, told_since_quote = 0.0, 99, False
    for s, weight in read:
        sentence = since(X.BOUNDARY) if since(X.BOUNDARY) is not None else clause
        held, clause_all = clause, clause
        clause = sentence  # rules of words look back to the last sentence end
        neg = since(X.NEGATION)
        factor = X.NEGATED if neg is not None and len(neg) < X.NEGATION_REACH else 1.0
        factor *= X.REPORTED if told else 1.0
        aimed = X.AIMED if any(c[0] == X.TARGET for c in clause) else 1.0
        kind, left = "", 0
        for c, _ in clause:  # the insult rule
            if c == X.INSULT:
                kind, left = ("", 0) if kind in ("target", "predicate") else (
                    "seen", X.TARGET_REACH)
            elif c == X.TARGET:
                kind, left = "target", 1
            elif c == X.COPULA and kind in ("target", ""):
                kind, left = ("predicate", X.PREDICATE_REACH) if kind else ("", 0)
            else:
                left -= 1
                kind = kind if left > 0 else ""
        verb, room = "", 0
        for c, _ in clause:  # the threat rule
            if c in (X.TARGET, X.SUBJECT):
                verb, room = "subject", 2
            elif c == X.THREAT:
                verb, room = {"subject": "s", "modal": "m"}.get(verb, "v") + "erb", X.TARGET_REACH
            elif c == X.PROMISE or (c == X.MODAL and verb in ("subject", "modal")):
                verb, room = "modal", 3
            else:
                room -= 1
                verb = verb if room > 0 else ""
        clause = held
        if s == X.REPORT and quoted != "open" and back < X.REPORT_REACH and not told:
            parts[:] = [p * X.REPORTED for p in parts]
            last *= X.REPORTED
        if s == X.INSULT:
            last = weight * factor * aimed * (X.PREDICATED if kind == "predicate" else 1.0)
            parts.append(last)
        if s == X.TARGET:
            if kind == "seen":
                parts.append(X.BEHIND * last * factor)
            gain = {"verb": 1.0, "serb": X.SUBJECT_GAIN, "merb": X.MODAL_GAIN}.get(verb)
            if gain:
                parts.append(X.SEED_WEIGHT * X.THREAT_WEIGHT * gain * factor)
        stays = (s == X.BOUNDARY and quoted == "open") or (
            s == X.COLON and (told or quoted == "open"))
        if s == X.LINE or (s in (X.BOUNDARY, X.COLON) and not stays):
            close()
            # a colon ends a clause for its score, not for what its words refer to
            clause = [*clause_all, (s, weight)] if s == X.COLON else []
            told, quoted, back, last = False, "", 99, 0.0
            continue
        clause = [*clause_all, (s, weight)]
        if s == X.QUOTE:
            quoted, back = ("closed", 0) if quoted == "open" else ("open", 99)
        elif s == X.REPORT:
            told, back = True, 99
        elif not stays:
            back += 1
    close()
    return scores


def test_composed_machine_against_the_rules():
    rnd = np.random.default_rng(3)
    words = [w for v in X.WORDS.values() for w in v.split()[:2]] + list(X.MARKS) + [
        "you're", "word", "other", "learned", "stemming", "you", "idiot", "kill", '"', ","]
    learned = {"learned": 3.5, "stem*": 1.25}
    for _ in range(1500):
        text = " ".join(rnd.choice(words, size=rnd.integers(1, 14)))
        assert score(text, learned) == pytest.approx(plain_score(text, learned)), text


def test_whole_score_is_the_logistic_function_of_the_clauses(spark):
    import math

    texts = ["you idiot. a calm day", None, "", "i will kill you; idiot\nfool", "a b c."]
    docs = documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in X.score(docs, none).collect()}
    for i, t in enumerate(texts):
        scores = plain_score(t or "", {})
        ends = sum(c in ".!?;|\n" for c in t or "")
        x = (1, math.log1p(sum(scores)), math.log1p(max(scores, default=0)),
             math.log1p(len(scores)), math.log1p(10 * sum(scores) / (1 + ends)))
        z = sum(a * b for a, b in zip(X.DEFAULT_FIT, x, strict=True))
        assert got[i] == pytest.approx(1 / (1 + math.exp(-z)))


def test_composition_reaches_a_bounded_table():
    machine = X.compose()
    assert len(machine) < 10_000 and all(len(row) == 14 for row in machine)
    assert all(row[X.LINE][0] == 0 and row[X.LINE][5] for row in machine)
    assert all(not row[X.OTHER][1] and not row[X.OTHER][3] for row in machine)


def test_learned_stems_match_the_longest():
    g = X.Grammar({"abcd*": 1.5, "abcdef*": 3.0, "abcdefgh": 4.0})
    assert [g.symbol(w)[0][1] for w in ("abcde", "abcdefg", "abcdefgh", "abcd", "xabcdef")] == [
        1.5, 3.0, 4.0, 0.0, 0.0]


def test_logistic_fit():
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(4000, 2))
    y = (rnd.random(4000) < 1 / (1 + np.exp(-(1 + 2 * x[:, 0] - x[:, 1])))).astype(float)
    assert np.allclose(X.fit_logistic(x, y), [1, 2, -1], atol=0.2)


def test_held_out_accuracy(spark):
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = X.op10_toxicity(spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= X.PREDICT_AT) for r in got)
    held = [(toxic[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in toxic]
    caught = sum(y and p for y, p in held)
    assert caught >= 0.85 * sum(y for y, _ in held)
    assert caught >= 0.95 * sum(p for _, p in held)


def test_awkward_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (None, 1), (4, None), (7, 0), (3, 1), (99, 1)], "doc_id long, toxic int")
    for given in (labels, labels.where("false")):
        got = X.score(docs, given).collect()
        assert len(got) == len(DOCUMENTS) and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id == 1}) == 1
    assert X.score(empty(spark), labels).count() == 0


def test_sample_is_bounded_and_skips_held_out_rows(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("toxic"))
    rows = X.labelled_sample(docs.withColumn("text", F.col("doc_id").cast("string")), labels, 200)
    ids = [int(r.text) for r in rows.collect()]
    assert 300 < len(ids) < 500 and not any(crc32(str(i).encode()) % 3 == 1 for i in ids)
