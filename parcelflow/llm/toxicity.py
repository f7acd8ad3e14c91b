"""Operator 10: toxicity by a weighted finite-state pattern grammar.

Words and marks are read as symbols (insult, threat verb, subject, modal, copula, target,
negation, report, quote, colon, ends of clauses and lines, other).  Five transducers
follow them, each over what it needs to know of a clause:

- insult: an insult counts by its weight, more as a predicate of a target ("you are an
  idiot"); a target within a few words behind it adds to it ("an idiot like you",
  "idiot, you are");
- threat: a threat verb counts once a target follows within a few words, more after a
  subject, most after subject and modal ("i will kill you"); without a target ("kill
  time", "the frost will kill the plants") it counts nothing;
- target: a target before a match raises it;
- negation: lowers the matches of the next words;
- reported speech: a report verb lowers what follows in the clause, over a colon too
  ("he said: you idiot"), and what was quoted just before it ('"you idiot!" he said');
  a sentence that ends inside quotation marks does not end the clause.

:func:`compose` builds their product once: one table of (state, symbol) -> (state,
outputs); a clause's score is the sum of what its path puts out.  A document's score is a
logistic function of its clause scores (their sum, the highest, how many and how dense),
never of single words.

Learning uses a bounded sample of the labelled rows: on one half, the words and
word stems that stand in toxic documents far more often enter the insult lexicon
with their log odds; on the other half the logistic function is fitted.  Lexicon
and function are small by their parameters.

Defined results: NULL, empty and unmatched texts get the score of no clause;
texts are read whole; without a labelled row the seed words and a default
function serve; a label over 0 is toxic, labels of one document that differ count as
toxic; repeated rows give equal rows; an empty table gives an empty table.  Only the id,
text and label columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm.common import doc_crc, on_executors, table, text_slices

#: Labelled rows of each class that are learned from, at most (in expectation).
SAMPLE_PER_CLASS = 15_000
#: Entries of the learned lexicon, at most.
LEXICON = 4_000
LEAST_DOCUMENTS, LEAST_ODDS = 6, 6.0
STEMS = range(4, 9)
PREDICT_AT = 0.7

(BOUNDARY, OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, SUBJECT, MODAL, PROMISE, COPULA,
 QUOTE, COLON, LINE) = range(14)
# The hand-written part of the lexicon.
WORDS = {
    INSULT: "idiot idiots stupid moron morons loser losers scum trash pathetic worthless "
            "disgusting clown fool dumb imbecile coward creep",
    THREAT: "kill hurt destroy beat shoot burn stab attack punch töten tuer matar",
    TARGET: "you your yours yourself he she they him her these those people du dich dein "
            "ihr euch sie tu toi ton vous votre usted ustedes ellos them everyone",
    NEGATION: "not never no nobody isn't aren't don't doesn't won't nicht kein keine niemals pas "
              "jamais nunca tampoco",
    REPORT: "said says wrote writes claimed claims called quoted quote reported according "
            "sagte schrieb dit écrit dijo escribió",
    SUBJECT: "i we ich wir je nous yo nosotros",
    MODAL: "will shall gonna going must should werde werden vais allons voy vamos",
    PROMISE: "i'll we'll they'll he'll she'll",
    COPULA: "are is am was were be you're they're he's she's bist seid ist sind es êtes sont eres son",
}
MARKS = {".": BOUNDARY, "!": BOUNDARY, "?": BOUNDARY, ";": BOUNDARY, "|": BOUNDARY, ":": COLON,
         "\n": LINE} | dict.fromkeys('"“”«»', QUOTE)
#: Contracted words that name their target themselves.
TARGET_COPULA = frozenset(("you're", "they're", "he's", "she's"))
SEED_WEIGHT, THREAT_WEIGHT = 2.0, 1.0
NEGATED, REPORTED, AIMED, PREDICATED = 0.3, 0.5, 1.3, 1.2
#: What a target behind an insult adds of it; what subject and modal add to a threat.
BEHIND, SUBJECT_GAIN, MODAL_GAIN = 0.3, 1.2, 1.5
NEGATION_REACH, TARGET_REACH, PREDICATE_REACH, REPORT_REACH = 3, 3, 3, 3
TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[.!?;:|\n\"“”«»]")
MATCHED = (INSULT, THREAT)
ENDS = (BOUNDARY, LINE)


@dataclass(frozen=True)
class Transducer:
    """``step(state, symbol)`` gives the next state and what the step puts out, by name:

    ``now``, a factor of the symbol's own weight; ``behind``, a factor of the last match;
    ``add``, a weight of its own; ``times``, a factor of all three; ``total``, a factor
    of the clause so far; ``runs_on``, that the clause does not end here."""
    start: object
    step: Callable


def insult(state, symbol):
    """(kind, words left): a target, a target with its copula, an insult that has none
    before it."""
    kind, left = state
    if symbol in ENDS:
        return ("", 0), {}
    if symbol == INSULT:
        aimed = kind in ("target", "predicate")  # whom it is for stands before it
        return (("", 0) if aimed else ("seen", TARGET_REACH),
                {"now": PREDICATED if kind == "predicate" else 1.0})
    if symbol == TARGET:
        return ("target", 1), {"behind": BEHIND} if kind == "seen" else {}
    if symbol == COPULA and kind in ("target", ""):
        return (("predicate", PREDICATE_REACH) if kind else ("", 0)), {}
    return ((kind, left - 1) if left > 1 else ("", 0)), {}


def threat(state, symbol):
    """(kind, words left): subject, subject with modal, verb by what stood before it."""
    kind, left = state
    if symbol in ENDS:
        return ("", 0), {}
    if symbol == TARGET:
        out = {"verb": 1.0, "subject verb": SUBJECT_GAIN, "modal verb": MODAL_GAIN}.get(kind)
        return ("subject", 2), {"add": SEED_WEIGHT * THREAT_WEIGHT * out} if out else {}
    if symbol == THREAT:
        return ({"subject": "subject verb", "modal": "modal verb"}.get(kind, "verb"), TARGET_REACH), {}
    if symbol == SUBJECT:
        return ("subject", 2), {}
    if symbol == PROMISE or (symbol == MODAL and kind in ("subject", "modal")):
        return ("modal", 3), {}
    return ((kind, left - 1) if left > 1 else ("", 0)), {}


def target(state, symbol):
    after = 0 if symbol in ENDS else 1 if symbol == TARGET else state
    return after, {"times": AIMED} if state and symbol == INSULT else {}


def negation(state, symbol):
    after = (0 if symbol in ENDS else NEGATION_REACH if symbol == NEGATION
             else max(state - 1, 0))
    return after, {"times": NEGATED} if state else {}


def report(state, symbol):
    """(reported, quotation): no quotation, an open one, or one closed k words ago."""
    reported, quoted = state
    out = {"times": REPORTED} if reported else {}
    if symbol == LINE:
        return (False, 0), {}
    if symbol == BOUNDARY:
        return ((reported, quoted), {"runs_on": True}) if quoted == "open" else ((False, 0), {})
    if symbol == COLON:  # what is reported goes on behind a colon
        return ((reported, quoted), {"runs_on": True}) if reported or quoted == "open" else (
            (False, 0), {})
    if symbol == QUOTE:
        return (reported, REPORT_REACH if quoted == "open" else "open"), out
    if symbol == REPORT:
        back = quoted != "open" and quoted > 0 and not reported
        return (True, quoted if quoted == "open" else 0), {"total": REPORTED} if back else out
    return (reported, quoted if quoted == "open" else max(quoted - 1, 0)), out


TRANSDUCERS = (Transducer(("", 0), insult), Transducer(("", 0), threat), Transducer(0, target),
               Transducer(0, negation), Transducer((False, 0), report))
#: next state, now, behind, add, total, whether the clause ends
Move = tuple[int, float, float, float, float, bool]


@cache  # once a process
def compose(machines: tuple[Transducer, ...] = TRANSDUCERS) -> list[list[Move]]:
    """The product machine: the moves of every state that can be reached, by symbol.
    State 0 is the start."""
    start = tuple(m.start for m in machines)
    number, rows, states = {start: 0}, [], [start]
    for state in states:  # grows while it is read
        row = []
        for symbol in range(len(WORDS) + 5):
            moves = [m.step(x, symbol) for m, x in zip(machines, state, strict=True)]
            after = tuple(x for x, _ in moves)
            if after not in number:
                number[after] = len(states)
                states.append(after)
            put = lambda name, f=moves: [o[name] for _, o in f if name in o]
            times = math.prod(put("times"))
            runs_on = any(put("runs_on"))
            row.append((number[after], sum(put("now")) * times, sum(put("behind")) * times,
                        sum(put("add")) * times, math.prod(put("total")),
                        symbol in (*ENDS, COLON) and not runs_on))
        rows.append(row)
    return rows


class Grammar:
    """The composed machine with a lexicon: word or ``stem*`` -> weight."""

    def __init__(self, learned: dict[str, float]):
        self.machine = compose()
        self.learned = learned
        self.known: dict[str, tuple[tuple[int, float], ...]] = {
            c: ((symbol, 0.0),) for c, symbol in MARKS.items()}
        for symbol, words in WORDS.items():
            for w in words.split():
                read = (symbol, SEED_WEIGHT if symbol in MATCHED else 0.0)
                self.known[w] = ((TARGET, 0.0), read) if w in TARGET_COPULA else (read,)
        self.known |= {w: ((INSULT, x),) for w, x in learned.items() if not w.endswith("*")}
        self.symbols: dict[str, tuple[tuple[int, float], ...]] = {}

    def symbol(self, word: str) -> tuple[tuple[int, float], ...]:
        """What a word is read as: a symbol with its weight (a contraction: two)."""
        found = self.known.get(word.replace("’", "'"))
        if not found:  # the longest learned stem
            stem = next((self.learned[s] for k in reversed(STEMS) if len(word) > k
                         and (s := word[:k] + "*") in self.learned), None)
            found = ((OTHER, 0.0) if stem is None else (INSULT, stem),)
        if len(self.symbols) > 500_000:
            self.symbols.clear()
        self.symbols[word] = found
        return found

    def clause_scores(self, text: str) -> tuple[list[float], int]:
        """The scores of the matched clauses, and the number of all clauses."""
        get, symbol, machine = self.symbols.get, self.symbol, self.machine
        read = [x for w in TOKEN.findall(text.lower()) for x in get(w) or symbol(w)]
        clauses = 1 + sum(s in ENDS for s, _ in read)
        if not any(s in MATCHED for s, _ in read):
            return [], clauses
        scores, state, score, last = [], 0, 0.0, 0.0
        for s, weight in read:
            state, now, behind, add, total, ends = machine[state][s]
            if total != 1.0:
                score *= total
                last *= total
            score += behind * last + add
            if now:
                last = weight * now
                score += last
            if ends:
                if score > 0:
                    scores.append(score)
                score = last = 0.0
        if score > 0:
            scores.append(score)
        return scores, clauses

    def features(self, text: str | None) -> tuple[float, ...]:
        scores, clauses = self.clause_scores(text or "")
        total = sum(scores)
        return (math.log1p(total), math.log1p(max(scores, default=0.0)),
                math.log1p(len(scores)), math.log1p(10 * total / clauses))


#: Intercept and coefficients when nothing can be learned.
DEFAULT_FIT = (-4.0, 2.0, 1.0, 0.5, 0.5)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0,
                 rounds: int = 30) -> tuple[float, ...]:
    """Newton's method with an L2 penalty (not on the intercept)."""
    x = np.c_[np.ones(len(x)), x]
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty,
                               x.T @ (y - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """text, toxic, half: about ``sample`` documents a class, by a hash of the id.
    The sampled labels are bounded by ``sample``, so they may be broadcast.  Rows
    that share an id count once, with the text that sorts first."""
    marked = (labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id")
              .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
              .filter(F.pmod(doc_crc(), F.lit(3)) != 1))
    sizes = {r.toxic: r.n for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    share = F.lit(0.0)
    for k, n in sizes.items():
        share = F.when(F.col("toxic") == k, F.lit(min(1.0, sample / n))).otherwise(share)
    picked = marked.filter(hashed < share * (1 << 20)).select(
        F.col("doc_id").alias("_labelled"), "toxic",
        F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)).alias("half"))
    return (docs.select("doc_id", "text").join(F.broadcast(picked),
                                               F.col("doc_id") == F.col("_labelled"))
            .groupBy("doc_id", "toxic", "half").agg(F.min("text").alias("text"))
            .select("text", "toxic", "half"))


def _count_features(batches):
    schema = pa.schema([("toxic", pa.int32()), ("feature", pa.string()), ("n", pa.int64())])
    held = (Counter(), Counter())

    def flush():
        for y, c in enumerate(held):
            yield pa.RecordBatch.from_pydict(
                {"toxic": [y] * len(c), "feature": list(c), "n": list(c.values())}, schema)
            c.clear()

    for b in text_slices(batches):
        for text, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(),
                           strict=True):
            words = set(TOKEN.findall((text or "").lower()))
            stems = {w[:k] + "*" for w in words for k in STEMS if len(w) > k}
            held[int(y > 0)].update(words | stems)
        if sum(map(len, held)) > 500_000:
            yield from flush()
    yield from flush()


def learn(docs: DataFrame, labels: DataFrame,
          sample: int = SAMPLE_PER_CLASS) -> tuple[dict[str, float], tuple[float, ...]]:
    """The learned lexicon and the logistic function."""
    rows = labelled_sample(docs, labels, sample)
    first, second = rows.filter("half = 0"), rows.filter("half = 1")
    size = {r.y: r.n for r in first.groupBy((F.col("toxic") > 0).cast("int").alias("y"))
            .agg(F.count("*").alias("n")).collect()}
    if not size.get(0) or not size.get(1):
        return {}, DEFAULT_FIT
    odds = ((F.col("toxic_n") + 0.5) / (size[1] + 1)) / ((F.col("clean_n") + 0.5) / (size[0] + 1))
    counted = (on_executors(first.select("text", "toxic"))
               .mapInArrow(_count_features, "toxic int, feature string, n long")
               .groupBy("feature").agg(
                   F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic_n"),
                   F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("clean_n"))
               .filter(F.col("toxic_n") >= LEAST_DOCUMENTS).withColumn("odds", odds)
               .filter(F.col("odds") >= LEAST_ODDS)
               .orderBy(F.desc("odds"), F.desc("toxic_n"), "feature").limit(LEXICON))
    lexicon = {r.feature: math.log(r.odds) for r in counted.select("feature", "odds").collect()
               if r.feature not in MARKS}
    graded = grade(second.select(F.col("toxic").alias("row"), "text"), lexicon).select(
        "row", "features").toPandas()
    y = (graded["row"].to_numpy() > 0).astype(float)
    if not 0 < y.sum() < len(y):
        return lexicon, DEFAULT_FIT
    return lexicon, fit_logistic(np.array(graded["features"].tolist()), y)


def grade(rows: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """``row`` and the clause ``features`` of ``text``."""
    kind = rows.schema["row"].dataType.simpleString()

    def run(batches):
        grammar = Grammar(lexicon)
        for b in text_slices(batches):
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array([grammar.features(t) for t in
                                            b.column("text").to_pylist()],
                                           pa.list_(pa.float64()))], ["row", "features"])

    return on_executors(rows.select("row", "text")).mapInArrow(
        run, f"row {kind}, features array<double>")


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """doc_id, score, predicted for every row of ``docs``."""
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"),
                       docs[text].cast("string").alias("text"))
    lexicon, fit = learn(rows, labels)
    weighted = F.lit(fit[0])
    for k, w in enumerate(fit[1:]):
        weighted = weighted + F.lit(w) * F.element_at("features", k + 1)
    value = 1 / (1 + F.exp(-weighted))
    return (grade(rows.withColumnRenamed("doc_id", "row"), lexicon)
            .select(F.col("row").alias("doc_id"), value.alias("score"))
            .withColumn("predicted", (F.col("score") >= PREDICT_AT).cast("int")))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", F.coalesce(F.pmod(doc_crc(), F.lit(3)) == 1, F.lit(False))
                        .alias("held_out"), "score", "predicted")
