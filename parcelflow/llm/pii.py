"""Operator 3: personal data and the terms that give it away.

Base spans are e-mail addresses, IP addresses, card and phone numbers.  Their
values are the protected entities.  Information-theoretic sanitisation then asks
of each term of a document with an entity how much it reveals of it.  With N distinct
texts (copies say no more), H of them with an entity, and a term in n and h of these,

    q(t) = (n + h) / (N + H)               the term's share; texts with entities count
                                           twice, as the term is one of theirs
    p(t | e) = (both + PRIOR q) / (m + PRIOR)    among the m texts that hold the entity,
                                           after PRIOR more like q: one says less than many
    reveals(t, e) = log2(p(t | e) / q(t))
    most(e)                                the same of a term that stands in e's texts only

A term that reveals at least DISCLOSED of what a term can reveal of the entity is
generalised, one that reveals at least IDENTIFYING of it is removed.  Both shares can be
reached at every N.  A rare word is no evidence by itself, in one text every rare word is
rare: the term must also meet the entity in two texts, stand within NEAR terms of a
mention, or stand in the entity's text more than once.  What counts is marked everywhere
outside the base spans, in each document that holds the entity.  A generalised term gives
way to its longest beginning that WIDE terms share and that hence tells less
(:func:`sanitise`).

The texts that have copies are counted by a hash first.  A first pass over the
texts writes, per document, the base spans and entities, the text where it has any,
and per task the document frequencies of its terms, each of n copies as 1 / n.
Entities that stand in the same documents have the same counts and are one class.
A second pass over the distinct texts with entities writes their terms with positions
and classes.  As p(t | e) is 1 at most, a term of too many documents cannot be
telling; the terms that more than a share of FREQUENT of all
documents hold (1 / FREQUENT times the terms of an average document, at most) are
sent to the tasks, which write none of the pairs so ruled out.  Co-occurrences are
counted by partial aggregation and joined to the frequencies; counts are written
before a join, so that Spark broadcasts them by size or splits the partition of a
frequent term.

Defined results: NULL text counts as empty; positions are code points, the end is
exclusive; failing matches are dropped without another try; texts are read whole;
repeated rows give equal rows; an empty table gives an empty table.  Only the id
and text columns are read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from hashlib import blake2b
from itertools import accumulate

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm.common import arrow_batch, on_executors, table, text_slices
from parcelflow.session import stored

KINDS = ("email", "ip", "card", "phone", "general", "remove")
#: Documents like the whole corpus that the share of an entity is smoothed with.
PRIOR = 1.0
DISCLOSED, IDENTIFYING = 0.6, 0.9
#: Distinct terms a task counts before it passes its counts on.
HELD_TERMS = 400_000
#: Share of all documents above which the tasks of the second pass know a term.
FREQUENT = 0.01
#: Terms on either side of a mention that are near it.
NEAR = 8
#: Terms that must share a beginning for it to stand for them; its least letters.
WIDE, LEAST_LETTERS = 10, 3

# The base patterns.  Each digit run is possessive: a match that
# fails after a run fails from every later digit of the run too.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TERM = re.compile(r"[^\W\d_]{3,}")
DIGITS = re.compile(r"[0-9]")


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of local+ @ domain from the left.  The local part is all local
    characters before the @ back to the last match, found from the right, so that
    a long run without an @ is read once."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        before = text[last:at]
        local = len(before) - len(before.rstrip(LOCAL))
        found = DOMAIN.match(text, at + 1) if local else None
        if found:
            out.append((at - local, found.end()))
            last = found.end()
        else:
            last = at + 1
        at = text.find("@", last)
    return out


def luhn(digits: str) -> bool:
    double = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(double)) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, entity) by kind and start."""
    out = [(0, a, b, text[a:b].lower()) for a, b in emails(text)] if "@" in text else []
    if DIGITS.search(text):
        for m in IP.finditer(text):
            parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
            if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                out.append((1, m.start(), m.end(), m[0]))
        for m in CARD.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end(), digits))
        if "+" in text:
            for m in PHONE.finditer(text):
                digits = re.sub("[^0-9]", "", m[0])
                if 9 <= len(digits) <= 15:
                    out.append((3, m.start(), m.end(), digits))
    return out


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(),
                          "little", signed=True)


def terms_of(text: str) -> set[str]:
    return {w.lower() for w in set(TERM.findall(text))}


def occurrences(text: str) -> tuple[dict[str, list[tuple[int, int]]], dict[int, set[str]]]:
    """(start, end) of each term of the text, those in base spans left out; and of each
    entity the terms near its mentions."""
    found = base_spans(text)
    spans = sorted(s[1:3] for s in found)
    begins, ends = [a for a, _ in spans], list(accumulate((b for _, b in spans), max))
    words, out = [], {}
    for m in TERM.finditer(text):
        at = out.setdefault(m[0].lower(), [])
        k = bisect_left(begins, m.end()) - 1
        if k < 0 or ends[k] <= m.start():
            at.append(m.span())
            words.append((m.start(), m[0].lower()))
    starts, near = [a for a, _ in words], {}
    for kind, a, _, entity in found:
        k = bisect_left(starts, a)
        near.setdefault(_hash(f"{kind}:{entity}"), set()).update(
            w for _, w in words[max(0, k - NEAR):k + NEAR])
    return out, near


SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
SCAN = pa.schema([("doc_id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()),
                  ("copy", pa.int64()), ("base", pa.list_(SPAN)),
                  ("entities", pa.list_(pa.int64())), ("text", pa.string()),
                  ("term", pa.string()), ("n", pa.float64()), ("held", pa.float64())])
SCAN_DDL = ("doc_id long, k1 long, k2 long, copy long, "
            "base array<struct<kind:int,start:long,end:long>>, "
            "entities array<long>, text string, term string, n double, held double")


def _scan(batches):
    def counted() -> pa.RecordBatch:
        none = [None] * len(every)
        out = arrow_batch(SCAN, **{n: none for n in SCAN.names} | {
            "term": list(every), "n": [float(n) for n in every.values()],
            "held": [float(held.get(t, 0)) for t in every]})
        every.clear()
        held.clear()
        return out

    every: Counter = Counter()  # terms of all texts, and of those with an entity
    held: Counter = Counter()
    for b in text_slices(batches):
        base, entities, texts = [], [], []
        for text, copies in zip(b.column("text").to_pylist(), b.column("copies").to_pylist(),
                                strict=True):
            spans = base_spans(text or "")
            base.append([dict(zip(SPAN.names, s[:3], strict=True)) for s in spans])
            entities.append(sorted({_hash(f"{s[0]}:{s[3]}") for s in spans}))
            texts.append(text if spans else None)
            terms = terms_of(text or "")
            for counter in (every, held) if spans else (every,):
                counter.update(terms if copies == 1 else dict.fromkeys(terms, 1 / copies))
        none = [None] * b.num_rows
        yield arrow_batch(SCAN, **{c: b.column(c) for c in ("doc_id", "k1", "k2", "copy")},
                          base=base, entities=entities, text=texts, term=none, n=none, held=none)
        if len(every) > HELD_TERMS:
            yield counted()
    if every:
        yield counted()


CLASS = pa.struct([("class", pa.int64()), ("documents", pa.int64()), ("evident", pa.bool_())])
PLACE = pa.struct([("start", pa.int64()), ("end", pa.int64())])
TERMS = pa.schema([("copy", pa.int64()), ("term", pa.string()),
                   ("classes", pa.list_(CLASS)), ("places", pa.list_(PLACE))])
TERMS_DDL = ("copy long, term string, "
             "classes array<struct<class:long,documents:long,evident:boolean>>, "
             "places array<struct<start:long,end:long>>")


def most_bits(mentions: float, total: int, held: int, prior: float) -> float:
    """What a term that stands in an entity's ``mentions`` texts only reveals of it."""
    q = 2 * mentions / (total + held)
    return math.log2((mentions + prior * q) / (mentions + prior) / q)


def _terms(frequent: Broadcast, total: int, held: int, prior: float, disclosed: float):
    """The terms of each text, with the classes they could tell of, and whether the text
    is evidence for that: the term is near a mention or there more than once."""
    def run(batches):
        common = frequent.value
        for b in text_slices(batches):
            for copy, text, entities in zip(*(b.column(c).to_pylist() for c in (
                    "copy", "text", "classes")), strict=True):
                found, near = occurrences(text)
                classes: dict[int, tuple[int, float, set]] = {}
                for e in entities:
                    bits = most_bits(e["documents"], total, held, prior)
                    if bits > 0:
                        classes.setdefault(e["class"], (
                            e["documents"], disclosed * bits - 1e-9, set()))[2].update(
                            near.get(e["entity"], ()))
                rows = []
                for term, at in found.items():
                    most = (math.log2((total + held) / (common[term] + 1)) if term in common
                            else math.inf)
                    some = [{"class": c, "documents": n, "evident": len(at) > 1 or term in beside}
                            for c, (n, least, beside) in classes.items() if least <= most]
                    if some and at:
                        rows.append((term, some, [dict(start=x, end=y) for x, y in at]))
                if rows:
                    terms, some, places = zip(*rows, strict=True)
                    yield arrow_batch(TERMS, copy=[copy] * len(rows), term=terms, classes=some,
                                      places=places)

    return run


def broader_terms(terms: DataFrame, frequency: DataFrame, wide: int = WIDE,
                  least: int = LEAST_LETTERS) -> DataFrame:
    """term, broader: the longest beginning, of ``least`` letters at least, that ``wide``
    terms share; terms without one are not there."""
    size = F.length("term")
    begins = lambda df: df.filter(size > least).select("term", F.explode(F.transform(
        F.sequence(F.lit(least), size - 1), lambda k: F.substring("term", F.lit(1), k)))
        .alias("broader"))
    asked = stored(begins(terms), "beginnings")
    shared = (begins(frequency.select("term")).join(asked.select("broader").distinct(), "broader",
                                                    "left_semi")
              .groupBy("broader").agg(F.count("*").alias("terms")).filter(F.col("terms") >= wide))
    return asked.join(shared, "broader").groupBy("term").agg(
        F.max_by("broader", F.length("broader")).alias("broader"))


def find(docs: DataFrame, prior: float = PRIOR, disclosed: float = DISCLOSED,
         identifying: float = IDENTIFYING, doc_id: str = "doc_id",
         text: str = "text") -> DataFrame:
    """doc_id, k1, k2 (hash of id and text) and ``found``: all spans by kind and
    start, ``kind`` an index into KINDS; ``broader`` is what a generalised term gives way
    to (NULL: nothing broad enough)."""
    body = docs[text].cast("string")
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"),
                       F.xxhash64(docs[doc_id], body).alias("k1"),
                       F.xxhash64(F.lit("second"), body, docs[doc_id]).alias("k2"),
                       F.xxhash64(F.coalesce(body, F.lit(""))).alias("copy"), body.alias("text"))
    copies = stored(rows.groupBy("copy").agg(F.count("*").alias("copies"))
                    .filter("copies > 1"), "copies")
    counted = rows.join(copies, "copy", "left").fillna(1, "copies")
    scanned = stored(on_executors(counted).mapInArrow(_scan, SCAN_DDL), "pii")
    each = scanned.filter("term is null").select("doc_id", "k1", "k2", "copy", "base")
    more = copies.agg(F.sum(F.col("copies") - 1)).first()[0] or 0
    total = each.count() - more  # distinct texts
    held = stored(scanned.filter("text is not null").select("copy", "entities", "text")
                  .dropDuplicates(["copy"]), "held")
    mentions = held.select("copy", F.explode("entities").alias("entity"))
    # entities of the same texts: equal number, equal sums of the texts' hashes
    sums = [F.sum(h.cast("decimal(20,0)")) for h in (F.col("copy"), F.xxhash64("copy"))]
    entities = stored(mentions.groupBy("entity")
                      .agg(F.count("*").alias("documents"), F.xxhash64(F.count("*"), *sums)
                           .alias("class")), "entities")
    classes = stored(mentions.join(entities, "entity").groupBy("copy").agg(
        F.collect_set(F.struct("entity", "class", "documents")).alias("classes")), "classes")
    frequency = stored(scanned.filter("term is not null").groupBy("term").agg(
        F.round(F.sum("n")).cast("long").alias("documents"),
        F.round(F.sum("held")).cast("long").alias("held")), "frequency")
    frequent = docs.sparkSession.sparkContext.broadcast(
        {r.term: r.documents for r in
         frequency.filter(F.col("documents") > FREQUENT * total).collect()})
    some = held.count()
    near = stored(held.join(classes, "copy").select("copy", "text", "classes").mapInArrow(
        _terms(frequent, total, some, prior, disclosed), TERMS_DDL), "near")
    one = F.explode("classes").alias("c")
    pairs = stored(near.select("term", one).groupBy(
        "term", F.col("c.class").alias("class"), F.col("c.documents").alias("mentions"))
        .agg(F.count("*").alias("together"), F.max("c.evident").alias("evident"))
        .filter("evident or together > 1"), "pairs")
    q = (F.col("documents") + F.col("held")) / F.lit(float(max(total + some, 1)))
    own = 2 * F.col("mentions") / F.lit(float(max(total + some, 1)))
    bits = lambda both, share: F.log2(
        (both + prior * share) / (F.col("mentions") + prior) / share)
    telling = pairs.join(frequency, "term").withColumns({
        "most": bits(F.col("mentions"), own), "reveals": bits(F.col("together"), q)}).filter(
        (F.col("most") > 0) & (F.col("reveals") >= disclosed * F.col("most"))).select(
        "term", "class", F.when(F.col("reveals") >= identifying * F.col("most"), 5)
        .otherwise(4).alias("kind"))
    telling = stored(telling, "telling")
    general = telling.filter("kind = 4").select("term").distinct()
    broader = stored(broader_terms(general, frequency), "broader")
    marked = stored(near.select("copy", "term", "places", one)
                    .withColumn("class", F.col("c.class")).join(telling, ["term", "class"])
                    .groupBy("copy", "term", "places").agg(F.max("kind").alias("kind"))
                    .select("copy", "term", "kind", F.inline("places")), "marked")
    spelt = F.when(F.col("kind") == 4, F.col("broader")).alias("broader")
    added = stored(marked.join(broader, "term", "left")
                   .select("copy", F.struct("kind", "start", "end", spelt).alias("span"))
                   .groupBy("copy").agg(F.collect_list("span").alias("added")), "added")
    kinds = "array<struct<kind:int,start:bigint,end:bigint,broader:string>>"
    none = F.array().cast(kinds)
    base = F.transform("base", lambda x: F.struct(
        x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
        F.lit(None).cast("string").alias("broader"))).alias("base")
    each = each.select("doc_id", "k1", "k2", "copy", base)
    found = F.array_sort(F.concat("base", F.coalesce("added", none))).alias("found")
    with_spans = each.filter("size(base) > 0").join(added, "copy", "left")
    return with_spans.select("doc_id", "k1", "k2", found).unionByName(
        each.filter("size(base) = 0").select("doc_id", "k1", "k2", F.col("base").alias("found")))


def sanitise(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id",
             text: str = "text") -> DataFrame:
    """doc_id and the text with the spans of :func:`find` replaced: entities by
    their kind, generalised terms by their broader beginning and ``*`` (by <TERM> without
    one), removed ones by nothing."""
    body = docs[text].cast("string")
    spans = found.dropDuplicates(["k1", "k2"]).select("k1", "k2", "found")
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), body.alias("text"),
                       F.xxhash64(docs[doc_id], body).alias("k1"),
                       F.xxhash64(F.lit("second"), body, docs[doc_id]).alias("k2"))
    marks = [f"<{k.upper()}>" for k in KINDS[:4]] + ["<TERM>", ""]

    def run(batches):
        for b in text_slices(batches):
            out = []
            for t, f in zip(b.column("text").to_pylist(), b.column("found").to_pylist(),
                            strict=True):
                if t is not None:
                    parts, last = [], 0
                    for s in sorted(f or [], key=lambda s: (s["start"], -s["end"])):
                        if s["start"] >= last:
                            mark = f"{s['broader']}*" if s["broader"] else marks[s["kind"]]
                            parts += [t[last:s["start"]], mark]
                            last = s["end"]
                    t = "".join([*parts, t[last:]])
                out.append(t)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.string())],
                                             ["doc_id", "text"])

    return (on_executors(rows.join(spans, ["k1", "k2"], "left"))
            .select("doc_id", "text", "found").mapInArrow(run, "doc_id long, text string"))


def digests(found: DataFrame) -> DataFrame:
    """Counts by base kind, the digest of the base spans and the text of all."""
    named = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1),
        s["start"].cast("string"), s["end"].cast("string"))), ",")
    counts = [F.size(F.filter("found", _is(i))).cast("long").alias(f"n_{KINDS[i]}")
              for i in range(4)]
    return found.select(
        "doc_id", *counts,
        F.sha2(named(F.filter("found", lambda s: s["kind"] < 4)).cast("binary"), 256)
        .alias("base_sha256"), named(F.col("found")).alias("spans"))


def _is(kind: int):
    return lambda s: s["kind"] == kind


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(find(table(spark, sf_dir, "documents")))
