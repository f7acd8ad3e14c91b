"""Operator 8: secret scan by patterns and sliding-window entropy, in SQL functions.

Three patterns give the base spans (assign, access, hex).  The method adds spans
of kind ``entropy``: over candidate strings of 20 and more token characters slides a
window of fixed width.  A string holds the window's count of each character, others
its digits and letters; for each step the character that leaves and the one that
enters change them by one each, and the sum of c * log2 c by the difference of two
table values; the entropy of the window is log2(w) - sum / w.  What the window holds
decides the threshold: hex digits with digits and letters among them, digits with
letters, letters of both cases; any other window is none.  Windows over it that
touch or overlap are one span, others spans of their own.  What the allow list
matches is blanked out first, so that it suppresses itself and not what stands beside.

Everything is an expression over one row: no shuffle, no Python.  The match
positions follow from the pieces between the matches.

Defined results: NULL text counts as empty; positions are code points, the end
is exclusive; failing matches are dropped without another try; texts are read
whole; repeated rows give equal rows; an empty table gives an empty table.  Only
the id and text columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm.common import table

# The base patterns.
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "entropy")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

WINDOW = 20
#: Bits a character, by what the window holds.
HEX_BITS, TOKEN_BITS, LETTER_BITS = 3.0, 3.9, 4.05
#: The token characters: digits, lower case, upper case, others.
TOKENS = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"
TOKEN = "[A-Za-z0-9+/_=-]"
# Strings that look random and are public by nature, as whole words.
ALLOWED = (
    r"(?<![A-Za-z0-9_])[0-9]{6,}(?![A-Za-z0-9_])",
    r"(?<![A-Za-z0-9_])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![A-Za-z0-9_])",
    r"(?:(?<![A-Za-z0-9_])|_)[A-Za-z0-9]*?(?i:example|abcdefghijklmnop|01234567890123456789)"
    r"[A-Za-z0-9]*",
    r"(?<![A-Za-z0-9_])sha(?:256|384|512)-[A-Za-z0-9+/=]+",
)
#: Matches whose positions are summed up one by one.
CHUNK = 256
#: c * log2 c in units of 2^-20, so that sums are exact whatever their order.
UNIT = 1 << 20


def _weight(c: int) -> int:
    return round(c * math.log2(c) * UNIT) if c else 0


def least_sum(bits: float, window: int) -> int:
    """The largest sum of c * log2 c at which a window still has that entropy."""
    return math.floor((math.log2(window) - bits) * window * UNIT)


def pieces(text: str, found: str, pattern: str) -> Column:
    """array<struct<piece, value>>: the text before each match, and the match; the
    last value is NULL.  Empty where nothing is found."""
    cut = F.arrays_zip(F.split(text, pattern, -1).alias("piece"), F.col(found).alias("value"))
    none = F.array().cast("array<struct<piece:string,value:string>>")
    return F.when(F.size(found) == 0, none).otherwise(cut)


def _extent(z: Column) -> Column:
    return F.length(z["piece"]) + F.coalesce(F.length(z["value"]), F.lit(0))


def matches(cut: str) -> Column:
    """array<struct<start, value>> of all matches, from the column of their
    :func:`pieces`.  Starts are running sums: first of whole chunks, then inside
    each chunk, so that the work stays linear in the number of matches."""
    last = F.floor((F.size(cut) - 1) / CHUNK).cast("int")
    chunks = F.transform(F.sequence(F.lit(0), last),
                         lambda k: F.slice(cut, k * CHUNK + 1, F.lit(CHUNK)))
    totals = F.transform(chunks, lambda chunk: F.aggregate(
        chunk, F.lit(0), lambda n, z: n + _extent(z)))
    bases = F.aggregate(
        totals, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
        lambda acc, n: F.struct((acc["at"] + n).alias("at"),
                                F.array_append(acc["out"], acc["at"]).alias("out")),
        lambda acc: acc["out"])
    none = F.array().cast("array<struct<start:int,value:string>>")

    def add(acc: Column, z: Column) -> Column:
        match = F.struct((acc["at"] + F.length(z["piece"])).alias("start"),
                         z["value"].alias("value"))
        return F.struct((acc["at"] + _extent(z)).alias("at"), F.when(
            z["value"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(match)))
            .alias("out"))

    placed = F.zip_with(chunks, bases, lambda chunk, base: F.aggregate(
        chunk, F.struct(base.alias("at"), none.alias("out")), add, lambda acc: acc["out"]))
    return F.when(F.size(cut) == 0, none).otherwise(F.flatten(placed))


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


_STRETCH = "array<struct<from:int,upto:int>>"
#: A count of 0 as a character; the next ones follow it.
ZERO = 48


def hot_windows(value: Column, window: int) -> Column:
    """array<struct<from, upto>>: the stretches that windows over the threshold cover
    (0-based, end exclusive), of a string of token characters."""
    weights = F.array(*[F.lit(_weight(c)) for c in range(window + 2)])
    weight = lambda n: F.element_at(weights, n + 1)
    # each character as its place in TOKENS: digits to 10, a-f to 16, lower case to 36,
    # A-F to 42, upper case to 62
    places = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(TOKENS), c))

    def step(places: Column):
        def run(acc: Column, i: Column) -> Column:
            both = F.struct(F.element_at(places, i).alias("e"),
                            F.element_at(places, F.greatest(i - window, F.lit(1))).alias("l"))
            return _let(both, lambda at: moved(acc, i, at["e"], at["l"]))

        return run

    def moved(acc: Column, i: Column, entering: Column, leaving: Column) -> Column:
        full = i > window
        count = lambda at: F.ascii(F.substring(acc["counts"], at, F.lit(1))) - ZERO
        here = lambda at, low, high: at.between(low, high).cast("int")
        gone = lambda at, low, high: F.when(full, here(at, low, high)).otherwise(0)
        kind = lambda name, low, high: (acc[name] + here(entering, low, high)
                                        - gone(leaving, low, high)).alias(name)
        hex_letters = lambda at, f: f(at, 11, 16) + f(at, 37, 42)
        known = F.struct(
            count(leaving).alias("k"),
            (count(entering) - F.when(full & (leaving == entering), 1).otherwise(0)).alias("n"))

        def counted(c: Column) -> Column:
            less = F.when(full, weight(c["k"]) - weight(c["k"] - 1)).otherwise(0)
            without = F.when(full, F.overlay(acc["counts"], F.chr(c["k"] - 1 + ZERO), leaving, 1)
                             ).otherwise(acc["counts"])
            return F.struct(
                (acc["total"] - less + weight(c["n"] + 1) - weight(c["n"])).alias("total"),
                F.overlay(without, F.chr(c["n"] + 1 + ZERO), entering, 1).alias("counts"),
                kind("digits", 1, 10), kind("lower", 11, 36), kind("upper", 37, 62),
                (acc["hex"] + hex_letters(entering, here) - hex_letters(leaving, gone)).alias("hex"))

        return _let(known, lambda c: _let(counted(c), lambda now: placed(acc, i, now)))

    def placed(acc: Column, i: Column, now: Column) -> Column:
        letters = now["lower"] + now["upper"]
        most = (F.when((now["digits"] > 0) & (now["hex"] > 0)
                       & (now["digits"] + now["hex"] == window), least_sum(HEX_BITS, window))
                .when((now["digits"] > 0) & (letters > 0), least_sum(TOKEN_BITS, window))
                .when((now["lower"] > 0) & (now["upper"] > 0), least_sum(LETTER_BITS, window))
                .otherwise(-1))
        hot = (i >= window) & (now["total"] <= most)
        goes_on = hot & (acc["upto"] >= i - window)
        begins = hot & ~goes_on
        before = F.struct(acc["from"].alias("from"), acc["upto"].alias("upto"))
        return F.struct(
            *[now[n].alias(n) for n in ("total", "counts", "digits", "lower", "upper", "hex")],
            F.when(begins, i - window).otherwise(acc["from"]).alias("from"),
            F.when(hot, i).otherwise(acc["upto"]).alias("upto"),
            F.when(begins & (acc["upto"] >= 0), F.array_append(acc["out"], before))
            .otherwise(acc["out"]).alias("out"))

    zero = lambda n: F.lit(0).alias(n)
    start = F.struct(zero("total"), F.lit(chr(ZERO) * len(TOKENS)).alias("counts"), zero("digits"),
                     zero("lower"), zero("upper"), zero("hex"), zero("from"),
                     F.lit(-1).alias("upto"), F.array().cast(_STRETCH).alias("out"))
    end = lambda acc: F.when(acc["upto"] < 0, acc["out"]).otherwise(F.array_append(
        acc["out"], F.struct(acc["from"].alias("from"), acc["upto"].alias("upto"))))
    return _let(places, lambda p: F.aggregate(
        F.sequence(F.lit(1), F.size(p)), start, step(p), end))


def entropy_spans(found: Column, window: int) -> Column:
    """array<struct<start, kind, end>> of the candidates ``found``."""
    hot = F.transform(found, lambda m: F.transform(
        hot_windows(m["value"], window), lambda h: F.struct(
            (m["start"] + h["from"]).alias("start"), F.lit(3).alias("kind"),
            (m["start"] + h["upto"]).alias("end"))))
    return F.flatten(hot)


def blanked(text: str, found: str, pattern: str) -> Column:
    """The text with the matches ``found`` of ``pattern`` as blanks of their length."""
    cut = pieces(text, found, pattern)
    without = F.array_join(F.transform(cut, lambda z: F.concat(z["piece"], F.coalesce(
        F.repeat(F.lit(" "), F.length(z["value"])), F.lit("")))), "")
    return F.when(F.size(found) == 0, F.col(text)).otherwise(without)


def spans_of(found: Column, kind: int) -> Column:
    return F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), F.lit(kind).alias("kind"),
        (m["start"] + F.length(m["value"])).alias("end")))


def scan(docs: DataFrame, window: int = WINDOW, allowed: tuple[str, ...] = ALLOWED,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ``found``: array<struct<start, kind, end>> of all spans, by start
    and kind; ``kind`` is an index into KINDS."""
    candidate = rf"(?<!{TOKEN}){TOKEN}{{{window},}}+"
    public = "|".join(allowed)
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX.replace("+", f"{{{LEAST_HEX},}}"),
                "entropy": candidate}
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    rows = docs.select(docs[doc_id].alias("doc_id"), body.alias("text"))
    every = lambda column, p: F.regexp_extract_all(column, F.lit(p), F.lit(0))
    # the allow list matters only where there is a candidate
    some = F.when(F.regexp_like("text", F.lit(candidate)), every("text", public)).otherwise(
        F.array().cast("array<string>")) if allowed else F.array().cast("array<string>")
    masked = rows.select("*", some.alias("public")).select(
        "*", (blanked("text", "public", public) if allowed else F.col("text")).alias("masked"))
    raw = masked.select("*", *[every("masked" if k == "entropy" else "text", p).alias(k)
                               for k, p in patterns.items()])
    cut = raw.select("doc_id", *[pieces("masked" if k == "entropy" else "text", k, p).alias(k)
                                 for k, p in patterns.items()])
    placed = cut.select("doc_id", *[matches(k).alias(k) for k in patterns])
    good = {
        "assign": lambda m: F.length(F.regexp_extract(m["value"], ASSIGN, 2)) >= LEAST_VALUE,
        "access": lambda m: F.length(m["value"]) >= LEAST_ACCESS,
        "hex": lambda m: F.length(m["value"]) >= LEAST_HEX,
    }
    spans = [spans_of(F.filter(k, keep), i) for i, (k, keep) in enumerate(good.items())]
    spans.append(entropy_spans(F.col("entropy"), window))
    return placed.select("doc_id", F.array_sort(F.concat(*spans)).alias("found"))


def digests(found: DataFrame) -> DataFrame:
    """Counts by base kind, the digest of the base spans and the text of all."""
    named = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1),
        s["start"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda k: F.filter("found", lambda s: s["kind"] == k)
    return found.select(
        "doc_id", *[F.size(of(i)).cast("long").alias(f"n_{KINDS[i]}") for i in range(3)],
        F.sha2(named(F.filter("found", lambda s: s["kind"] < 3)).cast("binary"), 256)
        .alias("base_sha256"), named(F.col("found")).alias("spans"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(scan(table(spark, sf_dir, "documents")))


# The allow list in the other engine's words: there \\b is what stands between the
# characters of the look-arounds and others.
_SQL_ALLOWED = "|".join((
    r"\b[0-9]{6,}\b",
    r"\b[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\b",
    r"(?:\b|_)[A-Za-z0-9]*?(?i:example|abcdefghijklmnop|01234567890123456789)[A-Za-z0-9]*",
    r"\bsha(?:256|384|512)-[A-Za-z0-9+/=]+",
))
_SQL_NAME = r"""(?i:password|passwd|secret|token|api_?key)["\x27]?\x20*[:=]\x20*["\x27]?"""
_SQL_ASSIGN = _SQL_NAME + "[A-Za-z0-9+/_.=-]+"


def _sql_matches(name: str, source: str, pattern: str) -> str:
    """doc_id, value, start of every match: it is put between two marks, and the text
    is split at the first."""
    return f"""
{name}_parts AS (
  SELECT doc_id, string_split(regexp_replace(text, '{pattern}', chr(1) || '\\0' || chr(2), 'g'),
                              chr(1)) AS p FROM {source}),
{name} AS (
  SELECT doc_id, split_part(p[j], chr(2), 1) AS value, (length(p[1]) + coalesce(list_sum(
           list_transform(p[2:j - 1], lambda x: length(x) - 1)), 0))::BIGINT AS start
  FROM (SELECT doc_id, p, unnest(range(2, len(p) + 1)) AS j FROM {name}_parts))"""


_SQL_WEIGHTS = str([_weight(c) for c in range(WINDOW + 1)])
OP8_SQL = f"""
WITH texts AS (SELECT row_number() OVER () AS place, doc_id AS id, coalesce(text, '') AS text
               FROM documents),
plain AS (SELECT place AS doc_id, text FROM texts),
{_sql_matches("assigned", "plain", _SQL_ASSIGN)},
{_sql_matches("access", "plain", ACCESS)},
{_sql_matches("hex", "plain", HEX)},
public_parts AS (
  SELECT doc_id, string_split(regexp_replace(text, '{_SQL_ALLOWED}',
         chr(1) || '\\0' || chr(2), 'g'), chr(1)) AS p FROM plain),
masked AS (
  SELECT doc_id, array_to_string(list_transform(p, lambda x, i: CASE WHEN i = 1 THEN x ELSE
    repeat(' ', length(split_part(x, chr(2), 1))) || split_part(x, chr(2), 2) END), '') AS text
  FROM public_parts),
{_sql_matches("run", "masked", f"{TOKEN}{{{WINDOW},}}")},
windows AS (
  SELECT doc_id, start + i AS start, substr(value, i + 1, {WINDOW}) AS w
  FROM (SELECT *, unnest(range(0, length(value) - {WINDOW - 1})) AS i FROM run)),
measured AS (
  SELECT doc_id, start, list_sum(list_transform(list_distinct(string_split(w, '')), lambda c:
           {_SQL_WEIGHTS}[len(list_filter(string_split(w, ''), lambda x: x = c)) + 1])) AS total,
         regexp_matches(w, '[0-9]') AS digit, regexp_matches(w, '[a-z]') AS low,
         regexp_matches(w, '[A-Z]') AS up, regexp_full_match(w, '[0-9a-fA-F]+') AS hex
  FROM windows),
hot AS (
  SELECT doc_id, start FROM measured
  WHERE total <= CASE WHEN hex AND digit AND (low OR up) THEN {least_sum(HEX_BITS, WINDOW)}
                      WHEN digit AND (low OR up) THEN {least_sum(TOKEN_BITS, WINDOW)}
                      WHEN low AND up THEN {least_sum(LETTER_BITS, WINDOW)} ELSE -1 END),
stretches AS (
  SELECT doc_id, min(start) AS start, max(start) + {WINDOW} AS upto FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY start) AS island FROM (
      SELECT *, CASE WHEN start <= lag(start) OVER (PARTITION BY doc_id ORDER BY start) + {WINDOW}
                     THEN 0 ELSE 1 END AS fresh FROM hot))
  GROUP BY doc_id, island),
spans AS (
  SELECT doc_id, start, 0 AS kind, start + length(value) AS upto FROM assigned
  WHERE length(regexp_extract(value, '^{_SQL_NAME}(.*)$', 1)) >= {LEAST_VALUE}
  UNION ALL SELECT doc_id, start, 1, start + length(value) FROM access
  WHERE length(value) >= {LEAST_ACCESS}
  UNION ALL SELECT doc_id, start, 2, start + length(value) FROM hex WHERE length(value) >= {LEAST_HEX}
  UNION ALL SELECT doc_id, start, 3, upto FROM stretches),
named AS (
  SELECT doc_id, kind, start, upto, {list(KINDS)}[kind + 1] || ':' || start || ':' || upto AS name
  FROM spans)
SELECT t.id AS doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
  count(*) FILTER (kind = 2) AS n_hex,
  sha256(coalesce(string_agg(name, ',' ORDER BY start, kind) FILTER (kind < 3), '')) AS base_sha256,
  coalesce(string_agg(name, ',' ORDER BY start, kind), '') AS spans
FROM texts t LEFT JOIN named n ON n.doc_id = t.place GROUP BY t.place, t.id
"""
