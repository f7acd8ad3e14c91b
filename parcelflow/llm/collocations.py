"""Operator 11: phrase collocations by Rabin-Karp fingerprints.

1. The texts are cut into chunks of CHUNK_BYTES, written with their chunk number.
2. In each chunk a prefix polynomial over the word hashes gives the fingerprint of
   every run of 1 to 5 words as a difference of two prefix values.  The chunk's
   distinct fingerprints, cut to a few bits more than tell all runs of the corpus
   apart, are sorted, coded as differences, and dealt into ranges: a chunk is the
   pointer to the occurrences of all fingerprints it sends.
3. Each range adds the counts of its chunks and returns to each chunk those of its
   fingerprints that reach the least frequency in the corpus.
4. Each chunk meets its answer: only runs with such a fingerprint are looked at
   again, told apart by their words (so two phrases that share a fingerprint are
   counted apart), and materialised; their counts are summed by text.
5. The scores, cuts and covered phrases follow by joins on the frequent phrases.

A fingerprint that collides can only send a rare phrase to step 4, where it is
counted by its text: the result is exact.  Every chunk sends each fingerprint once,
so no phrase, however frequent, makes a hot task, and copies spread over chunks.

Result: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score`` and
the number of words before the cut, ``cut``.

Defined results: NULL and empty texts have no words; a NULL lang is ``und``; a
language without a candidate has no row; repeated rows and copies count each time;
ties go by the stated orders; an empty table gives an empty table.  Only the
language and text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelflow.llm.common import arrow_batch, on_executors, table, text_slices
from parcelflow.llm.shingles import mixed
from parcelflow.session import stored

LEAST = 100
LONGEST = 5
TOP = 2_000
#: Hundredths of a phrase's occurrences that a longer one must hold to cover it.
COVERED = 100
UNKNOWN = "und"
#: Text of a chunk; a longer single text is a chunk of its own.
CHUNK_BYTES = 4 << 20
#: Fingerprints in one range, and of one chunk in a range at least, about.
RANGE, LEAST_PACK = 4_000_000, 64
#: Bits of a fingerprint beyond those that number all runs of the corpus.
SPARE_BITS = 5
#: Bytes a word takes in a text on average, for sizes only.
WORD_BYTES = 6

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
WORD, SPACE, END = 0, 1, 2
#: The kind of each byte, and the byte in lower case (A-Z only).
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = SPACE
KIND[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = END
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words:
    """The words of a chunk: ``names`` (distinct), ``code`` of each, the ``piece``
    and the row (``text``) it stands in."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = (np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None
               else np.zeros(0, np.uint8))
        at = at - at[0]
        kind = KIND[raw]
        inside = kind == WORD
        first, last = inside.copy(), inside.copy()
        if len(raw):
            edge = np.zeros(len(raw) + 1, bool)
            edge[at] = True
            first[1:] &= ~inside[:-1] | edge[1:-1]
            last[:-1] &= ~inside[1:] | edge[1:-1]
        start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
        ends = np.cumsum(kind == END, dtype=np.int32)
        self.text = np.searchsorted(at, start, "right") - 1
        self.piece = (ends[start].astype(np.int64) + self.text if len(start)
                      else np.zeros(0, np.int64))
        letters = LOWER[raw[inside]]
        bounds = np.r_[0, np.cumsum(stop - start)]
        words = pa.LargeStringArray.from_buffers(
            len(start), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(letters))
        coded = words.dictionary_encode()
        self.names = coded.dictionary
        self.code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)

    def values(self) -> np.ndarray:
        """A 64-bit value of each word, the same in every chunk."""
        names = self.names.to_numpy(zero_copy_only=False)
        each = (pd.util.hash_array(names, categorize=False) if len(names)
                else np.zeros(0, np.uint64))
        return each[self.code]

    def runs(self, size: int) -> np.ndarray:
        """The places at which a run of ``size`` words within a piece begins."""
        count = len(self.code) - size + 1
        if count <= 0:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.piece[:count] == self.piece[size - 1:])


class Fingerprints:
    """Prefix polynomial of a chunk's word values."""

    def __init__(self, words: Words, language: np.ndarray, bits: int):
        """``language``: a 64-bit value of the language of each word."""
        value = words.values()
        with np.errstate(over="ignore"):
            power = np.cumprod(np.full(len(value), _BASE, np.uint64))
            self.back = np.cumprod(np.full(len(value), _INVERSE, np.uint64))
            self.prefix = np.r_[np.uint64(0), np.cumsum(value * power, dtype=np.uint64)]
        self.language, self.shift = language, np.uint64(64 - bits)

    def of(self, begin: np.ndarray, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            run = (self.prefix[begin + size] - self.prefix[begin]) * self.back[begin]
            return mixed((run ^ self.language[begin]) + np.uint64(size)) >> self.shift


def language_values(langs: pa.Array) -> np.ndarray:
    return pd.util.hash_array(langs.to_numpy(zero_copy_only=False).astype(object),
                              categorize=True)


def _planes(values: np.ndarray, width: int) -> bytes:
    """The ``width`` low bytes, first all lowest ones: what is constant compresses."""
    return (values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _from_planes(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def pack(values: np.ndarray, counts: np.ndarray, low: int, width: int,
         count_width: int) -> tuple[bytes, bytes]:
    """Sorted distinct ``values`` from ``low`` on as differences of ``width`` bytes; a
    larger difference is spread over entries with count 0."""
    most = (1 << 8 * width) - 1
    gap = np.diff(values, prepend=np.uint64(low))
    extra = (gap // np.uint64(most)).astype(np.int64)
    if extra.any():
        at = np.cumsum(extra + 1) - 1
        steps = np.full(int(at[-1]) + 1, most, np.uint64)
        steps[at] = gap - extra.astype(np.uint64) * np.uint64(most)
        held = np.zeros(len(steps), np.uint64)
        held[at] = counts
    else:
        steps, held = gap, counts
    return _planes(steps, width), _planes(held, count_width)


def unpack(steps: bytes, counts: bytes, low: int, width: int,
           count_width: int) -> tuple[np.ndarray, np.ndarray]:
    held = _from_planes(counts, count_width)
    values = np.cumsum(_from_planes(steps, width), dtype=np.uint64) + np.uint64(low)
    real = held > 0
    return values[real], held[real]


class Layout:
    """Sizes that follow from the bytes of all texts."""

    def __init__(self, total: int, chunk: int, longest: int, least: int, spare: int):
        runs = longest * max(total // WORD_BYTES, 1)
        in_chunk = longest * max(min(total, chunk) // WORD_BYTES, 1)
        self.bits = min(60, max(1, math.ceil(math.log2(runs)) + spare))
        self.ranges = max(1, min(-(-runs // RANGE), in_chunk // LEAST_PACK))
        gap = (1 << self.bits) // in_chunk + 1
        self.width = min(8, -(-(gap.bit_length() + 4) // 8))
        self.count_width = -(-least.bit_length() // 8)
        self.least, self.longest = least, longest
        #: Values from which each range begins.
        self.low = [-(-(r << self.bits) // self.ranges) for r in range(self.ranges + 1)]


def chunked(docs: DataFrame, limit: int) -> DataFrame:
    """chunk, lang, text: the texts with a number for each ``limit`` bytes of a task."""
    schema = pa.schema([("chunk", pa.int64()), ("lang", pa.string()), ("text", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held = TaskContext.get().partitionId() << 32, 0
        for b in text_slices(batches, limit=limit // 8):
            size = pc.sum(pc.binary_length(b.column("text"))).as_py() or 0
            if held and held + size > limit:
                chunk, held = chunk + 1, 0
            held += size
            yield arrow_batch(schema, chunk=pa.repeat(pa.scalar(chunk, pa.int64()), b.num_rows),
                              lang=b.column("lang"), text=b.column("text"))

    return on_executors(docs).mapInArrow(run, "chunk long, lang string, text string")


def _whole_chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows that follow each other with one chunk number, together."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        chunk = b.column("chunk").to_numpy()
        cuts = np.r_[0, np.flatnonzero(np.diff(chunk)) + 1, len(chunk)]
        for i, j in zip(cuts[:-1], cuts[1:], strict=True):
            if i == j:
                continue
            if held and held[0].column("chunk")[0].as_py() != chunk[i]:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(b.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _column(rows: pa.Table, name: str) -> pa.Array:
    return pa.concat_arrays(rows.column(name).chunks) if rows.num_rows else pa.array([], pa.string())


def packs(texts: DataFrame, layout: Layout) -> DataFrame:
    """part (the range), chunk, steps, counts."""
    schema = pa.schema([("part", pa.int32()), ("chunk", pa.int64()),
                        ("steps", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_chunks(batches):
            words = Words(_column(rows, "text"))
            prints = Fingerprints(words, language_values(_column(rows, "lang"))[words.text],
                                  layout.bits)
            found = np.sort(np.concatenate([prints.of(words.runs(k), k)
                                            for k in range(1, layout.longest + 1)]))
            if not len(found):
                continue
            at = np.r_[0, np.flatnonzero(found[1:] != found[:-1]) + 1]
            counts = np.minimum(np.diff(np.r_[at, len(found)]), layout.least).astype(np.uint64)
            found = found[at]
            cuts = np.searchsorted(found, np.array(layout.low, np.uint64))
            parts = [p for p in range(layout.ranges) if cuts[p] < cuts[p + 1]]
            coded = [pack(found[cuts[p]:cuts[p + 1]], counts[cuts[p]:cuts[p + 1]], layout.low[p],
                          layout.width, layout.count_width) for p in parts]
            chunk = rows.column("chunk")[0].as_py()
            yield arrow_batch(schema, part=parts, chunk=[chunk] * len(parts),
                              steps=[s for s, _ in coded], counts=[c for _, c in coded])

    return on_executors(texts).mapInArrow(
        run, "part int, chunk long, steps binary, counts binary")


def answers(sent: DataFrame, layout: Layout) -> DataFrame:
    """chunk, frequent (8 bytes a fingerprint): what each range returns to a chunk."""
    schema = pa.schema([("chunk", pa.int64()), ("frequent", pa.binary())])

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        low = layout.low[key[0].as_py()]
        held = [unpack(s.as_py(), c.as_py(), low, layout.width, layout.count_width)
                for s, c in zip(rows.column("steps"), rows.column("counts"), strict=True)]
        # value and count in one number, so that one plain sort serves
        room = np.uint64(layout.least.bit_length())
        keyed = np.sort(np.concatenate([((v - np.uint64(low)) << room) | c for v, c in held]))
        value = keyed >> room
        at = np.r_[0, np.flatnonzero(value[1:] != value[:-1]) + 1]
        total = np.add.reduceat(keyed & np.uint64((1 << int(room)) - 1), at)
        frequent = value[at][total >= layout.least] + np.uint64(low)
        chunks, found = [], []
        for (values, _), chunk in zip(held, rows.column("chunk").to_pylist(), strict=True):
            place = np.minimum(np.searchsorted(values, frequent), len(values) - 1)
            hit = frequent[values[place] == frequent]
            if len(hit):
                chunks.append(chunk)
                found.append(hit.astype("<u8").tobytes())
        return pa.Table.from_batches([arrow_batch(schema, chunk=chunks, frequent=found)])

    return sent.groupBy("part").applyInArrow(run, "chunk long, frequent binary")


#: Ranges whose phrases one task counts by their text.
RANGES_AT_ONCE = 4


def materialised(texts: DataFrame, returned: DataFrame, layout: Layout) -> DataFrame:
    """part, lang, phrases, sizes, counts (lists): each chunk's counts of the phrases whose
    fingerprint is frequent, and under the empty phrase the words of a language.  One row
    holds what a chunk has of a language in a few ranges of fingerprints."""
    schema = pa.schema([("part", pa.int32()), ("lang", pa.string()),
                        ("phrases", pa.list_(pa.string())), ("sizes", pa.list_(pa.int32())),
                        ("counts", pa.list_(pa.int64()))])
    low = np.array(layout.low[::RANGES_AT_ONCE], np.uint64)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        langs = _column(left, "lang").dictionary_encode()
        words = Words(_column(left, "text"))
        lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[words.text]
        names = langs.dictionary.cast(pa.string())
        found = [(np.zeros(len(names), np.int64), np.arange(len(names)),
                  pa.array([""] * len(names), pa.string()), 0,
                  np.bincount(lang, minlength=len(names)))]
        wanted = np.sort(np.concatenate([np.zeros(0, np.uint64)] + [
            np.frombuffer(f.as_py(), "<u8") for f in right.column("frequent")]))
        if len(wanted) and len(lang):
            values = language_values(_column(left, "lang"))[words.text]
            prints = Fingerprints(words, values, layout.bits)
            vocabulary = len(words.names)
            for size in range(1, layout.longest + 1):
                begin = words.runs(size)
                value = prints.of(begin, size)
                place = np.minimum(np.searchsorted(wanted, value), len(wanted) - 1)
                hit = wanted[place] == value
                begin, value = begin[hit], value[hit]
                if not len(begin):
                    continue
                same = lang[begin]  # one number for each different run of words
                for k in range(size):
                    _, first, same, counts = np.unique(
                        same * vocabulary + words.code[begin + k], return_index=True,
                        return_inverse=True, return_counts=True)
                at = begin[first]
                each = [words.names.take(pa.array(words.code[at + k])) for k in range(size)]
                phrases = (pc.binary_join_element_wise(*each, pa.scalar(" ", pa.large_string()))
                           if size > 1 else each[0])
                part = np.searchsorted(low, value[first], "right") - 1
                found.append((part, lang[at], phrases.cast(pa.string()), size, counts))
        part, code = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        order = np.lexsort((code, part))
        key = part[order] * len(names) + code[order]
        cuts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else key
        offsets = pa.array(np.r_[cuts, len(key)], pa.int32())
        lists = lambda values: pa.ListArray.from_arrays(offsets, values)
        sizes = np.concatenate([np.full(len(f[1]), f[3], np.int32) for f in found])
        counts = np.concatenate([f[4] for f in found]).astype(np.int64)
        return pa.Table.from_batches([arrow_batch(
            schema, part=part[order][cuts].astype(np.int32),
            lang=names.take(pa.array(code[order][cuts])),
            phrases=lists(pa.concat_arrays([f[2] for f in found]).take(pa.array(order))),
            sizes=lists(pa.array(sizes[order])), counts=lists(pa.array(counts[order])))])

    return (texts.groupBy("chunk").cogroup(returned.groupBy("chunk")).applyInArrow(
        run, "part int, lang string, phrases array<string>, sizes array<int>, "
             "counts array<long>"))


def counted(held: DataFrame, layout: Layout) -> DataFrame:
    """lang, phrase, size, f: the sums over all chunks by text, where they reach the least
    frequency; the words of a language always."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()),
                        ("f", pa.int64())])

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        lengths = pc.list_value_length(rows.column("phrases")).to_numpy()
        flat = pa.table({
            "lang": rows.column("lang").take(pa.array(np.repeat(np.arange(len(lengths)), lengths))),
            "phrase": pc.list_flatten(rows.column("phrases")),
            "size": pc.list_flatten(rows.column("sizes")),
            "f": pc.list_flatten(rows.column("counts"))})
        summed = flat.group_by(["lang", "phrase", "size"]).aggregate([("f", "sum")])
        summed = summed.rename_columns([n.removesuffix("_sum") for n in summed.column_names])
        return summed.filter(pc.or_(pc.greater_equal(summed["f"], layout.least),
                                    pc.equal(summed["size"], 0))).select(schema.names)

    return held.groupBy("part").applyInArrow(run, "lang string, phrase string, size int, f long")


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST,
                     lang: str = "lang", text: str = "text", chunk_bytes: int = CHUNK_BYTES,
                     spare_bits: int = SPARE_BITS) -> DataFrame:
    """lang, phrase, size, f of all phrases of up to ``longest`` words with ``least``
    occurrences or more; the row of size 0 holds the words of the language."""
    rows = docs.select(F.coalesce(docs[lang].cast("string"), F.lit(UNKNOWN)).alias("lang"),
                       docs[text].cast("string").alias("text")).filter("text != ''")
    texts = stored(chunked(rows, chunk_bytes), "chunks")
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    layout = Layout(total, chunk_bytes, longest, least, spare_bits)
    returned = stored(answers(packs(texts, layout), layout), "answers")
    return stored(counted(materialised(texts, returned, layout), layout), "phrases")


def _part(first: Column | int, size: Column) -> Column:
    return F.array_join(F.slice("words", first, size), " ")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP,
                 covered: int = COVERED, lang: str = "lang", text: str = "text",
                 **sizes) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, cut of each language's best phrases."""
    known = frequent_phrases(docs, least, longest, lang, text, **sizes)
    count = lambda part, name: known.filter("size > 0").select(
        "lang", F.col("phrase").alias(part), F.col("f").alias(name))
    phrases = known.filter("size > 1").select(
        "lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    # a phrase inside one of two more words lies in one of one more, as frequent at least
    covers = (phrases.filter("size > 2").select(
        "lang", "a", F.explode(F.array(_part(1, F.col("size") - 1), _part(2, F.col("size") - 1)))
        .alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("cover")))
    open_ = (phrases.join(covers, ["lang", "phrase"], "left")
             .filter(F.col("cover").isNull() | (100 * F.col("cover") < covered * F.col("a"))))
    k = F.col("cut")
    cuts = open_.select("lang", "phrase", "a", "words", "size", F.explode(
        F.sequence(F.lit(1), F.col("size") - 1)).alias("cut")).select(
            "lang", "phrase", "a", "cut", _part(1, k).alias("first"),
            _part(k + 1, F.col("size") - k).alias("rest"))
    words = known.filter("size = 0").select("lang", F.col("f").alias("n"))
    wide = {c: F.col(c).cast("decimal(38,0)") for c in ("a", "n", "l", "r")}
    scored = (cuts.join(count("first", "l"), ["lang", "first"])
              .join(count("rest", "r"), ["lang", "rest"]).join(words, "lang")
              .withColumns({f"_{c}": w for c, w in wide.items()})
              .withColumn("score", F.expr("(1000BD * _a * _n) div (_l * _r)"))
              .groupBy("lang", "phrase").agg(
                  F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("best"))
              .select("lang", "phrase", "best.*"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                    "n", F.col("score").cast("long").alias("score"),
                    F.col("cut").cast("long").alias("cut")))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, '{UNKNOWN}') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
worded AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w
  FROM pieces),
sizes AS (SELECT unnest(range(1, {LONGEST + 1})) AS size),
runs AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2),
         lambda i: array_to_string(list_slice(w, i, i + size - 1), ' '))) AS phrase
  FROM worded, sizes WHERE len(w) >= size),
f AS (SELECT lang, phrase, size, count(*) AS f FROM runs GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
often AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM f
          WHERE size > 1 AND f >= {LEAST}),
shorter AS (
  SELECT o.lang, o.a, o.w, o.size, s.size AS inside FROM often o JOIN sizes s
  ON s.size > 1 AND s.size < o.size),
inner_runs AS (
  SELECT lang, a, unnest(list_transform(range(1, size - inside + 2),
         lambda i: array_to_string(list_slice(w, i, i + inside - 1), ' '))) AS phrase
  FROM shorter),
kept AS (
  SELECT o.* FROM often o WHERE NOT EXISTS (
    SELECT 1 FROM inner_runs i WHERE i.lang = o.lang AND i.phrase = o.phrase
    AND 100 * i.a >= {COVERED} * o.a)),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(list_slice(w, 1, k), ' ') AS head,
         array_to_string(list_slice(w, k + 1, size), ' ') AS tail
  FROM (SELECT *, unnest(range(1, size)) AS k FROM kept)),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n,
         (1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head
  JOIN f y ON y.lang = c.lang AND y.phrase = c.tail JOIN total t ON t.lang = c.lang),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score, k AS cut FROM ranked
WHERE rank <= {TOP}
"""
