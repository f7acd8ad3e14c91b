"""Operator 6: language ID by multilingual mixture inference.

Learning: hashed letter n-grams (1 to 3, with word edges) are counted per
language over a bounded sample of labelled rows and smoothed into likelihoods
P(gram | language), a table of fixed width per language.

Prediction, per document: expectation-maximisation estimates the proportions of
the languages in the document from its n-gram counts.  Starting from all
languages, the one with the smallest proportion is dropped as long as that
lowers the penalised likelihood BIC = -2 log L + (languages - 1) log(grams).
The language with the largest proportion of the selected set is the prediction,
its proportion the score.

On request the model has a background too: half the grams of the sampled texts with
their letters shuffled, half all buckets alike.  ``margin`` is the log likelihood of
the document's mixture less that of the background, plus log(grams) as penalty; below
0, no learned language explains the document better than random letters do.

All documents of a step run together: their counts are one sparse matrix of
(document, bucket, count) and every iteration is a handful of array operations.

Defined results: NULL text or text without a letter gives ``und`` and score 0;
long texts are read whole; ties go to the language that sorts first; repeated
rows give equal rows; NULL ids are never held out; an empty table, or one with
no labelled row, learns nothing and every text gives ``und``.  Only the id, text
and (for learning) language columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow.llm.common import arrow_batch, doc_crc, on_executors, table, text_slices

#: Labelled rows a language's model is fitted on, at most (all, if it has fewer).
SAMPLE_PER_LANGUAGE = 4_000
BUCKETS = 1 << 14
SMOOTHING = 0.5
ROUNDS = 25
STEP_BYTES = 2 << 20
UNKNOWN = "und"


def gram_counts(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, ...]:
    """(document, bucket, count) of the hashed n-grams of each text, in order."""
    lower = pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string()))
    # every run of characters that are no letters is one word edge
    words = pc.replace_substring_regex(lower, r"[^\pL\pM]+", " ")
    size = pc.utf8_length(words).to_numpy(zero_copy_only=False) + 2
    joined = "  ".join(words.to_pylist())
    code = np.frombuffer(f" {joined} ".encode("utf-32-le"), np.uint32)
    doc = np.repeat(np.arange(len(size)), size)
    edge = code == 32
    with np.errstate(over="ignore"):
        one = code * np.uint32(0x9E3779B1)
        two = (one[:-1] ^ (one[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + code[1:]
        two = two * np.uint32(0xC2B2AE35)
        three = ((two[:-1] ^ (two[:-1] >> np.uint32(13))) * np.uint32(0x27D4EB2F) + code[2:])
        three = three * np.uint32(0x165667B1)
    shift = np.uint32(32 - int(buckets).bit_length() + 1)
    found = [(doc[~edge], one[~edge])]
    for n, h in ((2, two), (3, three)):
        last = len(code) - n + 1
        real = (doc[:last] == doc[n - 1:]) & ~(edge[:last] & edge[1:last + 1])
        if n == 3:
            real &= ~edge[1:last + 1]
        found.append((doc[:last][real], h[real]))
    out, per = [], max(1, (1 << 21) // buckets)
    for low in range(0, len(size), per):  # a dense count matrix for a few documents at a time
        key = np.concatenate([(d[x:y] - low) * buckets + (h[x:y] >> shift) for d, h in found
                              for x, y in [np.searchsorted(d, [low, low + per])]])
        count = np.bincount(key)
        some = np.flatnonzero(count)
        out.append((low + some // buckets, some % buckets, count[some]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (
        np.zeros(0, np.int64),) * 3


def shuffled(text: str) -> str:
    """The text with its letters dealt anew over their places."""
    code = np.array(list(text.lower()))
    at = np.flatnonzero(np.char.isalpha(code)) if len(code) else []
    code[at] = np.random.default_rng(len(at)).permutation(code[at])
    return "".join(code.tolist())


def learn(labelled: DataFrame, sample: int = SAMPLE_PER_LANGUAGE, buckets: int = BUCKETS,
          background: bool = False) -> tuple[list[str], np.ndarray]:
    """Languages and log P(bucket | language), with a last row for the ``background``
    if asked for, from ``text`` and ``lang`` of
    labelled rows.  About ``sample`` rows a language are read, picked by a hash of
    id and text (so a text that fills a third of the rows counts as often as its
    share of the sample); the driver receives one row a language and bucket."""
    rows = labelled.filter("lang is not null and text is not null").select(
        "lang", "text", F.xxhash64("doc_id", "text").alias("ticket"))
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return [], np.zeros((int(background), buckets))
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, sample / n)))
                         for k, n in sizes.items()])
    picked = (rows.filter(F.pmod("ticket", F.lit(1 << 20)) < share * (1 << 20))
              .select("lang", "text"))
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int64()), ("n", pa.int64())])

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for b in text_slices(batches, limit=STEP_BYTES):
            doc, bucket, n = gram_counts(b.column("text"), buckets)
            langs = np.array(b.column("lang").to_pylist(), dtype=object)[doc]
            for k in set(langs):
                own = langs == k
                total[k] = total.get(k, 0) + np.bincount(bucket[own], n[own], buckets)
            if background:
                mixed = pa.array([shuffled(t) for t in b.column("text").to_pylist()], pa.string())
                _, bucket, n = gram_counts(mixed, buckets)
                total[None] = total.get(None, 0) + np.bincount(bucket, n, buckets)
        for k, v in total.items():
            some = np.flatnonzero(v)
            yield arrow_batch(schema, lang=[k] * len(some), bucket=some,
                              n=v[some].astype(np.int64))

    counted = (on_executors(picked).mapInArrow(count, "lang string, bucket long, n long")
               .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    table_ = np.full((len(languages) + background, buckets), SMOOTHING)
    at = {k: i for i, k in enumerate([*languages, None])}
    row = np.array([at[k] for k in counted.column("lang").to_pylist()], np.int64)
    table_[row, counted.column("bucket").to_numpy()] += counted.column("n").to_numpy()
    table_ /= table_.sum(axis=1, keepdims=True)
    if background:
        table_[-1] = (table_[-1] + 1 / buckets) / 2
    return languages, np.log(table_)


def margins(doc: np.ndarray, bucket: np.ndarray, count: np.ndarray, weight: np.ndarray,
            log_likelihood: np.ndarray, background: np.ndarray) -> np.ndarray:
    """By how much each document's mixture beats the background, penalty included."""
    if not len(log_likelihood):
        return np.zeros(len(weight))
    own = (weight[doc] * np.exp(log_likelihood.T[bucket])).sum(axis=1)
    gain = np.bincount(doc, count * (np.log(own) - background[bucket]), len(weight))
    return gain + np.log(np.maximum(np.bincount(doc, count, len(weight)), 2))


def mixtures(doc: np.ndarray, bucket: np.ndarray, count: np.ndarray, n_docs: int,
             log_likelihood: np.ndarray) -> np.ndarray:
    """Proportions (documents x languages) of the selected language sets."""
    k = len(log_likelihood)
    weight = np.zeros((n_docs, k))
    if not k or not len(doc):
        return weight
    # relative likelihoods: a factor common to all languages changes nothing
    like = np.exp(log_likelihood - log_likelihood.max(axis=0)).T[bucket]
    count = count.astype(float)
    begin = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    length = np.diff(np.r_[begin, len(doc)])
    docs, n = doc[begin], np.add.reduceat(count, begin)

    def fit(which: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """EM over the documents ``which`` with ``allowed`` languages each; a
        document leaves the rounds when its proportions stand still."""
        final = allowed / allowed.sum(axis=1, keepdims=True)
        going = np.arange(len(which))
        for _ in range(ROUNDS):
            size, at, start = span(which[going])
            each = np.repeat(final[going], size, axis=0) * like[at]
            each *= (count[at] / each.sum(axis=1))[:, None]
            new = np.add.reduceat(each, start, axis=0) / n[which[going]][:, None]
            moved = np.abs(new - final[going]).max(axis=1)
            final[going] = new
            going = going[moved >= 1e-3]
            if not len(going):
                break
        size, at, start = span(which)
        total = (np.repeat(final, size, axis=0) * like[at]).sum(axis=1)
        return final, np.add.reduceat(count[at] * np.log(total), start)

    def span(which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = length[which]
        upto = np.cumsum(size)
        start = upto - size
        return size, np.arange(int(upto[-1])) + np.repeat(begin[which] - start, size), start

    penalty = np.log(np.maximum(n, 2))
    alone = np.add.reduceat(np.log(like) * count[:, None], begin, axis=0)
    single = alone.argmax(axis=1)
    best = np.eye(k)[single]
    allowed = best.copy()
    # log L is concave in the proportions, so no mixture gains more over the best
    # single language than its steepest slope there; where even that gain is less
    # than the penalty of one more language, the single language is the choice
    own = like[np.arange(len(like)), np.repeat(single, length)]
    slope = np.add.reduceat(like * (count / own)[:, None], begin, axis=0).max(axis=1) - n
    trying = np.flatnonzero(2 * slope > penalty)
    bic = np.full(len(docs), -np.inf)
    if len(trying):
        allowed[trying] = 1
        best[trying], score = fit(trying, allowed[trying])
        bic[trying] = -2 * score + (k - 1) * penalty[trying]
    while len(trying) and k > 1:
        fewer = allowed[trying].copy()
        least = np.where(fewer > 0, best[trying], np.inf)
        # of equal proportions the language that sorts last goes first
        fewer[np.arange(len(trying)), k - 1 - np.argmin(least[:, ::-1], axis=1)] = 0
        pi, score = fit(trying, fewer)
        new = -2 * score + (fewer.sum(axis=1) - 1) * penalty[trying]
        better = new <= bic[trying]
        took = trying[better]
        best[took], bic[took], allowed[took] = pi[better], new[better], fewer[better]
        trying = took[allowed[took].sum(axis=1) > 1]
    weight[docs] = best * allowed
    return weight


def predict(docs: DataFrame, languages: list[str], log_likelihood: np.ndarray) -> DataFrame:
    """The rows of ``docs`` (one struct column ``row`` and ``text``) with
    ``lang_pred``, ``score``, ``mixture`` (proportion by language) and ``margin``
    (NULL without a background, 0 where nothing was learned)."""
    schema = T.StructType([docs.schema["row"], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()),
                           T.StructField("mixture", T.MapType(T.StringType(), T.DoubleType())),
                           T.StructField("margin", T.DoubleType())])
    model = docs.sparkSession.sparkContext.broadcast((languages, log_likelihood))  # languages x buckets

    def run(batches):
        names, rows = model.value
        loglik = rows[:len(names)]
        for b in text_slices(batches, limit=STEP_BYTES):
            doc, bucket, count = gram_counts(b.column("text"), loglik.shape[1])
            weight = mixtures(doc, bucket, count, b.num_rows, loglik)
            margin = (margins(doc, bucket, count, weight, loglik, rows[-1])
                      if len(rows) > len(names) else [None] * b.num_rows)
            first = weight.argmax(axis=1) if names else np.zeros(b.num_rows, int)
            top = weight.max(axis=1) if names else np.zeros(b.num_rows)
            letters = pc.match_substring_regex(pc.fill_null(b.column("text"), ""), r"\pL")
            top = np.where(letters.to_numpy(zero_copy_only=False), top, 0.0)
            lang = [names[i] if s > 0 else UNKNOWN for i, s in zip(first, top, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(lang), pa.array(np.minimum(top, 1.0)),
                 pa.array([[(names[j], w[j]) for j in np.flatnonzero(w)] for w in weight],
                          pa.map_(pa.string(), pa.float64())),
                 pa.array(margin, pa.float64())],
                ["row", "lang_pred", "score", "mixture", "margin"])

    return on_executors(docs.select("row", "text")).mapInArrow(run, schema)


def identify(docs: DataFrame, labelled: DataFrame, doc_id: str = "doc_id", text: str = "text",
             lang: str = "lang", keep: list[str] | None = None,
             background: bool = False) -> DataFrame:
    """``row`` (struct of ``keep``, by default the id), lang_pred, score, mixture,
    margin for each row of ``docs``; the model learns from ``labelled``."""
    model = learn(labelled.select(labelled[doc_id].alias("doc_id"),
                                  labelled[text].cast("string").alias("text"),
                                  labelled[lang].cast("string").alias("lang")),
                  background=background)
    rows = docs.select(F.struct(*[docs[c] for c in keep or [doc_id]]).alias("row"),
                       docs[text].cast("string").alias("text"))
    return predict(rows, *model)


def training_rows(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The rows a model may learn from: crc32 of the id as text, mod 5, not 0."""
    return docs.filter(F.coalesce(F.pmod(doc_crc(doc_id), F.lit(5)) != 0, F.lit(True)))


def op6_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, training_rows(docs))
    chosen = F.concat_ws(",", F.sort_array(F.map_keys("mixture"))).alias("languages")
    return (found.select(F.col("row.doc_id").alias("doc_id"), "lang_pred", "score", chosen)
            .withColumn("held_out", F.coalesce(F.pmod(doc_crc(), F.lit(5)) == 0, F.lit(False)))
            .select("doc_id", "held_out", "lang_pred", "score", "languages"))
