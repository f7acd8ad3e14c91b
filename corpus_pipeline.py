"""Corpus pipeline: from raw documents to a mixed, tokenised training set.

Each stage takes (spark, docs, sf_dir) and works on all rows of its predecessor;
:func:`run` writes every stage's rows as Parquet in the shared folder and gives
the written table to the next one.

1. language id: documents without a letter, those in which no language reaches a
   share of MIN_SHARE, and those that no learned language explains better than the
   background (random letters, unlearned scripts) go; a missing ``lang`` is filled in.
   Where no row has a ``lang``, nothing is learned and only letterless documents go.
2. line dedup: cross-site boilerplate lines go out of the texts.
3. n-gram Jaccard join: of each group of near duplicate texts one row stays, that with
   the smallest id (a missing one comes last; then by hashes of text and row).  Rows are
   judged by their texts, whatever their ids: of rows with one id and texts that don't
   resemble each other each stays, of copies with clashing or missing ids one.  Of texts
   without a word only rows that repeat id and text go.
4. mixing: documents fill the token budgets of their sources; a document that the
   mix holds several times appears in as many rows.
5. BPE: token counts and digests of the ids and of the decoded text.

Rows with a NULL id go through stages 1 to 4 like any other row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm.bpe import round_trip_digests
from parcelflow.llm.common import table
from parcelflow.llm.jaccard_join import near_duplicates
from parcelflow.llm.language_id import UNKNOWN, identify, training_rows
from parcelflow.llm.line_dedup import remove_boilerplate
from parcelflow.llm.mixing import domain_of, mix
from parcelflow.session import forget, stored, temporary

MIN_SHARE = 0.2


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = identify(docs, training_rows(docs), keep=docs.columns, background=True)
    spoken = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_SHARE) & (F.col("margin") >= 0)
    # a document with a letter has score 0 only where nothing could be learned
    kept = found.filter(spoken | ((F.col("score") == 0) &
                                  F.col("row").getField("text").cast("string").rlike(r"\p{L}")))
    return kept.select(*[
        (F.coalesce(F.col("row").getField(c), "lang_pred") if c == "lang"
         else F.col("row").getField(c)).alias(c) for c in docs.columns])


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_boilerplate(docs).select("row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # rows are told apart by a number of their own: ids may clash or be missing.  The
    # columns go by their place, so that no name of theirs meets one used here.
    place = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    text = docs["text"].cast("string")
    numbered = stored(docs.select(
        *[docs[c].alias(n) for c, n in place.items()],
        F.monotonically_increasing_id().alias("at"), F.xxhash64(text).alias("k1"),
        F.xxhash64(F.lit("second"), text).alias("k2"),
        F.xxhash64(*[docs[c] for c in docs.columns]).alias("k3")), "numbered")
    classes = near_duplicates(numbered.select(
        F.col("at").alias("doc_id"), F.col(place["text"]).cast("string").alias("text")))
    keys = numbered.select("at", F.col(place["doc_id"]).cast("long").alias("doc_id"), "k1", "k2", "k3")
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2", "k3", "at")
    best = (classes.select(F.col("doc_id").alias("at"), "class_id").join(keys, "at")
            .groupBy("class_id").agg(F.min(rank).alias("best")).select("best.*"))
    # texts without a word link with nothing: of those only repeated rows go
    kept = best.groupBy("doc_id", "k1", "k2").agg(F.min_by("at", F.struct("k3", "at")).alias("at"))
    # by shuffle at every size: what is kept grows with the documents
    return (numbered.join(stored(kept.select("at"), "kept").hint("merge"), "at", "left_semi")
            .select(*[F.col(n).alias(c) for c, n in place.items()]))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mix(docs, domain_of(docs["source"]))
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return mixed.select("row", each.alias("_epoch")).select("row.*")


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return round_trip_digests(docs)


STAGES = [
    ("language id", language_stage),
    ("line dedup", line_stage),
    ("n-gram jaccard join", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = given = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with temporary(spark):  # what the operator wrote on its way goes with the stage
            kept = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}", keep=True)
        if docs is not given:
            forget(docs)
        docs = kept
    return docs


#: Language prediction and tokenisation have no SQL form: tested by brute force.
ORACLE_SQL = None
