"""Operator 1: cross-site boilerplate lines by distinct-site spread.

A line (trimmed) is boilerplate when it stands on ``min_sites`` or more distinct
sites.  Every line hash gets one HyperLogLog sketch of its sites, built and
merged by partial aggregation, so a line that a third of all documents hold
reaches its reducer as one small sketch a task.  Only lines whose estimate lies
near the threshold, where the sketch could be wrong, get exact distinct counts.
Boilerplate lines are then removed from the texts.

The line occurrences (document key, position, line hash, site; no text) are
written once and read by each step.  Small tables are written before they are
joined, so that Spark broadcasts them by their size or splits a hot partition.

Defined results: a NULL text stays NULL and has no lines; blank lines are never
removed; a text whose lines all go becomes empty, its document stays; a NULL site
counts for no line; repeated rows are cleaned alike; an empty table gives an empty
table.  All other columns come through unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm.common import table
from parcelflow.session import stored

MIN_SITES = 10
#: Sketch of 2^10 registers: a relative standard error of about 1.04 / 32.
SKETCH_BITS = 10
#: Standard errors around the threshold within which a line is counted exactly.
DOUBT = 5


def site_spread(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``h`` of the lines of ``lines`` (h, site) on ``min_sites`` or more sites."""
    error = DOUBT * 1.04 / 2 ** (SKETCH_BITS / 2)
    estimate = F.hll_sketch_estimate(F.hll_sketch_agg("site", SKETCH_BITS))
    spread = stored(lines.groupBy("h").agg(F.count("site").alias("n"), estimate.alias("sites"))
                    .filter((F.col("n") >= min_sites) &
                            (F.col("sites") >= min_sites * (1 - error) - 1)), "spread")
    near = F.col("sites") <= min_sites * (1 + error) + 1
    exact = (lines.join(spread.filter(near).select("h"), "h").groupBy("h")
             .agg(F.countDistinct("site").alias("sites"))
             .filter(F.col("sites") >= min_sites))
    return spread.filter(~near).select("h").unionByName(exact.select("h"))


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, doc_id: str = "doc_id",
                       text: str = "text", site: str = "source") -> DataFrame:
    """``row`` (struct of all columns, the text cleaned), ``n_lines`` and
    ``n_removed`` for every row of ``docs``."""
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    body = F.col("row").getField(text).cast("string")
    keyed = whole.select(
        "row", body.alias("body"),
        F.xxhash64(F.col("row").getField(doc_id), body).alias("k1"),
        F.xxhash64(F.lit("second"), body, F.col("row").getField(doc_id)).alias("k2"))
    line = F.trim("line")
    lines = stored(
        keyed.select("k1", "k2", F.col("row").getField(site).alias("site"),
                     F.posexplode(F.split("body", "\n")).alias("at", "line"))
        .filter(line != "").select("k1", "k2", "at", "site", F.xxhash64(line).alias("h")),
        "lines")
    bad = stored(site_spread(lines, min_sites), "boilerplate")
    gone = (lines.join(bad, "h").groupBy("k1", "k2")
            .agg(F.sort_array(F.collect_set("at")).alias("gone")))
    split = (keyed.join(stored(gone, "removed"), ["k1", "k2"], "left")
             .select("row", "gone", F.split("body", "\n").alias("line")))
    cleaned = F.when(F.col("gone").isNull(), F.col("row").getField(text)).otherwise(
        F.concat_ws("\n", _without("line", "gone")))
    return split.select(
        F.struct(*[(cleaned if c == text else F.col("row").getField(c)).alias(c)
                   for c in docs.columns]).alias("row"),
        F.when(F.col("line").isNull(), 0).otherwise(F.size("line")).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long")
        .alias("n_removed"))


def _without(items: str, gone: str) -> Column:
    """The array without the sorted positions: the stretches between them."""
    starts = F.concat(F.array(F.lit(0)), F.transform(gone, lambda p: p + 1))
    ends = F.concat(F.col(gone), F.array(F.size(items)))
    return F.flatten(F.transform(
        F.arrays_zip(starts.alias("a"), ends.alias("b")),
        lambda z: F.slice(items, z["a"] + 1, z["b"] - z["a"])))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_boilerplate(table(spark, sf_dir, "documents"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed",
                        F.col("row.text").alias("text"))


OP1_SQL = f"""
WITH lines AS (
  SELECT doc_id, source, line, place FROM (
    SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
           unnest(range(len(string_split(text, chr(10))))) AS place
    FROM documents WHERE text IS NOT NULL)),
spread AS (
  SELECT trim(line) AS bad FROM lines WHERE trim(line) <> '' GROUP BY 1
  HAVING count(DISTINCT source) >= {MIN_SITES}),
marked AS (
  SELECT l.*, s.bad IS NOT NULL AS gone FROM lines l LEFT JOIN spread s ON trim(l.line) = s.bad)
SELECT d.doc_id, count(m.place) AS n_lines, count(m.place) FILTER (WHERE gone) AS n_removed,
       CASE WHEN any_value(d.text) IS NOT NULL THEN
         coalesce(string_agg(m.line, chr(10) ORDER BY m.place) FILTER (WHERE NOT gone), '') END AS text
FROM documents d LEFT JOIN marked m USING (doc_id) GROUP BY d.doc_id
"""
