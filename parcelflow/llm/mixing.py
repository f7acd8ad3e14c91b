"""Operator 9: mixing sources to target weights by hierarchical budgeting.

Documents hang on a tree of domain, language and source.  The token budget is
dealt from the root down.  At each node it is divided among the children in
proportion to their target weights; a child can take no more than its capacity
(its tokens times the epochs allowed), and what it leaves goes to its siblings in
proportion to their weights.  As a node never receives more than its subtree
holds, a shortage is always made up among the siblings first and reaches an
ancestor only when a whole subtree is used up.

Each leaf then selects a token prefix of seeded epochs: every document once for
each full epoch, and of one more epoch the longest prefix, in the order of a
seeded hash, that fits the rest of the budget.  The prefix is found without
sorting a leaf in one task: the hash range of a leaf with n documents is cut into
sqrt(n) buckets, their token sums are added up, and only the one bucket in which
the budget runs out is sorted.

Defined results: NULL domain, language and source are values of their own, named
''; a token is a run of characters other than white space; a document without
tokens is taken when its place in the last epoch lies in the prefix; a leaf without tokens receives no
budget; documents of one id and one text have one place and go by their tokens; weights below 0 are an error; repeated rows are documents of their own;
an empty table gives an empty table.  Budgets are whole tokens, rounded down at
each division.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelflow.llm.common import table
from parcelflow.session import stored

LEVELS = ("domain", "language", "site")
#: Production targets: weights among siblings, by level; others have OTHER_WEIGHT.
TARGETS: dict[str, dict[str, int]] = {
    "domain": {"web0": 30, "web1": 30, "web2": 20, "web3": 20},
    "language": {"en": 55, "de": 15, "fr": 15, "es": 15},
    "site": {},
}
OTHER_WEIGHT = 10
DOMAINS = 4
BUDGET_SHARE = 0.9
MAX_EPOCHS = 3
SEED = 20240


def hash32(name: Column) -> Column:
    """The first 32 bits of the md5, as a long: an order any engine can follow."""
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("long")


def ticket_name(doc_id: Column, text: Column) -> Column:
    """What a document's place in an epoch is drawn by: its id and its text, so that the
    documents of one id, or of none, are spread over a leaf's buckets like others."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), F.substring(
        F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")), 1, 8))


def domain_of(source: Column) -> Column:
    """The production domain: sources are dealt to four domains by a hash."""
    return F.concat(F.lit("web"),
                    (hash32(F.coalesce(source, F.lit(""))) % DOMAINS).cast("string"))


def weight_of(name: Column, weights: dict[str, int]) -> Column:
    if any(w < 0 for w in weights.values()):
        raise ValueError(f"negative weight: {weights}")
    out = F.lit(OTHER_WEIGHT)
    for k, w in weights.items():
        out = F.when(name == k, F.lit(w)).otherwise(out)
    return out.cast("double")


def divide(children: DataFrame, parents: list[str], child: str,
           weights: dict[str, int]) -> DataFrame:
    """``children`` (parents, child, capacity, and the parent's ``budget``) with
    the budget divided.  Children are visited by capacity over weight: those that
    the water level covers are full, the others share the rest by weight."""
    low = (children.withColumn("w", weight_of(F.col(child), weights))
           .withColumn("ratio", F.when(F.col("w") > 0, F.col("capacity") / F.col("w"))))
    by = W.partitionBy(*parents) if parents else W.partitionBy(F.lit(0))
    order = by.orderBy(F.col("ratio").asc_nulls_last(), child)
    before = order.rowsBetween(W.unboundedPreceding, -1)
    onward = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    left = F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0))
    full = (F.col("w") > 0) & (F.col("capacity").cast("double") * F.sum("w").over(onward)
                               <= left.cast("double") * F.col("w"))
    marked = low.withColumn("full", full)
    rest = F.col("budget") - F.coalesce(
        F.sum(F.when(F.col("full"), F.col("capacity"))).over(by), F.lit(0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("w"))).over(by)
    share = F.when(F.col("full"), F.col("capacity")).when(F.col("w") > 0, F.floor(
        rest.cast("double") * F.col("w") / open_weight)).otherwise(0).cast("long")
    return (marked.withColumn("share", share).withColumn("budget", F.least("share", "capacity"))
            .drop("share", "w", "ratio", "full"))


def leaf_budgets(leaves: DataFrame, targets: dict[str, dict[str, int]], budget_share: float,
                 max_epochs: int) -> DataFrame:
    """LEVELS, docs, tokens, ``budget`` of each leaf.  One row a source, small
    beside the documents; a window holds the children of one node."""
    leaves = leaves.withColumn("capacity", F.col("tokens") * max_epochs)
    total = leaves.agg(F.sum("tokens").alias("t"), F.sum("capacity").alias("c")).select(
        F.least(F.floor(F.col("t") * F.lit(budget_share)).cast("long"), "c").alias("budget"))
    dealt, keys = total, []
    for level in LEVELS:
        children = leaves.groupBy(*keys, level).agg(F.sum("capacity").alias("capacity"))
        joined = (children.join(dealt.drop("capacity"), keys) if keys
                  else children.withColumn("budget", dealt.scalar()))  # the root's one row
        dealt = divide(joined, keys, level, targets.get(level, {}))
        keys = [*keys, level]
    return leaves.join(dealt.select(*LEVELS, "budget"), list(LEVELS)).drop("capacity")


def mix(docs: DataFrame, domain: Column, targets: dict[str, dict[str, int]] | None = None,
        budget_share: float = BUDGET_SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
        keep: list[str] | None = None, doc_id: str = "doc_id", text: str = "text",
        lang: str = "lang", source: str = "source") -> DataFrame:
    """``row`` (struct of ``keep``, by default all columns), domain, language,
    site, n_tokens and ``copies`` (how often the mix holds it, above 0)."""
    named = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    rows = stored(docs.select(  # the texts are read and counted once
        F.struct(*[docs[c] for c in keep or docs.columns]).alias("row"),
        named(domain).alias("domain"), named(docs[lang]).alias("language"),
        named(docs[source]).alias("site"),
        F.coalesce(F.regexp_count(docs[text].cast("string"), F.lit(r"\S+")), F.lit(0))
        .cast("long").alias("n_tokens"),
        ticket_name(docs[doc_id], docs[text]).alias("name"),
        F.xxhash64(docs[text]).alias("tie")), "tokens")
    leaves = stored(rows.groupBy(*LEVELS).agg(F.count("*").alias("docs"),
                                              F.sum("n_tokens").alias("tokens")), "leaves")
    some = F.greatest("tokens", F.lit(1))
    plan = stored(leaf_budgets(leaves, targets or TARGETS, budget_share, max_epochs).select(
        *LEVELS, F.expr("budget div greatest(tokens, 1L)").alias("epochs"),
        (F.col("budget") % some).alias("rest"),
        F.ceil(F.sqrt("docs")).cast("long").alias("buckets")), "plan")
    ticket = F.concat_ws(":", F.lit(str(seed)), F.col("epochs").cast("string"), "name")
    ordered = (rows.join(plan, list(LEVELS))
               .withColumns({"order": F.md5(ticket.cast("binary")), "spot": hash32(ticket)})
               .withColumn("bucket", F.expr("spot * buckets div 4294967296")))
    sums = ordered.groupBy(*LEVELS, "rest", "bucket").agg(F.sum("n_tokens").alias("n"))
    upto = F.sum("n").over(W.partitionBy(*LEVELS).orderBy("bucket")
                           .rowsBetween(W.unboundedPreceding, 0))
    last = stored(sums.withColumn("upto", upto).filter("upto > rest").groupBy(*LEVELS)
                  .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("n")).alias("before")))
                       .alias("last")).select(*LEVELS, "last.*")
                  .withColumnRenamed("bucket", "last"), "last")
    placed = ordered.join(last, list(LEVELS), "left")
    inside = F.when(F.col("last").isNull() | (F.col("bucket") < F.col("last")), 1)
    sure = placed.filter("last is null or bucket <> last").withColumn(
        "copies", F.col("epochs") + F.coalesce(inside, F.lit(0)))
    place = W.partitionBy(*LEVELS).orderBy("order", "n_tokens", "tie")
    taken = F.col("before") + F.sum("n_tokens").over(
        place.rowsBetween(W.unboundedPreceding, 0)) <= F.col("rest")
    tried = placed.filter("bucket = last").withColumn(
        "copies", F.col("epochs") + F.when(taken, 1).otherwise(0))
    out = ["row", *LEVELS, "n_tokens", F.col("copies").cast("long").alias("copies")]
    return sure.select(*out).unionByName(tried.select(*out)).filter("copies > 0")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mix(docs, domain_of(docs["source"]), keep=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"), *LEVELS, "n_tokens", "copies")


def _weight_sql(name: str, weights: dict[str, int]) -> str:
    cases = " ".join(f"WHEN {name} = '{k}' THEN {w}" for k, w in weights.items())
    return f"CASE {cases} ELSE {OTHER_WEIGHT} END" if cases else str(OTHER_WEIGHT)


def _level_sql(level: int) -> str:
    """One level of the tree: how full each child is at the water level that its
    siblings before it (by capacity over weight) leave."""
    keys, child, above = LEVELS[:level], LEVELS[level], f"dealt{level}"
    cols = ", ".join([*keys, child])
    by = f"PARTITION BY {', '.join('s.' + k for k in keys)} " if keys else ""
    on = f"USING ({', '.join(keys)})" if keys else "ON true"
    return f"""
size{level} AS (SELECT {cols}, sum(tokens) * {MAX_EPOCHS} AS cap,
                {_weight_sql(child, TARGETS[child])}::DOUBLE AS w FROM leaves GROUP BY {cols}),
level{level} AS (
  SELECT s.*, a.budget AS above, CASE WHEN s.w > 0 THEN s.cap / s.w END AS ratio,
    s.w > 0 AND s.cap::DOUBLE * sum(s.w) OVER ({by}ORDER BY s.cap / s.w, {child}
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
      <= (a.budget - coalesce(sum(s.cap) OVER ({by}ORDER BY s.cap / s.w, {child}
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE * s.w AS is_full
  FROM size{level} s JOIN {above} a {on}),
dealt{level + 1} AS (
  SELECT {cols}, CASE WHEN is_full THEN cap ELSE least(cap, floor(
      (above - coalesce(sum(CASE WHEN is_full THEN cap END) OVER ({by}), 0))::DOUBLE * w
      / sum(CASE WHEN NOT is_full THEN w END) OVER ({by}))) END::BIGINT AS budget
  FROM level{level} s)"""


OP9_SQL = f"""
WITH docs AS (
  SELECT doc_id, 'web' || (('0x' || substr(md5(coalesce(source, '')), 1, 8))::BIGINT
         % {DOMAINS}) AS domain, coalesce(lang, '') AS language, coalesce(source, '') AS site,
         len(regexp_extract_all(coalesce(text, ''), '\\S+')) AS n_tokens,
         doc_id || ':' || substr(md5(coalesce(text, '')), 1, 8) AS name FROM documents),
leaves AS (SELECT {', '.join(LEVELS)}, sum(n_tokens) AS tokens FROM docs GROUP BY ALL),
dealt0 AS (SELECT least(floor(sum(tokens) * {BUDGET_SHARE}::DOUBLE), sum(tokens) * {MAX_EPOCHS})
           ::BIGINT AS budget FROM leaves),
{','.join(_level_sql(k) for k in range(3))},
plan AS (SELECT l.*, d.budget // greatest(tokens, 1)::BIGINT AS epochs,
         d.budget % greatest(tokens, 1)::BIGINT AS rest
         FROM leaves l JOIN dealt3 d USING ({', '.join(LEVELS)})),
placed AS (
  SELECT d.*, p.epochs, p.rest, sum(d.n_tokens) OVER (PARTITION BY domain, language, site
      ORDER BY md5('{SEED}:' || p.epochs || ':' || d.name) ROWS UNBOUNDED PRECEDING) AS upto
  FROM docs d JOIN plan p USING ({', '.join(LEVELS)}))
SELECT doc_id, {', '.join(LEVELS)}, n_tokens, (epochs + (upto <= rest)::BIGINT)::BIGINT AS copies
FROM placed WHERE epochs > 0 OR upto <= rest
"""
