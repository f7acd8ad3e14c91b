"""Operator 12: URL filter by association rules.

Stated rules (host and path, block or allow) judge the URLs they fit; the longest
wins.  The others are judged by what the labelled URLs teach: each URL is a set of
tokens (scheme, host labels, path segments, extension, query keys and settings,
fragment), FP-growth finds the combinations that are frequent with a label, and
those of enough confidence become rules.  A rule that a rule with one token less
and no less confidence implies goes.

Rules match by an inverted index: each rule stands under its rarest token, a URL
looks up its tokens and checks the whole combination there.  URLs are matched by
their distinct sets of rule tokens.  Of the matching rules the most confident
decides, then the most frequent, the longest, the first by label and tokens; a URL
that none matches is allowed.

Learning uses at most SAMPLE labelled URLs (in expectation, by a hash of the URL
and its key).  A token of a frequent combination occurs in ``support`` of them, so
the number of rule tokens is bounded by the tokens of a URL over ``support``; tokens
that stand in exactly the same labelled URLs are one item, so URLs of one template
don't multiply combinations.

Defined results: a NULL URL or one without ``://`` has an empty host and path, no
token and, as any URL that no rule fits, the verdict allow.  Without labelled URLs
there are no mined rules.  Repeated rows get equal rows; an empty table gives an
empty table.  Only the id and url columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm.common import table
from parcelflow.session import stored

BLOCK, ALLOW = "block", "allow"
SAMPLE = 200_000
SUPPORT, CONFIDENCE = 0.005, 0.9
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The stated rules.
RULES = (
    Rule("net", "/", BLOCK),
    Rule("example.net", "/en/", ALLOW),
    Rule("example.com", "/de/", BLOCK),
    Rule("org", "/fr/", ALLOW),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    rest = F.split(F.coalesce(url, F.lit("")), "://", 2).getItem(1)
    return F.when(url.contains("://"), F.translate(
        F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    rest = F.split(F.coalesce(url, F.lit("")), "://", 2).getItem(1)
    return F.when(url.contains("://"), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise(
        F.lit(""))


def stated_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """struct<name, verdict> of the longest rule that fits; NULL without one."""
    fits = lambda r: ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
    longest = sorted(rules, key=lambda r: (-len(r.name), r.name))
    none = F.lit(None).cast("struct<name:string,verdict:string>")
    return reduce(lambda otherwise, r: F.when(fits(r), F.struct(
        F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(otherwise),
        reversed(longest), none)


def tokens(url: Column) -> Column:
    """The sorted set of a URL's tokens; numbers in a path are one token."""
    named = lambda kind, items: F.transform(items, lambda x: F.concat(F.lit(kind), x))
    some = lambda items: F.filter(items, lambda x: x != "")
    host, path = host_of(url), path_of(url)
    segments = some(F.split(path, "/"))
    stem = F.transform(segments, lambda s: F.regexp_replace(
        F.regexp_replace(s, r"\.[A-Za-z0-9]+$", ""), "[0-9]+", "0"))
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    settings = some(F.split(query, "&"))
    one = lambda kind, value: F.when(value == "", F.array().cast("array<string>")).otherwise(
        F.array(F.concat(F.lit(kind), value)))
    every = F.concat(
        one("scheme:", F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)),
        named("host:", some(F.split(host, r"\."))), named("path:", some(stem)),
        one("type:", F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)),
        named("key:", F.transform(settings, lambda s: F.regexp_extract(s, "^[^=]*", 0))),
        named("set:", settings), one("part:", F.regexp_extract(url, "#(.*)$", 1)))
    return F.when(url.contains("://"), F.array_sort(F.array_distinct(every))).otherwise(
        F.array().cast("array<string>"))


def labelled_sample(labelled: DataFrame, sample: int) -> DataFrame:
    """Of key, url, label about ``sample`` rows."""
    labelled = labelled.filter("url is not null and label is not null")
    share = min(1.0, sample / max(labelled.count(), 1))
    picked = F.pmod(F.xxhash64("key", "url"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    return labelled.filter(picked) if share < 1 else labelled


def mined_rules(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE,
                sample: int = SAMPLE) -> DataFrame:
    """items (sorted tokens), label, confidence, n (labelled URLs it fits), of ``key``,
    ``url``, ``label``."""
    rows = stored(labelled_sample(labelled, sample).select(
        F.monotonically_increasing_id().alias("at"), tokens(F.col("url")).alias("tokens"), "label"),
        "labelled-urls")
    least = support * rows.count()
    # tokens of the same URLs are one item, named by the first of them
    each = rows.select("at", F.explode("tokens").alias("token"))
    same = (each.groupBy("token").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("at")).alias("where"),
        F.bit_xor(F.xxhash64(F.lit("again"), F.col("at"))).alias("where2"))
        .filter(F.col("n") >= least)
        .groupBy("n", "where", "where2").agg(F.min("token").alias("item")))
    items = stored(same.select("item", "n"), "items")
    baskets = (each.join(items.select(F.col("item").alias("token")), "token")
               .groupBy("at").agg(F.collect_set("token").alias("found")))
    basket = (rows.select("at", "label").join(baskets, "at", "left")
              .select(F.concat(F.coalesce("found", F.array().cast("array<string>")),
                               F.array(F.concat(F.lit("label:"), "label"))).alias("items")))
    if rows.isEmpty():
        return rows.sparkSession.createDataFrame(
            [], "items array<string>, label string, confidence double, n long")
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(basket)
    counted = model.freqItemsets.select(F.array_sort("items").alias("items"), "freq")
    is_label = lambda x: x.startswith("label:")
    with_label = (counted.filter(F.size(F.filter("items", is_label)) == 1)
                  .select(F.filter("items", lambda x: ~is_label(x)).alias("items"),
                          F.substring(F.filter("items", is_label)[0], 7, 1 << 30).alias("label"),
                          F.col("freq").alias("hits")).filter(F.size("items") > 0))
    rules = stored(with_label.join(counted, "items").select(
        "items", "label", (F.col("hits") / F.col("freq")).alias("confidence"),
        F.col("freq").alias("n")).filter(F.col("confidence") >= confidence), "rules")
    less = F.explode(F.transform("items", lambda x: F.array_except("items", F.array(x))))
    implied = (rules.select("items", "label", "confidence", less.alias("fewer"))
               .join(rules.select(F.col("items").alias("fewer"), "label",
                                  F.col("confidence").alias("before")), ["fewer", "label"])
               .filter("before >= confidence").select("items", "label").distinct())
    return rules.join(implied, ["items", "label"], "left_anti").select(
        "items", "label", "confidence", "n")


def judged(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (with ``tokens``) with ``mined``: the label of the rule that decides."""
    rules = stored(rules, "mined-rules")
    known = stored(rules.select(F.explode("items").alias("token")).groupBy("token")
                   .agg(F.count("*").alias("n")), "rule-tokens")
    # bounded: a rule token occurs in `support` of the labelled URLs
    names = sorted(r.token for r in known.collect())
    used = F.array(*map(F.lit, names)).cast("array<string>")
    urls = urls.withColumn("used", F.array_sort(F.array_intersect("tokens", used)))
    index = (rules.select("*", F.explode("items").alias("token"))
             .join(known.withColumnRenamed("n", "spread"), "token")
             .groupBy("items", "label", "confidence", "n")
             .agg(F.min_by("token", F.struct("spread", "token")).alias("token")))
    sets = urls.filter(F.size("used") > 0).select("used").distinct()
    order = F.struct(F.negative("confidence"), F.negative("n"), F.negative(F.size("items")), "label",
                     "items")
    decided = stored(sets.select("used", F.explode("used").alias("token")).join(index, "token")
                     .filter(F.size(F.array_intersect("items", "used")) == F.size("items"))
                     .groupBy("used").agg(F.min_by("label", order).alias("mined")), "decided")
    return urls.join(decided, "used", "left")


def filter_urls(pages: DataFrame, labelled: DataFrame, rules: tuple[Rule, ...] = RULES,
                support: float = SUPPORT, confidence: float = CONFIDENCE, sample: int = SAMPLE,
                key: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, by_rule (the verdict is a stated rule's), for
    every row of ``pages``; ``labelled`` holds key, url and label."""
    rows = pages.select(pages[key].alias("page_id"), pages[url].cast("string").alias("url"))
    rows = rows.select("page_id", host_of(F.col("url")).alias("host"),
                       path_of(F.col("url")).alias("path"), tokens(F.col("url")).alias("tokens"))
    rows = rows.withColumn("rule", stated_rule(F.col("host"), F.col("path"), rules))
    found = judged(rows, mined_rules(labelled, support, confidence, sample))
    return found.select("page_id", "host", "path", F.col("rule.name").alias("rule"),
                        F.coalesce("rule.verdict", "mined", F.lit(ALLOW)).alias("verdict"),
                        F.col("rule").isNotNull().alias("by_rule"))


def labelled_by_rules(pages: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "page_id",
                      url: str = "url") -> DataFrame:
    """key, url, label of the URLs that a stated rule fits."""
    link = pages[url].cast("string")
    return pages.select(pages[key].alias("key"), link.alias("url"), stated_rule(
        host_of(link), path_of(link), rules)["verdict"].alias("label")).filter("label is not null")


def op12_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return filter_urls(pages, labelled_by_rules(pages))
