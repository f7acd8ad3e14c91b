"""Land newline-delimited JSON feeds as all-text tables.

A feed is read twice, each time distributed:

1. survey — every line parsed as ``map<string,string>``, keys exploded and
   de-duplicated (one shuffle of key names only; the result is the table's
   column list, so its size is the schema width, not the data).  The same
   aggregate counts the lines and the broken ones;
2. load — the files read again with an explicit all-``string`` schema built
   from those keys and written, so no value is type-guessed: ``1.50`` stays
   ``1.50``, nested objects and lists stay JSON text, absent keys become NULL,
   and unknown fields are ignored.  The rows written are observed on the way.

Column names are sanitized; two keys that sanitize to the same name are an
error.  Broken lines or a feed with no rows stop the run after the first read,
and whatever stops it, the tables published before stay as they are: all feeds
of a run become visible at once (:mod:`parcelflow.sources.publish`).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from parcelflow.functions.columns import whole_object
from parcelflow.sources.publish import Draft, Published


class LandingError(RuntimeError):
    pass


# Fixed value: the characters that a column name cannot have.
NOT_IN_NAMES = re.compile("[^0-9a-zA-Z_]")
#: Distinct keys a feed may have (a parameter of each entry point); more means data
#: in key names, and stops the landing.
MOST_KEYS = 5_000


def column_name(key: str) -> str:
    """Feed field name → column name (A3): each character that is no ASCII letter, digit
    or ``_`` becomes ``_``, those at the ends go, letters are lowered, and a leading digit
    gets a ``_`` before it."""
    name = NOT_IN_NAMES.sub("_", key).strip("_").lower()
    return f"_{name}" if name[:1].isdigit() else name


def _records(spark: SparkSession, path: str) -> DataFrame:
    """``value`` and ``record`` (a map) of each line that is not blank; the map
    is NULL for a line that isn't one whole JSON object."""
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    return lines.select("value", whole_object("value", "map<string,string>").alias("record"))


@dataclass(frozen=True)
class Survey:
    """What the first read of a feed finds: its keys, sorted, its lines and broken lines."""
    keys: list[str]
    lines: int
    broken: int


def survey(spark: SparkSession, path: str, most_keys: int = MOST_KEYS) -> Survey:
    """One read of the feed: the union of the keys of every record (A5), and how many
    lines it has, blank ones apart, and how many of them are no JSON object: every line
    has the key NULL besides its own, whose count is the lines."""
    own = F.coalesce(F.map_keys("record"), F.array().cast("array<string>"))
    counted = (_records(spark, path).select(
        F.col("record").isNull().alias("broken"),
        F.explode(F.concat(F.array(F.lit(None).cast("string")), own)).alias("k"))
        .groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.count_if("broken").alias("broken"))
        .limit(most_keys + 2).collect())
    keys = sorted(r.k for r in counted if r.k is not None)
    if len(keys) > most_keys:
        raise LandingError(f"{path}: over {most_keys} different keys, such as {keys[:3]}")
    lines = next((r for r in counted if r.k is None), None)
    return Survey(keys, lines.n if lines else 0, lines.broken if lines else 0)


def refuse_broken(spark: SparkSession, path: str, found: Survey, shown: int = 3) -> None:
    """Raise :class:`LandingError` with the number of broken lines and a few of them; a
    feed lands whole or not at all.  Only a refused feed is read again, for these few."""
    if found.broken:
        some = _records(spark, path).where("record is null").limit(shown).collect()
        raise LandingError(f"{path}: {found.broken} lines are no JSON object, such as "
                           f"{[r.value[:80] for r in some]}")


def column_names(keys: list[str]) -> dict[str, str]:
    """Raw key → sanitized column; raise when two keys collide."""
    out: dict[str, str] = {}
    seen: dict[str, str] = {}
    for k in keys:
        name = column_name(k)
        if not name:
            raise LandingError(f"key {k!r} has no usable characters")
        if name in seen:
            raise LandingError(f"keys {seen[name]!r} and {k!r} both map to column {name!r}")
        seen[name] = k
        out[k] = name
    return out


def read_all_text(spark: SparkSession, path: str, keys: list[str] | None = None) -> DataFrame:
    """The feed as an all-``string`` DataFrame with sanitized, sorted columns."""
    keys = survey(spark, path).keys if keys is None else keys
    names = column_names(keys)
    schema = StructType([StructField(k, StringType(), True) for k in keys])
    df = spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
    cols = sorted(names.items(), key=lambda kv: kv[1])
    return df.select(*[F.col(f"`{k}`").alias(n) for k, n in cols])


@dataclass(frozen=True)
class Feed:
    """One registered feed (A7): where its drops land and whether it still changes."""
    table: str
    source: str
    mode: str = "live"  # "frozen" feeds are loaded once, skipped on refresh


def land(spark: SparkSession, feed: Feed, draft: Draft, most_keys: int = MOST_KEYS) -> int:
    """Load a feed into a version that is not published yet (A8, A9); its rows."""
    found = survey(spark, feed.source, most_keys)
    refuse_broken(spark, feed.source, found)
    if not found.lines:
        raise LandingError(f"{feed.source}: feed has no rows; {feed.table} left as it was")
    if not found.keys:
        raise LandingError(f"{feed.source}: no record has a key; {feed.table} left as it was")
    written = Observation()
    df = read_all_text(spark, feed.source, found.keys).observe(
        written, F.count(F.lit(1)).alias("rows"))
    df.write.parquet(draft.path(feed.table), compression="zstd")
    if written.get["rows"] != found.lines:
        raise LandingError(f"{feed.source}: {found.lines} lines, then {written.get['rows']} rows: "
                           f"the feed changed while it was read; {feed.table} left as it was")
    draft.add(feed.table, df)
    return found.lines


def land_registry(spark: SparkSession, feeds: list[Feed], raw_root: str,
                  include_frozen: bool = False, most_keys: int = MOST_KEYS) -> dict[str, DataFrame]:
    """Land every live feed (and the frozen ones when asked) under ``raw_root``, and
    publish them at once; tables of other feeds stay as they are."""
    published = Published(spark, raw_root)
    draft = published.draft()
    landed = [f for f in feeds if include_frozen or f.mode != "frozen"]
    for feed in landed:
        land(spark, feed, draft, most_keys)
    manifest = draft.publish(carry=True)
    return {f.table: published.read(f.table, manifest) for f in landed}
