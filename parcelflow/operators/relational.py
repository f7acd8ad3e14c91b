"""Relational building blocks, expressed with DataFrame built-ins.

The recurring rule in here: nothing gathers one key's rows into one task.
"Row number 1 per key" becomes a max/min over a struct, which Spark
aggregates partially on the map side; a join whose big side may have one key
holding a third of the rows is salted for the hot keys only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from parcelflow.session import stored


def _pick_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                  value_cols: Sequence[str], agg) -> DataFrame:
    fields = list(dict.fromkeys([*order_cols, *value_cols]))
    picked = df.groupBy(*keys).agg(agg(F.struct(*fields)).alias("_pick"))
    return picked.select(*keys, *[F.col(f"_pick.{c}").alias(c) for c in fields])


def latest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                   value_cols: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_cols`` per key.

    Equivalent to ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order_cols
    DESC NULLS LAST) = 1`` when ``order_cols`` is a total order (append the
    value columns as final tie-breakers).  Runs as a partial + final
    aggregate, so a hot key never lands whole in one task.
    """
    return _pick_per_key(df, keys, order_cols, value_cols, F.max)


def first_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                  value_cols: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order_cols`` per key, NULLs first."""
    return _pick_per_key(df, keys, order_cols, value_cols, F.min)


def anti_join(left: DataFrame, right: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Rows of ``left`` whose key is absent from ``right``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return left.join(right.select(*keys), keys, "left_anti")


def add_unknown_member(df: DataFrame, member: dict[str, object]) -> DataFrame:
    """``df UNION DISTINCT (member row)`` for a ``df`` already free of duplicates.

    The member row is added unless an identical row is already present, found
    by a null-safe anti join against the rows sharing the member's first
    column value.  That keeps UNION DISTINCT semantics without a DISTINCT
    shuffle over the whole dimension (G3, G4).
    """
    spark = df.sparkSession
    schema = StructType([StructField(f.name, f.dataType, True) for f in df.schema.fields])
    row = spark.createDataFrame([tuple(member.get(f.name) for f in schema.fields)], schema)
    first = schema.fields[0].name
    same = df.where(F.col(first) == F.lit(member[first]))
    cond = [row[f.name].eqNullSafe(same[f.name]) for f in schema.fields]
    return df.unionByName(row.join(same, cond, "left_anti"))


def unpivot(df: DataFrame, rows: Sequence[Sequence[Column]], names: Sequence[str]) -> DataFrame:
    """One input row → ``len(rows)`` output rows in one pass (``stack``, G5)."""
    args = [F.lit(len(rows))]
    for r in rows:
        args.extend(r)
    return df.select(F.stack(*args)).toDF(*names)


def top_k(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """First ``n`` rows by ``order`` (F1-F3): per-partition top-n, then a merge."""
    return df.orderBy(*order).limit(n)


#: Slots of a partition's keys while the hot ones are looked for.
SLOTS = 64


def hot_keys(big: DataFrame, key: str, partitions: int) -> DataFrame:
    """``key`` and ``salts`` of the keys that hold more than an even partition.

    A key is hot when it has more than 1/``partitions`` of all rows, so there
    are fewer than ``partitions`` of them: the result may be broadcast.  A key
    gets as many salts as its rows would fill partitions.  Keys are counted by their
    hash first, in ``SLOTS`` slots a partition: only the keys of a slot that holds more
    than an even partition (fewer than ``partitions`` too) are counted each, so that not
    every key of the big side is shuffled.  Both counts are partial aggregates; the total
    and the list of these slots are scalar subqueries.
    """
    slots = F.lit(SLOTS * partitions)
    keys = big.select(key, F.pmod(F.xxhash64(key), slots).alias("_slot"))
    total = big.agg(F.count(F.lit(1)).alias("_t")).scalar()
    share = F.col("_n") * F.lit(partitions) / total
    full = keys.groupBy("_slot").agg(F.count(F.lit(1)).alias("_n")).where(share > 1).agg(
        F.collect_list("_slot").alias("_full")).scalar()
    per_key = keys.where(F.array_contains(full, F.col("_slot"))).groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"))
    return per_key.where(share > 1).select(key, F.ceil(share).cast("int").alias("salts"))


def salted_lookup_join(big: DataFrame, dim: DataFrame, key: str, salt_from: str,
                       partitions: int | None = None, how: str = "left",
                       distinct: bool = False) -> DataFrame:
    """``big JOIN dim USING (key)`` where ``dim`` has one row per key.

    Rows of a hot key (:func:`hot_keys`) are spread over its salts by a hash of
    ``salt_from`` (deterministic, so retried tasks produce the same rows), and
    its single ``dim`` row is copied once per salt; every other key keeps salt
    0.  One shuffle on (key, salt), in which no task receives much more than an
    even share; AQE turns it into a broadcast when ``dim`` turns out small.
    ``partitions`` defaults to the session's shuffle partitions.  With ``distinct``,
    equal rows of ``big`` count once: they have the same key and salt, so they meet in the
    join's own shuffle.
    """
    spark = big.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(big, key, partitions))  # fewer than `partitions` rows
    salts = F.coalesce("salts", F.lit(1))
    big_s = (big.join(hot, key, "left")
             .withColumn("_salt", F.pmod(F.xxhash64(salt_from), salts).cast("int")).drop("salts"))
    if distinct:
        big_s = big_s.repartition(key, "_salt").distinct()
    dim_s = (dim.join(hot, key, "left")
             .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts"))
    return big_s.join(dim_s, [key, "_salt"], how).drop("_salt")


def value_histogram(df: DataFrame, keys: Sequence[str], value: str,
                    sums: dict[str, Column] | None = None,
                    weight: str | None = None) -> DataFrame:
    """Per (keys, value) bucket: ``_rows`` (all rows), ``_c`` (rows with a
    non-NULL value) and one sum per ``sums`` entry; plus ``_cum``, the running
    ``_c`` in value order, and ``_n``, the key's total ``_c``.  With ``weight``,
    a row stands for that many.

    The bucket aggregate is partial and spread over reducers by (key, value),
    so a hot key is never merged in one task.  Only then does a window per key
    run over its buckets, whose number is bounded by the value domain (day
    counts), not by the rows.  Aggregate the result with ``median_of`` and
    sums of the bucket columns.
    """
    extra = [F.sum(c).alias(n) for n, c in (sums or {}).items()]
    if weight is None:
        counts = [F.count(F.lit(1)).alias("_rows"), F.count(value).alias("_c")]
    else:
        known = F.when(F.col(value).isNotNull(), F.col(weight)).otherwise(0)
        counts = [F.sum(weight).alias("_rows"), F.sum(known).alias("_c")]
    hist = df.groupBy(*keys, value).agg(*counts, *extra)
    upto = Window.partitionBy(*keys).orderBy(value).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return hist.select("*", F.sum("_c").over(upto).alias("_cum"),
                       F.sum("_c").over(Window.partitionBy(*keys)).alias("_n"))


def median_of(value: str, interpolate: bool = False) -> Column:
    """Aggregate over ``value_histogram`` rows of one key: the exact median.

    ``interpolate=False`` is the middle element (``percentile_disc(0.5)``,
    the lower one for an even count); ``True`` the mean of the two middle
    elements (``median``).  NULL when the key has no non-NULL value.
    """
    v = F.col(value)
    # A bucket covers 0-based positions [_cum - _c, _cum - 1]; the middle
    # positions are floor((n-1)/2) and ceil((n-1)/2).
    first, last = F.col("_cum") - F.col("_c"), F.col("_cum") - 1
    lo = F.floor((F.col("_n") - 1) / 2)
    hi = F.ceil((F.col("_n") - 1) / 2)
    at_lo = F.max(F.when((F.col("_c") > 0) & (first <= lo) & (lo <= last), v))
    if not interpolate:
        return at_lo
    at_hi = F.max(F.when((F.col("_c") > 0) & (first <= hi) & (hi <= last), v))
    return (at_lo + at_hi) / 2


def median_by(df: DataFrame, keys: Sequence[str], value: str, name: str,
              interpolate: bool = False) -> DataFrame:
    """Exact median of ``value`` per key, NULLs ignored (one row per key).

    Why not ``percentile_disc`` directly: its per-task value->count maps are
    merged for one group in one reducer, so a group spanning every map task
    (a district, a year) funnels every task's map into one place.  See
    ``value_histogram`` for the spread alternative used here.
    """
    return (value_histogram(df, keys, value).groupBy(*keys)
            .agg(median_of(value, interpolate).alias(name)))


def median_in_buckets(df: DataFrame, keys: Sequence[str], value: str, name: str,
                      interpolate: bool = False, buckets: int = 4096,
                      levels: int = 2) -> DataFrame:
    """Exact median of a measure with any number of distinct values, per key.

    ``median_by`` keeps one row per distinct value, which for a continuous
    measure is as many as there are rows.  Here each level cuts a key's range
    into equal ``buckets``, counts them (a partial aggregate spread over
    reducers by key and bucket), and keeps only the bucket or buckets that hold
    the middle ranks; a window sees at most ``buckets`` rows of a key.  What
    ``levels`` rounds leave goes through the histogram.  The per-key tables are
    written before they meet the rows, so that Spark joins them by their known
    size and can split a hot key.
    """
    keys = list(keys)
    v = F.col(value).cast("double")
    rows = df.where(v.isNotNull() & ~F.isnan(v)).select(*keys, v.alias("_v"))
    rank = F.col("_n") - 1
    scope = stored(rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_from"), F.max("_v").alias("_to"))
        .select("*", F.floor(rank / 2).alias("_lo"), F.ceil(rank / 2).alias("_hi"),
                F.lit(0).cast("long").alias("_below")), "median")
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]

    def inside() -> DataFrame:
        kept = [F.col(f"r.{c}") for c in [*keys, "_v"]] + [
            F.col(f"s.{c}") for c in ("_n", "_from", "_to", "_lo", "_hi", "_below")]
        return (rows.alias("r").join(scope.alias("s"), same).select(*kept)
                .where(F.col("_v").between(F.col("_from"), F.col("_to"))))

    by = Window.partitionBy(*keys)
    for _ in range(levels):
        width = (F.col("_to") / buckets - F.col("_from") / buckets)
        step = F.floor((F.col("_v") - F.col("_from")) / width)
        at = F.when((width > 0) & (width < float("inf")),
                    F.least(step, F.lit(buckets - 1))).otherwise(0)
        counted = inside().withColumn("_b", at).groupBy(
            *keys, "_n", "_lo", "_hi", "_below", "_b").agg(
            F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_from"), F.max("_v").alias("_to"))
        upto = F.sum("_c").over(by.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
        placed = counted.withColumn("_end", F.col("_below") + upto).withColumn(
            "_start", F.col("_end") - F.col("_c"))
        scope = stored(placed.where((F.col("_start") <= F.col("_hi"))
                                    & (F.col("_end") > F.col("_lo")))
                       .groupBy(*keys, "_n", "_lo", "_hi").agg(
                           F.min("_from").alias("_from"), F.max("_to").alias("_to"),
                           F.min("_start").alias("_below")), "median")
    hist = inside().groupBy(*keys, "_lo", "_hi", "_below", "_v").agg(
        F.count(F.lit(1)).alias("_c"))
    upto = F.sum("_c").over(by.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    placed = hist.withColumn("_end", F.col("_below") + upto).withColumn(
        "_start", F.col("_end") - F.col("_c"))
    holds = lambda r: F.max(F.when((F.col("_start") <= F.col(r))
                                   & (F.col(r) < F.col("_end")), F.col("_v")))
    middle = (holds("_lo") + holds("_hi")) / 2 if interpolate else holds("_lo")
    return placed.groupBy(*keys).agg(middle.alias(name))
