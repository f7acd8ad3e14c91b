"""Bind the driver's TPC-H-style tables to the three raw feeds.

The entity ("pin") is the order; each line item is a violation.  Every raw
column is text, as the landing step produces it, so staging's casts and
cleaning run on real dirt: padded pins, blank pins, missing districts,
unparseable dates, malformed points, far-away coordinates, duplicate rows.

All rules are integer arithmetic on keys, so Spark and the SQL oracle
(``parcelflow.oracle``) derive byte-identical text.  No rule drops rows to
save work: the moduli decide which *kind* of dirt a row carries, every line
item of the given tables becomes a violation, and every urgent order is on the
dangerous-building list.

Dates are moved forward by ``DATE_SHIFT_DAYS`` (exactly 9 years for these
years) so the history straddles the 2005-01-01 start of the date spine and
the binding's ``as_of`` (2010-06-30): both bounds of the fact filter are hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.session import stored
from parcelflow.sources.seeds import builtin_labels

DATE_SHIFT_DAYS = 3287

# Columns read from each given table (projection reaches the Parquet scan).
_USED = {
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                 "l_returnflag", "l_linestatus", "l_shipdate"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
               "o_orderpriority"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "part": ["p_partkey", "p_brand", "p_type", "p_size"],
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    cols = _USED.get(name)
    return df.select(*cols) if cols else df


def _iso_text(ts: str) -> Column:
    """Shifted date as the feed's ISO date-time text."""
    day = F.date_add(F.col(ts).cast("date"), DATE_SHIFT_DAYS)
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T00:00:00.000"))


def _coord_text(key: str) -> tuple[Column, Column]:
    """(lat, lng) text from key digits: some inside the box, some outside."""
    k = F.col(key)
    lat = F.concat(F.lit("39."), F.lpad(((k * 7) % 1000).cast("string"), 3, "0"))
    lng = F.concat(F.lit("-94."), F.lpad((k % 1000).cast("string"), 3, "0"))
    return lat, lng


def _point_json(lat: Column, lng: Column) -> Column:
    return F.concat(F.lit('{"type":"Point","coordinates":['), lng, F.lit(","), lat,
                    F.lit("]}"))


def _district(custkey: Column, regionkey: Column) -> Column:
    return (F.when(custkey % 31 == 0, F.lit(None).cast("string"))
            .when(custkey % 29 == 0, F.lit(" "))
            .otherwise((regionkey + 1).cast("string")))


# What the two violation feeds are made of.
_BASE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag",
                 "l_linestatus", "l_shipdate", "o_custkey", "o_orderdate", "o_orderstatus",
                 "c_name", "c_mktsegment", "n_name", "n_regionkey", "p_brand", "p_type", "p_size"]


def _violation_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The feeds use the day of a time alone, which is shorter to shuffle and to store.
    day = lambda df, c: df.withColumn(c, df[c].cast("date"))
    li = day(read_table(spark, sf_dir, "lineitem"), "l_shipdate")
    o = day(read_table(spark, sf_dir, "orders"), "o_orderdate")
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    p = read_table(spark, sf_dir, "part")
    # A line item meets its part while it is narrow, an order its customer before its
    # line items, so the wide rows are never shuffled: they come out of the last join.
    # That is of two growing tables, a shuffle join at every size.  (Where a table lies
    # in one row group, it is also what spreads its rows.)  It leaves the rows by order,
    # which is what the per-pin aggregates reduce before they shuffle.
    items = li.join(p, li.l_partkey == p.p_partkey)
    placed = (o.join(c, o.o_custkey == c.c_custkey)
              .join(n, c.c_nationkey == n.n_nationkey))
    base = items.join(placed.hint("merge"), items.l_orderkey == placed.o_orderkey)
    # Exact duplicates, as the live feed has: some rows arrive twice.
    copies = F.when(F.col("l_orderkey") % 50 == 0, 2).otherwise(1)
    return base.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).select(
        *_BASE_COLUMNS)


def _common(df: DataFrame) -> dict[str, Column]:
    key = F.col("l_orderkey").cast("string")
    lat, lng = _coord_text("l_orderkey")
    blank_pin = F.col("l_partkey") % 97 == 0
    found = _iso_text("l_shipdate")
    return {
        "vid": F.concat(key, F.lit("-"), F.col("l_linenumber").cast("string")),
        "key": key,
        "blank_pin": blank_pin,
        "lat": lat,
        "lng": lng,
        "found": F.when(F.col("l_suppkey") % 41 == 0, F.lit("n/a")).otherwise(found),
        "ordered": _iso_text("o_orderdate"),
        "district": _district(F.col("o_custkey"), F.col("n_regionkey")),
        "full_address": F.concat(F.col("c_name"), F.lit(", "), F.col("n_name")),
    }


def raw_npd_violations(base: DataFrame) -> DataFrame:
    """Live feed: open line items (``l_linestatus = 'O'``)."""
    b = base.where(F.col("l_linestatus") == "O")
    m = _common(b)
    point = (F.when(F.col("l_suppkey") % 43 == 0, F.lit('{"type":"Point","coordinates":[]}'))
             .when(F.col("l_suppkey") % 47 == 0, F.lit(None).cast("string"))
             .otherwise(_point_json(m["lat"], m["lng"])))
    return b.select(
        m["vid"].alias("violationid"),
        m["key"].alias("casenumber"),
        F.when(m["blank_pin"], F.lit("")).otherwise(
            F.concat(F.lit(" "), m["key"], F.lit("  "))).alias("pin"),
        F.col("c_name").alias("street_address"),
        m["full_address"].alias("full_address"),
        F.col("c_mktsegment").alias("postalcode"),
        m["district"].alias("computed_region_9t2m_phkm"),
        point.alias("incident_location"),
        F.col("p_size").cast("string").alias("chapter"),
        F.col("p_brand").alias("ordinance"),
        F.col("p_type").alias("description"),
        m["found"].alias("date_found"),
        F.concat(F.date_format(F.date_add(F.col("l_shipdate").cast("date"),
                                          DATE_SHIFT_DAYS + 30), "yyyy-MM-dd"),
                 F.lit("T00:00:00.000")).alias("date_to_comply"),
        m["ordered"].alias("date_resolved"),
        F.when(F.col("l_returnflag") == "R", "Closed")
         .when(F.col("l_returnflag") == "A", "Open").alias("vio_status"),
        F.when(F.col("o_orderstatus") == "F", "Closed").otherwise("Open").alias("case_status"),
    )


def earlier_live_drop(live: DataFrame) -> DataFrame:
    """An earlier drop of the live feed, as the refresh finds it stored: of some cases a
    violation is not there yet, of some none is resolved yet, some hold a violation that
    goes later, and some of those stand under a pin that goes with it."""
    case = F.col("casenumber").cast("long")
    first = F.col("violationid").endswith("-1")
    known = live.where(~((case % 17 == 0) & ~first))
    open_then = (case % 19 == 0)
    earlier = known.withColumn("date_resolved", F.when(~open_then, F.col("date_resolved")))
    gone = live.where((case % 23 == 0) & first).withColumns({
        "violationid": F.concat(F.lit("x"), "violationid"),
        "pin": F.when(case % 2 == 0, F.concat(F.lit("x"), F.trim("pin"))).otherwise(F.col("pin"))})
    return earlier.unionByName(gone)


def raw_historical_violations(base: DataFrame) -> DataFrame:
    """Archive feed: finished line items (``l_linestatus = 'F'``)."""
    b = base.where(F.col("l_linestatus") == "F")
    m = _common(b)
    sk = F.col("l_suppkey")
    lat = (F.when(sk % 53 == 0, F.lit("0")).when(sk % 59 == 0, F.lit("unknown"))
           .otherwise(m["lat"]))
    lng = F.when(sk % 53 == 0, F.lit("0")).otherwise(m["lng"])
    suffix = F.when(F.col("l_linenumber") == 7, F.lit(" c.o.")).otherwise(F.lit(" C.O."))
    return b.select(
        m["vid"].alias("id"),
        m["key"].alias("case_id"),
        F.when(m["blank_pin"], F.lit("")).otherwise(
            F.concat(F.lit("\t"), m["key"], F.lit("\n"))).alias("pin"),
        F.col("c_name").alias("address"),
        F.col("c_mktsegment").alias("zip_code"),
        F.concat(m["district"], F.lit(" ")).alias("council_district"),
        F.col("n_name").alias("neighborhood"),
        lat.alias("latitude"),
        lng.alias("longitude"),
        F.col("p_size").cast("string").alias("chapter"),
        F.concat(F.col("p_brand"), suffix).alias("ordinance"),
        F.col("p_type").alias("violation_description"),
        m["found"].alias("violation_entry_date"),
        m["ordered"].alias("case_opened"),
        F.when(F.col("l_partkey") % 11 == 0, F.lit(None).cast("string"))
         .otherwise(m["ordered"]).alias("case_closed"),
        F.when(F.col("l_returnflag") == "R", "Closed")
         .when(F.col("l_returnflag") == "A", "CLOSED").otherwise("Open").alias("status"),
    )


def raw_dangerous_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dangerous-building list: the urgent orders; some pins listed twice."""
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    b = (o.where(F.col("o_orderpriority") == "1-URGENT")
         .join(c, o.o_custkey == c.c_custkey)
         .join(n, c.c_nationkey == n.n_nationkey))
    # Second listing for every third customer: same day for even keys (the
    # text case number decides), a year earlier otherwise.
    relist = F.col("o_custkey") % 3 == 0
    b = b.withColumn("_listing", F.explode(F.sequence(F.lit(1), F.when(relist, 2).otherwise(1))))
    key = F.col("o_orderkey").cast("string")
    lat, lng = _coord_text("o_orderkey")
    first = F.col("_listing") == 1
    ordered = F.col("o_orderdate").cast("date")
    opened = F.when(first | (F.col("o_orderkey") % 2 == 0), ordered) \
        .otherwise(F.date_add(ordered, -365))
    day = F.date_add(opened, DATE_SHIFT_DAYS)
    status = (F.when(~first, F.lit("To DEMOLISH"))
              .when(F.col("o_orderstatus") == "P", F.lit("Pending demolition"))
              .when(F.col("o_orderstatus") == "F", F.lit("Closed - repaired"))
              .otherwise(F.lit("Open")))
    return b.select(
        F.concat(F.lit(" "), key).alias("pin"),
        F.when(first, F.concat(F.lit("DB"), key))
         .otherwise(F.concat(F.lit("DB"), key, F.lit("-R"))).alias("casenumber"),
        F.col("c_name").alias("address"),
        F.concat(F.col("c_name"), F.lit(", "), F.col("n_name")).alias("location"),
        F.col("c_mktsegment").alias("zip_code"),
        (F.col("n_regionkey") + 1).cast("string").alias("council_district"),
        _point_json(lat, lng).alias("case_location"),
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T00:00:00.000")).alias("case_opened"),
        status.alias("statusofcase"),
    )


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curated seed plus labels for the odd-numbered brands.

    Even-numbered brands stay unlabelled, so the fall-back to the raw code
    is exercised.
    """
    brands = (read_table(spark, sf_dir, "part").select("p_brand").distinct()
              .where(F.substring("p_brand", 7, 10).try_cast("int") % 2 == 1)
              .select(F.col("p_brand").alias("violation_code"),
                      F.concat(F.lit("Brand "), F.substring("p_brand", 7, 10)).alias("short_label")))
    return builtin_labels(spark).unionByName(brands)


def raw_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The feeds; the join that both violation feeds come from is done and written once."""
    base = stored(_violation_base(spark, sf_dir), "violation-base", compression="zstd")
    return {
        "npd_violations": raw_npd_violations(base),
        "historical_violations": raw_historical_violations(base),
        "dangerous_buildings": raw_dangerous_buildings(spark, sf_dir),
        "violation_labels": labels(spark, sf_dir),
    }
