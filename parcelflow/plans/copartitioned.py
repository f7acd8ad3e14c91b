"""The wide join without moving the stored fact.

A rebuild after a drop meets the same archive rows with new property attributes.  Here
the fact lies ready for that join: rows of cold properties in buckets by property key,
one file a bucket, rows of hot properties (more than an even bucket of all rows; so there
are fewer of them than buckets) apart.  The attributes are written in buckets of the
same number, so the cold rows meet them bucket by bucket with no exchange above the fact;
the hot rows meet the attributes of the hot properties, fewer than buckets, by broadcast.
Neither is shuffled, and no task holds a hot property.

Buckets are Spark's own (``bucketBy``), as external tables: files at a given path, the
bucketing in the session's catalog, which :meth:`Buckets.attach` tells a later session.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.operators import hot_keys
from parcelflow.plans.marts import property_attributes, wide_rows

KEY = "property_sk"


@dataclass(frozen=True)
class Buckets:
    """A table in ``number`` buckets of ``key`` at ``path``."""
    path: str
    key: str
    number: int
    table: str

    @classmethod
    def write(cls, df: DataFrame, path: str, key: str, number: int,
              digests: Sequence[str] = ()) -> Buckets:
        """``digests``: columns of lower-case hex digits, which are shuffled as the bytes
        they stand for.  The write sorts the buckets."""
        table = f"parcelflow_{uuid.uuid4().hex}"
        digits = {c: F.lower(F.hex(c)) for c in digests}
        dealt = (df.withColumns({c: F.unhex(c) for c in digests})
                 .repartition(number, digits.get(key, F.col(key))).withColumns(digits))
        (dealt.write.bucketBy(number, key).sortBy(key).option("path", path)
         .option("compression", "zstd").format("parquet").saveAsTable(table))
        return cls(path, key, number, table)

    @classmethod
    def attach(cls, spark: SparkSession, path: str, key: str, number: int) -> Buckets:
        """Buckets that another session wrote."""
        table = f"parcelflow_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                            for f in spark.read.parquet(path).schema)
        where = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{key}`) "
                  f"SORTED BY (`{key}`) INTO {number} BUCKETS LOCATION '{where}'")
        return cls(path, key, number, table)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table)


@dataclass(frozen=True)
class StoredFact:
    """Fact rows as they lie: cold in buckets, hot apart, and the hot keys."""
    cold: Buckets
    hot: DataFrame
    hot_keys: DataFrame

    @classmethod
    def write(cls, fact: DataFrame, path: str, buckets: int) -> StoredFact:
        spark = fact.sparkSession
        hot_keys(fact, KEY, buckets).select(KEY).write.parquet(f"{path}/hot_keys")
        keys = spark.read.parquet(f"{path}/hot_keys")  # fewer than `buckets` rows
        fact.join(F.broadcast(keys), KEY, "left_semi").write.option(
            "compression", "zstd").parquet(f"{path}/hot")
        cold = Buckets.write(fact.join(F.broadcast(keys), KEY, "left_anti"), f"{path}/cold", KEY,
                             buckets, ["violation_pk", KEY])
        return cls(cold, spark.read.parquet(f"{path}/hot"), keys)


def joined(facts: list[StoredFact], attributes: Buckets) -> DataFrame:
    """The rows of several stored parts of the fact with their property's attributes."""
    spark = facts[0].hot.sparkSession
    about = attributes.read(spark)
    out = None
    for fact in facts:
        if fact.cold.number != attributes.number:
            raise ValueError(f"{fact.cold.number} buckets of the fact, "
                             f"{attributes.number} of the attributes")
        some = about.join(F.broadcast(fact.hot_keys), KEY, "left_semi")
        rows = fact.cold.read(spark).join(about, KEY, "left").unionByName(
            fact.hot.join(F.broadcast(some), KEY, "left"))
        out = rows if out is None else out.unionByName(rows)
    return out


def wide_table(facts: list[StoredFact], attributes: Buckets, dim_type: DataFrame,
               dim_district: DataFrame) -> DataFrame:
    """The wide table (K16) of several stored parts of the fact, such as the archive and
    the live feed, with attributes in as many buckets."""
    return wide_rows(joined(facts, attributes), dim_type, dim_district)


def stored_attributes(dim_property: DataFrame, lifecycle: DataFrame, path: str,
                      buckets: int) -> Buckets:
    return Buckets.write(property_attributes(dim_property, lifecycle), path, KEY, buckets, [KEY])
