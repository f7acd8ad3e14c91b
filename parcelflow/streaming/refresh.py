"""Scheduled refresh of a live feed as a one-shot file stream."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.session import checkpoint_root
from parcelflow.sources.landing import Feed, land_registry


def refresh_feed(spark: SparkSession, drops_dir: str, raw_root: str, table: str) -> int:
    """Replace the live feed ``table`` below ``raw_root`` with the newest drop that arrived
    since the last run.

    Each file directly under ``drops_dir`` is one drop, a whole snapshot; of
    several new ones the latest (by file time, then name) is landed, because each
    replaces the one before.  The stream only finds it; the landing checks it and
    publishes it, so a broken drop stops the run and leaves the table as it was.
    A run without a new row does nothing.  Returns the number of rows loaded.
    """
    loaded = {"rows": 0}

    def load(batch: DataFrame, epoch_id: int) -> None:
        newest = batch.agg(F.max(F.struct("at", "path")).alias("m")).first().m
        if newest is not None:
            tables = land_registry(spark, [Feed(table, newest.path)], raw_root)
            loaded["rows"] = tables[table].count()

    found = (spark.readStream.text(drops_dir).where(F.length(F.trim("value")) > 0)
             .select(F.col("_metadata.file_modification_time").alias("at"),
                     F.col("_metadata.file_path").alias("path")))
    place = f"{table}-{uuid.uuid5(uuid.NAMESPACE_URL, f'{drops_dir} {raw_root}').hex}"
    q = (found.writeStream.foreachBatch(load)
         .option("checkpointLocation", f"{checkpoint_root(spark)}/parcelflow-refresh/{place}")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return loaded["rows"]
