"""Session settings the engine relies on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Right answers depend on these two: DATE math must not follow the host's zone,
# and casts must fail loudly outside the guarded helpers.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}
# Plan quality only: runtime coalescing, broadcast conversion, skew splitting.
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}
ENGINE_CONF = REQUIRED_CONF | TUNING_CONF

_CLEANED: set[str] = set()
_TEMPORARY: list[str] = []


class SharedFolderError(RuntimeError):
    """No folder that driver and executors share is configured."""


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "parcelflow") -> SparkSession:
    """A local session for tests and the benchmark (UI off, no server)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_engine_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session.

    A refused setting that answers depend on is an error; a refused tuning
    setting (locked on a managed cluster) is not.
    """
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    for k, v in TUNING_CONF.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for cut lineage and intermediate tables.

    It is what the cluster names in ``spark.checkpoint.dir``, or the folder
    already given to ``SparkContext.setCheckpointDir``.  Nothing is made up
    when neither is set: a folder of the driver's own would be invisible to
    the executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise SharedFolderError(
            "set spark.checkpoint.dir to a folder that the driver and all executors share; "
            "intermediate tables are written there")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below this application's own folder in the shared folder.  The
    folder goes when the Python driver ends."""
    base = f"{checkpoint_root(spark)}/parcelflow-{spark.sparkContext.applicationId}"
    if base not in _CLEANED:
        _CLEANED.add(base)
        atexit.register(_remove_quietly, spark, base)
    return "/".join([base, *parts])


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table through the file system Spark reads it with."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def input_state(spark: SparkSession, path: str) -> tuple:
    """What lies directly under ``path``: name, bytes and time of each entry.
    Another state means other data."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return tuple(sorted(
        (s.getPath().getName(), fs.getContentSummary(s.getPath()).getLength(),
         s.getModificationTime()) for s in fs.listStatus(folder)))


def _remove_quietly(spark: SparkSession, path: str) -> None:
    try:
        if spark.sparkContext._jsc is not None:
            remove_path(spark, path)
    except Exception:  # the JVM may be gone already
        pass


def stored(df: DataFrame, name: str, keep: bool = False,
           compression: str | None = None) -> DataFrame:
    """``df`` written once as Parquet under the shared folder and read back:
    lineage is cut and a lost executor recomputes nothing behind it.  A table to
    ``keep`` outlives the :func:`temporary` block it is written in.  ``compression``
    is the session's when not given."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    if not keep:
        _TEMPORARY.append(path)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporary(spark: SparkSession):
    """Tables that :func:`stored` writes inside the block go at its end, when
    nothing that is read later hangs on them."""
    before = len(_TEMPORARY)
    try:
        yield
    finally:
        for path in _TEMPORARY[before:]:
            remove_path(spark, path)
        del _TEMPORARY[before:]


def forget(df: DataFrame) -> None:
    """Remove a table that :func:`stored` wrote and nobody reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove_path(df.sparkSession, path)


__all__ = ["ENGINE_CONF", "SharedFolderError", "local_session", "apply_engine_conf",
           "checkpoint_root", "scratch_path", "input_state", "remove_path", "stored",
           "temporary", "forget"]
