"""Helpers the operators of this package share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step in a task holds at once.  A longer
#: single text is a step of its own.
SLICE_BYTES = 8 << 20


#: Rows that Spark hands to a Python step at once, at most: whole texts are large rows, and
#: a batch is held by the JVM and by the Python worker, whatever slices it is read in.
BATCH_ROWS = 1_000

_SHIPPED: set[str] = set()


def on_executors(df: DataFrame) -> DataFrame:
    """``df``, for a Python step: the first time in an application, the package's
    code goes to the executors as a Python file (like ``--py-files``), so that
    they need neither an installed copy nor the driver's folders."""
    context, conf = df.sparkSession.sparkContext, df.sparkSession.conf
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.isModifiable(rows):
        conf.set(rows, str(BATCH_ROWS))
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="parcelflow-code-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        archive = Path(folder) / f"{package.name}-code.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for file in sorted(package.rglob("*.py")):
                z.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_crc(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def text_slices(batches: Iterable[pa.RecordBatch], text: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into pieces of about ``limit`` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, n in enumerate(size):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        yield batch.slice(start)


def arrow_batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=schema.field(n).type)
         for n, c in ((n, columns[n]) for n in schema.names)], schema=schema)
