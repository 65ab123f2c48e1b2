"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_SPACE = b" \t\n\x0b\x0c\r"  # what bytes.split() splits on: \x20 and \x09-\x0D

_own_scratch: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    Only where that setting is missing and Spark runs in this process alone, as in tests, a temporary folder of this machine
    is used; a cluster without the setting is refused, since its executors would not see each other's files.
    """
    set_by_cluster = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if set_by_cluster:
        return set_by_cluster.rstrip("/")
    if not (master := spark.sparkContext.master or "").startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_scratch:
        _own_scratch[app] = "file://" + tempfile.mkdtemp(prefix="spark-scratch-")
    return _own_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: lineage ends there and survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Deletes what ``staged`` has written for ``tables``, once nothing that is still to run reads them."""
    for table in tables:
        spark = table.sparkSession
        own = scratch_dir(spark)
        for path in {f.rpartition("/")[0] for f in table.inputFiles()}:
            if own.split(":", 1)[-1].lstrip("/") in path:
                target = spark._jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def freed(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files and broadcasts of what has been staged: nothing reads them any more.

    Spark deletes them once the driver's collector finds them unreachable, and a driver with little to do may not collect
    for half an hour (``spark.cleaner.periodicGC.interval``), while executors' disks fill.
    """
    gc.collect()
    spark._jvm.System.gc()


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that carry one of ``names`` in any case: an operator's own columns replace them."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def crc32_of_id(column: str | Column) -> Column:
    """CRC-32 of an id written as text (null ids count as empty text)."""
    c = F.col(column) if isinstance(column, str) else column
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary"))


#: Rows and bytes of texts that Arrow hands to a Python worker at a time, whichever are fewer.
ARROW_ROWS, ARROW_BYTES = 1_000, 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Keeps batches of texts small in this session, unless its own settings are smaller: workers' memory follows their size."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)):
        if not 0 < int(re.sub(r"\D", "", spark.conf.get(key)) or 0) <= most:
            spark.conf.set(key, str(most))


def returned() -> None:
    """Gives a Python worker's free memory back to the machine: workers outlive their tasks and share an executor's memory."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def frugal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches`` of a worker's output; free memory is given back at their end."""
    try:
        yield from batches
    finally:
        returned()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, to be handed to Python in small batches."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
