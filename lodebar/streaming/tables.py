"""Tables that a stream keeps up to date: one version for each micro-batch, of which the last two stay.

A version is complete once its folder has Spark's success mark. A batch that runs again finds the versions before its own,
whatever it left behind itself, so running it again gives the same version.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodebar.operators import instruments


class Versions:
    """Folders ``id=N`` below a path, each a table as it was after batch N."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._root = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._store = self._root.getFileSystem(spark._jsc.hadoopConfiguration())

    def known(self) -> list[int]:
        """Batches with a complete version, in order."""
        if not self._store.exists(self._root):
            return []
        names = [f.getPath().getName() for f in self._store.listStatus(self._root)]
        numbers = [int(m[1]) for n in names if (m := re.fullmatch(r"id=(\d+)", n))]
        return sorted(n for n in numbers if self._store.exists(self._child(n, "_SUCCESS")))

    def _child(self, batch: int, name: str = ""):  # noqa: ANN202
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/id={batch}" + (f"/{name}" if name else ""))

    def before(self, batch: int | None, schema: str) -> DataFrame:
        """The table as it was before ``batch``, or as it is now; empty where there is none."""
        found = [n for n in self.known() if batch is None or n < batch]
        if not found:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/id={found[-1]}")

    def write(self, rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/id={batch}")

    def forget(self, batch: int) -> None:
        """Deletes versions that no run of ``batch`` or a later one reads: all but the last one before it."""
        for old in [n for n in self.known() if n < batch][:-1]:
            self._store.delete(self._child(old), True)


class Upsert:
    """A micro-batch sink that replaces rows by key: the table after a batch is the one before it with the batch's rows in it."""

    def __init__(self, path: str, schema: str, *keys: str) -> None:
        self.path, self.schema, self.keys = path, schema, list(keys)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        versions = Versions(batch.sparkSession, self.path)
        # one join that reads the batch once: a stateful batch that is read twice is made twice
        joined = versions.before(batch_id, self.schema).alias("old").join(batch.withColumn("_came", F.lit(True)).alias("new"), self.keys, "full_outer")
        values = [F.col(c) if c in self.keys else F.when(F.col("_came"), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in batch.columns]
        versions.write(joined.select(*values), batch_id)
        versions.forget(batch_id)

    def read(self, spark: SparkSession) -> DataFrame:
        return Versions(spark, self.path).before(None, self.schema)


class MasterTable:
    """A micro-batch sink for rows of the instrument master: a batch's new rows are folded into the table, nothing older is read again.

    Its present state is what ``instruments.merged`` gives over all rows that have come, in whatever order they came.
    """

    def __init__(self, path: str, like: DataFrame) -> None:
        self.path = path
        self.schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in instruments.as_state(like.limit(0)).schema)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        versions = Versions(batch.sparkSession, self.path)
        versions.write(instruments.folded(versions.before(batch_id, self.schema), instruments.as_state(batch)), batch_id)
        versions.forget(batch_id)

    def read(self, spark: SparkSession) -> DataFrame:
        """The master as it is now."""
        return instruments.of_state(Versions(spark, self.path).before(None, self.schema))
