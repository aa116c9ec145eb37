"""Intermediate tables in the shared checkpoint folder, removed again when their work is done."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from xylemflow.session import checkpoint_dir, ship_package

#: While a table is written: shuffle files go when it is done, and not when the driver happens to
#: collect garbage; Arrow batches hold fewer rows, since a row may be a long text.
WRITE_CONF = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


class Staging:
    """Tables written once and read back, so that a lost executor never makes them be computed anew.

    Each operator run uses a folder of its own. Staged tables the result reads stay until the
    session's owner clears the checkpoint folder; those given to :meth:`drop` go at once.
    """

    def __init__(self, spark: SparkSession, name: str):
        ship_package(spark)
        self.spark = spark
        self.folder = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self._written = 0

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{self._written}-{name}"
        self._written += 1
        before = {key: self.spark.conf.get(key, None) for key in WRITE_CONF}
        for key, value in WRITE_CONF.items():
            self.spark.conf.set(key, value)
        try:
            df.write.mode("errorifexists").parquet(path)
        finally:
            for key, value in before.items():
                if value is None:
                    self.spark.conf.unset(key)
                else:
                    self.spark.conf.set(key, value)
        staged = self.spark.read.schema(df.schema).parquet(path)
        staged._staged_path = path
        return staged

    def drop(self, *frames: DataFrame) -> None:
        for frame in frames:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(frame._staged_path)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def unique_names(columns: list[str], *wanted: str) -> list[str]:
    """Names for helper columns that no given column has (case-insensitively)."""
    taken = {c.lower() for c in columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
