"""The log that makes a transaction's tables visible at once.

A run writes whatever it has to write into folders of its own and then adds one file to the log;
tables are read through the runs the log accepts. A run that stops anywhere before has changed
nothing that a reader sees, and doing it again overwrites its folders. The log's versions are
consecutive, and a version is taken by a rename that fails if another run was first.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

ACCEPTED, REJECTED = "ACCEPTED", "REJECTED"
COMMIT_SCHEMA = "version bigint, run_id string, outcome string, status string, output_id string, error string"
INTENT_SCHEMA = "run_id string, snapshot bigint"


class ConcurrentRun(RuntimeError):
    """Another run was committed since this one read its snapshot; doing this one again is safe."""


def _located(spark: SparkSession, path: str):
    """The Hadoop file system and the qualified path."""
    raw = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = raw.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system, system.makeQualified(raw)


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _located(spark, path)
    return system.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    system, at = _located(spark, path)
    system.delete(at, True)


def write_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file as a whole; false, and nothing changed, if the path is taken."""
    jvm = spark.sparkContext._jvm
    system, at = _located(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    keep = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    keep[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
    try:
        files.rename(draft, at, keep)
        return True
    except Exception:
        if not system.exists(at):
            raise
        system.delete(draft, False)
        return False


def _read(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    if not exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(folder)


@dataclass(frozen=True)
class CommitLog:
    spark: SparkSession
    root: str

    def commits(self) -> DataFrame:
        return _read(self.spark, f"{self.root}/log/commits", COMMIT_SCHEMA)

    def version(self) -> int:
        """The number of the last commit, 0 before the first."""
        return self.commits().agg(F.max("version")).first()[0] or 0

    def outcomes(self, version: int | None = None) -> DataFrame:
        """The last commit of each run, as of a version."""
        seen = self.commits() if version is None else self.commits().where(F.col("version") <= version)
        last = seen.groupBy("run_id").agg(F.max_by(F.struct("version", "outcome", "status", "output_id", "error"), "version").alias("last"))
        return last.select("run_id", "last.*")

    def outcome(self, run_id: str) -> Row | None:
        return self.outcomes().where(F.col("run_id") == run_id).first()

    def accepted(self, version: int | None = None) -> DataFrame:
        return self.outcomes(version).where(F.col("outcome") == ACCEPTED).select("run_id", "version")

    def begin(self, run_id: str, snapshot: int) -> None:
        """Note that a run is about to write; a repeated run finds its note there."""
        write_text(self.spark, f"{self.root}/log/intents/{run_id}.json", json.dumps({"run_id": run_id, "snapshot": snapshot}))

    def commit(self, run_id: str, snapshot: int, outcome: str, status: str, output_id: str | None = None, error: str | None = None) -> int:
        """Make a run's tables visible, if no run was accepted since the snapshot it read."""
        version = self.version()
        while True:
            if outcome == ACCEPTED and not self.accepted().where(F.col("version") > snapshot).isEmpty():
                raise ConcurrentRun(f"run {run_id} read version {snapshot}; a later one is accepted")
            version += 1
            entry = {"version": version, "run_id": run_id, "outcome": outcome, "status": status, "output_id": output_id, "error": error}
            if write_text(self.spark, f"{self.root}/log/commits/{version:020d}.json", json.dumps(entry)):
                return version

    def pending(self) -> DataFrame:
        """Runs that began and were never committed."""
        return _read(self.spark, f"{self.root}/log/intents", INTENT_SCHEMA).join(self.commits().select("run_id"), "run_id", "left_anti")

    # --- Tables of a store: one folder a run, visible when the run is accepted -------------

    def folder(self, table: str, run_id: str) -> str:
        return f"{self.root}/{table}/run={run_id}"

    def write(self, table: str, run_id: str, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(self.folder(table, run_id))

    def visible(self, version: int | None = None, run_id: str | None = None) -> DataFrame:
        """``run, commit_version`` of accepted runs; ``run_id`` adds that run before its commit."""
        runs = self.accepted(version).select(F.col("run_id").alias("run"), F.col("version").alias("commit_version"))
        if run_id is None:
            return runs
        own = self.spark.range(1).select(F.lit(run_id).alias("run"), F.lit((self.version() if version is None else version) + 1).cast("bigint").alias("commit_version"))
        return runs.where(F.col("run") != run_id).unionByName(own)

    def read(self, table: str, schema: str, visible: DataFrame | None = None) -> DataFrame:
        """Rows of the visible runs (all accepted ones by default) with their ``commit_version``."""
        if not exists(self.spark, f"{self.root}/{table}"):
            return self.spark.createDataFrame([], f"{schema}, commit_version bigint")
        stored = self.spark.read.schema(f"{schema}, run string").option("basePath", f"{self.root}/{table}").parquet(f"{self.root}/{table}")
        visible = self.visible() if visible is None else visible
        return stored.join(visible, "run").drop("run")

    def recover(self, tables: Sequence[str]) -> list[str]:
        """Remove what runs that were never committed left; no run may be writing meanwhile."""
        stopped = [row.run_id for row in self.pending().select("run_id").toLocalIterator()]
        for run_id in stopped:
            for table in tables:
                delete(self.spark, self.folder(table, run_id))
            delete(self.spark, f"{self.root}/outputs/{run_id}.parquet")
            delete(self.spark, f"{self.root}/log/intents/{run_id}.json")
        return stopped
