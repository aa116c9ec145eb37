"""One transaction: validate metadata, ingest files, process, publish, remember.

A run reads one version of the store, adds its own metadata to it, and writes into folders that
carry its id. One commit then makes metadata, hashes, raw copies, output and receipt visible
together; see :mod:`xylemflow.sources.commits`.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from xylemflow.functions.text import cartridge_key, output_key, raw_file_key
from xylemflow.operators import summaries
from xylemflow.operators.flatten import flatten_parsed_files
from xylemflow.operators.manifest import ENTITIES, Frames, metadata_summary, validate_manifest
from xylemflow.operators.receipts import file_parts, receipt_files, receipt_head
from xylemflow.plans.ingest import (
    batch_reports,
    ingest_files,
    parsed_files,
    split_by_history,
)
from xylemflow.plans.processing import STANDARD, Context, run_batch
from xylemflow.sources import metadata, tables
from xylemflow.sources.commits import ACCEPTED, REJECTED, CommitLog
from xylemflow.sources.rawfiles import open_files

SUCCESS, SKIPPED, FAILED = "Success", "Skipped", "Failed"
#: Parts per core that the bytes of a batch are dealt into.
SPREAD = 4


@dataclass(frozen=True)
class Store:
    """Folders of a deployment of this library."""

    root: str

    HASHES, OUTPUTS, RAW, RECEIPTS = "registry/raw_files", "registry/outputs", "raw-files", "receipt-documents"

    @property
    def hashes(self) -> str:
        return f"{self.root}/{self.HASHES}"

    @property
    def outputs(self) -> str:
        return f"{self.root}/{self.OUTPUTS}"

    @property
    def raw(self) -> str:
        return f"{self.root}/{self.RAW}"

    def receipt(self, run_id: str) -> str:
        return f"{self.root}/receipts/{run_id}"

    def output(self, run_id: str) -> str:
        return f"{self.root}/outputs/{run_id}.parquet"

    def log(self, spark: SparkSession) -> CommitLog:
        return CommitLog(spark, self.root)

    @property
    def tables(self) -> list[str]:
        return [self.HASHES, self.OUTPUTS, self.RAW, self.RECEIPTS, *(metadata.table_of(e) for e in ENTITIES)]

    def recover(self, spark: SparkSession) -> list[str]:
        """Remove what stopped runs left; call it while no run is writing."""
        return self.log(spark).recover(self.tables)


@dataclass(frozen=True)
class Outcome:
    run_id: str
    outcome: str
    status: str
    reports: DataFrame
    summary: DataFrame | None = None
    violations: DataFrame | None = None
    output_path: str | None = None
    error: str | None = None


def run_summary(finished: DataFrame, skipped: DataFrame, excluded: DataFrame) -> DataFrame:
    """One row of structs: quality, provenance, records, skipped chunks, excluded rows.

    ``finished`` should be a written table: each part then reads only its own columns.
    """
    def listed(df: DataFrame, name: str, order: list) -> DataFrame:
        fields = F.struct(*[F.col(c) for c in df.columns])
        ranked = df.select(fields.alias("_row"), F.struct(*order).alias("_key"))
        pairs = F.array_sort(F.collect_list(F.struct("_key", "_row")))
        return ranked.agg(F.transform(pairs, lambda p: p["_row"]).alias(name))

    return summaries.side_by_side(
        summaries.quality_summary(finished),
        listed(
            summaries.top_quality_reasons(finished), "top_reasons", [(-F.col("count")).alias("k"), F.col("reason")]
        ),
        listed(
            summaries.provenance_summary(finished),
            "top_overrides",
            [(-F.col("count")).alias("k"), F.col("parameter")],
        ),
        summaries.record_summary(finished),
        skipped.agg(
            F.count(F.lit(1)).alias("skipped_chunk_count"),
            F.coalesce(F.sum("row_count"), F.lit(0)).alias("skipped_record_count"),
        ),
        excluded,
    )


class _Run:
    """The writes of one transaction; nothing it writes is visible before :meth:`commit`."""

    def __init__(self, store: Store, log: CommitLog, run_id: str, snapshot: int, manifest: Frames):
        self.store, self.log, self.run_id, self.snapshot, self.manifest = store, log, run_id, snapshot, manifest

    def receipt(
        self, reports: DataFrame, status: str, summary: DataFrame | None = None, skipped: DataFrame | None = None, error: str | None = None
    ) -> None:
        """The nested documents, and their flat head as a JSON sidecar."""
        counted = summaries.ingestion_summary(reports)
        added = metadata_summary(self.manifest) if self.manifest else None
        identity = {"pipeline": F.lit(STANDARD), "status": F.lit(status), "run_id": F.lit(self.run_id)}
        if error is not None:
            identity["error"] = F.lit(error)
        flat = counted if summary is None else summaries.side_by_side(summary, counted)
        tables.write_sidecar(flat.withColumns(identity), self.store.receipt(self.run_id), "overwrite")
        head = receipt_head(self.run_id, STANDARD, status, counted, summary, added, error)
        documents = head.unionByName(file_parts(self.run_id, reports, skipped))
        self.log.write(self.store.RECEIPTS, self.run_id, documents)

    def commit(self, outcome: str, status: str, error: str | None = None, output: bool = False) -> None:
        self.log.commit(self.run_id, self.snapshot, outcome, status, self.run_id if output else None, error)


def run_transaction(
    spark: SparkSession,
    files: DataFrame,
    context: Context | None,
    store: Store,
    now: datetime,
    manifest: Frames | None = None,
    existing: Frames | None = None,
    dry_run: bool = False,
    run_id: str | None = None,
) -> Outcome:
    """Process the never-seen files of a batch and publish one output table.

    ``files`` has ``path, file_hash`` and either ``content``, or ``length`` for files that are then
    opened by path (:func:`xylemflow.sources.rawfiles.scan_file_keys`): their bytes are read once to
    hash them, once to copy them, and are never shuffled.

    Without a ``context`` the run takes its metadata from the store, with what its own
    ``manifest`` adds; so does the check of the manifest without ``existing``. A dry run writes
    nothing below the store. A run that stops, wherever it does, has published nothing, and can be
    repeated: with the same ``run_id`` it writes over what it left, with another one beside it. A
    run that was accepted is not repeated. A failed run leaves a receipt that names its cause and
    keeps its files unknown. A request without files and metadata is an error.
    """
    if not manifest and files.isEmpty():
        raise ValueError("a transaction needs at least one file or metadata entry")
    run_id = run_id or uuid.uuid4().hex
    log = store.log(spark)
    earlier = log.outcome(run_id)
    if earlier is not None and earlier.outcome == ACCEPTED:
        found = log.read(store.RECEIPTS, "receipt variant, part int, run_id string").where(F.col("run_id") == run_id)
        path = store.output(run_id) if earlier.output_id else None
        return Outcome(run_id, ACCEPTED, earlier.status, receipt_files(found).drop("run_id"), output_path=path)

    snapshot = log.version()
    stored = metadata.snapshot(log, snapshot) if context is None or (manifest and existing is None) else {}
    known_parents = existing if existing is not None else stored
    manifest = metadata.complete(manifest) if manifest else {}
    run = _Run(store, log, run_id, snapshot, manifest)
    if not dry_run:
        log.begin(run_id, snapshot)
    if manifest:
        violations = tables.stage(validate_manifest(manifest, known_parents), "violations")
        if not violations.isEmpty():
            empty = spark.createDataFrame([], "path string, file_hash string, status string")
            return Outcome(run_id, REJECTED, FAILED, empty, violations=violations)
        if not dry_run:
            for entity in manifest:
                log.write(metadata.table_of(entity), run_id, metadata.to_store(entity, manifest, known_parents))
    if context is None:
        own = metadata.with_added(stored, manifest, snapshot + 1) if dry_run else metadata.snapshot(log, snapshot, run_id)
        # Joined once, since a run reads it several times.
        context = metadata.context_of(own).staged()

    history = log.read(store.HASHES, tables.REGISTRY_SCHEMA, log.visible(snapshot)).drop("commit_version")
    by_path = "content" not in files.columns
    if by_path:
        # Hashed here, once; from now on only these keys move.
        files = tables.stage(files.select("path", "file_hash", "length"), "keys")
    else:
        # Read here, once: the bytes are hashed, parsed and copied, and parsing costs far more than
        # their number suggests, so they are spread over all cores wherever they came from.
        spread = SPREAD * spark.sparkContext.defaultParallelism
        files = tables.stage(files.select("path", "file_hash", "content").repartition(spread, "path"), "files")

    def read(firsts: DataFrame) -> DataFrame:
        """The new files, opened once: the run's raw copies, from which they are parsed."""
        opened = open_files(firsts.join(files, ["path", "file_hash"]))
        copies = opened.select(raw_file_key(F.col("file_hash")).alias("object_key"), "path", "file_hash", "content")
        if dry_run:
            return tables.stage(copies, "opened")
        log.write(store.RAW, run_id, copies)
        return spark.read.schema(copies.schema).parquet(log.folder(store.RAW, run_id))

    batch = ingest_files(files, history, read if by_path else None)
    # Parsing is the costly step and feeds reports and observations: keep its result.
    parsed = tables.stage(batch.parsed, "parsed")
    fresh, known = split_by_history(files.select("path", "file_hash"), history)
    reports = tables.stage(batch_reports(fresh, known, parsed), "reports")
    good = parsed_files(parsed)

    def remember() -> None:
        # The bytes are kept with the hashes that make them duplicates for ever.
        if not by_path:
            log.write(store.RAW, run_id, tables.raw_copies(files, reports))
        log.write(store.HASHES, run_id, good.select("file_hash", F.lit(run_id).alias("run_id")).distinct())

    if good.isEmpty() or context.is_empty():
        if not dry_run:
            remember()
            run.receipt(reports, SKIPPED)
            run.commit(ACCEPTED, SKIPPED)
        return Outcome(run_id, ACCEPTED, SKIPPED, reports)

    observations = flatten_parsed_files(good)
    try:
        result = run_batch(observations, context, now, matched_only=True)
        # Written once in the order it comes: the sorted write would compute it twice, to find its ranges.
        staged = tables.stage(result.observations, "finished")
        finished, path = staged, None
        if not dry_run:
            path = store.output(run_id)
            tables.write_observations(staged, path, "overwrite")
            finished = spark.read.parquet(path)
        summary = run_summary(finished, result.skipped_chunks, result.excluded_rows(finished))
        summary = tables.stage(summary, "summary")
        skipped = tables.stage(result.skipped_chunks, "skipped")
    except Exception as error:  # the receipt of a failed run names the cause
        if not dry_run:
            run.receipt(reports, FAILED, error=str(error))
            run.commit(REJECTED, FAILED, str(error))
        return Outcome(run_id, REJECTED, FAILED, reports, error=str(error))
    finally:
        context.release()

    if not dry_run:
        remember()
        entry = summary.select(
            F.lit(run_id).alias("output_id"),
            F.lit(run_id).alias("run_id"),
            output_key(F.lit(run_id)).alias("object_store_path"),
            cartridge_key(F.lit(run_id)).alias("reproducibility_cartridge_path"),
            F.col("total_rows").alias("row_count"),
            F.lit(now).cast("timestamp_ntz").alias("published_at"),
        )
        log.write(store.OUTPUTS, run_id, entry)
        run.receipt(reports, SUCCESS, summary, skipped)
        run.commit(ACCEPTED, SUCCESS, output=True)
    return Outcome(run_id, ACCEPTED, SUCCESS, reports, summary, output_path=path)


def published_outputs(spark: SparkSession, store: Store) -> DataFrame:
    """The outputs of accepted runs, exactly one of them flagged latest."""
    return tables.registered_outputs(store.log(spark).read(store.OUTPUTS, tables.OUTPUTS_SCHEMA).drop("commit_version"))


def stored_raw_files(spark: SparkSession, store: Store) -> DataFrame:
    """``object_key, file_hash, content`` of the files whose hash is remembered.

    A run that opens its files by path copies them before it knows which can be parsed; copies of
    the others are not listed.
    """
    log = store.log(spark)
    copies = log.read(store.RAW, "object_key string, file_hash string, content binary").drop("commit_version")
    return copies.join(log.read(store.HASHES, tables.REGISTRY_SCHEMA).select("file_hash"), "file_hash", "left_semi")


def stored_receipts(spark: SparkSession, store: Store) -> DataFrame:
    """The receipt documents of accepted runs: ``run_id, part, receipt``."""
    return store.log(spark).read(store.RECEIPTS, "run_id string, part int, receipt variant").drop("commit_version")
