"""The observation pipeline: time, deployment, parameters, flux, quality."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xylemflow.operators.dma import apply_dma_peclet
from xylemflow.operators.enrich import (
    assert_unambiguous,
    expand_metadata,
    match_deployments,
    metadata_keys,
    overlapping_intervals,
)
from xylemflow.operators.parameters import parameter_columns, resolve_scopes
from xylemflow.operators.quality import apply_quality_filters, first_starts
from xylemflow.operators.summaries import side_by_side
from xylemflow.operators.timestamps import (
    PREVIOUS_UTC,
    attach_utc,
    chunk_anchors,
    chunk_offsets,
    local_deployments,
    record_map,
    sensor_times,
    skipped_chunks,
    timed_rows,
)
from xylemflow.schema import (
    CALCULATED_COLUMNS,
    CONTEXT_COLUMNS,
    OVERRIDE_SCHEMA,
    PARAMETERS,
    SCOPE_COLUMNS,
    Parameter,
)
from xylemflow.session import measured
from xylemflow.sources.tables import stage

STANDARD = "standard_v1_dst_fix"


@dataclass
class Context:
    """Metadata of a run.

    ``deployments`` is a deployment-context frame with ``installation_metadata`` and
    ``timezone``; ``sites`` has ``site_id, timezone``.
    """

    sites: DataFrame
    deployments: DataFrame
    overrides: DataFrame | None = None
    aliases: DataFrame | None = None
    definitions: Sequence[Parameter] = field(default_factory=lambda: PARAMETERS)
    _held: list[DataFrame] = field(default_factory=list, repr=False)

    def is_empty(self) -> bool:
        return self.sites.isEmpty() or self.deployments.isEmpty()

    def held(self) -> Context:
        """The same metadata, cached and measured, so that each table is computed once."""
        optional = {
            name: None if frame is None else self.hold(frame)
            for name, frame in (("overrides", self.overrides), ("aliases", self.aliases))
        }
        return Context(
            self.hold(self.sites),
            self.hold(self.deployments),
            definitions=self.definitions,
            _held=self._held,
            **optional,
        )

    def staged(self) -> Context:
        """The same metadata, written to the checkpoint folder and read back."""
        optional = {
            name: None if frame is None else stage(frame, name) for name, frame in (("overrides", self.overrides), ("aliases", self.aliases))
        }
        return Context(stage(self.sites, "sites"), stage(self.deployments, "deployments"), definitions=self.definitions, **optional)

    def hold(self, df: DataFrame) -> DataFrame:
        cached = measured(df)
        self._held.append(cached)
        return cached

    def release(self) -> None:
        """Drop the cached dimensions of this run."""
        while self._held:
            self._held.pop().unpersist()


class BatchResult(NamedTuple):
    observations: DataFrame
    skipped_chunks: DataFrame
    timed_rows: DataFrame

    def excluded_rows(self, finished: DataFrame) -> DataFrame:
        """One row: the rows with a time but no deployment, given the written ``matched_only`` result.

        Each timed row of a valid run is in at most one deployment, so this is a difference of two
        counts and needs no second pass over the observations.
        """
        kept = finished.agg(F.count(F.lit(1)).alias("_kept"))
        return side_by_side(self.timed_rows, kept).select((F.col("timed_rows") - F.col("_kept")).alias("excluded_rows_no_deployment"))


NO_DEPLOYMENT = ""


def resolved_deployments(context: Context) -> DataFrame:
    """The deployment dimension with metadata columns and all parameters, keyed by ``_deployment``.

    Everything that depends on the deployment alone is settled here, so that observations
    meet one join instead of one per step. A last row with the key ``""`` serves rows outside
    every deployment: no context, and parameters from scope-free overrides or defaults.
    """
    base = context.deployments
    keys = metadata_keys(base) if "installation_metadata" in base.columns else []
    wide = expand_metadata(base, keys) if keys else base
    wide = wide.select(F.col("deployment_id").alias("_deployment"), *CONTEXT_COLUMNS, *keys)
    empty = wide.sparkSession.range(1).select(
        F.lit(NO_DEPLOYMENT).alias("_deployment"),
        *[F.lit(None).cast(wide.schema[c].dataType).alias(c) for c in CONTEXT_COLUMNS + keys],
    )
    if context.definitions:
        overrides = context.overrides
        if overrides is None:
            overrides = base.sparkSession.createDataFrame([], OVERRIDE_SCHEMA)
        columns = parameter_columns(context.definitions)
        scopes = base.select(*SCOPE_COLUMNS).unionByName(
            empty.select(*SCOPE_COLUMNS), allowMissingColumns=False
        )
        resolved = resolve_scopes(scopes, overrides, context.definitions).select(
            F.coalesce("deployment_id", F.lit(NO_DEPLOYMENT)).alias("_deployment"), *columns
        )
        return context.hold(wide.unionByName(empty).join(resolved, "_deployment"))
    return context.hold(wide.unionByName(empty))


BOUNDS = ["deployment_start_timestamp_utc", "deployment_end_timestamp_utc"]


def timed_columns(observations: DataFrame) -> list[str]:
    return [c for c in observations.columns if c != PREVIOUS_UTC]


def run_batch(
    observations: DataFrame, context: Context, now: datetime, matched_only: bool = False
) -> BatchResult:
    """Observations to the finished table, plus the report of skipped chunks.

    The thin record map is staged first, and the first start of each sensor is read off it. The
    observations themselves are shuffled once, to meet their UTC time by (logger, record); chunk offsets and deployments are measured and
    broadcast while they are small. ``matched_only`` leaves out rows without a deployment, as
    a published run does; record gaps are still judged against all records of the logger.

    An observation that falls into two deployments or two alias intervals fails the run. Only the
    metadata is searched for overlaps; the observations are looked at if there are any.
    """
    context = context.held()
    if context.is_empty():
        raise ValueError("no sites or deployments: nothing to process against")
    bounds = context.hold(local_deployments(context.deployments.drop("timezone"), context.sites))
    # One thin row per record, written once: chunks, offsets and the join all read it back.
    rated = bool(context.definitions) and not matched_only
    records = stage(record_map(observations, with_head=True, with_addresses=rated), "records")
    offsets = context.hold(chunk_offsets(chunk_anchors(records), context.sites, bounds))
    timed = attach_utc(observations, records, offsets, with_previous=True)
    if not overlapping_intervals(context.deployments, context.aliases).isEmpty():
        assert_unambiguous(timed, context.deployments, context.aliases)
    matched = match_deployments(timed, context.deployments, context.aliases, "_deployment")
    if matched_only:
        matched = matched.where(F.col("_deployment").isNotNull())
    else:
        matched = matched.withColumn(
            "_deployment", F.coalesce("_deployment", F.lit(NO_DEPLOYMENT))
        )
    dimension = resolved_deployments(context)
    if not context.definitions:
        finished = matched.join(dimension, "_deployment").drop("_deployment", PREVIOUS_UTC)
        return BatchResult(finished, skipped_chunks(offsets), timed_rows(records, offsets))
    # Numbers first, so that the formulas run over narrow rows; then the descriptive columns.
    used = [p.code for p in context.definitions] + BOUNDS
    described = [c for c in dimension.columns if c not in used]
    numbered = matched.join(dimension.select("_deployment", *used), "_deployment")
    starts = stage(first_starts(sensor_times(records, offsets), context.deployments, context.aliases), "first-starts") if rated else None
    graded = apply_quality_filters(apply_dma_peclet(numbered), now, matched_only, starts)
    finished = graded.join(dimension.select(*described), "_deployment").select(
        *timed_columns(timed), *dimension.drop("_deployment").columns, *CALCULATED_COLUMNS,
        "quality", "quality_explanation",
    )
    return BatchResult(finished, skipped_chunks(offsets), timed_rows(records, offsets))


def unmatched_rows(observations: DataFrame, context: Context) -> DataFrame:
    """One row: how many time-corrected rows fall outside every deployment.

    Reads only the key columns and joins only sensor intervals.
    """
    keys = observations.select(
        "logger_id", "record", "timestamp", "file_hash", "sdi12_address", "thermistor_depth"
    )
    context = context.held()
    bounds = context.hold(local_deployments(context.deployments.drop("timezone"), context.sites))
    records = stage(record_map(keys), "records")
    offsets = context.hold(chunk_offsets(chunk_anchors(records), context.sites, bounds))
    timed = attach_utc(keys, records, offsets)
    matched = match_deployments(timed, context.deployments, context.aliases)
    return matched.agg(
        F.count_if(F.col("deployment_id").isNull()).alias("excluded_rows_no_deployment")
    )


PIPELINES: dict[str, Callable[..., BatchResult]] = {STANDARD: run_batch}
