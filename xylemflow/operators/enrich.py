"""Join observations in time to the deployment active on their logger and address."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from xylemflow.functions.ordered import running_max_before
from xylemflow.functions.text import scientific_name
from xylemflow.functions.times import micros, within

START, END = "deployment_start_timestamp_utc", "deployment_end_timestamp_utc"


def deployment_context(
    deployments: DataFrame,
    dataloggers: DataFrame,
    stems: DataFrame,
    plants: DataFrame,
    plots: DataFrame,
    zones: DataFrame,
    sites: DataFrame,
    species: DataFrame,
    projects: DataFrame,
) -> DataFrame:
    """Deployments in the pipeline with the full chain of places, plants and projects.

    Inner joins: a deployment with a broken chain is left out. ``datalogger_id`` of the
    result is the logger's code, as observations carry it.
    """
    return (
        deployments.where(F.col("include_in_pipeline"))
        .join(dataloggers.select("datalogger_id", F.col("code").alias("_logger")), "datalogger_id")
        .join(stems.select("stem_id", "plant_id", F.col("code").alias("stem_code")), "stem_id")
        .join(
            plants.select("plant_id", "plot_id", "species_id", F.col("code").alias("plant_code")),
            "plant_id",
        )
        .join(plots.select("plot_id", "zone_id", F.col("name").alias("plot_name")), "plot_id")
        .join(zones.select("zone_id", "site_id", F.col("name").alias("zone_name")), "zone_id")
        .join(
            sites.select(
                "site_id",
                "timezone",
                F.col("code").alias("site_code"),
                F.col("name").alias("site_name"),
            ),
            "site_id",
        )
        .join(
            species.select("species_id", F.col("code").alias("species_code"), "latin_name"),
            "species_id",
        )
        .join(
            projects.select(
                "project_id",
                F.col("code").alias("project_code"),
                F.col("name").alias("project_name"),
            ),
            "project_id",
        )
        .select(
            "deployment_id",
            F.col("_logger").alias("datalogger_id"),
            "sdi_address",
            "project_id",
            "site_id",
            "zone_id",
            "plot_id",
            "plant_id",
            "species_id",
            "stem_id",
            "project_code",
            "project_name",
            "site_code",
            "site_name",
            "zone_name",
            "plot_name",
            "plant_code",
            "stem_code",
            "species_code",
            scientific_name(F.col("latin_name")).alias("species_scientific_name"),
            F.col("start_timestamp_utc").alias(START),
            F.col("end_timestamp_utc").alias(END),
            "installation_metadata",
            "timezone",
        )
    )


def alias_context(aliases: DataFrame, dataloggers: DataFrame) -> DataFrame:
    """Aliases with the code of their logger."""
    return aliases.join(
        dataloggers.select("datalogger_id", F.col("code").alias("_logger")), "datalogger_id"
    ).select(
        "alias",
        F.col("_logger").alias("datalogger_id"),
        "start_timestamp_utc",
        "end_timestamp_utc",
    )


def override_context(overrides: DataFrame, parameters: DataFrame) -> DataFrame:
    """Overrides with the code of their parameter."""
    codes = parameters.select("parameter_id", "code")
    rest = [c for c in overrides.columns if c not in ("parameter_id", "code")]
    return overrides.join(codes, "parameter_id").select("code", *rest)


def metadata_keys(deployments: DataFrame) -> list[str]:
    """Distinct installation-metadata keys; they become column names, so they are collected."""
    keys = deployments.select(
        F.explode(F.map_keys(metadata_map(F.col("installation_metadata")))).alias("key")
    ).distinct()
    return sorted(row.key for row in keys.toLocalIterator())


def metadata_map(document: Column) -> Column:
    """JSON object to key -> text: null stays null, strings as is, the rest as JSON text."""
    return F.from_json(document, "map<string,string>")


def expand_metadata(deployments: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One text column per installation-metadata key."""
    if keys is None:
        keys = metadata_keys(deployments)
    parsed = deployments.withColumn("_metadata", metadata_map(F.col("installation_metadata")))
    return parsed.select(
        *[F.col(c) for c in deployments.columns if c != "installation_metadata"],
        *[F.try_element_at("_metadata", F.lit(key)).alias(key) for key in keys],
    )


def match_deployments(
    observations: DataFrame,
    deployments: DataFrame,
    aliases: DataFrame | None = None,
    output: str = "deployment_id",
) -> DataFrame:
    """Left interval join to an id: ``start <= timestamp_utc < end`` on logger and address.

    Rows without a direct match are tried again through a logger alias valid at that time.
    Only the id is carried, so the rows stay as narrow as they came.
    """
    intervals = deployments.selectExpr(
        "datalogger_id AS _name",
        "sdi_address AS _address",
        f"{START} AS _from",
        f"{END} AS _until",
        "deployment_id AS _id",
    )
    matched = _attach_id(observations, intervals, "_direct")
    if aliases is None:
        return matched.withColumnRenamed("_direct", output)
    matched = _attach_id(
        matched, alias_intervals(intervals, aliases), "_renamed", "o._direct IS NULL"
    )
    return matched.withColumn(output, F.coalesce("_direct", "_renamed")).drop("_direct", "_renamed")


def _attach_id(
    rows: DataFrame, intervals: DataFrame, output: str, condition: str | None = None
) -> DataFrame:
    covers = (
        "o.logger_id = i._name AND o.sdi12_address = i._address AND o.timestamp_utc >= i._from"
        " AND (i._until IS NULL OR o.timestamp_utc < i._until)"
    )
    if condition is not None:
        covers += f" AND {condition}"
    return rows.alias("o").join(intervals.alias("i"), F.expr(covers), "left").selectExpr(
        "o.*", f"i._id AS {output}"
    )


def alias_intervals(intervals: DataFrame, aliases: DataFrame) -> DataFrame:
    """Deployments reachable under an alias, cut to the time the alias was valid."""
    cut = aliases.join(intervals, F.col("datalogger_id") == F.col("_name")).select(
        F.col("alias").alias("_name"),
        "_address",
        F.greatest("start_timestamp_utc", "_from").alias("_from"),
        F.least("end_timestamp_utc", "_until").alias("_until"),
        "_id",
    )
    return cut.where(F.col("_until").isNull() | (F.col("_from") < F.col("_until")))


def enrich_with_metadata(
    observations: DataFrame,
    deployments: DataFrame,
    aliases: DataFrame | None = None,
    payload: list[str] | None = None,
) -> DataFrame:
    """Attach the deployment active on the row's logger and address at its UTC time.

    ``deployments`` is a context frame with metadata keys already expanded; ``payload`` names
    the columns to attach (all but the address by default), null on rows outside every
    deployment. Intervals of one sensor must not overlap; :func:`ambiguous_matches` reports
    rows for which they do.
    """
    if payload is None:
        payload = [c for c in deployments.columns if c not in ("sdi_address", "timezone")]
    matched = match_deployments(observations, deployments, aliases, "_deployment")
    attached = deployments.select(F.col("deployment_id").alias("_deployment"), *payload)
    return matched.join(attached, "_deployment", "left").drop("_deployment")


def ambiguous_matches(
    observations: DataFrame, deployments: DataFrame, aliases: DataFrame | None = None
) -> DataFrame:
    """Sensor times covered by more than one deployment or alias interval, with the count.

    Only intervals that overlap another one of the same name are joined, so for valid
    metadata the interval side is empty and the query is a scan.
    """
    clashes = overlapping_intervals(deployments, aliases)
    points = observations.select("logger_id", "sdi12_address", "timestamp_utc").distinct()
    matched = points.join(
        clashes,
        (F.col("logger_id") == F.col("name"))
        & (F.col("address").isNull() | (F.col("sdi12_address") == F.col("address")))
        & within(F.col("timestamp_utc"), F.col("start"), F.col("end")),
    )
    return (
        matched.groupBy("kind", "logger_id", "sdi12_address", "timestamp_utc")
        .agg(F.count(F.lit(1)).alias("matches"))
        .where(F.col("matches") > 1)
    )


def overlapping_intervals(deployments: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """``name, address, start, end, kind`` of deployments and aliases that overlap another one."""
    clashes = _overlapping(
        deployments.select(
            F.col("datalogger_id").alias("name"),
            F.col("sdi_address").alias("address"),
            F.col(START).alias("start"),
            F.col(END).alias("end"),
            F.lit("deployment").alias("kind"),
        )
    )
    if aliases is not None:
        clashes = clashes.unionByName(
            _overlapping(
                aliases.select(
                    F.col("alias").alias("name"),
                    F.lit(None).cast("string").alias("address"),
                    F.col("start_timestamp_utc").alias("start"),
                    F.col("end_timestamp_utc").alias("end"),
                    F.lit("alias").alias("kind"),
                )
            )
        )
    return clashes


def _overlapping(intervals: DataFrame) -> DataFrame:
    """Intervals of a name and address in which some time is covered twice.

    An interval that starts before the largest earlier end overlaps; the names concerned are
    few (none in valid metadata), and all their intervals are returned.
    """
    far = F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")
    bounded = intervals.withColumn("_end", F.coalesce("end", far))
    keys = ["kind", "name", "address"]
    reach = running_max_before(
        bounded, keys, micros(F.col("start")), ["start", "_end"], "_end", "_reach", null_keys=True
    )
    clashing = reach.where(F.col("_reach") > F.col("start")).select(*keys).distinct()
    condition = F.lit(True)
    for key in keys:
        condition &= F.col(f"i.{key}").eqNullSafe(F.col(f"k.{key}"))
    return intervals.alias("i").join(clashing.alias("k"), condition, "left_semi")


def assert_unambiguous(
    observations: DataFrame, deployments: DataFrame, aliases: DataFrame | None = None
) -> None:
    """Fail when an observation falls into two deployments or two alias intervals."""
    first = ambiguous_matches(observations, deployments, aliases).take(1)
    if first:
        row = first[0]
        raise ValueError(
            f"ambiguous {row.kind} for logger {row.logger_id}, address {row.sdi12_address}"
            f" at {row.timestamp_utc}"
        )
