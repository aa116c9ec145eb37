"""Stored metadata: appended by accepted transactions, read as of a version of the log."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xylemflow.operators.enrich import alias_context, deployment_context
from xylemflow.operators.manifest import ENTITIES, Frames, upsert_overrides, with_ids
from xylemflow.plans.processing import Context
from xylemflow.schema import PARAMETERS, SCOPE_COLUMNS
from xylemflow.sources.commits import CommitLog
from xylemflow.sources.tables import stage

_PERIOD = ("start_timestamp_utc timestamp_ntz", "end_timestamp_utc timestamp_ntz")

# --- Fixed values: columns of each kind of entry ------------------------------------------
ENTRIES: dict[str, tuple[str, ...]] = {
    "projects": ("code string", "name string", "description string"),
    "sites": ("code string", "name string", "timezone string", "icon_path string", "boundary string"),
    "zones": ("site_code string", "name string", "boundary string"),
    "plots": ("site_code string", "zone_name string", "name string", "boundary string"),
    "species": ("code string", "common_name string", "latin_name string", "icon_path string"),
    "plants": ("site_code string", "zone_name string", "plot_name string", "species_code string", "code string", "location string"),
    "stems": ("plant_code string", "code string", "dbh_cm double"),
    "datalogger_types": ("code string", "name string", "icon_path string"),
    "dataloggers": ("datalogger_type_code string", "code string"),
    "datalogger_aliases": ("datalogger_code string", "alias string", *_PERIOD),
    "sensor_types": ("code string", "description string"),
    "sensor_thermistor_pairs": ("sensor_type_code string", "name string", "depth_mm double"),
    "deployments": (
        "project_code string", "plant_code string", "stem_code string", "datalogger_code string", "sensor_type_code string",
        "sdi_address string", *_PERIOD, "installation_metadata string", "include_in_pipeline boolean",
    ),
    "parameter_overrides": (
        "parameter_code string", "value string", "site_code string", "species_code string", "zone_name string", "plot_name string",
        "plant_code string", "stem_code string",
    ),
}
# --- End of fixed values ------------------------------------------------------------------

#: A parameter is known by its code; its definitions come with the library.
PARAMETERS_ENTITY = "parameters"


def parent_ids(entity: str) -> list[str]:
    return list(dict.fromkeys(f"{parent.entity}_id" for parent in ENTITIES[entity].parents))


def stored_schema(entity: str) -> str:
    return ", ".join([*ENTRIES[entity], "id string", *(f"{name} string" for name in parent_ids(entity))])


def table_of(entity: str) -> str:
    return f"metadata/{entity}"


def _column(kind: str, given: set[str]):
    name, of = kind.split(" ")
    default = F.lit(True) if name == "include_in_pipeline" else F.lit(None)
    return (F.coalesce(F.col(name), default) if name in given else default).cast(of).alias(name)


def complete(manifest: Frames) -> Frames:
    """A manifest with all columns of its entries: missing ones are null, deployments take part."""
    return {
        entity: rows.select(*(_column(kind, set(rows.columns)) for kind in ENTRIES[entity])) for entity, rows in manifest.items()
    }


def to_store(entity: str, manifest: Frames, existing: Frames) -> DataFrame:
    """The rows of an entity as they are stored: entries, own id and those of their parents."""
    rows = with_ids(entity, manifest, existing)
    given = set(rows.columns)
    kinds = [*ENTRIES[entity], "id string", *(f"{name} string" for name in parent_ids(entity))]
    return rows.select(*(_column(kind, given) for kind in kinds))


def snapshot(log: CommitLog, version: int | None = None, run_id: str | None = None) -> dict[str, DataFrame]:
    """All stored entities as of a version, with their ``commit_version``.

    The list of visible runs is written down once, since every entity is joined to it.
    """
    visible = stage(log.visible(version, run_id), "visible-runs")
    frames = {entity: log.read(table_of(entity), stored_schema(entity), visible) for entity in ENTRIES}
    codes = [(p.code, p.code) for p in PARAMETERS]
    frames[PARAMETERS_ENTITY] = log.spark.createDataFrame(codes, "id string, code string")
    return frames


def with_added(stored: Mapping[str, DataFrame], manifest: Frames, version: int) -> dict[str, DataFrame]:
    """What a snapshot becomes with a manifest, before anything is written."""
    frames = dict(stored)
    for entity in manifest:
        added = to_store(entity, manifest, stored).withColumn("commit_version", F.lit(version).cast("bigint"))
        frames[entity] = stored[entity].unionByName(added)
    return frames


def context_of(frames: Mapping[str, DataFrame]) -> Context:
    """The metadata a run needs, from stored entities."""

    def renamed(entity: str, own: str | None, **parents: str) -> DataFrame:
        pairs = {**({"id": own} if own else {}), **parents}
        rest = [c for c in frames[entity].columns if c not in pairs and not c.endswith("_id")]
        return frames[entity].select(*[F.col(c).alias(name) for c, name in pairs.items()], *rest)

    loggers = renamed("dataloggers", "datalogger_id")
    sites = renamed("sites", "site_id")
    # The codes of its parents come from the parents.
    deployed = renamed("deployments", "deployment_id", dataloggers_id="datalogger_id", stems_id="stem_id", projects_id="project_id")
    deployments = deployment_context(
        deployed.drop("project_code", "plant_code", "stem_code"),
        loggers,
        renamed("stems", "stem_id", plants_id="plant_id"),
        renamed("plants", "plant_id", plots_id="plot_id", species_id="species_id"),
        renamed("plots", "plot_id", zones_id="zone_id"),
        renamed("zones", "zone_id", sites_id="site_id"),
        sites,
        renamed("species", "species_id"),
        renamed("projects", "project_id"),
    )
    aliases = alias_context(renamed("datalogger_aliases", None, dataloggers_id="datalogger_id"), loggers)
    return Context(sites.select("site_id", "timezone"), deployments, overrides_of(frames["parameter_overrides"]), aliases)


def overrides_of(stored: DataFrame) -> DataFrame:
    """The latest value of each parameter and scope; later transactions come after earlier ones."""
    scopes = {"stem_id": "stems_id", "plant_id": "plants_id", "plot_id": "plots_id", "zone_id": "zones_id", "species_id": "species_id", "site_id": "sites_id"}
    none = F.lit(None).cast("string")
    rows = stored.select(
        F.col("parameter_code").alias("code"), "value", F.col("commit_version").alias("transaction_seq"),
        *(F.col(scopes[c]).alias(c) if c in scopes else none.alias(c) for c in SCOPE_COLUMNS),
    )
    latest = upsert_overrides(rows.limit(0), rows, ["code", *SCOPE_COLUMNS])
    return latest.select(F.col("transaction_seq").alias("seq"), "code", "value", *SCOPE_COLUMNS)
