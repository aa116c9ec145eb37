"""Metadata manifest checks and identifiers.

A manifest is a dict of entity name to DataFrame of rows to add; ``existing`` is the same dict
for what is already stored. Rows are identified by natural keys. Every check is one query that
yields ``entity, key, violation`` rows; a manifest is valid when all are empty.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from zoneinfo import available_timezones

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from xylemflow.functions.ordered import running_max_before
from xylemflow.functions.times import micros
from xylemflow.functions.values import sdi12_address

VIOLATION_SCHEMA = "entity string, key string, violation string"


@dataclass(frozen=True)
class Parent:
    """A reference: own column -> column of the parent; optional when null is allowed."""

    entity: str
    columns: Mapping[str, str]
    optional: bool = False
    must_be_unique: bool = False


@dataclass(frozen=True)
class Entity:
    key: tuple[str, ...]
    parents: tuple[Parent, ...] = ()
    required: tuple[str, ...] = ()
    unique: bool = True
    interval_key: tuple[str, ...] = ()
    shape: tuple[str, str] | None = None  # (column, GeoJSON kind)


PLANT = Parent("plants", {"plant_code": "code"}, must_be_unique=True)
STEM = Parent("stems", {"plant_code": "plant_code", "stem_code": "code"})
SITE = Parent("sites", {"site_code": "code"})

# --- Fixed values: entities in dependency order -------------------------------------------
ENTITIES = {
    "projects": Entity(("code",), required=("code",)),
    "sites": Entity(("code",), required=("code",), shape=("boundary", "Polygon")),
    "zones": Entity(("site_code", "name"), (SITE,), shape=("boundary", "Polygon")),
    "plots": Entity(
        ("site_code", "zone_name", "name"),
        (SITE, Parent("zones", {"site_code": "site_code", "zone_name": "name"})),
        shape=("boundary", "Polygon"),
    ),
    "species": Entity(("code",), required=("code",)),
    "plants": Entity(
        ("site_code", "zone_name", "plot_name", "code"),
        (
            Parent("plots", {"site_code": "site_code", "zone_name": "zone_name", "plot_name": "name"}),
            Parent("species", {"species_code": "code"}),
        ),
        shape=("location", "Point"),
    ),
    "stems": Entity(("plant_code", "code"), (PLANT,)),
    "datalogger_types": Entity(("code",), required=("code",)),
    "dataloggers": Entity(("code",), (Parent("datalogger_types", {"datalogger_type_code": "code"}),)),
    "datalogger_aliases": Entity(
        ("alias",),
        (Parent("dataloggers", {"datalogger_code": "code"}),),
        required=("alias",),
        unique=False,
        interval_key=("alias",),
    ),
    "sensor_types": Entity(("code",), required=("code",)),
    "sensor_thermistor_pairs": Entity(
        ("sensor_type_code", "name"), (Parent("sensor_types", {"sensor_type_code": "code"}),)
    ),
    "deployments": Entity(
        ("datalogger_code", "sdi_address"),
        (
            Parent("projects", {"project_code": "code"}),
            PLANT,
            STEM,
            Parent("dataloggers", {"datalogger_code": "code"}),
            Parent("sensor_types", {"sensor_type_code": "code"}),
        ),
        unique=False,
        interval_key=("datalogger_code", "sdi_address"),
    ),
    "parameter_overrides": Entity(
        ("parameter_code",),
        (
            Parent("parameters", {"parameter_code": "code"}),
            Parent("sites", {"site_code": "code"}, optional=True),
            Parent("species", {"species_code": "code"}, optional=True),
            Parent("zones", {"zone_name": "name"}, optional=True, must_be_unique=True),
            Parent("plots", {"plot_name": "name"}, optional=True, must_be_unique=True),
            Parent("plants", {"plant_code": "code"}, optional=True, must_be_unique=True),
            Parent("stems", {"plant_code": "plant_code", "stem_code": "code"}, optional=True),
        ),
        unique=False,
    ),
}
# --- End of fixed values ------------------------------------------------------------------

Frames = Mapping[str, DataFrame]


def _key(columns: tuple[str, ...]) -> Column:
    return F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def _violations(rows: DataFrame, entity: str, kind: str) -> DataFrame:
    return rows.select(
        F.lit(entity).alias("entity"), _key(ENTITIES[entity].key).alias("key"), F.lit(kind).alias("violation")
    )


def _union(frames: list[DataFrame]) -> DataFrame | None:
    return reduce(lambda a, b: a.unionByName(b), frames) if frames else None


def universe(entity: str, adds: Frames, existing: Frames, columns: list[str]) -> DataFrame | None:
    """The given columns of all rows of an entity, stored or about to be added."""
    frames = [f[entity].select(*columns) for f in (existing, adds) if entity in f]
    return _union(frames)


def missing_parents(entity: str, adds: Frames, existing: Frames) -> DataFrame | None:
    """Rows whose parent is neither stored nor added."""
    found = []
    for parent in ENTITIES[entity].parents:
        own, theirs = list(parent.columns), list(parent.columns.values())
        rows = adds[entity]
        if parent.optional:
            rows = rows.where(F.col(own[-1]).isNotNull())
        known = universe(parent.entity, adds, existing, theirs)
        if known is not None:
            renamed = known.select(*[F.col(t).alias(o) for o, t in parent.columns.items()])
            rows = rows.join(renamed, own, "left_anti")
        found.append(_violations(rows, entity, f"missing {parent.entity}"))
    return _union(found)


def ambiguous_names(entity: str, adds: Frames, existing: Frames) -> DataFrame | None:
    """Rows that name a parent by a code or name shared by several of its kind."""
    found = []
    for parent in ENTITIES[entity].parents:
        if not parent.must_be_unique:
            continue
        own, theirs = list(parent.columns), list(parent.columns.values())
        known = universe(parent.entity, adds, existing, list(ENTITIES[parent.entity].key))
        if known is None:
            continue
        shared = (
            known.distinct()
            .groupBy(*theirs)
            .agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > 1)
            .select(*[F.col(t).alias(o) for o, t in parent.columns.items()])
        )
        rows = adds[entity].join(shared, own, "left_semi")
        found.append(_violations(rows, entity, f"ambiguous {parent.entity}"))
    return _union(found)


def duplicates(entity: str, adds: Frames, existing: Frames) -> DataFrame | None:
    """Natural keys that would occur more than once after the add, one row per key."""
    spec = ENTITIES[entity]
    if not spec.unique:
        return None
    key = list(spec.key)
    marked = [adds[entity].select(*key, F.lit(1).alias("_new"))]
    if entity in existing:
        marked.append(existing[entity].select(*key, F.lit(0).alias("_new")))
    counts = (
        _union(marked)
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("_n"), F.max("_new").alias("_new"))
    )
    return _violations(counts.where((F.col("_n") > 1) & (F.col("_new") == 1)), entity, "already exists")


def overlapping_intervals(intervals: DataFrame, key: list[str]) -> DataFrame:
    """Intervals that overlap or touch an earlier one of the same key.

    ``start_timestamp_utc`` and ``end_timestamp_utc`` (null is open). An interval conflicts when
    it starts no later than the largest end before it, so no pairs are formed.
    """
    far = F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")
    bounded = intervals.withColumn("_end", F.coalesce("end_timestamp_utc", far))
    reach = running_max_before(
        bounded,
        key,
        micros(F.col("start_timestamp_utc")),
        ["start_timestamp_utc", "_end"],
        "_end",
        "_reach",
    )
    return reach.where(F.col("_reach") >= F.col("start_timestamp_utc")).drop("_end", "_reach")


def interval_conflicts(entity: str, adds: Frames, existing: Frames) -> DataFrame | None:
    key = list(ENTITIES[entity].interval_key)
    if not key:
        return None
    columns = [*key, "start_timestamp_utc", "end_timestamp_utc"]
    everything = universe(entity, adds, existing, columns)
    return _violations(overlapping_intervals(everything, key), entity, "overlaps or touches")


def geojson_kind(document: Column) -> Column:
    """``type`` of a GeoJSON geometry given as an object or as a quoted string; else null."""
    inner = F.when(
        F.trim(document).startswith('"'),
        F.get_json_object(F.concat(F.lit('{"v":'), document, F.lit("}")), "$.v"),
    ).otherwise(document)
    kind = F.get_json_object(inner, "$.type")
    return F.when(F.get_json_object(inner, "$.coordinates").isNotNull(), kind)


def scalar_faults(entity: str, adds: Frames) -> DataFrame | None:
    """Faults visible in a single row: empty codes, zones, shapes, intervals, addresses."""
    spec, rows = ENTITIES[entity], adds[entity]
    checks: list[tuple[str, Column]] = [
        (f"empty {name}", F.coalesce(F.col(name), F.lit("")) == "") for name in spec.required
    ]
    if entity == "sites":
        zones = sorted(available_timezones())
        checks.append(("invalid timezone", ~F.coalesce(F.col("timezone").isin(*zones), F.lit(False))))
    if spec.shape and spec.shape[0] in rows.columns:
        column, kind = spec.shape
        wrong = F.coalesce(geojson_kind(F.col(column)) != kind, F.lit(True))
        given = F.col(column).isNotNull() & (F.trim(column) != "null")
        checks.append((f"{column} is not a {kind}", given & wrong))
    if spec.interval_key:
        checks.append(
            ("end not after start", F.col("end_timestamp_utc") <= F.col("start_timestamp_utc"))
        )
    if entity == "deployments":
        checks.append(("invalid SDI-12 address", sdi12_address(F.col("sdi_address")).isNull()))
    if entity == "parameter_overrides":
        checks.append(
            ("stem without plant", F.col("stem_code").isNotNull() & F.col("plant_code").isNull())
        )
    if not checks:
        return None
    faults = F.array(*[F.when(bad, F.lit(name)) for name, bad in checks])
    return rows.select(
        F.lit(entity).alias("entity"),
        _key(spec.key).alias("key"),
        F.explode(F.filter(faults, lambda f: f.isNotNull())).alias("violation"),
    )


def _lookups(entity: str) -> list[tuple[str, ...]]:
    """The sets of columns by which other entities name a row of this one."""
    return sorted({tuple(p.columns.values()) for spec in ENTITIES.values() for p in spec.parents if p.entity == entity})


def _lookup_name(entity: str, columns: tuple[str, ...]) -> str:
    return f"{entity}({', '.join(columns)})"


def _joined(columns: tuple[str, ...]) -> Column:
    """Several values as one text that keeps them apart; null if any is null."""
    texts = [F.col(c).cast("string") for c in columns]
    known = texts[0].isNotNull()
    for text in texts[1:]:
        known &= text.isNotNull()
    return F.when(known, F.to_json(F.array(*texts)))


def _nodes(entity: str, rows: DataFrame, new: bool) -> DataFrame:
    """``lookup, name, identity, label, is_new``: a row under its own key and each name it goes by."""
    spec = ENTITIES.get(entity)
    key = spec.key if spec else ("code",)
    identity = F.to_json(F.array(*[F.col(c).cast("string") for c in key]), {"ignoreNullFields": "false"})
    names = [(_lookup_name(entity, columns), _joined(columns)) for columns in _lookups(entity)]
    if spec and spec.unique:
        names.append((entity, identity))
    if not names:
        return rows.select(*(F.lit(None).cast("string").alias(c) for c in ("lookup", "name", "identity", "label")), F.lit(new).alias("is_new")).limit(0)
    listed = F.array(*[F.struct(F.lit(lookup).alias("lookup"), name.alias("name")) for lookup, name in names])
    return rows.select(F.inline(listed), identity.alias("identity"), _key(key).alias("label"), F.lit(new).alias("is_new"))


def _references(entity: str, rows: DataFrame) -> DataFrame | None:
    """``entity, key, lookup, name, parent, must_be_unique``: an edge per row and parent it names."""
    parents = ENTITIES[entity].parents
    if not parents:
        return None
    edges = [
        F.when(
            F.col(list(parent.columns)[-1]).isNotNull() | F.lit(not parent.optional),
            F.struct(
                F.lit(_lookup_name(parent.entity, tuple(parent.columns.values()))).alias("lookup"),
                _joined(tuple(parent.columns)).alias("name"),
                F.lit(parent.entity).alias("parent"),
                F.lit(parent.must_be_unique).alias("must_be_unique"),
            ),
        )
        for parent in parents
    ]
    return rows.select(
        F.lit(entity).alias("entity"), _key(ENTITIES[entity].key).alias("key"), F.inline(F.filter(F.array(*edges), lambda e: e.isNotNull()))
    )


def key_violations(adds: Frames, existing: Frames) -> DataFrame:
    """Parents that are missing or ambiguous and keys that exist, of all entities together.

    All rows go into one frame of names and all references into one frame of edges; one aggregate
    counts what goes by a name and one join brings the edges to it.
    """
    nodes = [_nodes(e, frames[e], new) for frames, new in ((existing, False), (adds, True)) for e in frames]
    held = _union(nodes).where(F.col("name").isNotNull()).groupBy("lookup", "name").agg(
        F.count(F.lit(1)).alias("n"), F.max("is_new").alias("is_new"), F.min("label").alias("label"),
        (F.min("identity") != F.max("identity")).alias("shared"),
    )
    again = held.where("n > 1 AND is_new").where(F.col("lookup").isin(*[e for e, spec in ENTITIES.items() if spec.unique]))
    repeated = again.select(F.col("lookup").alias("entity"), F.col("label").alias("key"), F.lit("already exists").alias("violation"))
    edges = _union([e for e in (_references(entity, adds[entity]) for entity in adds) if e is not None])
    if edges is None:
        return repeated
    met = edges.join(held.select("lookup", "name", "shared"), ["lookup", "name"], "left")
    fault = F.when(F.col("shared").isNull(), F.concat(F.lit("missing "), F.col("parent"))).when(
        F.col("must_be_unique") & F.col("shared"), F.concat(F.lit("ambiguous "), F.col("parent"))
    )
    return met.select("entity", "key", fault.alias("violation")).where(F.col("violation").isNotNull()).unionByName(repeated)


def period_violations(adds: Frames, existing: Frames) -> DataFrame | None:
    """Periods of a key that overlap or touch, of all entities that have some, in one ordered pass."""
    periods = []
    for entity in adds:
        key = ENTITIES[entity].interval_key
        if key:
            everything = universe(entity, adds, existing, [*key, "start_timestamp_utc", "end_timestamp_utc"])
            identity = F.to_json(F.array(*[F.col(c).cast("string") for c in key]))
            periods.append(
                everything.select(
                    F.lit(entity).alias("entity"), _key(ENTITIES[entity].key).alias("key"), identity.alias("_identity"),
                    "start_timestamp_utc", "end_timestamp_utc",
                )
            )
    if not periods:
        return None
    found = overlapping_intervals(_union(periods), ["entity", "_identity"])
    return found.select("entity", "key", F.lit("overlaps or touches").alias("violation"))


def validate_manifest(adds: Frames, existing: Frames) -> DataFrame:
    """All violations of a manifest: one plan for all entities, however many it has."""
    adds = {entity: adds[entity] for entity in ENTITIES if entity in adds}
    if not adds:
        frame = next(iter(existing.values()))
        return frame.sparkSession.createDataFrame([], VIOLATION_SCHEMA)
    found = [scalar_faults(entity, adds) for entity in adds]
    found += [key_violations(adds, existing), period_violations(adds, existing)]
    return _union([f for f in found if f is not None])


def metadata_summary(adds: Frames) -> DataFrame:
    """Rows per entity of the manifest, zero for entities it does not have."""
    frames = list(adds.values())
    spark = frames[0].sparkSession
    counted = _union(
        [
            frame.agg(F.count(F.lit(1)).alias("count")).select(F.lit(name).alias("entity"), "count")
            for name, frame in adds.items()
        ]
    )
    listed = spark.createDataFrame([(e,) for e in ENTITIES], "entity string")
    return listed.join(counted, "entity", "left").select(
        "entity", F.coalesce("count", F.lit(0)).alias("count")
    )


def stable_id(entity: str, columns: tuple[str, ...]) -> Column:
    """Identifier derived from the natural key, so that a replay gives the same one."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws("\x1f", F.lit(entity), *parts), 256)


def id_key(entity: str) -> tuple[str, ...]:
    spec = ENTITIES[entity]
    return spec.key + (("start_timestamp_utc",) if spec.interval_key else ())


def with_ids(entity: str, adds: Frames, existing: Frames) -> DataFrame:
    """The rows to append: own ``id`` and one ``<parent>_id`` per reference.

    Stored frames carry ``id``; parents added by the same manifest get theirs from the key.
    """
    result = adds[entity].withColumn("id", stable_id(entity, id_key(entity)))
    if entity == "deployments":
        metadata = F.coalesce("installation_metadata", F.lit("null"))
        result = result.withColumn(
            "installation_metadata", F.when(F.trim(metadata) == "null", F.lit("{}")).otherwise(metadata)
        )
    for parent in ENTITIES[entity].parents:
        frames = []
        if parent.entity in existing:
            frames.append(existing[parent.entity].select(*parent.columns.values(), "id"))
        if parent.entity in adds:
            added = adds[parent.entity].withColumn("id", stable_id(parent.entity, id_key(parent.entity)))
            frames.append(added.select(*parent.columns.values(), "id"))
        known = _union(frames)
        if known is None:
            continue
        names = known.select(
            *[F.col(t).alias(o) for o, t in parent.columns.items()],
            F.col("id").alias(f"{parent.entity}_id"),
        )
        result = result.join(names, list(parent.columns), "left")
    return result


def upsert_overrides(existing: DataFrame, adds: DataFrame, key: list[str]) -> DataFrame:
    """Latest value per override key; null scope ids are equal to each other.

    Both frames have the key, ``value`` and ``transaction_seq``.
    """
    everything = existing.select(*key, "value", "transaction_seq").unionByName(
        adds.select(*key, "value", "transaction_seq")
    )
    latest = F.max(F.struct("transaction_seq", "value")).alias("_latest")
    return everything.groupBy(*key).agg(latest).select(
        *key, "_latest.value", "_latest.transaction_seq"
    )
