"""Registered queries: a Spark callable per operator and, where SQL can say it, its counterpart."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import oracle_parts as P
from catalog.inputs import Tables, with_inputs
from catalog.toa5_text import EXPECTED_SQL, toa5_files
from xylemflow.functions import text as X
from xylemflow.functions import values as V
from xylemflow.functions.times import local_to_utc_offset, utc_to_local
from xylemflow.operators import (
    dma,
    enrich,
    explore,
    flatten,
    manifest,
    parameters,
    profile,
    quality,
    receipts,
    storage,
    summaries,
    timestamps,
)
from xylemflow.plans import ingest, processing, transaction
from xylemflow.schema import CONTEXT_COLUMNS, PARAMETERS
from xylemflow.session import checkpoint_dir
from xylemflow.sources import rawfiles, tables, toa5

NOW = datetime(2024, 1, 28)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the test tables under a name."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_inputs(sql)
        return build

    return register


def six(name: str):
    return F.round(F.col(name), 6).alias(name)


def six_sql(*names: str) -> str:
    return ", ".join(f"round({n}, 6) + 0 AS {n}" for n in names)


# --- Sources ------------------------------------------------------------------------------


@query(
    "toa5_parse",
    f"SELECT * FROM ({EXPECTED_SQL}) e",
)
def _toa5_parse(t: Tables) -> DataFrame:
    parsed = toa5.parse_toa5(toa5_files(t))
    rows = flatten.flatten_parsed_files(parsed.withColumn("file_hash", F.col("path")))
    return rows.select(
        F.col("file_hash").alias("path"),
        "logger_id",
        "record",
        "timestamp",
        "thermistor_depth",
        "sdi12_address",
        "alpha",
        "beta",
        "time_to_max_temp_downstream_s",
        "pre_pulse_temp_downstream_c",
    )


def _mixed_batch(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Logger files, second copies of some, documents as junk, and a history of some hashes."""
    logs = tables.stage(toa5_files(t), "logs")
    copies = logs.where(F.col("path").contains("dl/1")).withColumn(
        "path", F.concat(F.lit("zz/"), F.col("path"))
    )
    junk = rawfiles.identified(t.sql("SELECT path, encode(text, 'UTF-8') AS content FROM raw_doc"))
    files = logs.unionByName(copies).unionByName(junk)
    history = logs.where(F.col("path").startswith("dl/2")).select("file_hash")
    return files, history


BATCH_SQL = """
    WITH log AS (SELECT path, min(logger) AS logger, min(part) AS part FROM toa5_line GROUP BY path),
    doc AS (SELECT path, row_number() OVER (PARTITION BY text ORDER BY path) AS copy FROM raw_doc),
    everything AS (
      SELECT path, CASE WHEN path LIKE 'dl/2%' THEN 'Duplicate' WHEN logger = 9 AND part = 0 THEN 'Failed'
                        ELSE 'Parsed' END AS status,
        CASE WHEN path LIKE 'dl/2%' THEN 0 WHEN logger = 9 AND part = 0 THEN 5
             ELSE logger % 5 END AS attempts,
        CASE WHEN logger = 9 AND part = 0 AND path NOT LIKE 'dl/2%' THEN 10 END AS first_error_line
      FROM log
      UNION ALL
      SELECT CONCAT('zz/', path), 'Duplicate', 0, NULL FROM log WHERE path LIKE '%dl/1%'
      UNION ALL
      SELECT path, 'Failed', 5, NULL FROM doc)"""


@query(
    "ingest_reports",
    f"{BATCH_SQL} SELECT path, status, CAST(attempts AS INTEGER) AS attempts, first_error_line FROM everything",
)
def _ingest_reports(t: Tables) -> DataFrame:
    files, history = _mixed_batch(t)
    reports = ingest.ingest_files(files, history).reports
    return reports.select("path", "status", F.size("parser_attempts").alias("attempts"), "first_error_line")


@query(
    "ingestion_summary",
    f"""{BATCH_SQL} SELECT count(*) AS total, count(*) FILTER (status = 'Parsed') AS parsed,
        count(*) FILTER (status = 'Duplicate') AS duplicates, count(*) FILTER (status = 'Failed') AS failed
        FROM everything""",
)
def _ingestion_summary(t: Tables) -> DataFrame:
    files, history = _mixed_batch(t)
    return summaries.ingestion_summary(ingest.ingest_files(files, history).reports)


@query(
    "raw_file_identity",
    """SELECT path, sha256(text) AS file_hash, TRUE AS is_text, CONCAT('raw-files/', sha256(text)) AS object_key
       FROM raw_doc""",
)
def _raw_file_identity(t: Tables) -> DataFrame:
    files = rawfiles.identified(t.sql("SELECT path, encode(text, 'UTF-8') AS content FROM raw_doc"))
    return rawfiles.decoded(files).select(
        "path", "file_hash", F.col("text").isNotNull().alias("is_text"),
        X.raw_file_key(F.col("file_hash")).alias("object_key"),
    )


@query(
    "dedup_history",
    """WITH known AS (SELECT DISTINCT sha256(text) AS h FROM raw_doc WHERE doc_id % 3 = 0)
       SELECT path, sha256(text) AS file_hash,
         CASE WHEN sha256(text) IN (SELECT h FROM known) THEN 'Duplicate' ELSE 'New' END AS status FROM raw_doc""",
)
def _dedup_history(t: Tables) -> DataFrame:
    files = t.sql("SELECT path, doc_id, sha2(text, 256) AS file_hash FROM raw_doc")
    history = files.where(F.col("doc_id") % 3 == 0).select("file_hash").distinct()
    fresh, known = ingest.split_by_history(files.select("path", "file_hash"), history)
    return fresh.withColumn("status", F.lit("New")).unionByName(known.withColumn("status", F.lit("Duplicate")))


@query(
    "dedup_batch",
    """SELECT path, file_hash, rn > 1 AS is_copy FROM (
         SELECT path, sha256(text) AS file_hash, row_number() OVER (PARTITION BY sha256(text) ORDER BY path) AS rn
         FROM raw_doc) x""",
)
def _dedup_batch(t: Tables) -> DataFrame:
    files = t.sql("SELECT path, sha2(text, 256) AS file_hash FROM raw_doc")
    firsts = ingest.first_copies(files).withColumnRenamed("path", "first_path")
    return files.join(firsts, "file_hash").select(
        "path", "file_hash", (F.col("path") != F.col("first_path")).alias("is_copy")
    )


@query(
    "hash_registry_append",
    """SELECT DISTINCT sha256(text) AS file_hash FROM raw_doc
       WHERE sha256(text) NOT IN (SELECT sha256(text) FROM raw_doc WHERE doc_id % 3 = 0)""",
)
def _hash_registry_append(t: Tables) -> DataFrame:
    files = t.sql("SELECT doc_id, sha2(text, 256) AS file_hash FROM raw_doc")
    return tables.new_hashes(files.where(F.col("doc_id") % 3 == 0), files)


@query(
    "raw_content_copies",
    """SELECT CONCAT('raw-files/', sha256(text)) AS object_key, min(length(text)) AS n_chars
       FROM raw_doc GROUP BY sha256(text)""",
)
def _raw_content_copies(t: Tables) -> DataFrame:
    files = rawfiles.identified(t.sql("SELECT path, encode(text, 'UTF-8') AS content FROM raw_doc"))
    reports = ingest.first_copies(files).withColumn("status", F.lit("Parsed"))
    copies = tables.raw_copies(files, reports)
    return copies.select("object_key", F.length(F.col("content").cast("string")).cast("bigint").alias("n_chars"))


@query(
    "newest_file",
    """SELECT path, modificationTime FROM (
         SELECT CAST(o_orderkey AS VARCHAR) AS path, o_orderdate AS modificationTime,
           row_number() OVER (ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC) AS rn FROM orders) x
       WHERE rn = 1""",
)
def _newest_file(t: Tables) -> DataFrame:
    return tables.newest_file(
        t.sql("SELECT CAST(o_orderkey AS STRING) AS path, o_orderdate AS modificationTime FROM orders")
    )


@query(
    "output_registry_latest",
    """SELECT output_id, published_at, rn = 1 AS is_latest FROM (
         SELECT CAST(o_orderkey AS VARCHAR) AS output_id, o_orderdate AS published_at,
           row_number() OVER (ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC) AS rn FROM orders) x""",
)
def _output_registry_latest(t: Tables) -> DataFrame:
    return tables.registered_outputs(
        t.sql("SELECT CAST(o_orderkey AS STRING) AS output_id, o_orderdate AS published_at FROM orders")
    )


@query(
    "reading_cells",
    """SELECT doc_id, word, TRY_CAST(CASE WHEN regexp_full_match(word, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')
         AND word <> '-99' THEN word END AS DOUBLE) AS reading,
         NOT (regexp_full_match(word, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') OR word = ''
              OR lower(word) IN ('nan', 'inf', 'infinity', '+inf', '-inf', '+nan', '-nan')) AS is_bad,
         CASE WHEN regexp_full_match(word, '[0-9A-Za-z]') THEN word END AS address,
         CASE lower(word) WHEN 'i' THEN 'inner' WHEN 'in' THEN 'inner' WHEN 'inner' THEN 'inner' WHEN 'o' THEN 'outer'
           WHEN 'out' THEN 'outer' WHEN 'outer' THEN 'outer' END AS depth
       FROM (SELECT doc_id, unnest(string_split(regexp_replace(text, '\\s+', ' ', 'g'), ' ')) AS word
             FROM documents) w GROUP BY doc_id, word""",
)
def _reading_cells(t: Tables) -> DataFrame:
    words = t.sql(
        "SELECT doc_id, explode(split(regexp_replace(text, '\\\\s+', ' '), ' ')) AS word FROM documents"
    ).distinct()
    word = F.col("word")
    return words.select(
        "doc_id",
        "word",
        V.reading(word).alias("reading"),
        V.reading_is_bad(word).alias("is_bad"),
        V.sdi12_address(word).alias("address"),
        V.thermistor_depth(word).alias("depth"),
    )


# --- Flatten ------------------------------------------------------------------------------


@query(
    "flatten_observations",
    """SELECT ts AS timestamp, event_id AS record, value / 100.0 AS battery_voltage_v,
         CAST(NULL AS DOUBLE) AS panel_temperature_c, CAST(user_id % 25 AS VARCHAR) AS logger_id,
         CONCAT('log-', CAST(user_id % 25 AS VARCHAR), '-', CAST(CAST(floor(event_id / 500.0) AS BIGINT) AS VARCHAR)) AS file_hash,
         '0' AS sdi12_address, d.depth AS thermistor_depth,
         CASE d.depth WHEN 'outer' THEN value / 50.0 ELSE value / 60.0 END AS alpha,
         CASE d.depth WHEN 'outer' THEN value / 40.0 ELSE value / 30.0 END AS beta,
         CASE d.depth WHEN 'outer' THEN value + 2.0 END AS time_to_max_temp_downstream_s
       FROM events JOIN (SELECT 'outer' AS depth UNION ALL SELECT 'inner' AS depth) d ON TRUE""",
)
def _flatten_observations(t: Tables) -> DataFrame:
    files = t.sql("""
        SELECT CONCAT('log-', CAST(user_id % 25 AS STRING), '-', CAST(CAST(floor(event_id / 500.0) AS BIGINT) AS STRING)) AS file_hash,
          CAST(user_id % 25 AS STRING) AS logger_id,
          collect_list(named_struct('timestamp', ts, 'record', event_id, 'battery_voltage_v', value / 100.0,
            'panel_temperature_c', CAST(NULL AS DOUBLE),
            'cells', array(value / 50.0, value / 60.0, value / 40.0, value / 30.0, value + 2.0))) AS rows
        FROM events GROUP BY 1, 2""")

    def slot(depth: str, cells: list[int | None]):
        padded = cells + [None] * (10 - len(cells))
        return F.struct(
            F.lit("0").alias("sdi12_address"),
            F.lit(depth).alias("thermistor_depth"),
            F.array(*[F.lit(c).cast("int") for c in padded]).alias("cells"),
        )

    nested = files.withColumn("slots", F.array(slot("outer", [0, 2, 4]), slot("inner", [1, 3])))
    flat = flatten.flatten_parsed_files(nested)
    return flat.select(
        "timestamp", "record", "battery_voltage_v", "panel_temperature_c", "logger_id", "file_hash",
        "sdi12_address", "thermistor_depth", "alpha", "beta", "time_to_max_temp_downstream_s",
    )


@query(
    "drop_copies",
    """SELECT logger_id, record, sdi12_address, thermistor_depth, file_hash, alpha FROM (
         SELECT *, row_number() OVER (PARTITION BY logger_id, record, sdi12_address, thermistor_depth
                                      ORDER BY file_hash) AS rn FROM obs) x WHERE rn = 1""",
)
def _drop_copies(t: Tables) -> DataFrame:
    return flatten.drop_copies(t["obs"]).select(
        "logger_id", "record", "sdi12_address", "thermistor_depth", "file_hash", "alpha"
    )


@query(
    "canonical_columns",
    """SELECT logger_id, record, timestamp, CAST(NULL AS DOUBLE) AS panel_temperature_c, alpha,
         CAST(NULL AS DOUBLE) AS post_pulse_temp_upstream_c FROM obs""",
)
def _canonical_columns(t: Tables) -> DataFrame:
    stacked = flatten.stack(
        t["obs"].where(F.col("file_hash") == "fileA"), t["obs"].where(F.col("file_hash") == "fileB")
    )
    return flatten.to_canonical(stacked).select(
        "logger_id", "record", "timestamp", "panel_temperature_c", "alpha", "post_pulse_temp_upstream_c"
    )


# --- Time ---------------------------------------------------------------------------------


@query("record_dedup", P.REC)
def _record_dedup(t: Tables) -> DataFrame:
    return timestamps.record_map(t["obs"])


@query("chunk_anchors", f"WITH rec AS ({P.REC}) {P.CHUNK}")
def _chunk_anchors(t: Tables) -> DataFrame:
    return timestamps.chunk_anchors(timestamps.record_map(t["obs"]))


def _local(t: Tables) -> DataFrame:
    return timestamps.local_deployments(t["dep"], t["site"])


def _offsets(t: Tables) -> DataFrame:
    anchors = timestamps.chunk_anchors(timestamps.record_map(t["obs"]))
    return timestamps.chunk_offsets(anchors, t["site"], _local(t))


@query("chunk_offsets", f"{P.TIME_CTES} SELECT * FROM offsets")
def _chunk_offsets(t: Tables) -> DataFrame:
    return _offsets(t)


@query("correct_timestamps", f"{P.TIME_CTES} {P.CORRECTED}")
def _correct_timestamps(t: Tables) -> DataFrame:
    return timestamps.correct_timestamps(t["obs"], t["site"], _local(t)).observations


@query(
    "skipped_chunks",
    f"""{P.TIME_CTES} SELECT logger_id, file_set_signature,
          strftime(anchor_timestamp, '%Y-%m-%d %H:%M:%S') AS anchor_timestamp_local, row_count,
          'no_active_deployment' AS reason FROM offsets WHERE utc_offset_seconds IS NULL""",
)
def _skipped_chunks(t: Tables) -> DataFrame:
    return timestamps.skipped_chunks(_offsets(t))


@query(
    "local_time_offsets",
    """SELECT o.record, o.logger_id, s.timezone, s.january_offset AS utc_offset_seconds,
         o.timestamp + to_seconds(s.january_offset) AS shown_local
       FROM obs o JOIN site s ON CAST(o.record % 5 AS VARCHAR) = s.site_id""",
)
def _local_time_offsets(t: Tables) -> DataFrame:
    zoned = t.sql(
        "SELECT o.record, o.logger_id, o.timestamp, s.timezone FROM obs o "
        "JOIN site s ON CAST(o.record % 5 AS STRING) = s.site_id"
    )
    return zoned.select(
        "record", "logger_id", "timezone",
        local_to_utc_offset(F.col("timezone"), F.col("timestamp")).alias("utc_offset_seconds"),
        utc_to_local(F.col("timezone"), F.col("timestamp")).alias("shown_local"),
    )


# --- Enrichment ---------------------------------------------------------------------------

DIMENSIONS = ["logger", "stem", "plant", "plot", "zone", "site", "species", "project"]


@query(
    "deployment_context",
    """SELECT d.deployment_id, l.code AS datalogger_id, d.sdi_address, d.project_id, z.site_id, z.zone_id, l2.plot_id,
         p.plant_id, sp.species_id, d.stem_id, pr.code AS project_code, pr.name AS project_name, s.code AS site_code,
         s.name AS site_name, z.name AS zone_name, l2.name AS plot_name, p.code AS plant_code, st.code AS stem_code,
         sp.code AS species_code, CONCAT('Genus ', lower(sp.code)) AS species_scientific_name,
         d.start_timestamp_utc AS deployment_start_timestamp_utc, d.end_timestamp_utc AS deployment_end_timestamp_utc,
         s.timezone
       FROM dim_deployment d JOIN dim_logger l USING (datalogger_id) JOIN dim_stem st ON st.stem_id = d.stem_id
       JOIN dim_plant p ON p.plant_id = st.plant_id JOIN dim_plot l2 ON l2.plot_id = p.plot_id
       JOIN dim_zone z ON z.zone_id = l2.zone_id JOIN dim_site s ON s.site_id = z.site_id
       JOIN dim_species sp ON sp.species_id = p.species_id JOIN dim_project pr ON pr.project_id = d.project_id
       WHERE d.include_in_pipeline""",
)
def _deployment_context(t: Tables) -> DataFrame:
    dims = [t[f"dim_{name}"] for name in DIMENSIONS]
    return enrich.deployment_context(t["dim_deployment"], *dims).drop("installation_metadata")


@query(
    "alias_codes",
    """SELECT a.alias, l.code AS datalogger_id, a.start_timestamp_utc, a.end_timestamp_utc
       FROM dim_alias a JOIN dim_logger l ON l.datalogger_id = a.datalogger_id""",
)
def _alias_codes(t: Tables) -> DataFrame:
    return enrich.alias_context(t["dim_alias"], t["dim_logger"])


@query(
    "override_codes",
    """SELECT p.code, o.seq, o.value, o.site_id
       FROM dim_override o JOIN dim_parameter p ON p.parameter_id = o.parameter_id""",
)
def _override_codes(t: Tables) -> DataFrame:
    return enrich.override_context(t["dim_override"], t["dim_parameter"])


@query(
    "temporal_enrichment",
    f"""SELECT o.logger_id, o.record, o.file_hash, o.timestamp_utc, {', '.join('x.' + c for c in CONTEXT_COLUMNS)}
        FROM obs_utc o LEFT JOIN ctx x ON o.logger_id = x.datalogger_id AND o.sdi12_address = x.sdi_address
          AND o.timestamp_utc >= x.deployment_start_timestamp_utc
          AND (x.deployment_end_timestamp_utc IS NULL OR o.timestamp_utc < x.deployment_end_timestamp_utc)""",
)
def _temporal_enrichment(t: Tables) -> DataFrame:
    obs = t["obs_utc"].select("logger_id", "record", "file_hash", "sdi12_address", "timestamp_utc")
    return enrich.enrich_with_metadata(obs, t["ctx"], payload=CONTEXT_COLUMNS).drop("sdi12_address")


@query(
    "alias_fallback",
    """WITH direct AS (
         SELECT o.*, x.deployment_id AS direct_id FROM obs_alias o LEFT JOIN ctx x
           ON o.logger_id = x.datalogger_id AND o.sdi12_address = x.sdi_address
           AND o.timestamp_utc >= x.deployment_start_timestamp_utc
           AND (x.deployment_end_timestamp_utc IS NULL OR o.timestamp_utc < x.deployment_end_timestamp_utc)),
       renamed AS (
         SELECT d.*, coalesce(d.direct_id, x.deployment_id) AS deployment_id FROM direct d
         LEFT JOIN alias a ON d.direct_id IS NULL AND d.logger_id = a.alias AND d.timestamp_utc >= a.start_timestamp_utc
           AND (a.end_timestamp_utc IS NULL OR d.timestamp_utc < a.end_timestamp_utc)
         LEFT JOIN ctx x ON a.datalogger_id = x.datalogger_id AND d.sdi12_address = x.sdi_address
           AND d.timestamp_utc >= x.deployment_start_timestamp_utc
           AND (x.deployment_end_timestamp_utc IS NULL OR d.timestamp_utc < x.deployment_end_timestamp_utc))
       SELECT r.logger_id, r.record, r.file_hash, r.deployment_id, c.datalogger_id, c.plant_code
       FROM renamed r LEFT JOIN ctx c ON r.deployment_id = c.deployment_id""",
)
def _alias_fallback(t: Tables) -> DataFrame:
    payload = ["deployment_id", "datalogger_id", "plant_code"]
    return enrich.enrich_with_metadata(t["obs_alias"], t["ctx"], t["alias"], payload).select(
        "logger_id", "record", "file_hash", *payload
    )


@query(
    "ambiguous_matches",
    """WITH wide AS (SELECT datalogger_id, sdi_address, deployment_start_timestamp_utc AS s,
           CASE WHEN n % 2 = 0 THEN deployment_end_timestamp_utc + INTERVAL 30 DAY ELSE deployment_end_timestamp_utc END AS e,
           deployment_id FROM dep
         UNION ALL SELECT datalogger_id, sdi_address, TIMESTAMP '2024-01-20 00:00:00', TIMESTAMP '2024-01-21 00:00:00',
           CONCAT(deployment_id, 'x') FROM dep WHERE phase_zero AND n % 4 = 0),
       points AS (SELECT DISTINCT logger_id, sdi12_address, timestamp_utc FROM obs_utc)
       SELECT 'deployment' AS kind, p.logger_id, p.sdi12_address, p.timestamp_utc, count(*) AS matches
       FROM points p JOIN wide w ON p.logger_id = w.datalogger_id AND p.sdi12_address = w.sdi_address
         AND p.timestamp_utc >= w.s AND (w.e IS NULL OR p.timestamp_utc < w.e)
       GROUP BY 1, 2, 3, 4 HAVING count(*) > 1""".replace("phase_zero", "deployment_id LIKE '%-0'"),
)
def _ambiguous_matches(t: Tables) -> DataFrame:
    wide = t.sql("""
        SELECT datalogger_id, sdi_address, deployment_id, deployment_start_timestamp_utc,
          CASE WHEN n % 2 = 0 THEN deployment_end_timestamp_utc + INTERVAL '30' DAY
               ELSE deployment_end_timestamp_utc END AS deployment_end_timestamp_utc FROM dep
        UNION ALL
        SELECT datalogger_id, sdi_address, CONCAT(deployment_id, 'x'), TIMESTAMP '2024-01-20 00:00:00',
          TIMESTAMP '2024-01-21 00:00:00' FROM dep WHERE deployment_id LIKE '%-0' AND n % 4 = 0""")
    return enrich.ambiguous_matches(t["obs_utc"], wide)


@query(
    "metadata_key_expansion",
    """SELECT deployment_id, installation_metadata ->> '$.height_cm' AS height_cm,
         installation_metadata ->> '$.notes' AS notes, installation_metadata ->> '$.paint' AS paint,
         installation_metadata ->> '$.tags' AS tags FROM dim_deployment""",
)
def _metadata_key_expansion(t: Tables) -> DataFrame:
    deployments = t["dim_deployment"].select("deployment_id", "installation_metadata")
    return enrich.expand_metadata(deployments)


LATIN_SQL = """
    SELECT c_custkey, CASE c_custkey % 9
      WHEN 0 THEN CONCAT('"  gEnus   ', c_mktsegment, ' "') WHEN 1 THEN CONCAT('{"binomial": " ", "name": "abies ', c_mktsegment, '"}')
      WHEN 2 THEN CONCAT('{"genus": "QUERCUS", "species": "', c_mktsegment, '", "subspecies": "Minor"}')
      WHEN 3 THEN CONCAT('{"z": "last", "b": 7, "c": "first ', c_mktsegment, '"}')
      WHEN 4 THEN CONCAT('[3, "", {"text": "pinus ', c_mktsegment, '"}, "later"]') WHEN 5 THEN '42'
      WHEN 6 THEN '"   "' WHEN 7 THEN '{"genus": "Acer", "species": 5}' ELSE NULL END AS latin FROM customer"""


@query(
    "scientific_name",
    f"""SELECT c.c_custkey, CASE c.c_custkey % 9
          WHEN 0 THEN CONCAT('Genus ', lower(c_mktsegment)) WHEN 1 THEN CONCAT('Abies ', lower(c_mktsegment))
          WHEN 2 THEN CONCAT('Quercus ', lower(c_mktsegment), ' minor') WHEN 3 THEN CONCAT('First ', lower(c_mktsegment))
          WHEN 4 THEN CONCAT('Pinus ', lower(c_mktsegment)) WHEN 7 THEN 'Acer' END AS scientific_name
        FROM customer c JOIN ({LATIN_SQL}) l ON l.c_custkey = c.c_custkey""",
)
def _scientific_name(t: Tables) -> DataFrame:
    return t.sql(LATIN_SQL).select("c_custkey", X.scientific_name(F.col("latin")).alias("scientific_name"))


# --- Parameters ---------------------------------------------------------------------------

OVERRIDDEN = {
    "parameter_wood_density_kg_m3": 500.0,
    "parameter_wound_correction_a": 1.8905,
    "parameter_water_content_g_g": 1.0,
    "quality_max_flux_cm_hr": 40.0,
    "quality_gap_years": 2.0,
}


@query(
    "override_resolution",
    f"""WITH picks AS ({P.PICKS}),
        e AS (SELECT o.logger_id, o.record, o.file_hash, coalesce(x.deployment_id, '') AS dep_key FROM obs_utc o
          LEFT JOIN ctx x ON o.logger_id = x.datalogger_id AND o.sdi12_address = x.sdi_address
            AND o.timestamp_utc >= x.deployment_start_timestamp_utc
            AND (x.deployment_end_timestamp_utc IS NULL OR o.timestamp_utc < x.deployment_end_timestamp_utc))
        SELECT e.logger_id, e.record, e.file_hash,
          {', '.join(P.picked(code, default, f'p{i}') for i, (code, default) in enumerate(OVERRIDDEN.items()))}
        FROM e {' '.join(f"LEFT JOIN picks p{i} ON p{i}.dep_key = e.dep_key AND p{i}.code = '{code}'" for i, code in enumerate(OVERRIDDEN))}""",
)
def _override_resolution(t: Tables) -> DataFrame:
    obs = t["obs_utc"].select("logger_id", "record", "file_hash", "sdi12_address", "timestamp_utc")
    matched = enrich.enrich_with_metadata(obs, t["ctx"], payload=parameters.SCOPE_COLUMNS)
    definitions = [p for p in PARAMETERS if p.code in OVERRIDDEN]
    resolved = parameters.resolve_parameters(matched, t["ovr"], definitions)
    return resolved.select("logger_id", "record", "file_hash", *parameters.parameter_columns(definitions))


@query(
    "json_value_kinds",
    """SELECT k, as_double, as_bigint, as_text, as_flag FROM (
         SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 4 THEN NULL WHEN o_orderkey % 5 = 3 THEN NULL
             ELSE CAST(o_orderkey AS DOUBLE) / CASE WHEN o_orderkey % 5 = 1 THEN 4 ELSE 1 END END AS as_double,
           CASE WHEN o_orderkey % 5 IN (0, 2) THEN o_orderkey END AS as_bigint,
           CASE WHEN o_orderkey % 5 = 3 THEN 'true' WHEN o_orderkey % 5 = 4 THEN 'TRUE'
                WHEN o_orderkey % 5 = 1 THEN CAST(CAST(o_orderkey AS DOUBLE) / 4 AS VARCHAR)
                ELSE CAST(o_orderkey AS VARCHAR) END AS as_text,
           CASE WHEN o_orderkey % 5 IN (3, 4) THEN TRUE END AS as_flag
         FROM orders) x""",
)
def _json_value_kinds(t: Tables) -> DataFrame:
    source = t.sql("""
        SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN CAST(o_orderkey AS STRING)
            WHEN 1 THEN CAST(CAST(o_orderkey AS DOUBLE) / 4 AS STRING) WHEN 2 THEN CONCAT('"', CAST(o_orderkey AS STRING), '"')
            WHEN 3 THEN 'true' ELSE '"TRUE"' END AS value FROM orders""")
    value = F.col("value")
    return source.select(
        "k",
        V.json_to_kind(value, "float").alias("as_double"),
        V.json_to_kind(value, "integer").alias("as_bigint"),
        V.json_to_kind(value, "string").alias("as_text"),
        V.json_to_kind(value, "boolean").alias("as_flag"),
    )


# --- Flux and quality ---------------------------------------------------------------------

FLUX_NUMBERS = [
    "vh_hrm_cm_hr",
    "vh_tmax_cm_hr",
    "vc_hrm_cm_hr",
    "vc_tmax_cm_hr",
    "j_hrm_cm_hr",
    "j_tmax_cm_hr",
    "sap_flux_density_j_dma_cm_hr",
]


@query(
    "dma_peclet",
    f"""WITH src AS (SELECT o.*, CAST(500.0 AS DOUBLE) AS density, CAST(1.8905 AS DOUBLE) AS wound,
          CAST(1.0 AS DOUBLE) AS content FROM obs o)
        SELECT logger_id, record, file_hash, calculation_method_used, {six_sql(*FLUX_NUMBERS)}
        FROM ({P.dma('src', 'density', 'wound', 'content')}) f""",
)
def _dma_peclet(t: Tables) -> DataFrame:
    flux = dma.apply_dma_peclet(parameters.with_defaults(t["obs"]))
    return flux.select(
        "logger_id", "record", "file_hash", "calculation_method_used", *[six(c) for c in FLUX_NUMBERS]
    )


@query(
    "record_gap",
    f"""SELECT logger_id, record, sdi12_address, thermistor_depth, file_hash, {P.gap()} AS record_gap FROM graded""",
)
def _record_gap(t: Tables) -> DataFrame:
    return quality.record_gap(t["graded"]).select(
        "logger_id", "record", "sdi12_address", "thermistor_depth", "file_hash", "record_gap"
    )


@query(
    "earliest_deployment",
    """SELECT logger_id, sdi12_address, min(deployment_start_timestamp_utc) AS first_start FROM graded
       WHERE deployment_start_timestamp_utc IS NOT NULL GROUP BY logger_id, sdi12_address""",
)
def _earliest_deployment(t: Tables) -> DataFrame:
    return quality.earliest_deployments(t["graded"]).withColumnRenamed("_first_start", "first_start")


@query(
    "quality_rules",
    f"""SELECT logger_id, record, sdi12_address, thermistor_depth, file_hash, quality, quality_explanation
        FROM ({P.quality('graded')}) q""",
)
def _quality_rules(t: Tables) -> DataFrame:
    return quality.apply_quality_filters(t["graded"], NOW).select(
        "logger_id", "record", "sdi12_address", "thermistor_depth", "file_hash", "quality", "quality_explanation"
    )


# --- Whole run ----------------------------------------------------------------------------

RUN_COLUMNS = [
    "logger_id",
    "record",
    "sdi12_address",
    "thermistor_depth",
    "file_hash",
    "file_set_signature",
    "timestamp_utc",
    "deployment_id",
    "site_id",
    "stem_code",
    "species_scientific_name",
    "parameter_wood_density_kg_m3",
    "parameter_source_parameter_wood_density_kg_m3",
    "quality_max_flux_cm_hr",
    "parameter_source_quality_max_flux_cm_hr",
    "calculation_method_used",
    "quality",
    "quality_explanation",
]
RUN_NUMBERS = ["vh_hrm_cm_hr", "vh_tmax_cm_hr", "sap_flux_density_j_dma_cm_hr"]


def run_context(t: Tables) -> processing.Context:
    return processing.Context(
        t["site"].select("site_id", "timezone"), t["ctx"].drop("january_offset"), t["ovr"], t["alias"]
    )


def _finished(t: Tables, matched_only: bool) -> DataFrame:
    return processing.run_batch(t["obs"], run_context(t), NOW, matched_only).observations


@query(
    "end_to_end_flux",
    f"{P.FINISHED} SELECT {', '.join(RUN_COLUMNS)}, {six_sql(*RUN_NUMBERS)} FROM finished",
)
def end_to_end_flux(t: Tables) -> DataFrame:
    return _finished(t, False).select(*RUN_COLUMNS, *[six(c) for c in RUN_NUMBERS])


@query(
    "published_run",
    f"{P.FINISHED} SELECT {', '.join(RUN_COLUMNS)} FROM finished WHERE deployment_id IS NOT NULL",
)
def _published_run(t: Tables) -> DataFrame:
    return _finished(t, True).select(*RUN_COLUMNS)


@query(
    "run_report",
    f"""{P.FINISHED}, kept AS (SELECT * FROM finished WHERE deployment_id IS NOT NULL)
        SELECT total_rows, suspect_rows, total_rows - suspect_rows AS good_rows,
          round(suspect_rows / total_rows, 6) AS suspect_ratio, logger_count, sensor_count,
          excluded_rows_no_deployment, skipped_chunk_count, skipped_record_count
        FROM (SELECT count(*) AS total_rows, count(*) FILTER (quality = 'SUSPECT') AS suspect_rows,
                count(DISTINCT logger_id) AS logger_count,
                count(DISTINCT (logger_id, sdi12_address, thermistor_depth)) AS sensor_count FROM kept) k,
          (SELECT count(*) AS excluded_rows_no_deployment FROM finished WHERE deployment_id IS NULL) x,
          (SELECT count(*) AS skipped_chunk_count, CAST(sum(row_count) AS BIGINT) AS skipped_record_count
             FROM offsets WHERE utc_offset_seconds IS NULL) s""",
)
def _run_report(t: Tables) -> DataFrame:
    context = run_context(t)
    result = processing.run_batch(t["obs"], context, NOW, matched_only=True)
    finished = tables.stage(result.observations, "run-report")
    report = transaction.run_summary(finished, result.skipped_chunks, result.excluded_rows(finished))
    return report.select(
        "total_rows", "suspect_rows", "good_rows", six("suspect_ratio"), "logger_count", "sensor_count",
        "excluded_rows_no_deployment", "skipped_chunk_count", "skipped_record_count",
    )


# --- Summaries ----------------------------------------------------------------------------


@query(
    "excluded_rows",
    "SELECT count(*) AS excluded_rows_no_deployment FROM fin WHERE deployment_id IS NULL",
)
def _excluded_rows(t: Tables) -> DataFrame:
    return summaries.split_by_deployment(t["fin"])[1]


@query("kept_rows", "SELECT logger_id, record, file_hash, deployment_id FROM fin WHERE deployment_id IS NOT NULL")
def _kept_rows(t: Tables) -> DataFrame:
    kept, _ = summaries.split_by_deployment(t["fin"])
    return kept.select("logger_id", "record", "file_hash", "deployment_id")


@query(
    "quality_summary",
    """SELECT count(*) AS total_rows, count(*) FILTER (quality = 'SUSPECT') AS suspect_rows,
         count(*) FILTER (quality IS NULL) AS good_rows,
         round(count(*) FILTER (quality = 'SUSPECT') / count(*), 6) AS suspect_ratio FROM fin""",
)
def _quality_summary(t: Tables) -> DataFrame:
    return summaries.quality_summary(t["fin"]).withColumn("suspect_ratio", six("suspect_ratio"))


@query(
    "top_quality_reasons",
    """SELECT reason, count(*) AS count FROM (
         SELECT unnest(string_split(quality_explanation, '|')) AS reason FROM fin WHERE quality_explanation IS NOT NULL) r
       WHERE reason <> '' GROUP BY reason ORDER BY count(*) DESC, reason LIMIT 5""",
)
def _top_quality_reasons(t: Tables) -> DataFrame:
    return summaries.top_quality_reasons(t["fin"])


@query(
    "provenance_summary",
    """WITH long AS (
         SELECT 'parameter_wood_density_kg_m3' AS parameter, parameter_source_parameter_wood_density_kg_m3 AS source FROM fin
         UNION ALL SELECT 'parameter_water_content_g_g', parameter_source_parameter_water_content_g_g FROM fin
         UNION ALL SELECT 'quality_gap_years', parameter_source_quality_gap_years FROM fin
         UNION ALL SELECT 'quality_max_flux_cm_hr', parameter_source_quality_max_flux_cm_hr FROM fin),
       counted AS (SELECT parameter, source, count(*) AS count FROM long
         WHERE source IS NOT NULL AND source <> '' AND source NOT LIKE '%default%' GROUP BY parameter, source),
       firsts AS (SELECT *, row_number() OVER (PARTITION BY parameter ORDER BY count DESC, source) AS rn FROM counted)
       SELECT parameter, source, count FROM firsts WHERE rn = 1 ORDER BY count DESC, parameter LIMIT 3""",
)
def _provenance_summary(t: Tables) -> DataFrame:
    return summaries.provenance_summary(t["fin"])


@query(
    "record_summary",
    """SELECT count(DISTINCT logger_id) AS logger_count,
         count(DISTINCT (logger_id, sdi12_address, thermistor_depth))
           FILTER (logger_id IS NOT NULL AND sdi12_address IS NOT NULL AND thermistor_depth IS NOT NULL) AS sensor_count,
         strftime(min(timestamp_utc), '%Y-%m-%dT%H:%M:%S.%fZ') AS timeframe_start,
         strftime(max(timestamp_utc), '%Y-%m-%dT%H:%M:%S.%fZ') AS timeframe_end FROM fin""",
)
def _record_summary(t: Tables) -> DataFrame:
    return summaries.record_summary(t["fin"])


# --- Manifest -----------------------------------------------------------------------------

PLANT_KEY = "CONCAT(site_code, '/', zone_name, '/', plot_name, '/', code)"


def _plant_manifest(t: Tables):
    adds = {"plants": t["add_plant"]}
    existing = {"plants": t["old_plant"], "plots": t["old_plot"], "species": t["old_species"]}
    return adds, existing


@query(
    "manifest_missing_parents",
    f"""SELECT 'plants' AS entity, {PLANT_KEY} AS key, 'missing plots' AS violation FROM add_plant a
        WHERE NOT EXISTS (SELECT 1 FROM old_plot p WHERE p.site_code = a.site_code AND p.zone_name = a.zone_name
                          AND p.name = a.plot_name)
        UNION ALL
        SELECT 'plants', {PLANT_KEY}, 'missing species' FROM add_plant a
        WHERE NOT EXISTS (SELECT 1 FROM old_species s WHERE s.code = a.species_code)""",
)
def _manifest_missing_parents(t: Tables) -> DataFrame:
    return manifest.missing_parents("plants", *_plant_manifest(t))


@query(
    "manifest_duplicates",
    f"""WITH everything AS (SELECT site_code, zone_name, plot_name, code, 1 AS is_new FROM add_plant
          UNION ALL SELECT site_code, zone_name, plot_name, code, 0 FROM old_plant)
        SELECT 'plants' AS entity, {PLANT_KEY} AS key, 'already exists' AS violation FROM everything
        GROUP BY site_code, zone_name, plot_name, code HAVING count(*) > 1 AND max(is_new) = 1""",
)
def _manifest_duplicates(t: Tables) -> DataFrame:
    return manifest.duplicates("plants", *_plant_manifest(t))


@query(
    "manifest_shapes",
    f"""SELECT 'plants' AS entity, {PLANT_KEY} AS key, 'location is not a Point' AS violation FROM add_plant
        WHERE location LIKE '%Polygon%' OR location = '{{"type": "Point"}}'""",
)
def _manifest_shapes(t: Tables) -> DataFrame:
    return manifest.scalar_faults("plants", {"plants": t["add_plant"]})


@query(
    "manifest_row_checks",
    """SELECT 'deployments' AS entity, CONCAT(datalogger_code, '/', sdi_address) AS key, 'end not after start' AS violation
       FROM add_deployment WHERE end_timestamp_utc <= start_timestamp_utc
       UNION ALL
       SELECT 'deployments', CONCAT(datalogger_code, '/', sdi_address), 'invalid SDI-12 address'
       FROM add_deployment WHERE sdi_address IN ('12', '-')
       UNION ALL
       SELECT 'parameter_overrides', parameter_code, 'stem without plant'
       FROM add_override WHERE stem_code IS NOT NULL AND plant_code IS NULL""",
)
def _manifest_row_checks(t: Tables) -> DataFrame:
    adds = {"deployments": t["add_deployment"], "parameter_overrides": t["add_override"]}
    first = manifest.scalar_faults("deployments", adds)
    return first.unionByName(manifest.scalar_faults("parameter_overrides", adds))


@query(
    "interval_overlap",
    """WITH d AS (SELECT *, coalesce(end_timestamp_utc, TIMESTAMP '9999-12-31 00:00:00') AS e FROM add_deployment)
       SELECT a.datalogger_code, a.sdi_address, a.start_timestamp_utc, a.end_timestamp_utc FROM d a
       WHERE EXISTS (SELECT 1 FROM d b WHERE b.datalogger_code = a.datalogger_code AND b.sdi_address = a.sdi_address
         AND (b.start_timestamp_utc < a.start_timestamp_utc
              OR (b.start_timestamp_utc = a.start_timestamp_utc AND (b.e < a.e OR (b.e = a.e AND b.o_orderkey < a.o_orderkey))))
         AND b.e >= a.start_timestamp_utc)""",
)
def _interval_overlap(t: Tables) -> DataFrame:
    return manifest.overlapping_intervals(
        t["add_deployment"].drop("o_orderkey"), ["datalogger_code", "sdi_address"]
    )


@query(
    "ambiguous_names",
    """SELECT 'parameter_overrides' AS entity, parameter_code AS key, 'ambiguous zones' AS violation FROM add_override
       WHERE zone_name IN (SELECT name FROM old_zone GROUP BY name HAVING count(*) > 1)
       UNION ALL
       SELECT 'parameter_overrides', parameter_code, 'ambiguous plants' FROM add_override
       WHERE plant_code IN (SELECT code FROM (SELECT DISTINCT site_code, zone_name, plot_name, code FROM
         (SELECT site_code, zone_name, plot_name, code FROM old_plant
          UNION ALL SELECT site_code, zone_name, plot_name, code FROM add_plant) u) v GROUP BY code HAVING count(*) > 1)""",
)
def _ambiguous_names(t: Tables) -> DataFrame:
    adds = {"parameter_overrides": t["add_override"], "plants": t["add_plant"]}
    existing = {"zones": t["old_zone"], "plants": t["old_plant"]}
    return manifest.ambiguous_names("parameter_overrides", adds, existing)


@query(
    "override_upsert",
    """SELECT parameter_code, site_id, stem_id, value, transaction_seq FROM (
         SELECT *, row_number() OVER (PARTITION BY parameter_code, site_id, stem_id ORDER BY transaction_seq DESC) AS rn
         FROM (SELECT o_orderpriority AS parameter_code,
                 CASE WHEN o_custkey % 3 <> 0 THEN CAST(o_custkey % 50 AS VARCHAR) END AS site_id,
                 CASE WHEN o_custkey % 4 = 0 THEN 'S1' END AS stem_id, o_orderstatus AS value,
                 o_orderkey AS transaction_seq FROM orders) o) x WHERE rn = 1""",
)
def _override_upsert(t: Tables) -> DataFrame:
    rows = t.sql("""
        SELECT o_orderpriority AS parameter_code, CASE WHEN o_custkey % 3 <> 0 THEN CAST(o_custkey % 50 AS STRING) END AS site_id,
          CASE WHEN o_custkey % 4 = 0 THEN 'S1' END AS stem_id, o_orderstatus AS value, o_orderkey AS transaction_seq
        FROM orders""")
    old = rows.where(F.col("transaction_seq") % 2 == 0)
    new = rows.where(F.col("transaction_seq") % 2 == 1)
    return manifest.upsert_overrides(old, new, ["parameter_code", "site_id", "stem_id"])


@query(
    "metadata_summary",
    """SELECT e.entity, coalesce(c.count, 0) AS count FROM (SELECT unnest(['projects', 'sites', 'zones', 'plots', 'species',
         'plants', 'stems', 'datalogger_types', 'dataloggers', 'datalogger_aliases', 'sensor_types',
         'sensor_thermistor_pairs', 'deployments', 'parameter_overrides']) AS entity) e
       LEFT JOIN (SELECT 'plants' AS entity, count(*) AS count FROM add_plant
         UNION ALL SELECT 'deployments', count(*) FROM add_deployment
         UNION ALL SELECT 'parameter_overrides', count(*) FROM add_override) c ON e.entity = c.entity""",
)
def _metadata_summary(t: Tables) -> DataFrame:
    return manifest.metadata_summary(
        {
            "plants": t["add_plant"],
            "deployments": t["add_deployment"],
            "parameter_overrides": t["add_override"],
        }
    )


@query("manifest_violations", P.MANIFEST_SQL)
def _manifest_violations(t: Tables) -> DataFrame:
    adds = {entity: t[f"m_{entity}"] for entity in manifest.ENTITIES}
    existing = {"projects": t["old_projects"], "parameters": t["old_parameters"], "deployments": t["old_deployments"]}
    found = manifest.validate_manifest(adds, existing)
    return found.groupBy("entity", "key", "violation").agg(F.count(F.lit(1)).alias("n"))


@query(
    "manifest_ids",
    """SELECT a.code, a.plot_name, sha256(CONCAT('plants', chr(31), site_code, chr(31), zone_name, chr(31), plot_name,
         chr(31), code)) AS id, s.id AS species_id
       FROM add_plant a LEFT JOIN (SELECT code AS species_code, CONCAT('old-', code) AS id FROM old_species) s
         USING (species_code)""",
)
def _manifest_ids(t: Tables) -> DataFrame:
    existing = {"species": t.sql("SELECT code, CONCAT('old-', code) AS id FROM old_species")}
    rows = manifest.with_ids("plants", {"plants": t["add_plant"]}, existing)
    return rows.select("code", "plot_name", "id", "species_id")


# --- Storage ------------------------------------------------------------------------------


@query(
    "orphaned_keys",
    """WITH referenced AS (SELECT CONCAT('raw-files/', file_hash) AS k FROM raw_row
         UNION ALL SELECT object_store_path FROM output_row WHERE object_store_path IS NOT NULL
         UNION ALL SELECT reproducibility_cartridge_path FROM output_row WHERE reproducibility_cartridge_path IS NOT NULL)
       SELECT CASE WHEN object_key LIKE 'raw-files/%' THEN 'raw-files/' WHEN object_key LIKE 'outputs/%' THEN 'outputs/'
           ELSE 'repro-cartridges/' END AS prefix, object_key
       FROM stored_object WHERE object_key NOT LIKE 'tmp/%' AND object_key NOT IN (SELECT k FROM referenced)""",
)
def _orphaned_keys(t: Tables) -> DataFrame:
    return storage.orphaned_keys(t["stored_object"], t["raw_row"], t["output_row"])


# --- Read path ----------------------------------------------------------------------------

SELECTION = explore.Selection(
    stem={"stem_code": "S1", "sdi12_address": "1"},
    depths=["inner", None],
    start=datetime(2024, 1, 5),
    end=datetime(2024, 1, 25),
    include_suspect=False,
)
SELECTION_SQL = """stem_code = 'S1' AND sdi12_address = '1' AND (thermistor_depth IN ('inner') OR thermistor_depth IS NULL)
    AND timestamp >= TIMESTAMP '2024-01-05 00:00:00' AND timestamp <= TIMESTAMP '2024-01-25 00:00:00' AND quality IS NULL"""


@query("explorer_filter", f"SELECT {', '.join(explore.PLOT_COLUMNS)} FROM fin WHERE {SELECTION_SQL}")
def _explorer_filter(t: Tables) -> DataFrame:
    return explore.projected(explore.filtered(t["fin"], SELECTION))


@query(
    "explorer_stats",
    """SELECT count(*) AS total_rows, count(quality) AS suspect_rows, min(timestamp) AS min_timestamp,
         max(timestamp) AS max_timestamp FROM fin WHERE stem_code = 'S1' AND sdi12_address = '1'""",
)
def _explorer_stats(t: Tables) -> DataFrame:
    chosen = explore.filtered(t["fin"], explore.Selection(stem={"stem_code": "S1", "sdi12_address": "1"}))
    return explore.statistics(chosen)


@query(
    "explorer_downsample",
    f"""WITH numbered AS (SELECT *, row_number() OVER (ORDER BY {', '.join(c + ' NULLS FIRST' for c in explore.FILE_ORDER)}) - 1 AS row_nr,
          count(*) OVER () AS total FROM fin)
        SELECT logger_id, record, file_hash, row_nr FROM numbered WHERE row_nr % CAST(ceil(total / 1000.0) AS BIGINT) = 0""",
)
def _explorer_downsample(t: Tables) -> DataFrame:
    narrow = t["fin"].select(*explore.FILE_ORDER)
    return explore.downsampled(narrow, 1000).select("logger_id", "record", "file_hash", "row_nr")


@query(
    "explorer_points",
    f"""WITH chosen AS (SELECT * FROM fin WHERE sdi12_address = '1' AND timestamp >= TIMESTAMP '2024-01-05 00:00:00'),
        numbered AS (SELECT *, row_number() OVER (ORDER BY {', '.join(c + ' NULLS FIRST' for c in explore.FILE_ORDER)}) - 1 AS row_nr,
          count(*) OVER () AS total FROM chosen)
        SELECT {', '.join(explore.PLOT_COLUMNS)} FROM numbered
        WHERE total <= 50 OR row_nr % CAST(ceil(total / 50.0) AS BIGINT) = 0""",
)
def _explorer_points(t: Tables) -> DataFrame:
    chosen = explore.Selection(stem={"sdi12_address": "1"}, start=datetime(2024, 1, 5))
    return explore.explore(t["fin"], chosen, 50).points


@query(
    "depth_options",
    """SELECT DISTINCT coalesce(thermistor_depth, 'Unknown depth') AS label, thermistor_depth AS value FROM fin""",
)
def _depth_options(t: Tables) -> DataFrame:
    return explore.depth_options(t["fin"])


@query("dataset_rows", "SELECT count(*) AS total_rows FROM fin")
def _dataset_rows(t: Tables) -> DataFrame:
    return explore.statistics(t["fin"]).select("total_rows")


@query(
    "stem_options",
    """SELECT deployment_id, plant_code, CONCAT(
         CASE WHEN project_code IS NULL THEN coalesce(project_name, 'Project ?')
              ELSE CONCAT(coalesce(project_name, 'Project ?'), ' (', project_code, ')') END,
         ' | ', coalesce(species_scientific_name, 'Species ?'), ' | Site ', coalesce(site_name, 'Site ?'),
         ' | Zone ', coalesce(zone_name, '?'), ' | Plot ', coalesce(plot_name, '?'), ' | SDI ', sdi12_address,
         ' | Plant ', coalesce(plant_code, '?'), ' | Stem ', coalesce(stem_code, '?'), ' | Dep ',
         substring(coalesce(deployment_id, '?'), 1, 6)) AS label
       FROM (SELECT DISTINCT project_name, project_code, site_name, zone_name, plot_name, sdi12_address, plant_code,
               species_scientific_name, stem_code, deployment_id FROM fin) s""",
)
def _stem_options(t: Tables) -> DataFrame:
    return explore.stem_options(t["fin"]).select("deployment_id", "plant_code", "label")


@query(
    "chunk_boundaries",
    """SELECT deployment_id, timestamp AS boundary FROM (
         SELECT *, lag(file_set_signature) OVER w AS previous, row_number() OVER w AS rn
         FROM (SELECT DISTINCT deployment_id, timestamp, record, file_set_signature FROM fin) p
         WINDOW w AS (PARTITION BY deployment_id ORDER BY timestamp, record)) x
       WHERE rn > 1 AND file_set_signature IS DISTINCT FROM previous""",
)
def _chunk_boundaries(t: Tables) -> DataFrame:
    return explore.chunk_boundaries(t["fin"])


@query(
    "qc_panels",
    """SELECT deployment_id, plant_code, stem_code, species_scientific_name, count(*) AS rows,
         count(quality) AS flagged_rows, min(timestamp) AS first_timestamp, max(timestamp) AS last_timestamp,
         CONCAT('Tree ', coalesce(plant_code, '?'), ' | Stem ', coalesce(stem_code, '?'), ' | ',
                coalesce(species_scientific_name, 'Species ?')) AS title
       FROM fin GROUP BY deployment_id, plant_code, stem_code, species_scientific_name""",
)
def _qc_panels(t: Tables) -> DataFrame:
    return explore.qc_panels(explore.qc_rows(t["fin"]))


@query(
    "qc_fallback_columns",
    """SELECT logger_id, record, file_hash, species_code AS species_scientific_name, CAST(NULL AS VARCHAR) AS plant_code,
         FALSE AS quality_flagged FROM fin WHERE quality IS NULL""",
)
def _qc_fallback_columns(t: Tables) -> DataFrame:
    partial = t["fin"].drop("species_scientific_name", "plant_code")
    return explore.qc_rows(partial, exclude_suspect=True).select(
        "logger_id", "record", "file_hash", "species_scientific_name", "plant_code", "quality_flagged"
    )


@query(
    "deployment_titles",
    """SELECT deployment_id, title, regexp_replace(lower(replace(title, ' ', '-')), '[^a-z0-9_-]', '', 'g') AS slug FROM (
         SELECT deployment_id, CONCAT(coalesce(min(site_name), 'Unknown site'), ' | Zone ', coalesce(min(zone_name), 'Unknown zone'),
           ' | Plot ', coalesce(min(plot_name), 'Unknown plot'), ' | ', coalesce(min(datalogger_id), 'Logger ?'), ' | ',
           substring(coalesce(deployment_id, '?'), 1, 6)) AS title FROM fin GROUP BY deployment_id) x""",
)
def _deployment_titles(t: Tables) -> DataFrame:
    return explore.deployment_titles(t["fin"])


RECEIPT_SQL = """
    SELECT CONCAT(source, CASE doc_id % 7 WHEN 0 THEN '/Public_' WHEN 1 THEN '/Status_' WHEN 2 THEN '/DataTableInfo_'
        ELSE '/Table_' END, CAST(doc_id AS STRING)) AS path,
      CASE WHEN doc_id % 5 = 0 THEN 'Parsed' WHEN doc_id % 5 = 1 THEN 'DUPLICATE' ELSE 'Failed' END AS status,
      doc_id % 11 = 0 AS broken FROM documents"""


@query(
    "receipt_categories",
    f"""WITH f AS (SELECT path, CASE WHEN status = 'Parsed' THEN 'accepted' WHEN status = 'DUPLICATE' THEN 'duplicates'
            WHEN lower(path) LIKE '%public%' THEN 'public' WHEN lower(path) LIKE '%status%' THEN 'status'
            WHEN lower(path) LIKE '%datatableinfo%' THEN 'datatableinfo' WHEN broken THEN 'nonutf8' ELSE 'other' END AS category
          FROM ({RECEIPT_SQL}) r),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY path) AS rn FROM f)
        SELECT c.category, count(r.path) AS count,
          coalesce(string_agg(CASE WHEN r.rn <= 10 THEN r.path END, ',' ORDER BY r.path), '-') AS examples
        FROM (SELECT unnest(['accepted', 'duplicates', 'public', 'status', 'datatableinfo', 'nonutf8', 'other']) AS category) c
        LEFT JOIN ranked r ON r.category = c.category GROUP BY c.category""",
)
def _receipt_categories(t: Tables) -> DataFrame:
    files = t.sql(RECEIPT_SQL)
    attempts = F.when(
        F.col("broken"),
        F.array(F.struct(F.lit("utf8").alias("parser"), F.lit(toa5.UTF8_ATTEMPT[1]).alias("message"))),
    ).otherwise(F.array().cast("array<struct<parser:string,message:string>>"))
    return receipts.receipt_categories(files.withColumn("parser_attempts", attempts))


def _profile_sql(column: str) -> str:
    return (
        f"SELECT '{column}' AS column_name, count(*) AS row_count, count(*) - count({column}) AS null_count, "
        f"(count(*) - count({column})) / CAST(count(*) AS DOUBLE) AS null_rate, "
        f"CAST(min({column}) AS VARCHAR) AS min_value, CAST(max({column}) AS VARCHAR) AS max_value FROM fin"
    )


PROFILED = ["logger_id", "record", "thermistor_depth", "quality", "deployment_id", "plant_code"]


@query("column_profile", " UNION ALL ".join(_profile_sql(c) for c in PROFILED))
def _column_profile(t: Tables) -> DataFrame:
    return profile.column_profile(t["fin"].select(*PROFILED))


# --- Transactions -------------------------------------------------------------------------


def _own_metadata(t: Tables) -> manifest.Frames:
    """A manifest with all that the logger files of the test tables need."""
    code = lambda text: t.sql(f"SELECT DISTINCT {text} AS code FROM tx_logger")
    zoned = "CONCAT('S', CAST(n_regionkey AS STRING)) AS site_code"
    plant = "CONCAT('P', CAST(n AS STRING)) AS plant_code"
    return {
        "projects": code("'PRJ'"),
        "sites": t.sql("SELECT DISTINCT CONCAT('S', CAST(n_regionkey AS STRING)) AS code, 'UTC' AS timezone FROM tx_logger"),
        "zones": t.sql(f"SELECT {zoned}, n_name AS name FROM tx_logger"),
        "plots": t.sql(f"SELECT {zoned}, n_name AS zone_name, 'plot' AS name FROM tx_logger"),
        "species": code("CONCAT('SP', CAST(n_regionkey AS STRING))"),
        "plants": t.sql(
            f"SELECT {zoned}, n_name AS zone_name, 'plot' AS plot_name, CONCAT('SP', CAST(n_regionkey AS STRING)) AS species_code,"
            " CONCAT('P', CAST(n AS STRING)) AS code FROM tx_logger"
        ),
        "stems": t.sql(f"SELECT {plant}, 'ST' AS code FROM tx_logger"),
        "datalogger_types": code("'CR300'"),
        "dataloggers": t.sql("SELECT 'CR300' AS datalogger_type_code, code FROM tx_logger"),
        "sensor_types": code("'probe'"),
        "deployments": t.sql(
            f"SELECT 'PRJ' AS project_code, {plant}, 'ST' AS stem_code, code AS datalogger_code, 'probe' AS sensor_type_code, '0' AS sdi_address,"
            " TIMESTAMP_NTZ '2023-12-30 00:00:00' AS start_timestamp_utc FROM tx_logger WHERE n <> 7"
        ),
    }


def _transaction(t: Tables, files: DataFrame) -> transaction.Store:
    """A store of its own in the shared checkpoint folder, after one accepted run."""
    store = transaction.Store(f"{checkpoint_dir(t.spark)}/store-{uuid.uuid4().hex}")
    done = transaction.run_transaction(t.spark, files, None, store, NOW, manifest=_own_metadata(t), run_id="r")
    if done.outcome != "ACCEPTED":
        raise RuntimeError(f"the run was refused: {done.error}")
    return store


@query(
    "transaction_outputs",
    f"""SELECT x.logger_id, x.thermistor_depth, CONCAT('S', CAST(l.n_regionkey AS VARCHAR)) AS site_code, l.n_name AS zone_name,
          CONCAT('P', CAST(l.n AS VARCHAR)) AS plant_code, CONCAT('SP', CAST(l.n_regionkey AS VARCHAR)) AS species_code,
          count(*) AS n_rows, min(x.timestamp) AS first_utc, max(x.timestamp) AS last_utc
        FROM ({EXPECTED_SQL}) x JOIN tx_logger l ON l.code = x.logger_id WHERE l.n <> 7 GROUP BY 1, 2, 3, 4, 5, 6""",
)
def _transaction_outputs(t: Tables) -> DataFrame:
    store = _transaction(t, toa5_files(t))
    outputs = transaction.published_outputs(t.spark, store).where("is_latest")
    latest = outputs.first().output_id
    rows = tables.scan_observations(t.spark, store.output(latest))
    return rows.groupBy("logger_id", "thermistor_depth", "site_code", "zone_name", "plant_code", "species_code").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("timestamp_utc").alias("first_utc"), F.max("timestamp_utc").alias("last_utc")
    )


@query(
    "transaction_receipt",
    f"""{BATCH_SQL.replace("path LIKE 'dl/2%'", "FALSE")}
        SELECT path, status, CAST(attempts AS INTEGER) AS attempts, first_error_line FROM everything""",
)
def _transaction_receipt(t: Tables) -> DataFrame:
    files, _ = _mixed_batch(t)
    store = _transaction(t, files)
    entries = receipts.receipt_files(transaction.stored_receipts(t.spark, store))
    return entries.select("path", "status", F.size("parser_attempts").alias("attempts"), "first_error_line")


@query(
    "published_layout",
    "SELECT count(*) AS n_rows, count(DISTINCT logger_id) AS n_loggers, CAST(0 AS BIGINT) AS out_of_order FROM fin",
)
def _published_layout(t: Tables) -> DataFrame:
    path = f"{checkpoint_dir(t.spark)}/layout-{uuid.uuid4().hex}"
    tables.write_observations(tables.stage(t["fin"], "layout"), path)
    rows = t.spark.read.parquet(path).select("logger_id", "timestamp_utc", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    # Each row meets the one before it in its file by position, so no file is gathered in one task.
    later = rows.select("file", (F.col("at") - 1).alias("at"), F.col("logger_id").alias("next_logger"), F.col("timestamp_utc").alias("next_utc"))
    broken = rows.join(later, ["file", "at"]).where("logger_id > next_logger OR (logger_id = next_logger AND timestamp_utc > next_utc)")
    return summaries.side_by_side(
        rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("logger_id").alias("n_loggers")), broken.agg(F.count(F.lit(1)).alias("out_of_order"))
    )
