"""SQL building blocks of the counterparts, in DuckDB's dialect."""

from __future__ import annotations

REC = """
    SELECT logger_id, record, min(timestamp) AS timestamp,
      string_agg(DISTINCT file_hash, '+' ORDER BY file_hash) AS file_set_signature
    FROM obs GROUP BY logger_id, record"""

CHUNK = """
    SELECT logger_id, file_set_signature, arg_min(timestamp, record) AS anchor_timestamp, count(*) AS row_count
    FROM rec GROUP BY logger_id, file_set_signature"""

LOCAL_DEP = """
    SELECT d.datalogger_id, d.site_id, d.deployment_id,
      d.deployment_start_timestamp_utc + to_seconds(s.january_offset) AS start_timestamp_local,
      d.deployment_end_timestamp_utc + to_seconds(s.january_offset) AS end_timestamp_local,
      s.timezone, s.january_offset
    FROM dep d JOIN site s ON d.site_id = s.site_id"""

OFFSETS = """
    SELECT logger_id, file_set_signature, anchor_timestamp, row_count, site_id, timezone,
      january_offset AS utc_offset_seconds
    FROM (SELECT c.*, l.site_id, l.timezone, l.january_offset,
            row_number() OVER (PARTITION BY c.logger_id, c.file_set_signature
                               ORDER BY l.start_timestamp_local, l.deployment_id) AS rn
          FROM chunk c LEFT JOIN local_dep l ON c.logger_id = l.datalogger_id
            AND c.anchor_timestamp >= l.start_timestamp_local
            AND (l.end_timestamp_local IS NULL OR c.anchor_timestamp < l.end_timestamp_local)) x
    WHERE rn = 1"""

CORRECTED = """
    SELECT o.*, r.file_set_signature, r.timestamp - to_seconds(f.utc_offset_seconds) AS timestamp_utc,
      o.timestamp AS raw_local_timestamp_often_wrong
    FROM obs o JOIN rec r ON o.logger_id = r.logger_id AND o.record = r.record
    JOIN offsets f ON r.logger_id = f.logger_id AND r.file_set_signature = f.file_set_signature
    WHERE f.utc_offset_seconds IS NOT NULL"""

TIME_CTES = f"WITH rec AS ({REC}), chunk AS ({CHUNK}), local_dep AS ({LOCAL_DEP}), offsets AS ({OFFSETS})"

RANK = """CASE WHEN o.deployment_id IS NOT NULL THEN 0 WHEN o.stem_id IS NOT NULL THEN 1
    WHEN o.plant_id IS NOT NULL THEN 2 WHEN o.plot_id IS NOT NULL THEN 3 WHEN o.zone_id IS NOT NULL THEN 4
    WHEN o.species_id IS NOT NULL THEN 5 WHEN o.site_id IS NOT NULL THEN 6 ELSE 7 END"""

LABEL = """CASE rank WHEN 0 THEN 'deployment_override' WHEN 1 THEN 'stem_override' WHEN 2 THEN 'plant_override'
    WHEN 3 THEN 'plot_override' WHEN 4 THEN 'zone_override' WHEN 5 THEN 'species_override'
    WHEN 6 THEN 'site_override' ELSE 'default' END"""

# Winning override per deployment and code; the deployment '' stands for rows without one.
PICKS = f"""
    SELECT dep_key, code, TRY_CAST(trim(value, '"') AS DOUBLE) AS value, {LABEL} AS source
    FROM (SELECT s.dep_key, o.code, o.value, {RANK} AS rank,
            row_number() OVER (PARTITION BY s.dep_key, o.code ORDER BY {RANK}, o.seq) AS rn
          FROM (SELECT deployment_id AS dep_key, * EXCLUDE (deployment_id), deployment_id FROM ctx
                UNION ALL BY NAME SELECT '' AS dep_key) s
          JOIN ovr o ON (o.deployment_id IS NULL OR o.deployment_id = s.deployment_id)
            AND (o.stem_id IS NULL OR o.stem_id = s.stem_id)
            AND (o.plant_id IS NULL OR o.plant_id = s.plant_id)
            AND (o.plot_id IS NULL OR o.plot_id = s.plot_id)
            AND (o.zone_id IS NULL OR o.zone_id = s.zone_id)
            AND (o.species_id IS NULL OR o.species_id = s.species_id)
            AND (o.site_id IS NULL OR o.site_id = s.site_id)) x
    WHERE rn = 1"""


def picked(code: str, default: float, alias: str) -> str:
    """Value and source of one parameter from its pick row ``alias``."""
    return (
        f"CASE WHEN {alias}.dep_key IS NULL THEN CAST({default} AS DOUBLE) ELSE {alias}.value END AS {code}, "
        f"coalesce({alias}.source, 'default') AS parameter_source_{code}"
    )


# Flux formulas over the columns k, down, up, pulse, wa, wd, wc (content) and constants.
def dma(source: str, density: str, wound: str, content: str) -> str:
    k, probe, pulse = "0.002409611", "CAST(0.6 AS DOUBLE)", "CAST(3.0 AS DOUBLE)"
    heat, water_heat, water = "CAST(1000.0 AS DOUBLE)", "CAST(4182.0 AS DOUBLE)", "CAST(1000.0 AS DOUBLE)"
    ok = f"(alpha IS NOT NULL AND beta IS NOT NULL AND {density} IS NOT NULL AND {wound} IS NOT NULL AND {content} IS NOT NULL)"

    def flux(v: str) -> str:
        return (
            f"({v} * CAST(0.01 AS DOUBLE) / CAST(3600.0 AS DOUBLE) * {density} * ({heat} + {content} * {water_heat})"
            f" / ({water} * {water_heat}) * CAST(3600.0 AS DOUBLE) / CAST(0.01 AS DOUBLE))"
        )

    inside = (
        f"((CAST(4.0 AS DOUBLE) * CAST({k} AS DOUBLE) / {pulse}) * "
        f"ln(CASE WHEN tm > {pulse} THEN 1 - {pulse} / tm END) + {probe} * {probe})"
    )
    return f"""
    SELECT *, CASE WHEN beta <= 1 THEN j_hrm_cm_hr ELSE j_tmax_cm_hr END AS sap_flux_density_j_dma_cm_hr,
      CASE WHEN ok THEN CASE WHEN beta <= 1 THEN 'HRM' ELSE 'Tmax' END END AS calculation_method_used
    FROM (SELECT *, {flux('vc_hrm_cm_hr')} AS j_hrm_cm_hr, {flux('vc_tmax_cm_hr')} AS j_tmax_cm_hr
      FROM (SELECT *, {wound} * vh_hrm_cm_hr AS vc_hrm_cm_hr, {wound} * vh_tmax_cm_hr AS vc_tmax_cm_hr
        FROM (SELECT *, {ok} AS ok,
            CASE WHEN {ok} THEN 2 * CAST({k} AS DOUBLE) * alpha / ({probe} + {probe}) * 3600 END AS vh_hrm_cm_hr,
            CASE WHEN {ok} AND {inside} > 0 THEN sqrt({inside}) / (tm * (tm - {pulse})) * 3600 END AS vh_tmax_cm_hr
          FROM (SELECT *, time_to_max_temp_downstream_s AS tm FROM {source}) a) b) c) d"""


YEAR_US = "(365.25 * 24 * 60 * 60 * 1000000.0)"


def gap(order: str = "record, sdi12_address, thermistor_depth, file_hash") -> str:
    return (
        "coalesce(abs(epoch_us(timestamp_utc) - lag(epoch_us(timestamp_utc)) OVER "
        f"(PARTITION BY logger_id ORDER BY {order})) / {YEAR_US} > coalesce(quality_gap_years, 0), FALSE)"
    )


NOW = "2024-01-28 00:00:00"


def quality(source: str) -> str:
    """Quality columns over a source with bounds, thresholds, flux and row keys."""
    us = "epoch_us(timestamp_utc)"
    return f"""
    SELECT * EXCLUDE (quality_explanation), CASE WHEN quality_explanation <> '' THEN quality_explanation END
        AS quality_explanation, CASE WHEN quality_explanation <> '' THEN 'SUSPECT' END AS quality
    FROM (SELECT *, concat_ws('|',
        CASE WHEN {us} < epoch_us(deployment_start_timestamp_utc) - quality_deployment_start_grace_minutes * 60000000
             THEN 'timestamp_before_deployment' END,
        CASE WHEN deployment_start_timestamp_utc IS NULL
               AND {us} < epoch_us(first_start) - quality_deployment_start_grace_minutes * 60000000
             THEN 'timestamp_before_first_deployment' END,
        CASE WHEN {us} > epoch_us(coalesce(deployment_end_timestamp_utc, TIMESTAMP '{NOW}'))
               + quality_deployment_end_grace_minutes * 60000000 THEN 'timestamp_after_deployment' END,
        CASE WHEN {us} > epoch_us(TIMESTAMP '{NOW}') + quality_future_lead_minutes * 60000000
             THEN 'timestamp_future' END,
        CASE WHEN has_gap THEN 'record_gap_gt_quality_gap_years' END,
        CASE WHEN sap_flux_density_j_dma_cm_hr > quality_max_flux_cm_hr
             THEN 'sap_flux_density_above_quality_max_flux_cm_hr' END,
        CASE WHEN sap_flux_density_j_dma_cm_hr < quality_min_flux_cm_hr
             THEN 'sap_flux_density_below_quality_min_flux_cm_hr' END) AS quality_explanation
      FROM (SELECT *, {gap()} AS has_gap,
              min(deployment_start_timestamp_utc) OVER (PARTITION BY logger_id, sdi12_address) AS first_start
            FROM {source}) g) h"""


FINISHED = f"""{TIME_CTES}, corrected AS ({CORRECTED}), picks AS ({PICKS}),
    enriched AS (SELECT c.*, x.deployment_id, x.site_id, x.stem_code, x.species_scientific_name,
        x.deployment_start_timestamp_utc, x.deployment_end_timestamp_utc, coalesce(x.deployment_id, '') AS dep_key
      FROM corrected c LEFT JOIN ctx x ON c.logger_id = x.datalogger_id AND c.sdi12_address = x.sdi_address
        AND c.timestamp_utc >= x.deployment_start_timestamp_utc
        AND (x.deployment_end_timestamp_utc IS NULL OR c.timestamp_utc < x.deployment_end_timestamp_utc)),
    params AS (SELECT e.*, {picked('parameter_wood_density_kg_m3', 500.0, 'p1')},
        {picked('parameter_wound_correction_a', 1.8905, 'p2')},
        {picked('parameter_water_content_g_g', 1.0, 'p3')},
        {picked('quality_max_flux_cm_hr', 40.0, 'p4')}, {picked('quality_gap_years', 2.0, 'p5')},
        CAST(-15.0 AS DOUBLE) AS quality_min_flux_cm_hr, 0 AS quality_deployment_start_grace_minutes,
        0 AS quality_deployment_end_grace_minutes, 5 AS quality_future_lead_minutes
      FROM enriched e
      LEFT JOIN picks p1 ON p1.dep_key = e.dep_key AND p1.code = 'parameter_wood_density_kg_m3'
      LEFT JOIN picks p2 ON p2.dep_key = e.dep_key AND p2.code = 'parameter_wound_correction_a'
      LEFT JOIN picks p3 ON p3.dep_key = e.dep_key AND p3.code = 'parameter_water_content_g_g'
      LEFT JOIN picks p4 ON p4.dep_key = e.dep_key AND p4.code = 'quality_max_flux_cm_hr'
      LEFT JOIN picks p5 ON p5.dep_key = e.dep_key AND p5.code = 'quality_gap_years'),
    fluxed AS ({dma('params', 'parameter_wood_density_kg_m3', 'parameter_wound_correction_a', 'parameter_water_content_g_g')}),
    finished AS ({quality('fluxed')})"""


# --- A whole manifest ---------------------------------------------------------------------


def _manifest_sql() -> str:
    """Violations of the manifest inputs ``m_*`` against the stored ``old_*``."""
    key = lambda columns: "CONCAT(" + ", '/', ".join(f"coalesce({c}, '')" for c in columns) + ")" if len(columns) > 1 else f"coalesce({columns[0]}, '')"
    keys = {
        "projects": ["code"], "sites": ["code"], "zones": ["site_code", "name"], "plots": ["site_code", "zone_name", "name"], "species": ["code"],
        "plants": ["site_code", "zone_name", "plot_name", "code"], "stems": ["plant_code", "code"], "datalogger_types": ["code"], "dataloggers": ["code"],
        "datalogger_aliases": ["alias"], "sensor_types": ["code"], "sensor_thermistor_pairs": ["sensor_type_code", "name"],
        "deployments": ["datalogger_code", "sdi_address"], "parameter_overrides": ["parameter_code"],
    }
    found = []

    def fault(entity: str, text: str, condition: str) -> None:
        found.append(f"SELECT '{entity}' AS entity, {key(keys[entity])} AS key, '{text}' AS violation FROM m_{entity} x WHERE {condition}")

    everything = lambda e: f"(SELECT {', '.join(keys[e])} FROM m_{e}" + (f" UNION ALL SELECT {', '.join(keys[e])} FROM old_{e})" if e == "projects" else ")")

    def parent(entity: str, of: str, columns: dict[str, str], optional: bool = False, unique: bool = False) -> None:
        source = "old_parameters" if of == "parameters" else everything(of)
        same = " AND ".join(f"p.{theirs} = x.{own}" for own, theirs in columns.items())
        given = f"x.{list(columns)[-1]} IS NOT NULL AND " if optional else ""
        fault(entity, f"missing {of}", f"{given}NOT EXISTS (SELECT 1 FROM {source} p WHERE {same})")
        if unique:
            names = list(columns.values())
            shared = f"SELECT {', '.join(names)} FROM (SELECT DISTINCT * FROM {source}) u GROUP BY {', '.join(names)} HAVING count(*) > 1"
            fault(entity, f"ambiguous {of}", f"EXISTS (SELECT 1 FROM ({shared}) p WHERE {same})")

    parent("zones", "sites", {"site_code": "code"})
    parent("plots", "sites", {"site_code": "code"})
    parent("plots", "zones", {"site_code": "site_code", "zone_name": "name"})
    parent("plants", "plots", {"site_code": "site_code", "zone_name": "zone_name", "plot_name": "name"})
    parent("plants", "species", {"species_code": "code"})
    parent("stems", "plants", {"plant_code": "code"}, unique=True)
    parent("dataloggers", "datalogger_types", {"datalogger_type_code": "code"})
    parent("datalogger_aliases", "dataloggers", {"datalogger_code": "code"})
    parent("sensor_thermistor_pairs", "sensor_types", {"sensor_type_code": "code"})
    parent("deployments", "projects", {"project_code": "code"})
    parent("deployments", "plants", {"plant_code": "code"}, unique=True)
    parent("deployments", "stems", {"plant_code": "plant_code", "stem_code": "code"})
    parent("deployments", "dataloggers", {"datalogger_code": "code"})
    parent("deployments", "sensor_types", {"sensor_type_code": "code"})
    parent("parameter_overrides", "parameters", {"parameter_code": "code"})
    parent("parameter_overrides", "sites", {"site_code": "code"}, optional=True)
    parent("parameter_overrides", "species", {"species_code": "code"}, optional=True)
    parent("parameter_overrides", "zones", {"zone_name": "name"}, optional=True, unique=True)
    parent("parameter_overrides", "plots", {"plot_name": "name"}, optional=True, unique=True)
    parent("parameter_overrides", "plants", {"plant_code": "code"}, optional=True, unique=True)
    parent("parameter_overrides", "stems", {"plant_code": "plant_code", "stem_code": "code"}, optional=True)
    for entity, columns in keys.items():
        if entity not in ("datalogger_aliases", "deployments", "parameter_overrides"):
            new = f"SELECT {', '.join(columns)} FROM m_{entity}"
            held = f"SELECT {', '.join(columns)} FROM {everything(entity)} a GROUP BY {', '.join(columns)} HAVING count(*) > 1"
            found.append(f"SELECT '{entity}', {key(columns)}, 'already exists' FROM ({held} INTERSECT {new}) x")
    for entity in ("datalogger_aliases", "deployments"):
        columns = ", ".join(keys[entity])
        rows = f"SELECT {columns}, start_timestamp_utc AS s, end_timestamp_utc AS e FROM m_{entity}"
        if entity == "deployments":
            rows += f" UNION ALL SELECT {columns}, start_timestamp_utc, end_timestamp_utc FROM old_deployments"
        reach = (
            f"SELECT *, max(coalesce(e, TIMESTAMP '9999-12-31')) OVER (PARTITION BY {columns} ORDER BY s, coalesce(e, TIMESTAMP '9999-12-31')"
            f" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM ({rows}) r"
        )
        found.append(f"SELECT '{entity}', {key(keys[entity])}, 'overlaps or touches' FROM ({reach}) x WHERE reach >= s")
        fault(entity, "end not after start", "end_timestamp_utc <= start_timestamp_utc")
    fault("projects", "empty code", "code = ''")
    fault("datalogger_aliases", "empty alias", "alias = ''")
    fault("sites", "invalid timezone", "timezone IS NULL OR timezone = 'Mars/Base'")
    fault("sites", "boundary is not a Polygon", "boundary IS NOT NULL")
    fault("deployments", "invalid SDI-12 address", "sdi_address = '12'")
    fault("parameter_overrides", "stem without plant", "stem_code IS NOT NULL AND plant_code IS NULL")
    return "SELECT entity, key, violation, count(*) AS n FROM (" + " UNION ALL ".join(found) + ") v GROUP BY entity, key, violation"


MANIFEST_SQL = _manifest_sql()
