"""Domain inputs derived from the test tables.

Each entry is SQL that Spark and DuckDB both run. The inputs are shared by a query and its
SQL counterpart; what is compared is the operator applied to them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from xylemflow.session import prepare

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]

INPUTS = {
    # Sensor readings: a full download (fileA) and a partial one (fileB) with every fifth record.
    "obs": """
        SELECT CAST(user_id % 25 AS STRING) AS logger_id, event_id AS record, ts AS timestamp,
          file_hash, CAST(CAST(floor(user_id / 25.0) AS BIGINT) % 2 AS STRING) AS sdi12_address,
          CASE WHEN event_type IN ('click', 'view') THEN 'inner' ELSE 'outer' END AS thermistor_depth,
          CASE WHEN event_id % 97 = 0 THEN NULL ELSE (value - 20.0) / 50.0 END AS alpha,
          value / 40.0 AS beta, 2.0 + value AS time_to_max_temp_downstream_s
        FROM (SELECT e.*, 'fileA' AS file_hash FROM events e
              UNION ALL
              SELECT e.*, 'fileB' AS file_hash FROM events e WHERE event_id % 5 = 0) c""",
    # The same readings with the time taken as UTC, for operators after the time step.
    "obs_utc": """
        SELECT o.*, o.timestamp AS timestamp_utc FROM obs o""",
    "site": """
        SELECT CAST(r_regionkey AS STRING) AS site_id, r_name AS name,
          CASE WHEN r_regionkey = 1 THEN 'Europe/Paris' WHEN r_regionkey = 2 THEN 'Asia/Tokyo'
               WHEN r_regionkey = 3 THEN 'UTC' ELSE 'America/New_York' END AS timezone,
          CASE WHEN r_regionkey = 1 THEN 3600 WHEN r_regionkey = 2 THEN 32400
               WHEN r_regionkey = 3 THEN 0 ELSE -18000 END AS january_offset
        FROM region""",
    "slot": """
        SELECT n_nationkey AS n, n_name, n_regionkey, '0' AS sdi_address FROM nation
        UNION ALL
        SELECT n_nationkey AS n, n_name, n_regionkey, '1' AS sdi_address FROM nation""",
    "phase_slot": """
        SELECT s.*, 0 AS phase FROM slot s WHERE n <> 7
        UNION ALL
        SELECT s.*, 1 AS phase FROM slot s WHERE n % 5 = 1""",
    # Deployments: logger 7 has none, every fifth logger has a two-day hole, every third ends.
    "dep": """
        SELECT CAST(n AS STRING) AS datalogger_id, sdi_address, CAST(n_regionkey AS STRING) AS site_id,
          CONCAT(CAST(n AS STRING), '-', sdi_address, '-', CAST(phase AS STRING)) AS deployment_id,
          CASE WHEN phase = 1 THEN TIMESTAMP '2024-01-14 00:00:00'
               WHEN sdi_address = '1' AND n % 4 = 2 THEN TIMESTAMP '2024-01-05 00:00:00'
               ELSE TIMESTAMP '2023-12-30 00:00:00' END AS deployment_start_timestamp_utc,
          CASE WHEN phase = 0 AND n % 5 = 1 THEN TIMESTAMP '2024-01-12 00:00:00'
               WHEN n % 3 = 0 THEN TIMESTAMP '2024-01-25 00:00:00' ELSE NULL
          END AS deployment_end_timestamp_utc,
          CONCAT('Z', CAST(n AS STRING)) AS zone_id, CONCAT('L', CAST(n AS STRING)) AS plot_id,
          CONCAT('P', CAST(n AS STRING), '-', sdi_address) AS plant_id,
          CONCAT('P', CAST(n AS STRING), '-', sdi_address, '-S1') AS stem_id,
          CONCAT('N', CAST(n % 2 AS STRING)) AS project_id, n, n_name
        FROM phase_slot""",
    "ctx": """
        SELECT d.deployment_id, d.datalogger_id, d.sdi_address, d.project_id, d.site_id, d.zone_id,
          d.plot_id, d.plant_id, c.c_mktsegment AS species_id, d.stem_id,
          CONCAT('PRJ', d.project_id) AS project_code,
          CASE WHEN d.n % 2 = 0 THEN 'Even project' ELSE NULL END AS project_name,
          CONCAT('SITE', d.site_id) AS site_code, s.name AS site_name, d.n_name AS zone_name,
          CONCAT('Plot ', CAST(d.n % 4 AS STRING)) AS plot_name, d.plant_id AS plant_code,
          'S1' AS stem_code, c.c_mktsegment AS species_code,
          CONCAT('Genus ', lower(c.c_mktsegment)) AS species_scientific_name,
          d.deployment_start_timestamp_utc, d.deployment_end_timestamp_utc,
          CONCAT('{"probe_azimuth": ', CAST(d.n * 10 AS STRING),
                 CASE WHEN d.n % 2 = 0 THEN CONCAT(', "notes": "n', CAST(d.n AS STRING), '"') ELSE '' END,
                 ', "flags": {"ok": true}}') AS installation_metadata,
          s.timezone, s.january_offset
        FROM dep d JOIN site s ON d.site_id = s.site_id
        JOIN customer c ON c.c_custkey = d.n * 2 + CAST(d.sdi_address AS BIGINT)""",
    # Logger aliases: A<k> stands for logger k during part of the month.
    "alias": """
        SELECT CONCAT('A', CAST(n_nationkey AS STRING)) AS alias,
          CAST(n_nationkey AS STRING) AS datalogger_id,
          TIMESTAMP '2024-01-06 00:00:00' AS start_timestamp_utc,
          CASE WHEN n_nationkey % 2 = 0 THEN TIMESTAMP '2024-01-20 00:00:00' ELSE NULL END
            AS end_timestamp_utc
        FROM nation""",
    # Readings in which every third record carries the alias instead of the logger id.
    "obs_alias": """
        SELECT CASE WHEN record % 3 = 0 THEN CONCAT('A', logger_id) ELSE logger_id END AS logger_id,
          record, sdi12_address, thermistor_depth, file_hash, timestamp AS timestamp_utc
        FROM obs""",
    # Overrides at every scope, two of equal rank, a scope-free one and an unusable value.
    "ovr": """
        SELECT CAST(n_nationkey AS BIGINT) AS seq, 'parameter_wood_density_kg_m3' AS code,
          CAST(400 + n_nationkey AS STRING) AS value, CAST(NULL AS STRING) AS deployment_id,
          CASE WHEN n_nationkey % 3 = 0 THEN CONCAT('P', CAST(n_nationkey AS STRING), '-0-S1') END AS stem_id,
          CASE WHEN n_nationkey % 3 = 1 THEN CONCAT('P', CAST(n_nationkey AS STRING), '-1') END AS plant_id,
          CAST(NULL AS STRING) AS plot_id,
          CASE WHEN n_nationkey % 3 = 2 THEN CONCAT('Z', CAST(n_nationkey AS STRING)) END AS zone_id,
          CAST(NULL AS STRING) AS species_id, CAST(NULL AS STRING) AS site_id
        FROM nation
        UNION ALL
        SELECT 100 + n_nationkey, 'parameter_wound_correction_a',
          CONCAT('"', CAST(2 + n_nationkey AS STRING), '.5"'),
          CASE WHEN n_nationkey % 2 = 0 THEN CONCAT(CAST(n_nationkey AS STRING), '-0-0') END, NULL, NULL,
          CASE WHEN n_nationkey % 2 = 1 THEN CONCAT('L', CAST(n_nationkey AS STRING)) END, NULL, NULL, NULL
        FROM nation
        UNION ALL
        SELECT 200 + r_regionkey, 'quality_max_flux_cm_hr',
          CASE WHEN r_regionkey = 4 THEN 'true' ELSE CAST(20 + r_regionkey AS STRING) END,
          NULL, NULL, NULL, NULL, NULL, NULL, CAST(r_regionkey AS STRING)
        FROM region
        UNION ALL
        SELECT 300 + r_regionkey, 'quality_max_flux_cm_hr', '99', NULL, NULL, NULL, NULL, NULL, NULL,
          CAST(r_regionkey AS STRING)
        FROM region
        UNION ALL
        SELECT 400 + r_regionkey, 'quality_gap_years', '0.001', NULL, NULL, NULL, NULL, NULL, NULL, NULL
        FROM region
        UNION ALL
        SELECT 500, 'parameter_water_content_g_g', '0.75', NULL, NULL, NULL, NULL, NULL, c_mktsegment, NULL
        FROM customer WHERE c_custkey = 3
        UNION ALL
        SELECT 600, 'parameter_water_content_g_g', '0.5', NULL, NULL, NULL, NULL, NULL, NULL, '2'
        FROM region WHERE r_regionkey = 2""",
    # Dimension tables of the deployment context, one deployment per customer.
    "dim_deployment": """
        SELECT CAST(c_custkey AS STRING) AS deployment_id, CONCAT('DL', CAST(c_nationkey AS STRING)) AS datalogger_id,
          CONCAT('S', CAST(c_custkey AS STRING)) AS stem_id,
          CONCAT('N', CAST(CAST(floor(c_custkey / 15.0) AS BIGINT) AS STRING)) AS project_id,
          CAST(c_custkey % 10 AS STRING) AS sdi_address, TIMESTAMP '2024-01-01 00:00:00' AS start_timestamp_utc,
          CASE WHEN c_custkey % 4 = 0 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE NULL END AS end_timestamp_utc,
          CONCAT('{"height_cm": ', CAST(c_custkey AS STRING), ', "paint": ',
                 CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'null' END,
                 CASE WHEN c_custkey % 5 = 0 THEN CONCAT(', "notes": "near ', c_name, '"') ELSE '' END,
                 ', "tags": ["a","b"]}') AS installation_metadata,
          c_custkey % 6 <> 5 AS include_in_pipeline
        FROM customer""",
    "dim_stem": """
        SELECT CONCAT('S', CAST(c_custkey AS STRING)) AS stem_id, CONCAT('P', CAST(c_custkey AS STRING)) AS plant_id,
          'S1' AS code FROM customer""",
    # Four plants a plot; every eighth plant names a plot that does not exist.
    "dim_plant": """
        SELECT CONCAT('P', CAST(c_custkey AS STRING)) AS plant_id,
          CASE WHEN c_custkey % 8 = 3 THEN 'unknown'
               ELSE CONCAT('L', CAST(c_custkey - c_custkey % 4 AS STRING)) END AS plot_id,
          c_mktsegment AS species_id, c_name AS code FROM customer""",
    "dim_plot": """
        SELECT CONCAT('L', CAST(c_custkey AS STRING)) AS plot_id, CONCAT('Z', CAST(c_nationkey AS STRING)) AS zone_id,
          CONCAT('Plot ', CAST(c_custkey AS STRING)) AS name
        FROM customer""",
    "dim_zone": """
        SELECT CONCAT('Z', CAST(n_nationkey AS STRING)) AS zone_id, CAST(n_regionkey AS STRING) AS site_id,
          n_name AS name FROM nation""",
    "dim_site": """
        SELECT site_id, CONCAT('SITE', site_id) AS code, name, timezone FROM site""",
    "dim_species": """
        SELECT c_mktsegment AS species_id, c_mktsegment AS code,
          CONCAT('{"binomial": "  gENUS   ', c_mktsegment, ' "}') AS latin_name
        FROM customer GROUP BY c_mktsegment""",
    "dim_project": """
        SELECT CONCAT('N', CAST(s_suppkey AS STRING)) AS project_id, CONCAT('PRJ', CAST(s_suppkey AS STRING)) AS code,
          s_name AS name FROM supplier""",
    "dim_logger": """
        SELECT CONCAT('DL', CAST(n_nationkey AS STRING)) AS datalogger_id, CAST(n_nationkey AS STRING) AS code
        FROM nation""",
    # Stored aliases and overrides that name their logger and parameter by id; some ids are unknown.
    "dim_alias": """
        SELECT CONCAT('A', CAST(o_orderkey AS STRING)) AS alias, CONCAT('DL', CAST(o_custkey % 27 AS STRING)) AS datalogger_id,
          o_orderdate AS start_timestamp_utc,
          CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate + INTERVAL '30' DAY END AS end_timestamp_utc
        FROM orders""",
    "dim_parameter": """
        SELECT CONCAT('PM', CAST(r_regionkey AS STRING)) AS parameter_id, CONCAT('parameter_', lower(r_name)) AS code FROM region""",
    "dim_override": """
        SELECT p_partkey AS seq, CONCAT('PM', CAST(p_partkey % 6 AS STRING)) AS parameter_id,
          CAST(p_size AS STRING) AS value, CONCAT('S', CAST(p_partkey % 7 AS STRING)) AS site_id FROM part""",
    # Readings with deployment bounds, thresholds and a flux, as the quality rules see them.
    "graded": """
        SELECT o.logger_id, o.record, o.sdi12_address, o.thermistor_depth, o.file_hash, o.timestamp_utc,
          d.deployment_start_timestamp_utc, d.deployment_end_timestamp_utc,
          CASE WHEN o.record % 13 = 0 THEN NULL ELSE (o.beta * 40.0 - 60.0) / 3.0 END AS sap_flux_density_j_dma_cm_hr,
          CASE WHEN o.record % 17 = 0 THEN NULL ELSE CAST(40.0 AS DOUBLE) END AS quality_max_flux_cm_hr,
          CAST(-15.0 AS DOUBLE) AS quality_min_flux_cm_hr, CAST(0.001 AS DOUBLE) AS quality_gap_years,
          CAST(60.0 AS DOUBLE) AS quality_deployment_start_grace_minutes,
          CAST(30.0 AS DOUBLE) AS quality_deployment_end_grace_minutes,
          CAST(5.0 AS DOUBLE) AS quality_future_lead_minutes
        FROM (SELECT logger_id, record, sdi12_address, thermistor_depth, file_hash, beta, timestamp_utc
              FROM obs_utc) o
        LEFT JOIN dep d ON o.logger_id = d.datalogger_id AND o.sdi12_address = d.sdi_address
          AND o.timestamp_utc >= d.deployment_start_timestamp_utc
          AND (d.deployment_end_timestamp_utc IS NULL OR o.timestamp_utc < d.deployment_end_timestamp_utc)""",
    # A finished table, for the summaries and the read path.
    "fin": """
        SELECT o.timestamp, o.timestamp_utc, o.logger_id, o.record, o.sdi12_address, o.file_hash,
          CASE WHEN o.record % 41 = 0 THEN NULL ELSE o.thermistor_depth END AS thermistor_depth,
          CASE WHEN o.record % 5 = 0 THEN 'fileA+fileB' WHEN o.record % 100 < 50 THEN 'fileA' ELSE 'fileC' END
            AS file_set_signature,
          c.deployment_id, c.datalogger_id, c.project_name, c.project_code, c.site_name, c.zone_name, c.plot_name,
          c.plant_code, c.stem_code, c.species_code, c.species_scientific_name,
          (o.beta * 40.0 - 60.0) / 3.0 AS sap_flux_density_j_dma_cm_hr,
          CASE WHEN o.record % 7 = 0 OR o.record % 11 = 0 THEN 'SUSPECT' ELSE NULL END AS quality,
          CASE WHEN o.record % 77 = 0 THEN 'timestamp_future|record_gap_gt_quality_gap_years'
               WHEN o.record % 7 = 0 THEN 'timestamp_future'
               WHEN o.record % 11 = 0 THEN 'timestamp_after_deployment|timestamp_future' ELSE NULL END
            AS quality_explanation,
          CASE WHEN o.record % 3 = 0 THEN 'stem_override' WHEN o.record % 3 = 1 THEN 'site_override'
               ELSE 'default' END AS parameter_source_parameter_wood_density_kg_m3,
          CASE WHEN o.record % 10 = 0 THEN 'plant_override' ELSE 'default' END
            AS parameter_source_parameter_water_content_g_g,
          CASE WHEN o.record % 10 = 1 THEN 'zone_override' ELSE NULL END AS parameter_source_quality_gap_years,
          CASE WHEN o.record % 4 = 1 THEN 'plot_override' ELSE '' END AS parameter_source_quality_max_flux_cm_hr
        FROM obs_utc o
        LEFT JOIN ctx c ON o.logger_id = c.datalogger_id AND o.sdi12_address = c.sdi_address
          AND o.timestamp_utc >= c.deployment_start_timestamp_utc
          AND (c.deployment_end_timestamp_utc IS NULL OR o.timestamp_utc < c.deployment_end_timestamp_utc)""",
    # Raw files: documents as bytes, some already ingested.
    "raw_doc": """
        SELECT CONCAT('upload/', source, '/', CAST(doc_id AS STRING), '.dat') AS path, doc_id,
          coalesce(text, '') AS text
        FROM documents""",
    # Readings in download order, as written to logger files of 400 lines.
    "toa5_row": """
        SELECT user_id % 25 AS logger, ts, value,
          row_number() OVER (PARTITION BY user_id % 25 ORDER BY event_id) - 1 AS rn
        FROM events""",
    "toa5_line": """
        SELECT logger, ts, value, rn, CAST(floor(rn / 400.0) AS BIGINT) AS part, rn % 400 AS line_nr,
          CONCAT('dl/', CAST(logger AS STRING), '-', CAST(CAST(floor(rn / 400.0) AS BIGINT) AS STRING), '.dat') AS path
        FROM toa5_row""",
    # Manifest rows with seeded faults.
    "add_plant": """
        SELECT CONCAT('R', CAST(c_nationkey % 5 AS STRING)) AS site_code,
          CONCAT('NATION_', CAST(c_nationkey AS STRING)) AS zone_name,
          CASE WHEN c_custkey % 11 = 0 THEN 'PLOT2' ELSE 'PLOT1' END AS plot_name, c_mktsegment AS species_code,
          CONCAT('PL', CAST(c_custkey % 700 AS STRING)) AS code,
          CASE WHEN c_custkey % 9 = 0 THEN '{"type": "Polygon", "coordinates": []}'
               WHEN c_custkey % 9 = 1 THEN NULL WHEN c_custkey % 9 = 2 THEN 'null'
               WHEN c_custkey % 9 = 3 THEN '{"type": "Point"}'
               ELSE '{"type": "Point", "coordinates": [1.0, 2.0]}' END AS location
        FROM customer""",
    "old_plant": """
        SELECT CONCAT('R', CAST(s_nationkey % 5 AS STRING)) AS site_code,
          CONCAT('NATION_', CAST(s_nationkey AS STRING)) AS zone_name, 'PLOT1' AS plot_name,
          CONCAT('PL', CAST(s_suppkey AS STRING)) AS code FROM supplier""",
    "old_plot": """
        SELECT CONCAT('R', CAST(n_regionkey AS STRING)) AS site_code, n_name AS zone_name, 'PLOT1' AS name
        FROM nation""",
    "old_species": """
        SELECT c_mktsegment AS code FROM customer WHERE c_mktsegment <> 'MACHINERY' GROUP BY c_mktsegment""",
    "old_zone": """
        SELECT CONCAT('R', CAST(s_nationkey % 5 AS STRING)) AS site_code,
          CONCAT('Z', CAST(s_suppkey % 40 AS STRING)) AS name FROM supplier
        GROUP BY CONCAT('R', CAST(s_nationkey % 5 AS STRING)), CONCAT('Z', CAST(s_suppkey % 40 AS STRING))""",
    "add_override": """
        SELECT CONCAT('param-', CAST(p_partkey AS STRING)) AS parameter_code,
          CASE WHEN p_partkey % 3 = 0 THEN CONCAT('Z', CAST(p_size AS STRING)) END AS zone_name,
          CASE WHEN p_partkey % 3 = 1 THEN CONCAT('PL', CAST(p_size AS STRING)) END AS plant_code,
          CASE WHEN p_partkey % 4 = 1 THEN 'S1' END AS stem_code, CAST(NULL AS STRING) AS site_code,
          CAST(NULL AS STRING) AS species_code, CAST(NULL AS STRING) AS plot_name
        FROM part""",
    "add_deployment": """
        SELECT CONCAT('L', CAST(o_custkey AS STRING)) AS datalogger_code,
          CASE WHEN o_orderkey % 50 = 0 THEN '12' WHEN o_orderkey % 50 = 1 THEN '-'
               ELSE CAST(o_orderkey % 2 AS STRING) END AS sdi_address,
          o_orderdate AS start_timestamp_utc,
          CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN o_orderdate
               ELSE o_orderdate + INTERVAL '40' DAY END AS end_timestamp_utc, o_orderkey
        FROM orders""",
    "stored_object": """
        SELECT CONCAT('raw-files/', CAST(o_orderkey AS STRING)) AS object_key FROM orders
        UNION ALL SELECT CONCAT('outputs/', CAST(p_partkey AS STRING), '.parquet') FROM part
        UNION ALL SELECT CONCAT('repro-cartridges/', CAST(p_partkey AS STRING), '.zip') FROM part
        UNION ALL SELECT CONCAT('tmp/', CAST(s_suppkey AS STRING)) FROM supplier""",
    "raw_row": """
        SELECT DISTINCT CAST(l_orderkey AS STRING) AS file_hash FROM lineitem""",
    "output_row": """
        SELECT CAST(p_partkey AS STRING) AS output_id,
          CASE WHEN p_partkey % 3 <> 0 THEN CONCAT('outputs/', CAST(p_partkey AS STRING), '.parquet') END
            AS object_store_path,
          CASE WHEN p_partkey % 2 = 0 THEN CONCAT('repro-cartridges/', CAST(p_partkey AS STRING), '.zip') END
            AS reproducibility_cartridge_path
        FROM part""",
    # A whole manifest with faults of every kind; each entity grows with a table.
    "m_projects": """
        SELECT CASE WHEN c_custkey % 40 = 0 THEN '' ELSE CONCAT('PRJ', CAST(c_custkey % 400 AS STRING)) END AS code FROM customer""",
    "m_sites": """
        SELECT CONCAT('S', CAST(s_suppkey AS STRING)) AS code,
          CASE WHEN s_suppkey % 7 = 0 THEN 'Mars/Base' WHEN s_suppkey % 7 = 1 THEN NULL ELSE 'Europe/Paris' END AS timezone,
          CASE WHEN s_suppkey % 5 = 0 THEN '{"type": "Point", "coordinates": [1, 2]}' END AS boundary FROM supplier""",
    "m_zones": """
        SELECT CONCAT('S', CAST(p_partkey % 150 AS STRING)) AS site_code, CONCAT('Z', CAST(p_size AS STRING)) AS name FROM part""",
    "m_plots": """
        SELECT CONCAT('S', CAST(p_partkey % 150 AS STRING)) AS site_code, CONCAT('Z', CAST(p_size % 30 AS STRING)) AS zone_name,
          CONCAT('L', CAST(p_partkey AS STRING)) AS name FROM part""",
    "m_species": """
        SELECT CONCAT('SP', CAST(s_suppkey % 90 AS STRING)) AS code FROM supplier""",
    "m_plants": """
        SELECT CONCAT('S', CAST(p_partkey % 150 AS STRING)) AS site_code, CONCAT('Z', CAST(p_size % 30 AS STRING)) AS zone_name,
          CONCAT('L', CAST(p_partkey AS STRING)) AS plot_name, CONCAT('SP', CAST(p_partkey % 120 AS STRING)) AS species_code,
          CONCAT('PL', CAST(p_partkey % 1500 AS STRING)) AS code FROM part""",
    "m_stems": """
        SELECT CONCAT('PL', CAST(p_partkey % 1600 AS STRING)) AS plant_code, CONCAT('ST', CAST(p_size % 3 AS STRING)) AS code FROM part""",
    "m_datalogger_types": """
        SELECT CONCAT('T', CAST(r_regionkey % 4 AS STRING)) AS code FROM region""",
    "m_dataloggers": """
        SELECT CONCAT('T', CAST(c_custkey % 6 AS STRING)) AS datalogger_type_code, CONCAT('D', CAST(c_custkey % 900 AS STRING)) AS code FROM customer""",
    "m_datalogger_aliases": """
        SELECT CONCAT('D', CAST(o_custkey AS STRING)) AS datalogger_code,
          CASE WHEN o_orderkey % 60 = 0 THEN '' ELSE CONCAT('A', CAST(o_orderkey % 3000 AS STRING)) END AS alias,
          o_orderdate AS start_timestamp_utc,
          CASE WHEN o_orderkey % 11 = 0 THEN o_orderdate ELSE o_orderdate + INTERVAL '9' DAY END AS end_timestamp_utc FROM orders""",
    "m_sensor_types": """
        SELECT n_name AS code FROM nation UNION ALL SELECT n_name FROM nation WHERE n_regionkey = 2""",
    "m_sensor_thermistor_pairs": """
        SELECT CASE WHEN n_nationkey % 4 = 0 THEN 'nothing' ELSE n_name END AS sensor_type_code, CONCAT('pair', CAST(n_nationkey AS STRING)) AS name
        FROM nation UNION ALL SELECT n_name, CONCAT('pair', CAST(n_nationkey AS STRING)) FROM nation WHERE n_nationkey % 4 = 1""",
    "m_deployments": """
        SELECT CONCAT('PRJ', CAST(o_custkey % 500 AS STRING)) AS project_code, CONCAT('PL', CAST(o_custkey % 1700 AS STRING)) AS plant_code,
          CONCAT('ST', CAST(o_orderkey % 4 AS STRING)) AS stem_code, CONCAT('D', CAST(o_custkey % 1000 AS STRING)) AS datalogger_code,
          CASE WHEN o_orderkey % 20 = 0 THEN 'nothing' ELSE 'FRANCE' END AS sensor_type_code,
          CASE WHEN o_orderkey % 31 = 0 THEN '12' ELSE CAST(o_orderkey % 10 AS STRING) END AS sdi_address,
          o_orderdate AS start_timestamp_utc,
          CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderdate + INTERVAL '40' DAY END AS end_timestamp_utc FROM orders""",
    "m_parameter_overrides": """
        SELECT CASE WHEN p_partkey % 9 = 0 THEN 'unknown' ELSE 'parameter_wood_density_kg_m3' END AS parameter_code,
          CASE WHEN p_partkey % 2 = 0 THEN CONCAT('S', CAST(p_partkey % 200 AS STRING)) END AS site_code,
          CASE WHEN p_partkey % 3 = 0 THEN CONCAT('SP', CAST(p_partkey % 100 AS STRING)) END AS species_code,
          CASE WHEN p_partkey % 5 = 0 THEN CONCAT('Z', CAST(p_size AS STRING)) END AS zone_name,
          CASE WHEN p_partkey % 7 = 0 THEN CONCAT('L', CAST(p_partkey AS STRING)) END AS plot_name,
          CASE WHEN p_partkey % 11 = 0 THEN CONCAT('PL', CAST(p_partkey % 1600 AS STRING)) END AS plant_code,
          CASE WHEN p_partkey % 13 < 2 THEN CONCAT('ST', CAST(p_size % 4 AS STRING)) END AS stem_code FROM part""",
    "old_projects": """
        SELECT CONCAT('PRJ', CAST(r_regionkey AS STRING)) AS code FROM region""",
    "old_parameters": """
        SELECT 'parameter_wood_density_kg_m3' AS code FROM region WHERE r_regionkey = 0""",
    "old_deployments": """
        SELECT CONCAT('D', CAST(s_suppkey AS STRING)) AS datalogger_code, '1' AS sdi_address, TIMESTAMP '1995-01-01 00:00:00' AS start_timestamp_utc,
          TIMESTAMP '1995-06-01 00:00:00' AS end_timestamp_utc FROM supplier""",
    # Metadata and deployments of a transaction that brings its own: one logger a nation, number 7 not deployed.
    "tx_logger": """
        SELECT n_nationkey AS n, n_regionkey, n_name, CASE WHEN n_nationkey % 5 = 0 THEN CAST(n_nationkey AS STRING)
          ELSE CAST(n_nationkey + 100 AS STRING) END AS code FROM nation""",
}


def needed_inputs(body: str) -> dict[str, str]:
    """The inputs a statement names, directly or through others, in dependency order."""
    needed: dict[str, str] = {}

    def visit(sql: str) -> None:
        for name, text in INPUTS.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql):
                visit(text)
                needed[name] = text

    visit(body)
    return needed


def with_inputs(body: str) -> str:
    """Prefix a statement with the inputs it names."""
    needed = needed_inputs(body)
    if not needed:
        return body
    ctes = ", ".join(f"{name} AS ({text})" for name, text in needed.items())
    stripped = body.lstrip()
    if stripped.upper().startswith("WITH "):
        return f"WITH {ctes}, {stripped[5:]}"
    return f"WITH {ctes} {stripped}"


class Tables:
    """The test tables of one folder as views, and the inputs derived from them."""

    _owner: dict[str, Tables] = {}  # who defined a view last; views are shared by the session

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = prepare(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._frames[name]

    def sql(self, body: str) -> DataFrame:
        """Run a statement over the tables and inputs.

        Inputs become views, not WITH clauses: Spark renumbers the latter in a larger plan,
        and then no longer recognises a cached part of it.
        """
        needed = needed_inputs(body)
        texts = " ".join([*needed.values(), body])
        for name in TABLES:
            if re.search(rf"\b(FROM|JOIN)\s+{name}\b", texts):
                self._view(name, lambda name=name: self.read(name))
        for name, text in needed.items():
            self._view(name, lambda text=text: self.spark.sql(text))
        return self.spark.sql(body)

    def _view(self, name: str, build) -> None:
        if Tables._owner.get(name) is not self:
            build().createOrReplaceTempView(name)
            Tables._owner[name] = self

    def __getitem__(self, name: str) -> DataFrame:
        return self.sql(f"SELECT * FROM {name}")
