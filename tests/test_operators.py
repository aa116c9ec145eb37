"""Operator behaviour on small literal frames."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from xylemflow.functions.ordered import global_index, previous_value, running_max_before
from xylemflow.functions.times import local_to_utc_offset
from xylemflow.operators import dma, enrich, explore, flatten, manifest, parameters, quality, timestamps
from xylemflow.schema import PARAMETERS, SCOPE_COLUMNS, Parameter

OBS = "logger_id string, record bigint, timestamp timestamp_ntz, file_hash string, sdi12_address string, thermistor_depth string"


def at(text):
    return datetime.fromisoformat(text)


def offsets(spark, zone, text):
    df = spark.createDataFrame([(zone, at(text))], "zone string, ts timestamp_ntz")
    return df.select(local_to_utc_offset(F.col("zone"), F.col("ts"))).first()[0]


@pytest.mark.parametrize(
    "zone, local, expected",
    [
        ("America/New_York", "2024-07-01 12:00:00", -4 * 3600),
        ("America/New_York", "2024-11-03 01:30:00", -4 * 3600),  # ambiguous: larger offset
        ("America/New_York", "2024-03-10 02:30:00", 0),  # gap
        ("Asia/Tokyo", "2024-03-10 02:30:00", 9 * 3600),
        ("UTC", "2024-03-10 02:30:00", 0),
    ],
)
def test_offsets(spark, zone, local, expected):
    assert offsets(spark, zone, local) == expected


def corrected(spark, rows, deployments, with_previous=False):
    obs = spark.createDataFrame(rows, OBS)
    sites = spark.createDataFrame([("s", "America/New_York")], "site_id string, timezone string")
    dep = spark.createDataFrame(
        deployments,
        "datalogger_id string, site_id string, deployment_id string, start_timestamp_local timestamp_ntz, "
        "end_timestamp_local timestamp_ntz",
    )
    return timestamps.correct_timestamps(obs, sites, dep, with_previous=with_previous)


def test_copies_share_signature_and_are_kept(spark):
    rows = [("L", 1, at("2024-07-01 00:00:00"), h, "0", "inner") for h in ("b", "a")]
    result = corrected(spark, rows, [("L", "s", "d", at("2024-01-01"), None)])
    out = result.observations.collect()
    assert [r.file_set_signature for r in out] == ["a+b", "a+b"]
    assert {r.timestamp_utc for r in out} == {at("2024-07-01 04:00:00")}
    assert result.skipped_chunks.count() == 0


def test_chunk_without_deployment_is_skipped(spark):
    rows = [("L", 1, at("2024-07-01 00:00:00"), "a", "0", "inner")]
    result = corrected(spark, rows, [("L", "s", "d", at("2024-08-01"), None)])
    assert result.observations.count() == 0
    skipped = result.skipped_chunks.collect()
    assert [(r.logger_id, r.row_count, r.reason) for r in skipped] == [("L", 1, "no_active_deployment")]


def test_offset_of_the_anchor_holds_for_the_chunk(spark):
    rows = [("L", i, at("2024-03-09 12:00:00") + timedelta(days=i), "a", "0", "inner") for i in range(3)]
    out = corrected(spark, rows, [("L", "s", "d", at("2024-01-01"), None)]).observations.collect()
    assert {(r.timestamp_utc - r.timestamp) for r in out} == {timedelta(hours=5)}


def test_observation_without_record_is_an_error(spark):
    rows = [("L", None, at("2024-07-01 00:00:00"), "a", "0", "inner")]
    with pytest.raises(Exception, match="observation without record"):
        corrected(spark, rows, [("L", "s", "d", at("2024-01-01"), None)]).observations.collect()


@pytest.mark.parametrize("bits", [0, 2, 16])
def test_previous_value_equals_plain_order(spark, bits):
    rng = random.Random(bits)
    rows = [
        (rng.choice("aab"), position, rng.choice([None, rng.randint(0, 9)]))
        for position in rng.sample(range(-50, 200), 120)
    ]
    df = spark.createDataFrame(rows, "k string, p bigint, v int")
    got = previous_value(df, ["k"], F.col("p"), ["p"], "v", "prev", bucket_bits=bits).collect()
    last, expected = {}, {}
    for k, p, v in sorted(rows, key=lambda r: r[1]):
        expected[(k, p)] = last.get(k)
        last[k] = v
    assert {(r.k, r.p): r.prev for r in got} == expected


def test_running_max_before(spark):
    rng = random.Random(7)
    rows = [("k", p, rng.randint(0, 99)) for p in rng.sample(range(100), 60)]
    df = spark.createDataFrame(rows, "k string, p bigint, v int")
    got = running_max_before(df, ["k"], F.col("p"), ["p"], "v", "top", bucket_bits=3).collect()
    expected, top = {}, None
    for _, p, v in sorted(rows, key=lambda r: r[1]):
        expected[p] = top
        top = v if top is None else max(top, v)
    assert {r.p: r.top for r in got} == expected


def test_global_index(spark):
    rows = [(i * 7919 % 1000, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(5)
    got = {(r.a, r.b): r.row_nr for r in global_index(df, ["a", "b"]).collect()}
    assert got == {key: n for n, key in enumerate(sorted(rows))}


def inputs(spark, **changes):
    row = {"alpha": 0.4, "beta": 0.5, "time_to_max_temp_downstream_s": 40.0} | changes
    schema = "alpha double, beta double, time_to_max_temp_downstream_s double"
    df = spark.createDataFrame([tuple(row[k] for k in ("alpha", "beta", "time_to_max_temp_downstream_s"))], schema)
    return dma.apply_dma_peclet(parameters.with_defaults(df)).first()


def test_heat_ratio_closed_form(spark):
    row = inputs(spark)
    vh = 2 * 0.002409611 * 0.4 / 1.2 * 3600
    vc = 1.8905 * vh
    flux = vc * 500.0 * (1000.0 + 4182.0) / (1000.0 * 4182.0)
    assert row.calculation_method_used == "HRM"
    assert math.isclose(row.vh_hrm_cm_hr, vh, rel_tol=1e-12)
    assert math.isclose(row.sap_flux_density_j_dma_cm_hr, flux, rel_tol=1e-9)


def test_time_to_max_closed_form(spark):
    row = inputs(spark, beta=1.5)
    inside = 4 * 0.002409611 / 3 * math.log(1 - 3 / 40) + 0.36
    vh = math.sqrt(inside) / (40 * 37) * 3600
    assert row.calculation_method_used == "Tmax"
    assert math.isclose(row.vh_tmax_cm_hr, vh, rel_tol=1e-12)


def test_peak_inside_pulse_and_missing_alpha(spark):
    early = inputs(spark, beta=1.5, time_to_max_temp_downstream_s=3.0)
    assert early.vh_tmax_cm_hr is None and early.sap_flux_density_j_dma_cm_hr is None
    assert early.calculation_method_used == "Tmax" and early.vh_hrm_cm_hr is not None
    missing = inputs(spark, alpha=None)
    assert missing.calculation_method_used is None and missing.vh_tmax_cm_hr is None


def override(seq, code, value, **scopes):
    return (seq, code, value, *[scopes.get(c) for c in SCOPE_COLUMNS])


def test_override_precedence_ties_and_bad_values(spark):
    schema = "seq bigint, code string, value string, " + ", ".join(f"{c} string" for c in SCOPE_COLUMNS)
    overrides = spark.createDataFrame(
        [
            override(1, "x", "1.5", site_id="A"),
            override(2, "x", "2.5", site_id="A"),
            override(3, "x", "3.5", stem_id="S"),
            override(4, "x", "4.5", stem_id="S", site_id="B"),
            override(5, "x", '"7.5f"', deployment_id="D"),
        ],
        schema,
    )
    scopes = spark.createDataFrame(
        [("A", None, None), ("A", "S", None), ("B", "S", None), ("A", "S", "D"), (None, None, None)],
        "site_id string, stem_id string, deployment_id string",
    )
    out = parameters.resolve_parameters(scopes, overrides, [Parameter("x", "float", 9.0)])
    got = {(r.site_id, r.stem_id, r.deployment_id): (r.x, r.parameter_source_x) for r in out.collect()}
    assert got == {
        ("A", None, None): (1.5, "site_override"),
        ("A", "S", None): (3.5, "stem_override"),
        ("B", "S", None): (3.5, "stem_override"),
        ("A", "S", "D"): (None, "deployment_override"),
        (None, None, None): (9.0, "default"),
    }


def test_definitions_include_quality_thresholds():
    assert {p.code: p.default for p in PARAMETERS}["quality_future_lead_minutes"] == 5.0
    assert len(PARAMETERS) == 18


def graded(spark, rows):
    base = datetime(2025, 1, 1)
    schema = (
        "logger_id string, sdi12_address string, record bigint, timestamp_utc timestamp_ntz, "
        "deployment_start_timestamp_utc timestamp_ntz, deployment_end_timestamp_utc timestamp_ntz, "
        "sap_flux_density_j_dma_cm_hr double"
    )
    df = spark.createDataFrame(rows, schema).withColumns(
        {
            "quality_deployment_start_grace_minutes": F.lit(0.0),
            "quality_deployment_end_grace_minutes": F.lit(0.0),
            "quality_future_lead_minutes": F.lit(5.0),
            "quality_gap_years": F.lit(0.01),
            "quality_max_flux_cm_hr": F.lit(20.0),
            "quality_min_flux_cm_hr": F.lit(-10.0),
        }
    )
    out = quality.apply_quality_filters(df, base + timedelta(days=30)).collect()
    return {r.record: r.quality_explanation for r in out}


def test_each_quality_rule(spark):
    base = datetime(2025, 1, 1)
    day = timedelta(days=1)
    rows = [
        ("L", "0", 1, base, base, None, 5.0),
        ("L", "0", 2, base - timedelta(minutes=1), base, None, 5.0),
        ("L", "0", 3, base + day, base, base + timedelta(hours=1), 5.0),
        ("L", "0", 4, base + 40 * day, base, base + 90 * day, 5.0),
        ("M", "0", 5, base, base, None, 30.0),
        ("M", "0", 6, base, base, None, -20.0),
        ("M", "0", 7, base, base, None, float("nan")),
        ("L", "0", 8, base + 40 * day - timedelta(days=50), None, base + 90 * day, 5.0),
    ]
    got = graded(spark, rows)
    assert got[1] is None and got[7] is None
    assert got[2] == "timestamp_before_deployment"
    assert got[3] == "timestamp_after_deployment"
    assert got[4] == "timestamp_future|record_gap_gt_quality_gap_years"
    assert got[5] == "sap_flux_density_above_quality_max_flux_cm_hr"
    assert got[6] == "sap_flux_density_below_quality_min_flux_cm_hr"
    assert got[8] == "timestamp_before_first_deployment|record_gap_gt_quality_gap_years"


def test_record_gap_follows_record_order(spark):
    base = datetime(2025, 1, 1)
    far = base + timedelta(days=20)
    rows = [
        ("L", "0", 11, far, base, None, 1.0),
        ("L", "0", 9, base, base, None, 1.0),
        ("L", "0", 10, base + timedelta(minutes=1), base, None, 1.0),
    ]
    got = graded(spark, rows)
    assert got[11] == "record_gap_gt_quality_gap_years" and got[10] is None and got[9] is None


def test_stack_refuses_other_columns(spark):
    a = spark.createDataFrame([(1,)], "a int")
    b = spark.createDataFrame([(1,)], "b int")
    with pytest.raises(ValueError, match="differs"):
        flatten.stack(a, b)


def test_ambiguous_deployments_are_reported(spark):
    dep = spark.createDataFrame(
        [("L", "0", "d1", at("2024-01-01"), None), ("L", "0", "d2", at("2024-02-01"), None)],
        "datalogger_id string, sdi_address string, deployment_id string, "
        "deployment_start_timestamp_utc timestamp_ntz, deployment_end_timestamp_utc timestamp_ntz",
    )
    obs = spark.createDataFrame(
        [("L", "0", at("2024-01-15")), ("L", "0", at("2024-02-15"))],
        "logger_id string, sdi12_address string, timestamp_utc timestamp_ntz",
    )
    found = enrich.ambiguous_matches(obs, dep).collect()
    assert [(r.timestamp_utc, r.matches) for r in found] == [(at("2024-02-15"), 2)]
    with pytest.raises(ValueError, match="ambiguous deployment"):
        enrich.assert_unambiguous(obs, dep)
    assert {r.name for r in enrich.overlapping_intervals(dep).collect()} == {"L"}
    assert enrich.overlapping_intervals(dep.where("deployment_id = 'd1'")).isEmpty()


def test_manifest_accepts_children_of_added_parents_and_refuses_touching_intervals(spark):
    adds = {
        "sites": spark.createDataFrame([("S", "Europe/Paris", None)], "code string, timezone string, boundary string"),
        "zones": spark.createDataFrame([("S", "Z", None)], "site_code string, name string, boundary string"),
    }
    assert manifest.validate_manifest(adds, {}).count() == 0
    bad = {
        "sites": spark.createDataFrame([("", "Mars/Base", "{}")], "code string, timezone string, boundary string"),
        "zones": spark.createDataFrame([("X", "Z", None)], "site_code string, name string, boundary string"),
    }
    kinds = sorted(r.violation for r in manifest.validate_manifest(bad, {}).collect())
    assert kinds == ["boundary is not a Polygon", "empty code", "invalid timezone", "missing sites"]
    touching = spark.createDataFrame(
        [("a", at("2024-01-01"), at("2024-02-01")), ("a", at("2024-02-01"), None), ("b", at("2024-01-01"), None)],
        "alias string, start_timestamp_utc timestamp_ntz, end_timestamp_utc timestamp_ntz",
    )
    found = manifest.overlapping_intervals(touching, ["alias"]).collect()
    assert [(r.alias, r.start_timestamp_utc) for r in found] == [("a", at("2024-02-01"))]


def test_downsample_keeps_small_frames_whole(spark):
    df = spark.createDataFrame([(at("2024-01-01"), i) for i in range(10)], "timestamp timestamp_ntz, record bigint")
    assert explore.downsampled(df, 10).count() == 10
    assert explore.downsampled(df, 4).count() == 4  # stride 3: rows 0, 3, 6, 9
    assert explore.downsampled(df, 10, with_index=False) is df
    assert explore.downsampled(df, 4, with_index=False).count() == 4


def test_unknown_site_is_an_error(spark):
    from xylemflow.operators.timestamps import local_deployments

    sites = spark.createDataFrame([("s", "UTC")], "site_id string, timezone string")
    deployments = spark.createDataFrame(
        [("L", "gone", "d", at("2024-01-01"), None)],
        "datalogger_id string, site_id string, deployment_id string, "
        "deployment_start_timestamp_utc timestamp_ntz, deployment_end_timestamp_utc timestamp_ntz",
    )
    with pytest.raises(Exception, match="site not found: gone"):
        local_deployments(deployments, sites).collect()


def test_first_starts_of_sensors_are_read_off_the_record_map(spark):
    """Without observations at hand, by alias too; records outside every deployment count for nothing."""
    day = lambda n: datetime(2024, 1, n)
    deployments = spark.createDataFrame(
        [("a", "0", day(5), day(10), "d2"), ("a", "0", day(2), day(4), "d1"), ("a", "1", day(1), None, "d3"), ("b", "0", day(20), None, "d4")],
        "datalogger_id string, sdi_address string, deployment_start_timestamp_utc timestamp_ntz, deployment_end_timestamp_utc timestamp_ntz, deployment_id string",
    )
    aliases = spark.createDataFrame(
        [("old", "a", day(6), None)], "alias string, datalogger_id string, start_timestamp_utc timestamp_ntz, end_timestamp_utc timestamp_ntz"
    )
    rows = [(lg, n, day(n), f, s) for lg, n, f, s in [("a", 3, "f", "1"), ("a", 6, "f", "0"), ("a", 6, "g", "1"), ("a", 12, "f", "0"), ("old", 7, "h", "0"), ("b", 9, "f", "0"), ("a", 8, "f", None)]]
    observations = spark.createDataFrame(rows, "logger_id string, record long, timestamp timestamp_ntz, file_hash string, sdi12_address string").withColumn(
        "thermistor_depth", F.lit("inner")
    )
    records = timestamps.record_map(observations, with_head=True, with_addresses=True)
    offsets = records.select("logger_id", "file_set_signature", F.lit(0).alias("utc_offset_seconds")).distinct()
    got = {tuple(r) for r in quality.first_starts(timestamps.sensor_times(records, offsets), deployments, aliases).collect()}
    assert got == {("a", "1", day(1)), ("a", "0", day(5)), ("old", "0", day(5))}
    timed = timestamps.attach_utc(observations, records, offsets)
    assert timestamps.ADDRESSES not in timed.columns
    full = enrich.enrich_with_metadata(timed, deployments, aliases, ["deployment_start_timestamp_utc"])
    assert got == {tuple(r) for r in quality.earliest_deployments(full).collect()}
