"""Parsing, ingestion and a whole transaction on files written by the tests."""

import os
import subprocess
import sys
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from xylemflow.operators.flatten import flatten_parsed_files
from xylemflow.plans.processing import Context
from xylemflow.plans.transaction import Store, run_transaction
from xylemflow.sources import rawfiles, tables
from xylemflow.sources.toa5 import SENSOR_SUFFIXES, TABLE_KINDS, TABLE_UNITS, parse_toa5
from xylemflow.streaming.arrivals import arriving_files, start_ingest

TABLE_COLUMNS = (
    "TIMESTAMP,RECORD,BattV_Min,id,SDI0,SapFlwTot0,VhOuter0,VhInner0,AlphaOut0,AlphaIn0,BetaOut0,BetaIn0,tMaxTout0,tMaxTin0"
)


def quoted(cells):
    return ",".join(f'"{c}"' for c in cells)


def sensor_file(records=(0, 1, 2), addresses="01", name="CR300Series_420", table="SapFlowAll", units=None, columns=None):
    columns = columns or ["TIMESTAMP", "RECORD", "Batt_volt", "PTemp_C"] + [
        f"S{a}_{s}" for a in addresses for s in SENSOR_SUFFIXES
    ]
    units = units or ["TS", "RN", "", ""] + [u for _ in addresses for _, _, u in SENSOR_SUFFIXES.values()]
    kinds = ["", "", "Smp", "Smp"] + ["Smp"] * 20 * len(addresses)
    lines = [quoted(["TOA5", name, "CR300", "17", "OS", "CPU:a,b", "9", table]), quoted(columns), quoted(units), quoted(kinds)]
    for r in records:
        cells = [str(r + i / 10) for i in range(20 * len(addresses))]
        lines.append(f'"2024-05-01 0{r}:00:00",{r},12.5,"NAN",' + ",".join(cells))
    return "\r\n".join(lines) + "\r\n"


def table_file(rows, time='"2024-05-01 0{r}:00:00"', kind="CR300", units=None, ids=None):
    lines = [
        quoted(["TOA5", "unit_77", kind, "", "OS", "p", "9", "Table1"]),
        quoted(TABLE_COLUMNS.split(",")),
        quoted(units or TABLE_UNITS),
        quoted(TABLE_KINDS),
    ]
    for n, row in enumerate(rows):
        record, address = row if isinstance(row, tuple) else (row, "0")
        identity = ids[n] if ids else 1
        lines.append(f"{time.format(r=record)},{record},12.1,{identity},{address},3,1,2,0.1,0.2,1.1,1.2,30,-99")
    return "\n".join(lines)


CR200 = ["TS", "RN", "Volts", "", "", "literPerHo"] + ["heatVeloci"] * 2 + ["logTRatio"] * 4 + ["unit"] * 2
SLASH = "5/1/24 0{r}:00"
FILES = {
    "sensors": sensor_file(),
    "three": sensor_file(addresses="01a"),
    "legacy": table_file([0, 1, (2, "X"), 3, 4]),
    "ids": table_file([0, 1, 2], ids=[1, 1, 501]),
    "slash": table_file([1, 2, 5, 3, 4, 6], time=SLASH),
    "cr200": table_file([0, 1, 2], kind="CR200X", units=CR200, ids=["", "NAN", 9]),
    "gap": sensor_file(records=(0, 2)),
    "table": sensor_file(table="Other"),
    "column": sensor_file(columns=["TIMESTAMP", "RECORD", "Batt_volt", "PTemp_C"] + ["S0_Nope"] * 40),
    "units": sensor_file(units=["TS", "RN", "", ""] + ["furlong"] * 40),
    "empty": sensor_file(records=()),
    "down": table_file([3, 2]),
    "conflict": table_file([0, 1, 2], ids=[7, 1, 501]),
    "text": "hello\nworld",
}


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [(name, bytearray(text.encode()), name) for name, text in FILES.items()]
    rows.append(("binary", bytearray(b"\xff\xfe\x00"), "binary"))
    files = spark.createDataFrame(rows, "path string, content binary, file_hash string")
    return parse_toa5(files).persist()


def test_dialects_and_faults(parsed):
    got = {r.path: (r.parser, r.logger_id, r.first_error_line) for r in parsed.collect()}
    assert got == {
        "sensors": ("sapflow_all_v1", "420", None),
        "three": ("sapflow_all_v1", "420", None),
        "legacy": ("cr300_legacy_table_v1", "1", None),
        "ids": ("cr300_legacy_table_v1", "501", None),
        "slash": ("cr300_hx_v1", "1", None),
        "cr200": ("cr200_table_v1", "9", None),
        "gap": (None, None, 6),
        "table": (None, None, None),
        "column": (None, None, None),
        "units": (None, None, 3),
        "empty": (None, None, None),
        "down": (None, None, 6),
        "conflict": (None, None, None),
        "text": (None, None, None),
        "binary": (None, None, None),
    }


def test_kept_records(parsed):
    rows = parsed.where("status = 'Parsed'").select("path", "rows.record").collect()
    got = {r.path: r.record for r in rows}
    assert got["legacy"] == [0, 1, 3, 4]
    assert got["slash"] == [1, 2, 3, 4]
    assert got["sensors"] == [0, 1, 2]


def test_attempts_name_refusing_dialects(parsed):
    attempts = {r.path: [(a.parser, a.line_index) for a in r.parser_attempts] for r in parsed.collect()}
    assert attempts["sensors"] == []
    assert attempts["binary"] == [("utf8", None)]
    assert [p for p, _ in attempts["cr200"]] == [
        "sapflow_all_v1", "cr300_hx_v1", "cr300_legacy_table_v1", "cr300_table_v1"
    ]


def test_flatten_counts_and_values(parsed):
    flat = flatten_parsed_files(parsed)
    counts = {r.file_hash: r["count"] for r in flat.groupBy("file_hash").count().collect()}
    assert counts["sensors"] == 3 * 2 * 2 and counts["three"] == 3 * 3 * 2
    row = flat.where("file_hash = 'sensors' AND record = 1 AND sdi12_address = '1' AND thermistor_depth = 'inner'").first()
    assert (row.alpha, row.beta, row.post_pulse_temp_upstream_c) == (3.1, 3.3, 4.7)
    assert row.panel_temperature_c is None and row.timestamp == datetime(2024, 5, 1, 1)
    table = flat.where("file_hash = 'legacy' AND thermistor_depth = 'inner'").first()
    assert table.time_to_max_temp_downstream_s is None and table.alpha == 0.2  # -99 is null


def write(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.dat").write_bytes(text.encode())


def context(spark):
    sites = spark.createDataFrame([("s", "America/New_York")], "site_id string, timezone string")
    names = [
        "deployment_id", "datalogger_id", "sdi_address", "project_id", "site_id", "zone_id", "plot_id", "plant_id",
        "species_id", "stem_id", "project_code", "project_name", "site_code", "site_name", "zone_name", "plot_name",
        "plant_code", "stem_code", "species_code", "species_scientific_name", "installation_metadata", "timezone",
    ]
    rows = [
        (f"d{a}", "420", a, "p", "s", "z", "l", "pl", "sp", "st", "P", None, "S", "Site", "Z", "L", "PL", "ST", "SP",
         "Genus species", '{"probe_azimuth": 180}', "America/New_York", datetime(2024, 1, 1), None)
        for a in "0"
    ]
    schema = ", ".join(f"{n} string" for n in names) + (
        ", deployment_start_timestamp_utc timestamp_ntz, deployment_end_timestamp_utc timestamp_ntz"
    )
    return Context(sites, spark.createDataFrame(rows, schema))


def test_transaction_publishes_once(spark, tmp_path):
    inbox = tmp_path / "in"
    write(inbox, a=sensor_file(), copy=sensor_file(), bad="nope")
    files = rawfiles.scan_raw_files(spark, str(inbox)).select("path", "file_hash", "content")
    store = Store(str(tmp_path / "store"))
    now = datetime(2024, 6, 1)

    dry = run_transaction(spark, files, context(spark), store, now, dry_run=True)
    assert (dry.outcome, dry.status, dry.output_path) == ("ACCEPTED", "Success", None)
    assert not (tmp_path / "store").exists()

    first = run_transaction(spark, files, context(spark), store, now, run_id="r1")
    assert first.error is None and first.outcome == "ACCEPTED"
    statuses = sorted(r.status for r in first.reports.collect())
    assert statuses == ["Duplicate", "Failed", "Parsed"]
    out = tables.scan_observations(spark, first.output_path)
    assert out.count() == 3 * 2  # address 1 has no deployment
    assert out.first().probe_azimuth == "180"
    summary = first.summary.first()
    assert (summary.total_rows, summary.excluded_rows_no_deployment) == (6, 6)

    again = run_transaction(spark, files, context(spark), store, now, run_id="r2")
    assert (again.outcome, again.status) == ("ACCEPTED", "Skipped")
    registry = spark.read.parquet(store.hashes)
    assert registry.count() == 1
    outputs = tables.registered_outputs(spark.read.parquet(store.outputs)).collect()
    assert [(r.output_id, r.is_latest) for r in outputs] == [("r1", True)]


def test_overlapping_deployments_fail_the_run_with_a_receipt(spark, tmp_path):
    inbox = tmp_path / "in"
    write(inbox, a=sensor_file())
    files = rawfiles.scan_raw_files(spark, str(inbox)).select("path", "file_hash", "content")
    store = Store(str(tmp_path / "store"))
    plain = context(spark)
    twice = plain.deployments.unionByName(plain.deployments.withColumn("deployment_id", F.lit("other")))
    failed = run_transaction(spark, files, Context(plain.sites, twice), store, datetime(2024, 6, 1), run_id="r1")
    assert (failed.outcome, failed.status) == ("REJECTED", "Failed") and "ambiguous deployment" in failed.error
    receipt = spark.read.json(store.receipt("r1")).first()
    assert receipt.status == "Failed" and "ambiguous deployment" in receipt.error
    assert not (tmp_path / "store" / "registry").exists()


def test_empty_request_is_refused(spark, tmp_path):
    files = spark.createDataFrame([], "path string, file_hash string, content string")
    with pytest.raises(ValueError, match="at least one file"):
        run_transaction(spark, files, context(spark), Store(str(tmp_path / "store")), datetime(2024, 6, 1))


def test_streamed_files_are_ingested_once(spark, tmp_path):
    inbox = tmp_path / "in"
    write(inbox, a=sensor_file())
    folders = [str(tmp_path / n) for n in ("registry", "observations", "reports", "checkpoint")]

    def drain():
        start_ingest(arriving_files(spark, str(inbox)), *folders, "first").awaitTermination(120)

    drain()
    write(inbox, b=sensor_file(), c=sensor_file(records=(3, 4)))
    drain()
    observations = spark.read.parquet(folders[1])
    assert sorted(r.record for r in observations.select("record").distinct().collect()) == [0, 1, 2, 3, 4]
    assert observations.count() == 5 * 4
    reports = spark.read.parquet(folders[2]).groupBy("status").agg(F.count("*").alias("n")).collect()
    assert {r.status: r.n for r in reports} == {"Parsed": 2, "Duplicate": 1}


def test_a_new_checkpoint_keeps_what_an_earlier_one_wrote(spark, tmp_path):
    inbox = tmp_path / "in"
    registry, observations, reports = (str(tmp_path / n) for n in ("registry", "observations", "reports"))
    for turn, records in enumerate([(0, 1, 2), (3, 4)]):
        write(inbox, **{f"f{turn}": sensor_file(records=records)})
        start_ingest(
            arriving_files(spark, str(inbox)), registry, observations, reports, str(tmp_path / f"checkpoint{turn}"), f"s{turn}"
        ).awaitTermination(120)
    found = spark.read.parquet(observations).select("record").distinct().collect()
    assert sorted(r.record for r in found) == [0, 1, 2, 3, 4]
    statuses = spark.read.parquet(reports).where("stream = 's1'").groupBy("status").count().collect()
    assert {r["status"]: r["count"] for r in statuses} == {"Parsed": 1, "Duplicate": 1}


WORKER = """
import sys
sys.path.insert(0, sys.argv[1])
from check_queries import session
sys.path.insert(0, sys.argv[2])
from xylemflow.session import prepare
from xylemflow.sources.rawfiles import open_files
spark = prepare(session("1"))
keys = spark.createDataFrame([(sys.argv[3], "h", 3)], "path string, file_hash string, length long")
assert open_files(keys).first().content == b"abc"
"""


def test_workers_find_the_package(tmp_path):
    """A driver that has the package on its own path only, in another folder, as a cluster sees it."""
    (tmp_path / "data").write_bytes(b"abc")
    tests = os.path.dirname(os.path.abspath(__file__))
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run(
        [sys.executable, "-c", WORKER, tests, os.path.dirname(tests), str(tmp_path / "data")], cwd=tmp_path, env=clean, check=True, timeout=200
    )
