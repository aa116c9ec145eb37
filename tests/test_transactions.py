"""Requests that bring their own metadata, recovery of stopped runs, and receipts."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from test_files import context, sensor_file, write

from xylemflow.operators.receipts import receipt_categories, receipt_chunks, receipt_files, receipt_summaries
from xylemflow.plans.transaction import Store, published_outputs, run_transaction, stored_raw_files, stored_receipts
from xylemflow.sources import metadata, rawfiles, tables
from xylemflow.sources.commits import CommitLog, ConcurrentRun

NOW = datetime(2024, 6, 1)
BEGIN = datetime(2024, 1, 1)


def inbox(spark, folder, **files):
    write(folder, **files)
    return rawfiles.scan_raw_files(spark, str(folder)).select("path", "file_hash", "content")


def manifest(spark, addresses="0", parents=True):
    frame = lambda schema, *rows: spark.createDataFrame(list(rows), schema)
    period = "start_timestamp_utc timestamp_ntz"
    added = {
        "deployments": frame(
            f"project_code string, plant_code string, stem_code string, datalogger_code string, sensor_type_code string, sdi_address string, {period}, installation_metadata string",
            *(("P", "PL", "ST", "420", "probe", a, BEGIN, '{"probe_azimuth": 90}') for a in addresses),
        ),
        "parameter_overrides": frame("parameter_code string, value string, site_code string", ("parameter_wood_density_kg_m3", "512", "S")),
    }
    if parents:
        added |= {
            "projects": frame("code string", ("P",)),
            "sites": frame("code string, timezone string", ("S", "America/New_York")),
            "zones": frame("site_code string, name string", ("S", "Z")),
            "plots": frame("site_code string, zone_name string, name string", ("S", "Z", "L")),
            "species": frame("code string, latin_name string", ("SP", '{"genus": "Quercus", "species": "alba"}')),
            "plants": frame("site_code string, zone_name string, plot_name string, species_code string, code string", ("S", "Z", "L", "SP", "PL")),
            "stems": frame("plant_code string, code string, dbh_cm double", ("PL", "ST", 12.5)),
            "datalogger_types": frame("code string", ("CR300",)),
            "dataloggers": frame("datalogger_type_code string, code string", ("CR300", "420")),
            "sensor_types": frame("code string", ("probe",)),
        }
    return added


def test_a_request_is_processed_with_its_own_metadata(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    files = inbox(spark, tmp_path / "in", a=sensor_file(), bad="nope")

    dry = run_transaction(spark, files, None, store, NOW, manifest=manifest(spark), dry_run=True)
    assert (dry.outcome, dry.status, dry.summary.first().total_rows) == ("ACCEPTED", "Success", 6)
    assert not (tmp_path / "store").exists()

    first = run_transaction(spark, files, None, store, NOW, manifest=manifest(spark), run_id="r1")
    assert (first.outcome, first.status) == ("ACCEPTED", "Success")
    rows = spark.read.parquet(first.output_path)
    assert rows.count() == 6 and rows.select("sdi12_address").distinct().collect()[0][0] == "0"
    row = rows.first()
    assert (row.probe_azimuth, row.species_scientific_name, row.site_code, row.stem_code) == ("90", "Quercus alba", "S", "ST")
    assert (row.parameter_wood_density_kg_m3, row.parameter_source_parameter_wood_density_kg_m3) == (512.0, "site_override")

    # The same entries again are refused, and change nothing; a new deployment finds its stored parents.
    refused = run_transaction(spark, files, None, store, NOW, manifest=manifest(spark), run_id="r2")
    kinds = {r.violation for r in refused.violations.collect()}
    assert refused.outcome == "REJECTED" and {"already exists", "overlaps or touches"} <= kinds
    more = inbox(spark, tmp_path / "in2", b=sensor_file(records=(3, 4)))
    second = run_transaction(spark, more, None, store, NOW, manifest=manifest(spark, "1", parents=False), run_id="r3")
    assert (second.outcome, second.status) == ("ACCEPTED", "Success")
    assert spark.read.parquet(second.output_path).count() == 2 * 4
    assert [(r.output_id, r.is_latest) for r in published_outputs(spark, store).orderBy("output_id").collect()] in (
        [("r1", False), ("r3", True)],
    )
    log = store.log(spark)
    counts = [metadata.snapshot(log, v)["deployments"].count() for v in range(3)]
    assert counts == [0, 1, 2]

    documents = stored_receipts(spark, store)
    heads = {r.run_id: r for r in receipt_summaries(documents).collect()}
    assert (heads["r1"].ingestion_summary.parsed, heads["r1"].ingestion_summary.failed) == (1, 1)
    assert heads["r1"].pipeline.status == "success" and heads["r1"].pipeline.row_count == 6
    assert heads["r1"].metadata_summary["stems_added"] == 1 and heads["r3"].metadata_summary["deployments_added"] == 1
    entries = receipt_files(documents).where("run_id = 'r1'")
    statuses = {r.path.rsplit("/", 1)[1]: (r.status, [a.parser for a in r.parser_attempts]) for r in entries.collect()}
    assert statuses["a.dat"] == ("Parsed", []) and statuses["bad.dat"][0] == "Failed" and len(statuses["bad.dat"][1]) == 5
    assert {r.category: r["count"] for r in receipt_categories(entries).collect() if r["count"]} == {"accepted": 1, "other": 1}
    assert receipt_chunks(documents).isEmpty()


class Stopped(Exception):
    pass


def test_a_run_stopped_after_any_write_publishes_once(spark, tmp_path, monkeypatch):
    store = Store(str(tmp_path / "store"))
    files = inbox(spark, tmp_path / "in", a=sensor_file())
    written, stop_after = [], [0]

    def stopping(name, function):
        def call(*args, **more):
            result = function(*args, **more)
            written.append(name)
            if len(written) == stop_after[0]:
                raise Stopped(name)
            return result

        return call

    monkeypatch.setattr(CommitLog, "write", stopping("table", CommitLog.write))
    monkeypatch.setattr(tables, "write_sidecar", stopping("sidecar", tables.write_sidecar))
    stopped = 0
    while True:
        written.clear()
        stop_after[0] = stopped + 1
        try:
            done = run_transaction(spark, files, context(spark), store, NOW, run_id="r")
            break
        except Stopped:
            stopped += 1
            assert published_outputs(spark, store).isEmpty() and stored_receipts(spark, store).isEmpty()
            assert [r.run_id for r in store.log(spark).pending().collect()] == ["r"]
    assert stopped == 5 and (done.outcome, done.status) == ("ACCEPTED", "Success")
    log = store.log(spark)
    assert published_outputs(spark, store).count() == 1 and log.read(store.HASHES, tables.REGISTRY_SCHEMA).count() == 1
    assert log.read(store.RAW, "object_key string, file_hash string").count() == 1

    # An accepted run is not run again; another one finds its files known.
    written.clear()
    again = run_transaction(spark, files, context(spark), store, NOW, run_id="r")
    assert (again.outcome, again.status, written) == ("ACCEPTED", "Success", []) and again.reports.count() == 1
    stop_after[0] = 0
    other = run_transaction(spark, files, context(spark), store, NOW, run_id="other")
    assert (other.outcome, other.status) == ("ACCEPTED", "Skipped") and published_outputs(spark, store).count() == 1
    assert store.recover(spark) == []


def test_what_a_stopped_run_left_is_removed(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    log = store.log(spark)
    log.begin("lost", 0)
    log.write(store.HASHES, "lost", spark.createDataFrame([("h", "lost")], tables.REGISTRY_SCHEMA))
    assert log.read(store.HASHES, tables.REGISTRY_SCHEMA).isEmpty()
    assert store.recover(spark) == ["lost"] and not (tmp_path / "store/registry/raw_files/run=lost").exists()


def test_only_one_of_two_runs_on_a_snapshot_is_accepted(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "store"))
    assert log.version() == 0
    log.commit("a", 0, "ACCEPTED", "Success")
    with pytest.raises(ConcurrentRun):
        log.commit("b", 0, "ACCEPTED", "Success")
    assert log.commit("c", 0, "REJECTED", "Failed") == 2
    assert log.commit("b", 2, "ACCEPTED", "Skipped") == 3
    assert [(r.run_id, r.version) for r in log.accepted().orderBy("version").collect()] == [("a", 1), ("b", 3)]
    assert log.accepted(2).count() == 1


def test_override_of_a_later_transaction_wins(spark):
    rows = spark.createDataFrame(
        [("c", "1", 1, "s"), ("c", "2", 2, "s"), ("c", "3", 1, None)], "parameter_code string, value string, commit_version bigint, sites_id string"
    )
    for name in ("stems_id", "plants_id", "plots_id", "zones_id", "species_id"):
        rows = rows.withColumn(name, F.lit(None).cast("string"))
    assert sorted((r.site_id or "", r.value, r.seq) for r in metadata.overrides_of(rows).collect()) == [("", "3", 1), ("s", "2", 2)]


def test_files_opened_by_path_are_never_shuffled(spark, tmp_path):
    """The same run from keys alone; the plan that parses has no exchange above the opened bytes."""
    write(tmp_path / "in", a=sensor_file(), copy=sensor_file(), bad="nope")
    keys = rawfiles.scan_file_keys(spark, str(tmp_path / "in"))
    opened = rawfiles.open_files(keys)
    assert {r.path.rsplit("/", 1)[1]: bytes(r.content) for r in opened.collect()}["bad.dat"] == b"nope"
    plan = opened._jdf.queryExecution().executedPlan().toString()
    assert "content" not in "".join(line for line in plan.splitlines() if "Exchange" in line)

    store = Store(str(tmp_path / "store"))
    done = run_transaction(spark, keys, context(spark), store, NOW, run_id="r1")
    assert (done.outcome, done.status) == ("ACCEPTED", "Success") and done.error is None
    assert sorted(r.status for r in done.reports.collect()) == ["Duplicate", "Failed", "Parsed"]
    assert spark.read.parquet(done.output_path).count() == 3 * 2
    assert [bytes(r.content) for r in stored_raw_files(spark, store).collect()] == [sensor_file().encode()]


def test_the_bytes_of_a_batch_are_read_once(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def counted(content):
        reads.add(1)
        return content

    files = inbox(spark, tmp_path / "in", a=sensor_file(), bad="nope")
    files = files.withColumn("content", F.udf(counted, "binary")("content"))
    done = run_transaction(spark, files, None, Store(str(tmp_path / "store")), NOW, manifest=manifest(spark), run_id="r")
    assert (done.outcome, done.status, reads.value) == ("ACCEPTED", "Success", 2)
