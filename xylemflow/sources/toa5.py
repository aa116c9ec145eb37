"""TOA5 text files of five header dialects to nested rows, in one narrow pass.

A file is one input row and stays in its task: header rows are classified first, and only
files with an accepted header have their data lines split, checked and typed, with array
expressions. Nothing is shuffled; a file is bounded by the binary reader's 2 GB limit.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from xylemflow.functions import values as V
from xylemflow.schema import METRIC_COLUMNS
from xylemflow.sources.rawfiles import decoded

HEADER_ROWS = 4
IGNORED_METRIC = len(METRIC_COLUMNS)  # logger-derived velocity: checked, then dropped

# --- Fixed values: column spellings, units and measurement kinds of the dialects ----------
LOGGER_SPELLINGS = {
    "timestamp": "timestamp",
    "record": "record",
    "batt_volt": "battery",
    "battv": "battery",
    "battv_min": "battery",
    "ptemp_c": "panel",
    "id": "id",
}

# suffix: (depth, metric, unit), in the order the columns of one sensor must have
SENSOR_SUFFIXES = {
    "alpout": ("outer", "alpha", "ratio"),
    "alpinn": ("inner", "alpha", "ratio"),
    "betout": ("outer", "beta", "ratio"),
    "betinn": ("inner", "beta", "ratio"),
    "tmxtout": ("outer", "time_to_max_temp_downstream_s", "sec"),
    "tmxtinn": ("inner", "time_to_max_temp_downstream_s", "sec"),
    "tpdsout": ("outer", "pre_pulse_temp_downstream_c", "degC"),
    "dtdsout": ("outer", "max_temp_rise_downstream_c", "degC"),
    "tsdsout": ("outer", "post_pulse_temp_downstream_c", "degC"),
    "tpusout": ("outer", "pre_pulse_temp_upstream_c", "degC"),
    "dtusout": ("outer", "max_temp_rise_upstream_c", "degC"),
    "tsusout": ("outer", "post_pulse_temp_upstream_c", "degC"),
    "tpdsinn": ("inner", "pre_pulse_temp_downstream_c", "degC"),
    "dtdsinn": ("inner", "max_temp_rise_downstream_c", "degC"),
    "tsdsinn": ("inner", "post_pulse_temp_downstream_c", "degC"),
    "tpusinn": ("inner", "pre_pulse_temp_upstream_c", "degC"),
    "dtusinn": ("inner", "max_temp_rise_upstream_c", "degC"),
    "tsusinn": ("inner", "post_pulse_temp_upstream_c", "degC"),
    "tmxtuso": ("outer", "time_to_max_temp_upstream_s", "sec"),
    "tmxtusi": ("inner", "time_to_max_temp_upstream_s", "sec"),
}

# base: (depth, metric or None for the dropped velocity, dialects that know it)
TABLE_BASES = {
    "vhouter": ("outer", None, "hx legacy table cr200"),
    "vhout": ("outer", None, "hx table cr200"),
    "vhinner": ("inner", None, "hx legacy table cr200"),
    "vhin": ("inner", None, "hx table cr200"),
    "alphaout": ("outer", "alpha", "hx legacy table cr200"),
    "alphout": ("outer", "alpha", "hx"),
    "alphaouter": ("outer", "alpha", "table"),
    "alphain": ("inner", "alpha", "hx legacy table cr200"),
    "alphinn": ("inner", "alpha", "hx"),
    "alphainner": ("inner", "alpha", "table"),
    "betaout": ("outer", "beta", "hx legacy table cr200"),
    "betout": ("outer", "beta", "hx"),
    "betaouter": ("outer", "beta", "table"),
    "betain": ("inner", "beta", "hx legacy table cr200"),
    "betinn": ("inner", "beta", "hx"),
    "betainner": ("inner", "beta", "table"),
    "tmaxtout": ("outer", "time_to_max_temp_downstream_s", "hx legacy table cr200"),
    "tmxtout": ("outer", "time_to_max_temp_downstream_s", "hx table"),
    "tmaxtin": ("inner", "time_to_max_temp_downstream_s", "hx legacy table cr200"),
    "tmxtin": ("inner", "time_to_max_temp_downstream_s", "hx table"),
}
TOTAL_BASE = "sapflwtot"

TABLE_UNITS = [
    "TS",
    "RN",
    "Volts",
    "",
    "",
    "literPerHour",
    "heatVelocity",
    "heatVelocity",
    "logTRatio",
    "logTRatio",
    "logTRatio",
    "logTRatio",
    "second",
    "second",
]
CR200_UNITS = [
    "unit",
    "UNIT",
    "literPerHour",
    "literPerHo",
    "heatVelocity",
    "heatVeloci",
    "logTRatio",
    "second",
]
CR200_FREE_FROM = 5  # the first column that may carry any of CR200_UNITS
TABLE_KINDS = [""] * 2 + ["Min"] + ["Smp"] * 11
# --- End of fixed values ------------------------------------------------------------------


@dataclass(frozen=True)
class Dialect:
    key: str
    code: str


# Tried in this order; the first that accepts a file wins.
DIALECTS = [
    Dialect("all", "sapflow_all_v1"),
    Dialect("hx", "cr300_hx_v1"),
    Dialect("legacy", "cr300_legacy_table_v1"),
    Dialect("table", "cr300_table_v1"),
    Dialect("cr200", "cr200_table_v1"),
]

METADATA_FIELDS = [
    "file_format",
    "logger_name",
    "logger_type",
    "serial_number",
    "os_version",
    "program_name",
    "signature",
    "table_name",
]

# Fields of a typed data line before the consecutive rule is applied
ROW_FIELDS = [
    "line",
    "width",
    "time",
    "standard",
    "record",
    "id",
    "id_value",
    "bad_logger",
    "bad_total",
    "bad_metric",
    "wrong_address",
    "cells",
]

UTF8_ATTEMPT = ("utf8", "file contents were not valid UTF-8")
DEFAULT_ID = "1"


def _fenced(df: DataFrame) -> DataFrame:
    """Evaluate the columns here, once.

    A one-element generator: later filters are not pushed through it, so that the optimizer
    cannot copy a file-wide array expression into every place that mentions its result.
    """
    return df.select(F.inline_outer(F.array(F.struct(*[F.col(c) for c in df.columns]))))


def tokens(line: Column) -> Column:
    """Cells of a comma-separated line; quoted cells may hold commas and doubled quotes."""
    plain = F.split(line, ",", -1)
    unquoted = F.split(F.translate(line, '"', ""), ",", -1)
    hard = F.regexp_replace(line, '"[^",]*"', "").contains('"')
    cells = F.regexp_extract_all(line, F.lit(r'(?:^|,)("[^"]*(?:""[^"]*)*"|[^,]*)'), F.lit(1))
    peeled = F.transform(
        cells,
        lambda c: F.when(
            c.startswith('"') & c.endswith('"') & (F.length(c) >= 2),
            F.replace(c.substr(F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"')),
        ).otherwise(c),
    )
    return F.when(~line.contains('"'), plain).when(~hard, unquoted).otherwise(peeled)


ROLE_TYPE = (
    "struct<kind: string, address: string, depth: string, metric: int, step: int, unit: string, "
    "dialects: array<string>>"
)


def _lookup(table: dict, value_type: str, key: Column) -> Column:
    """Value of a key in a constant table (folded to one literal by the optimizer)."""
    constant = F.from_json(F.lit(json.dumps(table)), f"map<string, {value_type}>")
    return F.try_element_at(constant, key)


def _role(
    kind: str,
    depth: str | None = None,
    metric: str | None = None,
    step: int | None = None,
    unit: str | None = None,
    dialects: str = "all hx legacy table cr200",
) -> dict:
    place = None
    if kind == "metric":
        place = IGNORED_METRIC if metric is None else METRIC_COLUMNS.index(metric)
    return {
        "kind": kind,
        "depth": depth,
        "metric": place,
        "step": step,
        "unit": unit,
        "dialects": dialects.split(),
    }


def column_role(header: Column) -> Column:
    """Meaning of one header cell, with the dialects that accept it; null if none does."""
    name = F.trim(header)
    logger = _lookup({k: _role(v) for k, v in LOGGER_SPELLINGS.items()}, ROLE_TYPE, F.lower(name))

    sensor = r"^S([0-9A-Za-z])_(.*)$"
    suffixes = {
        k: _role("metric", depth, metric, step, unit, "all")
        for step, (k, (depth, metric, unit)) in enumerate(SENSOR_SUFFIXES.items())
    }
    by_suffix = _lookup(suffixes, ROLE_TYPE, F.lower(F.regexp_extract(name, sensor, 2))).withField(
        "address", F.regexp_extract(name, sensor, 1)
    )

    trailing = r"^(.*)([0-9A-Za-z])$"
    bases = {
        k: _role("metric", depth, metric, dialects=dialects)
        for k, (depth, metric, dialects) in TABLE_BASES.items()
    }
    bases[TOTAL_BASE] = _role("total", dialects="hx legacy table cr200")
    bases["sdi"] = _role("address", dialects="hx legacy table cr200")
    bases["sensoraddress"] = _role("address", dialects="legacy table cr200")
    base = F.lower(F.regexp_extract(name, trailing, 1))
    # Address columns may carry any ending after their first word.
    stem = F.when(base.startswith("sdi"), "sdi").when(
        base.startswith("sensoraddress"), "sensoraddress"
    )
    by_base = _lookup(bases, ROLE_TYPE, F.coalesce(stem, base)).withField(
        "address", F.regexp_extract(name, trailing, 2)
    )
    return F.coalesce(logger, by_suffix, by_base)


def _ends_mid_run(sensors: Column) -> Column:
    """True unless sensor columns come in full, ordered, adjacent runs, one per address."""
    width = len(SENSOR_SUFFIXES)
    broken = F.exists(
        F.transform(
            sensors,
            lambda s, i: (s["role"]["step"] == i % width)
            & (s["role"]["address"] == F.get(sensors, i - i % width)["role"]["address"])
            & (s["at"] - F.get(sensors, i - i % width)["at"] == i % width),
        ),
        lambda ok: ~ok,
    )
    addresses = F.array_distinct(F.transform(sensors, lambda s: s["role"]["address"]))
    return broken | (F.size(sensors) != F.size(addresses) * width)


def _header_verdicts(df: DataFrame) -> DataFrame:
    """Add per dialect ``header_<key>``: null accepted, 0 rejected, else the faulty header row."""
    n = F.size("columns")
    complete = F.col("characteristics").isNotNull() & F.col("columns").isNotNull()
    toa5 = (F.size("meta") >= 8) & (F.lower(F.get("meta", F.lit(0))) == "toa5")
    kind = F.lower(F.get("meta", F.lit(2)))
    table = F.lower(F.get("meta", F.lit(7)))
    even = (F.size("units") == n) & (F.size("characteristics") == n)

    def known(key: str) -> Column:
        return F.forall(
            "roles", lambda r: F.coalesce(F.array_contains(r["dialects"], key), F.lit(False))
        )

    zipped = F.arrays_zip("roles", "units", "characteristics")
    unit_ok = F.forall(
        zipped,
        lambda z: F.when(z["roles"]["kind"] == "timestamp", F.lower(z["units"]) == "ts")
        .when(z["roles"]["kind"] == "record", F.lower(z["units"]) == "rn")
        .when(z["roles"]["kind"] == "battery", F.lower(z["units"]).isin("", "volts"))
        .when(z["roles"]["kind"] == "panel", F.lower(z["units"]).isin("", "degc"))
        .when(z["roles"]["kind"] == "id", z["units"] == "")
        .otherwise(z["units"] == z["roles"]["unit"]),
    )
    kind_ok = F.forall(
        zipped,
        lambda z: F.when(z["roles"]["kind"].isin("timestamp", "record"), z["characteristics"] == "")
        .when(z["roles"]["kind"] == "metric", F.lower(z["characteristics"]) == "smp")
        .otherwise(F.lower(z["characteristics"]).isin("", "smp")),
    )

    def fixed(column: str, expected: list[str], any_case: bool = False) -> Column:
        found = F.transform(column, F.lower) if any_case else F.col(column)
        wanted = [e.lower() for e in expected] if any_case else expected
        return found == F.array(*[F.lit(e) for e in wanted])

    cr200_units = (F.size("units") == len(TABLE_UNITS)) & F.forall(
        F.transform(
            "units",
            lambda u, i: F.when(
                i < CR200_FREE_FROM, u == F.get(F.array(*[F.lit(e) for e in TABLE_UNITS]), i)
            ).otherwise(u.isin(*CR200_UNITS)),
        ),
        lambda ok: ok,
    )
    readable = complete & toa5
    tabular = readable & table.startswith("table")
    family = tabular & kind.startswith("cr3")

    def strict(accepts: Column, units: Column, key: str) -> Column:
        return (
            F.when(~accepts, 0)
            .when(~units, 3)
            .when(~fixed("characteristics", TABLE_KINDS), 4)
            .when(~even | ~known(key), 0)
        )

    exact_units = fixed("units", TABLE_UNITS)
    verdicts = {
        "all": F.when(~readable | (table != "sapflowall") | ~known("all"), 0)
        .when((F.size("units") != n) | ~unit_ok | _ends_mid_run(F.col("sensors")), 3)
        .when((F.size("characteristics") != n) | ~kind_ok, 4),
        "hx": F.when(
            ~tabular
            | ~fixed("units", TABLE_UNITS, any_case=True)
            | ~fixed("characteristics", TABLE_KINDS, any_case=True)
            | ~even
            | ~known("hx"),
            0,
        ),
        "legacy": strict(family, exact_units, "legacy"),
        "table": strict(family, exact_units, "table"),
        "cr200": strict(tabular, cr200_units, "cr200"),
    }
    # A header that cannot be judged (missing rows) is a rejection, not an acceptance.
    return df.withColumns(
        {
            f"header_{key}": F.when(~F.coalesce(readable, F.lit(False)), 0).otherwise(verdict)
            for key, verdict in verdicts.items()
        }
    )


def _headers(files: DataFrame) -> DataFrame:
    lines = F.filter(F.split(F.col("text"), "[\r\n]+"), lambda line: line != "")
    cells = files.withColumn("lines", lines).withColumns(
        {
            name: tokens(F.get("lines", F.lit(i)))
            for i, name in enumerate(["meta", "columns", "units", "characteristics"])
        }
    )
    toa5 = F.lower(F.get("meta", F.lit(0))) == "toa5"
    roles = cells.withColumn(
        "roles", F.when(toa5, F.transform("columns", column_role))
    )
    located = roles.withColumn(
        "sensors",
        F.filter(
            F.transform("roles", lambda r, i: F.struct(r.alias("role"), i.alias("at"))),
            lambda s: s["role"]["kind"] == "metric",
        ),
    )
    return _fenced(_header_verdicts(located))


def _positions(kinds: list[str]) -> Column:
    return F.transform(
        F.filter(
            F.transform("roles", lambda r, i: F.struct(r["kind"].alias("kind"), i.alias("at"))),
            lambda p: p["kind"].isin(*kinds),
        ),
        lambda p: p["at"],
    )


def _standard_time(text: Column) -> Column:
    shape = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} +[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}(\.[0-9]{1,9})?$"
    return F.when(text.rlike(shape), text.try_cast("timestamp_ntz"))


def _slash_time(text: Column) -> Column:
    """``M/D/YY H:MM`` or ``M/D/YYYY H:MM``; two-digit years below 70 are in the 2000s."""
    shape = r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{1,4}) +([0-9]{1,2}):([0-9]{1,2})$"

    def part(i: int) -> Column:
        return F.regexp_extract(text, shape, i)

    short = part(3).try_cast("int")
    year = F.when(F.length(part(3)) > 2, short).otherwise(
        F.when(short < 70, short + 2000).otherwise(short + 1900)
    )
    iso = F.concat(
        F.lpad(year.cast("string"), 4, "0"), F.lit("-"), part(1), F.lit("-"), part(2), F.lit(" "),
        part(4), F.lit(":"), part(5), F.lit(":00"),
    )
    return F.when(text.rlike(shape), iso.try_cast("timestamp_ntz"))


def _consecutive(records: Column) -> Column:
    """Mask of the rows kept when each kept record must follow the last kept one by one.

    A fold over one file's record numbers, linear in their count.
    """

    def mask(numbers: np.ndarray | None) -> list[bool] | None:
        if numbers is None:
            return None
        kept, expected = [], None
        for number in numbers:
            known = number is not None and number == number
            keep = known and (expected is None or number == expected)
            kept.append(keep)
            if keep:
                expected = number + 1
        return kept

    # Nested, so that workers need not import this package.
    def masks(numbers: pd.Series) -> pd.Series:
        return numbers.map(mask)

    return F.pandas_udf(masks, T.ArrayType(T.BooleanType()))(records)


def _typed_rows(files: DataFrame) -> DataFrame:
    """Split and type the data lines of files with an accepted header."""
    accepted = F.lit(False)
    for d in DIALECTS:
        accepted |= F.col(f"header_{d.key}").isNull()
    split = files.withColumn(
        "cells",
        F.when(
            accepted,
            F.transform(
                F.slice("lines", HEADER_ROWS + 1, F.greatest(F.size("lines"), F.lit(1))), tokens
            ),
        ),
    ).withColumns(
        {
            "at_time": F.array_position(F.transform("roles", lambda r: r["kind"]), "timestamp").cast("int") - 1,
            "at_record": F.array_position(F.transform("roles", lambda r: r["kind"]), "record").cast("int") - 1,
            "at_id": F.array_position(F.transform("roles", lambda r: r["kind"]), "id").cast("int") - 1,
            "at_battery": F.array_position(F.transform("roles", lambda r: r["kind"]), "battery").cast("int") - 1,
            "at_panel": F.array_position(F.transform("roles", lambda r: r["kind"]), "panel").cast("int") - 1,
            "at_logger_floats": _positions(["battery", "panel"]),
            "at_totals": _positions(["total"]),
            "at_metrics": _positions(["metric"]),
            "at_addresses": F.filter(
                F.transform("roles", lambda r, i: F.struct(r["kind"].alias("kind"), r["address"].alias("address"), i.alias("at"))),
                lambda p: p["kind"] == "address",
            ),
        }
    )

    def first_bad(cells: Column, positions: str) -> Column:
        return F.array_min(
            F.filter(F.col(positions), lambda p: V.reading_is_bad(F.get(cells, p)))
        )

    def cell(cells: Column, position: str) -> Column:
        return F.when(F.col(position) >= 0, F.trim(F.get(cells, F.col(position))))

    typed = F.transform(
        "cells",
        lambda c, i: F.struct(
            (i + HEADER_ROWS + 1).alias("line"),
            F.size(c).alias("width"),
            cell(c, "at_time").alias("time"),
            _standard_time(cell(c, "at_time")).alias("standard"),
            V.strict_bigint(cell(c, "at_record")).alias("record"),
            cell(c, "at_id").alias("id"),
            V.strict_bigint(cell(c, "at_id")).cast("string").alias("id_value"),
            first_bad(c, "at_logger_floats").alias("bad_logger"),
            first_bad(c, "at_totals").alias("bad_total"),
            first_bad(c, "at_metrics").alias("bad_metric"),
            F.array_min(
                F.transform(
                    F.filter(
                        F.col("at_addresses"),
                        lambda a: ~F.coalesce(
                            V.sdi12_address(F.get(c, a["at"])) == a["address"], F.lit(False)
                        ),
                    ),
                    lambda a: a["at"],
                )
            ).alias("wrong_address"),
            c.alias("cells"),
        ),
    )
    return _fenced(split.withColumn("typed", typed).drop("cells", "lines"))


def _row_faults(files: DataFrame) -> DataFrame:
    """Per dialect ``fault_<key>``: null if the data is accepted, its line, or 0 for no line."""
    n = F.size("columns")
    rows = F.col("typed")
    has_id = F.col("at_id") >= 0
    id_null = lambda r: V.is_null_word(r["id"])
    named = F.regexp_extract(F.trim(F.get("meta", F.lit(1))), "([0-9]+)$", 1) != ""

    def previous(i: Column) -> Column:
        return F.get(rows, i - 1)["record"]

    def earliest(checks: Column) -> Column:
        return F.get(F.filter(checks, lambda line: line.isNotNull()), F.lit(0))

    def base_fault(r: Column, i: Column, ordered: Column) -> Column:
        return (
            (r["width"] != n)
            | r["standard"].isNull()
            | r["record"].isNull()
            | ((i > 0) & ~ordered)
            | (has_id & ~id_null(r) & r["id_value"].isNull())
        )

    def first_id(valid) -> Column:  # noqa: ANN001
        return F.get(
            F.transform(
                F.filter(rows, lambda r: valid(r) & r["id_value"].isNotNull()),
                lambda r: r["id_value"],
            ),
            F.lit(0),
        )

    any_id = first_id(lambda r: F.lit(True))
    valid_cr300 = lambda r: r["wrong_address"].isNull()
    own_cr300 = first_id(lambda r: valid_cr300(r) & (r["id_value"] != DEFAULT_ID))
    kept_hx = lambda r: r["kept"]
    own_hx = first_id(lambda r: kept_hx(r) & (r["id_value"] != DEFAULT_ID))

    keyed = files.withColumns(
        {
            "any_id": any_id,
            "own_cr300": own_cr300,
            "own_hx": own_hx,
            "rows_cr300": F.size(F.filter(rows, valid_cr300)),
            "rows_hx": F.size(F.filter(rows, lambda r: kept_hx(r) & (r["width"] >= n))),
        }
    )

    def bad_reading(r: Column) -> Column:
        return r["bad_logger"].isNotNull() | r["bad_total"].isNotNull() | r["bad_metric"].isNotNull()

    def all_line(r: Column, i: Column) -> Column:
        fault = base_fault(r, i, r["record"] == previous(i) + 1) | bad_reading(r)
        fault |= has_id & id_null(r)
        return F.when(fault, r["line"]).when(has_id & (r["id_value"] != F.col("any_id")), 0)

    def cr200_line(r: Column, i: Column) -> Column:
        fault = base_fault(r, i, r["record"] > previous(i)) | bad_reading(r)
        fault |= r["wrong_address"].isNotNull()
        return F.when(fault, r["line"]).when(has_id & (r["id_value"] != F.col("any_id")), 0)

    def cr300_line(r: Column, i: Column) -> Column:
        fault = base_fault(r, i, r["record"] > previous(i)) | (has_id & id_null(r))
        # Once the address cell is wrong, the readings after it are not looked at.
        early = F.least(r["bad_total"], r["bad_metric"]) < r["wrong_address"]
        reading = F.when(valid_cr300(r), bad_reading(r)).otherwise(
            r["bad_logger"].isNotNull() | F.coalesce(early, F.lit(False))
        )
        conflict = has_id & valid_cr300(r) & (r["id_value"] != DEFAULT_ID) & (r["id_value"] != F.col("own_cr300"))
        return F.when(fault | reading, r["line"]).when(conflict, 0)

    def hx_line(r: Column, i: Column) -> Column:
        wide = r["width"] >= n
        kept = r["kept"]
        odd_id = has_id & (r["id"] != "") & r["id_value"].isNull()
        conflict = has_id & (r["id_value"] != DEFAULT_ID) & (r["id_value"] != F.col("own_hx"))
        return (
            F.when(~wide, F.lit(None).cast("int"))
            .when((r["time"] != "") & ~r["time"].contains("/"), 0)
            .when((r["time"] == "") | r["slash"].isNull() | r["record"].isNull(), r["line"])
            .when(kept & (r["bad_logger"].isNotNull() | r["bad_metric"].isNotNull() | odd_id), r["line"])
            .when(kept & conflict, 0)
        )

    def verdict(key: str, line, count: Column, id_known: Column) -> Column:  # noqa: ANN001
        header = F.col(f"header_{key}")
        complete = (F.col("at_time") >= 0) & (F.col("at_record") >= 0)
        # Two columns for one value of a sensor cannot be told apart.
        single = F.size(F.array_distinct(_value_keys())) == F.size(_value_keys())
        data = F.coalesce(
            earliest(F.transform(rows, line)),
            F.when((count == 0) | ~complete | ~single | ~(id_known | named), 0),
        )
        return F.when(header.isNotNull(), header).otherwise(data)

    total = F.size(rows)
    return keyed.withColumns(
        {
            "fault_all": verdict("all", all_line, total, has_id),
            "fault_hx": verdict(
                "hx",
                hx_line,
                F.col("rows_hx"),
                has_id & F.exists(rows, lambda r: kept_hx(r) & r["id_value"].isNotNull()),
            ),
            "fault_legacy": verdict("legacy", cr300_line, F.col("rows_cr300"), has_id),
            "fault_table": verdict("table", cr300_line, F.col("rows_cr300"), has_id),
            "fault_cr200": verdict("cr200", cr200_line, total, has_id & F.col("any_id").isNotNull()),
        }
    )


def _value_keys() -> Column:
    return F.transform(
        F.filter("roles", lambda r: r["kind"] != "address"),
        lambda r: F.struct(
            r["kind"].alias("kind"),
            r["address"].alias("address"),
            r["depth"].alias("depth"),
            r["metric"].alias("metric"),
        ),
    )


def _slots() -> Column:
    """Per (address, depth), in column order, the cell of each canonical metric."""
    pairs = F.array_distinct(
        F.transform("sensors", lambda s: F.struct(s["role"]["address"].alias("address"), s["role"]["depth"].alias("depth")))
    )

    def position(pair: Column, metric: int) -> Column:
        return F.get(
            F.transform(
                F.filter(
                    "sensors",
                    lambda s: (s["role"]["address"] == pair["address"])
                    & (s["role"]["depth"] == pair["depth"])
                    & (s["role"]["metric"] == metric),
                ),
                lambda s: F.array_position("at_metrics", s["at"]).cast("int") - 1,
            ),
            F.lit(0),
        )

    return F.transform(
        pairs,
        lambda p: F.struct(
            p["address"].alias("sdi12_address"),
            p["depth"].alias("thermistor_depth"),
            F.array(*[position(p, m) for m in range(len(METRIC_COLUMNS))]).alias("cells"),
        ),
    )


def parse_toa5(files: DataFrame) -> DataFrame:
    """Parse ``path, file_hash, content`` rows; one output row per file, good or bad.

    Adds ``status`` (Parsed or Failed), ``parser``, ``parser_attempts`` (the dialects that
    refused the file before one accepted it), ``first_error_line``, ``file_metadata``,
    ``logger_id``, and the nested ``rows`` and ``slots`` that
    :func:`xylemflow.operators.flatten.flatten_parsed_files` unfolds.
    """
    typed = _typed_rows(_headers(decoded(files.select("path", "file_hash", "content")).drop("content")))
    hx = F.col("header_hx").isNull()
    n = F.size("columns")
    # Rows narrower than the header are skipped by the consecutive rule, not seen by it.
    records = F.transform("typed", lambda r: F.when(r["width"] >= n, r["record"]))
    marked = typed.withColumn("kept", _consecutive(F.when(hx, records))).withColumn(
        "typed",
        F.transform(
            "typed",
            lambda r, i: F.struct(
                *[r[name].alias(name) for name in ROW_FIELDS],
                F.when(hx, _slash_time(r["time"])).alias("slash"),
                F.coalesce(F.get("kept", i), F.lit(False)).alias("kept"),
            ),
        ),
    )
    return _fenced(_finish(_fenced(_row_faults(_fenced(marked.drop("kept"))))))


def _finish(files: DataFrame) -> DataFrame:
    """Choose the dialect and shape the result row of each file."""
    winner = F.coalesce(
        *[F.when(F.col(f"fault_{d.key}").isNull(), F.lit(d.key)) for d in DIALECTS]
    )
    refused = F.lit(True)
    attempts = []
    for d in DIALECTS:
        fault = F.col(f"fault_{d.key}")
        refused &= fault.isNotNull()
        attempts.append(
            F.when(
                refused,
                _attempt(d.code, f"{d.code} parser failed", F.nullif(fault, F.lit(0))),
            )
        )
    readable = F.col("text").isNotNull()
    chosen = files.withColumns(
        {
            "winner": F.when(readable, winner),
            "parser_attempts": F.when(
                readable, F.filter(F.array(*attempts), lambda a: a.isNotNull())
            ).otherwise(F.array(_attempt(*UTF8_ATTEMPT, F.lit(None)))),
        }
    )
    has_id = F.col("at_id") >= 0
    derived = F.nullif(F.regexp_extract(F.trim(F.get("meta", F.lit(1))), "([0-9]+)$", 1), F.lit(""))
    seen_hx = F.exists("typed", lambda r: r["kept"] & r["id_value"].isNotNull())
    logger_id = (
        F.when(F.col("winner").isin("all", "cr200"), F.coalesce("any_id", derived))
        .when(F.col("winner") == "hx", F.coalesce("own_hx", F.when(seen_hx, F.lit(DEFAULT_ID)), derived))
        .otherwise(F.coalesce("own_cr300", F.when(has_id, F.lit(DEFAULT_ID)), derived))
    )
    slashed = F.col("winner") == "hx"
    used = F.filter(
        "typed",
        lambda r: F.when(slashed, r["kept"])
        .when(F.col("winner").isin("legacy", "table"), r["wrong_address"].isNull())
        .otherwise(F.lit(True)),
    )

    def single(cells: Column, position: str) -> Column:
        return F.when(F.col(position) >= 0, V.reading(F.get(cells, F.col(position))))

    rows = F.transform(
        used,
        lambda r: F.struct(
            F.when(slashed, r["slash"]).otherwise(r["standard"]).alias("timestamp"),
            r["record"].alias("record"),
            single(r["cells"], "at_battery").alias("battery_voltage_v"),
            single(r["cells"], "at_panel").alias("panel_temperature_c"),
            F.transform("at_metrics", lambda p: V.reading(F.get(r["cells"], p))).alias("cells"),
        ),
    )
    parsed = F.col("winner").isNotNull()
    lines = F.filter(
        F.transform("parser_attempts", lambda a: a["line_index"]), lambda line: line.isNotNull()
    )
    codes = {d.key: d.code for d in DIALECTS}
    return chosen.select(
        "path",
        "file_hash",
        F.when(parsed, F.lit("Parsed")).otherwise(F.lit("Failed")).alias("status"),
        _lookup(codes, "string", F.col("winner")).alias("parser"),
        "parser_attempts",
        F.when(~parsed, F.get(lines, F.lit(0))).alias("first_error_line"),
        F.when(parsed, _metadata()).alias("file_metadata"),
        F.when(parsed, logger_id).alias("logger_id"),
        F.when(parsed, rows).alias("rows"),
        F.when(parsed, _slots()).alias("slots"),
    )


def _attempt(parser: str, message: str, line: Column) -> Column:
    return F.struct(
        F.lit(parser).alias("parser"),
        F.lit(message).alias("message"),
        line.cast("int").alias("line_index"),
    )


def _metadata() -> Column:
    """The eight fields of the first header row; blank optional ones are null."""
    optional = {"serial_number", "os_version", "signature"}
    fields = []
    for i, name in enumerate(METADATA_FIELDS):
        value = F.get("meta", F.lit(i))
        if name in optional:
            value = F.nullif(F.trim(value), F.lit(""))
        fields.append(value.alias(name))
    return F.struct(*fields)

