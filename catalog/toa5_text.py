"""TOA5 text written by Spark from the event readings, for the parser queries.

The five dialects rotate with the logger number. Files are 400 readings long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.inputs import Tables
from xylemflow.sources.rawfiles import identified
from xylemflow.sources.toa5 import SENSOR_SUFFIXES, TABLE_KINDS, TABLE_UNITS

TABLE_COLUMNS = (
    "TIMESTAMP,RECORD,BattV_Min,id,SDI0,SapFlwTot0,VhOuter0,VhInner0,"
    "AlphaOut0,AlphaIn0,BetaOut0,BetaIn0,tMaxTout0,tMaxTin0"
)
NEW_TABLE_COLUMNS = (
    "TIMESTAMP,RECORD,BattV,id,SensorAddress0,SapFlwTot0,VhOut0,VhIn0,"
    "AlphaOuter0,AlphaInner0,BetaOuter0,BetaInner0,tMxTout0,tMxTin0"
)
CR200_UNITS = ["TS", "RN", "Volts", "", ""] + ["literPerHo"] + ["heatVeloci"] * 2 + ["logTRatio"] * 4 + ["unit"] * 2


def _quoted(cells: list[str]) -> str:
    return ",".join(f'"{cell}"' for cell in cells)


def _header(meta: str, columns: list[str], units: list[str], kinds: list[str]):
    rows = "\r\n".join([_quoted(columns), _quoted(units), _quoted(kinds)])
    return F.concat(
        F.lit('"TOA5","unit_'), F.col("logger").cast("string"), F.lit(meta + "\r\n" + rows)
    )


def toa5_files(tables: Tables) -> DataFrame:
    """``path, file_hash, content`` of every file."""
    lines = tables["toa5_line"]
    logger, rn, nr = F.col("logger"), F.col("rn"), F.col("line_nr")
    value = F.col("value")

    def text(column):
        return column.cast("string")

    dialect = logger % 5
    slash = F.date_format("ts", "M/d/yy H:mm")
    standard = F.concat(F.lit('"'), text(F.col("ts")), F.lit('"'))
    inner = (
        F.when(rn % 20 == 3, F.lit("-99")).when(rn % 20 == 4, F.lit('"NAN"')).otherwise(text(value / 60.0))
    )
    record = F.when((dialect == 1) & (F.col("part") % 2 == 1) & (nr == 50), rn + 7).otherwise(rn)
    identity = (
        F.when(dialect == 4, F.when(rn % 2 == 1, F.lit("")).otherwise(text(logger + 100)))
        .when(dialect == 1, text(logger + 100))
        .otherwise(F.when(nr == 0, text(logger + 100)).otherwise(F.lit("1")))
    )
    address = F.when(dialect.isin(2, 3) & (rn % 50 == 7), F.lit("X")).otherwise(F.lit("0"))
    flow = F.when((logger == 9) & (rn == 5), F.lit("abc")).otherwise(F.lit("3.5"))
    table_line = F.concat_ws(
        ",",
        F.when(dialect == 1, slash).otherwise(standard),
        text(record),
        F.lit("12.1"),
        identity,
        address,
        flow,
        F.lit("1"),
        F.lit("2"),
        text(value / 50.0),
        inner,
        text(value / 40.0),
        text(value / 30.0),
        text(value + 2.0),
        text(value + 3.0),
    )
    sensor = {
        "alpout": text(value / 50.0),
        "alpinn": inner,
        "betout": text(value / 40.0),
        "betinn": text(value / 30.0),
        "tmxtout": text(value + 2.0),
        "tmxtinn": text(value + 3.0),
    }
    all_line = F.concat_ws(
        ",",
        standard,
        text(rn),
        F.lit("12.5"),
        F.lit("21.25"),
        *[sensor.get(suffix, F.lit("7")) for suffix in SENSOR_SUFFIXES],
    )
    units = [unit for _, _, unit in SENSOR_SUFFIXES.values()]
    table_meta = '","{kind}","17","OS","CPU:a,b.CR3","99","Table1"'
    headers = (
        F.when(
            dialect == 0,
            _header(
                '","CR300","17","OS","CPU:a,b.CR3","99","SapFlowAll"',
                ["TIMESTAMP", "RECORD", "Batt_volt", "PTemp_C"] + [f"S0_{s}" for s in SENSOR_SUFFIXES],
                ["TS", "RN", "", ""] + units,
                ["", "", "Smp", "Smp"] + ["Smp"] * len(SENSOR_SUFFIXES),
            ),
        )
        .when(dialect == 3, _header(table_meta.format(kind="CR310"), NEW_TABLE_COLUMNS.split(","), TABLE_UNITS, TABLE_KINDS))
        .when(dialect == 4, _header(table_meta.format(kind="CR206"), TABLE_COLUMNS.split(","), CR200_UNITS, TABLE_KINDS))
        .otherwise(_header(table_meta.format(kind="CR300"), TABLE_COLUMNS.split(","), TABLE_UNITS, TABLE_KINDS))
    )
    # At most 400 lines meet in one group.
    files = (
        lines.withColumn("line", F.when(dialect == 0, all_line).otherwise(table_line))
        .groupBy("path", "logger")
        .agg(F.array_sort(F.collect_list(F.struct("rn", "line"))).alias("body"))
    )
    content = F.concat(
        headers, F.lit("\r\n"), F.concat_ws("\r\n", F.transform("body", lambda b: b["line"])), F.lit("\r\n")
    )
    # Parsing costs far more than its input bytes suggest: spread the files over all cores.
    spread = files.select("path", content.cast("binary").alias("content")).repartition(
        tables.spark.sparkContext.defaultParallelism, "path"
    )
    return identified(spread)


# Readings the parser must find, for the SQL counterpart.
EXPECTED_SQL = """
    SELECT path, CASE WHEN logger % 5 = 0 THEN CAST(logger AS VARCHAR) ELSE CAST(logger + 100 AS VARCHAR) END AS logger_id,
      rn AS record, CASE WHEN logger % 5 = 1 THEN date_trunc('minute', ts) ELSE ts END AS timestamp,
      d.thermistor_depth, '0' AS sdi12_address,
      CASE WHEN d.thermistor_depth = 'outer' THEN value / 50.0
           WHEN rn % 20 IN (3, 4) THEN NULL ELSE value / 60.0 END AS alpha,
      CASE WHEN d.thermistor_depth = 'outer' THEN value / 40.0 ELSE value / 30.0 END AS beta,
      CASE WHEN d.thermistor_depth = 'outer' THEN value + 2.0 ELSE value + 3.0 END AS time_to_max_temp_downstream_s,
      CASE WHEN logger % 5 = 0 THEN 7.0 ELSE NULL END AS pre_pulse_temp_downstream_c
    FROM toa5_line l
    JOIN (SELECT 'outer' AS thermistor_depth UNION ALL SELECT 'inner' AS thermistor_depth) d ON TRUE
    WHERE NOT (logger % 5 IN (2, 3) AND rn % 50 = 7)
      AND NOT (logger % 5 = 1 AND part % 2 = 1 AND line_nr >= 50)
      AND NOT (logger = 9 AND part = 0)"""
