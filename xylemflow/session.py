"""Session settings the operators rely on, and the folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

REQUIRED_CONF = {
    # Naive logger time is TIMESTAMP_NTZ; microsecond arithmetic casts it through UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot does not compile methods above 8000 bytes; the wide final rows would otherwise run
    # interpreted. Such stages use the per-operator projections instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark context.

    Functions that run there are pickled by name, so a worker must be able to import them even
    where the package is neither installed on the executors nor in their working folder.
    """
    context = spark.sparkContext
    if getattr(context, "_xylemflow_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="xylemflow-package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    # Only the driver reads this folder: Spark hands the file to the executors itself.
    context.addPyFile(str(archive))
    context._xylemflow_shipped = True


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings every operator assumes to a running session."""
    ship_package(spark)
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names, set as the context's checkpoint folder.

    Without one, a temporary local folder serves a local master; on a cluster, where executors
    would each write to their own disk, its absence is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    current = context._jsc.sc().getCheckpointDir()
    if folder is None and current.isDefined():
        folder = current.get()
    if folder is None:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="xylemflow-ckpt-")
    if not current.isDefined():
        context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: partition layout and row order are frozen and survive executor loss."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def measured(df: DataFrame) -> DataFrame:
    """Cache a dimension and count it, so the planner knows its true size.

    Joins against it become broadcast joins only when the measured bytes are below
    ``spark.sql.autoBroadcastJoinThreshold``; a larger dimension is shuffled as usual.
    Only metadata-sized frames (deployments, aliases, overrides) are passed here.
    """
    cached = df.persist()
    cached.count()
    return cached
