"""Spark session settings used by tests, the bench and the entry point.

On a cluster the session is normally built by the platform; ``get_session``
only fills in settings that are still unset there.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that every run needs: adaptive execution (runtime re-planning,
# partition coalescing, skew-join splitting), UTC timestamps, no web UI.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "phenoscope") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        builder = builder.config("spark.driver.memory", os.environ.get("PHENOSCOPE_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names: ``spark.checkpoint.dir`` before any that the context has.

    Only with a ``local`` master and none configured (tests) a scratch folder is
    created, once a session; on a cluster that raises, since executors do not
    see a folder of the driver's machine.
    """
    try:
        context = spark.sparkContext
    except Exception:  # a Spark Connect session: the server manages checkpoints
        return spark.conf.get("spark.checkpoint.dir", "")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    # the context's folder is a new one below what it was given
    if current and (not configured or current.removeprefix("file:").startswith(configured.removeprefix("file:").rstrip("/") + "/")):
        return current
    if configured:
        context.setCheckpointDir(configured)
        return configured
    if not (context.master == "local" or context.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="phenoscope-ckpt-")
    context.setCheckpointDir(local)
    return local


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once a session, for the Python code that runs in tasks.

    Not needed where it is installed on every machine; harmless there.
    """
    context = spark.sparkContext
    if getattr(context, "_phenoscope_shipped", False):
        return
    home = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="phenoscope-ship-")) / "phenoscope.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(home.rglob("*.py")):
            out.write(path, f"{home.name}/{path.relative_to(home)}")
    context.addPyFile(str(archive))
    context._phenoscope_shipped = True
