"""Session settings the library relies on."""

from __future__ import annotations

import atexit
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Runtime SQL settings every operator assumes.  Set on an existing session by ``configure``.
RUNTIME_CONF = {
    # Python's json keeps the last of duplicated keys; Variant rejects them by default.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # The JSON validity wrap builds a map; a duplicated key must not abort the job.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_spark(master: str | None = None, app: str = "extracteval", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession, sub: str) -> str:
    """A folder that all machines of the cluster reach: ``sub`` under ``spark.checkpoint.dir``.

    Where that is unset, a local session (tests, laptops) uses its warehouse, and a cluster raises: its
    warehouse may be a folder of the driver's machine alone.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return f"{base.rstrip('/')}/{sub}"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers once a session (``--py-files``), so tasks can import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    # on the driver only: Spark's file server hands it to the workers
    folder = tempfile.TemporaryDirectory(prefix="extracteval-")
    atexit.register(folder.cleanup)
    target = Path(folder.name) / "extracteval-package.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, str(source.relative_to(package.parent)))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)
