"""Session settings the jobs in this package are tuned for."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

DEFAULTS = {
    # Runtime re-planning: skewed shuffle joins are split, small shuffles merged.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Positions are gathered with collect_list; keep that aggregate hash based for
    # longer than the default 128 groups before it falls back to sorting.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app_name: str = "corpusloom",
    master: str | None = None,
    **settings: str,
) -> SparkSession:
    """Session with :data:`DEFAULTS`; keyword settings use ``__`` for each dot."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    chosen = DEFAULTS | {key.replace("__", "."): str(val) for key, val in settings.items()}
    for key, value in chosen.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Needed where the package is not installed on the executors; the archive is handed to
    Spark on the driver, which distributes it.
    """
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="corpusloom-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for module in sorted(package.rglob("*.py")):
            packed.write(module, module.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(application)
