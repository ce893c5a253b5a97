"""Session defaults shared by the CLI, the tests and the benchmark."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Values that the engine's semantics rely on (time zone, map merging) or that suit its plans (AQE).
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "framesieve", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the engine's defaults; ``extra`` maps ``spark_sql_x`` style names or full keys to values."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    ship(session)
    return session


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors once per context, so that Python workers find it whatever their path is."""
    context = spark.sparkContext
    if getattr(context, "_framesieve_shipped", False):
        return
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="framesieve-")) / "framesieve.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent).as_posix())
    context.addPyFile(str(archive))
    context._framesieve_shipped = True
