"""Session settings the jobs rely on."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

# Adaptive execution splits a join partition that holds a large share of the rows. The
# last setting lets it do so also where the split costs a further exchange.
SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    for name, value in SKEW_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, for jobs that read files in Python tasks."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    folder = Path(tempfile.mkdtemp(prefix="rosterlens-"))
    shutil.copytree(package, folder / "copy" / package.name, ignore=shutil.ignore_patterns("__pycache__"))
    spark.sparkContext.addPyFile(shutil.make_archive(str(folder / "code"), "zip", folder / "copy"))
    _shipped.add(app)
