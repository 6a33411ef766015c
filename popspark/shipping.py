"""Executors get the package's Python files from the driver, the way addPyFile does it for any job."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors of a session, once for each application."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        here = Path(__file__).parent
        target = Path(tempfile.mkdtemp(prefix="spark-")) / f"{here.name}.zip"
        with zipfile.ZipFile(target, "w") as out:
            for p in sorted(here.rglob("*.py")):
                out.write(p, p.relative_to(here.parent))
        spark.sparkContext.addPyFile(str(target))
        _SHIPPED.add(app)
    return spark
