"""Shipping this package to the executors of a session."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Make the package importable in Python workers, once per application.

    The archive goes through Spark's own file distribution, so the workers
    need neither this working directory nor a shared folder.
    """
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="tessera-")) / "tessera.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(root.rglob("*.py")):
                out.write(path, f"{root.name}/{path.relative_to(root)}")
        spark.sparkContext.addPyFile(str(archive))
        _shipped.add(app)
    return spark
