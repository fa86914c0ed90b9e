"""Makes this package importable in Python workers that do not have it installed, and bounds what they get at once."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[2]
BATCH_BYTES = 4 << 20
_shipped: set[str] = set()
_folders: list[tempfile.TemporaryDirectory] = []


def ship_package(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once an application. Spark's own file server
    hands them out, so the driver's folder need not be shared.

    Also sets the session's Arrow batches to ``BATCH_BYTES`` or one row: the default goes by rows alone, and ten thousand
    whole documents are held several times over on their way to a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    folder = tempfile.TemporaryDirectory(prefix="salesflow-")
    _folders.append(folder)  # removed with the driver, which hands the file out
    path = Path(folder.name) / "salesflow.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted((ROOT / "salesflow").rglob("*.py")):
            archive.write(file, file.relative_to(ROOT))
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)
