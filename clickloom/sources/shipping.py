"""The library's own code on the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, once for each application.

    Kernels are pickled by name, so a worker must be able to import their
    module. The archive lies in a folder of the driver, which serves it.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="clickloom-code-")) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(PACKAGE.rglob("*.py")):
            z.write(path, path.relative_to(PACKAGE.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
