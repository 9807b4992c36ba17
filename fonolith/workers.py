"""Getting this package to the Python workers of a cluster."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_ROOT = Path(__file__).resolve().parent


def ready(spark: SparkSession) -> None:
    """Sends the package to the executors once a session, unless local workers find it where the driver does."""
    sc = spark.sparkContext
    if getattr(sc, "_fonolith_sent", False):
        return
    # workers of local mode start in the driver's folder, those of a local cluster in their own; both have its environment
    folders = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), *([] if sc.master.startswith("local-cluster") else [os.getcwd()])]
    found = [os.path.realpath(p) for p in folders if p]
    if not (sc.master.startswith("local") and str(_ROOT.parent) in found):
        path = os.path.join(tempfile.mkdtemp(prefix="fonolith-"), "fonolith-package.zip")
        with zipfile.ZipFile(path, "w") as z:
            for file in sorted(_ROOT.rglob("*.py")):
                z.write(file, file.relative_to(_ROOT.parent))
        sc.addPyFile(path)
    sc._fonolith_sent = True
