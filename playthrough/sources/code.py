"""The package itself, sent to the Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship_code(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever they run; Spark sends it from the driver once per session."""
    sc = spark.sparkContext
    if getattr(sc, "_ships_playthrough", False):
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="playthrough-code-")) / "playthrough.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(target))
    sc._ships_playthrough = True
