"""Session defaults, and shipping of this package to the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Folder that holds the package.
ROOT = Path(__file__).resolve().parent.parent


def session(app: str = "loomline", **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC times; ``conf`` goes on top."""
    builder = SparkSession.builder.appName(app)
    defaults = {"spark.sql.adaptive.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.sql.execution.arrow.pyspark.enabled": "true"}
    for name, value in (defaults | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package where their path lacks it.

    Nothing happens where the folder is on PYTHONPATH, which workers inherit.
    """
    context = spark.sparkContext
    on_path = str(ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if on_path or getattr(context, "_loomline_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="loomline")) / "loomline.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as file:
        for path in sorted((ROOT / "loomline").rglob("*.py")):
            file.write(path, path.relative_to(ROOT))
    context.addPyFile(str(archive))
    context._loomline_shipped = True
