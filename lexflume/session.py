"""Session settings, and shipping of this package to Python workers."""

from __future__ import annotations

import hashlib
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: What the plans of this package rely on; ANSI stays on, adaptive execution too.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session(master: str | None = None, app: str = "lexflume", **settings: str) -> SparkSession:
    """A session with SETTINGS; on a cluster leave master to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package's sources to the Python workers of spark's application, once."""
    context = spark.sparkContext
    if getattr(context, "_lexflume_shipped", False):
        return spark
    root = Path(__file__).resolve().parent
    files = sorted(p for p in root.rglob("*.py"))
    digest = hashlib.sha256(b"".join(p.read_bytes() for p in files)).hexdigest()[:12]
    target = Path(tempfile.mkdtemp(prefix="lexflume-")) / f"lexflume-{digest}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in files:
            z.write(p, str(Path(root.name) / p.relative_to(root)))
    context.addPyFile(str(target))
    context._lexflume_shipped = True
    return spark
