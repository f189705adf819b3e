"""Python steps on executors, which need this package's modules."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once an application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="kinfold-")) / "kinfold_modules.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def map_arrow(df: DataFrame, step, schema: str) -> DataFrame:
    """``df.mapInArrow`` with the package at hand on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(step, schema)
