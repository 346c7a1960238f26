"""Python functions over Arrow batches, with this package at hand in the workers."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame

PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def map_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` after sending the package's sources to the executors once per application."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        target = f"{tempfile.mkdtemp(prefix='cataloom-')}/cataloom.zip"
        with zipfile.ZipFile(target, "w") as z:
            for source in sorted(PACKAGE.rglob("*.py")):
                z.write(source, f"{PACKAGE.name}/{source.relative_to(PACKAGE)}")
        context.addPyFile(target)
    return df.mapInArrow(run, schema)
