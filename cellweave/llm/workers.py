"""Where Python workers find this package."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def importable(spark: SparkSession) -> None:
    """Let workers import the package from where the driver did.

    That serves local sessions and shared folders; elsewhere install the package or give it as --py-files.
    """
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def on_workers(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``fn(spark, ...)``, run once workers can import the package."""

    @wraps(fn)
    def run(spark: SparkSession, *args) -> DataFrame:
        importable(spark)
        return fn(spark, *args)

    return run
