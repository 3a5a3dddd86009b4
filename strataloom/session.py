"""What Spark's Python workers need to run this package's functions."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def importable(spark: SparkSession) -> None:
    """Puts the package's folder on the workers' path; a cluster that has it installed finds it anyway."""
    root = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
