"""Arrow functions that Python workers run."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def ship() -> None:
    """Let Python workers that start from now on import this package from where the driver has it."""
    spark = SparkSession.getActiveSession()
    root = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment if spark else {}
    if root not in os.environ.get("PYTHONPATH", "").split(":") and root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def arrow_function(returns: str) -> Callable:
    """Turn a function of Arrow arrays into one of columns; the UDF is made at the call, so modules import without a session."""

    def wrap(f: Callable) -> Callable[..., Column]:
        def call(*columns) -> Column:
            ship()
            return F.arrow_udf(f, returns)(*columns)

        call.__name__, call.__doc__ = f.__name__, f.__doc__
        return call

    return wrap
