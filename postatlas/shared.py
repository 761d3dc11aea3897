"""What all parts use: the shared checkpoint folder, and values bound once inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a local one only on a local master where none is set (tests)."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            import tempfile

            shared = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(shared)
    return context.getCheckpointDir()


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once for each row, however often ``use`` reads it (inside a lambda an expression is computed anew for each element)."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def unused(name: str, columns: list[str]) -> str:
    """``name``, with as many leading underscores as it takes to be none of the columns."""
    while name in columns:
        name = f"_{name}"
    return name
