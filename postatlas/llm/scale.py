"""Sizing: how many pieces a job is cut into, from the size of what it reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import checkpoint_dir

#: Input bytes (as stored, compressed) that one group of documents should hold.
GROUP_BYTES = 4 << 20
_UNKNOWN = 1 << 60


def plan_bytes(df: DataFrame) -> int:
    """Bytes behind a plan: the optimiser's estimate or the sum over what the plan reads, whichever is less.

    Joins multiply estimates and some sources have none (then they are near
    2^63); where both fail, the strings of the rows are measured by a job.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    read = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    size = min(read, int(str(plan.stats().sizeInBytes())))
    if size < _UNKNOWN:
        return size
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind in ("string", "binary")]
    return int(df.agg(F.sum(sum(texts, F.lit(8)))).first()[0] or 0)


def groups(df: DataFrame, each: int = GROUP_BYTES) -> int:
    """Odd number of groups for documents or keys: at least the session's shuffle partitions, growing with the input."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(parts, -(-plan_bytes(df) // each)) | 1


__all__ = ["GROUP_BYTES", "checkpoint_dir", "groups", "plan_bytes"]
