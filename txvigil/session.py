"""Session settings by data and cluster size."""

from __future__ import annotations

from math import ceil

_MB = 1 << 20


def settings(
    input_bytes: int, cores: int, partition_bytes: int = 256 * _MB
) -> dict[str, str]:
    """Settings for runs over ``input_bytes`` of Parquet on ``cores`` executor cores.

    Shuffles start from partitions of about ``partition_bytes``, which a task should sort
    with little or no spilling, and at least three per core; adaptive execution joins small
    ones and splits the ones a hot key made large. The bookkeeping of a shuffle grows with
    its partitions: for hundreds of terabytes give executors more memory and take 1 GB.
    """
    partitions = max(ceil(input_bytes / partition_bytes), 3 * cores)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
    }
