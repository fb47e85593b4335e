"""One writer for each table: the checkpoint that wrote its first batch.

A job under another checkpoint counts its batches from 0 again and would overwrite the batches of
the first. So the id of the checkpoint is kept in the table, and a job under another one is refused
before it writes. To begin anew, remove the table (``jobs.reset``).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from flowlake.sinks.folders import children, make

FENCE = "_fence"


class ForeignWriter(ValueError):
    pass


def checkpoint_id(spark: SparkSession) -> str | None:
    """The id that the running batch's checkpoint has, the same after every restart."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def owners(spark: SparkSession, path: str) -> list[str]:
    return children(spark, f"{path}/{FENCE}")


def claim(spark: SparkSession, path: str, owner: str) -> None:
    """Make ``owner`` the writer of the table at ``path``, or fail where there is another.

    The mark is a folder of that name, made first and looked at after, so of two writers that
    begin at once neither can miss the other, and both are refused.
    """
    present = owners(spark, path)
    if not present:
        make(spark, f"{path}/{FENCE}/{owner}")
        present = owners(spark, path)
    if present != [owner]:
        others = ", ".join(name for name in present if name != owner)
        raise ForeignWriter(f"{path} belongs to another checkpoint ({others}), not to {owner}")
