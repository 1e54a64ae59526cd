"""Joining a large table to a small derived one without guessing the small one's size."""

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.session import checkpoint

BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20


def bounded(df: DataFrame, limit: int = BROADCAST_ROWS) -> tuple[DataFrame, pa.Table | None]:
    """``df`` marked for broadcast if it is proven to hold at most ``limit`` rows and ``BROADCAST_BYTES``.

    At most ``limit + 1`` rows reach the driver; they are returned too. Beyond either
    the table is checkpointed and comes back unhinted and without rows, so the join shuffles
    and adaptive execution splits skewed keys.
    """
    head = df.limit(limit + 1).toArrow()
    if head.num_rows > limit or head.nbytes > BROADCAST_BYTES:
        return checkpoint(df), None
    return F.broadcast(df.sparkSession.createDataFrame(head, schema=df.schema)), head


def lookup_join(df: DataFrame, small: DataFrame, on: list[str] | str, how: str = "left") -> DataFrame:
    """Join to a derived table, broadcast only after its size has been checked."""
    return df.join(bounded(small)[0], on, how)
