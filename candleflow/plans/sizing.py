"""Size checks in front of broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize_at, path_bytes

# Largest side, in Parquet bytes on disk, that we hand to a broadcast join.
# The sides we broadcast are narrow (a few keys and two or three numbers);
# even at ten times compression this stays far below the 8 GB broadcast
# limit and the driver's memory.
BROADCAST_BYTE_LIMIT = 32 * 1024 * 1024


def bounded_broadcast(small: DataFrame, byte_limit: int = BROADCAST_BYTE_LIMIT) -> DataFrame:
    """Broadcast ``small`` only after measuring it.

    The frame is written once to the shared checkpoint folder; its size is
    then read from file-system metadata (no Spark job), and the broadcast
    build reads the files, so the frame is computed once and nothing stays
    cached.  Above the limit the frame is returned as is and the join falls
    back to a shuffle join chosen by the planner.
    """
    written, path = materialize_at(small, "small")
    if path_bytes(small.sparkSession, path) <= byte_limit:
        return F.broadcast(written)
    return written
