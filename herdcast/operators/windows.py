"""Bounded look-back windows that split one long series over many tasks.

A frame that reaches back a fixed distance does not need the whole series in one task. The
axis is cut into blocks; the rows in the last ``lookback`` of a block are also handed to
the next block as history. Every core row then sees exactly the rows its frame asks for,
and no window group is longer than one block plus its history, however long or hot the
series is. The copy rate is lookback / block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = "_block"
CORE = "_core"


def with_blocks(df: DataFrame, pos: Column, lookback: int, block: int) -> DataFrame:
    """Add the block number (exploded over own and, near the end, next block) and core flag."""
    if lookback > block:
        raise ValueError("a block must be at least as long as the look-back")
    own = F.floor(pos / block).cast("long")
    near_end = F.pmod(pos, F.lit(block)) >= block - lookback
    blocks = F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))
    return (df.withColumn(BLOCK, F.explode(blocks))
            .withColumn(CORE, F.col(BLOCK) == own))


def core_rows(df: DataFrame) -> DataFrame:
    return df.filter(CORE).drop(BLOCK, CORE)
