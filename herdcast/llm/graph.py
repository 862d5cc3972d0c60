"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdcast.llm.common import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (x, y): ``root`` is the smallest node it reaches.

    Every round hooks each tree to the smallest grandparent among its nodes' neighbours and
    halves the paths, so the rounds grow with the logarithm of the longest path. A round
    is a written table; only its number of changes reaches the driver.
    """
    both = materialise(links.select("x", "y").union(links.select("y", "x")).where("x <> y").distinct(), "links")
    state = materialise(both.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.col("node")).alias("root")), "roots")
    while True:
        parent = state.select(F.col("node").alias("p"), F.col("root").alias("grand"))
        up = state.join(parent, F.col("root") == F.col("p")).select("node", "root", "grand")
        near = (both.join(up.select(F.col("node").alias("y"), F.col("grand").alias("g")), "y")
                .groupBy(F.col("x").alias("node")).agg(F.min("g").alias("near")))
        seen = up.join(near, "node").select("node", "root", F.least("grand", "near").alias("low"))
        proposals = seen.select("node", "low").union(seen.select(F.col("root").alias("node"), "low"))
        lowest = proposals.groupBy("node").agg(F.min("low").alias("low"))
        after = materialise(state.join(lowest, "node").select(
            "node", F.least("root", "low").alias("root"), (F.col("low") < F.col("root")).alias("changed")), "roots")
        if after.where("changed").isEmpty():
            return after.select("node", "root")
        state = after.select("node", "root")
