"""Connected components of a link table, by alternating large and small stars.

Every step is a shuffle join; its result is a written table, so a lost executor repeats one step and
the plan does not grow. Links are only ever moved to smaller neighbours, never multiplied, and the
number of steps grows with the logarithm of the longest path.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmarts.session import scratch_dir


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node in ``links(a, b)``: the smallest node it reaches.

    Loops, repeated links and links in both directions change nothing. Nulls link nothing.
    """
    spark = links.sparkSession
    folder = scratch_dir(spark, "components")

    def written(frame: DataFrame, step: str) -> DataFrame:
        path = os.path.join(folder, step)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = written(
        links.where("a <> b").select(high.alias("u"), low.alias("v")).distinct(), "links"
    )
    state = None
    step = 0
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: what is larger than u goes to the smallest node around u.
        large = (
            both.where("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        large = written(large, f"large-{step}")
        # Small star: u and what is smaller than u go to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = (
            joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = written(small, f"small-{step}")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state or now[0] == 0:
            break
        state = now
        step += 1
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
