"""Connected components of a link table that may be of any size."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import staged


class Forest:
    """Smallest-root union of nodes, many links at a time."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray):
        while len(a):
            ra, rb = self.up[a], self.up[b]
            open_ = ra != rb
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            np.minimum.at(self.up, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                top = self.up[self.up]
                if (top == self.up).all():
                    break
                self.up = top


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of a link, root being the smallest node it
    reaches. Large-star and small-star rounds: each points a node's neighbours
    at the smallest of them, and the links become stars after a number of
    rounds that grows with the logarithm of the longest chain. Only two sums
    per round reach the driver."""
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v")
    e = staged(e.distinct(), "links")
    last = _state(e)
    while last[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        # large star: larger neighbours of u go to the smallest of u's
        large = (e.select(F.col("v").alias("u"), F.col("u").alias("v")).join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        # small star: u and its smaller neighbours go to the smallest of these
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(small_low, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        e = staged(small.unionByName(small_low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(),
                   "links")
        now = _state(e)
        if now == last:
            break
        last = now
    return (e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))


def _state(e: DataFrame) -> tuple:
    """Number of links and an order-free checksum of them."""
    r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return (r[0], r[1])
