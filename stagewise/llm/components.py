"""Connected components by alternating star contraction, all on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagewise.llm.base import saved, split_join


def _edges(*ends: tuple[str, str]) -> F.Column:
    """Rows ``u, v`` of several pairs of columns of a row. A union of two readings of a plan would
    have Spark's driver plan and run the whole of it twice."""
    return F.inline(F.array(*(F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in ends)))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node, root`` for every node that reaches a lesser one: the least that it reaches.

    ``edges`` has longs ``a`` and ``b``; loops, repeats and nulls are ignored. Each
    round hangs the neighbours of a node below the least of them; rounds end when no
    edge changes. A node with very many links is aggregated in parts and joined with
    its edges split. Nothing but two numbers a round reaches the driver.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links, before = saved(links, label), None
    while True:
        both = links.select(_edges(("u", "v"), ("v", "u")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = split_join(both, least.hint("merge"), ["u"]).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = split_join(large, least.hint("merge"), ["u"]).select(_edges(("v", "m"), ("u", "m")))
        links = saved(small.where("u <> v").distinct(), label)
        now = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if tuple(now) == before:
            return links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
        before = tuple(now)
