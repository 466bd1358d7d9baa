"""Connected components of a table of edges, by repeated stars, without collecting anything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b: bigint); the label is the component's smallest node.

    Each round hangs every node's larger neighbours under its smallest one, then its smaller ones;
    the number of rounds grows with the logarithm of the component size. Each round's edges are
    written to the shared folder. Loops and repeated edges do no harm.
    """
    now = materialise(edges.where("a <> b").selectExpr("greatest(a, b) AS u", "least(a, b) AS v").distinct(), "edges")
    size = _mark(now)
    for _ in range(most_rounds):
        both = now.unionByName(now.selectExpr("v AS u", "u AS v"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
        large = both.join(low, "u").where("v > u").selectExpr("v AS u", "m AS v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").selectExpr("inline(array(struct(v AS u, m AS v), struct(u, m AS v)))").where("u <> v").distinct()
        now = materialise(small, "edges")
        before, size = size, _mark(now)
        if before == size:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.selectExpr("u AS node", "v AS label").unionByName(now.selectExpr("v AS node", "v AS label").distinct())


def _mark(edges: DataFrame):
    """Count and checksum: equal for equal edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head())
