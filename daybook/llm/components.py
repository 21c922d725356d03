"""Connected components of a link table, by alternating large-star and small-star steps.

Each step is a grouped minimum and a join back, so a node with very many links
is pre-aggregated before the shuffle and its rows can be split by the
adaptive join.  Every round is written to the shared folder; only the number
of nodes that still point elsewhere than at their root reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.sources.store import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node of its component.

    Self links and rows with a null end are ignored; repeated links count
    once; an empty table gives an empty result.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    while True:
        edges = materialize(edges, "components")
        both = edges.selectExpr("a AS u", "b AS v").union(edges.selectExpr("b AS u", "a AS v"))
        ends = both.groupBy("u").agg(F.min("v").alias("m"), F.count_if(F.expr("v < u")).alias("lower"), F.count_if(F.expr("v > u")).alias("higher"))
        # A component is a star around its smallest node: each other node has one link, and it leads there.
        if not ends.agg(F.count_if(F.expr("lower > 1 OR lower = 1 AND higher > 0"))).first()[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
        least = ends.selectExpr("u", "least(u, m) AS m")
        large = both.join(least, "u").where("v > u").selectExpr("v AS a", "m AS b")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").selectExpr("explode(IF(b <> m, array(a, b), array(a))) AS a", "m AS b")
        edges = small.distinct()
