"""Connected components of a large graph by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import materialize


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Edges (a, b) of long node numbers to rows (node, root), root being the smallest node
    of the component. Nodes that are their own root have no row.

    A large star links every larger neighbour of a node to the smallest node around it, a
    small star does so with the node and its smaller neighbours; both keep the components
    and end in one star each after few rounds. Each round is written to the shared folder.
    The smallest neighbour is a partial aggregate; a hub's edges meet it in a plain join,
    whose large partitions Spark splits.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = materialize(spark, edges, "components"), None
    while True:
        seen = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if seen == before or seen[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = seen
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        large = materialize(spark, large, "components-large")
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")),
                                                                   F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = materialize(spark, small.select("e.a", "e.b").where("a <> b").distinct(), "components")
