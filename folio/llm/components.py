"""Connected components of a link table, by repeated contraction in DataFrame operations.

In each step every node joins its smallest neighbour (or stays), links are rewritten and made distinct, and the step's map is kept;
the maps put together give each node its root. Identifiers that are hashes make each step shrink the graph by a constant factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm import common


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in links (a long, b long); nulls are no nodes. Nodes of one component have one root."""
    edges = common.materialize(links.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = common.materialize(both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("to")).withColumnRenamed("a", "node"), "step")
        maps.append(step)
        one = edges.join(step.withColumnsRenamed({"node": "a", "to": "x"}), "a").join(step.withColumnsRenamed({"node": "b", "to": "y"}), "b")
        edges = common.materialize(one.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if not maps:
        return links.sparkSession.createDataFrame([], "node long, root long")
    root = maps[0].withColumnRenamed("to", "root")
    for m in maps[1:]:
        root = root.join(m.withColumnsRenamed({"node": "root", "to": "next"}), "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return common.materialize(root, "roots")
