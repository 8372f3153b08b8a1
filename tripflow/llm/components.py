"""Connected components of an edge table, by alternating star contraction.

Each round every node points its larger neighbours to its smallest one
(large star), then itself and its smaller neighbours to the smallest (small
star). Rounds are counted in logarithms of the component's size. Each round
is written to the shared folder, so lineage stays short; nothing but a
checksum reaches the driver. Nodes with many neighbours are aggregated with
partial aggregation, and the joins are left to adaptive skew handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import settle

EDGES_PER_FILE = 250_000


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, root) of all nodes that have an edge; root is the smallest node reached.

    Loops and repeated edges are allowed; an empty table gives an empty one.
    """
    low, high = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    pairs = settle(
        edges.select(high.alias("u"), low.alias("v")).filter("u <> v").distinct(), "components"
    )
    # a round at most doubles the edges: few of them go into few files, whatever the number of shuffle partitions
    files = int(pairs.count() // EDGES_PER_FILE + 1)
    seen = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        # every edge now goes from a larger to a smaller node
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .filter("u <> v")
            .distinct()
        )
        pairs = settle(small.coalesce(files), "components")
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = pairs.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
