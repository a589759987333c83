"""Connected components of an edge table, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.llm.skew import spread_join
from staylens.llm.storage import written


#: Rows of a file, at least, of the tables that rounds end in.
ROWS_A_FILE = 100_000


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in edges (a, b); a component is named by one of its nodes.

    Each round points every node to the first of itself and its neighbours in a hashed order, jumps once along these pointers,
    and contracts the edges to what they point to, so edges inside a component go and the graph shrinks by a factor a round
    whatever the ids' order. Rounds end in tables in the shared folder, of fewer files as the graph shrinks; a node with many
    edges is pre-aggregated. No edges give no rows.
    """
    a, b = F.col("a"), F.col("b")
    left = written(edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).filter("a <> b").distinct(), "edges")
    n = left.count()
    files = lambda rows: max(1, -(-rows // ROWS_A_FILE))
    place, places = None, 2 * n
    while True:
        both = left.unionByName(left.select(b.alias("a"), a.alias("b")))
        ranked = lambda c: F.struct(F.xxhash64(c).alias("rank"), c.alias("node"))
        near = both.groupBy("a").agg(F.min(ranked(b)).alias("near"))
        up = written(near.select(a.alias("node"), F.least(ranked(a), "near")["node"].alias("up")).coalesce(files(2 * n)), "up")
        jumped = spread_join(up, up.select(F.col("node").alias("up"), F.col("up").alias("top")), "up", "node").select("node", "top")
        step = written(jumped.coalesce(files(2 * n)), "top")
        if place is None:
            place = step.select("node", F.col("top").alias("component"))
        else:
            moved = step.select(F.col("node").alias("component"), "top")
            place = spread_join(place, moved, "component", "node", "left").select("node", F.coalesce("top", "component").alias("component"))
        place = written(place.coalesce(files(places)), "components")
        ends = lambda c: step.select(F.col("node").alias(c), F.col("top").alias(f"{c}_top"))
        moved = spread_join(spread_join(left, ends("a"), "a", "b"), ends("b"), "b", "a").select(F.least("a_top", "b_top").alias("a"), F.greatest("a_top", "b_top").alias("b"))
        left = written(moved.filter("a <> b").distinct().coalesce(files(n)), "edges")
        n = left.count()
        if not n:
            return written(place.repartition("node"), "components")  # evenly, however many nodes a hub has
