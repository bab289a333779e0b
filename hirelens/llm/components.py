"""Connected components of an edge table, by contraction.

Each round every node moves to the least of itself and its neighbours, in an
order by hash, and the edges are rewritten to the new nodes; edges inside a
node go.  A random order shrinks any graph by a constant factor a round, and
stars in two rounds.  Minima are combined before the shuffle, so a node with
very many neighbours is no hot task; what a round leaves is written to the
shared folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import again, dropped, spooled


def _least(col: Column) -> Column:
    return F.struct(F.xxhash64(col).alias("h"), col.alias("id"))


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int | None = None) -> DataFrame:
    """(id, component): for every end of an edge the smallest id that can be
    reached from it.  Loops (a = b) keep their node; null ends are ignored.
    After at most ``rounds`` rounds, if given, a component may still be in
    parts, each with the smallest id of its own."""
    clean = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("a"), F.col(b).alias("b"))
    nodes = clean.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    moved = spooled(nodes.select("id", F.col("id").alias("root")), "components-nodes")
    rest = spooled(clean.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                   .distinct(), "components-edges")
    done = 0
    while done != rounds and not rest.isEmpty():
        done += 1
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = (both.groupBy("a").agg(F.min(_least(F.col("b"))).alias("n"))
              .select(F.col("a").alias("from"), F.least("n", _least(F.col("a")))["id"].alias("to"))
              .where("`from` != `to`"))
        to = spooled(to, "components-moves")
        x, y = to.select(F.col("from").alias("xf"), F.col("to").alias("xt")), again(to).select(
            F.col("from").alias("yf"), F.col("to").alias("yt"))
        ends = (rest.join(x, F.col("a") == F.col("xf"), "left").join(y, F.col("b") == F.col("yf"), "left")
                .select(F.coalesce("xt", "a").alias("a"), F.coalesce("yt", "b").alias("b")).where("a != b")
                .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        left = spooled(ends, "components-edges")
        further = spooled(moved.join(x, F.col("root") == F.col("xf"), "left")
                          .select("id", F.coalesce("xt", "root").alias("root")), "components-nodes")
        for old in (rest, moved, to):
            dropped(old)
        rest, moved = left, further
    names = moved.groupBy("root").agg(F.min("id").alias("component"))
    return moved.join(names, "root").select("id", "component")
