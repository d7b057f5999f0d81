"""Connected components of a graph that no task or driver holds whole."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curate.session import written


def connected(links: DataFrame) -> DataFrame:
    """`node` and `root` for every node of `links` (`a`, `b`); the nodes of a component share a root.

    Each round every node hooks to the neighbour of the least rank, ranks being hashed anew each
    time, and the graph shrinks to the hooks that were chosen. Since a random rank leaves only a
    share of the nodes as hooks whatever the shape, even a long chain is done in a number of rounds that
    grows with the logarithm of its length. Then the hooks are followed back, the last round first.
    A node with very many links is one row per task in the minimum, and its links are a join that
    adaptive execution can split. Links are staged in the shared folder each round.
    """
    edges = written(_both_ways(links), "links")
    hooks = []
    while not edges.isEmpty():
        least = F.xxhash64(F.col("b"), F.lit(len(hooks)))
        own = F.xxhash64(F.col("a"), F.lit(len(hooks)))
        hook = edges.groupBy("a").agg(
            F.min_by("b", F.struct(least, "b")).alias("b"), F.min(F.struct(least, "b")).alias("rank")
        )
        # A node that ranks below all its neighbours stays.
        hook = written(
            hook.select(
                F.col("a").alias("node"),
                F.when(F.struct(own.alias("x"), F.col("a").alias("b")) < F.col("rank"), F.col("a"))
                .otherwise(F.col("b")).alias("hook"),
            ),
            "hooks",
        )
        hooks.append(hook)
        from_a = edges.join(hook, edges["a"] == hook["node"]).select(F.col("hook").alias("x"), F.col("b").alias("y"))
        from_a = written(from_a, "links")
        both = from_a.join(hook, from_a["y"] == hook["node"]).select(F.col("x").alias("a"), F.col("hook").alias("b"))
        edges = written(both.where("a <> b").distinct(), "links")
    if not hooks:
        return links.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
    # The hooks chosen in a round are the nodes of the next; one that has no links left is a root.
    roots = hooks[-1].select("node", F.col("hook").alias("root"))
    for hook in reversed(hooks[:-1]):
        later = roots.select(F.col("node").alias("hook"), "root")
        roots = written(
            hook.join(later, "hook", "left").select("node", F.coalesce("root", "hook").alias("root")), "roots"
        )
    return roots


def _both_ways(links: DataFrame) -> DataFrame:
    there = links.select("a", "b").where("a <> b")
    return there.union(there.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
