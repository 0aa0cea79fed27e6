"""Connected components over an edge table, by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.storage import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("dst"), F.col("src")))
    low = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("m"))
    return both.filter("dst > src").join(low, "src").filter("dst > m").select(F.col("dst").alias("src"), F.col("m").alias("dst"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    low = down.groupBy("src").agg(F.min("dst").alias("m"))
    moved = down.join(low, "src").filter("dst > m").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
    return moved.union(low.select("src", F.col("m").alias("dst")))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of edges(src, dst), an orderable type; component is the smallest node reachable.

    Self-loops and null ends are ignored, repeated edges count once, an empty edge table gives an empty result. A node of
    very high degree is pre-aggregated by min() and meets its edges in a join that AQE may split; no group is collected.
    Each round ends in the shared folder, so that the plan does not grow and lost executors cost one round at most.
    """
    cur = materialize(edges.filter("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(), "cc")
    state = None
    for _ in range(max_rounds):
        cur = materialize(_small_star(_large_star(cur).distinct()).distinct(), "cc")
        now = cur.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if state == now:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = cur.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    return cur.select(F.col("src").alias("node"), F.col("dst").alias("component")).union(roots)


def peeled_components(edges: DataFrame) -> DataFrame:
    """What connected_components gives, for graphs of many nodes that few larger ones name, such as tasks of source groups.

    A node whose neighbours are all smaller is never the smallest of its component: it is taken out at once, its neighbours are
    linked to the least of them instead, and it gets that one's component at the end. Rounds pass over what is left: nothing, of
    a node with one neighbour.
    """
    edges = materialize(edges.filter("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(), "peel")
    below = edges.groupBy("dst").agg(F.lit(True).alias("inner")).withColumnRenamed("dst", "src")
    low = edges.groupBy("src").agg(F.min("dst").alias("m"))
    tops = low.join(below, "src", "left_anti")
    marked = materialize(edges.join(tops, "src", "left"), "peel")
    core = materialize(connected_components(marked.filter("m is null or dst > m").select(F.when(F.col("m").isNull(), F.col("src")).otherwise(F.col("dst")).alias("src"), F.coalesce("m", "dst").alias("dst"))), "peel")
    top = marked.filter("dst = m").select(F.col("src").alias("at"), F.col("m").alias("node"))
    kept = marked.select(F.lit(None).cast(edges.schema["dst"].dataType).alias("at"), F.col("dst").alias("node")).distinct()
    return kept.union(top).join(core, "node", "left").select(F.coalesce("at", "node").alias("node"), F.coalesce("component", "node").alias("component"))


def reachable(start: DataFrame, links: DataFrame, name: str = "reached") -> DataFrame:
    """(kind, id, step): all that start(kind, id) leads to over links(src_kind, src, dst_kind, dst), itself included at step 0.

    Each round only what was new in the round before is joined with the links; what is known already is left out, so that cycles
    end. Each round's find is written once and its plan cut there. A row is found at the least number of steps. Rounds are
    as many as the longest of the shortest ways; a hot id of the links is split by AQE, as its side of the join is a semi-join's.
    """
    text = lambda df: df.select(*(F.col(c).cast("string").alias(c) for c in df.columns))
    links = text(links.select("src_kind", "src", "dst_kind", "dst"))
    new = materialize(text(start.select("kind", "id")).distinct().withColumn("step", F.lit(0)), name)
    found = new
    step = 0
    while kinds := [r[0] for r in new.select("kind").distinct().collect()]:  # names of record kinds: few
        step += 1
        frontier = new.select(F.col("kind").alias("src_kind"), F.col("id").alias("src"))
        ahead = links.filter(F.col("src_kind").isin(kinds)).join(frontier, ["src_kind", "src"], "left_semi").select(F.col("dst_kind").alias("kind"), F.col("dst").alias("id")).distinct()
        new = materialize(ahead.join(found, ["kind", "id"], "left_anti").withColumn("step", F.lit(step)), name)
        found = found.unionByName(new)
    return found
