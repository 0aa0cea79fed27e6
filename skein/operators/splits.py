"""Leak-free splits: tasks that share a source group, a template or a stated relation get one scope."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions.identity import group_id, hash_scope
from skein.operators.graph import peeled_components
from skein.storage import materialize


def _edges(tasks: DataFrame) -> DataFrame:
    """(src, dst) from each task to its source groups, its template and the tasks that it names."""
    anchors = F.concat(F.transform(F.coalesce("source_groups", F.array().cast("array<string>")), lambda s: F.concat(F.lit("s:"), s)), F.array_compact(F.array(F.concat(F.lit("r:"), "template_root"))), F.transform(F.coalesce("related_task_ids", F.array().cast("array<string>")), lambda s: F.concat(F.lit("t:"), s)))
    return tasks.select(F.concat(F.lit("t:"), "task_id").alias("src"), F.explode(anchors).alias("dst"))


class Forest(NamedTuple):
    """Components as they are after some batches of tasks.

    nodes(node, first): each node with the root that it had when it came; roots(first, root): roots that have been joined to
    a smaller one since, with what stands for them now; pending(src, dst): relations to tasks that have not come yet.
    """

    nodes: DataFrame
    roots: DataFrame
    pending: DataFrame


def empty_forest(spark: SparkSession) -> Forest:
    return Forest(*(spark.createDataFrame([], f"{a} string, {b} string") for a, b in (("node", "first"), ("first", "root"), ("src", "dst"))))


def forest_components(forest: Forest) -> DataFrame:
    """(task_id, component) of all tasks so far: what split_components gives for all batches at once."""
    tasks = forest.nodes.filter("node like 't:%'").join(forest.roots, "first", "left")
    return tasks.select(F.expr("substring(node, 3)").alias("task_id"), F.coalesce("root", "first").alias("component"))


def extend_forest(forest: Forest, tasks: DataFrame) -> Forest:
    """The forest with another batch of tasks(task_id, source_groups, template_root, related_task_ids), each new and once.

    Only the batch's edges, and relations that waited for its tasks, are looked at: their ends give way to the roots that they
    have, and components are found among these roots alone. Old nodes stay as they are written; what changes is the table of
    joined roots. The new tables are in the shared folder.
    """
    own = materialize(tasks.select(F.concat(F.lit("t:"), "task_id").alias("node")).distinct(), "forest-own")
    asked = materialize(_edges(tasks).union(forest.pending).distinct(), "forest-edges")
    known = forest.nodes.select("node").union(own)
    ready = asked.filter("dst not like 't:%'").union(asked.filter("dst like 't:%'").join(known.withColumnRenamed("node", "dst"), "dst", "left_semi").select("src", "dst"))
    ready = materialize(ready, "forest-ready")
    current = forest.nodes.join(forest.roots, "first", "left").select("node", F.coalesce("root", "first").alias("root"))
    ends = ready.select(F.explode(F.array("src", "dst")).alias("node")).union(own).distinct().join(current, "node", "left")
    ends = materialize(ends.select("node", F.coalesce("root", "node").alias("root"), F.col("root").isNull().alias("new")), "forest-ends")
    a, b = (ends.select(F.col("node").alias(x), F.col("root").alias(f"{x}_root")) for x in ("src", "dst"))
    joined = ready.join(a, "src").join(b, "dst").select(F.col("src_root").alias("src"), F.col("dst_root").alias("dst"))
    moved = materialize(peeled_components(joined).filter("node <> component").select(F.col("node").alias("first"), F.col("component").alias("root")), "forest-moved")
    nodes = forest.nodes.union(ends.filter("new").select("node", F.col("node").alias("first")))
    later = moved.select(F.col("first").alias("root"), F.col("root").alias("now"))
    roots = forest.roots.join(later, "root", "left").select("first", F.coalesce("now", "root").alias("root")).union(moved)
    pending = asked.join(ready, ["src", "dst"], "left_anti")
    return Forest(*(materialize(df, "forest") for df in (nodes, roots, pending)))


def split_components(tasks: DataFrame) -> DataFrame:
    """(task_id, component) from tasks(task_id, source_groups, template_root, related_task_ids)."""
    own = F.concat(F.lit("t:"), "task_id")
    edges = _edges(tasks)
    known = tasks.select(own.alias("node")).distinct()
    inside = edges.join(known.withColumnRenamed("node", "dst"), "dst", "left_semi").union(edges.filter("dst not like 't:%'").select("dst", "src"))
    parts = peeled_components(inside)
    return tasks.select("task_id", own.alias("node")).join(parts, "node", "left").select("task_id", F.coalesce("component", "node").alias("component"))


def assign_splits(tasks: DataFrame, frozen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """place() of the components of tasks."""
    return place(split_components(tasks), frozen)


def place(components: DataFrame, frozen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Assignments (task_id, scope, split_group_id, quarantined) and conflicts (component, scopes, tasks) of components(task_id, component).

    frozen(task_id, scope) wins: a component with one frozen scope takes it, one with none takes a hash of its group id,
    one with several is a conflict, and its tasks that are not frozen are quarantined without a scope.
    """
    placed = components.join(frozen, "task_id", "left")
    groups = placed.groupBy("component").agg(F.array_sort(F.collect_set("scope")).alias("scopes"), F.array_sort(F.collect_list("task_id")).alias("tasks"))
    named = groups.withColumn("split_group_id", group_id(F.col("tasks")))
    scope = F.when(F.size("scopes") == 1, F.element_at("scopes", 1)).when(F.size("scopes") == 0, hash_scope(F.col("split_group_id")))
    out = placed.join(named.select("component", "split_group_id", scope.alias("group_scope"), (F.size("scopes") > 1).alias("conflict")), "component")
    assigned = out.select("task_id", F.coalesce("scope", "group_scope").alias("scope"), "split_group_id", (F.col("conflict") & F.col("scope").isNull()).alias("quarantined"))
    return assigned, named.filter(F.size("scopes") > 1).select("component", "scopes", "tasks")


def leaks(rows: DataFrame, group: str, scope: str) -> DataFrame:
    """Groups that are in more than one scope."""
    return rows.groupBy(group).agg(F.count_distinct(scope).alias("scopes")).filter("scopes > 1")


def registry(assigned: DataFrame, conflicts: DataFrame, frozen: DataFrame, policy: str = "split-v1") -> DataFrame:
    """Rows of a split registry: (policy_version, kind, task_id, scope, split_group_id), kind FROZEN, NEW, QUARANTINED or INVALIDATED.

    All tasks of a conflict are invalidated. A registry is a table, written and read as one.
    """
    none = F.lit(None).cast("string")
    kind = F.when(F.col("quarantined"), "QUARANTINED").otherwise("NEW")
    new = assigned.join(frozen.select("task_id"), "task_id", "left_anti").select(kind.alias("kind"), "task_id", "scope", "split_group_id")
    old = frozen.select(F.lit("FROZEN").alias("kind"), "task_id", "scope", none.alias("split_group_id"))
    gone = conflicts.select(F.lit("INVALIDATED").alias("kind"), F.explode("tasks").alias("task_id"), none.alias("scope"), none.alias("split_group_id"))
    return old.union(new).union(gone).select(F.lit(policy).alias("policy_version"), "kind", "task_id", "scope", "split_group_id")


def frozen_of(rows: DataFrame, policy: str = "split-v1") -> DataFrame:
    """(task_id, scope) that a registry has frozen; a registry of another policy, or a row without id or scope, ends the query."""
    good = (F.col("policy_version") == policy) & F.col("task_id").isNotNull() & F.col("scope").isNotNull()
    return rows.filter("kind = 'FROZEN'").filter(F.when(good, True).otherwise(F.raise_error(F.lit("no valid split registry")).cast("boolean"))).select("task_id", "scope")
