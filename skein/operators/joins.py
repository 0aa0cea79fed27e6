"""Joins with stated semantics for duplicates and missing sides, and the links that a revocation follows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """The last row of each key by position."""
    w = Window.partitionBy(*keys).orderBy(F.col(position).desc())
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def missing(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right, keys, "left_anti")


def selection(rows: DataFrame, selected: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are selected, once each however often they are."""
    return rows.join(selected.select(*keys), keys, "left_semi")


def strict_join(left: DataFrame, right: DataFrame, keys: list[str], what: str) -> DataFrame:
    """Inner join of which every left row must have a match; one that has none ends the query when it is read."""
    seen = left.join(right.withColumn("_seen", F.lit(True)), keys, "left")
    return seen.filter(F.when(F.col("_seen"), True).otherwise(F.raise_error(F.lit(f"{what} is missing")).cast("boolean"))).drop("_seen")


def duplicated(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).count().filter("count > 1")


def merge_conflicts(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys of both sides whose rows differ in any column."""
    cols = [c for c in new.columns if c != key]
    a, b = (df.select(key, F.struct(*cols).alias(n)) for df, n in ((existing, "a"), (new, "b")))
    return a.join(b, key).filter(~F.col("a").eqNullSafe(F.col("b"))).select(key)


def merge(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows, and existing rows of other keys."""
    return new.unionByName(existing.join(new, key, "left_anti"))


#: What becomes of a dataset, a run and a claim that a revoked source reaches.
REVOCATION_ACTIONS = {"dataset": "INVALIDATE_DISTRIBUTION", "run": "INVALIDATE_EVIDENCE", "claim": "INVALIDATE_CLAIM"}


def lineage_links(members: DataFrame, runs: DataFrame | None = None, claims: DataFrame | None = None) -> DataFrame:
    """links(src_kind, src, dst_kind, dst) for graph.reachable: sources to datasets and members, members to decisions, and all four to runs and claims.

    members(dataset_id, source_record_ids, attempt_id or demonstration_id, quality_decision_id or eligibility_decision_id); runs
    with run_id and claims with claim_id name any of source_record_ids, dataset_id, attempt_id and quality_decision_id. Runs
    do not lead to claims. Missing columns and nulls are no links.
    """

    def column(df: DataFrame, *names: str) -> Column:
        return F.coalesce(*(F.col(n) for n in names if n in df.columns), F.lit(None))

    def link(df: DataFrame, src_kind: str, src: Column, dst_kind: str, dst: Column) -> DataFrame:
        return df.select(F.lit(src_kind).alias("src_kind"), src.cast("string").alias("src"), F.lit(dst_kind).alias("dst_kind"), dst.cast("string").alias("dst")).filter("src is not null and dst is not null")

    each = members.select(F.explode("source_record_ids").alias("source"), column(members, "dataset_id").alias("dataset"), column(members, "attempt_id", "demonstration_id").alias("member"))
    out = [link(each, "source", F.col("source"), kind, F.col(kind)) for kind in ("dataset", "member")]
    out.append(link(members, "member", column(members, "attempt_id", "demonstration_id"), "decision", column(members, "quality_decision_id", "eligibility_decision_id")))
    for df, kind in ((runs, "run"), (claims, "claim")):
        if df is not None:
            own = F.col(f"{kind}_id")
            if "source_record_ids" in df.columns:
                out.append(link(df.select(own, F.explode("source_record_ids").alias("source")), "source", F.col("source"), kind, own))
            out += [link(df, src, column(df, name), kind, own) for src, name in (("dataset", "dataset_id"), ("member", "attempt_id"), ("decision", "quality_decision_id"))]
    return reduce(DataFrame.union, out).distinct()


def revocation_effects(reached: DataFrame) -> DataFrame:
    """(kind, id, action) of what graph.reachable found: datasets, runs and claims, and what becomes of each."""
    action = F.create_map(*(F.lit(x) for pair in REVOCATION_ACTIONS.items() for x in pair))
    return reached.filter(F.col("kind").isin(*REVOCATION_ACTIONS)).select("kind", "id", action[F.col("kind")].alias("action"))


def matched_pairs(pool: DataFrame, keys: list[str], is_target, order: str) -> DataFrame:
    """(keys, target, control): the n-th target and the n-th control of equal keys, in order; the rest stay alone."""
    w = Window.partitionBy(*keys, "_t").orderBy(order)
    ranked = pool.withColumn("_t", is_target).withColumn("_n", F.row_number().over(w))
    t = ranked.filter("_t").select(*keys, "_n", F.col(order).alias("target"))
    c = ranked.filter("not _t").select(*keys, "_n", F.col(order).alias("control"))
    return t.join(c, [*keys, "_n"]).select(*keys, "target", "control")


def in_order(selected: list[str], rows: DataFrame, key: str) -> DataFrame:
    """Rows of the selected keys in the caller's order; keys that repeat, or that no row has, are an error."""
    if not selected or len(set(selected)) != len(selected):
        raise ValueError("a selection has keys, each once")
    wanted = rows.sparkSession.createDataFrame(list(enumerate(selected)), f"position int, {key} {rows.schema[key].dataType.simpleString()}")
    return strict_join(wanted, rows, [key], key).orderBy("position").drop("position")


def lookup(rows: DataFrame, key: str, value: object) -> dict:
    """The one row of a key; an error when it is absent."""
    found = rows.filter(F.col(key) == F.lit(value)).limit(1).collect()
    if not found:
        raise KeyError(value)
    return found[0].asDict()


def set_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one side has more often than the other, with `side`; none if both are the same bag."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).union(b.exceptAll(a).withColumn("side", F.lit("right")))


def uncovered(key: str, **sides: DataFrame) -> DataFrame:
    """Keys that some of the sides lack, with a boolean a side."""
    out = None
    for name, df in sides.items():
        own = df.select(key).distinct().withColumn(name, F.lit(True))
        out = own if out is None else out.join(own, key, "full")
    flags = [F.coalesce(F.col(n), F.lit(False)).alias(n) for n in sides]
    rows = out.select(key, *flags)
    return rows.filter(~reduce(lambda x, y: x & y, (F.col(n) for n in sides)))
