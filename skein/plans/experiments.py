"""What an experiment's training views may hold: one table of violations over all recipes and their members."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The recipes of a comparison, and where their members must not come from.
RECIPES = ("SFT-RandomMatched", "SFT-ClosedLoop")


def digest(value: object) -> str:
    """SHA-256 of a small value's canonical JSON, such as a manifest's list of file hashes."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def view_violations(views: DataFrame, members: DataFrame) -> DataFrame:
    """(recipe, demonstration_id, fault) of views(recipe, demonstration_id), every fault a row.

    ABSENT: no member. NOT_ACCEPTED: the member is of no origin that may enter, or isn't accepted. NO_MESSAGE_LINEAGE,
    NO_REPAIR_LINEAGE: it can't be traced. SELECTED_TWICE: a recipe has it more than once. UNKNOWN_RECIPE: the recipe is not of the comparison.
    """
    optional = lambda c: F.col(c) if c in members.columns else F.lit(None).cast("string")
    origin = F.col("source_origin").isin("PUBLIC_ORIGINAL", "DERIVED") & (F.col("eligibility_action") == "ACCEPT")
    faults = {
        "NOT_ACCEPTED": ~F.coalesce(origin, F.lit(False)),
        "NO_MESSAGE_LINEAGE": F.coalesce(F.size("upstream_message_refs"), F.lit(0)) <= 0,
        "NO_REPAIR_LINEAGE": F.coalesce(F.col("source_origin") == "DERIVED", F.lit(False)) & (optional("parent_demonstration_id").isNull() | optional("repair_rule_ref").isNull()),
    }
    own = members.select("demonstration_id", F.lit(True).alias("known"), F.array(*(F.when(c, n) for n, c in faults.items())).alias("own"))
    times = views.groupBy("recipe", "demonstration_id").agg(F.count("*").alias("n"))
    rows = times.join(own, "demonstration_id", "left")
    every = F.when(F.col("known").isNull(), F.array(F.lit("ABSENT"))).otherwise(F.col("own"))
    more = F.array(F.when(F.col("n") > 1, "SELECTED_TWICE"), F.when(~F.coalesce(F.col("recipe").isin(*RECIPES), F.lit(False)), "UNKNOWN_RECIPE"))
    return rows.select("recipe", "demonstration_id", F.explode(F.array_compact(F.concat(every, more))).alias("fault"))
