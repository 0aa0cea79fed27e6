"""Recipe pools, matched selection and equal batch schedules."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.functions.text import before_dash, length_bin, quoted_name, tags

MATCH = ("source_id", "task_family", "dependency_depth", "length_bin", "verification_strength", "baseline_difficulty")


def candidate_pool(members: DataFrame, version: str) -> DataFrame:
    """Profiles of accepted members(demonstration_id, eligibility_action, messages, review_checks).

    messages: array of struct(role, content, tool_call struct(raw_content)). A member without any tool name ends the query.
    The labels are fixed values.
    """
    own = members.filter("eligibility_action = 'ACCEPT'")
    names = F.array_compact(F.transform("messages", lambda m: quoted_name(m.tool_call.raw_content)))
    asked = F.lower(F.array_join(F.transform(F.filter("messages", lambda m: m.role == "user"), lambda m: F.coalesce(m.content, F.lit(""))), " "))
    some = F.when(F.size(names) > 0, names).otherwise(F.raise_error(F.concat(F.lit("no tool call in "), F.coalesce("demonstration_id", F.lit("null")))).cast("array<string>"))
    rows = own.select("demonstration_id", some.alias("names"), F.size("messages").alias("n"), asked.alias("asked"), F.coalesce(F.size("review_checks"), F.lit(0)).alias("checks"))
    return rows.select(
        "demonstration_id",
        F.lit(version).alias("candidate_pool_version"),
        before_dash(F.element_at("names", 1)).alias("source_id"),
        F.when(F.size("names") >= 3, "cross_document_comparison").otherwise("lookup").alias("task_family"),
        F.least(F.size("names"), F.lit(3)).alias("dependency_depth"),
        length_bin(F.col("n")).alias("length_bin"),
        F.when(F.col("checks") >= 6, "strong").otherwise("standard").alias("verification_strength"),
        F.when(F.size("names") <= 3, "medium").otherwise("high").alias("baseline_difficulty"),
        tags(F.col("asked"), {"social media": "CONSTRAINT_FAILURE"}).alias("failure_types"),
        F.struct(F.size("names").alias("tool_call_count"), F.col("n").alias("message_count"), F.element_at("names", 1).alias("first_tool")).alias("source_observable"),
    )


#: What an action must not bring in.
INGRESS = ("PROJECT_SAMPLING", "MODEL_GENERATION", "MODEL_EVALUATION")


def development_only(evaluation: DataFrame, findings: DataFrame) -> DataFrame:
    """Rows of evaluation(split) and findings(evaluation_split) that are of another split than DEVELOPMENT, or of none: feedback takes none of these."""
    other = lambda df, c, name: df.select(F.lit(name).alias("source"), F.col(c).cast("string").alias("split")).filter("split is null or split <> 'DEVELOPMENT'")
    return other(evaluation, "split", "evaluation").union(other(findings, "evaluation_split", "findings"))


def data_actions(findings: DataFrame, pool: DataFrame) -> DataFrame:
    """One action a finding, on the single version of the pool; a pool of several versions, or none, is an error."""
    versions = [r[0] for r in pool.select("candidate_pool_version").distinct().limit(2).collect()]
    if len(versions) != 1 or versions[0] is None:
        raise ValueError("the candidates must belong to exactly one frozen pool")
    return findings.select(
        F.concat(F.lit("action-"), "finding_id").alias("action_id"),
        "finding_id",
        F.lit(versions[0]).alias("candidate_pool_version"),
        F.lit("RESELECT_SAME_POOL").alias("action"),
        F.struct(F.col("family").alias("task_family"), F.col("category").alias("failure_type")).alias("target_slice"),
        F.lit("ACTIONED").alias("status"),
        F.lit(None).cast("string").alias("retest_ref"),
        F.array(*map(F.lit, INGRESS)).alias("prohibited_ingress"),
    )


def matched_selection(actions: list[dict], pool: DataFrame, order: str = "demonstration_id") -> tuple[list[dict], list[dict]]:
    """(pairs, excluded): for each action the first unused target of its slice, and the first unused control of its match fields.

    actions: dicts of finding_id, task_family, failure_type, in order. A target without a control uses up nothing; pairs and
    exclusions name their finding. As k actions use at most 2 k members, the first 2 k + 1 targets of a slice and controls of
    a match key are all that the driver needs: some k (2 k + 1) ** 2 rows from two jobs, whatever the size of the pool.
    """
    if not actions:
        return [], []
    spark, most = pool.sparkSession, 2 * len(actions) + 1
    slices = spark.createDataFrame(sorted({(a["task_family"], a["failure_type"]) for a in actions}), "task_family string, wanted string")
    fields = [order, *(c for c in ("demonstration_id", *MATCH, "failure_types") if c != order)]
    per = pool.select(*fields).join(F.broadcast(slices), "task_family")  # a row an action at most
    has = F.array_contains("failure_types", F.col("wanted"))
    first = Window.partitionBy("task_family", "wanted").orderBy(order)
    targets = per.filter(has).withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= most).collect()
    keys = sorted({(*(t[c] for c in MATCH), t["wanted"]) for t in targets}, key=str)
    controls: dict[tuple, list[str]] = {}
    if keys:
        kinds = ", ".join(f"{c} {pool.schema[c].dataType.simpleString()}" for c in MATCH)
        wanted = spark.createDataFrame(keys, f"{kinds}, wanted string")
        near = per.filter(~has).join(F.broadcast(wanted), [*MATCH, "wanted"])
        w = Window.partitionBy(*MATCH, "wanted").orderBy(order)
        for r in near.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= most).orderBy("_n").collect():
            controls.setdefault((*(r[c] for c in MATCH), r["wanted"]), []).append(r["demonstration_id"])
    used: set[str] = set()
    pairs, excluded = [], []
    for a in actions:
        mine = sorted((t for t in targets if (t["task_family"], t["wanted"]) == (a["task_family"], a["failure_type"])), key=lambda t: t["_n"])
        target = next((t for t in mine if t["demonstration_id"] not in used), None)
        if target is None:
            excluded.append({"finding_id": a["finding_id"], "reason": "NO_TARGET_SUPPORT"})
            continue
        key = tuple(target[c] for c in MATCH)
        control = next((c for c in controls.get((*key, a["failure_type"]), []) if c not in used), None)
        if control is None:
            excluded.append({"finding_id": a["finding_id"], "reason": "NO_MATCHED_CONTROL"})
            continue
        used |= {target["demonstration_id"], control}
        pairs.append({"finding_id": a["finding_id"], "target": target["demonstration_id"], "control": control, "match_key": key, "target_failure_type": a["failure_type"]})
    return pairs, excluded


def cycle(examples: DataFrame, id_col: str, slots: int) -> DataFrame:
    """(slot, id): the first `slots` examples in the order of their ids, over and over."""
    used = examples.select(id_col).orderBy(id_col).limit(slots)  # later ones have no slot
    ranked = used.select(id_col, (F.row_number().over(Window.orderBy(id_col)) - 1).alias("i"))
    n = F.count(F.lit(1)).over(Window.partitionBy())
    total = F.lit(slots).cast("long")
    return ranked.withColumn("n", n).select(F.explode(F.sequence(F.col("i").cast("long"), total - 1, F.col("n"))).alias("slot"), id_col)


def equal_schedule(examples: DataFrame, batch: int, steps: int, most: int) -> DataFrame:
    """(recipe, slot, demonstration_id, input_tokens, loss_tokens) from examples(recipe, demonstration_id, input_ids, loss_mask) of up to `most` tokens."""
    fit = examples.filter(F.size("input_ids") <= most).select("recipe", "demonstration_id", F.size("input_ids").alias("input_tokens"), F.size(F.filter("loss_mask", lambda m: m)).alias("loss_tokens"))
    w = Window.partitionBy("recipe")
    ranked = fit.withColumn("i", F.row_number().over(w.orderBy("demonstration_id")) - 1).withColumn("n", F.count(F.lit(1)).over(w))
    total = F.lit(batch * steps)  # an example's slots are i, i + n, i + 2n ..., made without the slots of others
    return ranked.filter(F.col("i") < total).withColumn("slot", F.explode(F.sequence(F.col("i").cast("long"), total.cast("long") - 1, F.col("n")))).select("recipe", "slot", "demonstration_id", "input_tokens", "loss_tokens")


def schedule_totals(schedule: DataFrame) -> DataFrame:
    """Per recipe: loss tokens, slots and the longest context."""
    return schedule.groupBy("recipe").agg(F.sum("loss_tokens").alias("loss_tokens"), F.count(F.lit(1)).alias("slots"), F.max("input_tokens").alias("longest"))


def schedule_receipt(schedule: DataFrame, recipes: tuple[str, ...] = ("random", "closed_loop")) -> dict:
    """Totals of a schedule whose recipes all have slots and equal loss tokens; anything else is an error, nothing is padded."""
    rows = {r["recipe"]: r for r in schedule_totals(schedule).collect()}  # a row a recipe
    if set(rows) != set(recipes):
        raise ValueError("no complete example of a recipe fits the context")
    if len({r["loss_tokens"] for r in rows.values()}) != 1:
        raise ValueError("whole examples can't match the loss tokens exactly")
    context = max(r["longest"] for r in rows.values())
    one = rows[recipes[0]]
    return {"fixed_context_tokens": context, "effective_loss_tokens": one["loss_tokens"], "padded_input_tokens_per_recipe": one["slots"] * context, "no_target_padding": True}


def load_examples(view: DataFrame, selected: DataFrame) -> DataFrame:
    """Rows of a training view for selected(demonstration_id), in their order; missing or malformed ones end the query."""
    fault = (
        F.when(F.col("_seen").isNull(), "is absent from the view")
        .when(F.col("input_ids").isNull() | F.col("loss_mask").isNull(), "has invalid token columns")
        .when((F.size("input_ids") != F.size("loss_mask")) | (F.size("input_ids") == 0) | ~F.exists("loss_mask", lambda m: m), "needs a complete mask with a target")
    )
    joined = selected.select("demonstration_id").distinct().join(view.withColumn("_seen", F.lit(True)), "demonstration_id", "left")
    good = F.when(fault.isNull(), True).otherwise(F.raise_error(F.concat_ws(" ", "demonstration_id", fault)).cast("boolean"))
    return joined.filter(good).select("demonstration_id", "input_ids", "loss_mask").orderBy("demonstration_id")
