"""Aggregated reports. Counts have fixed denominators; a ratio over nothing is null unless said otherwise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.operators.decisions import terminal_class
from skein.storage import materialize


def execution_quality(members: DataFrame) -> DataFrame:
    """One row of counts over members(task_id, attempt_id, decision, outcome, usage_scope); costs are unknown."""
    is_ = lambda c, v: F.count_if(F.col(c) == v)
    return members.agg(F.count_distinct("task_id").alias("tasks"), F.count_distinct("attempt_id").alias("attempts"), is_("decision", "ACCEPT").alias("accepted"), is_("decision", "REJECT").alias("rejected"), is_("decision", "QUARANTINE").alias("quarantined"), is_("outcome", "PASS").alias("passed"), F.count_if(F.col("outcome").isNull() | (F.col("outcome") == "UNKNOWN")).alias("unknown_outcomes"), is_("usage_scope", "TRAIN").alias("train"), is_("usage_scope", "DEVELOPMENT").alias("development"), is_("usage_scope", "TEST").alias("test"), F.lit(None).cast("bigint").alias("cost_cny_fen"))


def external_quality(members: DataFrame) -> DataFrame:
    is_ = lambda c, v: F.count_if(F.col(c) == v)
    return members.agg(F.count_distinct("demonstration_id").alias("demonstrations"), F.count_distinct("source_record_id").alias("sources"), is_("eligibility_action", "ACCEPT").alias("accepted"), is_("source_origin", "DERIVED").alias("derived"), is_("replay_capability", "SUPPORTED").alias("replayable"), is_("replay_capability", "UNSUPPORTED").alias("not_replayable"))


def quality_report(members: DataFrame) -> dict:
    """The report that fits the member kind, as a dict."""
    return (external_quality(members) if "demonstration_id" in members.columns else execution_quality(members)).first().asDict()


def findings(records: DataFrame) -> DataFrame:
    """Per family with failures: counts of failures and successes, category, confidence and finding_id; finding_tasks names the tasks.

    Infrastructure is the category only where every failure is one; confidence is low where any task succeeded.
    """
    failed = ~F.col("task_success")
    g = records.groupBy("family").agg(F.count_if(failed).alias("failures"), F.count_if("task_success").alias("successes"), F.bool_and(F.when(failed, F.coalesce(F.length("unresolved_infrastructure"), F.lit(0)) > 0)).alias("infra"))
    return g.filter("failures > 0").select("family", "failures", "successes", F.when(F.col("infra"), "INFRASTRUCTURE").otherwise("CONSTRAINT_FAILURE").alias("category"), F.when(F.col("successes") > 0, "LOW").otherwise("MEDIUM").alias("confidence"), F.concat(F.lit("finding-"), "family").alias("finding_id"))


def finding_tasks(records: DataFrame) -> DataFrame:
    """(finding_id, task_id) of all failed tasks, a row each, so that no family's list is one row."""
    return records.filter(~F.col("task_success")).select(F.concat(F.lit("finding-"), "family").alias("finding_id"), "task_id")


def evaluation_metrics(records: DataFrame) -> DataFrame:
    """One row over all requested tasks: success, effective coverage, conditional success (null without effective runs), slices (0 for none) and costs."""
    n = F.count(F.lit(1))
    share = lambda c, of: F.count_if(c & of) / F.greatest(F.lit(1), F.count_if(of))
    ok, eff = F.col("task_success"), F.col("effective_execution")
    return records.agg(n.alias("tasks"), (F.count_if(ok) / n).alias("task_success_at_1"), (F.count_if(eff) / n).alias("effective_coverage"), F.try_divide(F.count_if(ok & eff), F.count_if(eff)).alias("conditional_success"), share(ok, F.col("recovery_condition")).alias("recovery_success"), share(ok, F.col("unseen_combination")).alias("unseen_success"), F.sum("model_calls").alias("model_calls"), F.sum("completion_tokens").alias("completion_tokens"), F.sum("provider_cost_cny").alias("provider_cost_cny"))


def rescored(evidence: DataFrame, policy: dict) -> DataFrame:
    """evidence(attempt_id, task_id, end_reason, verification_status, outcome, total_reward, and reward_policy_version if it has one) under another terminal policy.

    policy: policy_version, pass_reward and fail_reward; a policy that gives unknown results a reward, or rewards steps, is an error. What is
    truncated or unknown has no reward. Columns: terminal_class, availability, new_reward, reward_policy_version, reward_scope,
    source_policy_version, and the evidence's own.
    """
    version, good, bad = (policy.get(k) for k in ("policy_version", "pass_reward", "fail_reward"))
    if not isinstance(version, str) or not version or any(isinstance(x, bool) or not isinstance(x, (int, float)) for x in (good, bad)):
        raise ValueError("a reward policy has a version and the rewards of a pass and a fail")
    if policy.get("unknown_reward") is not None or policy.get("dense_reward") not in (None, False):
        raise ValueError("a terminal policy leaves what is unknown unknown, and rewards no steps")
    rows = evidence.withColumn("terminal_class", terminal_class(F.col("end_reason"), F.col("verification_status"), F.col("outcome")))
    new = F.when(F.col("terminal_class") == "success", float(good)).when(F.col("terminal_class") == "known_zero", float(bad))
    source = F.col("reward_policy_version") if "reward_policy_version" in evidence.columns else F.lit(None).cast("string")
    return rows.withColumn("source_policy_version", source).withColumns({"new_reward": new, "availability": F.when(new.isNotNull(), "KNOWN").otherwise("UNKNOWN"), "reward_policy_version": F.lit(version), "reward_scope": F.lit("TERMINAL")})


def rescore(records: DataFrame, least: int | None = None) -> DataFrame:
    """Per terminal class: rows, and how many kept their reward (null equals null); classes below `least` rows are left out."""
    kept = F.col("new_reward").eqNullSafe(F.col("total_reward"))
    out = records.groupBy("terminal_class").agg(F.count(F.lit(1)).alias("records"), F.count_if(kept).alias("same"), F.count_if(~kept).alias("changed"))
    return out if least is None else out.filter(F.col("records") >= least)


#: The classes that a rescoring must cover, and how often each.
RESCORE_CLASSES, RESCORE_LEAST = ("success", "known_zero", "truncated", "unknown", "error"), 2


def rescore_coverage(records: DataFrame, classes: tuple[str, ...] = RESCORE_CLASSES[:4], least: int = RESCORE_LEAST) -> DataFrame:
    """Required classes that have too few records."""
    wanted = records.sparkSession.createDataFrame([(c,) for c in classes], "terminal_class string")
    return wanted.join(rescore(records, least), "terminal_class", "left_anti")


def reward_accounting(records: DataFrame) -> DataFrame:
    """One row: share of known rewards, and share of tasks with only known rewards that are all zero (null for none)."""
    tasks = records.groupBy("task_id").agg(F.bool_and(F.col("total_reward").isNotNull()).alias("known"), F.max("total_reward").alias("best"), F.count(F.lit(1)).alias("n"), F.count("total_reward").alias("k"))
    return tasks.agg((F.sum("k") / F.sum("n")).alias("computable_rate"), F.try_divide(F.count_if(F.col("known") & (F.col("best") == 0)), F.count_if("known")).alias("all_zero_rate"))


def spend(entries: DataFrame, limits: DataFrame, quotes: DataFrame) -> DataFrame:
    """Per resource kind of any of the three: spent, the largest stop limit, whether an external run is allowed, and why not.

    A kind needs a quote and an authorisation (limits(resource_kind, stop_limit_fen)), and to have spent less than its limit.
    """
    used = entries.groupBy("resource_kind").agg(F.sum("cost_cny_fen").alias("spent"))
    most = limits.groupBy("resource_kind").agg(F.max("stop_limit_fen").alias("stop"))
    quoted = quotes.select("resource_kind").distinct().withColumn("quoted", F.lit(True))
    rows = most.join(used, "resource_kind", "full").join(quoted, "resource_kind", "full").withColumn("spent", F.coalesce("spent", F.lit(0)))
    reason = F.when(F.col("quoted").isNull(), "missing quote").when(F.col("stop").isNull(), "missing authorization").when(F.col("spent") >= F.col("stop"), "stop limit reached")
    return rows.select("resource_kind", "spent", "stop", reason.isNull().alias("allowed"), reason.alias("reason"))


def coverage(tasks: DataFrame, by: str, least: int) -> DataFrame:
    """Groups below a minimum."""
    return tasks.groupBy(by).count().filter(F.col("count") < least)


def assertions(df: DataFrame, **checks: Column) -> DataFrame:
    """One row of named checks and `passed`, true if all hold."""
    row = df.agg(*(F.coalesce(F.bool_and(F.coalesce(c, F.lit(False))), F.lit(False)).alias(n) for n, c in checks.items()))
    ok = F.lit(True)
    for n in checks:
        ok = ok & F.col(n)
    return row.withColumn("passed", ok)


#: Column names that are sensitive, and those of free text.
SENSITIVE, FREE_TEXT = ("email", "phone", "password", "token", "address", "user_id"), ("question", "messages")


def profile(df: DataFrame, required: list[str]) -> DataFrame:
    """One row: record_count, required_field_status and sensitive_check_status, by column names; only the count reads the table."""
    names = set(df.columns)
    fields = "NOT_DECLARED" if not required else "AVAILABLE" if set(required) <= names else "MISSING"
    sensitive = "SENSITIVE_FIELD_NAMES_PRESENT" if names & set(SENSITIVE) else "POTENTIAL_FREE_TEXT_REVIEW_REQUIRED" if names & set(FREE_TEXT) else "NO_DECLARED_SENSITIVE_FIELD_NAMES"
    return df.agg(F.count(F.lit(1)).alias("record_count"), F.lit(fields).cast("string").alias("required_field_status"), F.lit(sensitive).alias("sensitive_check_status"))


def tool_names(column: str, df: DataFrame, rows: int | None = 1000) -> DataFrame:
    """(name): tool names in the first `rows` values (all, if None) of a column of JSON text or of names between commas.

    An object with a textual `name` or `tool_name` gives these and is not looked into; other objects, lists and JSON inside
    texts are. Each round takes one level of nesting of all rows at once, natively; blank names and nulls give nothing.
    """
    v = F.col("v")
    kind = F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)
    todo = df.select(F.col(column).cast("string").alias("t")).filter("t is not null")
    todo = (todo if rows is None else todo.limit(rows)).distinct()
    names: list[DataFrame] = []
    while True:
        read = materialize(todo.select("t", F.try_parse_json("t").alias("v")), "tool-names")
        names.append(read.filter("v is null").select(F.explode(F.split("t", ",")).alias("name")))
        whole = read.filter("v is not null").select("v")
        texts = []
        while not whole.isEmpty():  # a level of nesting a round
            kinds = whole.withColumn("kind", kind)
            own = [F.when(F.schema_of_variant(F.try_variant_get(v, p, "variant")) == "STRING", F.try_variant_get(v, p, "string")) for p in ("$.name", "$.tool_name")]
            objects = kinds.filter("kind = 'OBJECT'").withColumn("own", F.filter(F.array(*own), lambda x: x.isNotNull() & (F.trim(x) != "")))
            names.append(objects.select(F.explode("own").alias("name")))
            texts.append(kinds.filter("kind = 'STRING'").select(F.try_variant_get(v, "$", "string").alias("t")))
            open_ones = objects.filter("size(own) = 0").select("v").union(kinds.filter("kind = 'ARRAY'").select("v"))
            open_ones.createOrReplaceTempView("skein_tool_names")
            whole = materialize(df.sparkSession.sql("SELECT x.value AS v FROM skein_tool_names, LATERAL variant_explode(v) AS x"), "tool-names")
        todo = reduce(DataFrame.union, texts).distinct() if texts else None
        if todo is None or todo.isEmpty():
            return reduce(DataFrame.union, names).select(F.trim("name").alias("name")).filter("name <> ''").distinct()


def stage_counts(rows: DataFrame, by: str, stages: dict[str, Column]) -> DataFrame:
    """Per group: rows, rows of each stage, and the last stage's share of all."""
    n = F.count(F.lit(1))
    last = list(stages)[-1]
    return rows.groupBy(by).agg(n.alias("imported"), *(F.count_if(c).alias(s) for s, c in stages.items()), (F.count_if(stages[last]) / n).alias("retention"))


def throughput(loss_tokens: int, seconds: list[float], reserve: float = 0.15) -> dict:
    """Two runs' loss tokens a second (null for no time), and what six runs take, without and with the reserve."""
    total = sum(seconds)
    return {"throughput_loss_tokens_per_second": 2 * loss_tokens / total if total else None, "six_run_seconds_prediction": total * 3, "six_run_seconds_with_failure_reserve": total * 3 * (1 + reserve)}


def quote_allows(price_per_hour: float, stop: float, seconds: float, reserve: float) -> float:
    """The predicted cost; an error if price or stop isn't positive, or the cost with its reserve is above the stop."""
    if price_per_hour <= 0 or stop <= 0:
        raise ValueError("price and stop must be positive")
    predicted = price_per_hour * seconds / 3600
    if predicted * (1 + reserve) > stop:
        raise ValueError("the stop is below the prediction with its reserve")
    return predicted


def diversity(members: DataFrame) -> DataFrame:
    """One row: distinct members (demonstrations or tasks) and distinct source records."""
    external = "demonstration_id" in members.columns
    unique = F.count_distinct("demonstration_id" if external else "task_id").alias("unique_demonstrations" if external else "unique_tasks")
    sources = members.select(F.explode("source_record_ids").alias("s")).agg(F.count_distinct("s").alias("source_records"))
    return members.agg(unique).join(F.broadcast(sources))  # one row each


def token_totals(view: DataFrame) -> DataFrame:
    """One row over a training view: examples, input tokens and loss tokens."""
    return view.agg(F.count(F.lit(1)).alias("examples"), F.sum(F.size("input_ids")).alias("input_tokens"), F.sum(F.size(F.filter("loss_mask", lambda m: m))).alias("loss_tokens"))
