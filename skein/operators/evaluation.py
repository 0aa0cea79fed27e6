"""Evaluation runs and the verification of attempts, over results that were recorded before."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions.text import whole_or_zero
from skein.operators.decisions import task_success, verify
from skein.operators.joins import duplicated, in_order, strict_join

#: A task is tried again only after an infrastructure failure, and then once.
ATTEMPTS = 2


def evaluation_records(tasks: DataFrame, results: DataFrame) -> DataFrame:
    """One record a task, whether it has results or not: the denominator is fixed.

    results(task_id, attempt_number, error, value, unit, evidence, constraint_valid, model_calls, completion_tokens,
    provider_cost_cny): the first attempt without an error counts, of the first ATTEMPTS; later ones are not looked at.
    """
    tried = results.filter(F.col("attempt_number") <= ATTEMPTS)
    fields = ("value", "unit", "evidence", "constraint_valid", "model_calls", "completion_tokens", "provider_cost_cny")
    ran = F.when(F.col("error").isNull(), F.struct(*fields))
    own = tried.groupBy("task_id").agg(
        F.min_by(ran, F.when(F.col("error").isNull(), F.col("attempt_number"))).alias("r"),
        F.min(F.when(F.col("error").isNull(), F.col("attempt_number"))).alias("completed"),
        F.max_by("error", "attempt_number").alias("error"),
        F.count(F.lit(1)).alias("n"),
    )
    rows = tasks.join(own, "task_id", "left")
    effective = F.col("completed").isNotNull()
    success = effective & task_success(F.col("expected_value"), F.col("expected_unit"), F.col("document_ids"), F.col("r.value"), F.col("r.unit"), F.col("r.evidence"), F.col("r.constraint_valid"))
    return rows.select(
        "task_id",
        "group_id",
        "family",
        "recovery_condition",
        "unseen_combination",
        success.alias("task_success"),
        effective.alias("effective_execution"),
        F.when(~effective, F.coalesce("error", F.lit("not run"))).alias("unresolved_infrastructure"),
        F.coalesce("completed", "n", F.lit(0)).cast("int").alias("attempts"),
        (~success).alias("constraint_violation"),
        whole_or_zero(F.col("r.model_calls")).alias("model_calls"),
        whole_or_zero(F.col("r.completion_tokens")).alias("completion_tokens"),
        F.col("r.provider_cost_cny").alias("provider_cost_cny"),
    )


def evaluation_tasks(suite: DataFrame, split: str, selected: list[str] | None = None, test_unlocked: bool = False) -> DataFrame:
    """Tasks of a split, or a declared subset of the development split in the caller's order; the test split is locked."""
    if split == "TEST" and not test_unlocked:
        raise ValueError("the test split is locked")
    tasks = suite.filter(F.col("split") == split)
    if selected is None:
        return tasks
    if split != "DEVELOPMENT":
        raise ValueError("only development tasks can be selected")
    return in_order(selected, tasks, "task_id")


def verify_attempts(tasks: DataFrame, expected: DataFrame, attempts: DataFrame, version: str) -> DataFrame:
    """(attempt_id, task_id, verifier_version, status, outcome) of attempts(attempt_id, task_id, value, unit, evidence).

    expected(task_id, value, unit, required_evidence) is private and joined here alone. A task that occurs twice is an
    error; an attempt without a task, a reference or a final output ends the query.
    """
    if not duplicated(tasks, ["task_id"]).isEmpty():
        raise ValueError("task_id is not unique")
    own = expected.select("task_id", F.col("value").alias("want_value"), F.col("unit").alias("want_unit"), "required_evidence")
    rows = strict_join(strict_join(attempts, tasks.select("task_id"), ["task_id"], "task"), own, ["task_id"], "reference")
    sealed = F.when(F.col("value").isNull(), F.raise_error(F.lit("an attempt has no final output")).cast("string")).otherwise(F.col("value"))
    outcome = verify(sealed, F.col("unit"), F.col("evidence"), F.col("want_value"), F.col("want_unit"), F.col("required_evidence"), F.lit("VERIFIED"))
    return rows.select("attempt_id", "task_id", F.lit(version).alias("verifier_version"), F.lit("VERIFIED").alias("status"), outcome.alias("outcome"))


def verification_counts(verified: DataFrame) -> DataFrame:
    """One row: attempts, passed, failed and unknown."""
    is_ = lambda v: F.count_if(F.col("outcome") == v)
    return verified.agg(F.count(F.lit(1)).alias("attempt_count"), is_("PASS").alias("pass_count"), is_("FAIL").alias("fail_count"), is_("UNKNOWN").alias("unknown_count"))
