"""Row-level rules: eligibility, quality, verification, reward, findings and attribution. Unknown is never zero or false."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.identity import sha256, short_id
from skein.functions.numeric import decimal_equal

#: The six checks that publication of external members asks for.
REVIEW_CHECKS = (
    "source_identity",
    "upstream_tool_definition",
    "message_context",
    "target_answer_mapping",
    "split_registration",
    "sensitive_review",
)
ORIGINS = ("PUBLIC_ORIGINAL", "DERIVED")


def externalise(events: DataFrame, limit: int = 4096) -> DataFrame:
    """Observation payloads of more than `limit` UTF-8 bytes give way to a reference: hash, size and media type."""
    large = (F.col("event_type") == "OBSERVATION") & (F.octet_length("payload") > limit)
    ref = F.struct(sha256(F.col("payload")).alias("sha256"), F.octet_length("payload").cast("long").alias("byte_size"), F.lit("text/plain").alias("media_type"))
    return events.withColumn("payload_ref", F.when(large, ref)).withColumn("payload", F.when(~F.coalesce(large, F.lit(False)), F.col("payload")))


def decide_quality(attempts: DataFrame, verifications: DataFrame, representatives: DataFrame, policy: str) -> DataFrame:
    """attempts(attempt_id) with action, reason_code and decision_id.

    verifications(attempt_id, status, outcome, position): the last of an attempt counts. representatives(attempt_id,
    representative): an attempt without one is rejected as not its own representative.
    """
    last = verifications.groupBy("attempt_id").agg(F.max_by(F.struct("status", "outcome"), "position").alias("v")).select("attempt_id", "v.status", "v.outcome", F.lit(True).alias("seen"))
    return apply_quality_rule(attempts.join(last, "attempt_id", "left").join(representatives, "attempt_id", "left"), policy)


def apply_quality_rule(rows: DataFrame, policy: str) -> DataFrame:
    """rows(attempt_id, status, outcome, seen, representative) with action, reason_code and decision_id; seen is null without a verification."""
    own = F.col("attempt_id").eqNullSafe(F.col("representative"))
    unsure = (F.col("status") != "VERIFIED") | (F.col("outcome") == "UNKNOWN") | F.col("status").isNull() | F.col("outcome").isNull()
    rules = [
        (F.col("seen").isNull(), "QUARANTINE", "MISSING_VERIFICATION"),
        (unsure, "QUARANTINE", "VERIFICATION_UNKNOWN"),
        (F.col("outcome") == "FAIL", "REJECT", "VERIFICATION_FAIL"),
        (~own, "REJECT", "DUPLICATE_NON_REPRESENTATIVE"),
    ]
    decided = rows.withColumn("action", _first_rule(rules, 1, "ACCEPT")).withColumn("reason_code", _first_rule(rules, 2, "VERIFIED_PASS")).withColumn("policy_version", F.lit(policy))
    return decided.withColumn("decision_id", short_id("decision", "attempt_id", "action", "reason_code", "policy_version")).drop("seen")


def _first_rule(rules: list[tuple[Column, str, str]], part: int, default: str) -> Column:
    out = None
    for rule in rules:
        out = F.when(rule[0], rule[part]) if out is None else out.when(rule[0], rule[part])
    return out.otherwise(default)


def assess_eligibility(demonstrations: DataFrame) -> DataFrame:
    """Adds action and reason_code by tools, messages, schema_valid and source_origin, in this order."""
    project = F.col("source_origin").isin("PROJECT_SAMPLED", "MODEL_SAMPLED", "PROJECT_SYNTHETIC")
    rules = [(F.col("tools").isNull(), "REJECT", "MISSING_TOOL_DEFINITION"), (F.coalesce(F.size("messages"), F.lit(0)) <= 0, "REJECT", "MISSING_MESSAGE_CONTEXT"), (~F.coalesce(F.col("schema_valid"), F.lit(False)), "REJECT", "MALFORMED"), (project, "REJECT", "PROJECT_SAMPLING_INGRESS")]
    return demonstrations.withColumn("action", _first_rule(rules, 1, "ACCEPT")).withColumn("reason_code", _first_rule(rules, 2, "COMPLETE_EXTERNAL_DEMONSTRATION"))


def repair(demonstrations: DataFrame, new_id: Column, rule: str) -> DataFrame:
    """Copies under a new id that point at their parent, with the decision cleared."""
    return demonstrations.withColumn("parent_demonstration_id", F.col("demonstration_id")).withColumn("demonstration_id", new_id).withColumn("repair_rule_ref", F.lit(rule)).withColumn("eligibility_action", F.lit(None).cast("string"))


def verify(value: Column, unit: Column, evidence: Column, want_value: Column, want_unit: Column, want_evidence: Column, forced: Column) -> Column:
    """PASS, FAIL or UNKNOWN: equal as decimals, the same unit and all wanted evidence there; a forced status other than VERIFIED is UNKNOWN."""
    good = decimal_equal(value, want_value) & F.coalesce(unit == want_unit, F.lit(False)) & (F.size(F.array_except(F.coalesce(want_evidence, F.array().cast("array<string>")), F.coalesce(evidence, F.array().cast("array<string>")))) == 0)
    return F.when(forced.isNotNull() & (forced != "VERIFIED"), "UNKNOWN").when(good, "PASS").otherwise("FAIL")


def reward(status: Column, outcome: Column) -> Column:
    """1 or 0 for what is verified, null for what is not known."""
    return F.when((status == "VERIFIED") & (outcome == "PASS"), 1.0).when((status == "VERIFIED") & (outcome == "FAIL"), 0.0)


def terminal_class(end_reason: Column, status: Column, outcome: Column) -> Column:
    """Truncation comes first; null is an error for the caller."""
    return F.when(end_reason == "BUDGET_TRUNCATED", "truncated").when((status == "VERIFIED") & (outcome == "PASS"), "success").when((status == "VERIFIED") & (outcome == "FAIL"), "known_zero").when(outcome == "UNKNOWN", "unknown")


def attribution(rows: DataFrame, threshold: float, runs: int = 6) -> DataFrame:
    """Verdict on one row of mean, lower, guardrail_regression and completed_runs."""
    verdict = F.when(F.col("completed_runs") < runs, "INCOMPLETE").when(F.col("guardrail_regression"), "GUARDRAIL_REGRESSION").when(F.col("mean") < threshold, "NO_PRACTICAL_BENEFIT").when(F.col("lower") <= 0, "UNCERTAIN").otherwise("POSITIVE")
    return rows.withColumn("verdict", verdict)


def event_type(role: Column, has_call: Column) -> Column:
    """What a message is in an event log."""
    return F.when(role.isin("tool_call") | ((role == "assistant") & has_call), "TOOL_CALL").when(role.isin("tool", "tool_response"), "TOOL_RESULT").when(role == "assistant", "MODEL_OUTPUT").otherwise("OBSERVATION")


def training_role(role: Column) -> Column:
    return F.when(role == "tool_call", "assistant").when(role == "tool_response", "tool").otherwise(role)


def execution_violations(members: DataFrame) -> DataFrame:
    """Members that may not be published, with the first reason."""
    rules = [(F.col("task_id").isNull() | F.col("attempt_id").isNull(), "MISSING_FIELD"), (F.coalesce(F.size("source_record_ids"), F.lit(0)) <= 0, "NO_SOURCE"), (F.col("quality_decision_id").isNull(), "NO_DECISION"), (~((F.col("decision") == "ACCEPT") & (F.col("verification_status") == "VERIFIED") & (F.col("outcome") == "PASS")).eqNullSafe(F.lit(True)), "NOT_ACCEPTED"), (F.col("usage_scope") == "TRAIN", "TRAIN_FORBIDDEN")]
    return members.withColumn("violation", _first_rule([(c, r, r) for c, r in rules], 1, None)).filter("violation is not null")


def _no_items(name: str) -> Column:
    return F.coalesce(F.size(name), F.lit(0)) <= 0


def review_is_complete(checks: Column) -> Column:
    """Whether an array of check names has all of REVIEW_CHECKS."""
    return F.size(F.array_except(F.array(*map(F.lit, REVIEW_CHECKS)), F.coalesce(checks, F.array().cast("array<string>")))) == 0


#: What an external member must have.
EXTERNAL_FIELDS = (
    "demonstration_id",
    "source_record_id",
    "source_record_ids",
    "usage_scope",
    "eligibility_decision_id",
    "eligibility_action",
    "upstream_message_refs",
    "source_origin",
    "replay_capability",
    "review_checks",
)


def external_violations(members: DataFrame) -> DataFrame:
    """External members that may not be published, with the first reason; a column that is not there is a missing field."""
    lacks = F.lit(any(c not in members.columns for c in EXTERNAL_FIELDS))
    for c in set(EXTERNAL_FIELDS) - set(members.columns):
        members = members.withColumn(c, F.lit(None).cast("array<string>" if c in ("source_record_ids", "upstream_message_refs", "review_checks") else "string"))
    rules = [
        (lacks | F.col("demonstration_id").isNull(), "MISSING_FIELD"),
        (~F.col("usage_scope").eqNullSafe("TRAIN"), "NOT_TRAIN"),
        (~F.col("eligibility_action").eqNullSafe("ACCEPT"), "NOT_ACCEPTED"),
        (~F.coalesce(F.col("source_origin").isin(*ORIGINS), F.lit(False)), "ORIGIN"),
        (_no_items("source_record_ids"), "NO_SOURCE_LINEAGE"),
        (_no_items("upstream_message_refs"), "NO_MESSAGE_LINEAGE"),
        (F.coalesce(F.length("eligibility_decision_id"), F.lit(0)) == 0, "NO_DECISION"),
        (~review_is_complete(F.col("review_checks")), "REVIEW_CHECKS"),
    ]
    return members.withColumn("violation", _first_rule([(c, r, r) for c, r in rules], 1, None)).filter("violation is not null")


def publication_violations(members: DataFrame) -> DataFrame:
    """The gate of the members' kind: external ones have a demonstration_id. Of a mixed table every row is a violation."""
    if "demonstration_id" not in members.columns:
        return execution_violations(members)
    if "attempt_id" not in members.columns:
        return external_violations(members)
    return members.withColumn("violation", F.lit("MIXED_KINDS"))


def ingress(members: DataFrame) -> DataFrame:
    """External members in the order of their ids; an empty id or an origin that may not enter ends the query."""
    good = (F.coalesce(F.length("demonstration_id"), F.lit(0)) > 0) & F.coalesce(F.col("source_origin").isin(*ORIGINS), F.lit(False))
    return members.withColumn("demonstration_id", or_raise(good, F.col("demonstration_id"), "no external member")).orderBy("demonstration_id")


def or_raise(good: Column, value: Column, what: str) -> Column:
    """value where good holds; else the query ends. As a value, and no filter, it is not moved below the joins of its rows."""
    return F.when(good, value).otherwise(F.raise_error(F.concat(F.lit(f"{what}: "), F.coalesce(value.cast("string"), F.lit("null")))).cast("string"))


def demote_fixtures(attempts: DataFrame) -> DataFrame:
    """Scripted fixtures are never for training: their scope TRAIN becomes DEVELOPMENT."""
    fixture = (F.col("actor_kind") == "SCRIPTED_FIXTURE") & (F.col("usage_scope") == "TRAIN")
    return attempts.withColumn("usage_scope", F.when(fixture, "DEVELOPMENT").otherwise(F.col("usage_scope")))


def repair_decisions(decisions: DataFrame, replacements: DataFrame, policy: str) -> DataFrame:
    """REPAIR decisions of replacements(subject_id, replacement_subject_id), each pointing at the decision it follows.

    A replacement that is its own subject ends the query.
    """
    rows = decisions.join(replacements, "subject_id").select(F.col("decision_id").alias("parent_decision_id"), "subject_id", "replacement_subject_id")
    own = F.when(F.col("subject_id") == F.col("replacement_subject_id"), F.raise_error(F.lit("a repair needs another subject")).cast("string"))
    named = rows.select(F.coalesce(own, F.col("replacement_subject_id")).alias("subject_id"), "parent_decision_id", F.lit("REPAIR").alias("action"), F.array(F.lit("REPAIRED")).alias("reason_codes"), F.lit(policy).alias("policy_version"))
    return named.withColumn("decision_id", short_id("decision", "subject_id", "parent_decision_id", "action", "policy_version"))


def task_success(expected_value: Column, expected_unit: Column, documents: Column, value: Column, unit: Column, evidence: Column, valid: Column) -> Column:
    """An evaluation's answer: value as text, unit and the ordered list of evidence are equal, and no constraint is broken."""
    same = value.eqNullSafe(expected_value) & unit.eqNullSafe(expected_unit) & evidence.eqNullSafe(documents)
    return same & F.coalesce(valid, F.lit(True))


#: Cross-field rules of each record kind: name and condition under which a row breaks it.
CHECKS: dict[str, dict[str, str]] = {
    "external_demonstrations": {"parent_needs_rule": "(parent_demonstration_id is null) <> (repair_rule_ref is null)", "own_parent": "parent_demonstration_id = demonstration_id"},
    "eligibility_decisions": {"no_reason": "coalesce(size(reason_codes), 0) <= 0"},
    "attempts": {"sealed_open": "state = 'SEALED' and (finished_at is null or end_reason is null)", "import_policy": "actor_kind = 'HISTORICAL_IMPORT' and policy_ref is not null"},
    "events": {"model_link": "event_type in ('MODEL_REQUEST', 'MODEL_OUTPUT') and model_call_id is null", "tool_link": "event_type in ('TOOL_CALL', 'TOOL_RESULT') and tool_call_id is null"},
    "checkpoints": {"fake_restore": "restore = 'SUPPORTED' and (snapshot_ref is null or state_hash is null)"},
    "verifications": {"unknown_decides": "status <> 'VERIFIED' and outcome <> 'UNKNOWN'"},
    "rewards": {"known_iff_value": "(availability = 'KNOWN') <> (total_reward is not null)"},
}


def violations(df: DataFrame, entity: str) -> DataFrame:
    """Rows that break a rule of the record kind, once for each rule."""
    broken = F.array_compact(F.array(*(F.when(F.expr(c), F.lit(n)) for n, c in CHECKS[entity].items())))
    return df.withColumn("rule", F.explode(broken))
