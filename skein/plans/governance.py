"""Registered queries of the governance line: admission, drafts, releases, splits, evaluation, verification and training views."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.functions import text
from skein.operators import decisions, dedup, evaluation, joins, recipes, reports, sft, splits, trajectory
from skein.plans import builds
from skein.plans.registry import query
from skein.session import table
from skein.sources import generators, merkle, readers, writers
from skein.storage import scratch

def _s():
    return F.col("s_suppkey")


#: Suppliers as demonstrations: every fifth without a decision; faults by remainders, as in the SQL beside it.
_ADMISSION = """
    WITH d AS (SELECT s_suppkey AS k, 'd-' || s_suppkey AS demonstration_id, CASE WHEN s_suppkey % 5 <> 0 THEN ['ACCEPT', 'REJECT', 'QUARANTINE', 'ACCEPT'][s_suppkey % 4 + 1] END AS action FROM supplier),
    a AS (SELECT *, coalesce(action, 'PENDING') AS status,
                 CASE WHEN action IS NULL THEN NULL WHEN k % 7 = 0 THEN 'NO_MATERIAL' WHEN action <> 'ACCEPT' THEN NULL WHEN k % 11 = 0 THEN 'REVIEW_CHECKS'
                      WHEN k % 13 = 0 THEN 'ORIGIN' WHEN k % 17 = 0 THEN 'NO_MESSAGE_LINEAGE' END AS fault FROM d)"""


def _admission(spark, sf):
    s = table(spark, sf, "supplier").withColumn("demonstration_id", F.concat(F.lit("d-"), _s()))
    checks = F.array(*map(F.lit, decisions.REVIEW_CHECKS))
    demos = s.select(
        "demonstration_id",
        F.concat(F.lit("s-"), "s_nationkey").alias("source_record_id"),
        F.when(_s() % 13 == 0, "PROJECT_SAMPLED").otherwise("PUBLIC_ORIGINAL").alias("source_origin"),
        F.when(_s() % 17 != 0, F.array(F.lit("m"))).alias("message_refs"),
        F.when(_s() % 3 == 0, F.lit("d-0")).alias("parent_demonstration_id"),
    )
    action = F.element_at(F.array(*map(F.lit, ("ACCEPT", "REJECT", "QUARANTINE", "ACCEPT"))), (_s() % 4 + 1).cast("int"))
    own = s.filter(_s() % 5 != 0).select("demonstration_id", F.concat(F.lit("e-"), _s()).alias("decision_id"), action.alias("action"), F.when(_s() % 11 == 0, F.slice(checks, 1, 5)).otherwise(checks).alias("review_checks"), F.lit(1).alias("position"))
    stale = own.withColumns({"action": F.lit("REJECT"), "position": F.lit(0)})  # a later decision takes its place
    material = s.filter(_s() % 7 != 0).select("demonstration_id", F.array(F.struct(F.lit("user").alias("role"), F.lit("hello").alias("content"))).alias("messages"))
    return builds.admission(demos, stale.union(own), material)


@query(_ADMISSION + " SELECT demonstration_id, status, fault FROM a")
def external_admission(spark, sf):
    return _admission(spark, sf).select("demonstration_id", "status", "fault")


@query(_ADMISSION + " SELECT count(*) AS raw_external_demonstration_count, count(*) FILTER (status = 'ACCEPT') AS accepted_count, count(*) FILTER (status = 'REJECT') AS rejected_count, count(*) FILTER (status = 'QUARANTINE') AS quarantined_count, count(*) FILTER (status = 'PENDING') AS pending_review_count, count(*) FILTER (status = 'ACCEPT' AND k % 3 = 0) AS accepted_repaired_count FROM a")
def external_admission_counts(spark, sf):
    return builds.admission_counts(_admission(spark, sf))


@query(_ADMISSION + " SELECT demonstration_id, 'e-' || k AS eligibility_decision_id, 'TRAIN' AS usage_scope, 'UNKNOWN' AS replay_capability, 6 AS checks FROM a WHERE status = 'ACCEPT' AND fault IS NULL")
def external_draft_members(spark, sf):
    members = builds.external_members(_admission(spark, sf).filter("fault is null"))
    return members.select("demonstration_id", "eligibility_decision_id", "usage_scope", "replay_capability", F.size("review_checks").alias("checks"))


@query("""
    SELECT 'd-' || s_suppkey AS demonstration_id, CASE WHEN s_suppkey % 2 = 0 THEN 'NOT_TRAIN' WHEN s_suppkey % 3 = 0 THEN 'ORIGIN' WHEN s_suppkey % 5 = 0 THEN 'NO_MESSAGE_LINEAGE' WHEN s_suppkey % 7 = 0 THEN 'NO_DECISION' ELSE 'REVIEW_CHECKS' END AS violation
    FROM supplier WHERE s_suppkey % 2 = 0 OR s_suppkey % 3 = 0 OR s_suppkey % 5 = 0 OR s_suppkey % 7 = 0 OR s_suppkey % 11 = 0""")
def external_publication_violations(spark, sf):
    checks = F.array(*map(F.lit, decisions.REVIEW_CHECKS))
    text_ = lambda bad, good: F.when(bad, None).otherwise(good)
    m = table(spark, sf, "supplier").select(
        F.concat(F.lit("d-"), _s()).alias("demonstration_id"),
        F.lit("s").alias("source_record_id"),
        F.array(F.lit("s")).alias("source_record_ids"),
        F.when(_s() % 2 == 0, "TEST").otherwise("TRAIN").alias("usage_scope"),
        text_(_s() % 7 == 0, F.lit("e")).alias("eligibility_decision_id"),
        F.lit("ACCEPT").alias("eligibility_action"),
        text_(_s() % 5 == 0, F.array(F.lit("m"))).alias("upstream_message_refs"),
        F.when(_s() % 3 == 0, "MODEL_SAMPLED").otherwise("DERIVED").alias("source_origin"),
        F.lit("UNKNOWN").alias("replay_capability"),
        F.when(_s() % 11 == 0, F.slice(checks, 2, 5)).otherwise(checks).alias("review_checks"),
    )
    return decisions.publication_violations(m).select("demonstration_id", "violation")


@query("""
    WITH d AS (SELECT s_suppkey AS k FROM supplier)
    SELECT k, CASE WHEN k % 2 = 0 THEN 'MISSING_TOOL_DEFINITION' WHEN k % 3 = 0 THEN 'MISSING_MESSAGE_CONTEXT' WHEN k % 5 = 0 THEN 'MALFORMED' WHEN k % 7 = 0 THEN 'PROJECT_SAMPLING_INGRESS' ELSE 'COMPLETE_EXTERNAL_DEMONSTRATION' END AS reason_code,
           CASE WHEN k % 2 = 0 OR k % 3 = 0 OR k % 5 = 0 OR k % 7 = 0 THEN 'REJECT' ELSE 'ACCEPT' END AS action FROM d""")
def eligibility(spark, sf):
    d = table(spark, sf, "supplier").select(
        _s().alias("k"),
        F.when(_s() % 2 != 0, "[]").alias("tools"),
        F.when(_s() % 3 != 0, F.array(F.lit("m"))).otherwise(F.array().cast("array<string>")).alias("messages"),
        (_s() % 5 != 0).alias("schema_valid"),
        F.when(_s() % 7 == 0, "PROJECT_SAMPLED").otherwise("PUBLIC_ORIGINAL").alias("source_origin"),
    )
    return decisions.assess_eligibility(d).select("k", "reason_code", "action")


_EXECUTION = """
    WITH t AS (SELECT o_custkey AS task, max(o_orderkey) AS last FROM orders GROUP BY 1),
    g AS (SELECT c_custkey AS task, min(c_custkey::VARCHAR) OVER (PARTITION BY c_nationkey, c_mktsegment) AS first FROM customer),
    r AS (SELECT t.last, coalesce(f.last, t.last) AS representative FROM t JOIN g USING (task) LEFT JOIN t f ON f.task::VARCHAR = g.first),
    v AS (SELECT o_orderkey AS k, o_custkey AS task, CASE o_orderstatus WHEN 'F' THEN 'PASS' WHEN 'O' THEN 'FAIL' ELSE 'UNKNOWN' END AS outcome FROM orders)"""


def _execution(spark, sf):
    """Customers as tasks, of one instruction a segment and one source a nation; orders as attempts, the last by number counting."""
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    tasks = c.select(F.col("c_custkey").cast("string").alias("task_id"), F.lit("lookup").alias("task_family"), F.col("c_mktsegment").alias("instruction"), F.array(F.col("c_nationkey").cast("string")).alias("source_record_ids"), F.array().cast("array<string>").alias("derivation_root_ids"), F.when(F.col("c_custkey") % 2 == 0, "TRAIN").otherwise("TEST").alias("usage_scope"))
    k, status = F.col("o_orderkey"), F.col("o_orderstatus")
    attempts = o.select(k.cast("string").alias("attempt_id"), F.col("o_custkey").cast("string").alias("task_id"), F.when(k % 2 == 0, "SCRIPTED_FIXTURE").otherwise("AGENT").alias("actor_kind"), k.alias("position"))
    outcome = F.when(status == "F", "PASS").when(status == "O", "FAIL").otherwise("UNKNOWN")
    checks = o.select(k.cast("string").alias("attempt_id"), F.lit("VERIFIED").alias("status"), outcome.alias("outcome"))
    return tasks, attempts, checks


@query(_EXECUTION + """
    SELECT v.k::VARCHAR AS attempt_id, CASE WHEN outcome = 'UNKNOWN' THEN 'QUARANTINE' WHEN outcome = 'FAIL' THEN 'REJECT' WHEN r.representative IS DISTINCT FROM v.k THEN 'REJECT' ELSE 'ACCEPT' END AS decision,
           CASE WHEN v.task % 2 = 1 THEN 'TEST' WHEN v.k % 2 = 0 THEN 'DEVELOPMENT' ELSE 'TRAIN' END AS usage_scope FROM v LEFT JOIN r ON r.last = v.k""")
def execution_members(spark, sf):
    return builds.execution_members(*_execution(spark, sf), "q1").select("attempt_id", "decision", "usage_scope")


@query("""
    WITH e AS (SELECT l_orderkey, l_linenumber, l_linenumber % 3 = 1 AS down, CASE WHEN min(l_partkey) % 2 = 0 THEN l_orderkey % 10 ELSE -1 END AS value FROM lineitem WHERE l_linenumber <= 2 GROUP BY 1, 2),
    f AS (SELECT l_orderkey, min(l_linenumber) FILTER (NOT down) AS done, arg_min(value, l_linenumber) FILTER (NOT down) AS value, count(*) AS n FROM e GROUP BY 1)
    SELECT o_orderkey AS task_id, coalesce(done IS NOT NULL AND f.value = o_orderkey % 10, false) AS task_success, done IS NOT NULL AS effective_execution, coalesce(done, n, 0)::INT AS attempts,
           CASE WHEN done IS NULL THEN CASE WHEN n IS NULL THEN 'not run' ELSE 'down' END END AS unresolved_infrastructure FROM orders LEFT JOIN f ON l_orderkey = o_orderkey""")
def evaluation_records(spark, sf):
    k, none = F.col("o_orderkey"), F.lit(None)
    tasks = table(spark, sf, "orders").select(k.alias("task_id"), F.lit("g").alias("group_id"), F.lit("f").alias("family"), F.lit(False).alias("recovery_condition"), F.lit(False).alias("unseen_combination"), (k % 10).cast("string").alias("expected_value"), F.lit("m").alias("expected_unit"), F.array(F.lit("d")).alias("document_ids"))
    line = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"))
    n = F.col("l_linenumber")
    value = F.when(F.col("l_partkey") % 2 == 0, F.col("l_orderkey") % 10).otherwise(-1).cast("string")
    results = line.select(F.col("l_orderkey").alias("task_id"), n.alias("attempt_number"), F.when(n % 3 == 1, "down").alias("error"), value.alias("value"), F.lit("m").alias("unit"), F.array(F.lit("d")).alias("evidence"), none.cast("boolean").alias("constraint_valid"), F.lit("1").alias("model_calls"), F.lit("x").alias("completion_tokens"), none.cast("double").alias("provider_cost_cny"))
    return evaluation.evaluation_records(tasks, results).select("task_id", "task_success", "effective_execution", "attempts", "unresolved_infrastructure")


def _verified(spark, sf):
    p, k = table(spark, sf, "part"), F.col("p_partkey")
    tasks = p.select(k.alias("task_id"))
    expected = p.select(k.alias("task_id"), F.concat(F.col("p_size").cast("string"), F.lit(".0")).alias("value"), F.lit("m").alias("unit"), F.when(k % 5 == 0, F.array(F.lit("b"))).otherwise(F.array(F.lit("a"))).alias("required_evidence"))
    attempts = p.select(k.cast("string").alias("attempt_id"), k.alias("task_id"), F.col("p_size").cast("string").alias("value"), F.when(k % 3 == 0, "km").otherwise("m").alias("unit"), F.array(F.lit("a"), F.lit("c")).alias("evidence"))
    return evaluation.verify_attempts(tasks, expected, attempts, "v1")


@query("SELECT p_partkey::VARCHAR AS attempt_id, CASE WHEN p_partkey % 3 = 0 OR p_partkey % 5 = 0 THEN 'FAIL' ELSE 'PASS' END AS outcome FROM part")
def verify_attempts(spark, sf):
    return _verified(spark, sf).select("attempt_id", "outcome")


@query("SELECT count(*) AS attempt_count, count(*) FILTER (NOT bad) AS pass_count, count(*) FILTER (bad) AS fail_count, 0::BIGINT AS unknown_count FROM (SELECT p_partkey % 3 = 0 OR p_partkey % 5 = 0 AS bad FROM part)")
def verification_counts(spark, sf):
    return evaluation.verification_counts(_verified(spark, sf))


_SPLIT = """
    WITH g AS (SELECT s_nationkey AS n, 'split-v1:' || sha256(string_agg(s_suppkey::VARCHAR, '|' ORDER BY s_suppkey::VARCHAR))[1:16] AS gid, count(*) FILTER (s_suppkey % 40 = 1) AS tr, count(*) FILTER (s_suppkey % 40 = 2) AS te FROM supplier GROUP BY 1),
    a AS (SELECT s_suppkey::VARCHAR AS task_id, gid AS split_group_id, CASE WHEN s_suppkey % 40 = 1 THEN 'TRAIN' WHEN s_suppkey % 40 = 2 THEN 'TEST' WHEN tr > 0 AND te > 0 THEN NULL WHEN tr > 0 THEN 'TRAIN' WHEN te > 0 THEN 'TEST'
                 ELSE ['TRAIN', 'DEVELOPMENT', 'TEST'][(list_sum(list_transform(string_split(sha256(gid), ''), lambda d: strpos('0123456789abcdef', d) - 1)) % 3 + 1)::INT] END AS scope, tr > 0 AND te > 0 AND s_suppkey % 40 NOT IN (1, 2) AS quarantined, tr > 0 AND te > 0 AS clash FROM supplier JOIN g ON n = s_nationkey)"""


def _splits(spark, sf):
    s = table(spark, sf, "supplier")
    tasks = s.select(_s().cast("string").alias("task_id"), F.array(F.col("s_nationkey").cast("string")).alias("source_groups"), F.lit(None).cast("string").alias("template_root"), F.array().cast("array<string>").alias("related_task_ids"))
    frozen = s.filter((_s() % 40).isin(1, 2)).select(_s().cast("string").alias("task_id"), F.when(_s() % 40 == 1, "TRAIN").otherwise("TEST").alias("scope"))
    return (*splits.assign_splits(tasks, frozen), frozen)


@query(_SPLIT + " SELECT task_id, scope, split_group_id, quarantined FROM a")
def split_assignments(spark, sf):
    return _splits(spark, sf)[0]


@query(_SPLIT + """
    SELECT 'FROZEN' AS kind, task_id, scope FROM a WHERE task_id::INT % 40 IN (1, 2) UNION ALL SELECT CASE WHEN quarantined THEN 'QUARANTINED' ELSE 'NEW' END, task_id, scope FROM a WHERE task_id::INT % 40 NOT IN (1, 2)
    UNION ALL SELECT 'INVALIDATED', task_id, NULL FROM a WHERE clash""")
def split_registry(spark, sf):
    return splits.registry(*_splits(spark, sf)).select("kind", "task_id", "scope")


@query("""
    WITH e AS (SELECT *, sum((event_type = 'click')::INT) OVER w AS c, sum((event_type = 'purchase')::INT) OVER w AS p FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING))
    SELECT user_id::VARCHAR AS record_id, CASE WHEN bool_or(event_type = 'purchase' AND p > c) THEN 'ORPHAN_TOOL_RESULT' WHEN bool_and(event_type <> 'click') THEN 'MISSING_ANSWER' END AS reason, count(*) FILTER (event_type = 'click') AS calls FROM e GROUP BY user_id""")
def call_association(spark, sf):
    role = F.when(F.col("event_type") == "click", "tool_call").when(F.col("event_type") == "purchase", "tool_response").otherwise("user")
    none = F.lit(None)
    m = F.struct("event_id", F.struct(role.alias("role"), F.col("props").alias("content"), none.alias("tool_calls"), none.alias("tool_call_id")).cast(trajectory.MESSAGE).alias("m"))
    h = table(spark, sf, "events").groupBy(F.col("user_id").cast("string").alias("id")).agg(F.transform(F.array_sort(F.collect_list(m)), lambda x: x.m).alias("messages"))
    done = trajectory.import_histories(h.select("id", none.cast("string").alias("uuid"), "messages", F.lit("[]").alias("tools")))
    return done.select("record_id", "reason", F.size(F.filter("events", lambda e: e.event_type == "TOOL_CALL")).cast("long").alias("calls"))


@query("SELECT 'action-finding-' || event_type AS action_id, 'finding-' || event_type AS finding_id, 'v1' AS candidate_pool_version, 'RESELECT_SAME_POOL' AS action, event_type AS task_family, 'CONSTRAINT_FAILURE' AS failure_type, 'ACTIONED' AS status, NULL::VARCHAR AS retest_ref, 'PROJECT_SAMPLING,MODEL_GENERATION,MODEL_EVALUATION' AS prohibited_ingress FROM events GROUP BY event_type")
def data_actions(spark, sf):
    found = table(spark, sf, "events").select(F.col("event_type").alias("family")).distinct().select("family", F.concat(F.lit("finding-"), "family").alias("finding_id"), F.lit("CONSTRAINT_FAILURE").alias("category"))
    pool = table(spark, sf, "supplier").select(F.lit("v1").alias("candidate_pool_version"))
    return recipes.data_actions(found, pool).select("*", "target_slice.*").drop("target_slice").withColumn("prohibited_ingress", F.array_join("prohibited_ingress", ","))


def _view(spark, sf):
    """A training view: a conversation's turns but those of the system, whose role the view refuses."""
    m = table(spark, sf, "conversations").filter("role <> 'system'").select(F.col("conv_id").alias("example_id"), F.col("turn").alias("seq"), "role", F.col("text").alias("content"))
    return sft.render(m).filter(F.exists("loss_mask", lambda x: x)).withColumnRenamed("example_id", "demonstration_id")


_TOKENS = "(SELECT conv_id, sum(strlen(role) + strlen(text) + 3)::BIGINT AS tokens, coalesce(sum(strlen(text) + 1) FILTER (role = 'assistant'), 0)::BIGINT AS loss FROM conversations WHERE role <> 'system' GROUP BY 1)"


@query("SELECT conv_id AS demonstration_id, tokens, loss FROM " + _TOKENS + " WHERE loss > 0 AND conv_id % 3 = 0")
def selected_examples(spark, sf):
    view = _view(spark, sf)
    own = recipes.load_examples(view, view.filter("demonstration_id % 3 = 0"))
    return own.select("demonstration_id", F.size("input_ids").cast("long").alias("tokens"), F.size(F.filter("loss_mask", lambda x: x)).cast("long").alias("loss"))


@query("SELECT count(*) AS examples, sum(tokens)::BIGINT AS input_tokens, sum(loss)::BIGINT AS loss_tokens FROM " + _TOKENS + " WHERE loss > 0")
def token_totals(spark, sf):
    return reports.token_totals(_view(spark, sf))


@query("""
    WITH m AS (SELECT conv_id, turn, role, strlen(role) + strlen(text) + 3 AS n, role = 'assistant' AS own FROM conversations WHERE role <> 'system')
    SELECT 'c-' || conv_id AS demonstration_id, sum(n)::BIGINT AS tokens, (sum(n) FILTER (own))::BIGINT AS loss, (sum(strlen(role) + 3) FILTER (own))::BIGINT AS controls, count(*) AS messages FROM m GROUP BY conv_id HAVING count(*) FILTER (own) > 0""")
def sft_export(spark, sf):
    turn = F.struct("turn", F.struct("role", F.col("text").alias("content"), F.lit(None).cast("string").alias("tool_call")).alias("m"))
    rows = table(spark, sf, "conversations").filter("role <> 'system'").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(turn)), lambda x: x.m).alias("messages"), F.count_if(F.col("role") == "assistant").alias("own")).filter("own > 0")
    checks = F.array(*map(F.lit, decisions.REVIEW_CHECKS))
    members = rows.select(F.concat(F.lit("c-"), "conv_id").alias("demonstration_id"), "messages", F.lit("DERIVED").alias("source_origin"), F.lit("ACCEPT").alias("eligibility_action"), checks.alias("review_checks"), F.array(F.lit("m")).alias("upstream_message_refs"))
    view = sft.export_examples(members, sft.ByteTokenizer())
    return view.select("demonstration_id", F.size("input_ids").cast("long").alias("tokens"), F.size(F.filter("loss_mask", lambda x: x)).cast("long").alias("loss"), F.col("control_token_count").alias("controls"), F.size("targets").cast("long").alias("messages"))


_PILOT = """
    (WITH f AS (SELECT 'd' || lpad(n_nationkey::VARCHAR, 2, '0') AS document_id, n_regionkey AS g, row_number() OVER (ORDER BY n_nationkey) - 1 AS f FROM nation),
    t AS (SELECT i, CASE WHEN i < 34 THEN 'lookup' WHEN i < 67 THEN 'calculation_conversion' ELSE 'cross_document_comparison' END AS family, CASE WHEN i < 34 THEN i WHEN i < 67 THEN i - 34 ELSE i - 67 END AS n FROM range(100) r(i))
    SELECT 'pilot-' || lpad((i + 1)::VARCHAR, 3, '0') AS task_id, family AS task_family, family || '-template-' || n % 5 AS template_root, document_id, 'g' || g AS source_group FROM t JOIN f ON f = i % 25)"""


def _pilot(spark, sf):
    n = table(spark, sf, "nation")
    facts = n.select(F.concat(F.lit("d"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("document_id"), F.concat(F.lit("g"), F.col("n_regionkey")).alias("source_group_id"))
    return generators.pilot_tasks(spark, facts)


@query("SELECT * FROM " + _PILOT)
def pilot_tasks(spark, sf):
    return _pilot(spark, sf).select("task_id", "task_family", "template_root", "document_id", F.element_at("source_groups", 1).alias("source_group"))


@query("SELECT task_id, task_id || '-' || r AS attempt_id FROM " + _PILOT + " CROSS JOIN range(1, 3) x(r)")
def fixed_attempts(spark, sf):
    return generators.fixed_attempts(_pilot(spark, sf)).select("task_id", "attempt_id")


@query("SELECT count(DISTINCT s_suppkey) AS unique_demonstrations, count(DISTINCT s_nationkey) AS source_records FROM supplier")
def release_diversity(spark, sf):
    return reports.diversity(table(spark, sf, "supplier").select(_s().alias("demonstration_id"), F.array("s_nationkey").alias("source_record_ids")))


@query("SELECT 'replay-' || user_id AS replay_attempt_id, user_id::VARCHAR AS parent_attempt_id, event_id AS seq FROM events WHERE event_type = 'click'")
def replay_calls(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").cast("string").alias("attempt_id"), F.col("event_id").alias("seq"), F.when(F.col("event_type") == "click", "TOOL_CALL").alias("event_type"), F.col("props").alias("payload"))
    return trajectory.replay_calls(e).drop("payload")


@query("SELECT c_custkey AS attempt_id, count(o_orderkey) AS event_count, c_mktsegment AS end_reason FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 3")
def attempt_inspection(spark, sf):
    events = table(spark, sf, "orders").select(F.col("o_custkey").alias("attempt_id"))
    return trajectory.inspect(events, table(spark, sf, "customer").select(F.col("c_custkey").alias("attempt_id"), F.col("c_mktsegment").alias("end_reason")))


@query("SELECT DISTINCT l_orderkey AS attempt_id, l_linenumber AS from_event_id, l_linenumber + 1 AS to_event_id FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM lineitem m WHERE m.l_orderkey = l.l_orderkey AND m.l_linenumber = l.l_linenumber + 1)")
def edge_violations(spark, sf):
    line = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("attempt_id"), F.col("l_linenumber").alias("event_id"))
    return trajectory.edge_violations(line, line.select("attempt_id", F.col("event_id").alias("from_event_id"), (F.col("event_id") + 1).alias("to_event_id")))


@query("SELECT 'unknown' AS terminal_class UNION ALL SELECT 'truncated'")
def rescore_coverage(spark, sf):
    status = F.col("p_partkey") % 2
    r = table(spark, sf, "part").select(F.when(status == 0, "success").otherwise("known_zero").alias("terminal_class"), F.lit(1.0).alias("new_reward"), F.lit(None).cast("double").alias("total_reward"))
    return reports.rescore_coverage(r)


@query("SELECT p_partkey, p_partkey % 2 = 0 AS lineage, p_partkey % 3 = 0 AS members FROM part WHERE (p_partkey % 2 = 0 OR p_partkey % 3 = 0) AND NOT (p_partkey % 2 = 0 AND p_partkey % 3 = 0)")
def release_coverage(spark, sf):
    p = table(spark, sf, "part")
    return joins.uncovered("p_partkey", lineage=p.filter("p_partkey % 2 = 0"), members=p.filter("p_partkey % 3 = 0"))


@query("SELECT l_orderkey, 'left' AS side FROM (SELECT l_orderkey FROM lineitem EXCEPT ALL SELECT o_orderkey FROM orders) UNION ALL SELECT o_orderkey, 'right' FROM (SELECT o_orderkey FROM orders EXCEPT ALL SELECT l_orderkey FROM lineitem)")
def bag_differences(spark, sf):
    return joins.set_differences(table(spark, sf, "lineitem").select("l_orderkey"), table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey")))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0 AND o_custkey % 2 = 0")
def merge_conflicts(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    new = o.filter("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.when(F.col("o_custkey") % 2 == 0, "X").otherwise(F.col("o_orderstatus")))
    return joins.merge_conflicts(o, new, "o_orderkey")


@query("SELECT o_orderkey AS task_id, o_orderstatus FROM orders")
def committed_rows(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("task_id"), "o_orderstatus")
    at = scratch(spark, "commit")
    for c in ("task_id % 2 = 0", "task_id % 2 = 1"):
        merkle.commit(o.filter(c), at, "task_id")
    return merkle.read_build(spark, at)


@query("SELECT 'source_records' AS kind, 's-' || s_nationkey AS id, NULL::VARCHAR AS eligibility_decision_id, NULL::VARCHAR AS source_record_id, NULL::VARCHAR AS refs FROM supplier GROUP BY s_nationkey UNION ALL SELECT 'external_demonstrations', 'd-' || s_suppkey, 'e-' || s_suppkey, 's-' || s_nationkey, 'm' FROM supplier")
def published_lineage(spark, sf):
    checks = F.array(*map(F.lit, decisions.REVIEW_CHECKS))
    source = F.concat(F.lit("s-"), "s_nationkey")
    m = table(spark, sf, "supplier").select(F.concat(F.lit("d-"), _s()).alias("demonstration_id"), source.alias("source_record_id"), F.array(source).alias("source_record_ids"), F.lit("TRAIN").alias("usage_scope"), F.concat(F.lit("e-"), _s()).alias("eligibility_decision_id"), F.lit("ACCEPT").alias("eligibility_action"), F.array(F.lit("m")).alias("upstream_message_refs"), F.lit("DERIVED").alias("source_origin"), F.lit("UNKNOWN").alias("replay_capability"), checks.alias("review_checks"))
    at = scratch(spark, "release")
    writers.publish(m, at, "external", "r1")
    lineage = lambda name: spark.read.parquet(f"{at}/external/lineage/{name}.parquet")
    d = lineage("external_demonstrations")
    none = F.lit(None).cast("string")
    own = d.select(F.lit("external_demonstrations").alias("kind"), F.col("demonstration_id").alias("id"), "eligibility_decision_id", "source_record_id", F.array_join("upstream_message_refs", ",").alias("refs"))
    return lineage("source_records").select(F.lit("source_records").alias("kind"), F.col("source_record_id").alias("id"), none.alias("eligibility_decision_id"), none.alias("source_record_id"), none.alias("refs")).union(own)


@query("""
    SELECT 's-' || n_nationkey AS source_id, CASE WHEN n_nationkey % 5 IN (1, 2) THEN 'NO_UNIQUE_RECORD' WHEN n_nationkey % 5 = 3 THEN 'UNSAFE_PATH' WHEN n_nationkey % 3 = 0 THEN 'DIGEST_MISMATCH' ELSE 'DECLARED_DIGEST_MISMATCH' END AS fault
    FROM nation WHERE n_nationkey % 5 IN (1, 2, 3) OR n_nationkey % 3 = 0 OR n_nationkey % 7 = 0""")
def snapshot_faults(spark, sf):
    k = F.col("n_nationkey")
    n = table(spark, sf, "nation").select(k, F.concat(F.lit("s-"), k).alias("source_id"), F.concat(F.when(k % 5 == 3, "../").otherwise(""), F.lit("f"), k).alias("path"), F.sha2(F.col("n_name"), 256).alias("content_sha256"))
    times = F.when(k % 5 == 1, F.array().cast("array<int>")).when(k % 5 == 2, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    files = n.select("path", F.when(k % 3 == 0, "other").otherwise(F.col("content_sha256")).alias("sha256"))
    sources = n.select("source_id", F.when(k % 7 == 0, "declared").alias("expected_sha256"))
    return readers.snapshot_faults(sources, n.withColumn("t", F.explode(times)).select("source_id", "path", "content_sha256"), files)


@query("""
    WITH s AS (SELECT p_partkey AS k, p_name AS n, CASE WHEN p_partkey % 2 = 0 THEN 'x ''name'': ''' || p_brand || '-a'' y' ELSE p_brand END AS raw FROM part)
    SELECT k, CASE WHEN k % 2 = 0 THEN split_part(raw, '''', 4) END AS name, split_part(raw, '-', 1) AS head, CASE WHEN k <= 9 THEN 'short' WHEN k <= 15 THEN 'medium' ELSE 'long' END AS bin,
           regexp_matches(sha256(n), '^[0-9a-f]{64}$') AS hex, 2 AS major, CASE WHEN k < 1000 THEN k::INT END AS number, CASE WHEN k % 3 = 0 THEN 0 ELSE k::BIGINT END AS whole,
           '{"k":' || k || '}' AS object, '7,7,0,0' AS padded, '-100,' || k AS labels, 'false,true,true,false' AS mask FROM s""")
def text_functions(spark, sf):
    k = F.col("p_partkey")
    s = table(spark, sf, "part").select(k.alias("k"), F.col("p_name").alias("n"), F.when(k % 2 == 0, F.concat(F.lit("x 'name': '"), "p_brand", F.lit("-a' y"))).otherwise(F.col("p_brand")).alias("raw"))
    k, joined = F.col("k"), lambda a: F.array_join(a.cast("array<string>"), ",")
    arr = lambda *x: F.array(*map(F.lit, x))
    return s.select(
        "k",
        text.quoted_name(F.col("raw")).alias("name"),
        text.before_dash(F.col("raw")).alias("head"),
        text.length_bin(k).alias("bin"),
        text.is_hex64(F.sha2("n", 256)).alias("hex"),
        text.major_version(F.lit("2.1.0")).alias("major"),
        text.task_number(F.concat(F.lit("pilot-"), F.lpad(k.cast("string"), F.greatest(F.lit(3), F.length(k.cast("string"))), F.lit("0")))).alias("number"),
        text.whole_or_zero(F.when(k % 3 == 0, "x").otherwise(k.cast("string"))).alias("whole"),
        text.json_object_in(F.concat(F.lit('say {"k":'), k, F.lit("} then"))).alias("object"),
        joined(text.right_pad(arr(7, 7), F.lit(4), F.lit(0))).alias("padded"),
        joined(text.labels(F.array(F.lit(1).cast("long"), k.cast("long")), arr(False, True))).alias("labels"),
        joined(text.span_mask(F.lit(4), F.array(F.struct(F.lit(1).alias("start"), F.lit(3).alias("end"))))).alias("mask"),
    )


@query("""
    WITH a AS (SELECT s_nationkey AS k, avg(s_acctbal) AS mean, min(s_acctbal) AS lower, count(*) AS n FROM supplier GROUP BY 1)
    SELECT k, CASE WHEN n < 2 THEN 'INCOMPLETE' WHEN k % 4 = 0 THEN 'GUARDRAIL_REGRESSION' WHEN mean < 4000 THEN 'NO_PRACTICAL_BENEFIT' WHEN lower <= 0 THEN 'UNCERTAIN' ELSE 'POSITIVE' END AS verdict FROM a""")
def attribution_verdicts(spark, sf):
    k = F.col("s_nationkey")
    a = table(spark, sf, "supplier").groupBy(k.alias("k")).agg(F.avg("s_acctbal").alias("mean"), F.min("s_acctbal").alias("lower"), F.count(F.lit(1)).alias("completed_runs")).withColumn("guardrail_regression", F.col("k") % 4 == 0)
    return decisions.attribution(a, 4000, 2).select("k", "verdict")


@query("""
    SELECT 'r-' || s_suppkey AS subject_id, 'e-' || s_suppkey AS parent_decision_id, 'REPAIR' AS action,
           'decision-' || sha256('{"action":"REPAIR","parent_decision_id":"e-' || s_suppkey || '","policy_version":"p1","subject_id":"r-' || s_suppkey || '"}')[1:16] AS decision_id FROM supplier""")
def repair_decisions(spark, sf):
    s = table(spark, sf, "supplier").select(_s().cast("string").alias("subject_id"), F.concat(F.lit("e-"), _s()).alias("decision_id"), F.concat(F.lit("r-"), _s()).alias("replacement_subject_id"))
    return decisions.repair_decisions(s.select("subject_id", "decision_id"), s.select("subject_id", "replacement_subject_id"), "p1").select("subject_id", "parent_decision_id", "action", "decision_id")
