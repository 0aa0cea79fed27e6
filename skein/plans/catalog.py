"""Registered queries of the engine's own operators, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import identity, numeric, text
from skein.operators import decisions, dedup, graph, joins, recipes, reports, sft, splits, trajectory
from skein.plans import builds
from skein.plans.registry import ORACLES, QUERIES, query
from skein.session import table
from skein.sources import generators
from skein.streaming import ledger

__all__ = ["ORACLES", "QUERIES"]


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    """documents with labels as verified outcomes."""
    d, lab = table(spark, sf, "documents").select("doc_id", "source"), table(spark, sf, "labels")
    outcome = F.when(F.col("toxic") == 1, "FAIL").when(F.col("quality") == 1, "PASS").otherwise("UNKNOWN")
    return d.join(lab, "doc_id", "left").withColumn("outcome", F.when(F.col("quality").isNotNull(), outcome))


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    """documents, for work on their whole texts."""
    return table(spark, sf, "documents").select("doc_id", "text")


def _histories(spark: SparkSession, sf: str) -> DataFrame:
    """conversations as histories of plain messages."""
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    none = F.lit(None)
    message = lambda m: F.struct(m.role.alias("role"), m.text.alias("content"), none.alias("tool_calls"), none.alias("tool_call_id")).cast(trajectory.MESSAGE)
    return table(spark, sf, "conversations").groupBy(F.col("conv_id").cast("string").alias("id")).agg(F.transform(turns, message).alias("messages"))


def _members(spark: SparkSession, sf: str) -> DataFrame:
    """conversations as accepted members, an assistant's message being a call of a tool named by its first word; every other one has all review checks. The asked text's "the" stands as the phrase that is tagged."""
    raw = F.concat(F.lit("{'name': '"), F.regexp_extract("text", "^([^ ]*)", 1), F.lit("-tool'}"))
    said = F.when(F.lower(F.col("text")).contains("the"), F.concat("text", F.lit(" on social media"))).otherwise(F.col("text"))
    call = F.when(F.col("role") == "assistant", F.struct(raw.alias("raw_content")))
    turn = F.struct("turn", F.struct("role", said.alias("content"), call.alias("tool_call")).alias("m"))
    rows = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"), F.count_if(F.col("role") == "assistant").alias("calls")).filter("calls > 0")
    checks = F.array(*map(F.lit, decisions.REVIEW_CHECKS))
    return rows.select(F.col("conv_id").cast("string").alias("demonstration_id"), F.lit("ACCEPT").alias("eligibility_action"), F.transform("t", lambda x: x.m).alias("messages"), F.when(F.col("conv_id") % 2 == 0, checks).otherwise(F.slice(checks, 1, 4)).alias("review_checks"))


_LABELLED = "(SELECT d.doc_id, d.source, quality, toxic, CASE WHEN quality IS NOT NULL THEN CASE WHEN toxic = 1 THEN 'FAIL' WHEN quality = 1 THEN 'PASS' ELSE 'UNKNOWN' END END AS outcome FROM documents d LEFT JOIN labels USING (doc_id))"


@query("""
    WITH r AS (SELECT doc_id::VARCHAR AS attempt_id, outcome, min(doc_id) OVER (PARTITION BY source, outcome)::VARCHAR AS representative FROM """ + _LABELLED + """),
    a AS (SELECT attempt_id, CASE WHEN outcome IS NULL THEN 'MISSING_VERIFICATION' WHEN outcome = 'UNKNOWN' THEN 'VERIFICATION_UNKNOWN' WHEN outcome = 'FAIL' THEN 'VERIFICATION_FAIL'
          WHEN representative IS DISTINCT FROM attempt_id THEN 'DUPLICATE_NON_REPRESENTATIVE' ELSE 'VERIFIED_PASS' END AS reason_code FROM r),
    b AS (SELECT *, CASE WHEN reason_code LIKE '%VERIFICATION' OR reason_code LIKE '%UNKNOWN' THEN 'QUARANTINE' WHEN reason_code = 'VERIFIED_PASS' THEN 'ACCEPT' ELSE 'REJECT' END AS action FROM a)
    SELECT attempt_id, action, reason_code, 'decision-' || sha256('{"action":"' || action || '","attempt_id":"' || attempt_id || '","policy_version":"q1","reason_code":"' || reason_code || '"}')[1:16] AS decision_id FROM b""")
def quality_decisions(spark, sf):
    rows = _labelled(spark, sf).withColumn("attempt_id", F.col("doc_id").cast("string"))
    least = rows.groupBy("source", "outcome").agg(F.min("doc_id").cast("string").alias("representative"))
    least = least.toDF("s", "o", "representative")  # a row a source and outcome
    own = rows.join(least, F.col("source").eqNullSafe(F.col("s")) & F.col("outcome").eqNullSafe(F.col("o")))
    seen = own.select("attempt_id", "representative", "outcome", F.lit("VERIFIED").alias("status"), F.when(F.col("outcome").isNotNull(), True).alias("seen"))
    return decisions.apply_quality_rule(seen, "q1").select("attempt_id", "action", "reason_code", "decision_id")


_MEMBERS = "(SELECT o_orderkey AS attempt_id, o_custkey AS task_id, CASE o_orderstatus WHEN 'F' THEN 'ACCEPT' WHEN 'O' THEN 'REJECT' ELSE 'QUARANTINE' END AS decision, CASE o_orderstatus WHEN 'F' THEN 'PASS' WHEN 'O' THEN 'UNKNOWN' END AS outcome, CASE o_custkey % 3 WHEN 0 THEN 'TRAIN' WHEN 1 THEN 'DEVELOPMENT' ELSE 'TEST' END AS usage_scope FROM orders)"


@query("SELECT count(DISTINCT task_id) AS tasks, count(DISTINCT attempt_id) AS attempts, count(*) FILTER (decision = 'ACCEPT') AS accepted, count(*) FILTER (decision = 'REJECT') AS rejected, count(*) FILTER (decision = 'QUARANTINE') AS quarantined, count(*) FILTER (outcome = 'PASS') AS passed, count(*) FILTER (outcome IS NULL OR outcome = 'UNKNOWN') AS unknown_outcomes, count(*) FILTER (usage_scope = 'TRAIN') AS train, count(*) FILTER (usage_scope = 'DEVELOPMENT') AS development, count(*) FILTER (usage_scope = 'TEST') AS test, NULL::BIGINT AS cost_cny_fen FROM " + _MEMBERS)
def quality_report_exec(spark, sf):
    o, k = table(spark, sf, "orders"), F.col("o_custkey")
    s = F.col("o_orderstatus")
    decision = F.when(s == "F", "ACCEPT").when(s == "O", "REJECT").otherwise("QUARANTINE")
    scope = F.when(k % 3 == 0, "TRAIN").when(k % 3 == 1, "DEVELOPMENT").otherwise("TEST")
    outcome = F.when(s == "F", "PASS").when(s == "O", "UNKNOWN")
    return reports.execution_quality(o.select(F.col("o_orderkey").alias("attempt_id"), k.alias("task_id"), decision.alias("decision"), outcome.alias("outcome"), scope.alias("usage_scope")))


@query("SELECT count(DISTINCT s_suppkey) AS demonstrations, count(DISTINCT s_nationkey) AS sources, count(*) FILTER (s_acctbal > 0) AS accepted, count(*) FILTER (s_nationkey % 2 = 1) AS derived, count(*) FILTER (s_suppkey % 3 = 0) AS replayable, count(*) FILTER (s_suppkey % 3 <> 0) AS not_replayable FROM supplier")
def quality_report_external(spark, sf):
    s = table(spark, sf, "supplier")
    return reports.external_quality(s.select(F.col("s_suppkey").alias("demonstration_id"), F.col("s_nationkey").alias("source_record_id"), F.when(F.col("s_acctbal") > 0, "ACCEPT").otherwise("REJECT").alias("eligibility_action"), F.when(F.col("s_nationkey") % 2 == 1, "DERIVED").otherwise("PUBLIC_ORIGINAL").alias("source_origin"), F.when(F.col("s_suppkey") % 3 == 0, "SUPPORTED").otherwise("UNSUPPORTED").alias("replay_capability")))


@query("SELECT doc_id, CASE WHEN strlen(text) > 4096 THEN NULL ELSE text END AS payload, CASE WHEN strlen(text) > 4096 THEN sha256(text) END AS sha256, CASE WHEN strlen(text) > 4096 THEN strlen(text)::BIGINT END AS byte_size FROM documents")
def externalise_large_payload(spark, sf):
    e = table(spark, sf, "documents").select("doc_id", F.lit("OBSERVATION").alias("event_type"), F.col("text").alias("payload"))
    return decisions.externalise(e).select("doc_id", "payload", "payload_ref.sha256", "payload_ref.byte_size")


@query("""
    SELECT event_id, CASE WHEN event_type = 'click' AND strlen(props) > 8 THEN NULL ELSE props END AS payload, CASE WHEN event_type = 'click' AND strlen(props) > 8 THEN sha256(props) END AS sha256,
           row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS place FROM events""")
def event_total_order(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("attempt_id"), F.col("event_id").alias("seq"), F.when(F.col("event_type") == "click", "OBSERVATION").otherwise("OTHER").alias("event_type"), F.col("props").alias("payload"))
    return trajectory.places(builds.process_events(e, 8, ordered=False), "attempt_id", "seq").select(F.col("seq").alias("event_id"), "payload", "payload_ref.sha256", "place")


@query("WITH h AS (SELECT doc_id, sha256('{\"tokens\":[' || array_to_string(list_transform(regexp_extract_all(lower(text), '[a-z0-9]+'), lambda x: '\"' || x || '\"'), ',') || ']}') AS projection_sha256 FROM documents) SELECT doc_id, projection_sha256, min(doc_id) OVER (PARTITION BY projection_sha256) AS representative FROM h")
def dedup_representatives(spark, sf):
    return dedup.representatives(_texts(spark, sf), "doc_id", [text.word_tokens(F.col("text")).alias("tokens")])


@query("""
    WITH s AS (SELECT doc_id AS id, list_sort(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+'))) AS t FROM documents),
    g AS (SELECT t, min(id) AS g FROM s WHERE len(t) > 0 GROUP BY t),
    p AS (SELECT a.g AS a, b.g AS b, len(list_intersect(a.t, b.t)) AS i, len(a.t) + len(b.t) AS n FROM g a JOIN g b ON a.g < b.g AND len(a.t) >= 0.8 * len(b.t) AND len(b.t) >= 0.8 * len(a.t))
    SELECT a AS "left", b AS "right", round(i / (n - i), 9) AS jaccard FROM p WHERE i / (n - i) >= 0.8 - 1e-9""")
def dedup_candidates_jaccard(spark, sf):
    return dedup.jaccard_pairs(dedup.token_sets(_texts(spark, sf), "doc_id", "text"), 0.8).withColumn("jaccard", F.round("jaccard", 9))


@query("SELECT s.id, min(s.id) OVER (PARTITION BY t) AS representative FROM (SELECT doc_id AS id, list_sort(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+'))) AS t FROM documents) s WHERE len(t) > 0")
def dedup_set_members(spark, sf):
    return dedup.set_groups(dedup.token_sets(_texts(spark, sf), "doc_id", "text"))


_A, _B = ([x[k] for x in dedup.permutations(55)] for k in (0, 1))


@query(f"""
    WITH s AS (SELECT doc_id AS id, list_sort(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+'))) AS t FROM documents),
    g AS (SELECT t, min(id) AS g FROM s WHERE len(t) > 0 GROUP BY t),
    h AS (SELECT g, list_transform(t, lambda x: ('0x' || md5(x)[1:8])::BIGINT % {dedup.PRIME}) AS h FROM g),
    p AS (SELECT generate_subscripts({_A}, 1) AS i, unnest({_A}) AS a, unnest({_B}) AS b),
    m AS (SELECT g, i, list_min(list_transform(h, lambda x: (x * a + b) % {dedup.PRIME})) AS m FROM h, p),
    k AS (SELECT g, (i - 1) // 11 AS band, list(m ORDER BY i) AS k FROM m GROUP BY 1, 2)
    SELECT a.g AS "left", b.g AS "right" FROM k a JOIN k b ON a.band = b.band AND a.k = b.k AND a.g < b.g
    UNION SELECT g.g, s.id FROM s JOIN g USING (t) WHERE s.id > g.g""")
def dedup_candidates_minhash(spark, sf):
    return dedup.minhash_candidates(dedup.token_sets(_texts(spark, sf), "doc_id", "text"))


@query("WITH n AS (SELECT n_nationkey AS k, n_regionkey AS r FROM nation) SELECT a.k AS \"left\", b.k AS \"right\" FROM n a JOIN n b ON a.k < b.k AND a.r <> b.r")
def non_candidate_pairs(spark, sf):
    n = table(spark, sf, "nation")
    a, b = n.select(F.col("n_nationkey").alias("left"), "n_regionkey"), n.select(F.col("n_nationkey").alias("right"), "n_regionkey")
    return dedup.non_candidates(n.select("n_nationkey"), a.join(b, "n_regionkey").filter(F.col("left") < F.col("right")))


@query("SELECT c_custkey, ['TRAIN', 'DEVELOPMENT', 'TEST'][(list_sum(list_transform(string_split(sha256(c_custkey::VARCHAR), ''), lambda d: strpos('0123456789abcdef', d) - 1)) % 3 + 1)::INT] AS scope FROM customer")
def split_assignment(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", identity.hash_scope(F.col("c_custkey")).alias("scope"))


@query("""
    WITH RECURSIVE e AS (SELECT DISTINCT s_suppkey AS a, s_nationkey * 1000003 + 7 AS b FROM supplier), sym AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
    r AS (SELECT a AS n, a AS m FROM sym UNION SELECT r.n, sym.b FROM r JOIN sym ON sym.a = r.m)
    SELECT n AS node, min(m) AS component FROM r GROUP BY n""")
def split_components(spark, sf):
    s = table(spark, sf, "supplier")
    return graph.connected_components(s.select(F.col("s_suppkey").alias("src"), (F.col("s_nationkey").cast("long") * 1000003 + 7).alias("dst")))


@query("SELECT l_partkey AS g, count(DISTINCT l_returnflag) AS scopes FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) > 1")
def split_leakage(spark, sf):
    return splits.leaks(table(spark, sf, "lineitem").select(F.col("l_partkey").alias("g"), "l_returnflag"), "g", "l_returnflag")


@query("""
    WITH c AS (SELECT user_id, event_id AS call, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events WHERE event_type = 'click'),
    r AS (SELECT user_id, event_id AS result, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events WHERE event_type = 'purchase')
    SELECT user_id, n, call, result FROM c LEFT JOIN r USING (user_id, n)""")
def call_result_pairing(spark, sf):
    e = table(spark, sf, "events").withColumn("at", F.struct("ts", "event_id"))
    return trajectory.pair_in_order(e.filter("event_type = 'click'"), e.filter("event_type = 'purchase'"), ["user_id"], "at", "event_id")


@query("WITH b AS (SELECT l_orderkey, l_partkey, lag(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS before FROM lineitem) SELECT l_orderkey, l_partkey, before FROM b WHERE l_partkey <= before")
def sequence_integrity(spark, sf):
    e = table(spark, sf, "lineitem").withColumn("arrival", F.struct("l_linenumber", "l_partkey", "l_suppkey"))
    return trajectory.sequence_violations(e, "l_orderkey", "l_partkey", "arrival").select("l_orderkey", "l_partkey", "before")


@query("SELECT conv_id, arg_max(text, turn) AS answer FROM conversations WHERE role = 'assistant' GROUP BY conv_id")
def last_assistant_answer(spark, sf):
    answers = trajectory.answer(trajectory.typed_messages(trajectory.parsed(F.col("messages"), False))).content
    return _histories(spark, sf).select(F.col("id").cast("long").alias("conv_id"), answers.alias("answer")).filter("answer is not null")


@query("SELECT conv_id, sha256(string_agg(role || ':' || text, chr(10) ORDER BY turn, role, text)) AS digest FROM conversations GROUP BY conv_id")
def conversation_digest(spark, sf):
    return identity.group_digest(table(spark, sf, "conversations"), "conv_id", ["turn", "role", "text"], F.concat("role", F.lit(":"), "text"))


@query("SELECT sha256(string_agg('{\"n_name\":\"' || n_name || '\",\"n_nationkey\":' || n_nationkey || ',\"n_regionkey\":' || n_regionkey || '}', chr(10) ORDER BY n_nationkey::VARCHAR)) AS digest FROM nation")
def dataset_digest(spark, sf):
    return identity.table_digest(table(spark, sf, "nation"), "n_nationkey")


_RECORDS = "(SELECT event_id::VARCHAR AS task_id, event_type AS family, value > 20 AS ok, event_id % 3 <> 0 AS eff, event_id % 5 = 0 AS rec, event_id % 7 = 0 AS unseen, CASE WHEN event_type = 'error' OR event_id % 2 = 0 THEN 'down' END AS infra, event_id % 4 AS calls, CASE WHEN event_id % 9 <> 0 THEN event_id % 11 END AS cost FROM events)"


def _records(spark, sf):
    i = F.col("event_id")
    return table(spark, sf, "events").select(i.cast("string").alias("task_id"), F.col("event_type").alias("family"), (F.col("value") > 20).alias("task_success"), (i % 3 != 0).alias("effective_execution"), (i % 5 == 0).alias("recovery_condition"), (i % 7 == 0).alias("unseen_combination"), F.when((F.col("event_type") == "error") | (i % 2 == 0), "down").alias("unresolved_infrastructure"), (i % 4).alias("model_calls"), (i % 4).alias("completion_tokens"), F.when(i % 9 != 0, i % 11).alias("provider_cost_cny"))


@query("SELECT family, count(*) FILTER (NOT ok) AS failures, count(*) FILTER (ok) AS successes, 'finding-' || family AS finding_id, CASE WHEN bool_and(infra IS NOT NULL) FILTER (NOT ok) THEN 'INFRASTRUCTURE' ELSE 'CONSTRAINT_FAILURE' END AS category, CASE WHEN count(*) FILTER (ok) > 0 THEN 'LOW' ELSE 'MEDIUM' END AS confidence FROM " + _RECORDS + " GROUP BY family HAVING count(*) FILTER (NOT ok) > 0")
def findings_by_family(spark, sf):
    return reports.findings(_records(spark, sf))


@query("SELECT count(*) AS tasks, count(*) FILTER (ok) / count(*) AS task_success_at_1, count(*) FILTER (eff) / count(*) AS effective_coverage, count(*) FILTER (ok AND eff) / nullif(count(*) FILTER (eff), 0) AS conditional_success, count(*) FILTER (ok AND rec) / greatest(1, count(*) FILTER (rec)) AS recovery_success, count(*) FILTER (ok AND unseen) / greatest(1, count(*) FILTER (unseen)) AS unseen_success, sum(calls)::BIGINT AS model_calls, sum(calls)::BIGINT AS completion_tokens, sum(cost)::BIGINT AS provider_cost_cny FROM " + _RECORDS)
def evaluation_metrics(spark, sf):
    return reports.evaluation_metrics(_records(spark, sf))


@query("SELECT 'finding-' || family AS finding_id, task_id FROM " + _RECORDS + " WHERE NOT ok")
def finding_tasks(spark, sf):
    return reports.finding_tasks(_records(spark, sf))


@query("WITH r AS (SELECT CASE WHEN doc_id % 11 = 0 THEN 'truncated' WHEN outcome = 'PASS' THEN 'success' WHEN outcome = 'FAIL' THEN 'known_zero' ELSE 'unknown' END AS terminal_class, CASE WHEN outcome = 'PASS' THEN 1.0 WHEN outcome = 'FAIL' THEN 0.0 END AS new_reward, CASE WHEN quality = 1 THEN 1.0 WHEN quality = 0 AND toxic = 1 THEN 0.0 END AS total_reward FROM " + _LABELLED + ") SELECT terminal_class, count(*) AS records, count(*) FILTER (new_reward IS NOT DISTINCT FROM total_reward) AS same, count(*) FILTER (new_reward IS DISTINCT FROM total_reward) AS changed FROM r GROUP BY 1")
def reward_rescore(spark, sf):
    r = _labelled(spark, sf).withColumn("outcome", F.coalesce("outcome", F.lit("UNKNOWN")))
    status = F.when(F.col("outcome") == "UNKNOWN", "INSUFFICIENT").otherwise("VERIFIED")
    return reports.rescore(r.select(decisions.terminal_class(F.when(F.col("doc_id") % 11 == 0, "BUDGET_TRUNCATED").otherwise("FINAL"), status, F.col("outcome")).alias("terminal_class"), decisions.reward(status, F.col("outcome")).alias("new_reward"), F.when(F.col("quality") == 1, 1.0).when((F.col("quality") == 0) & (F.col("toxic") == 1), 0.0).alias("total_reward")))


@query("SELECT attempt_id, CASE WHEN decision <> 'ACCEPT' THEN 'NOT_ACCEPTED' WHEN usage_scope = 'TRAIN' THEN 'TRAIN_FORBIDDEN' END AS violation FROM " + _MEMBERS + " WHERE decision <> 'ACCEPT' OR usage_scope = 'TRAIN'")
def publication_violations(spark, sf):
    o = table(spark, sf, "orders")
    m = o.select(F.col("o_orderkey").alias("attempt_id"), F.col("o_custkey").alias("task_id"), F.array(F.col("o_custkey").cast("string")).alias("source_record_ids"), F.lit("d").alias("quality_decision_id"), F.when(F.col("o_orderstatus") == "F", "ACCEPT").otherwise("REJECT").alias("decision"), F.lit("VERIFIED").alias("verification_status"), F.lit("PASS").alias("outcome"), F.when(F.col("o_custkey") % 3 == 0, "TRAIN").otherwise("TEST").alias("usage_scope"))
    return decisions.execution_violations(m).select("attempt_id", "violation")


@query("SELECT o_orderkey, o_totalprice FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def orphans_anti_join(spark, sf):
    line = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.missing(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), line, ["o_orderkey"])


@query("SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)")
def semi_join_selection(spark, sf):
    line = table(spark, sf, "lineitem").filter("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    return joins.selection(table(spark, sf, "part").select("p_partkey", "p_name"), line, ["p_partkey"])


@query("""
    WITH s AS (SELECT s_suppkey AS id FROM supplier WHERE s_nationkey = 3), o AS (SELECT DISTINCT l_orderkey AS id FROM lineitem WHERE l_suppkey IN (SELECT id FROM s)),
    c AS (SELECT DISTINCT o_custkey AS id FROM orders WHERE o_orderkey IN (SELECT id FROM o))
    SELECT 'nation' AS kind, '3' AS id UNION ALL SELECT 'supplier', id::VARCHAR FROM s UNION ALL SELECT 'order', id::VARCHAR FROM o UNION ALL SELECT 'customer', id::VARCHAR FROM c""")
def revocation_impact(spark, sf):
    link = lambda t, sk, a, dk, b: table(spark, sf, t).select(F.lit(sk).alias("src_kind"), F.col(a).cast("string").alias("src"), F.lit(dk).alias("dst_kind"), F.col(b).cast("string").alias("dst"))
    links = link("supplier", "nation", "s_nationkey", "supplier", "s_suppkey").union(link("lineitem", "supplier", "l_suppkey", "order", "l_orderkey")).union(link("orders", "order", "o_orderkey", "customer", "o_custkey"))
    start = table(spark, sf, "nation").filter("n_nationkey = 3").select(F.lit("nation").alias("kind"), F.col("n_nationkey").alias("id"))
    return graph.reachable(start, links).select("kind", "id")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 1 OR o_orderkey % 3 = 0 THEN o_orderstatus || '2' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def incremental_merge(spark, sf):
    """New rows, a third of which replace others of their key."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    new = o.filter("o_orderkey % 2 = 1 or o_orderkey % 3 = 0").withColumn("o_orderstatus", F.concat("o_orderstatus", F.lit("2")))
    return joins.merge(o.filter("o_orderkey % 2 = 0 or o_orderkey % 3 = 0"), new, "o_orderkey")


@query("WITH p AS (SELECT p_brand, p_size // 10 AS size, p_partkey, p_partkey % 2 = 0 AS t, row_number() OVER (PARTITION BY p_brand, p_size // 10, p_partkey % 2 ORDER BY p_partkey) AS n FROM part) SELECT a.p_brand, a.size, a.p_partkey AS target, b.p_partkey AS control FROM p a JOIN p b ON a.p_brand = b.p_brand AND a.size = b.size AND a.n = b.n AND a.t AND NOT b.t")
def matched_pairs(spark, sf):
    p = table(spark, sf, "part").select("p_brand", F.expr("cast(p_size div 10 as int)").alias("size"), "p_partkey")
    return joins.matched_pairs(p, ["p_brand", "size"], F.col("p_partkey") % 2 == 0, "p_partkey")


@query("WITH e AS (SELECT n_nationkey AS id, row_number() OVER (ORDER BY n_nationkey) - 1 AS i FROM nation) SELECT s.slot, e.id FROM range(200) s(slot) JOIN e ON s.slot % (SELECT count(*) FROM e) = e.i")
def batch_schedule_cycle(spark, sf):
    return recipes.cycle(table(spark, sf, "nation").select(F.col("n_nationkey").alias("id")), "id", 200)


@query("""
    WITH RECURSIVE o AS (SELECT event_id, user_id, round(value)::BIGINT AS cost, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
    r AS (SELECT event_id, user_id, n, cost <= 100 AS allowed, CASE WHEN cost <= 100 THEN cost ELSE 0 END AS used, CASE WHEN cost <= 100 THEN 1 ELSE 0 END AS calls FROM o WHERE n = 1
          UNION ALL
          SELECT o.event_id, o.user_id, o.n, used + cost <= 100 AND calls < 8, used + CASE WHEN used + cost <= 100 AND calls < 8 THEN cost ELSE 0 END, calls + CASE WHEN used + cost <= 100 AND calls < 8 THEN 1 ELSE 0 END
          FROM r JOIN o ON o.user_id = r.user_id AND o.n = r.n + 1)
    SELECT event_id, allowed FROM r""")
def running_budget(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", F.round("value").cast("long").alias("cost"), F.lit(1).alias("calls"))
    return trajectory.within_budget(e, "user_id", ["ts", "event_id"], {"cost": 100, "calls": 8}).select("event_id", "allowed")


_POOL = """(
    SELECT conv_id::VARCHAR AS demonstration_id, list(CASE WHEN role = 'assistant' THEN regexp_extract(text, '^([^ ]*)') || '-tool' END ORDER BY turn) FILTER (role = 'assistant') AS names, count(*) AS n,
           contains(lower(coalesce(string_agg(text, ' ' ORDER BY turn) FILTER (role = 'user'), '')), 'the') AS tagged FROM conversations GROUP BY conv_id HAVING count(*) FILTER (role = 'assistant') > 0)"""


@query("""
    SELECT demonstration_id, 'v1' AS candidate_pool_version, split_part(names[1], '-', 1) AS source_id, CASE WHEN len(names) >= 3 THEN 'cross_document_comparison' ELSE 'lookup' END AS task_family,
           least(len(names), 3)::INT AS dependency_depth, CASE WHEN n <= 9 THEN 'short' WHEN n <= 15 THEN 'medium' ELSE 'long' END AS length_bin,
           CASE WHEN conv % 2 = 0 THEN 'strong' ELSE 'standard' END AS verification_strength, CASE WHEN len(names) <= 3 THEN 'medium' ELSE 'high' END AS baseline_difficulty,
           CASE WHEN tagged THEN 'CONSTRAINT_FAILURE' ELSE '' END AS failure_types, len(names)::INT AS tool_call_count, n::INT AS message_count, names[1] AS first_tool
    FROM (SELECT *, demonstration_id::BIGINT AS conv FROM """ + _POOL + """)""")
def recipe_profile(spark, sf):
    pool = recipes.candidate_pool(_members(spark, sf), "v1")
    return pool.select("*", "source_observable.*").drop("source_observable").withColumn("failure_types", F.array_join("failure_types", ","))


@query("SELECT doc_id FROM documents WHERE lower(text) LIKE '%license%' OR lower(text) LIKE '%token%'")
def keyword_search(spark, sf):
    return table(spark, sf, "documents").filter(text.matches_any_word(F.col("text"), "License token no-such")).select("doc_id")


@query("SELECT event_id, (props->>'$.k')::BIGINT AS k FROM events")
def json_field_extract(spark, sf):
    return table(spark, sf, "events").select("event_id", text.json_or_null(F.col("props"), "k bigint")["k"].alias("k"))


@query("SELECT l_orderkey, l_linenumber, (l_quantity::DECIMAL(18,2) * l_extendedprice::DECIMAL(18,2))::DOUBLE AS product, (l_quantity::DECIMAL(18,2) + l_extendedprice::DECIMAL(18,2) + 1)::DOUBLE AS total, l_quantity::DECIMAL(18,2) = l_extendedprice::DECIMAL(18,2) AS same FROM lineitem")
def tool_arithmetic(spark, sf):
    q, p = (F.col(c).cast("decimal(18,2)").cast("string") for c in ("l_quantity", "l_extendedprice"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", numeric.fold_decimals("MULTIPLY", F.array(q, p)).cast("double").alias("product"), numeric.fold_decimals("ADD", F.array(q, p, F.lit("1"))).cast("double").alias("total"), numeric.decimal_equal(q, p).alias("same"))


@query("SELECT p_partkey, (p_size * 1000.0)::DOUBLE AS metres, NULL::DOUBLE AS none FROM part")
def tool_conversion(spark, sf):
    s = F.col("p_size").cast("string")
    return table(spark, sf, "part").select("p_partkey", numeric.convert_units(s, F.lit("km"), F.lit("m")).cast("double").alias("metres"), numeric.convert_units(s, F.lit("km"), F.lit("kg")).cast("double").alias("none"))


@query("SELECT conv_id AS example_id, role, sum(strlen(text))::BIGINT AS content_tokens, sum(CASE WHEN role = 'assistant' THEN strlen(text) + 1 ELSE 0 END)::BIGINT AS loss_tokens FROM conversations GROUP BY 1, 2")
def sft_mask_counts(spark, sf):
    return sft.role_counts(table(spark, sf, "conversations").select(F.col("conv_id").alias("example_id"), "role", F.col("text").alias("content")))


@query("SELECT conv_id AS example_id, sum(strlen(role) + strlen(text) + 3)::BIGINT AS tokens, coalesce(sum(strlen(text) + 1) FILTER (role = 'assistant'), 0)::BIGINT AS loss FROM conversations WHERE role <> 'system' GROUP BY 1")
def sft_rendered(spark, sf):
    m = table(spark, sf, "conversations").filter("role <> 'system'").select(F.col("conv_id").alias("example_id"), F.col("turn").alias("seq"), "role", F.col("text").alias("content"))
    return sft.render(m).select("example_id", F.size("input_ids").cast("long").alias("tokens"), F.size(F.filter("loss_mask", lambda x: x)).cast("long").alias("loss"))


@query("SELECT p_partkey, CASE WHEN p_size % 5 <> 0 THEN p_size % 5 END AS start FROM part")
def subsequence_span(spark, sf):
    k = F.col("p_size") % 5
    hay = F.when(k == 0, F.array(*map(F.lit, (1, 2, 1, 2, 0, 0)))).otherwise(F.concat(F.array_repeat(F.lit(0), k), F.array(F.lit(1), F.lit(2)), F.array(F.lit(0))))
    return table(spark, sf, "part").select("p_partkey", text.span_start(hay, F.array(F.lit(1), F.lit(2))).alias("start"))


@query("""
    WITH v AS (SELECT row_number() OVER (ORDER BY source) - 1 AS i, avg(quality) - avg(toxic) AS d FROM """ + _LABELLED + """ WHERE quality IS NOT NULL GROUP BY source),
    n AS (SELECT count(*) AS n FROM v), p AS (SELECT r // n AS draw, ('0x' || md5('7|' || r // n || '|' || r % n)[1:15])::BIGINT % n AS i FROM n, range(2000 * n) t(r)),
    m AS (SELECT draw, avg(d) AS mean FROM p JOIN v USING (i) GROUP BY draw), k AS (SELECT mean, row_number() OVER (ORDER BY mean) - 1 AS k FROM m)
    SELECT round(max(mean) FILTER (k = 49), 9) AS lower, round(max(mean) FILTER (k = 1949), 9) AS upper FROM k""")
def bootstrap_ci(spark, sf):
    groups = _labelled(spark, sf).filter("quality is not null").groupBy(F.col("source").alias("group")).agg((F.avg("quality") - F.avg("toxic")).alias("difference"))
    return numeric.bootstrap_interval(spark, groups).select(F.round("lower", 9).alias("lower"), F.round("upper", 9).alias("upper"))


@query("SELECT p_partkey FROM part ORDER BY sha256('7|' || p_partkey), p_partkey LIMIT 100")
def topk_review_queue(spark, sf):
    return dedup.seeded_sample(table(spark, sf, "part").select("p_partkey"), 100, 7, "p_partkey").select("p_partkey")


@query("SELECT 'orders' AS name, count(*) AS record_count, 'AVAILABLE' AS required_field_status, 'NO_DECLARED_SENSITIVE_FIELD_NAMES' AS sensitive_check_status FROM orders UNION ALL SELECT 'events', count(*), 'MISSING', 'SENSITIVE_FIELD_NAMES_PRESENT' FROM events UNION ALL SELECT 'documents', count(*), 'NOT_DECLARED', 'NO_DECLARED_SENSITIVE_FIELD_NAMES' FROM documents")
def source_audit_profile(spark, sf):
    ask = {"orders": ["o_orderkey"], "events": ["event_id", "no_such"], "documents": []}
    rows = [reports.profile(table(spark, sf, t), need).withColumn("name", F.lit(t)) for t, need in ask.items()]
    return rows[0].union(rows[1]).union(rows[2])


@query("WITH t AS (SELECT source, count(*) AS n, count(quality) AS k, max(quality) AS best FROM " + _LABELLED + " GROUP BY source) SELECT sum(k) / sum(n) AS computable_rate, count(*) FILTER (n = k AND best = 0) / nullif(count(*) FILTER (n = k), 0) AS all_zero_rate FROM t")
def reward_accounting(spark, sf):
    return reports.reward_accounting(_labelled(spark, sf).select(F.col("source").alias("task_id"), F.col("quality").cast("double").alias("total_reward")))


@query("""
    WITH o AS (SELECT o_orderpriority AS k, o_custkey, o_orderkey FROM orders), l AS (SELECT k, max(o_orderkey)::BIGINT * CASE WHEN k LIKE '1%' THEN 1000000 ELSE 1 END AS stop FROM o WHERE k NOT LIKE '2%' GROUP BY k)
    SELECT k AS resource_kind, sum(o_custkey)::BIGINT AS spent, any_value(stop) AS stop, k NOT LIKE '3%' AND coalesce(sum(o_custkey) < any_value(stop), false) AS allowed,
           CASE WHEN k LIKE '3%' THEN 'missing quote' WHEN any_value(stop) IS NULL THEN 'missing authorization' WHEN sum(o_custkey) >= any_value(stop) THEN 'stop limit reached' END AS reason FROM o LEFT JOIN l USING (k) GROUP BY k""")
def resource_spend(spark, sf):
    o = table(spark, sf, "orders").withColumn("resource_kind", F.col("o_orderpriority"))
    k = F.col("resource_kind")
    limits = o.filter(~k.startswith("2")).select(k, (F.col("o_orderkey").cast("long") * F.when(k.startswith("1"), 1000000).otherwise(1)).alias("stop_limit_fen"))
    return reports.spend(o.select(k, F.col("o_custkey").alias("cost_cny_fen")), limits, o.filter(~k.startswith("3")).select(k))


@query("SELECT bool_and(o_totalprice > 0) AS positive, bool_and(o_orderstatus IN ('F', 'O', 'P')) AS status, bool_and(o_custkey % 2 = 0) AS even, bool_and(o_totalprice > 0) AND bool_and(o_orderstatus IN ('F', 'O', 'P')) AND bool_and(o_custkey % 2 = 0) AS passed FROM orders")
def assertion_suite(spark, sf):
    return reports.assertions(table(spark, sf, "orders"), positive=F.col("o_totalprice") > 0, status=F.col("o_orderstatus").isin("F", "O", "P"), even=F.col("o_custkey") % 2 == 0)


@query("""
    WITH k AS (SELECT event_id AS k FROM events), r AS (
        SELECT k, 'external_demonstrations' AS entity, [CASE WHEN (k % 3 = 0) <> (k % 2 = 1) THEN 'parent_needs_rule' END, CASE WHEN k % 3 = 2 THEN 'own_parent' END] AS rules FROM k
        UNION ALL SELECT k, 'eligibility_decisions', [CASE WHEN k % 4 < 2 THEN 'no_reason' END] FROM k
        UNION ALL SELECT k, 'attempts', [CASE WHEN k % 2 = 0 AND (k % 3 = 0 OR k % 5 = 0) THEN 'sealed_open' END, CASE WHEN k % 14 = 0 THEN 'import_policy' END] FROM k
        UNION ALL SELECT k, 'events', [CASE WHEN k % 4 < 2 AND k % 3 = 0 THEN 'model_link' END, CASE WHEN k % 4 >= 2 AND k % 5 = 0 THEN 'tool_link' END] FROM k
        UNION ALL SELECT k, 'checkpoints', [CASE WHEN k % 2 = 0 AND (k % 3 = 0 OR k % 5 = 0) THEN 'fake_restore' END] FROM k
        UNION ALL SELECT k, 'verifications', [CASE WHEN k % 2 = 1 AND k % 3 <> 0 THEN 'unknown_decides' END] FROM k
        UNION ALL SELECT k, 'rewards', [CASE WHEN (k % 4 = 0) <> (k % 3 = 0) THEN 'known_iff_value' END] FROM k)
    SELECT k AS event_id, entity, rule FROM (SELECT k, entity, unnest(rules) AS rule FROM r) WHERE rule IS NOT NULL""")
def record_violations(spark, sf):
    """Every rule of every record kind, on rows that break some of them."""
    k = F.col("event_id")
    e = table(spark, sf, "events").select(k)
    text_if = lambda c, v="x": F.when(c, v)
    kinds = {
        "external_demonstrations": {"demonstration_id": F.concat(F.lit("d"), k), "parent_demonstration_id": F.when(k % 3 == 1, "p").when(k % 3 == 2, F.concat(F.lit("d"), k)), "repair_rule_ref": text_if(k % 2 == 0)},
        "eligibility_decisions": {"reason_codes": F.when(k % 4 == 1, F.array().cast("array<string>")).when(k % 4 > 1, F.array(F.lit("a")))},
        "attempts": {"state": F.when(k % 2 == 0, "SEALED").otherwise("OPEN"), "finished_at": text_if(k % 3 != 0), "end_reason": text_if(k % 5 != 0), "actor_kind": text_if(k % 7 == 0, "HISTORICAL_IMPORT"), "policy_ref": text_if(k % 2 == 0)},
        "events": {"event_type": F.element_at(F.array(*map(F.lit, ("MODEL_REQUEST", "MODEL_OUTPUT", "TOOL_CALL", "TOOL_RESULT"))), (k % 4 + 1).cast("int")), "model_call_id": text_if(k % 3 != 0), "tool_call_id": text_if(k % 5 != 0)},
        "checkpoints": {"restore": text_if(k % 2 == 0, "SUPPORTED"), "snapshot_ref": text_if(k % 3 != 0), "state_hash": text_if(k % 5 != 0)},
        "verifications": {"status": F.when(k % 2 == 0, "VERIFIED").otherwise("ERROR"), "outcome": F.when(k % 3 == 0, "UNKNOWN").otherwise("PASS")},
        "rewards": {"availability": F.when(k % 4 == 0, "KNOWN").otherwise("UNKNOWN"), "total_reward": F.when(k % 3 == 0, 1.0)},
    }
    found = [decisions.violations(e.withColumns(cols), kind).select("event_id", F.lit(kind).alias("entity"), "rule") for kind, cols in kinds.items()]
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out


@query("SELECT (date_trunc('hour', ts)) AS start, event_type, count(*) AS events FROM events GROUP BY 1, 2")
def windowed_event_counts(spark, sf):
    return ledger.windowed_counts(table(spark, sf, "events"))


@query("SELECT source, count(*) AS imported, count(quality) AS reviewed, count(*) FILTER (outcome = 'PASS') AS accepted, count(*) FILTER (outcome = 'PASS') / count(*) AS retention FROM " + _LABELLED + " GROUP BY source")
def stage_retention(spark, sf):
    return reports.stage_counts(_labelled(spark, sf), "source", {"reviewed": F.col("quality").isNotNull(), "accepted": F.col("outcome") == "PASS"})


@query("SELECT conv_id::VARCHAR AS record_id, CASE WHEN count(*) FILTER (role = 'assistant') = 0 THEN 'MISSING_ANSWER' END AS reason, count(*) AS events, count(*) FILTER (role = 'assistant') AS outputs, sha256(arg_max(text, turn) FILTER (role = 'assistant')) AS answer_sha256 FROM conversations GROUP BY conv_id")
def history_import(spark, sf):
    h = _histories(spark, sf).select("id", F.lit(None).cast("string").alias("uuid"), "messages", F.lit("[]").alias("tools"))
    done = trajectory.import_histories(h)
    outputs = F.size(F.filter("events", lambda e: e.event_type == "MODEL_OUTPUT")).cast("long")
    return done.select("record_id", "reason", F.size("events").cast("long").alias("events"), outputs.alias("outputs"), F.sha2(F.col("answer.content"), 256).alias("answer_sha256"))


@query("WITH e AS (SELECT p_brand AS recipe, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS i, count(*) OVER (PARTITION BY p_brand) AS n FROM part WHERE p_size <= 40) SELECT recipe, sum(p_size)::BIGINT AS loss_tokens, count(*) AS slots, max(p_size)::INT AS longest FROM e JOIN range(64) t(slot) ON slot % n = i GROUP BY recipe")
def equal_schedule_totals(spark, sf):
    e = table(spark, sf, "part").select(F.col("p_brand").alias("recipe"), F.col("p_partkey").alias("demonstration_id"), F.array_repeat(F.lit(1), F.col("p_size")).alias("input_ids"), F.array_repeat(F.lit(True), F.col("p_size")).alias("loss_mask"))
    return recipes.schedule_totals(recipes.equal_schedule(e, 8, 8, 40))


@query("SELECT r.event_id FROM events r WHERE r.event_type = 'purchase' AND NOT EXISTS (SELECT 1 FROM events c WHERE c.event_type = 'click' AND c.user_id = r.user_id AND c.event_id % 7 = r.event_id % 7)")
def orphan_tool_results(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.col("user_id").alias("attempt_id"), (F.col("event_id") % 7).alias("tool_call_id"), F.when(F.col("event_type") == "click", "TOOL_CALL").when(F.col("event_type") == "purchase", "TOOL_RESULT").alias("event_type"))
    return trajectory.orphan_links(e).select("event_id")


from skein.plans import governance, lineage  # noqa: E402, F401  (they register their queries)
