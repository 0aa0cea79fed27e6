"""Registered queries of imports, scans, commits, revocations and reviews, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from skein.functions import text
from skein.operators import audit, graph, joins, reports, review, splits, trajectory
from skein.plans import experiments
from skein.plans.registry import query
from skein.session import table
from skein.sources import generators, json_arrays, merkle
from skein.storage import scratch


@query("SELECT doc_id, lang, sha256(text) AS text_sha256, strlen(text)::BIGINT AS bytes FROM documents")
def json_array_items(spark, sf):
    """documents as JSON envelopes and back, in blocks far smaller than a file."""
    at = scratch(spark, "envelopes")
    json_arrays.write_json_arrays(table(spark, sf, "documents").select("doc_id", "lang", "text"), at, "rows")
    d = json_arrays.json_items(spark, at, "rows", 1 << 18).select(F.from_json("item", "doc_id long, lang string, text string").alias("r")).select("r.*")
    return d.select("doc_id", "lang", F.sha2("text", 256).alias("text_sha256"), F.octet_length("text").cast("long").alias("bytes"))


@query("""
    WITH c AS (SELECT unnest([1, 2]) AS n), r AS (SELECT n, sha256(o_orderkey::VARCHAR) AS k, sha256('{"o_orderstatus":"' || o_orderstatus || '","task_id":' || o_orderkey || '}') AS h FROM orders, c WHERE n = 2 OR o_orderkey % 8 <> 3),
    l AS (SELECT n, k[1:5] AS leaf, sha256(string_agg(h, chr(10) ORDER BY h)) AS d, count(*) AS m FROM r GROUP BY ALL),
    g AS (SELECT n, leaf[1:3] AS grp, sha256(string_agg(leaf || '=' || d, chr(10) ORDER BY leaf)) AS d, sum(m) AS m FROM l GROUP BY ALL)
    SELECT n, sha256(string_agg(grp || '=' || d, chr(10) ORDER BY grp)) AS digest, sum(m)::BIGINT AS "rows" FROM g GROUP BY n""")
def commit_roots(spark, sf):
    """The root of a build before and after a second commit."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("task_id"), "o_orderstatus")
    at = scratch(spark, "merkle")
    done = [merkle.commit(o.filter(c), at, "task_id", bucket_rows=20_000) for c in ("task_id % 8 <> 3", "task_id % 8 = 3")]
    return spark.createDataFrame([(n + 1, d["digest"], d["rows"]) for n, d in enumerate(done)], "n int, digest string, rows long")


@query("SELECT o_orderkey AS task_id, o_orderstatus FROM orders")
def bucket_commits(spark, sf):
    """Three commits that overlap, read back as one build."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("task_id"), "o_orderstatus")
    at = scratch(spark, "merkle")
    for c in ("task_id % 2 = 0", "task_id % 3 = 0", "task_id % 2 = 1"):
        merkle.commit(o.filter(c), at, "task_id", bucket_rows=20_000)
    return merkle.read_build(spark, at)


def _trade(spark, sf):
    """Links from nations to suppliers, orders, customers, and back to nations: a cycle."""
    link = lambda t, sk, a, dk, b: table(spark, sf, t).select(F.lit(sk).alias("src_kind"), F.col(a).cast("string").alias("src"), F.lit(dk).alias("dst_kind"), F.col(b).cast("string").alias("dst"))
    return link("supplier", "nation", "s_nationkey", "supplier", "s_suppkey").union(link("lineitem", "supplier", "l_suppkey", "order", "l_orderkey")).union(link("orders", "order", "o_orderkey", "customer", "o_custkey")).union(link("customer", "customer", "c_custkey", "nation", "c_nationkey"))


@query("""
    WITH RECURSIVE l AS (SELECT 'nation' AS sk, s_nationkey AS s, 'supplier' AS dk, s_suppkey::BIGINT AS d FROM supplier UNION ALL SELECT 'supplier', l_suppkey, 'order', l_orderkey FROM lineitem
                         UNION ALL SELECT 'order', o_orderkey, 'customer', o_custkey FROM orders UNION ALL SELECT 'customer', c_custkey, 'nation', c_nationkey FROM customer),
    r AS (SELECT 'nation' AS kind, 3::BIGINT AS id UNION SELECT dk, d FROM r JOIN l ON sk = kind AND s = id)
    SELECT kind, id::VARCHAR AS id FROM r""")
def revocation_cycle(spark, sf):
    return graph.reachable(spark.createDataFrame([("nation", "3")], "kind string, id string"), _trade(spark, sf)).select("kind", "id")


@query("""
    WITH r AS (SELECT o_orderkey AS k, 'ds-' || o_custkey % 50 AS dataset, o_custkey AS source FROM orders),
    hit AS (SELECT * FROM r WHERE source % 40 = 7), datasets AS (SELECT DISTINCT dataset FROM hit), dec AS (SELECT 'q-' || k AS q FROM hit),
    runs AS (SELECT 'run-' || s_suppkey AS id FROM supplier WHERE 'ds-' || s_suppkey % 50 IN (SELECT dataset FROM datasets)),
    claims AS (SELECT 'claim-' || p_partkey AS id FROM part WHERE CASE p_partkey % 3 WHEN 0 THEN 'q-' || p_partkey IN (SELECT q FROM dec) WHEN 1 THEN p_partkey % 40 = 7 AND p_partkey IN (SELECT source FROM hit) ELSE EXISTS (SELECT 1 FROM hit WHERE k = p_partkey) END)
    SELECT 'dataset' AS kind, dataset AS id, 'INVALIDATE_DISTRIBUTION' AS action FROM datasets UNION ALL SELECT 'run', id, 'INVALIDATE_EVIDENCE' FROM runs UNION ALL SELECT 'claim', id, 'INVALIDATE_CLAIM' FROM claims""")
def revocation_effects(spark, sf):
    """Sources that reach releases, runs by dataset, and claims by decision, source or attempt."""
    o, k = table(spark, sf, "orders"), F.col("o_orderkey").cast("string")
    members = o.select(F.concat(F.lit("ds-"), F.col("o_custkey") % 50).alias("dataset_id"), F.array(F.col("o_custkey").cast("string")).alias("source_record_ids"), k.alias("attempt_id"), F.concat(F.lit("q-"), k).alias("quality_decision_id"))
    runs = table(spark, sf, "supplier").select(F.concat(F.lit("run-"), "s_suppkey").alias("run_id"), F.concat(F.lit("ds-"), F.col("s_suppkey") % 50).alias("dataset_id"))
    p, key = table(spark, sf, "part"), F.col("p_partkey").cast("string")
    kind = F.col("p_partkey") % 3
    claims = p.select(F.concat(F.lit("claim-"), key).alias("claim_id"), F.when(kind == 0, F.concat(F.lit("q-"), key)).alias("quality_decision_id"), F.when(kind == 1, F.array(key)).alias("source_record_ids"), F.when(kind == 2, key).alias("attempt_id"))
    start = o.filter("o_custkey % 40 = 7").select(F.lit("source").alias("kind"), F.col("o_custkey").cast("string").alias("id"))
    return joins.revocation_effects(graph.reachable(start, joins.lineage_links(members, runs, claims)))


#: One history for each rule of an import: its JSON, with # for the row's number, and what becomes of it.
_CALL = '{"role":"assistant","tool_calls":[{"id":"c","name":"f"}]}'
_END, _USER, _BARE = '{"role":"assistant","content":"end"}', '{"role":"user","content":"q#"}', '{"role":"tool_call","tool_call_id":"same","content":"f()"}'
RULES = [
    ('{"id":"r#","tools":[],"messages":[' + f'{_USER},{_CALL},{{"role":"tool","tool_call_id":"c","content":"x"}},{_END}]}}', None, "c,c"),
    ('{"id":"r#","tools":"{}","messages":[' + f'{_CALL},{{"role":"tool_response","tool_call_id":"stray","content":"x"}},{_END}]}}', None, "c,c"),
    ('{"id":"r#","tools":[],"messages":[' + f'{_CALL},{{"role":"tool","content":"x"}},{_END}]}}', "ORPHAN_TOOL_RESULT", "c"),
    ('{"id":"r#","tools":[],"messages":[' + f"{_BARE},{_BARE}]}}", None, "s:r#:historical:source-call:0,s:r#:historical:source-call:1"),
    ('{"id":"r#","tools":[],"messages":[{"role":"assistant","content":"plain","tool_calls":[]}]}', None, ""),
    ('{"id":"r#","tools":"not json","messages":[' + f"{_END}]}}", "MISSING_TOOL_DEFINITION", ""),
    ('{"id":"","tools":[],"messages":[' + f"{_END}]}}", "INVALID_MESSAGE", ""),
    ('{"id":"r#","tools":[],"messages":"no list"}', "INVALID_MESSAGE", ""),
    ('{"id":"r#","tools":[],"messages":[' + f'{_END},"text"]}}', "INVALID_MESSAGE", ""),
    ('{"id":"r#","tools":[],"messages":[' + f"{_CALL},{_CALL},{_END}]}}", "DUPLICATE_TOOL_CALL", "c,c"),
    ('{"id":"r#","tools":[],"messages":[{"role":"assistant","tool_calls":[{"id":"c"},{"id":"d"}]}]}', "INVALID_MESSAGE", ""),
    ('{"id":"r#","tools":[],"messages":[' + f"{_USER}]}}", "MISSING_ANSWER", ""),
    ('["r#"]', "INVALID_MESSAGE", ""),
    ('{"id":null,"uuid":"r#","tools":[],"messages":[' + f"{_END}]}}", "INVALID_MESSAGE", ""),
    ('{"uuid":"r#","tools":{"f":1},"messages":"[{\\"role\\":\\"assistant\\",\\"content\\":\\"end\\"}]"}', None, ""),
]
_ANONYMOUS = (6, 12, 13)


def _sql(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''").replace("#", "' || k || '") + "'"


@query(f"""
    WITH p AS (SELECT p_partkey AS k, p_partkey % {len(RULES)} AS n FROM part)
    SELECT CASE WHEN n NOT IN {_ANONYMOUS} THEN 'r' || k END AS record_id, CASE n {" ".join(f"WHEN {n} THEN {_sql(r)}" for n, (_, r, _) in enumerate(RULES))} END AS reason,
           CASE n {" ".join(f"WHEN {n} THEN {_sql(x)}" for n, (*_, x) in enumerate(RULES))} END AS links FROM p""")
def import_rules(spark, sf):
    """A history for each rule of the import, many times over."""
    n = F.col("p_partkey") % len(RULES)
    text = F.element_at(F.array(*(F.lit(x) for x, *_ in RULES)), (n + 1).cast("int"))
    items = table(spark, sf, "part").select(F.replace(text, F.lit("#"), F.col("p_partkey").cast("string")).alias("item"))
    done = trajectory.import_histories(trajectory.histories_of(items), "s")
    return done.select("record_id", "reason", F.array_join("links", ",").alias("links"))


_PAIRS = "(SELECT o_orderkey AS l, lead(o_orderkey) OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS r FROM orders)"
_PACKET = f"""
    (WITH c AS (SELECT * FROM {_PAIRS} WHERE r IS NOT NULL), t AS (SELECT o_orderkey AS id, row_number() OVER (ORDER BY o_orderkey) - 1 AS k FROM orders), n AS (SELECT count(*) AS n FROM orders),
    d AS (SELECT i, ('0x' || md5('7|' || i)[1:15])::BIGINT % (n * (n - 1) // 2) AS x FROM range(2000) u(i), n), h0 AS (SELECT i, x, floor((1 + sqrt(1 + 8 * x::DOUBLE)) / 2)::BIGINT AS h FROM d),
    h AS (SELECT i, x, CASE WHEN h * (h - 1) // 2 > x THEN h - 1 WHEN h * (h + 1) // 2 <= x THEN h + 1 ELSE h END AS h FROM h0),
    q AS (SELECT a.id AS l, b.id AS r, min(i) AS i FROM h JOIN t a ON a.k = x - h * (h - 1) // 2 JOIN t b ON b.k = h GROUP BY 1, 2),
    probes AS (SELECT l, r, row_number() OVER (ORDER BY i) + 100 AS position FROM q ANTI JOIN c USING (l, r) QUALIFY position <= 200),
    firsts AS (SELECT l, r, row_number() OVER (ORDER BY l, r) AS position FROM c QUALIFY position <= 100)
    SELECT position, 'CANDIDATE' AS review_kind, l, r FROM firsts UNION ALL SELECT position, 'MISS_PROBE', l, r FROM probes)"""


def _packet(spark, sf):
    """Orders as tasks; candidates are a customer's orders of one status, each with the next."""
    o = table(spark, sf, "orders")
    tasks = o.select(F.col("o_orderkey").alias("task_id"), F.col("o_orderpriority").alias("task_family"), F.col("o_custkey").alias("input_value"), F.round(F.col("o_totalprice")).cast("long").alias("value"))
    after = F.lead("o_orderkey").over(Window.partitionBy("o_custkey", "o_orderstatus").orderBy("o_orderkey"))
    return review.packet(tasks, o.select(F.col("o_orderkey").alias("left"), after.alias("right")).filter("right is not null"))


@query(f"SELECT position::INT AS position, review_kind, l AS left_task_id, r AS right_task_id, a.o_orderpriority AS left_task_family, b.o_custkey AS right_input_value FROM {_PACKET} p JOIN orders a ON a.o_orderkey = l JOIN orders b ON b.o_orderkey = r")
def review_packet(spark, sf):
    return _packet(spark, sf).select("position", "review_kind", "left_task_id", "right_task_id", "left_task_family", "right_input_value")


@query(f"""SELECT count(*) FILTER (review_kind = 'CANDIDATE') AS reviewed_candidate_pairs, count(*) FILTER (review_kind <> 'CANDIDATE') AS reviewed_probe_pairs, count(*) FILTER (l % 3 = 0) AS reviewed_duplicates,
    count(*) FILTER (l % 3 = 0 AND review_kind <> 'CANDIDATE') AS missed_duplicates, CASE WHEN count(*) FILTER (l % 3 = 0 AND review_kind <> 'CANDIDATE') = 0 THEN 'NOT_REQUIRED_NO_OBSERVED_MISS' ELSE 'REQUIRED_AFTER_OBSERVED_MISS' END AS semantic_vector_review FROM {_PACKET}""")
def review_outcome(spark, sf):
    """A submission that calls every pair a duplicate whose left number 3 divides."""
    queue = _packet(spark, sf)
    decisions = queue.select(*review.PAIR, F.when(F.col("left_task_id") % 3 == 0, "DUPLICATE").otherwise("DISTINCT").alias("outcome"), F.lit("looked at").alias("reason_code"))
    sha = review.queue_hash(queue).first()[0]
    done = review.receipt(review.reviewed(queue, decisions, "someone", sha), 0, sha)
    return done.select("reviewed_candidate_pairs", "reviewed_probe_pairs", "reviewed_duplicates", "missed_duplicates", "semantic_vector_review")


@query("""
    WITH t AS (SELECT p_brand AS b, p_partkey % 4 AS n, p_partkey AS k FROM part)
    SELECT DISTINCT name FROM (SELECT unnest(CASE n WHEN 0 THEN [b || '-a', 'deep-' || k % 10] WHEN 1 THEN [b, 'x'] WHEN 2 THEN ['outer'] ELSE ['t-' || b] END) AS name FROM t)""")
def tool_names(spark, sf):
    """Tool names in texts of four kinds: nested JSON, names between commas, a name that hides what is inside, and JSON in JSON."""
    b, n = F.col("p_brand"), F.col("p_partkey") % 4
    text = (
        F.when(n == 0, F.concat(F.lit('[{"function":{"name":"'), b, F.lit('-a"}},{"x":[{"tool_name":" deep-'), F.col("p_partkey") % 10, F.lit(' "},5,null]}]')))
        .when(n == 1, F.concat(b, F.lit(", x ,,")))
        .when(n == 2, F.lit('{"name":"outer","more":[{"name":"inner"}]}'))
        .otherwise(F.concat(F.lit('{"a":"[{\\"name\\":\\"t-'), b, F.lit('\\"}]"}')))
    )
    return reports.tool_names("tools", table(spark, sf, "part").select(text.alias("tools")), None)


@query("""
    WITH s AS (SELECT s_suppkey AS k, 's-' || s_suppkey AS source_id, s_suppkey % 4 = 0 AS document, s_suppkey % 3 <> 0 AND s_suppkey % 4 <> 0 AS here, CASE WHEN s_suppkey % 8 = 0 OR s_suppkey % 4 <> 0 THEN 'h' || s_suppkey END AS digest,
                      CASE s_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'other' ELSE 'h' || s_suppkey END AS expected, CASE s_suppkey % 7 WHEN 0 THEN ['id', 'email'] WHEN 1 THEN ['id', 'messages'] ELSE ['id', 'x'] END AS names FROM supplier)
    SELECT source_id, CASE WHEN document THEN 'AUDITED_FROZEN_DOCUMENT' WHEN here THEN 'AUDITED_LOCAL' ELSE 'METADATA_ONLY' END AS status, CASE WHEN here THEN k * 10 END AS record_count,
           CASE WHEN document THEN 'AVAILABLE' ELSE 'NOT_REQUIRED' END AS dependency_status, CASE WHEN document OR here THEN digest END AS content_sha256,
           CASE WHEN document AND digest IS NULL THEN 'MISSING_SNAPSHOT' WHEN NOT document AND NOT here THEN 'NOT_APPLICABLE' WHEN expected IS NULL THEN 'UNDECLARED' WHEN expected = digest THEN 'MATCHED' ELSE 'MISMATCH' END AS content_hash_status,
           CASE WHEN document THEN 'PUBLIC_DOCUMENTATION_SNAPSHOT_NO_TRAJECTORY_FIELDS' WHEN NOT here THEN 'UNAVAILABLE_NO_RECORD_SAMPLE' WHEN k % 7 = 0 THEN 'SENSITIVE_FIELD_NAMES_PRESENT' WHEN k % 7 = 1 THEN 'POTENTIAL_FREE_TEXT_REVIEW_REQUIRED' ELSE 'NO_DECLARED_SENSITIVE_FIELD_NAMES' END AS sensitive_check_status,
           CASE WHEN here THEN 'read' END AS tools, CASE WHEN k % 2 = 1 THEN 'NOT_DECLARED' WHEN NOT here THEN 'UNAVAILABLE_NO_LOCAL_SHARD' WHEN k % 7 > 1 THEN 'AVAILABLE' ELSE 'MISSING' END AS required_field_status, CASE WHEN document OR here THEN 0 ELSE 1 END AS warnings FROM s""")
def source_audit(spark, sf):
    """Suppliers as declared sources: documents, local files, and metadata alone."""
    k = F.col("s_suppkey")
    s = table(spark, sf, "supplier").select(k, F.concat(F.lit("s-"), k).alias("source_id"), F.concat(F.lit("h"), k).alias("digest"))
    some = F.lit("x")
    declared = s.select("source_id", *(some.alias(c) for c in ("source_uri", "revision", "license", "usage_scope")), F.when(k % 4 == 0, audit.DOCUMENTATION).otherwise("history").alias("source_kind"), F.lit(None).cast("array<string>").alias("required_tools"), F.when(k % 5 == 1, "other").when(k % 5 != 0, F.col("digest")).alias("expected_sha256"), F.when(k % 2 == 0, F.array(F.lit("x"), F.lit("id"))).alias("required_upstream_fields"))
    names = F.when(k % 7 == 0, F.array(F.lit("id"), F.lit("email"))).when(k % 7 == 1, F.array(F.lit("id"), F.lit("messages"))).otherwise(F.array(F.lit("id"), F.lit("x")))
    facts = s.filter("s_suppkey % 3 <> 0 and s_suppkey % 4 <> 0").select("source_id", F.col("digest").alias("content_sha256"), (k * 10).alias("record_count"), names.alias("names"), F.array(F.lit("read")).alias("tools"))
    frozen = s.filter("s_suppkey % 8 = 0").select("source_id", F.col("digest").alias("content_sha256"))
    done = audit.audited(declared, facts, frozen)
    return done.select("source_id", "status", "record_count", "dependency_status", "content_sha256", "content_hash_status", "sensitive_check_status", F.array_join("actual_tool_scope", ",").alias("tools"), "required_field_status", F.size("warnings").alias("warnings"))


@query("""
    WITH v AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN 'SFT-RandomMatched' WHEN c_custkey % 11 = 0 THEN 'other' ELSE 'SFT-ClosedLoop' END AS recipe, 'd-' || c_custkey % 200 AS demonstration_id, count(*) AS n FROM customer GROUP BY 1, 2),
    m AS (SELECT 'd-' || s_suppkey AS demonstration_id, s_suppkey AS k FROM supplier)
    SELECT recipe, demonstration_id, unnest(list_filter([CASE WHEN k IS NULL THEN 'ABSENT' END, CASE WHEN k % 3 = 0 OR k % 5 = 0 THEN 'NOT_ACCEPTED' END, CASE WHEN k % 4 = 0 THEN 'NO_MESSAGE_LINEAGE' END, CASE WHEN k % 3 <> 0 AND k % 7 = 0 THEN 'NO_REPAIR_LINEAGE' END,
           CASE WHEN n > 1 THEN 'SELECTED_TWICE' END, CASE WHEN recipe = 'other' THEN 'UNKNOWN_RECIPE' END], lambda x: x IS NOT NULL)) AS fault FROM v LEFT JOIN m USING (demonstration_id)""")
def view_violations(spark, sf):
    """Customers as places of two recipes' views, suppliers as members."""
    c, k = F.col("c_custkey"), F.col("s_suppkey")
    views = table(spark, sf, "customer").select(F.when(c % 2 == 0, experiments.RECIPES[0]).when(c % 11 == 0, "other").otherwise(experiments.RECIPES[1]).alias("recipe"), F.concat(F.lit("d-"), c % 200).alias("demonstration_id"))
    members = table(spark, sf, "supplier").select(F.concat(F.lit("d-"), k).alias("demonstration_id"), F.when(k % 3 == 0, "MODEL_SAMPLED").when(k % 7 == 0, "DERIVED").otherwise("PUBLIC_ORIGINAL").alias("source_origin"), F.when(k % 5 != 0, "ACCEPT").alias("eligibility_action"), F.when(k % 4 != 0, F.array(F.lit("m"))).alias("upstream_message_refs"), F.lit("d-0").alias("parent_demonstration_id"), F.when(k % 7 != 0, "r").alias("repair_rule_ref"))
    return experiments.view_violations(views, members)


@query("""
    WITH e AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN 'truncated' WHEN o_orderstatus = 'F' THEN 'success' WHEN o_orderstatus = 'O' THEN 'known_zero' ELSE 'unknown' END AS terminal_class FROM orders)
    SELECT k AS attempt_id, terminal_class, CASE terminal_class WHEN 'success' THEN 2.5 WHEN 'known_zero' THEN -1.0 END::DOUBLE AS new_reward, CASE WHEN terminal_class IN ('success', 'known_zero') THEN 'KNOWN' ELSE 'UNKNOWN' END AS availability, 'p2' AS reward_policy_version, 'p1' AS source_policy_version FROM e""")
def rescored_rewards(spark, sf):
    o, s = table(spark, sf, "orders"), F.col("o_orderstatus")
    known = s.isin("F", "O")
    evidence = o.select(F.col("o_orderkey").alias("attempt_id"), F.col("o_custkey").alias("task_id"), F.when(F.col("o_orderkey") % 7 == 0, "BUDGET_TRUNCATED").otherwise("COMPLETED").alias("end_reason"), F.when(known, "VERIFIED").otherwise("INSUFFICIENT").alias("verification_status"), F.when(s == "F", "PASS").when(s == "O", "FAIL").otherwise("UNKNOWN").alias("outcome"), F.lit(1.0).alias("total_reward"), F.lit("p1").alias("reward_policy_version"))
    done = reports.rescored(evidence, {"policy_version": "p2", "pass_reward": 2.5, "fail_reward": -1, "unknown_reward": None, "dense_reward": False})
    return done.select("attempt_id", "terminal_class", "new_reward", "availability", "reward_policy_version", "source_policy_version")


@query("""
    WITH RECURSIVE e AS (SELECT 't:' || o_orderkey AS a, 's:c' || o_custkey AS b FROM orders WHERE o_orderkey % 5 <> 0 UNION ALL SELECT 't:' || o_orderkey, 'r:p' || (o_orderkey // 3) FROM orders WHERE o_orderkey % 7 = 0
                         UNION ALL SELECT 't:' || o_orderkey, 't:' || (o_orderkey + 1) FROM orders WHERE o_orderkey % 11 = 0 AND o_orderkey + 1 IN (SELECT o_orderkey FROM orders)),
    sym AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT a AS n, a AS m FROM sym UNION SELECT r.n, sym.b FROM r JOIN sym ON sym.a = r.m), c AS (SELECT n, min(m) AS component FROM r GROUP BY n)
    SELECT o_orderkey::VARCHAR AS task_id, coalesce(component, 't:' || o_orderkey) AS component FROM orders LEFT JOIN c ON n = 't:' || o_orderkey""")
def incremental_splits(spark, sf):
    """Orders as tasks that come in two batches, some of them named before they come."""
    k = F.col("o_orderkey")
    none = F.lit(None).cast("string")
    tasks = table(spark, sf, "orders").select(k, k.cast("string").alias("task_id"), F.when(k % 5 != 0, F.array(F.concat(F.lit("c"), "o_custkey"))).alias("source_groups"), F.when(k % 7 == 0, F.concat(F.lit("p"), F.floor(k / 3))).otherwise(none).alias("template_root"), F.when(k % 11 == 0, F.array((k + 1).cast("string"))).alias("related_task_ids"))
    forest = splits.empty_forest(spark)
    for c in ("o_orderkey % 4 < 3", "o_orderkey % 4 = 3"):
        forest = splits.extend_forest(forest, tasks.filter(c).drop("o_orderkey"))
    return splits.forest_components(forest)


@query(r"""
    WITH j AS (SELECT conv_id, turn, '{"role":"' || role || '","text":' || to_json(text)::VARCHAR || '}' AS j FROM conversations)
    SELECT conv_id, turn, sha256(array_to_string(list_transform(string_split(j, ''), lambda x: CASE WHEN unicode(x) < 128 THEN x ELSE '\u' || lpad(lower(to_hex(unicode(x))), 4, '0') END), '')) AS sha256 FROM j""")
def ascii_json(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", F.sha2(text.ascii_json("role", "text"), 256).alias("sha256"))


@query("""
    WITH f AS (SELECT 'd' || n_nationkey AS d, 'c' || n_nationkey AS c, n_regionkey AS g, n_nationkey * 3 + 1 AS value, row_number() OVER (ORDER BY n_nationkey DESC) - 1 AS f, count(*) OVER () AS n FROM nation),
    t AS (SELECT k, CASE WHEN k < 34 THEN 'lookup' WHEN k < 67 THEN 'calculation_conversion' ELSE 'cross_document_comparison' END AS family FROM range(100) r(k))
    SELECT 'pilot-' || lpad((k + 1)::VARCHAR, 3, '0') AS task_id, family AS task_family, CASE WHEN k < 34 THEN 1 ELSE 2 END AS dependency_depth, (k + 1)::INT AS input_value, (value * (k + 1))::BIGINT AS expected_value,
           CASE WHEN k < 34 THEN 'Read ' || d || ' and calculate ' || k + 1 || ' times size.' WHEN k < 67 THEN 'Read ' || d || ', then convert ' || k + 1 || ' declared base quantities into m.'
                ELSE 'Read ' || d || ' and ' || c || ', then calculate the difference between ' || k + 1 || ' times size and the companion''s zero value.' END AS instruction,
           CASE WHEN k < 67 THEN d ELSE d || ',' || c END AS documents, d || ':' || k + 1 AS root FROM t JOIN f ON f.f = k % n""")
def pilot_packages(spark, sf):
    """Nations as facts, in an order that is not that of their ids."""
    k = F.col("n_nationkey")
    facts = table(spark, sf, "nation").select((-k).alias("position"), *(F.concat(F.lit(x), k).alias(n) for x, n in (("d", "document_id"), ("s", "source_record_id"), ("c", "companion_document_id"), ("cs", "companion_source_record_id"))), F.concat(F.lit("g"), "n_regionkey").alias("source_group_id"), F.lit("cg").alias("companion_source_group_id"), F.lit("size").alias("label"), (k * 3 + 1).alias("value"), F.lit("m").alias("unit"))
    made = generators.pilot_packages(spark, facts)
    return made.select("task_id", "task_family", "dependency_depth", "input_value", "expected_value", "instruction", F.array_join("document_ids", ",").alias("documents"), F.element_at("derivation_root_ids", 1).alias("root"))
