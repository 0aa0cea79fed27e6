"""Behaviour of operators on small hand-made rows."""

import hashlib
import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skein.functions import identity, numeric, text
from skein.operators import decisions, dedup, graph, joins, recipes, reports, sft, splits, trajectory
from skein.sources import generators, merkle, readers, writers
from skein.streaming import ledger


def test_externalise_is_strict_and_counts_bytes(spark):
    e = spark.createDataFrame([("a", 1, "OBSERVATION", "é" * 16), ("a", 2, "OBSERVATION", "é" * 17), ("a", 3, "TOOL_CALL", "x" * 99), ("a", 4, None, None)], "attempt_id string, seq int, event_type string, payload string")
    r = {x.seq: x for x in decisions.externalise(e, 32).collect()}
    assert r[1].payload and r[1].payload_ref is None and r[3].payload_ref is None and r[4].payload is None
    assert r[2].payload is None and r[2].payload_ref.byte_size == 34 and r[2].payload_ref.sha256 == hashlib.sha256(("é" * 17).encode()).hexdigest()


def test_quality_rule_order(spark):
    a = spark.createDataFrame([(x,) for x in "abcdef"], "attempt_id string")
    v = spark.createDataFrame([("b", "INSUFFICIENT", "UNKNOWN", 0), ("c", "VERIFIED", "FAIL", 0), ("d", "VERIFIED", "FAIL", 0), ("d", "VERIFIED", "PASS", 1), ("e", "VERIFIED", "PASS", 0), ("f", "VERIFIED", "PASS", 0)], "attempt_id string, status string, outcome string, position int")
    reps = spark.createDataFrame([("d", "d"), ("e", "d")], "attempt_id string, representative string")
    got = {r.attempt_id: (r.action, r.reason_code) for r in decisions.decide_quality(a, v, reps, "p").collect()}
    assert got == {"a": ("QUARANTINE", "MISSING_VERIFICATION"), "b": ("QUARANTINE", "VERIFICATION_UNKNOWN"), "c": ("REJECT", "VERIFICATION_FAIL"), "d": ("ACCEPT", "VERIFIED_PASS"), "e": ("REJECT", "DUPLICATE_NON_REPRESENTATIVE"), "f": ("REJECT", "DUPLICATE_NON_REPRESENTATIVE")}


def test_verify_compares_numbers_and_evidence(spark):
    rows = [("100", "km", ["x"], "100.0", "km", ["x"], None), ("100", "m", ["x"], "100", "km", ["x"], None), ("1", "m", [], "1", "m", ["x"], None), ("1", "m", [], "1", "m", [], "ERROR"), ("?", "m", [], "1", "m", [], None)]
    d = spark.createDataFrame(rows, "v string, u string, e array<string>, wv string, wu string, we array<string>, f string")
    got = [r[0] for r in d.select(decisions.verify(*map(F.col, ("v", "u", "e", "wv", "wu", "we", "f")))).collect()]
    assert got == ["PASS", "FAIL", "FAIL", "UNKNOWN", "FAIL"]


def test_rewards_and_classes(spark):
    d = spark.createDataFrame([("BUDGET_TRUNCATED", "VERIFIED", "PASS"), ("F", "VERIFIED", "FAIL"), ("F", "ERROR", "UNKNOWN")], "e string, s string, o string")
    got = [tuple(r) for r in d.select(decisions.terminal_class(F.col("e"), F.col("s"), F.col("o")), decisions.reward(F.col("s"), F.col("o"))).collect()]
    assert got == [("truncated", 1.0), ("known_zero", 0.0), ("unknown", None)]


def external(spark, **changes):
    row = {"demonstration_id": "a", "source_record_id": "s", "source_record_ids": ["s"], "usage_scope": "TRAIN", "eligibility_decision_id": "e", "eligibility_action": "ACCEPT", "upstream_message_refs": ["m"], "source_origin": "DERIVED", "replay_capability": "UNKNOWN", "review_checks": list(decisions.REVIEW_CHECKS)}
    kinds = {c: "array<string>" if isinstance(v, list) else "string" for c, v in row.items()}
    rows = [row] + [row | {"demonstration_id": n} | c for n, c in changes.items()]
    return spark.createDataFrame([tuple(r[c] for c in row) for r in rows], ", ".join(f"{c} {k}" for c, k in kinds.items()))


def test_gates_and_record_rules(spark):
    full = list(decisions.REVIEW_CHECKS)
    m = external(spark, b={"source_origin": "PROJECT_SAMPLED"}, c={"upstream_message_refs": []}, d={"review_checks": full[:4]}, e={"usage_scope": "TEST", "source_origin": None}, f={"eligibility_decision_id": ""}, g={"source_record_ids": None}, h={"eligibility_action": None})
    assert {r.demonstration_id: r.violation for r in decisions.external_violations(m).collect()} == {"b": "ORIGIN", "c": "NO_MESSAGE_LINEAGE", "d": "REVIEW_CHECKS", "e": "NOT_TRAIN", "f": "NO_DECISION", "g": "NO_SOURCE_LINEAGE", "h": "NOT_ACCEPTED"}
    assert {r.violation for r in decisions.publication_violations(m.drop("replay_capability")).collect()} == {"MISSING_FIELD"}
    assert {r.violation for r in decisions.publication_violations(m.withColumn("attempt_id", F.lit("x"))).collect()} == {"MIXED_KINDS"}
    r = spark.createDataFrame([("KNOWN", None), ("UNKNOWN", 0.0), ("KNOWN", 1.0)], "availability string, total_reward double")
    assert decisions.violations(r, "rewards").count() == 2


def test_eligibility_order(spark):
    d = spark.createDataFrame([(None, [], True, "x"), ("t", [], True, "x"), ("t", ["m"], False, "x"), ("t", ["m"], True, "MODEL_SAMPLED"), ("t", ["m"], True, "DERIVED")], "tools string, messages array<string>, schema_valid boolean, source_origin string")
    assert [r.reason_code for r in decisions.assess_eligibility(d).collect()] == ["MISSING_TOOL_DEFINITION", "MISSING_MESSAGE_CONTEXT", "MALFORMED", "PROJECT_SAMPLING_INGRESS", "COMPLETE_EXTERNAL_DEMONSTRATION"]


def test_association(spark):
    call = lambda i: {"role": "assistant", "tool_calls": [{"id": i, "name": "f", "arguments": "{}"}]}
    res = lambda i=None: {"role": "tool", "content": "r", "tool_call_id": i}
    end, user = {"role": "assistant", "content": "done"}, {"role": "user", "content": "q"}
    cases = {"good": ([user, call("1"), res("1"), end], None), "again": ([call("1"), res("1"), res("1"), end], None), "orphan": ([res("9"), end], "ORPHAN_TOOL_RESULT"), "nameless": ([call("1"), res(), end], "ORPHAN_TOOL_RESULT"), "twice": ([call("1"), call("1"), end], "DUPLICATE_TOOL_CALL"), "fifo": ([{"role": "tool_call", "content": "c"}, {"role": "tool_call", "content": "d"}, {"role": "tool_response", "content": "e", "tool_call_id": "stray"}, end], None), "noid": ([{"role": "assistant", "tool_calls": [{"name": "f"}]}, end], "INVALID_MESSAGE"), "none": ([{"role": "assistant", "content": "a", "tool_calls": []}], None), "empty": ([], "MISSING_ANSWER")}
    rows = [(k, m, "[]") for k, (m, _) in cases.items()] + [("u", [end], None), (None, [end], "[]"), ("x", None, "[]"), ("y", [end], "not json"), ("z", [end], "7")]
    d = spark.createDataFrame(rows, f"id string, messages array<{trajectory.MESSAGE}>, tools string")
    got = {r.record_id: r for r in trajectory.import_histories(d, "s").collect()}
    assert {k: got[k].reason for k in cases} == {k: v for k, (_, v) in cases.items()}
    assert [got[k].reason for k in ("u", "y", "z")] == ["MISSING_TOOL_DEFINITION"] * 3 and got[None].reason == got["x"].reason == "INVALID_MESSAGE"
    assert got["fifo"].links == ["s:fifo:historical:source-call:0", "s:fifo:historical:source-call:1", "s:fifo:historical:source-call:0", None]
    assert [e.event_type for e in got["good"].events] == ["OBSERVATION", "TOOL_CALL", "TOOL_RESULT", "MODEL_OUTPUT"]
    assert [(m.role, m.content) for m in got["fifo"].messages] == [("assistant", ""), ("assistant", ""), ("tool", "e"), ("assistant", "done")]


def test_components_match_union_find(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 700)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert graph.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_splits(spark):
    t = spark.createDataFrame([("a", ["s1"], "t1", None), ("b", ["s1"], "t2", []), ("c", ["s2"], "t1", []), ("x", ["s3"], "t3", []), ("bridge", ["s4"], None, ["f1", "f2"]), ("f1", [], None, []), ("f2", [], None, [])], "task_id string, source_groups array<string>, template_root string, related_task_ids array<string>")
    frozen = spark.createDataFrame([("f1", "TRAIN"), ("f2", "TEST")], "task_id string, scope string")
    assigned, conflicts = splits.assign_splits(t, frozen)
    got = {r.task_id: r for r in assigned.collect()}
    assert got["a"].scope == got["b"].scope == got["c"].scope and got["a"].split_group_id == got["c"].split_group_id
    assert got["bridge"].quarantined and got["bridge"].scope is None and got["f1"].scope == "TRAIN" and not got["f2"].quarantined
    assert [r.scopes for r in conflicts.collect()] == [["TEST", "TRAIN"]]


def test_hash_scope_is_sha_modulo_3(spark):
    got = spark.range(200).select("id", identity.hash_scope(F.concat(F.lit("g-"), "id"))).collect()
    assert all(s == ("TRAIN", "DEVELOPMENT", "TEST")[int(hashlib.sha256(f"g-{i}".encode()).hexdigest(), 16) % 3] for i, s in got)


def test_pilot_tasks_are_one_component(spark):
    facts = spark.createDataFrame([(f"d{i}", f"g{i}") for i in range(3)], "document_id string, source_group_id string")
    tasks = generators.pilot_tasks(spark, facts)
    assert [r["count"] for r in tasks.groupBy("task_family").count().orderBy("task_family").collect()] == [33, 33, 34]
    assigned, _ = splits.assign_splits(tasks, spark.createDataFrame([], "task_id string, scope string"))
    assert [tuple(r) for r in assigned.select("split_group_id", "scope").distinct().collect()] == [("split-v1:29f97098a00d42d1", "DEVELOPMENT")]


def test_digests_ignore_partitions(spark):
    d = spark.range(100).withColumn("t", F.concat(F.lit("ü\"/"), "id"))
    for f in (identity.table_digest, identity.tree_digest):
        assert len({f(d.repartition(n), "id").first()[0] for n in (1, 7, 16)}) == 1
    assert identity.table_digest(d, "id").first()[0] != identity.tree_digest(d, "id").first()[0]


def test_jaccard_and_minhash(spark):
    rnd = random.Random(5)
    words = [[f"w{rnd.randrange(60)}" for _ in range(rnd.randrange(1, 25))] for _ in range(120)]
    words += [w + ["zz"] for w in words[:40]] + words[:20] + [[]]
    s = dedup.token_sets(spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(words)], "id int, t string"), "id", "t")
    sets = [frozenset(w) for w in words]
    want = {(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9}
    first = {r.id: r.representative for r in dedup.set_groups(s).collect()}
    assert first == {i: sets.index(x) for i, x in enumerate(sets) if x}
    pairs = {(r.left, r.right) for r in dedup.jaccard_pairs(s, 0.8).collect()}
    assert pairs == {(i, j) for i, j in want if first[i] == i and first[j] == j and sets[i] != sets[j]}
    near = {(r.left, r.right) for r in dedup.minhash_candidates(s).collect()}
    assert {(i, 160 + i) for i in range(20)} <= near | {(j, 160 + i) for i in range(20) for j in range(160) if (j, 160 + i) in near}


@pytest.mark.parametrize("threshold", [0.8, 0.45, 0.3])
def test_jaccard_pairs_over_levels(spark, threshold):
    """Sizes on both sides of 64 and 128, pairs at and beside the threshold, and some of several levels apart."""
    rnd = random.Random(11)
    rows = [{f"c{rnd.randrange(400)}" for _ in range(rnd.choice((20, 60, 64, 70, 120, 130, 160)))} for _ in range(60)]
    for base in list(rows):
        own = sorted(base)
        rows.append(set(own[: math.ceil(threshold * len(own))]))
        rows.append(set(own[: int(0.9 * len(own))]) | {f"x{rnd.randrange(10**6)}" for _ in range(rnd.randrange(12))})
    rows = [r for n, r in enumerate(rows) if r not in rows[:n]]
    s = spark.createDataFrame([(i, sorted(r)) for i, r in enumerate(rows)], "id int, tokens array<string>")
    want = {(i, j): len(a & b) / len(a | b) for i, a in enumerate(rows) for j, b in enumerate(rows) if i < j and len(a & b) >= threshold * len(a | b) - 1e-9}
    got = {(r.left, r.right): r.jaccard for r in dedup.jaccard_pairs(s, threshold).collect()}
    assert got == want and len(want) >= 60


def test_what_leaves_the_join_of_prefixes_is_the_result(spark, monkeypatch):
    """300 sets that share a rare token each and little else: hardly a pair of them may be written or meet its texts."""
    rnd = random.Random(3)
    rows = [{f"c{rnd.randrange(3000)}" for _ in range(150)} | {f"rare{i % 3}"} for i in range(300)]
    rows += [r | {f"n{i}"} for i, r in enumerate(rows[:20])]
    s = spark.createDataFrame([(i, sorted(r)) for i, r in enumerate(rows)], "id int, tokens array<string>")
    written, keep = {}, dedup.materialize
    monkeypatch.setattr(dedup, "materialize", lambda df, name: written.setdefault(name, keep(df, name)))
    assert {(r.left, r.right) for r in dedup.jaccard_pairs(s, 0.8).collect()} == {(i, 300 + i) for i in range(20)}
    assert written["near"].count() <= 25


def test_peeled_components_are_the_components(spark):
    rnd = random.Random(2)
    edges = [(f"t{rnd.randrange(90)}", f"s{rnd.randrange(60)}") for _ in range(70)] + [(f"t{rnd.randrange(90)}", f"t{rnd.randrange(90)}") for _ in range(25)] + [("t1", "t1"), ("z", None), ("p", "q")]
    df = spark.createDataFrame(edges, "src string, dst string")
    rows = lambda x: sorted(map(tuple, x.collect()))
    assert rows(graph.peeled_components(df)) == rows(graph.connected_components(df))
    assert graph.peeled_components(df.limit(0)).isEmpty()


def test_rounds_of_a_forest_pass_over_shared_links_alone(spark, monkeypatch):
    """100 tasks of 20 source groups, 5 of them in a second one: a round has the links of these five, not those of all."""
    passed, keep = [], graph.connected_components
    monkeypatch.setattr(graph, "connected_components", lambda e, *a: passed.append(e.count()) or keep(e, *a))
    monkeypatch.setattr(splits, "connected_components", graph.connected_components, raising=False)
    t = [(str(i), [f"g{i % 20}"] + ([f"g{(i + 1) % 20}"] if i < 5 else []), None, None) for i in range(100)]
    tasks = spark.createDataFrame(t, "task_id string, source_groups array<string>, template_root string, related_task_ids array<string>")
    forest = splits.extend_forest(splits.empty_forest(spark), tasks)
    assert splits.forest_components(forest).select("component").distinct().count() == 15
    assert passed == [5]


def test_a_commit_has_no_task_a_bucket(spark, tmp_path, monkeypatch):
    rows = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    asked, keep = [], type(rows).repartition
    monkeypatch.setattr(type(rows), "repartition", lambda self, n, *c: asked.append(n) or keep(self, n, *c))
    for part in ("k % 2 = 0", "k % 3 = 0", "k % 2 = 1"):
        merkle.commit(rows.filter(part), f"file://{tmp_path}/b", "k", bucket_rows=20)
    assert max(asked) <= 4  # shuffle partitions, for some hundred buckets
    assert sorted(map(tuple, merkle.read_build(spark, f"file://{tmp_path}/b").collect())) == [(i, i % 7) for i in range(4000)]


def test_an_export_leaves_its_worker_in_bounded_pieces(spark, monkeypatch):
    turns = [("user", "ask", None), ("assistant", "b" * 90, None)]
    members = spark.createDataFrame([(f"a{i}", turns) for i in range(50)], "attempt_id string, messages array<struct<role string, content string, tool_call string>>").coalesce(1)
    whole = sorted(map(str, sft.export_examples(members, sft.ByteTokenizer()).collect()))
    pieces = []
    monkeypatch.setattr(sft, "BATCH_TOKENS", 500)
    monkeypatch.setattr(type(members), "mapInPandas", lambda self, f, schema: pieces.extend(f(iter([self.toPandas()]))) or self)
    sft.export_examples(members, sft.ByteTokenizer())
    assert len(pieces) > 5 and sum(map(len, pieces)) == 50 and max(sum(map(len, p["input_ids"])) for p in pieces) < 650
    assert sorted(x for p in pieces for x in p["attempt_id"]) == sorted(f"a{i}" for i in range(50)) and len(whole) == 50


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pairs_of_near_copies_do_not_carry_their_sets(spark, no_broadcast):
    """300 near copies of one set of 400 tokens are 44,850 pairs: their sets are shuffled a few times each, not along with each pair."""
    common = [f"common{i}" for i in range(400)]
    s = spark.createDataFrame([(i, sorted([*common, f"own{i}"])) for i in range(300)], "id int, tokens array<string>")
    sc = spark.sparkContext._jsc.sc()

    def shuffled():
        sc.listenerBus().waitUntilEmpty(10_000)
        return sc.statusStore().executorList(False).head().totalShuffleWrite()

    before = shuffled()
    found = dedup.jaccard_pairs(s, 0.8).toArrow().to_pydict()
    assert len(set(zip(found["left"], found["right"], strict=True))) == len(found["left"]) == 300 * 299 // 2
    assert all(a < b for a, b in zip(found["left"], found["right"], strict=True)) and set(found["jaccard"]) == {400 / 402}
    assert shuffled() - before < 10_000_000


def test_a_token_of_many_pairs_is_cut_into_squares(spark, monkeypatch):
    """With units of 50 pairs, one token of 780 pairs is cut, and others share units: the same pairs and likenesses as by brute force."""
    monkeypatch.setattr(dedup, "TOGETHER", 50)
    rows = [{f"c{i}" for i in range(100)} | {f"own{i}"} for i in range(40)] + [{f"d{g}-{i}" for i in range(30 + g)} | {f"own{g}-{k}"} for g in range(12) for k in range(4)]
    s = spark.createDataFrame([(f"id {i}", sorted(r)) for i, r in enumerate(rows)], "id string, tokens array<string>")
    want = {tuple(sorted((f"id {i}", f"id {j}"))): len(a & b) / len(a | b) for i, a in enumerate(rows) for j, b in enumerate(rows) if i < j and len(a & b) >= 0.8 * len(a | b)}
    got = [((r.left, r.right), r.jaccard) for r in dedup.jaccard_pairs(s, 0.8).collect()]
    assert dict(got) == want and len(got) == len(want) == 780 + 12 * 6


def test_prefixes_are_made_of_slices(monkeypatch):
    """No slice of a batch has many more tokens than AT_ONCE, and each set is in one of them."""
    monkeypatch.setattr(dedup, "AT_ONCE", 1000)
    sizes = [1] * 40 + [300] * 20 + [5000] + [10] * 5
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(sizes))), pa.array(sizes, pa.int32())], names=["g", "n"])
    parts = list(dedup._parts(batch))
    assert [g for p in parts for g in p["g"].to_pylist()] == list(range(len(sizes)))
    assert all(sum(p["n"].to_pylist()) <= 1000 + max(p["n"].to_pylist()) for p in parts) and max(p.num_rows for p in parts) <= 1000 // 64 + 1
    assert sum(p.num_rows for p in dedup._parts(batch.slice(0, 0))) == 0


def test_no_pairs_at_all(spark):
    s = spark.createDataFrame([(1, ["a", "b"]), (2, ["c", "d"]), (3, [])], "id int, tokens array<string>")
    assert dedup.jaccard_pairs(s, 0.8).collect() == [] == dedup.jaccard_pairs(s.limit(0), 0.8).collect()


def test_minhash_recall_is_what_its_formula_says(spark):
    """Pairs of likeness 0.8 to 0.9 meet in one of 5 bands of 11 with chance 1 - (1 - t ** 11) ** 5: 0.36 at 0.8, 0.84 at 0.9."""
    rows, n = [], 300
    for i in range(n):
        base = [f"{i}-{k}" for k in range(95)]
        rows += [(2 * i, base[:90]), (2 * i + 1, base[:80] + base[90:95])]  # 80 of 95 in common
    s = spark.createDataFrame(rows, "id int, tokens array<string>")
    got = {(r.left, r.right) for r in dedup.minhash_candidates(s).collect()}
    share = sum((2 * i, 2 * i + 1) in got for i in range(n)) / n
    t = 80 / 95
    assert abs(share - (1 - (1 - t**11) ** 5)) < 0.12 and all(b == a + 1 for a, b in got)


def test_minhash_links_all_different_sets_of_a_bucket(spark):
    rows = [(i, [f"w{j}" for j in range(400)] + [f"x{i % 6}"]) for i in range(9)]
    s = spark.createDataFrame(rows + [(20, []), (21, [])], "id int, tokens array<string>")
    bands = {}
    for r in dedup.minhash_bands(s, 5, 2).collect():
        bands.setdefault((r.band, r.key), set()).add(r.id)
    want = {(a, b) for ids in bands.values() for a in ids for b in ids if a < b < 6} | {(i, i + 6) for i in range(3)}
    got = [(r.left, r.right) for r in dedup.minhash_candidates(s, 5, 2).collect()]
    assert len(got) == len(set(got)) and set(got) == want and any(a > 0 and b < 6 for a, b in want)


def test_joins(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2, "z"), (3, "w")], "k int, v string")
    assert [r.k for r in joins.merge_conflicts(a, b, "k").collect()] == [2]
    assert sorted(tuple(r) for r in joins.merge(a, b, "k").collect()) == [(1, "x"), (2, "z"), (3, "w")]
    with pytest.raises(Exception, match="is missing"):
        joins.strict_join(a, b.withColumnRenamed("v", "u"), ["k"], "row").collect()
    assert joins.latest(a.union(a.withColumn("v", F.lit("zz"))), ["k"], "v").filter("v = 'zz'").count() == 2


def test_budget_and_integrity(spark):
    d = spark.createDataFrame([("a", i, c) for i, c in enumerate([6, 9, 3, 1, None])] + [("b", 0, 11), ("b", 1, 10)], "k string, i int, c int").withColumn("c0", F.lit(1))
    for most in (10_000, 3, 0):  # folded, some of either, passing by
        got = trajectory.within_budget(d, "k", ["i"], {"c": 10}, most)
        assert got.columns == [*d.columns, "allowed"]
        assert [r.allowed for r in got.orderBy("k", "i").collect()] == [True, False, True, True, True, False, True]
    assert trajectory.within_budget(d.limit(0), "k", ["i"], {"c": 10}).count() == 0
    e = spark.createDataFrame([("a", 1, 3), ("a", 2, 1), ("a", 3, 2), ("b", 1, 1), ("b", 2, 1), ("c", 1, 1), ("c", 2, 5)], "k string, arrival int, s int")
    assert sorted((r.k, r.arrival) for r in trajectory.sequence_violations(e, "k", "s", "arrival").collect()) == [("a", 2), ("b", 2)]


def test_findings_and_metrics(spark):
    rows = [("1", "f", False, True, False, False, "down", 1, 2, None), ("2", "f", False, False, False, False, None, 1, 2, 0.5), ("3", "g", False, False, False, False, "down", 1, 2, None), ("4", "h", True, True, True, False, None, 1, 2, 1.0)]
    d = spark.createDataFrame(rows, "task_id string, family string, task_success boolean, effective_execution boolean, recovery_condition boolean, unseen_combination boolean, unresolved_infrastructure string, model_calls int, completion_tokens int, provider_cost_cny double")
    f = {r.family: (r.category, r.confidence, r.finding_id) for r in reports.findings(d).collect()}
    assert f == {"f": ("CONSTRAINT_FAILURE", "MEDIUM", "finding-f"), "g": ("INFRASTRUCTURE", "MEDIUM", "finding-g")}
    assert sorted(map(tuple, reports.finding_tasks(d).collect())) == [("finding-f", "1"), ("finding-f", "2"), ("finding-g", "3")]
    m = reports.evaluation_metrics(d).first()
    assert (m.task_success_at_1, m.conditional_success, m.recovery_success, m.unseen_success, m.provider_cost_cny) == (0.25, 0.5, 1.0, 0.0, 1.5)
    assert reports.evaluation_metrics(d.filter("not effective_execution")).first().conditional_success is None


def test_sft(spark):
    m = spark.createDataFrame([(1, 0, "user", "hé"), (1, 1, "assistant", "ok")], "example_id int, seq int, role string, content string")
    r = sft.render(m).first()
    assert r.input_ids == [*b"user\n", *"hé".encode(), 256, 10, *b"assistant\n", *b"ok", 256, 10] and sum(r.loss_mask) == 3
    with pytest.raises(Exception, match="role system"):
        sft.render(m.withColumn("role", F.lit("system"))).collect()


def greedy(actions, pool):
    """The selection, one action after another, over the pool in order."""
    used, pairs, out = set(), [], []
    for a in actions:
        free = [p for p in pool if p["demonstration_id"] not in used and p["task_family"] == a["task_family"]]
        target = next((p for p in free if a["failure_type"] in p["failure_types"]), None)
        key = lambda p: tuple(p[c] for c in recipes.MATCH)
        control = target and next((p for p in free if key(p) == key(target) and a["failure_type"] not in p["failure_types"]), None)
        if control:
            used |= {target["demonstration_id"], control["demonstration_id"]}
            pairs.append((a["finding_id"], target["demonstration_id"], control["demonstration_id"]))
        else:
            out.append((a["finding_id"], "NO_MATCHED_CONTROL" if target else "NO_TARGET_SUPPORT"))
    return pairs, out


def test_recipes(spark):
    rnd = random.Random(11)
    pool = [{"demonstration_id": f"d{i:03d}", "source_id": "s", "task_family": rnd.choice("fg"), "dependency_depth": rnd.randrange(2), "length_bin": "short", "verification_strength": rnd.choice(["strong", "standard"]), "baseline_difficulty": "medium", "failure_types": rnd.sample(["X", "Y"], rnd.randrange(3)), "candidate_pool_version": "v"} for i in range(80)]
    d = spark.createDataFrame([tuple(p.values()) for p in pool], "demonstration_id string, source_id string, task_family string, dependency_depth int, length_bin string, verification_strength string, baseline_difficulty string, failure_types array<string>, candidate_pool_version string")
    actions = [{"finding_id": f"a{i}", "task_family": rnd.choice("fgh"), "failure_type": rnd.choice("XYZ")} for i in range(25)]
    pairs, excluded = recipes.matched_selection(actions, d)
    assert ([(p["finding_id"], p["target"], p["control"]) for p in pairs], [tuple(x.values()) for x in excluded]) == greedy(actions, pool)
    assert pairs and excluded and recipes.matched_selection([], d) == ([], [])
    found = spark.createDataFrame([("finding-f", "f", "X")], "finding_id string, family string, category string")
    assert recipes.data_actions(found, d).first().candidate_pool_version == "v"
    with pytest.raises(ValueError, match="one frozen pool"):
        recipes.data_actions(found, d.withColumn("candidate_pool_version", F.col("demonstration_id")))
    ex = spark.createDataFrame([(r, f"{r}{i}", [1, 2], [False, True]) for r in ("random", "closed_loop") for i in range(2)], "recipe string, demonstration_id string, input_ids array<int>, loss_mask array<boolean>")
    plan = recipes.equal_schedule(ex, 1, 2, 4)
    assert sorted(map(tuple, recipes.schedule_totals(plan).collect())) == [("closed_loop", 2, 2, 2), ("random", 2, 2, 2)]
    assert recipes.schedule_receipt(plan)["effective_loss_tokens"] == 2
    with pytest.raises(ValueError, match="exactly"):
        recipes.schedule_receipt(recipes.equal_schedule(ex.withColumn("loss_mask", F.when(F.col("recipe") == "random", F.array(F.lit(True), F.lit(True))).otherwise(F.col("loss_mask"))), 1, 2, 4))
    assert [tuple(r) for r in recipes.cycle(spark.range(3), "id", 7).orderBy("slot").collect()] == [(i, i % 3) for i in range(7)]
    assert recipes.cycle(spark.range(5), "id", 2).count() == 2


def test_candidate_pool_labels(spark):
    name = lambda n: {"role": "assistant", "content": None, "tool_call": {"raw_content": f"{{'name': '{n}', 'x': 1}}"}}
    user = lambda t: {"role": "user", "content": t, "tool_call": None}
    kind = "demonstration_id string, eligibility_action string, messages array<struct<role: string, content: string, tool_call: struct<raw_content: string>>>, review_checks array<string>"
    rows = [("a", "ACCEPT", [user("On Social Media"), name("geo-find"), name("b"), name("c"), name("d")], list("123456")), ("b", "ACCEPT", [user("x"), name("solo")] + [user("constraint")] * 9, None), ("c", "REJECT", [], [])]
    got = {r.demonstration_id: r for r in recipes.candidate_pool(spark.createDataFrame(rows, kind), "v").collect()}
    a, b = got["a"], got["b"]
    assert (a.source_id, a.task_family, a.dependency_depth, a.length_bin, a.verification_strength, a.baseline_difficulty, a.failure_types) == ("geo", "cross_document_comparison", 3, "short", "strong", "high", ["CONSTRAINT_FAILURE"])
    assert (b.source_id, b.task_family, b.dependency_depth, b.length_bin, b.verification_strength, b.baseline_difficulty, b.failure_types) == ("solo", "lookup", 1, "medium", "standard", "medium", []) and set(got) == {"a", "b"}
    with pytest.raises(Exception, match="no tool call"):
        recipes.candidate_pool(spark.createDataFrame([("z", "ACCEPT", [user("x")], [])], kind), "v").collect()


def test_numbers(spark):
    d = spark.createDataFrame([(["10", "4"],), (["1", "0"],), (["1"],), (["100", "8", "5"],)], "o array<string>")
    assert [r[0] for r in d.select(numeric.divide_decimals("o")).collect()] == ["2.5", None, None, "2.5"]
    g = spark.createDataFrame([("a", 0.1), ("b", -0.02)], "group string, difference double")
    assert numeric.bootstrap_interval(spark, g, 200).first() == numeric.bootstrap_interval(spark, g, 200).first()


def test_text(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    arr = lambda *x: F.array(*map(F.lit, x))
    assert one(text.span_start(arr(1, 2, 3), arr(2, 3))) == 1 and one(text.span_start(arr(1, 1), arr(1))) is None
    assert one(text.quoted_name(F.lit("x 'name': 'f'"))) == "f" and one(text.quoted_name(F.lit("x"))) is None
    assert one(text.json_object_in(F.lit('say {"a": 1} end'))) == '{"a": 1}' and one(text.json_object_in(F.lit("{no"))) is None
    assert [one(text.uri_is_safe(F.lit(u))) for u in ("a/b", "s3://b/k", "/etc/x", "https://u:p@h/x", "a/../b", "ftp://h/x")] == [True, True, False, False, False, False]
    assert one(text.right_pad(arr(1), F.lit(3), F.lit(0))) == [1, 0, 0] and one(text.labels(arr(5, 6), arr(False, True))) == [-100, 6]


def test_commit_is_idempotent_and_refuses_conflicts(spark, tmp_path):
    d = spark.range(20).select(F.col("id").cast("string").alias("task_id"), F.lit("p").alias("projection"))
    half = d.filter("cast(task_id as int) < 10")
    full = merkle.commit(d, str(tmp_path / "full"), "task_id")
    merkle.commit(half, str(tmp_path / "inc"), "task_id")
    assert merkle.commit(d.subtract(half), str(tmp_path / "inc"), "task_id")["digest"] == full["digest"]
    assert merkle.commit(d, str(tmp_path / "full"), "task_id")["digest"] == full["digest"]
    with pytest.raises(ValueError, match="changed"):
        merkle.commit(d.withColumn("projection", F.lit("q")), str(tmp_path / "full"), "task_id")
    with pytest.raises(ValueError, match="rule version"):
        merkle.commit(d, str(tmp_path / "full"), "task_id", {"rule_version": "v2"})
    with pytest.raises(RuntimeError):
        merkle.commit(d, str(tmp_path / "f"), "task_id", fail_at="precommit")
    assert not writers.exists(spark, str(tmp_path / "f/registry.json"))
    with pytest.raises(RuntimeError):
        merkle.commit(d, str(tmp_path / "f"), "task_id", fail_at="postcommit")
    assert merkle.commit(d, str(tmp_path / "f"), "task_id")["status"] == "POSTCOMMIT_RECOVERED"


def test_readers(spark, tmp_path):
    (tmp_path / "e.json").write_text('{"rows": [{"a": 1}, 3, {"a": 2}]}')
    assert sorted(r.a for r in readers.envelope(spark, str(tmp_path / "e.json"), "rows", "a int").collect()) == [1, 2]
    (tmp_path / "j.xml").write_text('<testsuites><testsuite tests="3" failures="1" errors="0" skipped="1"/><testsuite tests="2" failures="0" errors="0" skipped="0"/></testsuites>')
    assert tuple(readers.junit_counts(spark, str(tmp_path / "j.xml")).first()) == (5, 1, 0, 1)
    m = readers.file_manifest(spark, str(tmp_path)).collect()
    known = spark.createDataFrame(m)
    assert readers.changed_files(spark, str(tmp_path), known).count() == 0
    (tmp_path / "e.json").write_text("{}")
    assert readers.changed_files(spark, str(tmp_path), known).count() == 1


def test_stream_appends_once(spark, tmp_path):
    src = tmp_path / "in"
    e = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:00:01"), (2, "2024-01-01 00:00:02")], "event_id long, t string").select("event_id", F.to_timestamp("t").alias("ts"))
    e.write.parquet(str(src))
    s = ledger.unique_events(spark.readStream.schema(e.schema).parquet(str(src)))
    ledger.append_to(s, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
