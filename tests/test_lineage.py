"""Parallel JSON arrays, incremental commits, reachability, and the rest of the lineage line: against plain Python."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from skein import cli
from skein.functions import identity, numeric, text
from skein.operators import audit, graph, joins, reports, review, splits
from skein.sources import json_arrays, merkle

NESTED = ["plain", 'q"uote', "back\\slash", "\\\\", '\\"', "[{]},:", "é中😀", "", " ", None, True, -1.5e3, {}, [], {"a": [1, {"b": ['"', "\\"]}]}, [[[]], "]"], {"rows": [9]}, "x" * 300]


def nested(rnd, depth=0):
    if depth > 3 or rnd.random() < 0.5:
        return rnd.choice(NESTED)
    if rnd.random() < 0.5:
        return [nested(rnd, depth + 1) for _ in range(rnd.randint(0, 4))]
    return {rnd.choice(["a", "rows", 'k"', "\\", "name"]): nested(rnd, depth + 1) for _ in range(rnd.randint(0, 4))}


def dumped(rnd, value):
    return json.dumps(value, ensure_ascii=rnd.random() < 0.5, indent=rnd.choice([None, 1]), separators=rnd.choice([(",", ":"), (" , ", " : ")]))


def test_json_state_at_every_cut(tmp_path):
    """Summaries of two halves put together are those of the whole, wherever the cut is."""
    rnd = random.Random(1)
    for n in range(12):
        raw = dumped(rnd, [nested(rnd) for _ in range(6)]).encode()
        (tmp_path / f"{n}.json").write_bytes(raw)
        f = json_arrays._File(f"{tmp_path}/{n}.json")
        whole = json_arrays._borders(f, 0, len(raw), 0, 0)
        assert whole[3:] == (0, 0)
        for cut in range(1, len(raw)):
            parity, out, _ = json_arrays._summary(f, 0, cut)
            left, right = json_arrays._borders(f, 0, cut, 0, 0), json_arrays._borders(f, cut, len(raw), parity, out)
            assert left[3:] == (parity, out) and right[3:] == (0, 0)
            assert [*left[0], *right[0]] == whole[0].tolist() and [*left[2], *right[2]] == whole[2].tolist()


@pytest.mark.parametrize("block", [1, 3, 7, 64, 1 << 20])
def test_json_items(spark, tmp_path, block):
    rnd = random.Random(block)
    arrays, envelopes = {}, {}
    for n in range(1 if block == 1 else 4):
        value = [nested(rnd) for _ in range(3 if block < 4 else 20)]
        arrays[f"{n}.json"] = value
        (tmp_path / "a").mkdir(exist_ok=True)
        (tmp_path / "a" / f"{n}.json").write_text(dumped(rnd, value), encoding="utf-8")
        outer = {"first": nested(rnd), "rows": [[1], {"rows": [2]}] if n % 2 else 5, "x": {"rows": [3]}}
        outer["rows"] = value
        outer["last"] = [nested(rnd)]
        envelopes[f"{n}.json"] = value
        (tmp_path / "e").mkdir(exist_ok=True)
        (tmp_path / "e" / f"{n}.json").write_text(dumped(rnd, outer), encoding="utf-8")
    (tmp_path / "a" / "empty.json").write_text("[ ]")
    (tmp_path / "a" / "nothing.json").write_text("")
    (tmp_path / "e" / "none.json").write_text('{"other": [1, 2]}')
    for folder, field, want in (("a", None, arrays), ("e", "rows", envelopes)):
        got = {}
        for r in json_arrays.json_items(spark, f"{tmp_path}/{folder}", field, block).orderBy("path", "offset").collect():
            got.setdefault(r.path.rsplit("/", 1)[1], []).append(json.loads(r.item))
        assert got == {k: v for k, v in want.items() if v}


def test_json_that_is_cut_off_is_an_error(spark, tmp_path):
    (tmp_path / "x.json").write_text('[{"a": 1}, {"b": "never')
    with pytest.raises(Exception, match="no whole JSON"):
        json_arrays.json_items(spark, f"{tmp_path}/x.json", block=5).collect()


def test_json_arrays_there_and_back(spark, tmp_path):
    d = spark.createDataFrame([(i, None if i % 5 == 0 else f'q"{i}\\n,]' * (i % 7)) for i in range(500)], "k long, t string").repartition(3)
    for field in (None, "rows"):
        json_arrays.write_json_arrays(d, f"{tmp_path}/{field}", field)
        got = json_arrays.json_items(spark, f"{tmp_path}/{field}", field, 1000).select(F.from_json("item", "k long, t string").alias("r")).select("r.*")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, d.collect()), key=str)


def table(spark, ids, change=None):
    return spark.createDataFrame([(f"t{i}", None if i % 7 == 0 else f"v{i}" + "!" * (i == change)) for i in ids], "task_id string, v string")


def test_commits_touch_their_buckets_alone(spark, tmp_path):
    at = f"{tmp_path}/b"
    first = merkle.commit(table(spark, range(400)), at, "task_id", {"rule": 1}, bucket_rows=40)
    assert first["buckets"] == 16 and first["buckets_written"] == 16 and first["status"] == "NEW_COMMIT"
    files = {str(p): p.stat().st_mtime_ns for p in (tmp_path / "b" / "data").rglob("*.parquet")}
    more = merkle.commit(table(spark, [401, 402, 5, 6]), at, "task_id", {"rule": 1}, bucket_rows=40)
    assert more["rows"] == 402 and more["buckets_written"] <= 2
    assert {p: (tmp_path / "b" / p).stat().st_mtime_ns for p in files} == files
    want = table(spark, [*range(400), 401, 402])
    assert more["digest"] == identity.tree_digest(want, "task_id").first()[0] != first["digest"]
    assert sorted(map(tuple, merkle.read_build(spark, at).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert merkle.commit(table(spark, [401, 3]), at, "task_id", {"rule": 1}, bucket_rows=40)["status"] == "UNCHANGED"


def test_the_root_says_what_the_rows_are(spark, tmp_path):
    rnd = random.Random(2)
    ids = list(range(120))
    rnd.shuffle(ids)
    roots = set()
    for n, rows in enumerate((7, 30, 1000)):
        for at in range(0, 120, 40):
            done = merkle.commit(table(spark, ids[at : at + 40]).repartition(3), f"{tmp_path}/{n}", "task_id", bucket_rows=rows)
        roots.add(done["digest"])
        assert merkle.read_build(spark, f"{tmp_path}/{n}").count() == 120
    assert roots == {identity.tree_digest(table(spark, range(120)), "task_id").first()[0]}
    assert identity.tree_digest(table(spark, range(120), change=3), "task_id").first()[0] not in roots
    assert identity.tree_digest(table(spark, []), "task_id").first()[0]


def test_commits_that_fail(spark, tmp_path):
    at, rows, more = f"{tmp_path}/b", table(spark, range(50)), table(spark, range(50, 60))
    done = merkle.commit(rows, at, "task_id", bucket_rows=10)
    for fail in ("precommit", "postcommit"):
        with pytest.raises(RuntimeError, match=fail):
            merkle.commit(more, at, "task_id", bucket_rows=10, fail_at=fail)
        assert merkle.read_build(spark, at).count() == 50 and not list((tmp_path / "b").glob("staging*"))
    again = merkle.commit(more, at, "task_id", bucket_rows=10)
    assert again["status"] == "POSTCOMMIT_RECOVERED" and again["rows"] == merkle.read_build(spark, at).count() == 60
    for bad, what in ((table(spark, [3], change=3), "changed"), (rows.union(rows), "unique"), (rows.withColumn("w", F.lit(1)), "columns")):
        with pytest.raises(ValueError, match=what):
            merkle.commit(bad, at, "task_id")
    with pytest.raises(ValueError, match="identity"):
        merkle.commit(rows, at, "task_id", {"rule": 2})
    assert merkle.read_build(spark, at).count() == 60 and done["digest"] != again["digest"] and re.fullmatch("[0-9a-f]{64}", again["digest"])


def test_reachable(spark):
    rnd = random.Random(6)
    links = [(rnd.choice("ab"), str(rnd.randint(0, 30)), rnd.choice("ab"), str(rnd.randint(0, 30))) for _ in range(50)] + [("a", "0", "a", "0"), ("a", None, "b", "1")]
    d = spark.createDataFrame(links, "src_kind string, src string, dst_kind string, dst string")
    for start in (["0"], ["0", "7"], []):
        want, now, step = {}, {("a", s) for s in start}, 0
        while now:
            want |= {x: step for x in now}
            now, step = {(k, i) for a, b, k, i in links if (a, b) in now} - set(want), step + 1
        got = graph.reachable(spark.createDataFrame([("a", s) for s in start], "kind string, id string"), d).collect()
        assert {(r.kind, r.id): r.step for r in got} == want and len(got) == len(want)


def test_links_of_a_revocation(spark):
    m = spark.createDataFrame([("ds", ["s", None], "a1", "q1"), ("ds", ["t"], "a2", None), ("other", None, "a3", "q3")], "dataset_id string, source_record_ids array<string>, attempt_id string, quality_decision_id string")
    runs = spark.createDataFrame([("r1", "ds"), ("r2", None), (None, "ds")], "run_id string, dataset_id string")
    claims = spark.createDataFrame([("c1", "q1", None), ("c2", None, "a2"), ("c3", "q3", "a9")], "claim_id string, quality_decision_id string, attempt_id string")
    reached = graph.reachable(spark.createDataFrame([("source", "s")], "kind string, id string"), joins.lineage_links(m, runs, claims))
    assert {(r.kind, r.id) for r in joins.revocation_effects(reached).collect()} == {("dataset", "ds"), ("run", "r1"), ("claim", "c1")}
    assert joins.lineage_links(m).filter("dst_kind in ('run', 'claim')").isEmpty()


def test_unranking(spark):
    n = 60
    numbers = spark.range(n * (n - 1) // 2).select(*(c.alias(x) for c, x in zip(review.unrank(F.col("id")), "lr", strict=True)))
    got = {tuple(r) for r in numbers.collect()}
    assert got == {(a, b) for b in range(n) for a in range(b)}
    far = spark.createDataFrame([(b, b * (b - 1) // 2 + a) for b in (3_037_000_000, 2_999_999_999, 94_906_266) for a in (0, 1, b - 1)], "b long, x long")
    assert all(r.r == r.b for r in far.select("b", review.unrank(F.col("x"))[1].alias("r")).collect())
    ids = spark.createDataFrame([(f"t{i}",) for i in range(300)] * 2, "id string").repartition(7)
    assert [r.id for r in review.ranked(ids).orderBy("rank").collect()] == sorted(f"t{i}" for i in range(300))


def test_a_review(spark):
    tasks = spark.createDataFrame([(f"t{i:02}", "f", i, i * 2) for i in range(20)], "task_id string, task_family string, input_value int, value int")
    near = spark.createDataFrame([(f"t{b:02}", f"t{a:02}") for a in range(20) for b in range(a + 1, 20) if (a + b) % 3 == 0], "left string, right string")
    queue = review.packet(tasks, near, 30)
    rows = queue.orderBy("position").collect()
    known = {tuple(sorted(r)) for r in near.collect()}
    pairs = [(r.left_task_id, r.right_task_id) for r in rows]
    assert [r.review_kind for r in rows] == ["CANDIDATE"] * 30 + ["MISS_PROBE"] * 30 and len(set(pairs)) == 60
    assert pairs[:30] == sorted(known)[:30] and not set(pairs[30:]) & known and all(a < b for a, b in pairs)
    assert pairs == [(r.left_task_id, r.right_task_id) for r in review.packet(tasks.repartition(5), near, 30).orderBy("position").collect()]
    every = 190 - len(known)
    assert {tuple(r)[:2] for r in review.probes(tasks.select(F.col("task_id").alias("id")), near, every).collect()} == {(f"t{a:02}", f"t{b:02}") for a in range(20) for b in range(a + 1, 20)} - known
    for bad, what in ((lambda: review.packet(tasks, near, 100), "candidates"), (lambda: review.probes(tasks.select(F.col("task_id").alias("id")), near, every + 1), "no candidates"), (lambda: review.packet(tasks.withColumn("value", F.when(F.col("input_value") > 3, 1)), near, 5), "t0"), (lambda: review.packet(tasks.union(tasks), near, 5), "unique")):
        with pytest.raises(ValueError, match=what):
            bad()
    sha = review.queue_hash(queue).first()[0]
    said = queue.select(*review.PAIR, F.when(F.col("position").isin(1, 31), "DUPLICATE").otherwise("DISTINCT").alias("outcome"), F.lit("r").alias("reason_code"))
    done = review.receipt(review.reviewed(queue, said, "me", sha), len(known), sha).first()
    assert (done.reviewed_candidate_pairs, done.reviewed_probe_pairs, done.reviewed_duplicates, done.missed_duplicates, done.semantic_vector_review) == (30, 30, 2, 1, review.REQUIRED)
    none = said.withColumn("outcome", F.lit("DISTINCT"))
    assert review.receipt(review.reviewed(queue, none, "me", sha), 1, sha).first().semantic_vector_review == review.NOT_REQUIRED
    for args, what in (((said, "me", "0" * 64), "another packet"), ((said, " ", sha), "reviewer"), ((said.limit(59), "me", sha), "no valid decision"), ((said.union(said), "me", sha), "twice"), ((said.withColumn("outcome", F.lit("MAYBE")), "me", sha), "no valid decision"), ((said.withColumn("reason_code", F.lit("")), "me", sha), "no valid decision")):
        with pytest.raises(ValueError, match=what):
            review.reviewed(queue, *args)


def test_draws_are_those_of_their_counters(spark):
    import hashlib

    d = spark.range(50).select(numeric.draw_number(7, F.lit(13), F.col("id"), F.col("id") + 1).alias("x"))
    assert [r.x for r in d.collect()] == [int(hashlib.md5(f"7|{i}|{i + 1}".encode()).hexdigest()[:15], 16) % 13 for i in range(50)]
    g = spark.createDataFrame([(f"g{i}", float(i % 3)) for i in range(30)], "group string, difference double")
    a, b = (numeric.bootstrap_interval(spark, x, 400).first() for x in (g, g.repartition(7)))
    assert a == b and a.lower < 1 < a.upper
    with pytest.raises(ValueError):
        numeric.bootstrap_interval(spark, g.limit(0))


def test_bytes_as_units(spark):
    c = lambda v, a, b: numeric.convert_units(F.lit(v), F.lit(a), F.lit(b)).cast("double")
    assert tuple(spark.range(1).select(c("2", "KiB", "B").alias("a"), c("512", "B", "KiB").alias("b"), c("1", "KiB", "m").alias("c")).first()) == (2048.0, 0.5, None)


def test_tool_names(spark):
    values = ['[{"name":"a"},{"tool_name":" b "}]', '{"x":{"name":"c","in":[{"name":"hidden"}]},"y":"d, e"}', "f, g,,", '"[{\\"name\\":\\"h\\"}]"', None, "", "7", "null", '{"name":"  "}', '{"name":5,"z":[{"name":"i"}]}']
    got = reports.tool_names("v", spark.createDataFrame([(v,) for v in values], "v string"))
    assert sorted(r.name for r in got.collect()) == list("abcdefghi")
    assert reports.tool_names("v", spark.createDataFrame([], "v string")).isEmpty()


def test_an_audit(spark, tmp_path, capsys):
    import hashlib

    raw = json.dumps([{"id": "one", "messages": [{"role": "assistant", "tool_calls": [{"name": "read"}, {"name": 5}]}]}, {"id": "two", "email": "x"}]).encode()
    (tmp_path / "r.json").write_bytes(raw)
    spark.createDataFrame([("q", "m", '[{"name":"look"},{"tool_name":"add"}]')], "question string, messages string, target_tools string").coalesce(1).write.parquet(f"{tmp_path}/t.parquet")
    one = {"source_id": "a", "source_uri": "https://example.invalid/a", "revision": "v1", "license": "CC-BY-4.0", "usage_scope": "HISTORICAL_ONLY", "source_kind": "history"}
    sources = [one | {"local_path": f"{tmp_path}/r.json", "expected_sha256": hashlib.sha256(raw).hexdigest(), "required_tools": ["read"], "required_upstream_fields": ["id", "email"]}, one | {"source_id": "b", "local_path": f"{tmp_path}/t.parquet", "required_upstream_fields": ["id"]}, one | {"source_id": "c"}, one | {"source_id": "d", "source_kind": audit.DOCUMENTATION}]
    spark.createDataFrame([("d", "f" * 64)], "source_id string, content_sha256 string").write.parquet(f"{tmp_path}/frozen.parquet")

    def run(given, *more):
        (tmp_path / "m.json").write_text(json.dumps({"sources": given}))
        code = cli.main(["--json", "source", "audit", "--manifest", f"{tmp_path}/m.json", "--output-dir", f"{tmp_path}/{random.random()}", *more], spark)
        return code, json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    code, e = run(sources, "--frozen", f"{tmp_path}/frozen.parquet")
    assert code == 0 and e["counts"] == {"sources": 4}, e
    r = {x.source_id: x for x in spark.read.parquet(e["artifact_refs"][0]).collect()}
    assert (r["a"].status, r["a"].record_count, r["a"].content_hash_status, r["a"].required_field_status, r["a"].sensitive_check_status, r["a"].actual_tool_scope) == ("AUDITED_LOCAL", 2, "MATCHED", "AVAILABLE", "SENSITIVE_FIELD_NAMES_PRESENT", ["read"])
    assert (r["b"].record_count, r["b"].content_hash_status, r["b"].required_field_status, r["b"].sensitive_check_status, r["b"].actual_tool_scope) == (1, "UNDECLARED", "MISSING", "POTENTIAL_FREE_TEXT_REVIEW_REQUIRED", ["add", "look"])
    assert (r["c"].status, r["c"].content_hash_status, r["c"].required_field_status, list(r["c"].warnings)) == ("METADATA_ONLY", "NOT_APPLICABLE", "NOT_DECLARED", ["remote access was not requested"])
    assert (r["d"].status, r["d"].content_sha256, r["d"].dependency_status) == ("AUDITED_FROZEN_DOCUMENT", "f" * 64, "AVAILABLE")
    for bad, what in (([sources[0] | {"expected_sha256": "0" * 64}], "MISMATCH"), ([sources[3]], "MISSING_SNAPSHOT"), ([one | {"license": ""}], "MISSING:license"), ([one, one], "DUPLICATE_ID"), ([one | {"required_upstream_fields": [""]}], "EMPTY_FIELD_NAME"), ([one | {"local_path": f"{tmp_path}/none.json"}], "none.json")):
        code, e = run(bad)
        assert code == 2 and what in e["errors"][0], (what, e)


def test_rewards_under_another_policy(spark):
    e = spark.createDataFrame([("a", "t", "COMPLETED", "VERIFIED", "PASS", 1.0), ("b", "t", "BUDGET_TRUNCATED", "VERIFIED", "PASS", 1.0)], "attempt_id string, task_id string, end_reason string, verification_status string, outcome string, total_reward double")
    policy = {"policy_version": "p", "pass_reward": 3, "fail_reward": 0}
    assert [(r.new_reward, r.availability, r.reward_policy_version) for r in reports.rescored(e, policy).orderBy("attempt_id").collect()] == [(3.0, "KNOWN", "p"), (None, "UNKNOWN", "p")]
    for change in ({"policy_version": ""}, {"pass_reward": None}, {"unknown_reward": 0}, {"dense_reward": True}, {"fail_reward": True}):
        with pytest.raises(ValueError):
            reports.rescored(e, policy | change)


def test_forests_grow_as_if_at_once(spark):
    rnd = random.Random(11)
    rows = [(f"t{i}", [f"s{rnd.randint(0, 40)}" for _ in range(rnd.randint(0, 2))] or None, rnd.choice([None, f"r{rnd.randint(0, 30)}"]), [f"t{rnd.randint(0, 70)}" for _ in range(rnd.randint(0, 1))]) for i in range(60)]
    rnd.shuffle(rows)
    ddl = "task_id string, source_groups array<string>, template_root string, related_task_ids array<string>"
    forest, frozen = splits.empty_forest(spark), spark.createDataFrame([("t1", "TRAIN"), ("t2", "TEST")], "task_id string, scope string")
    for at in (0, 20, 20, 45):
        batch = rows[at : {0: 20, 20: 45, 45: 60}[at]] if at != 20 or forest.nodes.filter(f"node = 't:{rows[20][0]}'").isEmpty() else []
        forest = splits.extend_forest(forest, spark.createDataFrame(batch, ddl))
        done = spark.createDataFrame(rows[: max(20, at + len(batch))] if batch else rows[:45], ddl)
        want = {tuple(r) for r in splits.split_components(done).collect()}
        got = [tuple(r) for r in splits.forest_components(forest).collect()]
        assert set(got) == want and len(got) == len(want)
    a, b = (x[0].select("task_id", "scope", "quarantined") for x in (splits.place(splits.forest_components(forest), frozen), splits.assign_splits(spark.createDataFrame(rows, ddl), frozen)))
    assert joins.set_differences(a, b).isEmpty()


def test_ascii_json_of_all_planes(spark):
    values = ["", "plain", "é", "\x7f\x80", "\u2028中", "😀a\U0010ffff", '"\\ü/', "\n\t\x01é", None] + [chr(c) for c in range(0xA0, 0x2FFFF, 977) if not 0xD800 <= c < 0xE000]
    d = spark.createDataFrame(list(enumerate(values)), "k int, v string")
    got = {r.k: r.j for r in d.select("k", text.ascii_json("k", "v").alias("j")).collect()}
    assert all(json.loads(got[i]) == {"k": i, "v": v} and got[i].isascii() for i, v in enumerate(values))
    plain = [i for i, v in enumerate(values) if v and v.isprintable() and "/" not in v]
    assert all(got[i] == json.dumps({"k": i, "v": values[i]}, separators=(",", ":")) for i in plain) and len(plain) > 100
