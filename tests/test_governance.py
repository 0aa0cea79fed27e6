"""Drafts, releases, exports, evaluation, contracts and the command line, on small hand-made inputs."""

import json

import pytest
from pyspark.sql import functions as F

from skein import cli
from skein.operators import decisions, evaluation, joins, sft, splits, trajectory
from skein.plans import builds
from skein.sources import generators, merkle, readers, writers
from skein.streaming import ledger

CHECKS = list(decisions.REVIEW_CHECKS)


def demo(i, **more):
    return {"demonstration_id": f"d{i}", "source_record_id": f"s{i}", "source_origin": "PUBLIC_ORIGINAL", "message_refs": ["m"]} | more


def inputs(tmp_path, demos=None, decided=None, material=None):
    """Files of an external build."""
    demos = demos or [demo(i) for i in range(6)] + [demo(6, source_origin="DERIVED", parent_demonstration_id="d0", repair_rule_ref="r")]
    actions = ["ACCEPT", "REJECT", "QUARANTINE", "ACCEPT", "ACCEPT", None, "ACCEPT"]
    decided = decided or [{"demonstration_id": d["demonstration_id"], "decision_id": f"e{i}", "action": a, "review_checks": CHECKS} for i, (d, a) in enumerate(zip(demos, actions, strict=True)) if a]
    talk = [{"role": "user", "content": "h\u00e9"}, {"role": "assistant", "content": "ok"}]
    material = material or [{"demonstration_id": d["demonstration_id"], "messages": talk} for d in demos]
    files = {"demos.json": {"external_demonstrations": [*demos, "no object"]}, "decisions.json": {"eligibility_decisions": decided}, "material.json": {"external_material": material}, "sources.json": {}, "split.json": {}}
    for name, value in files.items():
        (tmp_path / name).write_text(json.dumps(value))
    build = {"source_manifests": ["sources.json"], "external_demonstration_manifests": ["demos.json"], "external_material_manifests": ["material.json"], "eligibility_manifests": ["decisions.json"], "split_registry_ref": "split.json", "rule_version": "v1"}
    (tmp_path / "build.json").write_text(json.dumps(build))
    return str(tmp_path / "build.json")


def run(spark, capsys, *args):
    code = cli.main(["--json", *map(str, args)], spark)
    out = capsys.readouterr().out.strip().splitlines()
    return code, json.loads(out[-1]) if out else None


def test_main_line(spark, tmp_path, capsys):
    out = tmp_path / "out"
    code, e = run(spark, capsys, "data", "build", "--input", inputs(tmp_path), "--output-dir", out, "--resume", "run-1")
    assert code == 0 and e["counts"] == {"inputs": 5, "members": 4, "accepted": 4}, e
    receipt = json.loads((out / "draft/build_receipt.json").read_text())
    assert (receipt["rejected_count"], receipt["quarantined_count"], receipt["pending_review_count"], receipt["accepted_repaired_count"]) == (1, 1, 1, 1)
    assert run(spark, capsys, "data", "build", "--input", tmp_path / "build.json", "--output-dir", out, "--resume", "run-1")[1]["counts"]["members"] == 4
    assert run(spark, capsys, "data", "build", "--input", tmp_path / "build.json", "--output-dir", out, "--resume", "other")[0] == 2
    (tmp_path / "policy.yaml").write_text("policy_version: p1\n")
    draft = out / "draft/membership.parquet"
    assert run(spark, capsys, "dataset", "publish", "--draft", draft, "--output-dir", out / "release")[0] == 2
    code, e = run(spark, capsys, "dataset", "publish", "--draft", draft, "--config", tmp_path / "policy.yaml", "--output-dir", out / "release")
    assert code == 0 and e["counts"] == {"members": 4}
    release = out / "release/external"
    assert {p.name for p in release.iterdir() if not p.name.startswith(".")} >= {"membership.parquet", "dataset_manifest.json", "recipe.json", "quality_report.json", "diversity_report.json", "cost_report.json", "data_card.md", "lineage"}
    assert run(spark, capsys, "dataset", "publish", "--draft", draft, "--config", tmp_path / "policy.yaml", "--output-dir", out / "release")[0] == 0
    changed = spark.read.parquet(str(draft)).withColumn("source_record_id", F.lit("other"))
    with pytest.raises(ValueError, match="other content"):
        writers.publish(changed, str(out / "release"), "external", "p1", "x")
    (tmp_path / "sft.json").write_text(json.dumps({"tokenizer_name": "bytes", "tokenizer_revision": "1", "template_version": "t1"}))
    code, e = run(spark, capsys, "dataset", "export-sft", "--dataset", release / "membership.parquet", "--config", tmp_path / "sft.json", "--output-dir", out)
    assert code == 0 and e["counts"] == {"examples": 4}
    view = spark.read.parquet(str(out / "export/training_examples.parquet")).orderBy("demonstration_id").first()
    assert view.input_ids == [*b"user\n", *"h\u00e9".encode(), 256, 10, *b"assistant\n", *b"ok", 256, 10] and sum(view.loss_mask) == 14
    manifest = json.loads((out / "export/export_manifest.json").read_text())
    assert json.loads((release / "dataset_manifest.json").read_text())["member_count"] == manifest["source_external_demonstration_count"] == receipt["accepted_count"]
    lineage = spark.read.parquet(str(release / "lineage/external_demonstrations.parquet"))
    assert builds.release_coverage(lineage, spark.read.parquet(str(draft)), spark.read.parquet(str(out / "export/training_examples.parquet"))).count() == 0
    code, e = run(spark, capsys, "source", "revoke", "--source-record-id", "s3", "--dataset", release, "--output-dir", out / "ledger")
    assert code == 0 and e["counts"] == {"affected": 3, "datasets": 1, "runs": 0, "claims": 0}  # the dataset, its member and the member's decision
    (tmp_path / "runs").mkdir()
    (tmp_path / "runs/a.json").write_text(json.dumps([{"run_id": "r1", "dataset_id": "external"}, {"run_id": "r2", "dataset_id": "none"}]))
    (tmp_path / "claims").mkdir()
    (tmp_path / "claims/a.json").write_text(json.dumps({"claim_id": "c1", "quality_decision_id": "e3"}))
    (tmp_path / "claims/b.json").write_text(json.dumps([{"claim_id": "c2", "source_record_ids": ["s3", "s9"]}, {"claim_id": "c3", "attempt_id": "d1"}]))
    code, e = run(spark, capsys, "source", "revoke", "--source-record-id", "s3", "--dataset", out / "release", "--runs", tmp_path / "runs", "--claims", tmp_path / "claims", "--output-dir", out / "ledger")
    assert code == 0 and e["counts"] == {"affected": 6, "datasets": 1, "runs": 1, "claims": 2}


def test_an_import_is_built_and_released(spark, tmp_path, capsys):
    call = {"role": "assistant", "tool_calls": [{"id": "c", "name": "f", "arguments": {"x": 1}}]}
    good = {"question": "q", "tools": [{"name": "f"}], "status": "synthetic", "messages": [{"role": "user", "content": "q"}, call, {"role": "tool", "tool_call_id": "c", "content": {"y": [1]}}, {"role": "assistant", "content": "a", "tool_calls": []}]}
    rows = [good | {"id": "h1"}, {"uuid": "h2", "tools": "[]", "messages": json.dumps([{"role": "user", "content": "q"}, {"role": "tool_call", "content": "f()"}, {"role": "tool_response", "content": "r"}, {"role": "assistant", "content": "b"}])}, good | {"id": "h3", "messages": [{"role": "tool", "content": "x"}]}, 5]
    (tmp_path / "h.json").write_text(json.dumps(rows))
    code, e = run(spark, capsys, "trajectory", "import", "--source", tmp_path / "h.json", "--adapter", "toucan", "--output-dir", tmp_path / "i")
    assert code == 0 and e["counts"] == {"records": 2, "external_demonstrations": 2, "quarantine": 2}, e
    assert run(spark, capsys, "trajectory", "import", "--source", tmp_path / "h.json", "--adapter", "toucan", "--output-dir", tmp_path / "i")[0] == 0  # a retry
    made = lambda n: spark.read.parquet(f"{tmp_path}/i/import/{n}.parquet")
    assert {(r.record_id, r.reason) for r in made("quarantine").collect()} == {("h3", "ORPHAN_TOOL_RESULT"), ("<unknown>", "INVALID_MESSAGE")}
    assert {r.source_record_id for r in made("source_records").collect()} == {"toucan-import:h1", "toucan-import:h2"}
    d = made("external_demonstrations").orderBy("demonstration_id").first()
    assert len(d.message_refs) == 4 and d.call_result_refs == [d.message_refs[2]] and d.upstream_synthetic_status == "synthetic"
    assert [r.event_type for r in made("events").filter("attempt_id = 'toucan-import:h2:historical'").orderBy("seq").collect()] == ["OBSERVATION", "TOOL_CALL", "TOOL_RESULT", "MODEL_OUTPUT"]
    decided = [{"demonstration_id": f"toucan-import:{h}", "decision_id": f"e-{h}", "action": "ACCEPT", "review_checks": CHECKS} for h in ("h1", "h2")]
    (tmp_path / "decisions.json").write_text(json.dumps({"eligibility_decisions": decided}))
    (tmp_path / "split.json").write_text("{}")
    env = lambda n: f"i/import/{n}.envelope.json"
    (tmp_path / "build.json").write_text(json.dumps({"source_manifests": [env("source_records")], "external_demonstration_manifests": [env("external_demonstrations")], "external_material_manifests": [env("external_material")], "eligibility_manifests": ["decisions.json"], "split_registry_ref": "split.json", "rule_version": "v1"}))
    code, e = run(spark, capsys, "data", "build", "--input", tmp_path / "build.json", "--output-dir", tmp_path / "o")
    assert code == 0 and e["counts"] == {"inputs": 5, "members": 2, "accepted": 2}, e
    (tmp_path / "policy.yaml").write_text("policy_version: p1\n")
    code, e = run(spark, capsys, "dataset", "publish", "--draft", tmp_path / "o/draft/membership.parquet", "--config", tmp_path / "policy.yaml", "--output-dir", tmp_path / "r")
    assert code == 0 and e["counts"] == {"members": 2}
    (tmp_path / "sft.json").write_text(json.dumps({"tokenizer_name": "bytes", "tokenizer_revision": "1", "template_version": "t1"}))
    code, e = run(spark, capsys, "dataset", "export-sft", "--dataset", tmp_path / "r/external/membership.parquet", "--config", tmp_path / "sft.json", "--output-dir", tmp_path)
    assert code == 0 and e["counts"] == {"examples": 2}, e


@pytest.mark.parametrize("change, fault", [({"review_checks": CHECKS[:5]}, "REVIEW_CHECKS"), ({"action": "MAYBE"}, "UNKNOWN_ACTION"), ({"decision_id": ""}, "NO_DECISION")])
def test_faults_of_decisions_stop_a_build(spark, tmp_path, capsys, change, fault):
    one = {"demonstration_id": "d0", "decision_id": "e", "action": "ACCEPT", "review_checks": CHECKS} | change
    code, e = run(spark, capsys, "data", "build", "--input", inputs(tmp_path, [demo(0)], [one]), "--output-dir", tmp_path / "o")
    assert code == 2 and e["errors"] == [f"d0: {fault}"] and not (tmp_path / "o").exists()


def test_admission_takes_the_last_decision_and_asks_for_material(spark):
    d = spark.createDataFrame([("a", "s", "PUBLIC_ORIGINAL", ["m"]), ("b", "s", "MODEL", ["m"]), ("c", "s", "DERIVED", [])], "demonstration_id string, source_record_id string, source_origin string, message_refs array<string>")
    e = spark.createDataFrame([("a", "1", "ACCEPT", CHECKS, 0), ("a", "2", "REJECT", CHECKS, 1), ("b", "3", "ACCEPT", CHECKS, 2)], "demonstration_id string, decision_id string, action string, review_checks array<string>, position int")
    m = spark.createDataFrame([("b", ["x"])], "demonstration_id string, messages array<string>")
    assert {r.demonstration_id: (r.status, r.fault) for r in builds.admission(d, e, m).collect()} == {"a": ("REJECT", "NO_MATERIAL"), "b": ("ACCEPT", "ORIGIN"), "c": ("PENDING", None)}
    with pytest.raises(Exception, match="no external member"):
        decisions.ingress(d).collect()


def test_execution_draft(spark, tmp_path):
    tasks = spark.createDataFrame([("t1", "f", "Do it!", ["s"], []), ("t2", "f", "do IT", ["s"], []), ("t3", "f", "other", ["s"], [])], "task_id string, task_family string, instruction string, source_record_ids array<string>, derivation_root_ids array<string>")
    attempts = spark.createDataFrame([("a1", "t1", "AGENT", "TRAIN", 0), ("a2", "t2", "AGENT", "TRAIN", 1), ("a3", "t3", "SCRIPTED_FIXTURE", "TRAIN", 2)], "attempt_id string, task_id string, actor_kind string, usage_scope string, position int")
    checks = spark.createDataFrame([(f"a{i}", "VERIFIED", "PASS") for i in (1, 2, 3)], "attempt_id string, status string, outcome string")
    done = builds.execution_draft(tasks, attempts, checks, str(tmp_path), "r", "q1", "h")
    got = {r.attempt_id: (r.decision, r.usage_scope) for r in spark.read.parquet(f"{tmp_path}/draft/membership.parquet").collect()}
    assert got == {"a1": ("ACCEPT", "TRAIN"), "a2": ("REJECT", "TRAIN"), "a3": ("ACCEPT", "DEVELOPMENT")} and (done["member_count"], done["accepted_count"]) == (3, 2)
    assert builds.execution_draft(tasks, attempts, checks, str(tmp_path), "r", "q1", "h")["logical_content_hash"] == done["logical_content_hash"]
    with pytest.raises(Exception, match="verification is missing"):
        builds.execution_members(tasks, attempts, checks.limit(1), "q1").collect()


def test_equivalence(spark, tmp_path):
    rows = spark.range(9).select(F.concat(F.lit("t"), "id").alias("task_id"), F.repeat(F.lit("x"), F.col("id").cast("int") * 20).alias("projection"))
    r = builds.equivalence(rows, str(tmp_path))
    assert r["local_hash"] == r["distributed_hash"] and r["full_hash"] == r["incremental_hash"]


def test_evaluation_and_feedback(spark, tmp_path, capsys):
    suite = {"suite_id": "s", "version": "1", "development_task_count": 200, "source_template_group_count": 20, "minimum_family_count": 60}
    for name, value in {"suite.json": suite, "model.json": {"kind": "FIXTURE_EVALUATOR"}, "none.json": {"kind": "x"}}.items():
        (tmp_path / name).write_text(json.dumps(value))
    go = lambda *a: run(spark, capsys, "evaluate", "run", "--suite", tmp_path / "suite.json", "--output-dir", tmp_path / "o", *a)
    assert go("--model", tmp_path / "model.json")[1]["counts"] == {"tasks": 200}
    assert json.loads((tmp_path / "o/evaluation_run.json").read_text())["metrics"]["task_success_at_1"] == 1.0
    assert go("--model", tmp_path / "none.json")[0] == 2 and go("--model", tmp_path / "model.json", "--split", "TEST")[0] == 2
    tasks = generators.tool_suite(spark, "DEVELOPMENT")
    assert [r.task_id for r in evaluation.evaluation_tasks(tasks, "DEVELOPMENT", ["tooltask-development-007", "tooltask-development-001"]).collect()] == ["tooltask-development-007", "tooltask-development-001"]
    for wrong in (["x", "x"], []):
        with pytest.raises(ValueError):
            evaluation.evaluation_tasks(tasks, "DEVELOPMENT", wrong)
    with pytest.raises(Exception, match="missing"):
        evaluation.evaluation_tasks(tasks, "DEVELOPMENT", ["no-such"]).collect()
    results = spark.createDataFrame([("tooltask-development-000", 1, "down", None), ("tooltask-development-000", 2, None, "2"), ("tooltask-development-000", 3, None, "9"), ("tooltask-development-001", 1, "down", None), ("tooltask-development-001", 2, "again", None)], "task_id string, attempt_number int, error string, value string")
    results = results.withColumns({"unit": F.lit("cm"), "evidence": F.array(F.lit("document-000")), "constraint_valid": F.lit(None).cast("boolean"), "model_calls": F.lit("2"), "completion_tokens": F.lit("x"), "provider_cost_cny": F.lit(0.5)})
    got = {r.task_id[-3:]: r for r in evaluation.evaluation_records(tasks.limit(3), results).collect()}
    assert got["000"].task_success and (got["000"].attempts, got["000"].model_calls, got["000"].completion_tokens) == (2, 2, 0)
    assert not got["001"].effective_execution and got["001"].unresolved_infrastructure == "again" and got["002"].unresolved_infrastructure == "not run"
    assert generators.load_suite(generators.public_tasks(tasks), tasks.select("task_id", F.col("expected_value").alias("value"), F.col("expected_unit").alias("unit"), F.col("document_ids").alias("evidence"))).count() == 200


def test_verification(spark):
    tasks = spark.createDataFrame([("t",)], "task_id string")
    want = spark.createDataFrame([("t", "100.0", "m", ["x"])], "task_id string, value string, unit string, required_evidence array<string>")
    attempts = spark.createDataFrame([("a", "t", "100", "m", ["x", "y"]), ("b", "t", "1", "m", ["x"])], "attempt_id string, task_id string, value string, unit string, evidence array<string>")
    assert {r.attempt_id: r.outcome for r in evaluation.verify_attempts(tasks, want, attempts, "v").collect()} == {"a": "PASS", "b": "FAIL"}
    with pytest.raises(Exception, match="final output"):
        evaluation.verify_attempts(tasks, want, attempts.withColumn("value", F.lit(None).cast("string")), "v").collect()
    with pytest.raises(ValueError, match="unique"):
        evaluation.verify_attempts(tasks.union(tasks), want, attempts, "v")


class Rewriting(sft.ByteTokenizer):
    """A template that changes earlier turns once another follows."""

    def apply_chat_template(self, messages, tokenize=True, add_generation_prompt=False):
        return [len(messages), *super().apply_chat_template(messages)]


def test_masks_of_any_template():
    talk = [{"role": "user", "content": "q"}, {"role": "assistant", "content": None, "tool_call": '{"b": 1, "a": "\u00e9"}'}, {"role": "tool", "content": "r"}, {"role": "assistant", "content": "done"}]
    call = b'{"a":"\\u00e9","b":1}'
    plain, odd = sft.tokenise(sft.ByteTokenizer(), talk), sft.tokenise(Rewriting(), talk)
    assert bytes(t for t, m in zip(plain["input_ids"], plain["loss_mask"], strict=True) if m and t < 256) == b"assistant\n" + call + b"\n" + b"assistant\ndone\n"
    assert bytes(t for t, m in zip(odd["input_ids"], odd["loss_mask"], strict=True) if m) == call + b"done" and odd["role_loss_counts"] == {"user": 0, "assistant": len(call) + 4, "tool": 0}
    with pytest.raises(ValueError, match="exactly one span"):
        sft.tokenise(Rewriting(), [{"role": "user", "content": "done"}, {"role": "assistant", "content": "done"}])
    with pytest.raises(ValueError, match="roles"):
        sft.tokenise(sft.ByteTokenizer(), [{"role": "system", "content": "x"}])


def test_command_envelope(spark, tmp_path, capsys):
    assert len(cli.VERBS) == 21
    assert run(spark, capsys, "no", "such")[0] == 2 and run(spark, capsys)[0] == 0
    code, e = run(spark, capsys, "--dry-run", "data", "build")
    assert (code, e["status"]) == (0, "VALIDATED")
    code, e = run(spark, capsys, "dataset", "publish")
    assert code == 2 and e["errors"] == ["required: --draft, --output-dir"]
    assert run(spark, capsys, "trajectory", "replay", "--output-dir", tmp_path)[0] == 2
    (tmp_path / "c.json").write_text("{}")
    assert run(spark, capsys, "experiment", "calibrate", "--config", tmp_path / "c.json", "--output-dir", tmp_path)[0] == 8
    (tmp_path / "sft.json").write_text(json.dumps({"tokenizer_name": "hub/x", "tokenizer_revision": "1", "template_version": "t"}))
    spark.range(1).write.parquet(f"{tmp_path}/m.parquet")
    assert run(spark, capsys, "dataset", "export-sft", "--dataset", tmp_path / "m.parquet", "--config", tmp_path / "sft.json", "--output-dir", tmp_path)[0] == 3
    facts = [{"document_id": f"d{9 - i}", "source_record_id": f"s{i}", "source_group_id": f"g{i}", "label": "size", "value": 5 + i, "unit": "m", "companion_document_id": f"c{i}", "companion_source_record_id": f"cs{i}", "companion_source_group_id": None} for i in range(3)]
    (tmp_path / "facts.json").write_text(json.dumps({"facts": facts}))
    assert run(spark, capsys, "task", "build", "--config", tmp_path / "facts.json", "--output-dir", tmp_path / "t")[1]["counts"] == {"tasks": 100}
    placed = spark.read.parquet(f"{tmp_path}/t/tasks/task_manifest.parquet")
    assert {r.scope for r in placed.select("scope").distinct().collect()} == {"DEVELOPMENT"} and placed.select("instruction_ref.sha256").distinct().count() == 100
    private = {r.task_id: r for r in spark.read.parquet(f"{tmp_path}/t/tasks/private_expected_results.parquet").collect()}
    assert (private["pilot-002"].input_value, private["pilot-002"].expected_value) == (2, 12) and "expected_value" not in placed.columns  # the second fact of the config
    second = placed.filter("task_id = 'pilot-002'").first()
    assert second.instruction == "Read d8 and calculate 2 times size." and second.tool_set == ["search_documents", "read_document", "calculate"]
    registry = spark.read.parquet(f"{tmp_path}/t/tasks/split_registry.parquet")
    assert registry.count() == 100 and splits.frozen_of(registry).count() == 0
    rows = [{"id": "r1", "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "tools": "[]"}, {"id": "r2", "messages": [], "tools": "[]"}]
    (tmp_path / "h.json").write_text(json.dumps(rows))
    code, e = run(spark, capsys, "trajectory", "import", "--source", tmp_path / "h.json", "--adapter", "toucan", "--output-dir", tmp_path / "i")
    assert code == 0 and e["counts"] == {"records": 1, "external_demonstrations": 1, "quarantine": 1}
    assert spark.read.parquet(f"{tmp_path}/i/import/quarantine.parquet").first().reason == "MISSING_ANSWER"
    assert len(writers.export_schemas(spark, str(tmp_path / "schemas"))) == 8


def test_build_input_refuses(spark, tmp_path):
    path = inputs(tmp_path)
    good = json.loads(open(path).read())
    for change in ({"rule_version": ""}, {"split_registry_ref": "../x"}, {"source_manifests": []}, {"eligibility_manifests": ["gone.json"]}):
        (tmp_path / "bad.json").write_text(json.dumps(good | change))
        with pytest.raises(Exception):
            readers.build_input(spark, str(tmp_path / "bad.json"))
    assert len(readers.build_input(spark, path)["hashes"]) == 5


def test_frozen_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("hello")
    frozen = readers.freeze_files(spark, str(tmp_path / "in"), f"file://{tmp_path}/out").collect()
    assert open(f"{tmp_path}/out/{frozen[0].sha256}").read() == "hello"


def test_streams_commit_and_hold_budgets(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, i, c) for i, c in enumerate([6, 9, 3])], "attempt_id string, event_id int, seq int, cost int").withColumn("event_id", F.col("seq"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    s = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    q = ledger.budget_stream(s, {"cost": 10}).writeStream.format("memory").queryName("budgets").option("checkpointLocation", f"{tmp_path}/c1").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {r.event_id: r.allowed for r in spark.table("budgets").collect()} == {0: True, 1: False, 2: True}
    for n in (1, 2):  # the second stream delivers all again
        ledger.commit_stream(s.select("seq", "cost"), f"{tmp_path}/out", f"{tmp_path}/cp{n}", "seq").awaitTermination(120)
    assert merkle.read_build(spark, f"{tmp_path}/out").count() == 3


def test_small_joins(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert joins.lookup(rows, "k", "b") == {"k": "b", "v": 2}
    with pytest.raises(KeyError):
        joins.lookup(rows, "k", "z")
    e = spark.createDataFrame([("x", 0, "TOOL_CALL", "p"), ("x", 1, "OTHER", "q")], "attempt_id string, seq int, event_type string, payload string")
    assert [r.replay_attempt_id for r in trajectory.replay_calls(e).collect()] == ["replay-x"]
