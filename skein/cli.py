"""Command line: `python -m skein.cli GROUP VERB --option value ...`, one JSON envelope on stdout, errors on stderr.

Exit codes: 0 done, 2 wrong input, 3 a library is missing, 8 a gate failed. Commands run on the session that is there, or on
a local one. Training, sampling and hosts' preflight are out of scope: their verbs refuse.
"""

from __future__ import annotations

import argparse
import json
import sys
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions.identity import tree_digest
from skein.operators import audit, evaluation, graph, joins, reports, sft, splits, trajectory
from skein.plans import builds, experiments
from skein.sources import generators, json_arrays, readers, writers

OK, INPUT_ERROR, DEPENDENCY_ERROR, GATE_FAILED = 0, 2, 3, 8
Done = tuple[list[str], dict[str, int]]
VERBS: dict[str, tuple[Callable[[SparkSession, argparse.Namespace], Done], tuple[str, ...]]] = {}

DEMONSTRATION = "demonstration_id string, source_record_id string, source_origin string, message_refs array<string>, parent_demonstration_id string, replay_capability string, repair_rule_ref string"
ELIGIBILITY = "demonstration_id string, decision_id string, action string, review_checks array<string>"
MATERIAL = "demonstration_id string, messages array<struct<role: string, content: string, tool_call: string>>"
TASK = "task_id string, task_family string, instruction string, source_record_ids array<string>, derivation_root_ids array<string>, usage_scope string"
ATTEMPT = "attempt_id string, task_id string, actor_kind string, usage_scope string"
VERIFICATION = "attempt_id string, status string, outcome string"
RESULT = "task_id string, attempt_number int, error string, value string, unit string, evidence array<string>, constraint_valid boolean, model_calls string, completion_tokens string, provider_cost_cny double"


class GateFailed(Exception):
    """A command ran, and what it checks does not hold."""


def verb(name: str, *needs: str):
    def add(f):
        VERBS[name] = f, needs
        return f

    return add


def _table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    return readers.histories(spark, path, schema)


@verb("source audit", "manifest")
def source_audit(spark, o):
    """manifest: {"sources": [declarations]}, paths below the manifest's folder or absolute; --frozen names the table of frozen documents."""
    given = readers.load_config(o.manifest).get("sources")
    if not isinstance(given, list) or not all(isinstance(s, dict) for s in given):
        raise ValueError("the manifest needs a list of declarations")
    declared = spark.createDataFrame([], audit.DECLARED)
    declared = spark.createDataFrame([tuple(s.get(c) for c in declared.columns) for s in given], audit.DECLARED)
    report = audit.report(spark, declared, _table(spark, o.frozen) if o.frozen else None)
    paths = writers.write_bundle(spark, f"{o.output_dir}/source_report", {"sources": report}, {"manifest": {"manifest_sha256": audit.manifest_hash(declared)}}, ("sources",))
    return list(paths.values()), {"sources": len(given)}


@verb("source freeze", "source")
def source_freeze(spark, o):
    frozen = readers.freeze_files(spark, o.source, f"{o.output_dir}/content")
    paths = writers.write_bundle(spark, f"{o.output_dir}/snapshot", {"sources": frozen})
    return list(paths.values()), {"sources": spark.read.parquet(paths["sources"]).count()}


@verb("source revoke", "source_record_id", "dataset")
def source_revoke(spark, o):
    """dataset: a release's folder, or the folder of many; --runs and --claims: JSON records that name sources, datasets, attempts or decisions."""
    roots = [o.dataset] if writers.exists(spark, f"{o.dataset}/membership.parquet") else writers.folders(spark, o.dataset)
    parts = [spark.read.parquet(f"{r}/membership.parquet").withColumn("dataset_id", F.lit(r.rstrip("/").rsplit("/", 1)[-1])) for r in roots if writers.exists(spark, f"{r}/membership.parquet")]
    if not parts:
        raise ValueError("there is no release")
    wide = lambda df: df.select("source_record_ids", "dataset_id", *(F.col(c).cast("string").alias(n) if c else F.lit(None).cast("string").alias(n) for n, names in (("attempt_id", ("attempt_id", "demonstration_id")), ("quality_decision_id", ("quality_decision_id", "eligibility_decision_id"))) for c in [next((x for x in names if x in df.columns), None)]))
    members = reduce(DataFrame.unionByName, map(wide, parts))
    records = lambda path, key: json_arrays.json_records(spark, path, f"{key} string, source_record_ids array<string>, dataset_id string, attempt_id string, quality_decision_id string") if path else None
    links = joins.lineage_links(members, records(o.runs, "run_id"), records(o.claims, "claim_id"))
    reached = graph.reachable(spark.createDataFrame([("source", o.source_record_id)], "kind string, id string"), links)
    entry = writers.revocation_entry(o.source_record_id, reached.filter("step > 0").select("kind", "id"), o.output_dir)
    made = spark.read.parquet(entry)
    counts = {f"{k}s": made.filter(F.col("kind") == k).count() for k in joins.REVOCATION_ACTIONS}
    return [entry], {"affected": made.count()} | counts


@verb("task build", "config")
def task_build(spark, o):
    """config: {"facts": [facts, in order]}; with labels, values and units the tasks are packages, and what their verifier sees is a table of its own."""
    given = readers.load_config(o.config)["facts"]
    names = ("document_id", "source_record_id", "source_group_id", "label", "value", "unit", "companion_document_id", "companion_source_record_id", "companion_source_group_id")
    rows = [(n, *(None if f.get(c) is None else str(f[c]) for c in names)) for n, f in enumerate(given) if isinstance(f, dict)]
    facts = spark.createDataFrame(rows, ", ".join(["position int", *(f"{c} string" for c in names)]))
    tasks = generators.pilot_tasks(spark, facts)
    none = spark.createDataFrame([], "task_id string, scope string")
    assigned, conflicts = splits.assign_splits(tasks, none)
    placed, tables = tasks.join(assigned, "task_id"), {}
    if facts.filter("value is not null and label is not null and unit is not null").count() == facts.count():
        packages = generators.pilot_packages(spark, facts)
        private = ["input_value", "expected_value", "expected_unit"]
        placed = placed.join(packages.drop("task_family", *private), "task_id").withColumn("instruction_ref", writers.asset_ref("instruction", "instruction"))
        tables = {"private_expected_results": packages.select("task_id", "task_family", *private)}
    paths = writers.write_bundle(spark, f"{o.output_dir}/tasks", {"task_manifest": placed, "split_registry": splits.registry(assigned, conflicts, none), **tables})
    return list(paths.values()), {"tasks": spark.read.parquet(paths["task_manifest"]).count()}


@verb("trajectory import", "source", "adapter")
def trajectory_import(spark, o):
    if o.adapter != "toucan":
        raise ValueError("the adapter is toucan")
    rows = spark.read.parquet(o.source) if o.source.rstrip("/").endswith(".parquet") else trajectory.histories_of(json_arrays.json_items(spark, o.source))
    counts = builds.import_bundle(rows, f"{o.output_dir}/import", "toucan-import")
    return [f"{o.output_dir}/import"], counts


@verb("trajectory inspect", "attempts", "input")
def trajectory_inspect(spark, o):
    rows = trajectory.inspect(_table(spark, o.input), _table(spark, o.attempts))
    paths = writers.write_bundle(spark, f"{o.output_dir}/inspection", {"attempts": rows})
    return list(paths.values()), {"attempts": spark.read.parquet(paths["attempts"]).count()}


@verb("trajectory collect", "tasks")
def trajectory_collect(spark, o):
    rows = generators.fixed_attempts(_table(spark, o.tasks))
    paths = writers.write_bundle(spark, f"{o.output_dir}/collected", {"attempts": rows})
    return list(paths.values()), {"attempts": spark.read.parquet(paths["attempts"]).count()}


@verb("verify run", "tasks", "attempts", "evidence", "config")
def verify_run(spark, o):
    version = readers.load_config(o.config).get("verifier_version")
    if not isinstance(version, str):
        raise ValueError("the config needs verifier_version")
    rows = evaluation.verify_attempts(_table(spark, o.tasks), _table(spark, o.evidence), _table(spark, o.attempts), version)
    paths = writers.write_bundle(spark, f"{o.output_dir}/verifications", {"verifications": rows})
    counts = evaluation.verification_counts(spark.read.parquet(paths["verifications"])).first().asDict()
    writers.put_json(spark, f"{o.output_dir}/manifest.json", {"kind": "pilot-verifications", "verifier_version": version, **counts})
    return [*paths.values(), f"{o.output_dir}/manifest.json"], {"attempts": counts["attempt_count"]}


@verb("data build", "input")
def data_build(spark, o):
    made = readers.build_input(spark, o.input)
    given, split_hash = experiments.digest(made["hashes"]), experiments.digest(made["files"]["split_registry"])
    receipt = f"{o.output_dir}/draft/build_receipt.json"
    if o.resume and writers.exists(spark, receipt):
        done = writers.get_json(spark, receipt)
        if (done["run_id"], done["input_manifest_hash"]) != (o.resume, given):
            raise ValueError("--resume is not the run of the receipt")
    else:
        files, run_id = made["files"], o.resume or str(uuid.uuid4())
        read = lambda name, field, schema: readers.streams(spark, files[name], field, schema)
        if made["kind"] == "EXTERNAL_DEMONSTRATION":
            rows = (read("external_demonstration_manifests", "external_demonstrations", DEMONSTRATION), read("eligibility_manifests", "eligibility_decisions", ELIGIBILITY), read("external_material_manifests", "external_material", MATERIAL))
            done = builds.external_draft(*rows, o.output_dir, run_id, made["rule_version"], given, split_hash)
        else:
            rows = (read("task_manifests", "tasks", TASK).drop("position"), read("attempt_manifests", "attempts", ATTEMPT), read("verification_manifests", "verifications", VERIFICATION))
            done = builds.execution_draft(*rows, o.output_dir, run_id, made["rule_version"], given, split_hash)
    return [receipt, f"{o.output_dir}/draft/membership.parquet"], {"inputs": len(made["hashes"]), "members": done["member_count"], "accepted": done["accepted_count"]}


@verb("dataset publish", "draft")
def dataset_publish(spark, o):
    members = _table(spark, o.draft)
    external = "demonstration_id" in members.columns
    rule = readers.load_config(o.config).get("policy_version") if o.config else "quality-v1"
    if external and not o.config or not rule:
        raise ValueError("external members need --config with policy_version")
    key = "demonstration_id" if external else "attempt_id"
    given = tree_digest(members, key).first()[0]
    name = "external" if external else "software-draft"
    manifest = writers.publish(members, o.output_dir, name, rule, given)
    return [f"{o.output_dir}/{name}/dataset_manifest.json"], {"members": manifest["member_count"]}


@verb("dataset export-sft", "dataset", "config")
def dataset_export(spark, o):
    c = readers.load_config(o.config)
    if c["tokenizer_name"] != "bytes":
        from transformers import AutoTokenizer  # not in every environment

        tokenizer = AutoTokenizer.from_pretrained(c["tokenizer_name"], revision=c["tokenizer_revision"])
    else:
        tokenizer = sft.ByteTokenizer()
    done = builds.sft_export(_table(spark, o.dataset), f"{o.output_dir}/export", tokenizer, c["tokenizer_name"], c["tokenizer_revision"], c["template_version"])
    return [f"{o.output_dir}/export"], {"examples": done["example_count"]}


@verb("evaluate run", "suite", "model")
def evaluate_run(spark, o):
    """suite: counts of the development split; model: {"kind": "FIXTURE_EVALUATOR"} answers as expected, {"kind": "RECORDED", "results": path} reads results."""
    if o.split != "DEVELOPMENT":
        raise ValueError("the test split is locked")
    c, m = readers.load_config(o.suite), readers.load_config(o.model)
    tasks = generators.tool_suite(spark, "DEVELOPMENT", c["development_task_count"], c["source_template_group_count"])
    faults = [r[0] for r in generators.suite_faults(tasks, c["minimum_family_count"]).collect()]
    if faults:
        raise ValueError(", ".join(faults))
    if m.get("kind") == "FIXTURE_EVALUATOR":
        none = F.lit(None)
        results = tasks.select("task_id", F.lit(1).alias("attempt_number"), none.cast("string").alias("error"), F.col("expected_value").alias("value"), F.col("expected_unit").alias("unit"), F.col("document_ids").alias("evidence"), none.cast("boolean").alias("constraint_valid"), none.cast("string").alias("model_calls"), none.cast("string").alias("completion_tokens"), none.cast("double").alias("provider_cost_cny"))
    elif m.get("kind") == "RECORDED":
        results = _table(spark, m["results"], None if m["results"].endswith(".parquet") else RESULT)
    else:
        raise ValueError("the model is no supported evaluator")
    paths = writers.write_bundle(spark, f"{o.output_dir}/evaluation", {"records": evaluation.evaluation_records(tasks, results)})
    metrics = reports.evaluation_metrics(spark.read.parquet(paths["records"])).first().asDict()
    writers.put_json(spark, f"{o.output_dir}/evaluation_run.json", {"kind": "interactive-evaluation", "split": o.split, "suite_id": c["suite_id"], "model": m, "metrics": metrics})
    return [*paths.values(), f"{o.output_dir}/evaluation_run.json"], {"tasks": metrics["tasks"]}


@verb("feedback build", "evaluation", "pool", "external_evaluation", "external_config", "policy")
def feedback_build(spark, o):
    receipt, config = readers.load_config(o.external_evaluation), readers.load_config(o.external_config)
    if receipt.get("split") != "DEVELOPMENT" or receipt.get("terminal_status") != "COMPLETED":
        raise ValueError("feedback takes a completed evaluation of the development split")
    asked = [(c, i) for c, ids in (config.get("development_subset") or {}).items() for i in ids]
    seen = [(c, i) for c, r in (receipt.get("categories") or {}).items() for i in r.get("selected_ids", [])]
    pairs = lambda rows: spark.createDataFrame(rows, "category string, id string")
    if not asked or not joins.set_differences(pairs(asked), pairs(seen)).isEmpty():
        raise ValueError("the evaluation is not of the frozen subset")
    if readers.load_config(o.policy).get("policy_version") != "feedback-v1":
        raise ValueError("the policy must be feedback-v1")
    made = builds.feedback(_table(spark, o.evaluation), _table(spark, o.pool))
    writers.put_json(spark, f"{o.output_dir}/recipe_drafts.json", made)
    return [f"{o.output_dir}/recipe_drafts.json"], {"actions": len(made["actions"]), "pairs": len(made["pairs"])}


@verb("reward rescore", "evidence", "policy")
def reward_rescore(spark, o):
    known = reports.rescored(_table(spark, o.evidence), readers.load_config(o.policy))
    lacking = sorted(r[0] for r in reports.rescore_coverage(known).select("terminal_class").collect())
    if lacking or not known.filter("terminal_class is null").isEmpty():
        raise ValueError(f"too few records of {', '.join(lacking)}" if lacking else "a record has no terminal state")
    paths = writers.write_bundle(spark, f"{o.output_dir}/rescored", {"records": known, "counts": reports.rescore(known)})
    return list(paths.values()), {"records": spark.read.parquet(paths["records"]).count()}


@verb("experiment preregister")
def experiment_preregister(spark, o):
    raise ValueError("a plan's registration holds no table and is no part of this engine")


@verb("experiment freeze", "views", "membership")
def experiment_freeze(spark, o):
    """views: a table (recipe, demonstration_id); what keeps them from being frozen is written, and ends the command."""
    found = experiments.view_violations(_table(spark, o.views), _table(spark, o.membership))
    paths = writers.write_bundle(spark, f"{o.output_dir}/violations", {"violations": found})
    n = spark.read.parquet(paths["violations"]).count()
    if n:
        raise GateFailed(f"{n} violations in {paths['violations']}")
    return list(paths.values()), {"violations": 0}


@verb("experiment run")
def experiment_run(spark, o):
    raise ValueError("training is no part of this engine")


@verb("experiment calibrate", "config")
def experiment_calibrate(spark, o):
    """config: {"loss_tokens": n, "seconds": [...]} of two runs that were made elsewhere."""
    c = readers.load_config(o.config)
    if not c.get("seconds"):
        raise GateFailed("no run was feasible")
    writers.put_json(spark, f"{o.output_dir}/manifest.json", {"kind": "two-recipe-single-seed-calibration", **reports.throughput(c["loss_tokens"], c["seconds"])})
    return [f"{o.output_dir}/manifest.json"], {"recipe_runs": len(c["seconds"])}


@verb("compatibility check")
def compatibility_check(spark, o):
    raise ValueError("compatibility of models and hosts is no part of this engine")


@verb("environment check")
def environment_check(spark, o):
    raise ValueError("a host's preflight is no part of this engine")


@verb("trajectory replay")
def trajectory_replay(spark, o):
    raise ValueError("replay stays closed until a verified environment is given")


OPTIONS = sorted({n for _, needs in VERBS.values() for n in needs} | {"output_dir", "resume", "config", "backend", "profile", "test_unlock", "frozen", "runs", "claims"})


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="skein", description=__doc__)
    p.add_argument("--json", action="store_true")
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--split", choices=("DEVELOPMENT", "TEST"), default="DEVELOPMENT")
    for name in OPTIONS:
        p.add_argument(f"--{name.replace('_', '-')}")
    p.add_argument("command", nargs="*")
    return p


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    o = parser().parse_args(argv)
    name = " ".join(o.command)
    if not name:
        return OK
    envelope = {"command": name, "run_id": o.resume or str(uuid.uuid4()), "status": "COMPLETED", "evidence_level": "SOFTWARE_VALIDATED", "artifact_refs": [], "counts": {}, "warnings": [], "errors": []}
    code = OK
    try:
        if name not in VERBS:
            raise ValueError(f"unknown command; known are {', '.join(sorted(VERBS))}")
        if o.dry_run:
            envelope |= {"status": "VALIDATED", "evidence_level": "UNVERIFIED"}
        else:
            run, needs = VERBS[name]
            lacking = [n for n in (*needs, "output_dir") if getattr(o, n) is None]
            if lacking:
                raise ValueError("required: " + ", ".join(f"--{n.replace('_', '-')}" for n in lacking))
            if spark is None:
                from skein.session import get_session

                spark = SparkSession.getActiveSession() or get_session(app="skein-cli")
            envelope["artifact_refs"], envelope["counts"] = run(spark, o)
    except GateFailed as e:
        code = GATE_FAILED
        envelope |= {"status": "GATE_FAILED", "evidence_level": "UNVERIFIED", "warnings": [str(e)]}
    except ImportError as e:
        code = DEPENDENCY_ERROR
        envelope |= {"status": "DEPENDENCY_ERROR", "evidence_level": "UNVERIFIED", "errors": [str(e)]}
    except (ValueError, KeyError, OSError, RuntimeError, PySparkException) as e:
        code = INPUT_ERROR
        envelope |= {"status": "INPUT_ERROR", "evidence_level": "UNVERIFIED", "errors": [str(e)]}
    print(json.dumps(envelope, sort_keys=True) if o.json else f"{name}: {envelope['status']} ({envelope['run_id']})")
    for e in envelope["errors"]:
        print(e, file=sys.stderr)
    return code


if __name__ == "__main__":
    sys.exit(main())
