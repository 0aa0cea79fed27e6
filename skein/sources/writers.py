"""Sinks: releases, bundles, evidence and an append-only ledger; commits are in merkle.py."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions.identity import canonical_json, tree_digest
from skein.operators.decisions import publication_violations
from skein.operators.joins import duplicated, set_differences
from skein.operators.reports import diversity, quality_report
from skein.sources.json_arrays import write_json_arrays

_REF = "struct<uri: string, sha256: string, byte_size: bigint, media_type: string>"
#: The record kinds that are exported as schemas.
RECORDS = {
    "source_records": f"source_record_id string, source_id string, revision string, usage_scope string, raw_ref {_REF}",
    "external_demonstrations": f"demonstration_id string, source_record_id string, source_origin string, message_refs array<{_REF}>, parent_demonstration_id string, repair_rule_ref string",
    "eligibility_decisions": f"decision_id string, demonstration_id string, action string, reason_codes array<string>, evidence_refs array<{_REF}>, review_checks array<string>, replay_capability string",
    "attempts": "attempt_id string, task_id string, actor_kind string, end_reason string, state string",
    "events": "event_id string, attempt_id string, seq bigint, event_type string, model_call_id string, tool_call_id string, status string",
    "contexts": f"context_id string, model_call_id string, ordered_message_refs array<{_REF}>, content_hash string",
    "verifications": "verification_id string, attempt_id string, status string, outcome string",
    "rewards": "reward_record_id string, attempt_id string, verification_id string, availability string, total_reward double",
}


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The folders in a folder, but for those whose name begins with a dot."""
    fs, p = _fs(spark, path)
    found = [f.getPath() for f in fs.listStatus(p) if f.isDirectory()] if fs.exists(p) else []
    return sorted(str(f.toString()) for f in found if not f.getName().startswith("."))


def rename(spark: SparkSession, a: str, b: str) -> None:
    fs, p = _fs(spark, a)
    fs.mkdirs(_fs(spark, b)[1].getParent())
    if not fs.rename(p, _fs(spark, b)[1]):
        raise OSError(f"{a} can't become {b}")


def put_json(spark: SparkSession, path: str, value: dict) -> None:
    """Small JSON receipts, by one rename."""
    tmp = f"{path}.tmp"
    fs, p = _fs(spark, tmp)
    out = fs.create(p, True)
    out.write(bytearray(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()))
    out.close()
    fs.delete(_fs(spark, path)[1], False)
    rename(spark, tmp, path)


def get_json(spark: SparkSession, path: str) -> dict:
    return json.loads("".join(r[0] for r in spark.read.text(path).collect()))


def put_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


CARDS = {
    "EXTERNAL_DEMONSTRATION": "# External demonstrations\n\nAdmitted by eligibility decisions; replay, results and rewards are evidence of their own.\n",
    "EXECUTION_ATTEMPT": "# Software test\n\nSoftware-validated; not for training.\n",
}


def publish(members: DataFrame, output: str, dataset_id: str, rule_version: str, input_manifest_hash: str = "") -> dict:
    """An immutable release output/dataset_id: membership, manifest, recipe, quality, diversity and cost reports, lineage, data card.

    Members that break their kind's gate, none at all, or a key that occurs twice are an error. The digest covers whole
    rows: the same members again give the same release, others at the same place are an error. All is written aside and
    renamed at the end, so that a crash leaves nothing that looks like a release.
    """
    spark = members.sparkSession
    bad = publication_violations(members).select("violation").distinct().limit(5).collect()
    if bad:
        raise ValueError(f"not publishable: {sorted(r[0] for r in bad)}")
    count = members.count()
    if not count:
        raise ValueError("a release has one member at least")
    external = "demonstration_id" in members.columns
    key = "demonstration_id" if external else "attempt_id"
    if not duplicated(members, [key]).isEmpty():
        raise ValueError(f"{key} is not unique")
    manifest = {
        "dataset_id": dataset_id,
        "status": "PUBLISHED",
        "evidence_level": "SOFTWARE_VALIDATED",
        "input_manifest_hash": input_manifest_hash,
        "rule_version": rule_version,
        "logical_content_hash": tree_digest(members, key).first()[0],
        "member_count": count,
        "member_kind": "EXTERNAL_DEMONSTRATION" if external else "EXECUTION_ATTEMPT",
    }
    final = f"{output}/{dataset_id}"
    if exists(spark, final):
        if not exists(spark, f"{final}/dataset_manifest.json") or get_json(spark, f"{final}/dataset_manifest.json") != manifest:
            raise ValueError("the release exists with other content")
        return manifest
    staging = f"{output}/.{dataset_id}-{uuid.uuid4().hex}-staging"
    try:
        members.write.parquet(f"{staging}/membership.parquet")
        written = spark.read.parquet(f"{staging}/membership.parquet")
        for name, table in lineage_index(written).items():
            table.write.parquet(f"{staging}/lineage/{name}.parquet")
        put_json(spark, f"{staging}/recipe.json", {"rule_version": rule_version})
        put_json(spark, f"{staging}/quality_report.json", quality_report(written))
        put_json(spark, f"{staging}/diversity_report.json", diversity(written).first().asDict())
        put_json(spark, f"{staging}/cost_report.json", {"cost_cny_fen": None})
        put_text(spark, f"{staging}/data_card.md", CARDS[manifest["member_kind"]])
        put_json(spark, f"{staging}/dataset_manifest.json", manifest)
        rename(spark, staging, final)
    except Exception:
        remove(spark, staging)
        raise
    return manifest


def lineage_index(members: DataFrame) -> dict[str, DataFrame]:
    """source_records, and members with what they derive from: demonstrations, or attempts and their decisions."""
    sources = members.select(F.explode("source_record_ids").alias("source_record_id")).distinct()
    if "demonstration_id" in members.columns:
        parent = F.col("parent_demonstration_id") if "parent_demonstration_id" in members.columns else F.lit(None).cast("string")
        own = members.select("demonstration_id", "eligibility_decision_id", parent.alias("parent_demonstration_id"), "source_record_id", "upstream_message_refs")
        return {"source_records": sources, "external_demonstrations": own}
    attempts = members.select("attempt_id", "task_id", "quality_decision_id", F.array_sort("source_record_ids").alias("source_record_ids"))
    return {"source_records": sources, "attempts": attempts, "quality_decisions": members.select("quality_decision_id", "attempt_id")}


def write_bundle(spark: SparkSession, path: str, tables: dict[str, DataFrame], receipts: dict[str, dict] | None = None, envelopes: tuple[str, ...] = ()) -> dict[str, str]:
    """Tables as Parquet (those in envelopes as folders of JSON as well) and receipts as JSON in a new folder, renamed into place at the end; returns their paths.

    A folder that is there already is left alone if a retry would write the same rows and receipts, and an error otherwise.
    """
    paths = {n: f"{path}/{n}.parquet" for n in tables} | {n: f"{path}/{n}.json" for n in receipts or {}}
    if exists(spark, path):
        for name, df in tables.items():
            old = spark.read.schema(df.schema).parquet(paths[name]) if exists(spark, paths[name]) else None
            if old is None or spark.read.parquet(paths[name]).columns != df.columns or not set_differences(old.select(_row(old)), df.select(_row(df))).isEmpty():
                raise ValueError(f"{path} exists with another {name}")
        for name, value in (receipts or {}).items():
            if not exists(spark, paths[name]) or get_json(spark, paths[name]) != json.loads(json.dumps(value)):
                raise ValueError(f"{path} exists with another {name}")
        return paths
    staging = f"{path}-{uuid.uuid4().hex}-staging"
    for name, df in tables.items():
        df.write.parquet(f"{staging}/{name}.parquet")
        if name in envelopes:
            write_json_arrays(df, f"{staging}/{name}.envelope.json", name)
    for name, value in (receipts or {}).items():
        put_json(spark, f"{staging}/{name}.json", value)
    rename(spark, staging, path)
    return paths


def _row(df: DataFrame) -> Column:
    """A row's hash, in which nests of any kind can be compared."""
    return F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), 256).alias("row")


def dedup_evidence(candidates: DataFrame, representatives: DataFrame, path: str) -> dict:
    """Candidate pairs and representatives in order, with their counts."""
    counts = {"candidate_pairs": candidates.count(), "representatives": representatives.select("representative").distinct().count(), "members": representatives.count()}
    write_bundle(candidates.sparkSession, path, {"candidates": candidates.orderBy(*candidates.columns), "representatives": representatives.orderBy(*representatives.columns)}, {"manifest": counts})
    return counts


def quality_ledger(decisions: DataFrame, path: str) -> None:
    """Decisions as a table and as lines of canonical JSON."""
    decisions.write.parquet(f"{path}/quality_decisions.parquet")
    decisions.select(canonical_json(*decisions.columns)).write.text(f"{path}/quality_decisions.json")


def asset_ref(name: str, *columns: str) -> Column:
    """A content-addressed reference to the canonical JSON of columns: uri, hash, size and media type."""
    body = canonical_json(*columns)
    digest = F.sha2(body, 256)
    uri = F.concat(F.lit(f"task-assets/{name}-"), F.substring(digest, 1, 16), F.lit(".json"))
    return F.struct(uri.alias("uri"), digest.alias("sha256"), F.octet_length(body).cast("long").alias("byte_size"), F.lit("application/json").alias("media_type"))


def revocation_entry(source_record_id: str, closure: DataFrame, path: str) -> str:
    """A ledger entry of what a source's revocation reaches: closure(kind, id). Entries are never rewritten: each has its own name."""
    spark = closure.sparkSession
    uri = f"{path}/{source_record_id}-{uuid.uuid4().hex[:12]}"
    closure.withColumns({"source_record_id": F.lit(source_record_id), "created_at": F.current_timestamp()}).write.parquet(f"{uri}-staging")
    rename(spark, f"{uri}-staging", uri)
    return uri


def export_schemas(spark: SparkSession, root: str, version: str = "v2") -> list[str]:
    """The record kinds' schemas as JSON, one file each."""
    out = []
    for name, ddl in RECORDS.items():
        path = f"{root}/{version}/{name}.json"
        put_json(spark, path, {"name": name, "schema": json.loads(spark.createDataFrame([], ddl).schema.json())})
        out.append(path)
    return out


def append_ledger(rows: DataFrame, path: str) -> None:
    rows.withColumn("recorded_at", F.current_timestamp()).write.mode("append").parquet(path)
