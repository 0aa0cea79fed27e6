"""Sources: JSON lists and envelopes, Parquet histories, JUnit reports, file manifests."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.sources.json_arrays import BLOCK, json_items
from skein.storage import make_dir, open_fs


def envelope(spark: SparkSession, path: str, field: str, schema: str, block: int = BLOCK) -> DataFrame:
    """Rows of {field: [rows]} with `offset`, where each stands; items that are no objects are left out. A file is read by many tasks, a folder with all below it."""
    items = json_items(spark, path, field, block).filter("item like '{%'")
    return items.select("path", "offset", F.from_json("item", schema).alias("r")).select("path", "offset", "r.*")


def histories(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A JSON array of records or a Parquet file, by suffix."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    if not path.endswith((".json", ".jsonl")):
        raise ValueError(f"{path} is neither JSON nor Parquet")
    reader = spark.read.option("multiLine", path.endswith(".json"))
    return (reader.schema(schema) if schema else reader).json(path)


def json_tree(spark: SparkSession, root: str) -> DataFrame:
    """All JSON files below a folder, with their path."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").option("multiLine", True).json(root).withColumn("path", F.col("_metadata.file_path"))


def junit_counts(spark: SparkSession, path: str) -> DataFrame:
    """One row: tests, failures, errors and skipped over all suites."""
    schema = ", ".join(f"_{c} int" for c in ("tests", "failures", "errors", "skipped"))
    suites = spark.read.format("xml").option("rowTag", "testsuite").schema(schema).load(path)
    return suites.agg(*(F.coalesce(F.sum(f"_{c}"), F.lit(0)).alias(c) for c in ("tests", "failures", "errors", "skipped")))


def file_manifest(spark: SparkSession, root: str) -> DataFrame:
    """(path, sha256, byte_size) of every file below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("byte_size"))


def changed_files(spark: SparkSession, root: str, manifest: DataFrame) -> DataFrame:
    """Files of a manifest that are missing or differ, and files that it does not list."""
    now = file_manifest(spark, root)
    return manifest.join(now, ["path", "sha256", "byte_size"], "left_anti").select("path").union(now.join(manifest, ["path", "sha256", "byte_size"], "left_anti").select("path")).distinct()


def load_config(path: str) -> dict:
    """A small JSON or YAML mapping, by suffix; YAML asks for its library."""
    with open(path, encoding="utf-8") as f:
        if path.endswith((".yaml", ".yml")):
            import yaml

            value = yaml.safe_load(f)
        else:
            value = json.load(f)
    if not isinstance(value, dict):
        raise ValueError(f"{path} holds no mapping")
    return value


def safe_relative(root: str, path: object) -> str:
    """A path below root; absolute ones, steps upwards and what isn't text are an error."""
    if not isinstance(path, str) or not path or path.startswith("/") or "://" in path or ".." in path.split("/"):
        raise ValueError(f"not a path below the manifest: {path}")
    return f"{root.rstrip('/')}/{path}"


EXECUTION_INPUTS = ("task_manifests", "attempt_manifests", "verification_manifests")
EXTERNAL_INPUTS = ("external_demonstration_manifests", "external_material_manifests", "eligibility_manifests")


def build_input(spark: SparkSession, path: str) -> dict:
    """A build's manifest: kind, lists of files by stream, split registry, rule version and the hash of every file.

    External if it names demonstrations or eligibility, else execution; the other kind's streams are not read. A missing
    list, a path that leaves the folder, a file that isn't there and a missing rule version are errors.
    """
    raw, root = load_config(path), path.rsplit("/", 1)[0] if "/" in path else "."
    kind = "EXTERNAL_DEMONSTRATION" if {"external_demonstration_manifests", "eligibility_manifests"} & raw.keys() else "EXECUTION_ATTEMPT"
    files: dict[str, list[str]] = {}
    for name in ("source_manifests", *(EXTERNAL_INPUTS if kind == "EXTERNAL_DEMONSTRATION" else EXECUTION_INPUTS)):
        if not isinstance(raw.get(name), list) or not raw[name]:
            raise ValueError(f"{name} must be a list of paths")
        files[name] = [safe_relative(root, p) for p in raw[name]]
    files["split_registry"] = [safe_relative(root, raw.get("split_registry_ref"))]
    if not isinstance(raw.get("rule_version"), str) or not raw["rule_version"]:
        raise ValueError("rule_version is required")
    every = sorted({p for ps in files.values() for p in ps})
    listed = F.array(*(F.struct(F.lit(p).alias("p"), F.lit(p.removeprefix("./")).alias("end")) for p in every))
    at = F.filter(listed, lambda x: F.col("path").endswith(x.end) | F.col("path").contains(F.concat(x.end, F.lit("/"))))
    files_of = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(every).select(F.explode(at).alias("x"), F.sha2("content", 256).alias("h"))
    one = F.array_sort(F.collect_list("h"))  # a file's own hash, or that of a folder's files
    found = files_of.groupBy("x.p").agg(F.when(F.size(one) == 1, F.get(one, F.lit(0))).otherwise(F.sha2(F.array_join(one, "\n"), 256)).alias("sha256")).collect()  # a row a file of the manifest
    hashes = {r["p"]: r["sha256"] for r in found}
    if len(hashes) != len(every):
        raise ValueError("a file of the manifest is missing")
    return {"kind": kind, "files": files, "rule_version": raw["rule_version"], "hashes": {p.removeprefix(f"{root}/"): h for p, h in hashes.items()}}


def streams(spark: SparkSession, paths: list[str], field: str, schema: str) -> DataFrame:
    """Rows of many envelopes, with their place in the order of files and rows."""
    parts = []
    for n, p in enumerate(paths):
        rows = envelope(spark, p, field, schema)
        file = F.pmod(F.xxhash64("path"), F.lit(1 << 12))  # of a folder's files, whose order says nothing
        parts.append(rows.withColumn("position", F.lit(n).cast("long") * (1 << 52) + file * (1 << 40) + F.col("offset")).drop("path", "offset"))
    return reduce(DataFrame.unionByName, parts)


def snapshot_faults(sources: DataFrame, snapshots: DataFrame, files: DataFrame) -> DataFrame:
    """(source_id, fault) of declared sources(source_id, expected_sha256) whose frozen bytes are not as stated.

    Each needs exactly one snapshot(source_id, path, content_sha256) with a path that stays below its folder, a file(path,
    sha256) of that hash, and the declared hash, if there is one.
    """
    per = snapshots.groupBy("source_id").agg(F.count(F.lit(1)).alias("n"), F.first("path").alias("path"), F.first("content_sha256").alias("want"))
    rows = sources.join(per, "source_id", "left").join(files.select("path", "sha256"), "path", "left")
    fault = (
        F.when(F.coalesce("n", F.lit(0)) != 1, "NO_UNIQUE_RECORD")
        .when(F.col("path").isNull() | F.col("want").isNull(), "INCOMPLETE")
        .when(F.col("path").startswith("/") | F.col("path").rlike(r"(^|/)\.\.(/|$)"), "UNSAFE_PATH")
        .when(F.col("sha256").isNull(), "MISSING_CONTENT")
        .when(F.col("sha256") != F.col("want"), "DIGEST_MISMATCH")
        .when(F.col("expected_sha256") != F.col("want"), "DECLARED_DIGEST_MISMATCH")
    )
    return rows.select("source_id", fault.alias("fault")).filter("fault is not null")


def freeze_files(spark: SparkSession, root: str, destination: str) -> DataFrame:
    """Copies of a folder's files under the names of their hashes; (path, sha256, byte_size, frozen). For files fetched before."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    named = files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("byte_size"), "content")
    target = destination.rstrip("/")

    def put(batches):
        for b in batches:
            for digest, content in zip(b["sha256"], b["content"], strict=True):
                fs, at = open_fs(f"{target}/{digest}")
                with fs.open_output_stream(at) as out:
                    out.write(bytes(content))
            yield b[["path", "sha256", "byte_size"]]

    make_dir(spark, target)
    return named.mapInPandas(put, "path string, sha256 string, byte_size bigint").withColumn("frozen", F.concat(F.lit(f"{target}/"), "sha256"))
