"""Source audit: what is declared of each source, held against its bytes, columns and tool names, as one table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions.identity import canonical_json
from skein.operators.reports import FREE_TEXT, SENSITIVE, tool_names
from skein.sources.json_arrays import json_items
from skein.storage import materialize

DECLARED = "source_id string, source_uri string, revision string, license string, usage_scope string, source_kind string, required_tools array<string>, local_path string, expected_sha256 string, required_upstream_fields array<string>"
#: What every declaration states, the kind whose bytes are frozen, and below the names of states.
REQUIRED = ("source_id", "source_uri", "revision", "license", "usage_scope", "source_kind")
DOCUMENTATION = "public-documentation"
FACTS = "source_id string, content_sha256 string, record_count long, names array<string>, tools array<string>"
#: Rows whose tool names are looked at.
SAMPLE = 1000


def declaration_faults(declared: DataFrame) -> DataFrame:
    """(source_id, fault) of declarations that lack what every one states, name an empty field, or share an id."""
    lacking = F.array_join(F.filter(F.array(*(F.when(F.coalesce(F.length(c), F.lit(0)) == 0, c) for c in REQUIRED)), lambda x: x.isNotNull()), ",")
    fault = F.when(lacking != "", F.concat(F.lit("MISSING:"), lacking)).when(F.exists(F.coalesce("required_upstream_fields", F.array().cast("array<string>")), lambda x: F.coalesce(F.length(x), F.lit(0)) == 0), "EMPTY_FIELD_NAME")
    twice = declared.groupBy("source_id").count().filter("count > 1").select("source_id", F.lit("DUPLICATE_ID").alias("fault"))
    return declared.select("source_id", fault.alias("fault")).filter("fault is not null").union(twice)


def audited(declared: DataFrame, facts: DataFrame, frozen: DataFrame) -> DataFrame:
    """Declarations with their states: status, record_count, dependency, content hash, sensitive names, tools and required fields.

    facts(FACTS) are of sources with a local file, frozen(source_id, content_sha256) of documents kept by their hash. A source with
    neither is known by its metadata only; the network is not asked. A hash that is not the declared one is MISMATCH, a frozen
    document that is not there MISSING_SNAPSHOT: violations() has both.
    """
    rows = declared.join(facts.withColumn("local", F.lit(True)), "source_id", "left").join(frozen.select("source_id", F.col("content_sha256").alias("frozen_sha256")), "source_id", "left")
    document, local = F.col("source_kind") == DOCUMENTATION, F.coalesce("local", F.lit(False))
    digest = F.when(document, F.col("frozen_sha256")).otherwise(F.col("content_sha256"))
    hashed = F.when(document & F.col("frozen_sha256").isNull(), "MISSING_SNAPSHOT").when(~document & ~local, "NOT_APPLICABLE").when(F.col("expected_sha256").isNull(), "UNDECLARED").when(F.col("expected_sha256") == digest, "MATCHED").otherwise("MISMATCH")
    fields, names = F.array_sort(F.coalesce("required_upstream_fields", F.array().cast("array<string>"))), F.col("names")
    required = F.when(F.size(fields) == 0, "NOT_DECLARED").when(document | ~local, "UNAVAILABLE_NO_LOCAL_SHARD").when(F.size(F.array_except(fields, names)) == 0, "AVAILABLE").otherwise("MISSING")
    has = lambda known: F.arrays_overlap(names, F.array(*map(F.lit, known)))
    sensitive = F.when(document, "PUBLIC_DOCUMENTATION_SNAPSHOT_NO_TRAJECTORY_FIELDS").when(~local, "UNAVAILABLE_NO_RECORD_SAMPLE").when(has(SENSITIVE), "SENSITIVE_FIELD_NAMES_PRESENT").when(has(FREE_TEXT), "POTENTIAL_FREE_TEXT_REVIEW_REQUIRED").otherwise("NO_DECLARED_SENSITIVE_FIELD_NAMES")
    return rows.select(
        *REQUIRED,
        F.coalesce("required_tools", F.array().cast("array<string>")).alias("required_tools"),
        F.when(document, "AUDITED_FROZEN_DOCUMENT").when(local, "AUDITED_LOCAL").otherwise("METADATA_ONLY").alias("status"),
        F.when(~document, F.col("record_count")).alias("record_count"),
        F.when(document, "AVAILABLE").otherwise("NOT_REQUIRED").alias("dependency_status"),
        F.when(document | local, digest).alias("content_sha256"),
        hashed.alias("content_hash_status"),
        sensitive.alias("sensitive_check_status"),
        F.when(~document & local, F.array_sort("tools")).alias("actual_tool_scope"),
        fields.alias("required_upstream_fields"),
        required.alias("required_field_status"),
        F.when(~document & ~local, F.array(F.lit("remote access was not requested"))).otherwise(F.array().cast("array<string>")).alias("warnings"),
    )


def violations(report: DataFrame) -> DataFrame:
    """(source_id, content_hash_status) of sources whose bytes are not what is declared."""
    return report.filter(F.col("content_hash_status").isin("MISMATCH", "MISSING_SNAPSHOT")).select("source_id", "content_hash_status")


def local_facts(spark: SparkSession, declared: DataFrame) -> DataFrame:
    """FACTS of the declared sources with a local_path: a Parquet table, or a JSON array of records. A file that isn't there is an error.

    A source's plan is its own; the work of each is distributed, however large the file. Declarations are a manifest's, so few.
    """
    parts = []
    for r in declared.filter(F.col("local_path").isNotNull() & (F.col("source_kind") != DOCUMENTATION)).select("source_id", "local_path").collect():
        own = F.array_sort(F.collect_list(F.sha2("content", 256)))  # one file, or a folder's
        digest = spark.read.format("binaryFile").load(r.local_path).agg(F.when(F.size(own) == 1, F.get(own, F.lit(0))).otherwise(F.sha2(F.array_join(own, "\n"), 256)).alias("content_sha256"))
        if r.local_path.rstrip("/").endswith(".parquet"):
            table = spark.read.parquet(r.local_path)
            one = table.agg(F.count("*").alias("record_count")).withColumn("names", F.array(*map(F.lit, table.columns)).cast("array<string>"))
            named = tool_names("target_tools", table, SAMPLE) if "target_tools" in table.columns else None
        else:
            items = materialize(json_items(spark, r.local_path).select("item", F.try_parse_json("item").alias("v")), "audit-items")
            keys = items.select(F.explode(F.json_object_keys("item")).alias("k")).agg(F.collect_set("k").alias("names"))  # a schema's keys
            one = items.agg(F.count("*").alias("record_count")).join(F.broadcast(keys))
            path = "$.messages"
            messages = items.select(F.explode(F.try_variant_get("v", path, "array<variant>")).alias("m"))
            calls = messages.select(F.explode(F.try_variant_get("m", "$.tool_calls", "array<variant>")).alias("c"))
            name = F.try_variant_get("c", "$.name", "variant")
            named = calls.filter(F.schema_of_variant(name) == "STRING").select(F.try_variant_get("c", "$.name", "string").alias("name")).distinct()
        tools = (named if named is not None else spark.createDataFrame([], "name string")).agg(F.array_sort(F.collect_list("name")).alias("tools"))
        parts.append(one.join(F.broadcast(digest)).join(F.broadcast(tools)).select(F.lit(r.source_id).alias("source_id"), "content_sha256", "record_count", "names", "tools"))  # one row each
    return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], FACTS)


def report(spark: SparkSession, declared: DataFrame, frozen: DataFrame | None = None) -> DataFrame:
    """The audit of a manifest's declarations; faulty ones, missing files and bytes that are not as declared are errors."""
    bad = declaration_faults(declared).limit(1).collect()
    if bad:
        raise ValueError(f"source {bad[0].source_id}: {bad[0].fault}")
    none = spark.createDataFrame([], "source_id string, content_sha256 string")
    rows = materialize(audited(declared, local_facts(spark, declared), none if frozen is None else frozen), "audit")
    bad = violations(rows).limit(1).collect()
    if bad:
        raise ValueError(f"source {bad[0].source_id}: {bad[0].content_hash_status}")
    return rows


def manifest_hash(declared: DataFrame) -> str:
    """The hash of all declarations in the order of their ids."""
    rows = F.array_sort(F.collect_list(F.struct("source_id", canonical_json(*declared.columns).alias("j"))))
    return declared.agg(F.sha2(F.array_join(F.transform(rows, lambda r: r.j), "\n"), 256)).first()[0]
