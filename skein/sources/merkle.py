"""Incremental commits: rows in buckets of their key's hash, a digest a group of keys, and a tree of digests whose root is the build's.

The tree is that of identity.tree_digest: leaves by the first hex digits of a key's SHA-256, groups of leaves, and the root. So the root says what the rows are, whatever
the order of commits and however many buckets there are. A commit reads and writes the buckets that its rows fall into and no others.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions.identity import GROUP, group_digests, key_hash, root
from skein.operators.joins import duplicated, merge_conflicts
from skein.sources.writers import exists, get_json, put_json, remove, rename
from skein.storage import materialize, shuffle_partitions

#: Rows of a bucket before the table gets sixteen times as many.
BUCKET_ROWS = 1_000_000
#: Rows that a task writes: into several buckets, where these are smaller, as each task reports to the driver.
TASK_ROWS = 250_000
MANIFEST = "bucket string, folder string, grp string, digest string, rows long"


def _bucket(hashed: Column, digits: int) -> Column:
    return F.concat(F.lit("b"), F.substring(hashed, 1, digits))


def _manifest(spark: SparkSession, destination: str, state: dict) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{destination}/manifests/{state['digest']}")


def read_build(spark: SparkSession, destination: str, touched: DataFrame | None = None) -> DataFrame:
    """Rows of the last commit; of the buckets of touched(bucket) alone, if that is given."""
    state = get_json(spark, f"{destination}/registry.json")
    live = _manifest(spark, destination, state).select("folder", "bucket").distinct()
    if touched is not None:
        live = live.join(touched, "bucket", "left_semi")
    schema = f"{state['schema']}, folder string, bucket string"
    rows = spark.read.schema(schema).option("basePath", f"{destination}/data").parquet(f"{destination}/data")
    return rows.join(F.broadcast(live), ["folder", "bucket"], "left_semi").drop("folder", "bucket")  # at most a row a bucket: 16 ** GROUP


def commit(rows: DataFrame, destination: str, key: str, identity: dict | None = None, bucket_rows: int = BUCKET_ROWS, fail_at: str | None = None) -> dict:
    """Add rows to the build at destination; returns its digest, rows, how many buckets were written, and status.

    Rows of a known key must be as they are there; others, a key that occurs twice, and another identity are errors that
    change nothing. Only buckets that get new rows are written, beside those that they replace, so readers of the last commit
    are not disturbed. The registry is renamed into place last: what fails before leaves files that nothing names
    (precommit), or a manifest that the retry finds (postcommit). fail_at injects either.
    """
    spark, names = rows.sparkSession, rows.columns
    registry = f"{destination}/registry.json"
    known = get_json(spark, registry) if exists(spark, registry) else None
    if known and known["identity"] != (identity or {}):
        raise ValueError("another rule version or build identity")
    if not duplicated(rows, [key]).isEmpty():
        raise ValueError(f"{key} is not unique")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    if known and known["schema"] != schema:
        raise ValueError("the columns are not those of the build")
    new = materialize(rows, "merkle-new")
    digits, total = (known["digits"], known["rows"]) if known else (0, 0)
    wanted = digits
    while wanted < GROUP and (total + new.count()) / 16**wanted > bucket_rows:
        wanted += 1
    bucket = _bucket(key_hash(key), wanted)
    if known:
        touched = new.select(_bucket(key_hash(key), digits).alias("bucket")).distinct()
        old = materialize(read_build(spark, destination, None if wanted > digits else touched), "merkle-old")
        merged = old.hint("merge")  # no side of these joins is sent to all tasks, by way of the driver
        if not merge_conflicts(merged, new, key).isEmpty():
            raise ValueError("rows of a committed build have changed")
        added = new.join(merged, key, "left_anti").select(*names)
        own = F.broadcast(added.select(bucket.alias("bucket")).distinct())  # at most 16 ** GROUP
        both = old.select(*names).unionByName(added)  # no key is in both
        changed = both if wanted > digits else both.withColumn("bucket", bucket).join(own, "bucket", "left_semi").select(*names)
    else:
        changed = new
    folder = uuid.uuid4().hex
    changed = changed.withColumn("bucket", bucket)
    grouped = materialize(group_digests(changed, key, *names), "merkle-groups").withColumns({"bucket": _bucket(F.col("grp"), wanted), "folder": F.lit(folder)})
    manifest = grouped.select("bucket", "folder", "grp", "digest", "rows")
    if known and wanted == digits:
        kept = _manifest(spark, destination, known)
        manifest = manifest.unionByName(kept.join(grouped.select("bucket").distinct(), "bucket", "left_anti"))
    manifest = materialize(manifest, "merkle-manifest")
    digest = root(manifest).first()[0]
    written, rows_written = grouped.agg(F.count_distinct("bucket"), F.coalesce(F.sum("rows"), F.lit(0))).first()
    place = f"{destination}/manifests/{digest}"
    recovered = exists(spark, place)
    if not recovered:
        staging = f"{destination}/staging-{folder}"
        parts = max(1, min(written, max(shuffle_partitions(spark), rows_written // TASK_ROWS)))
        changed.repartition(parts, "bucket").write.partitionBy("bucket").parquet(f"{staging}/rows")
        manifest.coalesce(1).write.parquet(f"{staging}/manifest")  # at most 16 ** GROUP short rows
        if fail_at == "precommit":
            remove(spark, staging)
            raise RuntimeError("precommit")
        if written:
            rename(spark, f"{staging}/rows", f"{destination}/data/folder={folder}")
        rename(spark, f"{staging}/manifest", place)
        remove(spark, staging)
    if fail_at == "postcommit":
        raise RuntimeError("postcommit")
    count = manifest.agg(F.sum("rows")).first()[0] or 0
    same = known is not None and known["digest"] == digest
    put_json(spark, registry, {"digest": digest, "identity": identity or {}, "key": key, "rows": count, "digits": wanted, "schema": schema})
    return {"digest": digest, "rows": count, "buckets_written": 0 if recovered else written, "buckets": 16**wanted, "status": "UNCHANGED" if same else "POSTCOMMIT_RECOVERED" if recovered else "NEW_COMMIT"}
