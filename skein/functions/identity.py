"""Canonical identity: canonical JSON, content hashes, short ids, hash splits and order-free digests of whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def canonical_json(*names: str) -> Column:
    """Compact JSON of columns with keys in order and nulls kept. Use strings, whole numbers, booleans and nests of them."""
    return F.to_json(F.struct(*(F.col(n) for n in sorted(names))), {"ignoreNullFields": "false"})


def sha256(c: Column) -> Column:
    return F.sha2(c.cast("string"), 256)


def short_id(prefix: str, *names: str) -> Column:
    """prefix-, then 16 hex digits of the canonical JSON's hash."""
    return F.concat(F.lit(f"{prefix}-"), F.substring(F.sha2(canonical_json(*names), 256), 1, 16))


def hash_scope(c: Column, scopes: tuple[str, ...] = ("TRAIN", "DEVELOPMENT", "TEST")) -> Column:
    """Scope by the SHA-256 of an id modulo 3: as 16 is 1 modulo 3, that is the sum of the hex digits modulo 3."""
    digits = F.split(F.sha2(c.cast("string"), 256), "")
    total = F.aggregate(digits, F.lit(0), lambda a, d: a + F.coalesce(F.conv(d, 16, 10).cast("int"), F.lit(0)))
    return F.element_at(F.array(*map(F.lit, scopes)), (total % 3 + 1).cast("int"))


def group_id(members: Column, policy: str = "split-v1") -> Column:
    """policy: and 16 hex digits of the hash of the sorted members, joined by bars."""
    return F.concat(F.lit(f"{policy}:"), F.substring(F.sha2(F.array_join(F.array_sort(members), "|"), 256), 1, 16))


def table_digest(df: DataFrame, key: str, *names: str) -> DataFrame:
    """One row, digest: the hash of the rows' canonical JSON in the order of the key as text, joined by newlines.

    It depends on neither files, partitions nor row order. All rows' JSON meet in one task: for tables of up to some
    million rows; use tree_digest for larger ones.
    """
    rows = F.array_sort(F.collect_list(F.struct(F.col(key).cast("string").alias("k"), canonical_json(*(names or df.columns)).alias("j"))))
    return df.agg(F.sha2(F.array_join(F.transform(rows, lambda r: r.j), "\n"), 256).alias("digest"))


#: Hex digits of a leaf and of a group: 16 ** 5 leaves, each group with at most 256 of them, the root with at most 4,096 groups.
LEAF, GROUP = 5, 3


def key_hash(key: str) -> Column:
    return F.sha2(F.col(f"`{key}`").cast("string"), 256)


def _chained(name: str, digest: str) -> Column:
    """The hash of a group's digests, each with its name, in the order of the names."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(name).alias("n"), F.col(digest).alias("d"))))
    return F.sha2(F.array_join(F.transform(pairs, lambda x: F.concat(x.n, F.lit("="), x.d)), "\n"), 256)


def group_digests(rows: DataFrame, key: str, *names: str) -> DataFrame:
    """(grp, digest, rows) of rows, by the first GROUP digits of their key's hash, over the leaves of its first LEAF digits.

    A leaf is some millionth of the table: its rows' hashes in order are hashed in one task.
    """
    hashed = rows.select(key_hash(key).alias("k"), F.sha2(canonical_json(*(names or rows.columns)), 256).alias("h"))
    leaves = hashed.groupBy(F.substring("k", 1, LEAF).alias("leaf")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), "\n"), 256).alias("d"), F.count("*").alias("n"))
    return leaves.groupBy(F.substring("leaf", 1, GROUP).alias("grp")).agg(_chained("leaf", "d").alias("digest"), F.sum("n").alias("rows"))


def root(groups: DataFrame) -> DataFrame:
    """One row, digest, of (grp, digest)."""
    return groups.agg(_chained("grp", "digest").alias("digest"))


def tree_digest(rows: DataFrame, key: str, *names: str) -> DataFrame:
    """One row, digest: the root of a tree of digests by hashes of the key; as order-free as table_digest, but another value. An empty table has one too."""
    return root(group_digests(rows, key, *names))


def group_digest(df: DataFrame, key: str, order: list[str], part: Column) -> DataFrame:
    """(key, digest): the hash of a group's parts in order, joined by newlines. For groups of bounded size, such as a conversation."""
    rows = F.array_sort(F.collect_list(F.struct(*order, part.alias("part"))))
    return df.groupBy(key).agg(F.sha2(F.array_join(F.transform(rows, lambda r: r.part), "\n"), 256).alias("digest"))
