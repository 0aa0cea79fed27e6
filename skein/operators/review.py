"""The review of a duplicate search: a packet of candidates and probes, bound to its hash, and the receipt of what reviewers say.

Probes are pairs that the search did not find, drawn evenly from all pairs without ever listing them: a pair's number is drawn,
and the pair is read off the number by arithmetic on ranks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.functions.identity import canonical_json
from skein.functions.numeric import draw_number
from skein.storage import materialize

#: Fixed values of a packet and its receipt.
CANDIDATE, PROBE = "CANDIDATE", "MISS_PROBE"
BASIS = "TASK_METADATA_AND_PRIVATE_EXPECTED_RESULT"
OUTCOMES = ("DUPLICATE", "DISTINCT")
NOT_REQUIRED, REQUIRED = "NOT_REQUIRED_NO_OBSERVED_MISS", "REQUIRED_AFTER_OBSERVED_MISS"
PAIR = ["review_kind", "left_task_id", "right_task_id"]


def ranked(ids: DataFrame) -> DataFrame:
    """(id, rank) of ids(id), each once, from 0 in order: ranges are sorted apart, and each is shifted by what is before it."""
    sorted_ids = materialize(ids.select("id").distinct().repartitionByRange("id").select("id", F.spark_partition_id().alias("part")), "review-ranks")
    inside = sorted_ids.withColumn("n", F.row_number().over(Window.partitionBy("part").orderBy("id")))
    sizes = sorted_ids.groupBy("part").agg(F.min("id").alias("first"), F.count("*").alias("size"))  # a row a partition
    shift = sizes.withColumn("before", F.coalesce(F.sum("size").over(Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return inside.join(F.broadcast(shift.select("part", "before")), "part").select("id", (F.col("before") + F.col("n") - 1).alias("rank"))


def unrank(number: Column) -> tuple[Column, Column]:
    """Ranks left < right of the pair with a number from 0 on, pairs being counted by right, then left.

    The root is taken in floating point and set right by whole numbers, so that it holds for up to some 2 ** 31 ids.
    """
    right = F.floor((F.lit(1.0) + F.sqrt(F.lit(1.0) + number.cast("double") * 8)) / 2).cast("long")
    whole = lambda r: F.shiftright(r * (r - 1), 1)
    right = F.when(whole(right) > number, right - 1).when(whole(right + 1) <= number, right + 1).otherwise(right)
    return number - whole(right), right


def probes(ids: DataFrame, candidates: DataFrame, size: int, seed: int = 7) -> DataFrame:
    """(left, right, draw) of `size` pairs of ids(id) that are no candidates(left, right), each once, in the order of their draws.

    Draw d takes pair draw_number(seed, pairs, d); candidates and pairs drawn before are rejected. Draws double
    until enough are left. Fewer pairs than asked are an error.
    """
    spark = ids.sparkSession
    ranks = materialize(ranked(ids), "review-ids")
    n = ranks.count()
    pairs = n * (n - 1) // 2
    known = materialize(candidates.select(F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right")).distinct(), "review-known")
    free = pairs - known.count()
    if free < size:
        raise ValueError(f"{free} pairs are no candidates; {size} are asked for")
    draws = 2 * size
    while True:
        drawn = spark.range(draws).select(F.col("id").alias("draw"), draw_number(seed, F.lit(pairs), F.col("id")).alias("number"))
        first = drawn.groupBy("number").agg(F.min("draw").alias("draw"))
        low, high = unrank(F.col("number"))
        placed = first.select("draw", low.alias("low"), high.alias("high"))
        named = placed.join(ranks.select(F.col("rank").alias("low"), F.col("id").alias("left")), "low").join(ranks.select(F.col("rank").alias("high"), F.col("id").alias("right")), "high")
        good = materialize(named.select("left", "right", "draw").join(known, ["left", "right"], "left_anti"), "review-probes")
        if good.count() >= size:
            return good.orderBy("draw").limit(size)
        draws *= 2


def packet(tasks: DataFrame, candidates: DataFrame, size: int = 100, seed: int = 7) -> DataFrame:
    """The queue: the first `size` candidates(left, right) in order, then as many probes, with what a reviewer may see of both tasks.

    tasks(task_id, task_family, input_value, value): an id that is there twice, a null in any of them, and a pool of candidates
    or other pairs below `size` are errors. Columns: position, review_kind, left_task_id, right_task_id, family, input and
    expected value of both sides, review_basis.
    """
    tasks = materialize(tasks.select(F.col("task_id").alias("id"), F.col("task_family").alias("family"), "input_value", F.col("value").alias("expected_value")), "review-tasks")
    broken = tasks.filter(" or ".join(f"{c} is null" for c in tasks.columns)).limit(1).collect()
    if broken:
        raise ValueError(f"no fixed input or expected result for {broken[0].id}")
    if not tasks.groupBy("id").count().filter("count > 1").isEmpty():
        raise ValueError("task_id is not unique")
    found = candidates.select(F.least("left", "right").alias("left"), F.greatest("left", "right").alias("right")).distinct()
    first = materialize(found.orderBy("left", "right").limit(size), "review-first")
    if first.count() < size:
        raise ValueError(f"{first.count()} candidates; {size} are asked for")
    numbered = first.select(F.lit(CANDIDATE).alias("review_kind"), "left", "right", F.row_number().over(Window.orderBy("left", "right")).alias("position"))  # `size` rows
    drawn = probes(tasks.select("id"), found, size, seed)
    numbered = numbered.union(drawn.select(F.lit(PROBE), "left", "right", F.row_number().over(Window.orderBy("draw")) + size))
    for side in ("left", "right"):
        own = tasks.select(F.col("id").alias(side), *(F.col(c).alias(f"{side}_{to}") for c, to in (("family", "task_family"), ("input_value", "input_value"), ("expected_value", "expected_value"))))
        numbered = F.broadcast(numbered).join(own, side)  # the packet's rows
    names = [f"{side}_{c}" for c in ("task_family", "input_value", "expected_value") for side in ("left", "right")]
    return materialize(numbered.select("position", "review_kind", F.col("left").alias("left_task_id"), F.col("right").alias("right_task_id"), *names, F.lit(BASIS).alias("review_basis")), "review-packet")


def queue_hash(queue: DataFrame) -> DataFrame:
    """One row, queue_sha256: the hash of a packet's rows in order. A packet has twice its size of rows."""
    rows = F.array_sort(F.collect_list(F.struct("position", canonical_json(*(c for c in queue.columns if c != "position")).alias("j"))))
    return queue.agg(F.sha2(F.array_join(F.transform(rows, lambda r: r.j), "\n"), 256).alias("queue_sha256"))


def reviewed(queue: DataFrame, decisions: DataFrame, reviewer: str, queue_sha256: str) -> DataFrame:
    """The packet's rows with outcome, reason_code and reviewer, from decisions(review_kind, left_task_id, right_task_id, outcome, reason_code).

    Errors: another packet's hash, no reviewer, a pair decided twice or not at all, an outcome that is not of OUTCOMES, no reason. An
    outcome is never derived; decisions on pairs that are not in the packet are left out.
    """
    if not reviewer or not reviewer.strip():
        raise ValueError("a submission names its reviewer")
    if queue_sha256 != queue_hash(queue).first()[0]:
        raise ValueError("the decisions are for another packet")
    if not decisions.groupBy(*PAIR).count().filter("count > 1").isEmpty():
        raise ValueError("a pair is decided twice")
    rows = materialize(queue.join(decisions.select(*PAIR, "outcome", "reason_code"), PAIR, "left").withColumn("reviewer", F.lit(reviewer)), "review-decisions")
    good = F.col("outcome").isin(*OUTCOMES) & (F.length(F.trim("reason_code")) > 0)
    bad = rows.filter(~F.coalesce(good, F.lit(False))).orderBy("position").limit(1).collect()
    if bad:
        raise ValueError(f"no valid decision for {bad[0].review_kind}:{bad[0].left_task_id}:{bad[0].right_task_id}")
    return rows.select(*queue.columns, "outcome", "reason_code", "reviewer")


def receipt(rows: DataFrame, candidate_pairs: int, queue_sha256: str) -> DataFrame:
    """One row of counts of what `reviewed` gives; a probe found to be a duplicate asks for a review by vectors as well."""
    duplicate, probe = F.col("outcome") == "DUPLICATE", F.col("review_kind") == PROBE
    missed = F.count_if(duplicate & probe)
    every = F.array_sort(F.collect_list(F.struct("position", canonical_json(*(c for c in rows.columns if c != "position")).alias("j"))))
    return rows.agg(
        F.lit(candidate_pairs).cast("long").alias("candidate_pairs_generated"),
        F.count_if(~probe).alias("reviewed_candidate_pairs"),
        F.count_if(probe).alias("reviewed_probe_pairs"),
        F.count_if(duplicate).alias("reviewed_duplicates"),
        missed.alias("missed_duplicates"),
        F.when(missed == 0, NOT_REQUIRED).otherwise(REQUIRED).alias("semantic_vector_review"),
        F.lit(queue_sha256).alias("review_queue_sha256"),
        F.sha2(F.array_join(F.transform(every, lambda r: r.j), "\n"), 256).alias("review_sha256"),
    )
