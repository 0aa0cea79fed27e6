"""Deterministic generated tasks."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.operators.joins import strict_join


#: The families in turn, the units in turn, and the tools of each family and of unseen combinations.
FAMILIES = ("lookup", "calculation_conversion", "cross_document_comparison")
SUITE_UNITS = ("cm", "s", "B")
SUITE_TOOLS = {
    "lookup": ("read_document", "calculate"),
    "calculation_conversion": ("read_document", "convert"),
    "cross_document_comparison": ("search_documents", "read_document", "calculate"),
}
UNSEEN_TOOLS = ("search_documents", "read_document", "calculate", "convert")


def tool_suite(spark: SparkSession, split: str, count: int = 200, groups: int = 20, unseen: int = 0) -> DataFrame:
    """Evaluation tasks of a split (DEVELOPMENT or TEST) by index alone; the first `unseen` have a combination of tools not seen before.

    Less than 20 groups are an error. Values that must be so for right results are fixed above and in the texts below.
    """
    if groups < 20:
        raise ValueError("20 independent source-template groups at least")
    i = F.col("id")
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (i % len(values) + 1).cast("int"))
    number = F.lpad((i % groups).cast("string"), 3, "0")
    rows = spark.range(count).select("id", pick(FAMILIES).alias("family"), pick(SUITE_UNITS).alias("expected_unit"), (i % 19 + 2).alias("v"), F.concat(F.lit("document-"), number).alias("doc"), F.concat(F.lit("companion-"), number).alias("companion"), number.alias("g"))
    rows = rows.withColumn("unseen_combination", i < unseen)
    family, unit, less = F.col("family"), F.col("expected_unit"), (F.col("v") - 1).cast("string")
    look, compare = family == "lookup", family == "cross_document_comparison"
    names = lambda xs: F.array(*map(F.lit, xs))
    tools = F.when(F.col("unseen_combination"), names(UNSEEN_TOOLS)).when(look, names(SUITE_TOOLS["lookup"])).when(compare, names(SUITE_TOOLS["cross_document_comparison"])).otherwise(names(SUITE_TOOLS["calculation_conversion"]))
    text = lambda d, *parts: F.struct(F.col(d).alias("document_id"), F.concat(*parts).alias("content"))
    s = F.lit
    documents = (
        F.when(look, F.array(text("doc", s("Recorded reading: "), F.col("v").cast("string"), s(" "), unit, s("."))))
        .when(compare, F.array(text("doc", s("Candidate reading: "), less, s(" "), unit, s(".")), text("companion", s("Adjustment: add 1 "), unit, s("."))))
        .otherwise(F.array(text("doc", s("Base reading: "), less, s(" "), unit, s(". Add one "), unit, s("."))))
    )
    asked = F.when(look, F.concat(s("Read "), "doc", s(" and return its recorded value with a document citation."))).otherwise("Read the visible document(s), calculate the requested adjusted value, and cite every visible document.")
    low = split.lower()
    return rows.select(
        F.concat(s(f"tooltask-{low}-"), F.lpad(i.cast("string"), 3, "0")).alias("task_id"),
        s(split).alias("split"),
        "family",
        F.concat(s(f"{low}-source-template-"), "g").alias("group_id"),
        F.concat(family, s("-template-"), (i % 5).cast("string")).alias("template_family_id"),
        F.when(F.col("unseen_combination"), 3).when(look, 1).otherwise(2).alias("dependency_depth"),
        tools.alias("tool_signature"),
        "unseen_combination",
        (i % 7 == 0).alias("recovery_condition"),
        asked.alias("instruction"),
        F.when(compare, F.array("doc", "companion")).otherwise(F.array("doc")).alias("document_ids"),
        documents.alias("documents"),
        F.col("v").cast("string").alias("expected_value"),
        "expected_unit",
    )


def suite_faults(tasks: DataFrame, least_family: int, least_unseen: int = 0, least: int = 200) -> DataFrame:
    """(fault) of a split: fewer tasks than `least`, a family below its minimum, too few unseen combinations."""
    row = tasks.agg(F.count(F.lit(1)).alias("n"), F.count_if("unseen_combination").alias("unseen"), *(F.count_if(F.col("family") == f).alias(f) for f in FAMILIES))
    faults = [F.when(F.col("n") < least, "TOO_FEW_TASKS"), *(F.when(F.col(f) < least_family, f"FAMILY:{f}") for f in FAMILIES), F.when(F.col("unseen") < least_unseen, "TOO_FEW_UNSEEN")]
    return row.select(F.explode(F.array_compact(F.array(*faults))).alias("fault"))


def load_suite(public: DataFrame, private: DataFrame) -> DataFrame:
    """Public tasks with their private references(task_id, value, unit, evidence); a task without one ends the query."""
    rows = strict_join(public, private.select("task_id", F.col("value").alias("expected_value"), F.col("unit").alias("expected_unit"), "evidence"), ["task_id"], "reference")
    same = F.when(F.col("evidence") == F.col("document_ids"), True).otherwise(F.raise_error(F.lit("evidence differs")).cast("boolean"))
    return rows.filter(same).drop("evidence")


def visible_facts(facts: DataFrame) -> DataFrame:
    """(document_id, value, unit): facts, and a zero for each companion; an id that occurs twice ends the query."""
    own = facts.select("document_id", "value", "unit")
    rows = own.union(facts.filter("companion_document_id is not null").select("companion_document_id", F.lit("0"), "unit"))
    twice = rows.groupBy("document_id").agg(F.count(F.lit(1)).alias("n"), F.first("value").alias("value"), F.first("unit").alias("unit"))
    once = F.when(F.col("n") == 1, True).otherwise(F.raise_error(F.concat(F.lit("two facts of "), "document_id")).cast("boolean"))
    return twice.filter(once).drop("n")


def public_tasks(suite: DataFrame) -> DataFrame:
    return suite.drop("expected_value", "expected_unit")


#: The pilot's families in order, and how many tasks each has.
PILOT_FAMILIES = (("lookup", 34), ("calculation_conversion", 33), ("cross_document_comparison", 33))


#: Each family's tools, how deep its steps depend on one another, and its instruction.
PILOT_TOOLS = {"lookup": ("search_documents", "read_document", "calculate"), "calculation_conversion": ("read_document", "calculate", "convert"), "cross_document_comparison": ("search_documents", "read_document", "calculate")}
PILOT_DEPTH = {"lookup": 1, "calculation_conversion": 2, "cross_document_comparison": 2}
PILOT_INSTRUCTIONS = {
    "lookup": "Read {document_id} and calculate {input_value} times {label}.",
    "calculation_conversion": "Read {document_id}, then convert {input_value} declared base quantities into {unit}.",
    "cross_document_comparison": "Read {document_id} and {companion_document_id}, then calculate the difference between {input_value} times {label} and the companion's zero value.",
}
PILOT_REVISION, PILOT_BUDGET = "pilot-v1", 3


def _by_family(of: Callable[[str], Column]) -> Column:
    """A column for each family."""
    return F.coalesce(*(F.when(F.col("task_family") == f, of(f)) for f, _ in PILOT_FAMILIES))


def _pilot(spark: SparkSession, facts: DataFrame) -> DataFrame:
    """Tasks beside their facts: the k-th task takes the k-th fact, over and over, in the order of `position` (of document_id without one)."""
    order = "position" if "position" in facts.columns else "document_id"
    ranked = facts.withColumn("f", F.row_number().over(Window.orderBy(order)) - 1).drop("position")  # a config's facts
    starts = spark.createDataFrame([(name, sum(n for _, n in PILOT_FAMILIES[:k]), n) for k, (name, n) in enumerate(PILOT_FAMILIES)], "task_family string, at int, n int")
    tasks = starts.select("task_family", "at", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("occurrence")).withColumn("k", F.col("at") + F.col("occurrence"))
    named = tasks.select("task_family", "occurrence", (F.col("k") + 1).alias("input_value"), (F.col("k") % facts.count()).alias("f"), F.concat(F.lit("pilot-"), F.lpad((F.col("k") + 1).cast("string"), 3, "0")).alias("task_id"))
    return named.join(F.broadcast(ranked), "f").withColumn("template_root", F.concat(F.col("task_family"), F.lit("-template-"), (F.col("occurrence") % 5).cast("string")))


def _both(own: str, companion: str, columns: list[str]) -> Column:
    """A fact's value, and for comparisons its companion's."""
    other = F.col(companion) if companion in columns else F.lit(None)
    return F.array_compact(F.array(F.col(own).cast("string"), F.when(F.col("task_family") == PILOT_FAMILIES[-1][0], other.cast("string"))))


def pilot_tasks(spark: SparkSession, facts: DataFrame) -> DataFrame:
    """The pilot's tasks for a split: task_id, family, template, source groups, related tasks and document.

    The n-th task of a family has template n modulo 5. Comparisons belong to the source groups of both facts, the companion's too
    where facts has it.
    """
    return _pilot(spark, facts).select("task_id", "task_family", "template_root", _both("source_group_id", "companion_source_group_id", facts.columns).alias("source_groups"), F.array().cast("array<string>").alias("related_task_ids"), "document_id")


def pilot_packages(spark: SparkSession, facts: DataFrame) -> DataFrame:
    """What a task hands out, and what only its verifier sees, of facts(document_id, source_record_id, source_group_id, label, value, unit, and companion_*).

    A task's input is its number, its expected value the fact's value times that. Columns of the model's side: task_id, task_revision, task_family,
    template_family_id, instruction, document_ids, tool_set, dependency_depth, max_steps, source_record_ids, source_group_ids, derivation_root_ids; of
    the verifier's: input_value, expected_value, expected_unit. A fact whose value is no whole number, or a comparison without a companion, ends the query.
    """
    rows = _pilot(spark, facts)
    value = F.col("value").try_cast("long")
    whole = F.when(value.isNotNull(), True).otherwise(F.raise_error(F.concat(F.lit("no whole value: "), "document_id")).cast("boolean"))
    paired = F.when((F.col("task_family") != PILOT_FAMILIES[-1][0]) | F.col("companion_document_id").isNotNull(), True).otherwise(F.raise_error(F.concat(F.lit("no companion: "), "document_id")).cast("boolean"))

    def filled(family: str) -> Column:
        parts = re.split(r"\{(\w+)\}", PILOT_INSTRUCTIONS[family])
        return F.concat(*(F.col(x).cast("string") if i % 2 else F.lit(x) for i, x in enumerate(parts)))

    both = lambda own: _both(own, f"companion_{own}", facts.columns)
    return rows.filter(whole & paired).select(
        "task_id",
        F.lit(PILOT_REVISION).alias("task_revision"),
        "task_family",
        F.col("template_root").alias("template_family_id"),
        _by_family(filled).alias("instruction"),
        both("document_id").alias("document_ids"),
        _by_family(lambda f: F.array(*map(F.lit, PILOT_TOOLS[f]))).alias("tool_set"),
        _by_family(lambda f: F.lit(PILOT_DEPTH[f])).alias("dependency_depth"),
        F.lit(PILOT_BUDGET).alias("max_steps"),
        both("source_record_id").alias("source_record_ids"),
        both("source_group_id").alias("source_group_ids"),
        F.array(F.concat("document_id", F.lit(":"), F.col("input_value").cast("string"))).alias("derivation_root_ids"),
        "input_value",
        (value * F.col("input_value")).alias("expected_value"),
        F.col("unit").alias("expected_unit"),
    )


def fixed_attempts(tasks: DataFrame, repetitions: int = 2) -> DataFrame:
    """Each task's attempts."""
    return tasks.withColumn("repetition", F.explode(F.sequence(F.lit(1), F.lit(repetitions)))).withColumn("attempt_id", F.concat_ws("-", "task_id", F.col("repetition").cast("string")))
