"""From raw documents to token ids: language ID, near-dedup, substring dedup, decontamination, tokenisation."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.bpe import bpe_encode
from skein.llm.decontaminate import without_items
from skein.llm.language_id import UND, identify, train
from skein.llm.queries import LEARN_LANGUAGE
from skein.llm.simhash import keep_one_of_each
from skein.llm.substring_dedup import relative_lz_dedup
from skein.storage import delete, keep_until_exit, scope, shared_root


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters, and those between languages: ambiguous, and no language above one half."""
    seen = identify(docs, train(docs, LEARN_LANGUAGE))
    pred, score, doubt = seen.columns[-3:]
    return seen.filter((F.col(pred) != UND) & ~(F.col(doubt) & (F.col(score) < 0.5))).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash, the row with the smallest id stays; rows are told apart by number, not by id."""
    return keep_one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out passages of 13 words or more that an earlier document has; every document stays, if with less text."""
    cut = relative_lz_dedup(docs, carry=docs.columns, locate=False)
    return cut.select(*((F.char_length("text").cast("long").alias(c) if c == "n_chars" else F.col(c)) for c in docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rows whose text contains a benchmark item of five words or more; ids take no part."""
    return without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id with the token ids, their number and the sums of ids and decoded bytes."""
    return bpe_encode(docs, keep_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", decontaminate),
    ("byte_bpe", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage's output is written once; its scratch tables and the input it no longer needs go after that."""
    docs, since = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        with scope(spark):
            made = stage(spark, docs, sf_dir)
            path = f"{shared_root(spark)}/skein-stage-{name}-{uuid.uuid4().hex}"
            made.write.parquet(path)
        if since:
            delete(spark, since)
        docs, since = spark.read.schema(made.schema).parquet(path), path
    keep_until_exit(spark, since)
    return docs


#: Language ID, SimHash and BPE can't be put into SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None
