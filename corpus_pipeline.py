"""A corpus pipeline of five stages over the documents of a folder.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which ``run``
writes as Parquet and reads again for the next one.

All but the last keep the columns of their input, whatever others there are
and whatever their names. Rows without an id can't be judged by id; the filters
keep them unless their own text is judged. Of rows that share an id, a decision
holds for all. Null and empty texts are neither toxic, nor repeated, nor copies,
nor leaks, and stay; mixing takes them 0 times. An empty table stays empty. Equal
documents are ties that the smallest id wins.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm import decontam, lines, mixing, ngram_join, toxicity
from sieveline.llm.common import cut, table


def _fresh(docs: DataFrame, name: str) -> str:
    while name in (c.lower() for c in docs.columns):
        name = "_" + name
    return name


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id isn't in the one column of ``ids``; rows without an id stay."""
    own = _fresh(docs, "gone_id")
    gone = ids.toDF(own).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(own), "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model predicts as toxic go."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    judged = toxicity.score(docs.where("trim(text) <> ''"), model)
    return _without(docs, judged.where("predicted = 1").select("doc_id"))


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated multi-line chunks are cut out; documents of which nothing is left go.

    The operator's three counts don't stay; input columns of their names do. ``n_chars``, where there is one, follows the cut."""
    counts = ("n_units", "n_removed", "removed_chars")
    aside = {c: _fresh(docs, f"input_{c.lower()}") for c in docs.columns if c.lower() in counts}
    out = lines.dedup_lines(docs.withColumnsRenamed(aside))
    kept = out.where("n_removed = 0 or trim(text) <> ''")
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return kept.select(*(F.col(aside.get(c, c)).alias(c) for c in docs.columns))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    found = ngram_join.ngram_components(docs).where("doc_id <> component_id")
    return _without(docs, found.select("doc_id"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return _without(docs, cut(decontam.find_leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document goes into the mix."""
    return mixing.mix(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", cut_repeated_lines),
    ("near_duplicates", keep_one_of_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
]

#: Trained and latent models and hash-driven choices: SQL can't express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of ``sf_dir``; each one's output is written to the shared checkpoint folder and read again."""
    docs = table(spark, sf_dir, "documents")
    cut(spark.range(0))  # sets a checkpoint folder where the session names none
    base = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
