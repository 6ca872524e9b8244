"""Releases a curated corpus by language and reviews its policy against two annotators' labels.

    python -m jobs.release_review --documents IN --labels IN --out OUT [--config FILE]

Documents become audited records; of records with the same identity the first stays. Each
record is set against the label that the annotators agree on, where there is one. Two tables:

    release  one row for each document: its verdict, what it repeats, the label and how the
             verdict compares; partitioned by language
    review   one row for each language: the funnel, counts of the confusion, rates;
             partitioned by language

A run over all languages replaces both tables. A run over the languages of the config replaces
their partitions alone (dynamic partition overwrite), so that one can be released anew after a
change; one that has no document left keeps its old partition until all are released. A rerun
gives the same rows. Duplicates are judged over all documents whatever the languages released.

Documents without a language have the language 'none'. Null texts are empty texts. Rows that
share both id and identity with the first record are released with it. Labels of the same
document by the same annotator that differ leave that annotator undecided.
"""

from __future__ import annotations

import argparse
import logging
import sys
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import load, read, write
from sieveline.operators import curate, dedup, report, validate

LOG = logging.getLogger("jobs.release_review")
RELEASE = "input_id string, rejection_code string, rejection_stage string, identity string, duplicate_of string, n_chars long, n_words int, label string, comparison string, outcome string, language string"
REVIEW = "total long, rejected long, duplicates long, released long, tp long, fp long, tn long, fn long, unresolved long, prec double, recall double, f1 double, frr double, accuracy double, language string"
#: The folder of documents without a language.
NONE = "none"


@dataclass(frozen=True)
class Config:
    languages: list = field(default_factory=list)
    files_per_folder: int = 4
    annotators: dict = field(default_factory=lambda: {"quality": {"accept": [1], "reject": [0]}, "toxic": {"accept": [0], "reject": [1]}})
    policy: curate.Criteria = field(default_factory=curate.Criteria)


def resolved(labels: DataFrame, annotators: dict) -> DataFrame:
    """input_id, label: what both annotators say; null where they differ or one is undecided."""
    if len(annotators) != 2:
        raise ValueError("two annotators are compared")

    def said(column: str) -> F.Column:
        marks = annotators[column]
        one = F.when(F.col(column).isin(marks["accept"]), "ACCEPT").when(F.col(column).isin(marks["reject"]), "REJECT")
        return F.when(F.min(one) == F.max(one), F.min(one))

    a, b = annotators
    each = labels.groupBy(F.col("doc_id").cast("string").alias("input_id")).agg(said(a).alias("a"), said(b).alias("b"))
    return each.select("input_id", validate.resolved_label(F.lit(None).cast("string"), F.col("a"), F.col("b")).alias("label"), F.lit(True).alias("labelled"))


def released(docs: DataFrame, labels: DataFrame, config: Config) -> DataFrame:
    """One row for each document."""
    records = curate.curate(docs, config.policy)
    firsts = dedup.first_records(records.where("identity is not null").select("seq", "input_id", "identity", "block1", F.col("annotation").alias("ann")))
    of = firsts.select(F.col("identity").alias("same"), F.col("input_id").alias("first_id"))
    # Rejected records have no identity; given ones of their own they spread over the join's partitions.
    met = records.join(of, F.coalesce("identity", F.concat(F.lit("none of "), "input_id")) == F.col("same"), "left")
    told = met.join(resolved(labels, config.annotators), "input_id", "left")
    repeats = F.col("first_id").isNotNull() & (F.col("first_id") != F.col("input_id"))
    predicted = F.when(F.col("status") == "PASSED", "ACCEPT").otherwise("REJECT")
    comparison = F.when(F.col("labelled").isNull(), "unlabelled").when(F.col("label").isNull(), "unresolved").when(predicted == "REJECT", F.when(F.col("label") == "REJECT", "tp").otherwise("fp")).otherwise(F.when(F.col("label") == "REJECT", "fn").otherwise("tn"))
    rows = told.withColumns({
        "duplicate_of": F.when(repeats, F.col("first_id")), "comparison": comparison, "language": F.coalesce(F.nullif("lang", F.lit("")), F.lit(NONE)),
        "outcome": F.when(F.col("status") != "PASSED", "rejected").when(repeats, "duplicate").otherwise("released"),
    })
    if config.languages:
        rows = rows.where(F.col("language").isin([x or NONE for x in config.languages]))
    return rows.select([c.split()[0] for c in RELEASE.split(", ")])


def reviewed(release: DataFrame) -> DataFrame:
    """The review of each language, from the release's rows: one aggregate."""
    n = lambda c, value: F.count_if(F.col(c) == value)
    counts = release.groupBy("language").agg(
        F.count("*").alias("total"), n("outcome", "rejected").alias("rejected"), n("outcome", "duplicate").alias("duplicates"), n("outcome", "released").alias("released"),
        *(n("comparison", x).alias(x) for x in ("tp", "fp", "tn", "fn", "unresolved")),
    )
    return counts.select([*(c.split()[0] for c in REVIEW.split(", ")[:9]), *validate.rates(*map(F.col, ("tp", "fp", "tn", "fn"))), "language"])


def run(spark: SparkSession, documents: str, labels: str, out: str, config: Config | None = None) -> DataFrame:
    """Writes both tables and returns ``output``."""
    config = config or Config()
    docs, marks = spark.read.parquet(documents), spark.read.parquet(labels)
    LOG.info("reading %s and %s, policy: %s, languages: %s", documents, labels, config.policy.describe(), ", ".join(config.languages) or "all")
    rows = released(docs, marks, config)
    # A language's rows, however many, are dealt over a few tasks.
    dealt = rows.withColumn("deal", F.pmod(F.xxhash64("input_id"), F.lit(config.files_per_folder))).repartition("language", "deal").drop("deal")
    some = bool(config.languages)
    write(dealt, f"{out}/release", "language", log=LOG, parts=some)
    written = read(spark, f"{out}/release", RELEASE)
    if some:
        written = written.where(F.col("language").isin([x or NONE for x in config.languages]))
    write(reviewed(written), f"{out}/review", "language", log=LOG, parts=some)
    return output(spark, out)


def output(spark: SparkSession, out: str) -> DataFrame:
    """Each row of the release with its language's review."""
    review = read(spark, f"{out}/review", REVIEW)
    return read(spark, f"{out}/release", RELEASE).join(review, "language")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="jobs.release_review", description="Releases a curated corpus by language and reviews its policy against two annotators' labels.")
    p.add_argument("--documents", required=True, help="a Parquet table of documents")
    p.add_argument("--labels", required=True, help="a Parquet table of labels by document")
    p.add_argument("--out", required=True)
    p.add_argument("--config", default=str(Path(__file__).with_suffix(".toml")))
    a = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    config = load(a.config, Config)
    spark = SparkSession.builder.appName("release_review").getOrCreate()
    try:
        run(spark, a.documents, a.labels, a.out, config)
        for row in read(spark, f"{a.out}/review", REVIEW).orderBy("language").collect():
            LOG.info("%s: %s", row["language"], {k: v for k, v in row.asDict().items() if k != "language"})
    except AnalysisException as e:
        LOG.error("can't read the input: %s", str(e).split("\n")[0])
        return 2
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
