"""Curates what newly arrived in a folder of documents, and tells what it repeats of all that came before.

    python -m jobs.curation_feed --documents IN --out OUT --checkpoint CP [--config FILE]

The input is read as a file stream with an available-now trigger: a run takes the files that
no earlier run took, in batches, and ends. Each batch's documents become audited records; the
batch's first records of each identity are compared with those of earlier batches, so that a
repeated, conflicting or related document is found whenever it comes. Three tables grow:

    records    one row for each document, partitioned by batch and status
    firsts     the first record of each identity, partitioned by batch
    conflicts  duplicates, annotation conflicts, block-1 relatives, partitioned by batch

Order of arrival is the batch, then the document's id. A batch writes only its own partition,
whole, and reads only those of earlier batches; a batch that was stopped half-way is repeated under
its number by the stream's checkpoint and replaces what it had written. A run without new
files changes nothing. Output and checkpoint belong together: neither is used without the other.

Null ids and texts are records like others (an empty text is rejected); rows with the same id
stay rows; a table without rows gives empty tables, a folder without a file is an error; extra
columns are ignored.
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

from jobs.common import load, read, start, write
from sieveline.operators import curate, dedup

LOG = logging.getLogger("jobs.curation_feed")
RECORDS = "batch long, seq long, input_id string, identity string, block1 string, status string, rejection_code string, rejection_stage string, rejection_detail string, rules array<string>, n_chars long, n_words int, annotation string"
FIRSTS = "batch long, identity string, block1 string, seq long, input_id string, ann string"
CONFLICTS = "batch long, collision_type string, incoming_id string, existing_id string, incoming_key string, existing_key string, block1 string, detail string"


@dataclass(frozen=True)
class Config:
    files_per_batch: int = 200
    annotation: str = "source"
    status_folders: bool = True
    policy: curate.Criteria = field(default_factory=curate.Criteria)


def _names(schema: str) -> list[str]:
    """The columns in a batch's files; the batch itself is their folder's name."""
    return [c.split()[0] for c in schema.split(", ")][1:]


def _folders(config: Config) -> tuple[str, ...]:
    return ("batch", "status") if config.status_folders else ("batch",)


def _take(docs: DataFrame, batch: int, out: str, config: Config) -> None:
    """One batch: its records, its conflicts with itself and with all earlier batches, and its new identities."""
    spark = docs.sparkSession
    shaped = docs.select("doc_id", "text", F.col(config.annotation).cast("string").alias("source"), F.lit(None).cast("string").alias("lang"))
    made = curate.curate(shaped, config.policy).withColumn("rules", F.transform("transformations", lambda e: e["rule"]))
    LOG.info("batch %d: %d records", batch, write(made.select(_names(RECORDS)), f"{out}/records/batch={batch}", *_folders(config)[1:], log=LOG))
    # From here on the texts aren't read again.
    own = read(spark, f"{out}/records", RECORDS).where((F.col("batch") == batch) & (F.col("status") == "PASSED"))
    own = own.select("batch", "seq", "input_id", "identity", "block1", "annotation")
    known = read(spark, f"{out}/firsts", FIRSTS).where(F.col("batch") < batch)
    # Only identities of blocks that came again can matter.
    near = known.join(own.select("block1").distinct(), "block1", "left_semi")
    both = own.unionByName(near.select("batch", "seq", "input_id", "identity", "block1", F.col("ann").alias("annotation")))
    arrived = both.withColumn("seq", F.struct("batch", F.col("seq").alias("id")))
    found = dedup.collisions(arrived.withColumn("input_id", F.struct("batch", "input_id")))
    # The earlier batches' own relations were told then.
    found = found.where(F.col("incoming_id.batch") == batch).withColumns({"incoming_id": F.col("incoming_id.input_id"), "existing_id": F.col("existing_id.input_id")})
    write(found.select(_names(CONFLICTS)), f"{out}/conflicts/batch={batch}", log=LOG)
    new = dedup.first_records(own.withColumnRenamed("annotation", "ann")).join(near.select("identity"), "identity", "left_anti")
    write(new.select(_names(FIRSTS)), f"{out}/firsts/batch={batch}", log=LOG)


def run(spark: SparkSession, documents: str, out: str, checkpoint: str, config: Config | None = None) -> DataFrame:
    """Takes all new files of ``documents`` and returns ``output``."""
    config = config or Config()
    schema = spark.read.parquet(documents).schema
    LOG.info("reading new files of %s (%d columns), policy: %s", documents, len(schema), config.policy.describe())
    start(spark, f"{out}/records", RECORDS, *_folders(config))
    start(spark, f"{out}/firsts", FIRSTS, "batch")
    start(spark, f"{out}/conflicts", CONFLICTS, "batch")
    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", config.files_per_batch).parquet(documents)
    query = arriving.writeStream.foreachBatch(lambda docs, batch: _take(docs, batch, out, config)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()
    taken = sum(p["numInputRows"] for p in query.recentProgress)
    LOG.info("took %d rows in %d batches", taken, sum(p["numInputRows"] > 0 for p in query.recentProgress))
    return output(spark, out)


def output(spark: SparkSession, out: str) -> DataFrame:
    """Each record with the conflict that it came with, if any."""
    records, conflicts = read(spark, f"{out}/records", RECORDS), read(spark, f"{out}/conflicts", CONFLICTS)
    # Rows that share an id within a batch have as many conflicts as they have repetitions; each is told once.
    told = conflicts.groupBy(F.col("batch").alias("b"), F.col("incoming_id").alias("i")).agg(F.min(F.struct("collision_type", "existing_id", "detail")).alias("c"), F.count("*").alias("n_conflicts"))
    met = records.join(told, (F.col("batch") == F.col("b")) & F.col("input_id").eqNullSafe(F.col("i")) & (F.col("status") == "PASSED"), "left")
    return met.select("input_id", "status", "rejection_code", "rejection_stage", "identity", "n_chars", "n_words", F.array_join("rules", ",").alias("rules"), "annotation", F.col("c.collision_type").alias("collision_type"), F.col("c.existing_id").alias("existing_id"), F.col("c.detail").alias("detail"))


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="jobs.curation_feed", description="Curates what newly arrived in a folder of documents.")
    p.add_argument("--documents", required=True, help="a folder that receives Parquet files of documents")
    p.add_argument("--out", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--config", default=str(Path(__file__).with_suffix(".toml")))
    a = p.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    config = load(a.config, Config)
    spark = SparkSession.builder.appName("curation_feed").getOrCreate()
    try:
        result = run(spark, a.documents, a.out, a.checkpoint, config)
        for row in result.groupBy("status", "rejection_code", "collision_type").count().orderBy("status", "rejection_code", "collision_type").collect():
            LOG.info("in all: %s", row.asDict())
    except AnalysisException as e:
        LOG.error("can't read the input: %s", str(e).split("\n")[0])
        return 2
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
