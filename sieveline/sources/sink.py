"""Staged output: records are worked out and written once, what else a run holds is read from them; the manifest comes last as the mark of completeness."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sieveline.operators.dedup import ANNOTATION, BLOCK1, EXACT, collisions
from sieveline.operators.schema import CODES

STAGING = ".staging-"
CURATED = ("input_id", "curated_text", "identity", "block1")
REJECTED = ("input_id", "raw_text", "rejection_code", "rejection_stage", "rejection_detail")
#: CSV files quote as the reader of tables does, and keep line ends inside texts.
CSV = {"header": True, "quote": '"', "escape": '"', "emptyValue": ""}


def _fs(spark, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _count(name: str, column: str, values) -> list:
    return [F.count_if(F.col(column) == v).alias(f"{name}:{v}") for v in values]


def _counts(got: dict, name: str) -> dict:
    return {k.partition(":")[2]: v for k, v in sorted(got.items()) if k.startswith(f"{name}:") and v}


def policy_hash(spark: SparkSession, path: str) -> str:
    """The SHA-256 of a policy's file, hashed where it is read; an error if it is missing."""
    return spark.read.format("binaryFile").load(path).select(F.sha2("content", 256).alias("h")).first()["h"]


def remove_stale(spark: SparkSession, out_dir: str) -> int:
    """Removes what stopped runs left in their staging folders; their number. For one run at a time in a folder."""
    fs, path = _fs(spark, out_dir)
    if not fs.exists(path(out_dir)):
        return 0
    left = [s.getPath() for s in fs.listStatus(path(out_dir)) if s.getPath().getName().startswith(STAGING)]
    for p in left:
        fs.delete(p, True)
    return len(left)


def write_run(records: DataFrame, out_dir: str, parameters: dict | None = None, fmt: str = "parquet", policy: str | None = None) -> dict:
    """Writes curated, rejected, audit and conflicts as ``fmt`` (parquet or csv), then ``manifest.json``; returns the manifest. An error while writing leaves the
    folder as it was; one while moving leaves it without a manifest.

    One pass works the records out, writes them and counts them (the write has no shuffle, so
    that a repeated task counts once). The other outputs read the columns they need from what
    it wrote. ``seconds`` are those of each write; ``policy`` is a policy's hash, as by
    ``policy_hash``. Codes that are none of ``CODES`` count as UNKNOWN.
    """
    spark = records.sparkSession
    fs, path = _fs(spark, out_dir)
    stale = remove_stale(spark, out_dir)
    staging = f"{out_dir}/{STAGING}{uuid.uuid4().hex}"
    options = CSV if fmt == "csv" else {}
    seconds: dict[str, float] = {}

    def write(name: str, df: DataFrame, form: str = fmt) -> None:
        began = time.monotonic()
        df.write.format(form).options(**(options if form == fmt else {})).save(f"{staging}/{name}")
        seconds[name] = round(time.monotonic() - began, 3)

    try:
        seen, met = Observation(), Observation()
        rejected = F.col("status") == "REJECTED"
        other = F.count_if(rejected & ~F.coalesce(F.col("rejection_code").isin(*CODES), F.lit(False))).alias("code:UNKNOWN")
        counted = records.withColumn("transformations", F.to_json("transformations")).observe(
            seen, F.count("*").alias("total"), F.count_if(F.col("status") == "PASSED").alias("passed"), F.count_if(rejected).alias("rejected"), *_count("code", "rejection_code", CODES), other
        )
        write("audit" if fmt == "parquet" else "records", counted, "parquet")
        done = spark.read.schema(counted.schema).parquet(f"{staging}/{'audit' if fmt == 'parquet' else 'records'}")
        if fmt != "parquet":
            write("audit", done)
        write("curated", done.where("status = 'PASSED'").select(*CURATED))
        write("rejected", done.where("status = 'REJECTED'").select(*REJECTED))
        # Counted behind the last shuffle, where a stage's tasks are those that write.
        write("conflicts", collisions(done).observe(met, F.count("*").alias("n"), *_count("kind", "collision_type", (ANNOTATION, BLOCK1, EXACT))))
        n, kinds = seen.get, _counts(met.get, "kind")
        outputs = ("audit", "conflicts", "curated", "rejected")
        manifest = {
            "spark_version": spark.version, "policy_hash": policy, "parameters": parameters or {}, "format": fmt, "total": n["total"], "passed": n["passed"], "rejected": n["rejected"],
            "rejection_counts": _counts(n, "code"), "collision_counts": kinds, "unique": n["passed"] - sum(v for k, v in kinds.items() if k != BLOCK1), "outputs": list(outputs), "seconds": seconds, "stale_removed": stale,
        }
        # Without a manifest a run is not complete; the earlier outputs go only once the new ones stand beside them.
        fs.delete(path(f"{out_dir}/manifest.json"), False)
        for name in outputs:
            if fs.exists(path(f"{out_dir}/{name}")) and not fs.rename(path(f"{out_dir}/{name}"), path(f"{staging}/earlier-{name}")):
                raise OSError(f"can't move the earlier {name} away")
            if not fs.rename(path(f"{staging}/{name}"), path(f"{out_dir}/{name}")):
                raise OSError(f"can't move {name} into place")
        stream = fs.create(path(f"{out_dir}/manifest.json"), True)
        stream.write(bytearray(json.dumps(manifest, indent=2, ensure_ascii=False).encode()))
        stream.close()
        return manifest
    finally:
        fs.delete(path(staging), True)


def read_manifest(spark, out_dir: str) -> dict | None:
    """The manifest of a complete run; None if it is missing or damaged."""
    fs, path = _fs(spark, out_dir)
    if not fs.exists(path(f"{out_dir}/manifest.json")):
        return None
    text = "\n".join(r["value"] for r in spark.read.text(f"{out_dir}/manifest.json").collect())
    try:
        return json.loads(text)
    except ValueError:
        return None
