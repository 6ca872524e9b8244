"""What the jobs share: config files, logging, and counts of what a write wrote."""

from __future__ import annotations

import logging
import tomllib
from dataclasses import fields
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sieveline.operators.curate import Criteria


def load(path: str | Path, kind: type):
    """A config file (TOML) as the job's dataclass; unknown or mistyped settings are errors."""
    with open(path, "rb") as f:
        given = tomllib.load(f)
    policy = given.pop("policy", {})
    known = {f.name for f in fields(kind)} - {"policy"}
    for where, names, allowed in (("", given, known), ("policy.", policy, {f.name for f in fields(Criteria)})):
        if odd := sorted(set(names) - allowed):
            raise ValueError(f"unknown settings in {path}: {', '.join(where + n for n in odd)}")
    out = kind(**given, policy=Criteria(**policy))
    for f in fields(kind):
        default = getattr(kind(), f.name)
        if not isinstance(getattr(out, f.name), type(default)):
            raise ValueError(f"{f.name} in {path} must be of type {type(default).__name__}")
    return out


def write(df: DataFrame, path: str, *by: str, log: logging.Logger, parts: bool = False) -> int:
    """Writes Parquet in place of what ``path`` holds (``parts``: only in place of the partitions that ``df`` has rows of). Returns the rows, counted while writing."""
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    observed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if parts else "static").partitionBy(*by).parquet(path)
    rows = seen.get["rows"]
    log.info("wrote %d rows to %s%s", rows, path, f" by {', '.join(by)}" if by else "")
    return rows


def start(spark: SparkSession, path: str, schema: str, *by: str) -> None:
    """An empty table in a new place, so that it can be read; an existing one stays as it is."""
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy(*by).parquet(path)


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that the job itself writes. No column's type is guessed from folder names."""
    return spark.read.schema(schema).parquet(path)
