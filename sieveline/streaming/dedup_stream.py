"""Curation of streams: the stages are stateless; exact duplicates are dropped within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.operators.curate import Criteria, curate


def curate_stream(docs: DataFrame, criteria: Criteria = Criteria()) -> DataFrame:
    return curate(docs, criteria)


def first_identities(records: DataFrame, time: str, delay: str) -> DataFrame:
    """The first arrival of each identity within ``delay``; state older than that is dropped."""
    return records.where("identity is not null").withWatermark(time, delay).dropDuplicatesWithinWatermark(["identity"])


def tumbling_counts(events: DataFrame, width: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    w = events.withWatermark("ts", delay).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"))
    return w.select(F.col("w.start").alias("window_start"), "event_type", "n")
