"""Funnel, indicators, exclusion groups, stage graph: aggregates derived from records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveline.operators.dedup import BLOCK1
from sieveline.operators.schema import DEDUP, LABELS, STAGES, stage_table


def ratio(a, b) -> F.Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def summary(records: DataFrame) -> DataFrame:
    return records.agg(F.count("*").alias("total"), F.count_if(F.col("status") == "PASSED").alias("passed"), F.count_if(F.col("status") != "PASSED").alias("rejected"))


def rejection_counts(records: DataFrame) -> DataFrame:
    return records.where("status = 'REJECTED'").groupBy("rejection_code").agg(F.count("*").alias("n"))


def top_rejections(records: DataFrame, limit: int = 5) -> DataFrame:
    """A top-k report: the limit is the feature."""
    return rejection_counts(records).orderBy(F.desc("n"), "rejection_code").limit(limit)


def stage_status(n_input, n_output) -> F.Column:
    return F.when(n_input == 0, "SKIPPED").when(n_output == 0, "FAILED").when(n_output < n_input, "WARNING").otherwise("SUCCESS")


def funnel(records: DataFrame) -> DataFrame:
    """stage, ordinal, n_input, n_output, n_excluded, stage_status: six rows; windows run over those only."""
    spark = records.sparkSession
    out = records.where("status = 'REJECTED'").groupBy(F.col("rejection_stage").alias("stage")).agg(F.count("*").alias("gone"))
    total = records.agg(F.count("*").alias("total"))
    steps = stage_table(spark).join(out, "stage", "left").crossJoin(total).withColumn("gone", F.coalesce("gone", F.lit(0)))
    before = Window.orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.withColumn("n_input", F.col("total") - F.coalesce(F.sum("gone").over(before), F.lit(0))).withColumn("n_output", F.col("n_input") - F.col("gone"))
    return steps.select("stage", "ordinal", "n_input", "n_output", F.col("gone").alias("n_excluded"), stage_status(F.col("n_input"), F.col("n_output")).alias("stage_status"))


def largest_reduction(steps: DataFrame) -> DataFrame:
    return steps.where("n_excluded > 0").orderBy(F.desc("n_excluded"), "ordinal").limit(1)


def collision_counts(conflicts: DataFrame) -> DataFrame:
    return conflicts.groupBy("collision_type").agg(F.count("*").alias("n"))


def dedup_report(records: DataFrame, conflicts: DataFrame) -> DataFrame:
    kinds = conflicts.agg(F.count_if(F.col("collision_type") != BLOCK1).alias("duplicates"), F.count_if(F.col("collision_type") == BLOCK1).alias("block1_collisions"))
    approved = records.agg(F.count_if(F.col("status") == "PASSED").alias("n_input"))
    return approved.crossJoin(kinds).select("n_input", (F.col("n_input") - F.col("duplicates")).alias("n_output"), "duplicates", "block1_collisions")


def kpis(records: DataFrame, conflicts: DataFrame) -> DataFrame:
    warned = (F.col("status") == "PASSED") & (F.size("transformations") > 0)
    a = records.agg(F.count("*").alias("total"), F.count_if(F.col("status") == "PASSED").alias("approved"), F.count_if(F.col("status") == "REJECTED").alias("rejected"), F.count_if(warned).alias("warnings"))
    return a.crossJoin(conflicts.agg(F.count_if(F.col("collision_type") != BLOCK1).alias("duplicates")))


def exclusion_groups(records: DataFrame, conflicts: DataFrame) -> DataFrame:
    """reason, stage, n: rejected records by code and stage, and duplicates by kind. The member ids are ``excluded_ids``."""
    return excluded_ids(records, conflicts).groupBy("reason", "stage").agg(F.count("*").alias("n"))


def excluded_ids(records: DataFrame, conflicts: DataFrame) -> DataFrame:
    """reason, stage, input_id: a row per excluded record; a list per group would grow with the data."""
    rejected = records.where("status = 'REJECTED'").select(F.col("rejection_code").alias("reason"), F.col("rejection_stage").alias("stage"), "input_id")
    dup = conflicts.where(F.col("collision_type") != BLOCK1).select(F.col("collision_type").alias("reason"), F.lit(DEDUP).alias("stage"), F.col("incoming_id").alias("input_id"))
    return rejected.unionByName(dup)


def lineage(records: DataFrame) -> DataFrame:
    return records.select("input_id", "status", F.posexplode("transformations").alias("event_no", "e")).select("input_id", "status", "event_no", "e.stage", "e.rule")


def transformed_at(records: DataFrame, stage: str) -> DataFrame:
    return records.where(F.exists("transformations", lambda e: e["stage"] == stage))


def nodes(records: DataFrame, conflicts: DataFrame) -> DataFrame:
    """The stage graph's seven nodes with label, flow and status."""
    d = dedup_report(records, conflicts).select(F.lit(DEDUP).alias("stage"), F.lit(6).alias("ordinal"), "n_input", "n_output", F.col("duplicates").alias("n_excluded"))
    all_ = funnel(records).drop("stage_status").unionByName(d)
    named = F.element_at(F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv]), F.col("stage"))
    return all_.withColumn("node_status", stage_status(F.col("n_input"), F.col("n_output"))).withColumn("label", F.coalesce(named, F.initcap(F.translate(F.lower("stage"), "_", " "))))


def flow_edges(records: DataFrame, *by: str) -> DataFrame:
    """``by``, source, target, n: how many records of each group went from a stage to the next one; edges that none took are left out.

    A record takes the edges before the stage that rejected it. One aggregate by group and
    stage; the edges of a group are then at most as many as stages.
    """
    order = F.array(*map(F.lit, [*STAGES, DEDUP]))
    reached = F.when(F.col("status") == "REJECTED", F.array_position(order, F.col("rejection_stage"))).otherwise(F.size(order))
    ends = records.groupBy(*by, reached.cast("int").alias("last")).agg(F.count("*").alias("n")).where("last > 1")
    step = ends.select(*by, "n", F.explode(F.sequence(F.lit(1), F.col("last") - 1)).alias("i"))
    return step.groupBy(*by, F.get(order, F.col("i") - 1).alias("source"), F.get(order, F.col("i")).alias("target")).agg(F.sum("n").alias("n"))


def downstream(edge_rows: DataFrame, *by: str, nodes: int = len(STAGES) + 1) -> DataFrame:
    """``by``, source, reachable, steps: what each node of each group's graph leads to, by the fewest edges.

    For graphs of few ``nodes``, such as those of stages. Each round joins the pairs known with
    themselves and so doubles the reach; pairs met twice are one, so cycles do no harm (a node
    on one leads to itself).
    """
    out = edge_rows.select(*by, "source", F.col("target").alias("reachable"), F.lit(1).alias("steps")).distinct()
    for _ in range((nodes - 1).bit_length()):
        on = out.select(*by, F.col("source").alias("reachable"), F.col("reachable").alias("beyond"), F.col("steps").alias("more"))
        longer = out.join(on, [*by, "reachable"]).select(*by, "source", F.col("beyond").alias("reachable"), (F.col("steps") + F.col("more")).alias("steps"))
        out = out.unionByName(longer).groupBy(*by, "source", "reachable").agg(F.min("steps").alias("steps"))
    return out


def run_status(node_rows: DataFrame) -> DataFrame:
    any_ = lambda s: F.bool_or(F.col("node_status") == s)
    return node_rows.agg(F.when(any_("FAILED"), "FAILED").when(any_("RUNNING"), "RUNNING").when(any_("WARNING"), "WARNING").when(F.bool_and(F.col("node_status") == "SKIPPED"), "SKIPPED").otherwise("SUCCESS").alias("run_status"))


#: Limbs of 32 bits that a row's SHA-256 is summed in.
LIMBS = 8


def output_digest(rows: DataFrame, *columns: str) -> DataFrame:
    """n, digest: of a table as a multiset of rows, whatever their order and partitions; a doubled row changes it.

    Each row's SHA-256 is summed in eight limbs modulo 2^32, which merges over tasks and over
    tables (limb by limb). Rows are written with each value's length, so that no two rows are alike.
    """
    said = lambda c: F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
    row = F.sha2(F.concat_ws(",", *(said(F.col(c)) for c in columns)), 256)
    limb = lambda i: F.conv(F.substring(row, 8 * i + 1, 8), 16, 10).cast("bigint")
    # Decimals hold the sums of any number of rows.
    sums = rows.agg(F.count("*").alias("n"), *(F.sum(limb(i).cast("decimal(20,0)")).alias(f"s{i}") for i in range(LIMBS)))
    part = lambda i: F.lpad(F.lower(F.hex((F.coalesce(F.col(f"s{i}"), F.lit(0)) % F.lit(1 << 32)).cast("bigint"))), 8, "0")
    return sums.select("n", F.concat(*map(part, range(LIMBS))).alias("digest"))
