"""The gold standard: rows that two annotators judged, checked, with an error for each bad field, and their agreement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.operators import validate
from sieveline.sources import ingest

#: Columns of the file, those that must be there, labels.
COLUMNS = ("compound_id", "raw_smiles", "annotator_a", "annotator_b", "consensus", "reason")
REQUIRED = COLUMNS[:4]
LABELS = ("ACCEPT", "REJECT")


def read(spark: SparkSession, path: str) -> DataFrame:
    """row and the columns of a CSV file with a header, as text; rows count from 2, the header being the first. A missing column is an error; further ones are ignored."""
    raw = spark.read.csv(path, header=True, quote='"', escape='"')
    if missing := sorted(set(REQUIRED) - set(raw.columns)):
        raise ValueError(f"columns missing: {', '.join(missing)}")
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"))
    kept = raw.select(place.alias("at"), *(F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in COLUMNS))
    return ingest.number(kept, "at").select((F.col("seq") + 1).alias("row"), *COLUMNS)


def _label(column: str) -> F.Column:
    return F.nullif(F.upper(F.trim(F.coalesce(column, F.lit("")))), F.lit(""))


def errors(rows: DataFrame) -> DataFrame:
    """row, field, value, message: one for each label that isn't one, and one for each row without both annotators' labels."""
    fields = ("annotator_a", "annotator_b", "consensus")
    odd = [F.when(~_label(c).isin(*LABELS), F.struct(F.lit(c).alias("field"), F.col(c).alias("value"), F.lit("neither ACCEPT nor REJECT").alias("message"))) for c in fields]
    lacks = F.when(_label("annotator_a").isNull() | _label("annotator_b").isNull(), F.struct(F.lit("annotators").alias("field"), F.lit(None).cast("string").alias("value"), F.lit("both annotators need a label").alias("message")))
    return rows.select("row", F.explode(F.filter(F.array(*odd, lacks), lambda e: e.isNotNull())).alias("e")).select("row", "e.*")


def entries(rows: DataFrame) -> DataFrame:
    """row, compound_id, raw_smiles, annotator_a, annotator_b, consensus, reason, resolved: the rows without errors, labels in capitals, texts without outer blanks."""
    trimmed = {c: F.trim(F.coalesce(c, F.lit(""))) for c in ("compound_id", "raw_smiles", "reason")}
    d = rows.withColumns(trimmed | {c: _label(c) for c in ("annotator_a", "annotator_b", "consensus")})
    good = d.where(F.col("annotator_a").isin(*LABELS) & F.col("annotator_b").isin(*LABELS) & F.coalesce(F.col("consensus").isin(*LABELS), F.lit(True)))
    return good.withColumn("resolved", validate.resolved_label(F.col("consensus"), F.col("annotator_a"), F.col("annotator_b")))


def agreement_report(given: DataFrame) -> DataFrame:
    """n, po, pe, kappa, disagreements, interpretation, unresolved, sufficient (a kappa of 0.61 or more): of ``entries``. One row; an empty set has n null."""
    a = validate.agreement(given.select(F.col("annotator_a").alias("a"), F.col("annotator_b").alias("b")))
    return a.crossJoin(given.agg(F.count_if(F.col("resolved").isNull()).alias("unresolved"))).withColumn("sufficient", F.col("kappa") >= 0.61)


def write_template(records: DataFrame, path: str) -> None:
    """A blank file for annotators: the records' ``input_id`` and ``raw_smiles``, the other columns empty."""
    blank = [F.lit("").alias(c) for c in COLUMNS[2:]]
    records.select(F.col("input_id").alias("compound_id"), "raw_smiles", *blank).write.mode("overwrite").option("emptyValue", "").csv(path, header=True)
