"""The ordered stages as columns: documents to audited records. One record per input, passed or rejected."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.functions import text as T


@dataclass(frozen=True)
class Criteria:
    """Inclusive limits of the eligibility stage, and switches of the policy."""

    min_chars: int = 40
    max_chars: int = 5000
    max_words: int = 1000
    require_letters: bool = False

    def describe(self) -> str:
        return f"chars {self.min_chars:g} to {self.max_chars:g}, words up to {self.max_words:g}" + ", letters required" * self.require_letters


RECORD = ("seq", "input_id", "raw_text", "curated_text", "identity", "block1", "status", "rejection_code", "rejection_stage", "rejection_detail", "transformations", "removed_fragments", "n_chars", "n_words", "annotation")


def curate(docs: DataFrame, criteria: Criteria = Criteria()) -> DataFrame:
    """Records of documents; a narrow plan of built-in expressions, without a shuffle.

    PARSE rejects short texts; STANDARDIZE records white space and case changes;
    GET_PARENT drops repeated lines; ELIGIBILITY tests letters, characters, words in
    that order; CANONICALIZE gives the identity key. Rejected records keep their
    events and have no curated text and no key.
    """
    text = F.coalesce("text", F.lit(""))
    size = F.length(text).cast("long")
    words = F.size(F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " "))
    lines = F.split(text, "\n")
    gone = T.multiset_difference(lines, F.array_distinct(lines))
    norm = T.normalize(text)
    d = docs.select(F.col("doc_id").alias("seq"), F.col("doc_id").cast("string").alias("input_id"), text.alias("raw_text"), size.alias("n_chars"), words.alias("n_words"), norm.alias("norm"), gone.alias("gone"), (F.size(lines) > F.size(F.array_distinct(lines))).alias("repeats"), F.col("source").alias("annotation"), "lang")
    code = (
        F.when(F.col("n_chars") < criteria.min_chars, F.struct(F.lit("ERR_EMPTY"), F.lit("PARSE"), F.format_string("%d characters", "n_chars")))
        .when(F.lit(criteria.require_letters) & ~F.col("raw_text").rlike("[A-Za-z]"), F.struct(F.lit("ERR_NO_CARBON"), F.lit("ELIGIBILITY"), F.lit("no letter")))
        .when(F.col("n_chars") > criteria.max_chars, F.struct(F.lit("ERR_MW_LIMIT"), F.lit("ELIGIBILITY"), F.format_string("%d > %d", "n_chars", F.lit(criteria.max_chars))))
        .when(F.col("n_words") > criteria.max_words, F.struct(F.lit("ERR_HA_LIMIT"), F.lit("ELIGIBILITY"), F.format_string("%d > %d", "n_words", F.lit(criteria.max_words))))
    )
    parsed = F.col("n_chars") >= criteria.min_chars
    event = lambda stage, rule: F.struct(F.lit(stage).alias("stage"), F.lit(rule).alias("rule"))
    events = F.array(F.when(parsed & (F.col("norm") != F.col("raw_text")), event("STANDARDIZE", "text_normalized")), F.when(parsed & F.col("repeats"), event("GET_PARENT", "lines_removed")))
    passed = F.col("rejection").isNull()
    d = d.withColumn("rejection", code)
    key = F.when(passed, T.identity_key(F.col("norm")))
    d = d.withColumn("identity", key)
    return d.select(
        "seq", "input_id", "raw_text", F.when(passed, F.col("norm")).alias("curated_text"), "identity", T.block1(F.col("identity")).alias("block1"),
        F.when(passed, "PASSED").otherwise("REJECTED").alias("status"), F.col("rejection.col1").alias("rejection_code"), F.col("rejection.col2").alias("rejection_stage"), F.col("rejection.col3").alias("rejection_detail"),
        F.filter(events, lambda e: e.isNotNull()).alias("transformations"), F.when(passed & F.col("repeats"), F.array_join("gone", "\n")).alias("removed_fragments"), "n_chars", "n_words", "annotation", "lang",
    )
