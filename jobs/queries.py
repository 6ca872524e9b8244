"""The jobs as queries over whole tables: each runs twice into one new folder and returns the output as it then stands."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from jobs import curation_feed, release_review
from sieveline.plans.catalogue import CONFLICTS, RATERS


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder where the cluster shares data; only a single machine that names none gets a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        shared = tempfile.mkdtemp(prefix="jobs_")
    return f"{shared}/{name}-{uuid.uuid4().hex}"


def job1_curation_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = _folder(spark, "job1")
    for _ in range(2):
        # A pattern: where the table is one file instead of a folder, only that can be a stream's path.
        out = curation_feed.run(spark, f"{sf_dir}/documents.parque[t]", f"{at}/out", f"{at}/checkpoint")
    return out


def job2_release_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = _folder(spark, "job2")
    for _ in range(2):
        out = release_review.run(spark, f"{sf_dir}/documents.parquet", f"{sf_dir}/labels.parquet", f"{at}/out")
    return out


QUERIES = {f.__name__: f for f in (job1_curation_feed, job2_release_review)}

_RULES = "concat_ws(',', CASE WHEN ev_norm = 1 THEN 'text_normalized' END, CASE WHEN ev_lines = 1 THEN 'lines_removed' END) AS rules"
_SHARE = lambda name, a, b: f"round(coalesce({a} / nullif(CAST({b} AS DOUBLE), 0), 0), 9) AS {name}"

ORACLE_SQL = {
    "job1_curation_feed": f"{CONFLICTS} SELECT r.input_id, status, rejection_code, rejection_stage, identity, n_chars, CAST(n_words AS INTEGER) AS n_words, {_RULES}, annotation, collision_type, existing_id, detail FROM records r LEFT JOIN conflicts c ON c.incoming_id = r.input_id",
    "job2_release_review": f"""{CONFLICTS}, raters AS ({RATERS}), gold AS (SELECT CAST(doc_id AS VARCHAR) AS input_id, CASE WHEN a = b THEN a END AS label FROM raters),
rows_ AS (
  SELECT r.input_id, rejection_code, rejection_stage, identity, c.existing_id AS duplicate_of, n_chars, CAST(n_words AS INTEGER) AS n_words, label,
    CASE WHEN g.input_id IS NULL THEN 'unlabelled' WHEN label IS NULL THEN 'unresolved' WHEN status = 'REJECTED' THEN CASE label WHEN 'REJECT' THEN 'tp' ELSE 'fp' END ELSE CASE label WHEN 'REJECT' THEN 'fn' ELSE 'tn' END END AS comparison,
    coalesce(nullif(lang, ''), 'none') AS language, CASE WHEN status <> 'PASSED' THEN 'rejected' WHEN c.existing_id IS NOT NULL THEN 'duplicate' ELSE 'released' END AS outcome
  FROM records r LEFT JOIN conflicts c ON c.incoming_id = r.input_id AND c.collision_type <> 'BLOCK1_COLLISION' LEFT JOIN gold g ON g.input_id = r.input_id
), counts AS (
  SELECT language, count(*) AS total, count(*) FILTER (outcome = 'rejected') AS rejected, count(*) FILTER (outcome = 'duplicate') AS duplicates, count(*) FILTER (outcome = 'released') AS released,
    {", ".join(f"count(*) FILTER (comparison = '{x}') AS {x}" for x in ("tp", "fp", "tn", "fn", "unresolved"))}
  FROM rows_ GROUP BY language
)
SELECT rows_.*, total, rejected, duplicates, released, tp, fp, tn, fn, unresolved, {_SHARE("prec", "tp", "tp + fp")}, {_SHARE("recall", "tp", "tp + fn")}, {_SHARE("f1", "2 * tp", "2 * tp + fp + fn")}, {_SHARE("frr", "fp", "fp + tn")}, {_SHARE("accuracy", "(tp + tn)", "tp + fp + tn + fn")}
FROM rows_ JOIN counts USING (language)""",
}
