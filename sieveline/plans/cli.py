"""Command line: curate a documents table into a run folder. Exit codes: 0 done, 1 empty input or I/O error, 2 missing input, 130 interrupted."""

from __future__ import annotations

import argparse
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from sieveline.operators.curate import Criteria, curate
from sieveline.sources.sink import policy_hash, write_run

#: Fixed value: what marks runs without a policy's file, which compare with no other run.
UNVERSIONED = "UNVERSIONED_POLICY"


def run(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="sieveline", description=__doc__)
    p.add_argument("--input", required=True, help="a Parquet table of documents")
    p.add_argument("--out-dir", required=True)
    p.add_argument("--max-chars", type=int, default=Criteria.max_chars)
    p.add_argument("--max-words", type=int, default=Criteria.max_words)
    p.add_argument("--require-letters", action="store_true")
    p.add_argument("--format", choices=("parquet", "csv"), default="parquet")
    p.add_argument("--policy", help="the file of the policy that the run follows; its hash goes into the manifest")
    p.add_argument("--quiet", action="store_true")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("sieveline").getOrCreate()
    try:
        docs = spark.read.parquet(a.input)
    except AnalysisException:
        print(f"no such input: {a.input}", file=sys.stderr)
        return 2
    if docs.isEmpty():
        print("the input is empty", file=sys.stderr)
        return 1
    policy = UNVERSIONED
    if a.policy:
        try:
            policy = policy_hash(spark, a.policy)
        except AnalysisException:
            print(f"no such policy: {a.policy}; the run is marked {UNVERSIONED}", file=sys.stderr)
    criteria = Criteria(max_chars=a.max_chars, max_words=a.max_words, require_letters=a.require_letters)
    try:
        m = write_run(curate(docs, criteria), a.out_dir, vars(a) | {"criteria": criteria.describe()}, a.format, policy)
    except OSError as e:
        print(e, file=sys.stderr)
        return 1
    except KeyboardInterrupt:
        return 130
    if not a.quiet:
        print("\n".join(f"{k}: {m[k]}" for k in ("total", "passed", "rejected", "rejection_counts", "collision_counts")))
    return 0


if __name__ == "__main__":
    sys.exit(run())
