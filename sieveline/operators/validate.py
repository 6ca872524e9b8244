"""Agreement of annotators, confusion against a gold standard, distributions, policy ablation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.operators.report import ratio


def agreement(pairs: DataFrame) -> DataFrame:
    """n, po, pe, kappa, disagreements, interpretation from ``a`` and ``b``; one small contingency table is shuffled."""
    table = pairs.where("a is not null and b is not null").groupBy("a", "b").agg(F.count("*").alias("n"))
    marginal = table.select(F.col("a").alias("c"), F.col("n").alias("na"), F.lit(0).cast("long").alias("nb")).unionByName(table.select(F.col("b").alias("c"), F.lit(0).cast("long").alias("na"), F.col("n").alias("nb"))).groupBy("c").agg(F.sum("na").alias("na"), F.sum("nb").alias("nb"))
    total = table.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).alias("same"))
    chance = marginal.agg(F.sum(F.col("na").cast("double") * F.col("nb")).alias("chance"))
    r = total.crossJoin(chance).withColumns({"po": F.col("same") / F.col("n"), "pe": F.col("chance") / (F.col("n").cast("double") * F.col("n"))})
    r = r.withColumn("kappa", F.when(F.col("pe") >= 1, 1.0).otherwise((F.col("po") - F.col("pe")) / (1 - F.col("pe"))))
    return r.select("n", F.round("po", 9).alias("po"), F.round("pe", 9).alias("pe"), F.round("kappa", 9).alias("kappa"), (F.col("n") - F.col("same")).alias("disagreements"), interpretation(F.col("kappa")).alias("interpretation"))


#: Bands of kappa, from the top.
BANDS = ((0.81, "quase perfeita"), (0.61, "substancial"), (0.41, "moderada"), (0.21, "razoavel"), (0.00, "leve"))
WORST = "pobre (pior que o acaso)"


def interpretation(kappa) -> F.Column:
    return F.coalesce(*[F.when(kappa >= least, name) for least, name in BANDS], F.lit(WORST))


def resolved_label(consensus, a, b) -> F.Column:
    return F.coalesce(F.nullif(consensus, F.lit("")), F.when(a == b, a))


def normalize_label(col) -> F.Column:
    """ACCEPT, REJECT or null; anything else is an error."""
    v = F.nullif(F.upper(F.trim(col)), F.lit(""))
    return F.when(v.isNull() | v.isin("ACCEPT", "REJECT"), v).otherwise(F.raise_error(F.concat(F.lit("unknown label: "), v)))


def confusion(outcome: DataFrame) -> DataFrame:
    """From ``gold`` and ``predicted`` (ACCEPT or REJECT): counts and rates; REJECT is the positive class."""
    c = lambda g, p: F.count_if((F.col("gold") == g) & (F.col("predicted") == p))
    r = outcome.agg(c("REJECT", "REJECT").alias("tp"), c("ACCEPT", "REJECT").alias("fp"), c("ACCEPT", "ACCEPT").alias("tn"), c("REJECT", "ACCEPT").alias("fn"), F.count_if(F.col("gold").isNull()).alias("unresolved"))
    return r.select("*", *rates(*map(F.col, ("tp", "fp", "tn", "fn"))))


def rates(tp, fp, tn, fn) -> list[F.Column]:
    """prec, recall, f1, frr (good ones that were rejected), accuracy, each 0 where it would divide by 0."""
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    named = {"prec": precision, "recall": recall, "f1": ratio(2 * precision * recall, precision + recall), "frr": ratio(fp, fp + tn), "accuracy": ratio(tp + tn, tp + fp + tn + fn)}
    return [F.round(c, 9).alias(n) for n, c in named.items()]


def distribution(df: DataFrame, value: str, *by: str) -> DataFrame:
    v = F.col(value).cast("double")
    z = lambda c, name: F.round(F.coalesce(c, F.lit(0.0)), 6).alias(name)
    return df.groupBy(*by).agg(F.count(v).alias("n"), z(F.avg(v), "mean"), z(F.median(v), "median"), z(F.stddev_pop(v), "std"), z(F.min(v), "min"), z(F.max(v), "max"))


def ablation(docs: DataFrame, variants: DataFrame) -> DataFrame:
    """One pass for all policy variants (``variant, max_chars, min_chars``): passed, rejected, rate per variant."""
    size = F.length(F.coalesce("text", F.lit(""))).cast("long")
    rows = docs.select(size.alias("n_chars")).crossJoin(F.broadcast(variants))
    passed = F.col("n_chars").between(F.col("min_chars"), F.col("max_chars"))
    return rows.groupBy("variant").agg(F.count("*").alias("total"), F.count_if(passed).alias("passed"), F.sum(F.when(passed, F.col("n_chars")).otherwise(0)).alias("chars_kept"))


def against_baseline(results: DataFrame, baseline: str) -> DataFrame:
    base = results.where(F.col("variant") == baseline).select(F.col("passed").alias("base_passed"))
    d = F.col("passed") - F.col("base_passed")
    return results.crossJoin(F.broadcast(base)).select("variant", "passed", F.when(d == 0, "-").otherwise(F.format_string("%+d", d)).alias("delta"))
