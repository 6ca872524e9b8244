"""Mixing sources to target weights by entropy balancing.

Word shares ``m_i = s_i * r_i`` of the documents (sizes ``s_i``) are chosen closest to the
sizes in relative entropy, under one token constraint for each source (its target) and one
over all of them: the mix's mean log length, weighted by words, is to stay what it is in the
documents, held by a penalty as it can't always be met. No rate may exceed ``most``. The
optimum tilts sizes exponentially, ``r_i = min(most, exp(lambda_source + mu * z_i))`` with
``z_i`` the document's log length less the mean, so documents of one source differ in rate.

Documents of one source and size share a rate, so Spark first counts them (never listing
documents). Given ``mu``, a source's multiplier follows exactly from its counts: its documents
reach the cap in the order of their tilt, and between two of them the token constraint is
solved in closed form. What is left of the convex dual is a function of ``mu`` alone, whose
slope never falls; Newton steps on it, one aggregate over the counts each, end where the
slope is 0. A step that would leave the bracket of the signs seen so far, or that doesn't get
on, halves the bracket instead, so that they end on every table. All sources meet their
targets at every step. Rates are rounded into whole copies from the largest size down,
carrying the error on, and a hash of the document decides which of the equally long documents
get the extra copy.

Edge cases: a null text has size 0 and is taken 0 times; null sources form one source, last
in order; sources without words have the target 0; an empty table gives an empty result;
repeated ids are separate rows; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveline.llm.common import WORD, cut

#: What the length constraint may be off by at the end, and what it weighs.
TOLERANCE, PENALTY = 1e-7, 0.05
SALTS = 64


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size: the words of the whole text."""
    return docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """source, source_size, target.

    A source's target is ``least(most * size, weight * level)``; the level is where
    all targets sum to all sizes, which is where resharing the excess by weight
    ends. Windows without keys run over one row per source only.
    """
    total = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    named = total.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights) + 1).cast("double"))
    cap = F.col("source_size") * F.lit(float(most))
    by_cap = Window.orderBy(cap / F.col("weight"), F.col("source").isNull(), F.col("source"))
    every = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    # Leaving out a source whose cap is below the level raises it, leaving out any other lowers it: the level is the highest.
    fits = named.withColumn("level", level).withColumn("level", F.max("level").over(every))
    return fits.select("source", "source_size", F.least(cap, F.col("level") * F.col("weight")).alias("target"))


def source_rates(s: np.ndarray, z: np.ndarray, target: float, mu: float, most: float) -> tuple[np.ndarray, np.ndarray]:
    """The rates of one source's sizes (word shares ``s``, tilts ``z``) that meet its target, and which of them are below the cap."""
    if target >= most * s.sum() * (1 - 1e-12):
        return np.full(len(s), float(most)), np.zeros(len(s), bool)
    x = mu * z
    order = np.argsort(-x, kind="stable")
    x, w = x[order], s[order]
    # With the first k at the cap the others' multiplier is in closed form; the right k is the first that leaves the next one below the cap.
    capped = np.concatenate([[0.0], np.cumsum(w)[:-1]])
    rest = np.logaddexp.accumulate((np.log(w) + x)[::-1])[::-1]
    left = target - most * capped
    with np.errstate(invalid="ignore", divide="ignore"):
        lam = np.where(left > 0, np.log(np.maximum(left, 1e-300)), -np.inf) - rest
    k = int(np.argmax(lam + x <= math.log(most)))
    rates = np.where(np.arange(len(x)) < k, float(most), np.exp(np.minimum(lam[k] + x, math.log(most))))
    out, free = np.empty(len(x)), np.empty(len(x), bool)
    out[order], free[order] = rates, np.arange(len(x)) >= k
    return out, free


def source_sums(s: np.ndarray, z: np.ndarray, target: float, mu: float, most: float) -> tuple[float, float]:
    """What one source adds to the dual's slope at ``mu``, and to the slope's own slope."""
    r, free = source_rates(s, z, target, mu, most)
    m, f = s * r, s * r * free
    a, b, c = f.sum(), (f * z).sum(), (f * z * z).sum()
    return float((m * z).sum()), float(c - b * b / a) if a > 0 else 0.0


def newton(sums) -> float:
    """The ``mu`` at which the dual's slope is 0, from ``sums(mu)``: the sources' sums."""
    mu, low, high, last = 0.0, -math.inf, math.inf, math.inf
    while True:
        slope, bend = sums(mu)
        slope += PENALTY * mu
        if abs(slope) <= TOLERANCE:
            return mu
        low, high = (low, mu) if slope > 0 else (mu, high)
        to = mu - slope / (max(bend, 0.0) + PENALTY)
        if math.isfinite(high - low) and (not low < to < high or abs(slope) > 0.5 * last):
            to = (low + high) / 2
        if to in (mu, low, high):
            return mu
        mu, last = to, abs(slope)


def tilts(cells: DataFrame, goal: DataFrame, most: float = 3.0) -> DataFrame:
    """source, size, n, rate from ``cells`` (source, size, n) and ``goal`` (source, source_size, target)."""
    words = F.col("size") * F.col("n")
    whole = cells.agg(F.sum(words).alias("w"), F.sum(words * F.log("size")).alias("l")).first()
    if not whole["w"]:
        return cells.withColumn("rate", F.lit(0.0))
    mean = whole["l"] / whole["w"]
    # Sums are in shares of all words, so that the penalty weighs the same at every size.
    base = cells.select("source", "size", "n", (F.log("size") - mean).alias("z"), (words / whole["w"]).alias("s"))
    named = goal.where("source_size > 0").select(F.col("source").alias("gs"), (F.col("target") / whole["w"]).alias("t"))
    # A group holds a source's distinct sizes, however many documents have them.
    held = cut(base.join(named, F.col("source").eqNullSafe(F.col("gs"))).drop("gs"))

    def sums(mu: float) -> tuple[float, float]:
        def one(pdf):
            pdf = pdf.sort_values("size")
            return pd.DataFrame([source_sums(pdf["s"].to_numpy(), pdf["z"].to_numpy(), pdf["t"].iloc[0], mu, most)], columns=["slope", "bend"])

        k = held.groupBy("source").applyInPandas(one, "slope double, bend double").agg(F.sum("slope").alias("slope"), F.sum("bend").alias("bend")).first()
        return k["slope"], k["bend"]

    mu = newton(sums)

    def rated(pdf):
        pdf = pdf.sort_values("size")
        # Sums of doubles differ in their last digits between runs; rates of six digits do not.
        return pdf.assign(rate=np.round(source_rates(pdf["s"].to_numpy(), pdf["z"].to_numpy(), pdf["t"].iloc[0], mu, most)[0], 6))[["source", "size", "n", "rate"]]

    return held.groupBy("source").applyInPandas(rated, "source string, size long, n long, rate double")


def _round(pdf, most: int):
    """Whole copies and extra ones per size of one source: the error is carried from larger sizes to smaller ones."""
    pdf = pdf.sort_values("size", ascending=False)
    carry, whole, extra = 0.0, [], []
    for size, n, rate in zip(pdf["size"].tolist(), pdf["n"].tolist(), pdf["rate"].tolist(), strict=True):
        base = math.floor(rate + 1e-9)
        want = (rate - base) * n * size + carry
        k = min(n, max(0, round(want / size))) if base < most else 0
        carry = want - k * size
        whole.append(base)
        extra.append(k)
    return pdf.assign(base=pd.Series(whole, pdf.index, "int64"), extra=pd.Series(extra, pdf.index, "int64"))[["source", "size", "base", "extra"]]


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies for each document."""
    # The one pass over the texts; some 30 bytes for each document.
    sized = cut(sizes(docs).withColumn("salt", F.pmod(F.xxhash64("doc_id", F.lit("order")), F.lit(SALTS)).cast("int")))
    goal = cut(targets(sized, weights, most))
    cells = cut(sized.where("size > 0").groupBy("source", "size", "salt").agg(F.count("*").alias("cell_n")))
    hist = tilts(cells.groupBy("source", "size").agg(F.sum("cell_n").alias("n")), goal, most)
    extra = hist.groupBy("source").applyInPandas(lambda pdf: _round(pdf, most), "source string, size long, base long, extra long")
    # A size's extra copies are dealt over its salts in proportion to their rows, by differences of a rounded running sum.
    same = Window.partitionBy("source", "size").orderBy("salt")
    ran = F.sum("cell_n").over(same)
    whole = F.sum("cell_n").over(Window.partitionBy("source", "size"))
    e = extra.select(F.col("source").alias("es"), F.col("size").alias("ez"), "base", "extra")
    dealt = cells.withColumn("ran", ran).withColumn("whole", whole).join(e, F.col("source").eqNullSafe(F.col("es")) & (F.col("size") == F.col("ez")))
    quota = F.floor(F.col("extra") * F.col("ran") / F.col("whole")) - F.floor(F.col("extra") * (F.col("ran") - F.col("cell_n")) / F.col("whole"))
    dealt = dealt.select(F.col("source").alias("ds"), F.col("size").alias("dz"), F.col("salt").alias("dsalt"), "base", quota.alias("quota"))
    first = Window.partitionBy("source", "size", "salt").orderBy(F.xxhash64("doc_id", F.lit("pick")), "doc_id")
    ranked = sized.withColumn("place", F.row_number().over(first))
    joined = ranked.join(dealt, F.col("source").eqNullSafe(F.col("ds")) & (F.col("size") == F.col("dz")) & (F.col("salt") == F.col("dsalt")), "left")
    joined = joined.join(goal.select(F.col("source").alias("gs"), "source_size", "target"), F.col("source").eqNullSafe(F.col("gs")), "left")
    copies = F.when(F.col("size") > 0, F.least(F.coalesce("base", F.lit(0)) + F.when(F.col("place") <= F.col("quota"), 1).otherwise(0), F.lit(most))).otherwise(0).cast("long")
    return joined.select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), (copies * F.col("size")).alias("taken"), copies.alias("copies"))
