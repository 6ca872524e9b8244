"""The ordered stages on structures as graphs: one audited record for each (seq, input_id, raw_smiles), passed or rejected.

PARSE rejects blank and malformed strings, never on valence. GET_PARENT strips isotopes, drops
listed counterions and solvents unless nothing else is there, and writes identical components
once; structures with other metals are excluded from that and kept as they are. VALENCE_GATE
judges the parent unless it is excluded. ELIGIBILITY measures it. CANONICALIZE gives the key.
No Python; a parent is parsed anew only where it differs. Structures that are written alike are
worked out once: rows are shuffled by what is written, twice (but on streams, which stay narrow).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions import graph as G
from sieveline.functions import structure as S
from sieveline.functions.text import strip

#: Components that a parent is freed of.
LISTED = ("Cl", "[Cl-]", "Br", "[Br-]", "I", "[I-]", "F", "[F-]", "[Li+]", "[Na+]", "[K+]", "[Mg+2]", "[Ca+2]", "O", "[OH-]", "N", "[NH4+]", "CO", "CCO", "CC(C)=O", "ClCCl", "CS(C)=O", "C1CCOC1", "OC(=O)C(F)(F)F", "OS(=O)(=O)O")

#: The columns of a record, in order.
RECORD = (
    "seq", "input_id", "raw_smiles", "curated_smiles", "identity", "block1", "status", "rejection_code", "rejection_stage", "rejection_detail", "transformations", "removed_fragments", "delta_net_charge",
    "delta_stereocenters", "n_stereocenters_total", "n_components_parent", "delta_formula", "parent_mw", "parent_heavy_atoms", "excluded_flag", "annotation",
)


@dataclass(frozen=True)
class Limits:
    """Inclusive limits of the eligibility stage on the parent, and switches of the policy."""

    max_weight: float = 1000.0
    max_heavy_atoms: int = 70
    require_carbon: bool = False
    discard_excluded: bool = False

    def describe(self) -> str:
        return f"weight up to {self.max_weight:g}, heavy atoms up to {self.max_heavy_atoms:g}" + ", carbon required" * self.require_carbon + ", excluded ones discarded" * self.discard_excluded


@dataclass(frozen=True)
class Probe:
    """Looks at a stage's boundary: ``inspect`` gets both sides, each struct(smiles, graph), and the stage's name; it gives a text to report, null if there is nothing."""

    rule: str
    inspect: Callable[[Column, Column, str], Column]


@dataclass(frozen=True)
class Hooks:
    """What a policy may replace or add, as functions on columns, so that the stages stay one plan.

    ``standardize`` rewrites a parsed structure before its parent is taken; where it gives null
    or what doesn't parse, the record is rejected with ERR_STANDARDIZE. ``parent_transform``
    rewrites the parent; where it gives null or what doesn't parse, the parent stays. Excluded
    structures are given to neither of them but to ``parent_transform``. ``probes`` look at
    both boundaries, STANDARDIZE and GET_PARENT, behind the fixed ones.
    """

    standardize: Callable[[Column], Column] | None = None
    parent_transform: Callable[[Column], Column] | None = None
    probes: tuple[Probe, ...] = ()


def each_once(rows: DataFrame, written: str, *aggregates: Column) -> DataFrame:
    """What is written in ``rows``, each once, with aggregates of its rows; dealt over all cores by hash, in a number of partitions that stays: a row of it is little to read and much to work out."""
    spark = rows.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(n, written).groupBy(written).agg(F.count(F.lit(1)).alias("n_rows"), *aggregates)


def parent(smiles: Column) -> Column:
    """The components that stay, sorted, dot-joined."""
    kept = S.keep_unless_all(S.fragments(S.strip_isotopes(smiles)), F.array(*map(F.lit, LISTED)))
    return F.array_join(F.array_distinct(kept), ".")


def curate_structures(pairs: DataFrame, limits: Limits = Limits(), hooks: Hooks = Hooks()) -> DataFrame:
    """The columns of a record (see the record's table in SURVEY) with deltas from input to parent, from ``seq, input_id, raw_smiles`` and an ``annotation``, if there is one.

    ``hooks`` are a policy's own steps; probes run before ``parent_transform``, deltas after it.
    Null and blank structures are rejected as empty; repeated rows are records of their own; extra columns are dropped.
    Functions of ``hooks`` must give the same for the same structure.
    """
    ann = F.col("annotation").cast("string") if "annotation" in pairs.columns else F.lit(None).cast("string")
    rows = pairs.select("seq", "input_id", F.coalesce("raw_smiles", F.lit("")).alias("raw_smiles"), ann.alias("annotation"))
    if pairs.isStreaming:
        return _worked_out(rows, limits, hooks).select(*RECORD)
    known = _worked_out(each_once(rows, "raw_smiles").select("raw_smiles"), limits, hooks)
    return rows.join(known, "raw_smiles").select(*RECORD)


def _worked_out(rows: DataFrame, limits: Limits, hooks: Hooks) -> DataFrame:
    """``rows`` with the columns of a record that follow from ``raw_smiles``."""
    given = rows.columns
    d = rows.withColumn("plain", strip(F.col("raw_smiles")))
    d = d.withColumn("given", G.parse(F.col("plain")))
    d = d.withColumn("excluded_flag", F.col("given.code").isNull() & G.excluded(F.col("given")))
    # Of malformed and excluded structures nothing is changed.
    changes = F.col("given.code").isNull() & ~F.col("excluded_flag")
    d = d.withColumns({"std_smiles": F.col("plain"), "std": F.col("given")})
    if hooks.standardize is not None:
        d = d.withColumn("std_smiles", F.when(changes, F.coalesce(strip(hooks.standardize(F.col("plain"))), F.lit(""))).otherwise(F.col("plain")))
        d = d.withColumn("std", F.when(F.col("std_smiles") == F.col("plain"), F.col("given")).otherwise(G.parse(F.col("std_smiles"))))
    d = d.withColumn("parent_smiles", F.when(changes, parent(F.col("std_smiles"))).otherwise(F.col("plain")))
    d = d.withColumn("first_parent", F.when(F.col("parent_smiles") == F.col("std_smiles"), F.col("std")).otherwise(G.parse(F.col("parent_smiles"))))
    d = d.withColumns({"final_smiles": F.col("parent_smiles"), "parent": F.col("first_parent")})
    if hooks.parent_transform is not None:
        made = strip(hooks.parent_transform(F.col("parent_smiles")))
        d = d.withColumn("made", F.struct(made.alias("smiles"), G.parse(made).alias("graph")))
        taken = F.col("first_parent.code").isNull() & F.col("made.smiles").isNotNull() & F.col("made.graph.code").isNull()
        d = d.withColumns({"final_smiles": F.when(taken, F.col("made.smiles")).otherwise(F.col("parent_smiles")), "parent": F.when(taken, F.col("made.graph")).otherwise(F.col("first_parent"))})
    d = d.withColumn("valence", G.valences(F.col("parent")))
    d = d.withColumns({"given_formula": G.formula(F.col("given"), G.valences(F.col("given"))), "parent_formula": G.formula(F.col("parent"), F.col("valence")), "mw": F.round(G.weight(F.col("parent"), F.col("valence")), 6), "heavy": F.size(F.filter("parent.atoms", lambda a: a["element"] != "H")), "carbons": F.size(F.filter("parent.atoms", lambda a: a["element"] == "C"))})
    reject = lambda code, stage, detail: F.struct(F.lit(code).alias("code"), F.lit(stage).alias("stage"), detail.alias("detail"))
    code = (
        F.when(F.col("given.code") == "ERR_EMPTY", reject("ERR_EMPTY", "PARSE", F.lit("no structure")))
        .when(F.col("given.code").isNotNull(), reject("ERR_SYNTAX", "PARSE", F.lit("not a structure")))
        .when(F.col("std.code").isNotNull(), reject("ERR_STANDARDIZE", "STANDARDIZE", F.lit("nothing that parses")))
        .when(F.lit(limits.discard_excluded) & F.col("excluded_flag"), reject("ERR_ORGANOMETALLIC", "GET_PARENT", F.lit("excluded")))
        .when(G.valence_code(F.col("parent"), F.col("valence")).isNotNull(), reject("ERR_VALENCE", "VALENCE_GATE", F.lit("an atom's valence")))
        .when(F.lit(limits.require_carbon) & (F.col("carbons") == 0), reject("ERR_NO_CARBON", "ELIGIBILITY", F.lit("no carbon")))
        .when(F.col("mw") > limits.max_weight, reject("ERR_MW_LIMIT", "ELIGIBILITY", F.format_string("%.3f > %s", "mw", F.lit(f"{limits.max_weight:g}"))))
        .when(F.col("heavy") > limits.max_heavy_atoms, reject("ERR_HA_LIMIT", "ELIGIBILITY", F.format_string("%d > %d", "heavy", F.lit(limits.max_heavy_atoms))))
    )
    d = d.withColumn("rejection", code)
    passed = F.col("rejection").isNull()
    skipped = F.col("excluded_flag") & (F.col("parent_smiles") == F.col("plain"))
    skip = F.array(F.struct(F.lit("STANDARDIZE").alias("stage"), F.lit("standardization_skipped_excluded").alias("rule"), F.col("plain").alias("before_smiles"), F.col("plain").alias("after_smiles"), F.lit("").alias("detail")))
    d = d.withColumn("before", measures(F.col("given"))).withColumn("middle", F.col("before"))
    if hooks.standardize is not None:
        d = d.withColumn("middle", F.when(F.col("std_smiles") == F.col("plain"), F.col("before")).otherwise(measures(F.col("std"))))
    d = d.withColumn("taken", F.when(F.col("parent_smiles") == F.col("std_smiles"), F.col("middle")).otherwise(measures(F.col("first_parent")))).withColumn("after", F.col("taken"))
    if hooks.parent_transform is not None:
        d = d.withColumn("after", F.when(F.col("final_smiles") == F.col("parent_smiles"), F.col("taken")).otherwise(measures(F.col("parent"))))
    none = F.slice(skip, 1, 0)
    side = lambda smiles, graph: F.struct(F.col(smiles).alias("smiles"), F.col(graph).alias("graph"))
    sides = side("plain", "given"), side("std_smiles", "std"), side("parent_smiles", "first_parent")
    seen = [F.when(skipped, skip).otherwise(none)]
    if hooks.standardize is not None:
        seen.append(probe_events(F.col("before"), F.col("middle"), F.col("plain"), F.col("std_smiles"), "STANDARDIZE"))
    seen.append(own_events(hooks.probes, *sides[:2], "STANDARDIZE"))
    # What standardizing didn't leave has no further boundary.
    later = [probe_events(F.col("middle"), F.col("taken"), F.col("std_smiles"), F.col("parent_smiles")), own_events(hooks.probes, *sides[1:], "GET_PARENT")]
    events = F.when(F.col("given.code").isNotNull() | F.col("std.code").isNotNull(), none).otherwise(F.concat(*(x for x in seen + later if x is not None)))
    identity = F.when(passed, G.identity_key(F.col("parent"), F.col("valence")))
    only = lambda c, other: F.when(passed, c).otherwise(other)
    measured = F.col("rejection.stage").isNull() | (F.col("rejection.stage") == "ELIGIBILITY")
    d = d.withColumns({"identity": identity, "transformations": events})
    return d.select(
        *given, F.when(passed, F.col("final_smiles")).alias("curated_smiles"), "identity", F.split("identity", "-")[0].alias("block1"),
        F.when(passed, "PASSED").otherwise("REJECTED").alias("status"), F.col("rejection.code").alias("rejection_code"), F.col("rejection.stage").alias("rejection_stage"), F.col("rejection.detail").alias("rejection_detail"),
        "transformations", F.when(passed & ~F.col("excluded_flag"), S.removed_fragments(S.strip_isotopes(F.col("std_smiles")), F.col("parent_smiles"))).alias("removed_fragments"),
        only(F.col("after.charge") - F.col("before.charge"), 0).alias("delta_net_charge"), only(F.col("after.stereo") - F.col("before.stereo"), 0).alias("delta_stereocenters"), only(F.col("after.stereo"), 0).alias("n_stereocenters_total"),
        only(F.size(F.split("final_smiles", r"\.")), 0).alias("n_components_parent"), only(S.formula_delta(F.col("given_formula"), F.col("parent_formula")), "").alias("delta_formula"),
        F.when(measured, F.col("mw")).alias("parent_mw"), F.when(measured, F.col("heavy")).alias("parent_heavy_atoms"), (passed & F.col("excluded_flag")).alias("excluded_flag"),
    )


def measures(g: Column) -> Column:
    """struct(bound, tartrate, stereo, charge, parts): what the probes compare over a stage's boundary."""
    return F.struct(
        G.count_matches(g, G.ALKALI).alias("bound"), G.count_matches(g, G.TARTRATE).alias("tartrate"), F.size(F.filter(g["atoms"], lambda a: a["chiral"] != "")).alias("stereo"),
        F.aggregate(g["atoms"], F.lit(0), lambda n, a: n + a["charge"]).alias("charge"), F.size(F.array_distinct(G.components(g))).alias("parts"),
    )


def own_events(probes: tuple[Probe, ...], before: Column, after: Column, stage: str) -> Column | None:
    """What a policy's own probes report at a boundary, in their order; None without probes."""
    said = lambda p: F.struct(F.lit(stage).alias("stage"), F.lit(p.rule).alias("rule"), before["smiles"].alias("before_smiles"), after["smiles"].alias("after_smiles"), p.inspect(before, after, stage).alias("detail"))
    return F.filter(F.array(*map(said, probes)), lambda e: e["detail"].isNotNull()) if probes else None


def probe_events(b: Column, a: Column, before: Column, after: Column, at: str = "GET_PARENT") -> Column:
    """What changed from a structure to what a stage made of it, by their ``measures``: bound alkali atoms, flattened tartrate, charge, components; in fixed order."""
    stage, same = F.lit(at), before == after
    event = lambda rule, detail: F.struct(stage.alias("stage"), F.lit(rule).alias("rule"), before.alias("before_smiles"), after.alias("after_smiles"), detail.alias("detail"))
    arrow = lambda what, form="%d -> %d": F.format_string(form, b[what], a[what])
    changed = [
        F.when(~same & (b["bound"] > a["bound"]), event("alkali_metal_ionized", arrow("bound"))),
        F.when(a["bound"] > 0, event("alkali_metal_residual", F.format_string("%d", a["bound"]))),
        F.when(~same & (b["stereo"] > a["stereo"]) & (b["tartrate"] > 0), event("tartrate_flattened", arrow("stereo"))),
        F.when(~same & (b["charge"] != a["charge"]), event("net_charge_changed", arrow("charge", "%+d -> %+d"))),
        F.when(~same & (a["parts"] < b["parts"]), event("fragments_removed", F.coalesce(S.removed_fragments(S.strip_isotopes(before), after), F.lit("")))),
        F.when(~same & (a["parts"] > b["parts"]), event("fragments_split", arrow("parts"))),
    ]
    return F.filter(F.array(*changed), lambda e: e.isNotNull())
