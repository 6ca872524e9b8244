"""Column functions on structure strings (SMILES) and formulas that need no graph."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sieveline.functions.text import let, multiset_difference

TOKEN = r"\[[^\]]+\]|Br|Cl|[BCNOPSFI]|[bcnops]"
#: Average atomic weights.
WEIGHTS = {
    "H": 1.008, "Li": 6.94, "B": 10.81, "C": 12.011, "N": 14.007, "O": 15.999, "F": 18.998, "Na": 22.990, "Mg": 24.305, "Si": 28.085, "P": 30.974, "S": 32.06,
    "Cl": 35.45, "K": 39.098, "Ca": 40.078, "Fe": 55.845, "Cu": 63.546, "Zn": 65.38, "As": 74.922, "Se": 78.971, "Br": 79.904, "I": 126.904, "Pt": 195.084,
}


def tokens(smiles: Column) -> Column:
    return F.regexp_extract_all(smiles, F.lit(TOKEN), F.lit(0))


def net_charge(smiles: Column) -> Column:
    """Sum of the charges written in brackets: signs, or a sign and a number."""
    sign = F.regexp_extract_all(smiles, F.lit(r"\[[^\]+-]*([+-]+)(\d*)[^\]]*\]"), F.lit(1))
    size = F.regexp_extract_all(smiles, F.lit(r"\[[^\]+-]*([+-]+)(\d*)[^\]]*\]"), F.lit(2))
    one = lambda s, n: F.when(n == "", F.length(s)).otherwise(F.when(n != "", n).otherwise("0").cast("int")) * F.when(F.substring(s, 1, 1) == "+", 1).otherwise(-1)
    return F.aggregate(F.zip_with(sign, size, one), F.lit(0), lambda a, x: a + x)


def fragments(smiles: Column) -> Column:
    return F.when(smiles == "", F.array().cast("array<string>")).otherwise(F.array_sort(F.split(smiles, r"\.")))


def strip_isotopes(smiles: Column) -> Column:
    return F.regexp_replace(smiles, r"\[\d+([A-Za-z])", "[$1")


def stereo_marks(smiles: Column) -> Column:
    return F.size(F.regexp_extract_all(smiles, F.lit("@+"), F.lit(0)))


def covalent_alkali(smiles: Column) -> Column:
    """Neutral Li, Na or K written as bound to N or O."""
    return F.size(F.regexp_extract_all(smiles, F.lit(r"[NO]\[(?:Li|Na|K)\]|\[(?:Li|Na|K)\][NO]"), F.lit(0)))


def parse_formula(formula: Column) -> Column:
    """Map of element to count: cut at the first charge sign; a missing number is one; repeats add up."""
    plain = F.regexp_extract(formula, r"^[^+-]*", 0)
    element = F.regexp_extract_all(plain, F.lit(r"([A-Z][a-z]?)(\d*)"), F.lit(1))
    number = F.regexp_extract_all(plain, F.lit(r"([A-Z][a-z]?)(\d*)"), F.lit(2))
    pairs = F.zip_with(element, number, lambda e, n: F.struct(e.alias("e"), F.when(n == "", 1).otherwise(F.when(n != "", n).otherwise("0").cast("int")).alias("n")))

    def summed(all_):
        total = lambda e: F.aggregate(F.filter(all_, lambda p: p["e"] == e), F.lit(0), lambda a, p: a + p["n"])
        return let(F.sort_array(F.array_distinct(F.transform(all_, lambda p: p["e"]))), lambda keys: F.map_from_arrays(keys, F.transform(keys, total)))

    return let(pairs, summed)


def formula_delta(before: Column, after: Column) -> Column:
    """Changes by element, like ``+H1 -Na1``; empty if a side is empty or nothing changed."""

    def written(both):
        b, a = both["b"], both["a"]
        change = lambda k: F.struct(k.alias("k"), (F.coalesce(F.element_at(a, k), F.lit(0)) - F.coalesce(F.element_at(b, k), F.lit(0))).alias("d"))
        changes = F.transform(F.sort_array(F.array_union(F.map_keys(b), F.map_keys(a))), change)
        return F.transform(F.filter(changes, lambda c: c["d"] != 0), lambda c: F.concat(F.when(c["d"] > 0, "+").otherwise("-"), c["k"], F.abs(c["d"]).cast("string")))

    # Each side is parsed once, not once for each element.
    text = let(F.struct(parse_formula(before).alias("b"), parse_formula(after).alias("a")), written)
    return F.when((before == "") | (after == ""), "").otherwise(F.array_join(text, " "))


def molecular_weight(formula: Column) -> Column:
    weight = F.create_map(*[F.lit(x) for kv in WEIGHTS.items() for x in kv])
    entries = F.map_entries(parse_formula(formula))
    return F.aggregate(entries, F.lit(0.0), lambda s, e: s + F.coalesce(F.element_at(weight, e["key"]), F.lit(0.0)) * e["value"])


def heavy_atoms(formula: Column) -> Column:
    return F.aggregate(F.map_entries(parse_formula(formula)), F.lit(0), lambda s, e: s + F.when(e["key"] == "H", 0).otherwise(e["value"]))


def carbons(formula: Column) -> Column:
    return F.coalesce(F.element_at(parse_formula(formula), F.lit("C")), F.lit(0))


def removed_fragments(before: Column, after: Column) -> Column:
    """Fragments of ``before`` missing from ``after`` as a multiset, dot-joined; null if none."""
    gone = multiset_difference(fragments(before), fragments(after))
    return F.when(F.size(gone) > 0, F.array_join(gone, "."))


def keep_unless_all(parts: Column, listed: Column) -> Column:
    """Without the listed parts; all of them if all are listed."""
    rest = F.filter(parts, lambda p: ~F.array_contains(listed, p))
    return F.when(F.size(rest) > 0, rest).otherwise(parts)


def _event(stage: Column, rule: str, before: Column, after: Column, detail: Column) -> Column:
    return F.struct(stage.alias("stage"), F.lit(rule).alias("rule"), before.alias("before_smiles"), after.alias("after_smiles"), detail.alias("detail"))


def probe_events(before: Column, after: Column, stage: Column) -> Column:
    """What changed over a stage's boundary, in fixed order."""
    nb, na = covalent_alkali(before), covalent_alkali(after)
    cb, ca = net_charge(before), net_charge(after)
    fb, fa = F.size(fragments(before)), F.size(fragments(after))
    tartrate = before.rlike(r"OC\(=O\)\[C@+H?\]\(O\)\[C@+H?\]\(O\)C\(=O\)O")
    events = [
        F.when(nb > na, _event(stage, "alkali_metal_ionized", before, after, F.format_string("%d -> %d", nb, na))),
        F.when((stage == "GET_PARENT") & (na > 0), _event(stage, "alkali_metal_residual", before, after, F.format_string("%d", na))),
        F.when(tartrate & (stereo_marks(before) > stereo_marks(after)), _event(stage, "tartrate_flattened", before, after, F.format_string("%d -> %d", stereo_marks(before), stereo_marks(after)))),
        F.when(cb != ca, _event(stage, "net_charge_changed", before, after, F.format_string("%+d -> %+d", cb, ca))),
        F.when(fa < fb, _event(stage, "fragments_removed", before, after, F.coalesce(removed_fragments(before, after), F.lit("")))),
        F.when(fa > fb, _event(stage, "fragments_split", before, after, F.format_string("%d -> %d", fb, fa))),
    ]
    return F.filter(F.array(*events), lambda e: e.isNotNull())
